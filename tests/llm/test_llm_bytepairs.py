"""Byte-level BPE against the tiktoken library, on every codepoint and on long texts."""

import base64
import hashlib
import random
import struct
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from corpus_cases import ODD, SF, docs, result
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import bytepairs, queries
from strata.llm.bytepairs import BytePairs, automaton, byte_digests, decode_bytes, encode_bytes, read_ranks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = st.text(st.sampled_from("aeinorstlvmd  \n\t'.,-!0129éßñΣſ日☃  ▁<|s>\x1c\x85²Ⅷ\U0001e5d0"), max_size=60)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(RANKS, encoding="ascii") as file:
        return BytePairs(read_ranks(file.read()))


def split(flat, counts):
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


def test_compositions_are_closed_and_associative():
    functions, element, product, _ = automaton()
    assert len({tuple(f) for f in functions}) == len(functions) < 1000
    rng = random.Random(1)
    for _ in range(200):
        f, g, h = (rng.randrange(len(functions)) for _ in range(3))
        assert (functions[product[f, g]] == functions[g][functions[f]]).all()
        assert product[product[f, g], h] == product[f, product[g, h]]
    assert len(element) == 16


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXTS, max_size=8))
def test_ids_are_the_librarys(library, coder, texts):
    ids, counts = coder.encode(pa.array(texts, pa.string()))
    assert split(ids, counts)[: len(texts)] == [library.encode_ordinary(t) for t in texts]
    data, offsets = coder.decode(ids.astype(np.int64), counts)
    assert [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:])] == texts


def test_every_codepoint(library, coder):
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    between = " ".join(text[k] for k in range(0, len(text), 97))
    ids, counts = coder.encode(pa.array([text, None, between]))
    assert split(ids, counts) == [library.encode_ordinary(text), [], library.encode_ordinary(between)]


def test_long_texts_cost_in_proportion(library, coder):
    rng = random.Random(2)
    for text in ("x" * 200_000, " " * 200_000, "\n " * 100_000, "".join(rng.choices("abcdefgh", k=100_000))):
        began = time.process_time()
        ids, _ = coder.encode(pa.array([text]))
        assert time.process_time() - began < 10
        assert ids.tolist() == library.encode_ordinary(text)


def test_long_texts_are_cut_without_a_trace(library, coder, monkeypatch):
    monkeypatch.setattr(bytepairs, "CHUNK", 64)
    rng = random.Random(3)
    words = ["a", "don't", "it'll", "  ", "\n", " \t", "'", "s", "naïve", "日本", "12", "?!", " "]
    texts = ["", "x" * 500, *("".join(rng.choices(words, k=400)) for _ in range(40)), ""]
    ids, counts = coder.encode(pa.array(texts))
    assert split(ids, counts) == [library.encode_ordinary(t) for t in texts]


def test_forgotten_slices_are_merged_again(library, monkeypatch, coder):
    small = BytePairs(coder.ranks)
    small.table.limit = 10
    for seed in range(5):
        text = " ".join(f"w{random.Random(seed + k).randrange(90)}" for k in range(60))
        assert small.encode(pa.array([text]))[0].tolist() == library.encode_ordinary(text)


def test_odd_rows_round_trip(spark, library):
    source = docs(spark, ODD)
    encoded = encode_bytes(source, RANKS)
    rows = encoded.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"]) for r in rows) == sorted(
        (i is None, i or 0, library.encode_ordinary(t or "")) for i, t in ODD
    )
    for r in rows:
        parts = library.decode_tokens_bytes(r["ids"])
        assert r["offsets"] == [sum(map(len, parts[:k])) for k in range(len(parts))] if len(parts) < 500 else True
    decoded = decode_bytes(encoded, RANKS)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["decoded"])) for r in decoded.collect())
    assert got == sorted((i is None, i or 0, (t or "").encode()) for i, t in ODD)


def test_odd_ids_decode_to_nothing(spark):
    encoded = spark.createDataFrame([(1, [64, None, -5, 10**6, 64]), (2, None), (3, [])], "doc_id long, ids array<int>")
    first = {r["doc_id"]: bytes(r["decoded"]) for r in decode_bytes(encoded, RANKS).collect()}
    assert first[2] == first[3] == b"" and len(first[1]) == 2


def test_empty_table(spark):
    assert byte_digests(docs(spark, []), RANKS).count() == 0
    assert encode_bytes(docs(spark, []), RANKS).count() == 0


def test_query_against_the_library(spark, library):
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in texts:
        ids = library.encode_ordinary(r["text"] or "")
        want.append(
            {
                "doc_id": r["doc_id"],
                "n_tokens": len(ids),
                "ids_sha256": hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                "decoded_sha256": hashlib.sha256((r["text"] or "").encode()).hexdigest(),
            }
        )
    assert result(queries.QUERIES["op13_byte_bpe"](spark, SF)) == sorted(want, key=lambda r: r["doc_id"])
