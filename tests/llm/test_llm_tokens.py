"""Token counts, token files and pieces against the libraries themselves."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from corpus_cases import ODD, SF, docs, result
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import queries
from strata.llm.pieces import Lattice, Model, PieceEncoder, decode, decode_pieces, encode_pieces
from strata.llm.tokenfiles import BLOCK, Encoder, pack, read_token_files, unpack, write_token_files
from strata.llm.tokens import TokenCounter, count_tokens
from strata.session import scratch_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = st.text(st.sampled_from("aeinorst  \n\t'.,-!0129éßñΣſ日☃  ▁<|s>\x1c\x85"), max_size=60)


@pytest.fixture(scope="module")
def libraries():
    return {p: Tokenizer.from_file(p) for p in (WORDS, BYTES)}


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def counter():
    import json

    with open(WORDS, encoding="utf-8") as file:
        return TokenCounter(json.load(file))


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXTS, max_size=5))
def test_counts_follow_the_library(counter, libraries, texts):
    assert counter.counts(texts) == [len(ids_of(libraries[WORDS], t)) for t in texts]


def test_count_tokens_on_odd_rows(spark, libraries):
    got = result(count_tokens(docs(spark, ODD), WORDS, limit=3))
    want = [
        {"doc_id": i, "n_bytes": len((t or "").encode()), "n_tokens": n, "over_limit": n > 3}
        for i, t in ODD
        for n in [len(ids_of(libraries[WORDS], t))]
    ]
    assert got == sorted(want, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, repr(r)))


def test_empty_tables(spark):
    none = docs(spark, [])
    assert count_tokens(none, WORDS).count() == 0
    assert encode_pieces(none, PIECES).count() == 0
    path = scratch_dir(spark, "none")
    write_token_files(none, path, BYTES)
    assert read_token_files(spark, path).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=900))
def test_packed_words_come_back(ids):
    ids = np.array(ids, np.uint64)
    packed, offsets = pack(ids)
    assert (unpack(packed, offsets) == ids).all()
    assert len(offsets) == -(-len(ids) // BLOCK)
    if len(offsets) > 1:  # blocks decode alone
        assert (unpack(packed[offsets[1] :], offsets[1:] - offsets[1]) == ids[BLOCK:]).all()


def test_small_ids_share_words():
    assert len(pack(np.zeros(240, np.uint64))[0]) == 4
    assert len(pack(np.full(240, 30_000, np.uint64))[0]) == 60


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXTS, min_size=1, max_size=5))
def test_encoder_follows_the_library(encoder, libraries, texts):
    ids, lengths = encoder.encode(pa.array(texts))
    want = [[*ids_of(libraries[BYTES], t), 0] for t in texts]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.fixture(scope="module")
def encoder():
    with open(BYTES, encoding="utf-8") as file:
        return Encoder(file.read(), 0)


def expected_files(rows, tokenizer):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out, start = [], 0
    for i, t in rows:
        ids = [*ids_of(tokenizer, t), 0]
        out.append((i, start, ids))
        start += len(ids)
    return out


def test_token_files_on_odd_rows(spark, libraries):
    path = scratch_dir(spark, "files")
    write_token_files(docs(spark, ODD).repartition(3), path, BYTES)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids"]) for r in read_token_files(spark, path).collect())
    want = [(s, i, len(ids), ids) for i, s, ids in expected_files(ODD, libraries[BYTES])]
    assert [(g[0], g[1], g[2]) for g in got] == [(w[0], w[1], w[2]) for w in want]
    assert [g[3] for g in got] == [w[3] for w in want]


def test_op9_query(spark, libraries):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = expected_files([tuple(r) for r in table.collect()], libraries[BYTES])
    got = result(queries.QUERIES["op9_token_files"](spark, SF))
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == [
        (i, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, s, ids in want
    ]


def test_op4_query(spark, libraries):
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = result(queries.QUERIES["op4_token_counts"](spark, SF))
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(ids_of(libraries[WORDS], t)) for i, t in table.items()}


@pytest.fixture(scope="module")
def pieces():
    with open(PIECES, "rb") as file:
        model = Model(file.read())
    return PieceEncoder(Lattice(model), model), sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(TEXTS, min_size=1, max_size=5))
def test_pieces_follow_the_library(pieces, texts):
    encoder, library = pieces
    ids, lengths = encoder.encode(pa.array(texts))
    first = np.append(0, np.cumsum(lengths))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == library.encode(texts)
    assert decode(encoder.lattice, ids.astype(np.int64), first) == [library.decode(i) for i in library.encode(texts)]


def test_pieces_on_odd_rows(spark, pieces):
    library = pieces[1]
    table = encode_pieces(docs(spark, ODD), PIECES)
    got = sorted((repr(r["doc_id"]), list(r["ids"]), r["n_tokens"]) for r in table.collect())
    assert got == sorted((repr(i), e, len(e)) for i, t in ODD for e in [library.encode(t or "")])
    back = sorted((repr(r["doc_id"]), r["text"]) for r in decode_pieces(table, PIECES).collect())
    assert back == sorted((repr(i), (t or "").replace("▁", " ")) for i, t in ODD)


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [6312])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in decode_pieces(rows, PIECES).collect()}
    assert got[1] is None and got[2] == "" and got[3]


def test_op5_query(spark, pieces):
    library = pieces[1]
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op5_pieces"](spark, SF).collect():
        ids = library.encode(table[r["doc_id"]])
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r["round_trip"]


def test_long_words_cost_in_proportion(libraries, counter):
    import random
    import time

    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for size in (999, 1000, 1001, 5000, 100_000):
        word = "".join(rng.choices(letters, k=size))
        began = time.process_time()
        assert counter.counts([word, "ab" * size, "éß日" * 400]) == [
            len(ids_of(libraries[WORDS], t)) for t in (word, "ab" * size, "éß日" * 400)
        ]
        assert time.process_time() - began < 10


def test_runs_of_spaces_are_the_librarys(pieces):
    encoder, pieces_library = pieces
    texts = [" " * n for n in range(70)] + ["a" + " " * n + "b c" for n in range(40)] + [" " * 4000, "word  " * 500, "日   x " * 50]
    for text in texts:
        assert encoder.whole(text).tolist() == pieces_library.encode(text)


def test_long_runs_of_spaces_cost_in_proportion(pieces):
    import time

    encoder, _ = pieces
    began = time.process_time()
    assert len(encoder.whole(" " * 500_000)) > 10_000 and len(encoder.whole("word  " * 50_000)) >= 100_000
    assert time.process_time() - began < 10


def test_a_worker_holds_one_copy_of_a_piece_model(spark, tmp_path):
    """Encoding and decoding send the model each; the copy that comes second is not read, whatever its path."""
    from strata.llm.pieces import _encoder, _shared

    path = tmp_path / "a.model"
    with open(PIECES, "rb") as file:
        path.write_bytes(file.read())
    (one, sent), (same, again) = (_shared(docs(spark, ODD), p) for p in (PIECES, str(path)))
    assert _encoder(one, sent) is _encoder(same, again)
