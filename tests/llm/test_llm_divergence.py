"""Divergence of sources against plain counting, and its packed counts against a dictionary."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import oracle, problems
from corpus_cases import CLASHING, ODD, SF, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import divergence as module
from strata.llm import oracle as sql
from strata.llm import queries
from strata.llm.divergence import count_runs, count_terms, divergence, radix_order, terms_of
from strata.llm.words import text_bytes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def expected(rows, least, top):
    """(lang, source, part, item, value, rank) by plain arithmetic."""
    count, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        count[lang, source].update(terms(text))
        held[lang].update(set(terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])

        def share(n, total):
            return 1 + 1_000_000_000 * (n + 5) // (total + 5 * len(kept))

        totals = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(count[lang, s][t], totals[s]) for t in kept} for s in sources}
        q = {t: share(whole[t], sum(whole[t] for t in kept)) for t in kept}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            marks = [(q[t] - p[s][t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", marks)):
                ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))
                ranked = ranked if part == "pair" else ranked[:top]
                out += [(lang, s, part, i, -v, k + 1) for k, (v, i) in enumerate(ranked)]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    for name in [*CLASHING, "term", "n", "docs", "share", "block", "slice"]:
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@settings(max_examples=100, deadline=None)
@given(
    texts=st.lists(
        st.lists(st.sampled_from(["a", "B", "é", "abcdefgh", "abcdefghi", "x" * 16, "y" * 17, "日本語日本語", "A1b", "\0", "'"]), max_size=9),
        max_size=6,
    )
)
def test_packed_counts(texts):
    texts = [" ".join(t) for t in texts]
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    starts, ends = terms_of(data, offsets)
    doc = np.searchsorted(offsets, starts, "right") - 1
    group = doc % 2
    at, n, docs = count_runs(data, starts, ends, doc, group)
    raw = data.tobytes()
    got = {(int(group[k]), raw[starts[k] : ends[k]].decode()): (int(a), int(b)) for k, a, b in zip(at, n, docs)}
    count, held = Counter(), Counter()
    for k, t in enumerate(texts):
        count.update((k % 2, x) for x in TERM.findall(t))
        held.update({(k % 2, x) for x in TERM.findall(t)})
    assert got == {x: (count[x], held[x]) for x in count} and len(at) == len(got)


def test_radix_order_is_the_stable_order():
    rng = np.random.default_rng(1)
    low, high = rng.integers(0, 2**64, 500, np.uint64), rng.integers(0, 3, 500).astype(np.uint64)
    low[::7] = low[0]
    assert (radix_order([low, high]) == np.lexsort([low, high])).all()


@pytest.fixture(scope="module")
def rows():
    out = [(t, "en", "odd") for _, t in ODD] + [(None, None, None), ("Only Here", None, "x"), ("no kept term", "zz", "a"), ("other", "zz", "b")]
    out += [("", "qq", "alone")]
    words = "alpha Beta GAMMA été naïve d'accord internationalisation Donaudampfschifffahrtsgesellschaft x1y".split()
    for k in range(120):
        lang = ("en", "de", "")[k % 3 if k % 5 else 0]
        text = " ".join(words[(k * j) % len(words)] for j in range(k % 11)) + " " + prose(k, 5, 30).replace("w", "wort")
        out.append((text.replace("0", "o").replace("1", "i"), lang, f"s{k % 7}"))
    return out


@pytest.mark.parametrize("least, top", [(1, 50), (4, 3), (30, 50)])
def test_against_plain_counting(spark, rows, least, top):
    assert found(divergence(table(spark, rows), least, top)) == expected(rows, least, top)


def test_many_tiles_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(module, "TILE_TERMS", 3)
    monkeypatch.setattr(module, "TILE_SOURCES", 2)
    assert found(divergence(table(spark, rows).repartition(5), 2)) == expected(rows, 2, 50)


def test_counts_and_groups(spark, rows):
    got = {(r["lang"], r["source"], r["term"]): (r["n"], r["docs"]) for r in count_terms(table(spark, rows)).collect()}
    assert got["", "", ""] == (0, 1) and got["qq", "alone", ""] == (0, 1)
    assert got["en", "odd", ""] == (0, len(ODD)) and got["en", "odd", "long"] == (30_000, 1)
    assert got["en", "odd", "x" * 200_000] == (1, 1)


def test_empty_table_and_one_source(spark):
    assert divergence(table(spark, [])).count() == 0
    assert found(divergence(table(spark, [("a b", "en", "s")] * 3), 2)) == []


def test_query(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        assert problems(queries.QUERIES["op12_source_divergence"](spark, sf), oracle(sf), sql.ORACLE["op12_source_divergence"]) is None
