"""Benchmark passages and nearest vectors against brute force."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from compare import oracle, problems
from corpus_cases import ODD, SF, docs, prose
from pyspark.sql import functions as F

from strata.llm import oracle as sql
from strata.llm import queries, topk
from strata.llm.leaks import EDITS, LEAST_WORDS, Items, _search, find_leaks, symbols
from strata.llm.topk import top_k


def distance(item, text):
    """Least edit distance of ``item`` to any run of ``text``."""
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for k, b in enumerate(text):
            new.append(min(row[k] + (a != b), row[k + 1] + 1, new[k] + 1))
        row = new
    return min(row)


def edit(w, n, rng):
    w = list(w)
    for _ in range(n):
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[at] = f"z{rng.randrange(10**6)}"
        elif kind == 1:
            w.insert(at, f"z{rng.randrange(10**6)}")
        else:
            del w[at]
    return w


@pytest.fixture(scope="module")
def items():
    return [(k, prose(5000 + k, 12 + 3 * k, 3000)) for k in range(16)]


def item_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("item", F.lit("own"))


def test_planted_passages_are_found_and_nothing_else(spark, items):
    rng = random.Random(3)
    rows, planted = [], set()
    for k in range(160):
        body = prose(k, rng.randrange(0, 300), 3000).split()
        if k % 2:
            i, item = items[rng.randrange(len(items))]
            w = edit(item.split(), int(rng.choice([0, 0.05, 0.1]) * len(item.split())), rng)
            if k % 3 == 0:
                w = [x.upper() + rng.choice(["", ",", "."]) for x in w]
            at = rng.randrange(len(body) + 1)
            body[at:at] = w
            planted.add((k, i))
        rows.append((k, " ".join(body)))
    found = find_leaks(docs(spark, rows), item_table(spark, items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    texts = dict(rows)
    for r in found:
        plain = [x.lower().strip(".,") for x in texts[r["doc_id"]].split()]
        own = dict(items)[r["item_id"]].split()
        assert r["distance"] == distance(own, plain)
        assert r["distance"] == distance(own, plain[r["start"] : r["end"]])


@pytest.mark.parametrize("part", [(0, 1), (0, 0.5), (0.5, 1)])
@pytest.mark.parametrize("size", [8, 15, 40, 55, 100, 200, 300, 500])
def test_every_passage_within_the_edit_limit_is_found(size, part):
    """As many edits as allowed, over the whole item or one half of it only."""
    rng = random.Random(size)
    texts = [prose(9000 + k, size, 3000) for k in range(20)]
    rows = []
    for k, text in enumerate(texts):
        w = text.split()
        low, high = int(part[0] * size), int(part[1] * size)
        w[low:high] = edit(w[low:high], int(0.15 * size), rng)
        around = prose(k, 200, 3000).split()
        rows.append(" ".join(around[:101] + w + around[101:]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(rows)], names=["id", "text"])
    search = _search(SimpleNamespace(value=(list(range(20)), texts)), None, EDITS)
    found = {(r["id"], r["item"]) for out in search(iter([batch])) for r in out.to_pylist()}
    assert found >= {(k, k) for k in range(20)}


@pytest.mark.parametrize("part", [(0, 1), (0, 0.5), (0.5, 1)])
@pytest.mark.parametrize("size", [15, 25, 40, 100, 200, 300, 500])
def test_recall_of_the_walks_alone(size, part):
    """The runs switched off, as many edits as allowed."""
    rng = random.Random(size)
    texts = [prose(9000 + k, size, 3000) for k in range(20)]
    rows = []
    for k, text in enumerate(texts):
        w = text.split()
        low, high = int(part[0] * size), int(part[1] * size)
        w[low:high] = edit(w[low:high], int(EDITS * size), rng)
        around = prose(k, 200, 3000).split()
        rows.append(" ".join(around[:101] + w + around[101:]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(rows)], names=["id", "text"])
    search = _search(SimpleNamespace(value=(list(range(20)), texts)), None, EDITS, runs=False)
    found = {(r["id"], r["item"]) for out in search(iter([batch])) for r in out.to_pylist()}
    assert len(found & {(k, k) for k in range(20)}) >= 18


def search_one(item, text):
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([text])], names=["id", "text"])
    return [r for out in _search(SimpleNamespace(value=([7], [item])), None, EDITS)(iter([batch])) for r in out.to_pylist()]


@pytest.mark.parametrize("size", [401, 900])
def test_long_items_are_verified_in_bands(size):
    rng = random.Random(size)
    item = prose(1, size, 3000)
    for edits in (0, 3, 20, int(0.14 * size)):
        w = edit(item.split(), edits, rng)
        (got,) = search_one(item, " ".join(["q"] * 40 + w + ["q"] * 40))
        own = ["q"] * 40 + w + ["q"] * 40
        assert got["distance"] == distance(item.split(), own) <= edits
        assert got["distance"] == distance(item.split(), own[got["start"] : got["end"]])


def test_a_long_item_costs_in_proportion():
    import time

    item = prose(1, 8000, 3000)
    began = time.process_time()
    (got,) = search_one(item, item)
    assert (got["distance"], got["start"], got["end"]) == (0, 0, 8000)
    assert time.process_time() - began < 10


def test_short_items_are_found_whole(spark):
    rows = [(1, "we met the grey cat once"), (2, "the grey dog"), (3, "one two three FOUR five, six seven eight"), (4, "the  grey\ncat")]
    short = [(5, "the grey cat"), (6, "dog"), (7, "two three four five sax seven eight")]
    found = find_leaks(docs(spark, rows), item_table(spark, short)).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found} == {(1, 5, 0), (4, 5, 0), (2, 6, 0), (3, 7, 1)}
    assert find_leaks(docs(spark, rows), item_table(spark, short), least_words=8).count() == 0


def test_op7_query_against_all_places(spark):
    """Every item at every place of every document."""

    def plain(text):
        out = []
        for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).split():
            while len(w) > 1 and not (w[-1].isalnum() or ord(w[-1]) > 127):
                w = w[:-1]
            while len(w) > 1 and not (w[0].isalnum() or ord(w[0]) > 127):
                w = w[1:]
            out.append(hash(w))
        return np.array(out, np.int64)

    def least(item, text):
        column = np.arange(len(text) + 1)
        cost = np.zeros(len(text) + 1, np.int64)
        for word in item:
            new = cost + 1
            new[1:] = np.minimum(new[1:], cost[:-1] + (text != word))
            cost = np.minimum.accumulate(new - column) + column
        return int(cost.min())

    texts = [(r["doc_id"], plain(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        item = plain(r["text"])
        for doc, text in texts:
            # At least as many of the item's words must be there as the edits leave.
            if np.isin(item, text).sum() >= len(item) - int(EDITS * len(item)):
                d = least(item, text)
                if d <= int(EDITS * len(item)):
                    want[doc, r["item_id"]] = min(d, want.get((doc, r["item_id"]), d))
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in queries.QUERIES["op7_leaks"](spark, SF).collect()}
    assert got == want and want


def test_verification_is_the_edit_distance(items):
    rng = random.Random(9)
    block = Items([i for i, _ in items], [t for _, t in items], 2, 0.15)
    for _ in range(40):
        k = rng.randrange(len(items))
        w = edit(items[k][1].split(), rng.randrange(6), rng)
        around, values = symbols(pa.array([" ".join(["q"] * 30 + w + ["q"] * 30)]))
        got, begins, ends = block.verify(around, values, np.array([[0, k, 30]]))
        limit, own = block.limits[k], symbols(pa.array([items[k][1]]))[1].tolist()
        low = 30 - limit
        near = values[low : 30 + len(own) + limit].tolist()
        assert got[0] == distance(own, near) == distance(own, values[begins[0] : ends[0]].tolist())


def test_leaks_of_odd_rows(spark, items):
    odd_items = items + [(None, "no id " * 10), (90, None), (91, ""), (92, "too short"), (0, items[0][1])]
    rows = ODD + [(None, items[2][1]), (30, items[3][1] + " x " + items[3][1]), (30, items[4][1])]
    found = find_leaks(docs(spark, rows), item_table(spark, odd_items)).collect()
    got = {(r["doc_id"], r["item_id"]): r["n_places"] for r in found}
    assert got == {(None, 2): 1, (30, 3): 2, (30, 4): 1}
    assert len("too short".split()) < LEAST_WORDS


def test_leaks_of_empty_tables(spark, items):
    assert find_leaks(docs(spark, []), item_table(spark, items)).count() == 0
    assert find_leaks(docs(spark, ODD), item_table(spark, [])).count() == 0


def test_op7_query_finds_every_exact_passage(spark):
    sf = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{sf}/documents.parquet").collect()
    passages = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = {(d["doc_id"], b["item_id"]) for d in texts for b in passages if b["text"] in d["text"]}
    found = queries.QUERIES["op7_leaks"](spark, sf).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["distance"] == 0} >= want
    words_of = {b["item_id"]: len(b["text"].split()) for b in passages}
    assert all(r["distance"] <= 0.15 * words_of[r["item_id"]] for r in found)


def expected_top(rows, every, k):
    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, [int(np.floor(256 * x)) for x in v]))
    out = []
    for q, a in {(i, tuple(v)) for i, v in whole if i % every == 0}:
        scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def top(spark, rows, every=3, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("own"))
    got = top_k(df.withColumn("size", F.lit(0)).repartition(3), F.col("vec_id") % every == 0, k)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())


def test_top_k_with_ties_nulls_and_repeats(spark):
    rng = random.Random(1)
    rows = [(k, [float(rng.randrange(-2, 3)) for _ in range(4)]) for k in range(80)]
    rows += [(90, None), (93, [1.0, None, 2.0, 3.0]), (96, [float("nan")] * 4), (99, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [1.0] * 4), (-3, [2.0] * 4), (200, [1.0, 2.0]), (201, [3.0, 1.0]), (204, []), (207, [])]
    rows += [(7, rows[7][1]), (9, rows[9][1])]  # repeated rows: a candidate and a query
    assert top(spark, rows) == expected_top(rows, 3, 5)


@pytest.mark.parametrize("size", [1.0, 1e3, 1e8, 1e13])
def test_scores_are_exact_at_every_size(spark, size):
    rng = random.Random(2)
    limit = 2**63 - 1
    rows = [(k, [rng.uniform(-size, size) for _ in range(3)]) for k in range(30)]
    want = [(q, n, i, max(min(s, limit), -limit - 1)) for q, n, i, s in expected_top(rows, 3, 5)]
    assert [r[3] for r in top(spark, rows)] == [r[3] for r in want]


def test_top_k_of_few_and_none(spark):
    assert top(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 256 * 512)]
    assert top(spark, [(0, [1.0])]) == []
    assert top(spark, []) == []


def test_blocks_and_small_tiles_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, [float(rng.randrange(-3, 4)) * (1 if k % 9 else 1e5) for _ in range(5)]) for k in range(150)]
    rows += [(k, rows[0][1]) for k in range(150, 180)] + [(180, [1.0, 2.0]), (182, [3.0, 1.0])]
    monkeypatch.setattr(topk, "BLOCK", 64 * 6)
    monkeypatch.setattr(topk, "TILE", 7)
    monkeypatch.setattr(topk, "SHARE", 3)
    assert top(spark, rows, 2) == expected_top(rows, 2, 5)
    assert top(spark, rows, 2, 1) == expected_top(rows, 2, 1)


def test_queries_are_not_copied_for_every_partition(spark, conf):
    """A tile of queries has 128 KB; a copy of it for each of two partitions of a shuffle was over 2 GB here."""
    x = np.random.default_rng(4).normal(size=(1024, 64))
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").coalesce(1).cache()
    want = sorted(top_k(df, F.col("vec_id") >= 0, scale=4096).collect())
    conf("spark.sql.shuffle.partitions", "8000")
    assert sorted(top_k(df, F.col("vec_id") >= 0, scale=4096).collect()) == want
    assert len(want) == 5 * 1024


def test_op8_query(spark):
    assert problems(queries.QUERIES["op8_top_k"](spark, SF), oracle(SF), sql.ORACLE["op8_top_k"]) is None
