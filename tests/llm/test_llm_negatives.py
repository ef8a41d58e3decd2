"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from compare import oracle, problems
from corpus_cases import SF
from pyspark.sql import functions as F

from strata.llm import negatives as module
from strata.llm import oracle as sql
from strata.llm import queries, topk
from strata.llm.negatives import hard_negatives

CLASHING = ["id", "anchor", "score", "slot", "part", "size", "ids", "vector", "other", "limits"]


def usable(rows):
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            yield i, tuple(math.floor(256 * x) for x in v), label


def expected(rows, every, positives, negatives, low=30, high=90):
    whole = list(usable(rows))
    anchors = {}
    for i, v, label in whole:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted(
            (-max(min(sum(x * y for x, y in zip(v, w)), 2**63 - 1), -(2**63)), i, other)
            for i, w, other in whole
            if i != a and len(w) == len(v)
        )
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            inside = [(n, i) for n, i, other in scored if other != label and low * -s <= 100 * -n <= high * -s]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(inside[:negatives])]
    return sorted(out)


def mined(spark, rows, every=4, positives=5, negatives=10, parts=3, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in CLASHING:
        df = df.withColumn(name, F.lit(f"own {name}"))
    got = hard_negatives(df.repartition(parts), F.col("vec_id") % every == 0, positives, negatives, **more)
    return sorted(tuple(r) for r in got.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(k, [float(rng.randrange(-2, 4)) for _ in range(5)], rng.randrange(4)) for k in range(160)]
    out += [(200, None, 1), (204, [1.0, None, 2.0, 3.0, 0.0], 1), (208, [float("nan")] * 5, 1), (212, [1.0] * 5, None)]
    out += [(216, [float("inf")] * 5, 1), (None, [3.0] * 5, 1), (-4, [2.0] * 5, 0), (220, [1.0, 2.0], 2), (221, [2.0, 2.0], 2)]
    out += [(222, [1.0, 1.0], 3), (224, [], 1), (225, [], 1), (226, [], 2), (228, [9.0] * 3, 0), (232, [0.0] * 5, 2)]
    return out + [out[8], out[9], (12, out[13][1], 3)]  # an anchor and others repeated, an id of two rows


@pytest.mark.parametrize("positives, negatives", [(5, 10), (1, 1), (3, 200)])
def test_with_ties_nulls_and_repeats(spark, rows, positives, negatives):
    assert mined(spark, rows, 4, positives, negatives) == expected(rows, 4, positives, negatives)


@pytest.mark.parametrize("low, high", [(0, 100), (50, 50), (90, 30), (100, 130)])
def test_any_window(spark, rows, low, high):
    assert mined(spark, rows, low=low, high=high) == expected(rows, 4, 5, 10, low, high)


def test_small_tiles_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(module, "TILE", 7)
    assert mined(spark, rows, parts=1) == expected(rows, 4, 5, 10)


def test_one_label_holds_most_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=6).tolist(), 0 if k % 10 else k % 3) for k in range(300)]
    assert mined(spark, rows, 10) == expected(rows, 10, 5, 10)


@pytest.mark.parametrize("size", [1e3, 1e8, 1e13])
def test_scores_are_exact_at_every_size(spark, size):
    rng = random.Random(2)
    rows = [(k, [rng.uniform(0, size) for _ in range(3)], k % 3) for k in range(40)]
    assert mined(spark, rows) == expected(rows, 4, 5, 10)


def test_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []  # no positive
    assert mined(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []  # a positive below zero


@pytest.mark.parametrize("positives, negatives", [(5, 10), (2, 1)])
def test_blocks_give_the_same(spark, rows, monkeypatch, positives, negatives):
    monkeypatch.setattr(topk, "BLOCK", 64 * 9)
    monkeypatch.setattr(topk, "SHARE", 3)
    monkeypatch.setattr(module, "TILE", 5)
    rows = rows + [(k, rows[1][1], k % 3) for k in range(300, 330)] + [(k, [2e5] * 5, k % 2) for k in range(400, 410)]
    rows += [(500, [1.0] * 4, 2**63 - 1), (501, [1.0] * 4, 2**63 - 1), (502, [0.5] * 4, -(2**63))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").repartition(3)
    got = hard_negatives(df, F.col("vec_id") % 2 == 0, positives, negatives)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 2, positives, negatives)


def test_anchors_are_not_copied_for_every_partition(spark, conf):
    """A tile of anchors has 128 KB; a copy of it for each of two partitions of a shuffle was over 2 GB here."""
    x = np.abs(np.random.default_rng(5).normal(size=(1024, 64)))
    rows = [(k, v, k % 3) for k, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").coalesce(1).cache()
    want = sorted(hard_negatives(df, F.col("vec_id") >= 0, scale=4096).collect())
    conf("spark.sql.shuffle.partitions", "8000")
    assert sorted(hard_negatives(df, F.col("vec_id") >= 0, scale=4096).collect()) == want
    assert len(want) == 50 * 1024


def test_query(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        assert problems(queries.QUERIES["op11_hard_negatives"](spark, sf), oracle(sf), sql.ORACLE["op11_hard_negatives"]) is None
