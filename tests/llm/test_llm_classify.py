"""Scores of texts: what may be learned, odd rows, and accuracy on rows whose labels were held out."""

import random
import zlib

import pytest
from corpus_cases import ODD, docs, prose
from pyspark.sql import functions as F

from strata.llm import queries
from strata.llm.classify import THRESHOLD, classify, held_out, train
from strata.llm.compression import Settings, fit

SMALL = Settings(per_class=400_000, ratios=(5.0,), deviations=(4.0,))


def text(k, bad):
    rng = random.Random(k)
    w = prose(k, 150).split()
    for _ in range(15 if bad else 0):
        w.insert(rng.randrange(len(w)), rng.choice(["grimblefuss", "scrofnag", "trundlewort"]))
    return " ".join(w)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, text(k, k % 3 == 0)) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)], "doc_id long, toxic int")
    return train(docs(spark, rows), labels, "toxic", 4, 2, SMALL)


def test_new_texts_are_told_apart(spark, model):
    rows = [(k, text(k, k % 2 == 0)) for k in range(1000, 1100)]
    got = {r["doc_id"]: r for r in classify(docs(spark, rows), model, 4, 2).collect()}
    assert sum((r["predicted"] == 1) == (k % 2 == 0) for k, r in got.items()) >= 98
    for k, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= THRESHOLD)


def test_odd_rows(spark, model):
    got = classify(docs(spark, ODD), model, 4, 2).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    empty = [r["score"] for r, in zip(got) if r["doc_id"] in (1, 2)]
    assert empty == [model.empty] * 2
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert classify(docs(spark, []), model, 4, 2).count() == 0


def test_held_out_labels_are_not_learned(spark, model):
    """Labels of the held-out fold may say anything."""
    rows = docs(spark, [(k, text(k, k % 3 == 0)) for k in range(400)])
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(400)], "doc_id long, toxic int")
    other = labels.withColumn("toxic", F.when(held_out("doc_id", 4, 2), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert train(rows, other, "toxic", 4, 2, SMALL) == model


def test_contradictions_nulls_and_repeats_in_labels(spark, model):
    rows = docs(spark, [(k, text(k, k % 3 == 0)) for k in range(400)])
    labels = [(k, int(k % 3 == 0)) for k in range(400)]
    odd = [(None, 1), (5000, 1), (7000, None), (8000, 7)] + [r for r in labels if r[0] < 50]
    frame = spark.createDataFrame(labels + odd, "doc_id long, toxic int")
    assert train(rows, frame, "toxic", 4, 2, SMALL) == model


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(k, 1) for k in range(30)]])
def test_without_both_classes_the_share_is_the_score(spark, labels):
    rows = docs(spark, [(k, text(k, False)) for k in range(30)])
    model = train(rows, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic", 4, 2, SMALL)
    scores = {r["score"] for r in classify(rows, model, 4, 2).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


def test_fit_does_not_depend_on_the_order_of_rows():
    sample = sorted((k % 3 == 0, text(k, k % 3 == 0).encode()) for k in range(100))
    assert fit(sample, 0.3, SMALL, "quality") == fit(list(sample), 0.3, SMALL, "quality")


@pytest.mark.parametrize("query, label, least", [("op2_toxicity", "toxic", 0.8), ("op6_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    sf = "/root/testdata/sf0.1"
    scored = queries.QUERIES[query](spark, sf).where("held_out")
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("score", label).collect()
    good = sorted(r["score"] for r in rows if r[label] == 1)
    bad = sorted(r["score"] for r in rows if r[label] == 0)
    area = sum(sum(b < g for b in bad) + sum(b == g for b in bad) / 2 for g in good) / (len(good) * len(bad))
    assert area > least
