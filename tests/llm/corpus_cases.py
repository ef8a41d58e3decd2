"""Small tables with every odd row: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that the operators use inside, as further columns.
CLASHING = ["id", "_id", "_text", "_row", "n_tokens", "score", "class", "bucket", "component", "later", "row", "place"]

ODD = [
    (None, None),
    (None, "a row without an id"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "Two words"),
    (6, "same row twice here"),
    (6, "same row twice here"),
    (7, "one id\nwith"),
    (7, "two texts  of  odd   space "),
    (8, "snow☃man 日本語 naïve space <|endoftext|> <s> ▁mark"),
    (-9, "a negative id"),
    (10, "x" * 200_000),
    (11, "long " * 30_000),
]


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def docs(spark: SparkSession, rows: list[tuple], clash: bool = True) -> DataFrame:
    """A table of documents, with clashing columns."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in CLASHING if clash else ():
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def result(df: DataFrame, key: str = "doc_id") -> list[dict]:
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is None, r[key] or 0, repr(r)))
