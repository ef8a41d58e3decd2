"""A corpus pipeline of five stages over ``documents``.

Each stage takes the rows its predecessor kept, has them judged by one operator, and lets that take effect:
toxic documents go, one document of each group of near copies stays, passages that occurred earlier are
cut out, documents with benchmark passages go, and what is left is encoded in pieces.  Rows without an id
or text are kept by the filtering stages: nothing is known against them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.classify import THRESHOLD, train
from strata.llm.components import stored
from strata.llm.compression import score
from strata.llm.leaks import find_leaks
from strata.llm.neardup import near_duplicates
from strata.llm.pieces import decode_pieces, encode_pieces
from strata.llm.substrings import remove_repeats
from strata.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE = 5
PERCENT = 80
FOLDS, FOLD = 4, 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _packed(docs: DataFrame) -> DataFrame:
    """Rows as one struct beside id and text, so that no column's name can clash with a stage's own."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(row, F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic; the model learns from the labels of the held-in folds.

    Null and empty texts stay, and so does every document where the labels are of one class only or absent: then
    nothing tells a toxic text from another.
    """
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = train(docs.select("doc_id", "text"), labels, "toxic", folds=FOLDS, fold=FOLD)
    if not any(model.contents):
        return docs
    packed = _packed(docs).select("_row", "_text")
    scored = score(packed, model, ["_row"], "_text")
    empty = F.coalesce(F.length("_row.text") == 0, F.lit(True))
    return scored.where(empty | (F.col("score") < THRESHOLD)).select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the smallest id; of rows that repeat an id and its text, one.

    Texts that share an id are one document to the operator; each of them is kept with it.
    """
    judged = near_duplicates(docs.select("doc_id", "text"), shingle=SHINGLE, percent=PERCENT)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("_id")).distinct()
    kept = _packed(docs).join(gone, "_id", "left_anti")
    several = kept.groupBy("_id").agg(F.count("*").alias("_n")).where("_n > 1 and _id is not null").select("_id")
    repeated = kept.join(several, "_id").withColumn("_hash", F.xxhash64("_text")).dropDuplicates(["_id", "_hash"])
    single = kept.join(several, "_id", "left_anti")
    return single.select("_row.*").unionByName(repeated.select("_row.*"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of 20 words or more that start earlier; ``n_chars`` follows a text that changed."""
    cut = remove_repeats(docs)
    changed = F.col("n_removed") > 0
    columns = []
    for field in docs.schema:
        value = F.col("row").getField(field.name)
        if field.name == "text":
            value = F.when(changed, F.col("kept_text")).otherwise(value)
        elif field.name == "n_chars":
            value = F.when(changed, F.length("kept_text").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return cut.select(*columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    found = find_leaks(docs.select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return _packed(docs).join(found.select(F.col("doc_id").alias("_id")).distinct(), "_id", "left_anti").select("_row.*")


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces, and the text that they decode to.

    The pieces are stored in between: a task that encodes and decodes in one go holds two Python workers.
    """
    model = public_tokenizers.path("piece_bpe_32k.model")
    pieces, _ = stored(encode_pieces(docs.select("doc_id", "text"), model), "pieces")
    return decode_pieces(pieces, model)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("sentencepiece", to_pieces),
]

#: A trained classifier and a byte-pair tokenizer can't be stated in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
