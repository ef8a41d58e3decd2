"""Removal of word sequences that also start earlier in the corpus, by level-wise doubling.

A window is ``length`` consecutive words of one text.  Levels are half that length and the length
itself: a window of full length can be repeated only if the window of half its length that it owns is.
Each full window owns the half window with the lowest hash among those inside it, so equal full
windows own equal half windows, and only about every sixth half window is owned and needs counting.
Where no half window is repeated, the second level has no candidates and nothing is dealt out.

Rows shuffled are hashes with ids, reduced on the map side, so that a passage shared by a third of
all documents is one row per task.  Texts are dealt out by id, never by content.

What counts as earlier: a smaller id, or an earlier start in the same row.  Rows that share an id are not
ordered among each other.  Rows without an id come after all others, by the hash of their text.
Hashes of full windows have 128 bits; no two different windows are expected to meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import Words, chunks, mix, ragged, windows
from strata.session import scratch_dir

LENGTH = 20
#: Ids of rows that have none begin here.
NO_ID = 1 << 62


def _ids(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Shifting keeps the stand-in of a missing id above every usual one and positive.
    stand_in = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text), 2)
    return [F.coalesce(F.col(id_col).cast("long"), stand_in).alias("_id"), text.alias("_text")]


def owned(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: whether a full window starts there, the half window it owns, and the half windows' hashes."""
    half = length // 2
    halves = windows(words.hashes(), half)
    place = np.arange(len(halves))
    reach, lowest = 1, place
    while reach < length - half + 1:
        step = min(reach, length - half + 1 - reach)
        other = np.append(lowest[step:], lowest[len(lowest) - min(step, len(lowest)) :])
        lowest = np.where(halves[other] < halves[lowest], other, lowest)
        reach += step
    return words.fits(length), lowest, halves


def _half_windows(length: int):
    """Owned half windows: hash, id, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            words = Words(batch.column("_text"))
            full, lowest, halves = owned(words, length)
            at = np.unique(lowest[full])
            doc = words.doc()[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(halves[at].view(np.int64)),
                    batch.column("_id").take(pa.array(doc)),
                    pa.array((at - words.first[doc]).astype(np.int32)),
                ],
                names=["half", "_id", "place"],
            )

    return run


class _Candidates:
    """The full windows of a chunk of texts that may be repeated: first ones in their text, and all."""

    def __init__(self, batch: pa.RecordBatch, length: int):
        self.words = words = Words(batch.column("_text"))
        full, lowest, _ = owned(words, length)
        doc = words.doc()
        single = np.zeros(len(words), bool)
        places, first = ragged(batch.column("singles"))
        single[np.repeat(words.first[:-1], np.diff(first)) + places] = True
        shared = np.asarray(batch.column("shared").fill_null(False))
        self.full = full
        self.at = np.flatnonzero(full & (~single[lowest] | shared[doc]))
        self.doc = doc[self.at]
        self.hashes = windows(words.hashes(), length)[self.at]
        key = self.hashes ^ mix(self.doc.astype(np.uint64))
        self.firsts = np.unique(key, return_index=True)[1]


def _full_windows(length: int):
    """The first occurrence in its text of each candidate: hash, second hash, id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            # Every window of a later copy of a whole text is repeated; the first copy has them all.
            batch = batch.filter(pa.compute.invert(batch.column("later").fill_null(False)))
            if not batch.num_rows:
                continue
            found = _Candidates(batch, length)
            check = windows(found.words.hashes(1), length, 1)[found.at][found.firsts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.hashes[found.firsts].view(np.int64)),
                    pa.array(check.view(np.int64)),
                    batch.column("_id").take(pa.array(found.doc[found.firsts])),
                ],
                names=["hash", "check", "_id"],
            )

    return run


def _remove(length: int):
    """Each text without its repeated windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "_text"):
            found = _Candidates(batch, length)
            words = found.words
            later = np.asarray(batch.column("later").fill_null(False))
            earliest, first = ragged(batch.column("earliest"))
            # Windows that start nowhere earlier, as (text, hash); in a text only the first of a hash is kept.
            keys = earliest.view(np.uint64) ^ mix(np.repeat(np.arange(batch.num_rows), np.diff(first)).astype(np.uint64))
            own = found.hashes ^ mix(found.doc.astype(np.uint64))
            kept = np.zeros(len(found.at), bool)
            kept[found.firsts] = np.isin(own[found.firsts], keys)
            repeated = np.zeros(len(words) + 1, np.int32)
            repeated[found.at[~kept]] = 1
            repeated[:-1][found.full & later[words.doc()]] = 1
            # A word is covered where a repeated window began at it or in the length - 1 words before it.
            begun = np.append(0, np.cumsum(repeated))
            place = np.arange(len(words))
            covered = begun[place + 1] > begun[np.maximum(place - length + 1, 0)]
            texts, removed, spans, digests = [], [], [], []
            data = words.data.tobytes()
            original = batch.column("_text")
            for k in range(batch.num_rows):
                a, b = words.first[k], words.first[k + 1]
                gone = covered[a:b]
                n = int(gone.sum())
                stay = (np.flatnonzero(~gone) + a) if n else np.arange(a, b)
                text = b" ".join([data[i:j] for i, j in zip(words.starts[stay].tolist(), words.ends[stay].tolist())])
                digests.append(hashlib.sha256(text).hexdigest())
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans.append(edges.astype(np.int32))
                removed.append(n)
                texts.append(text.decode() if n else original[k].as_py())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.int32())),
                    pa.array(digests, pa.string()),
                    pa.array(texts, batch.schema.field("_text").type),
                ],
                names=["_row", "n_words", "n_removed", "spans", "kept_sha256", "kept_text"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row of ``docs`` as a struct ``row`` and what is left of its text.

    Columns: ``row``, ``n_words``, ``n_removed``, ``spans`` (begin and end words of the parts removed, in turn),
    ``kept_text`` (the text as it is where nothing is removed, else the kept words joined by one space) and
    ``kept_sha256`` (of the kept words joined by one space).  Words are runs of characters other than ASCII white
    space.  A word is removed if a window that covers it also starts earlier; windows are those of
    the input.  A null or empty text has no words and stays as it is, as does one of fewer words than ``length``.
    Rows repeated with their id are not earlier than each other, so both stay.  Columns of ``docs`` may have any
    names.  An empty table gives an empty result.
    """
    if length < 2:
        raise ValueError("a window has two words or more")
    spark = docs.sparkSession
    ids = docs.select(*_ids(id_col, text_col))

    # Whole texts: ids that stand for several texts, and texts that a smaller id has too.
    whole = ids.select("_id", F.xxhash64("_text").alias("a"), F.xxhash64(F.lit(1), "_text").alias("b"))
    earliest = whole.groupBy("a", "b").agg(F.min("_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = (
        whole.join(earliest, ["a", "b"], "left")
        .groupBy("_id")
        .agg(
            F.min(F.coalesce(F.col("_id") > F.col("first"), F.lit(False))).alias("later"),
            (F.min("a") != F.max("a")).alias("shared"),
        )
        .where("later or shared")
        .select("_id", "shared", (F.col("later") & ~F.col("shared")).alias("later"))
    )

    # Level 1: half windows that occur once.
    halves = ids.mapInArrow(_half_windows(length), "half long, _id long, place int")
    singles = (
        halves.groupBy("half")
        .agg(F.count("*").alias("n"), F.min("_id").alias("_id"), F.min("place").alias("place"))
        .where("n = 1")
        .groupBy("_id")
        .agg(F.sort_array(F.collect_list("place")).alias("singles"))
    )
    known_path = scratch_dir(spark, "half-windows")
    # Where an id has several texts the places of one say nothing of the others.
    known = copies.join(singles, "_id", "full").withColumn("singles", F.expr("if(shared, null, singles)"))
    known.write.parquet(known_path)
    known = spark.read.parquet(known_path)

    # Level 2: full windows that own a repeated half window, and where each starts first.
    found = ids.join(known, "_id", "left").mapInArrow(_full_windows(length), "hash long, check long, _id long")
    firsts = (
        found.groupBy("hash", "check")
        .agg(F.min("_id").alias("_id"))
        .groupBy("_id")
        .agg(F.collect_list("hash").alias("earliest"))
    )
    first_path = scratch_dir(spark, "full-windows")
    firsts.write.parquet(first_path)
    firsts = spark.read.parquet(first_path)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *_ids(id_col, text_col))
    kind = rows.schema["_row"].dataType.simpleString()
    return (
        rows.join(known, "_id", "left")
        .join(firsts, "_id", "left")
        .select("_row", "_text", "singles", "shared", "later", "earliest")
        .mapInArrow(
            _remove(length),
            f"_row {kind}, n_words long, n_removed long, spans array<int>, kept_sha256 string, kept_text string",
        )
        .withColumnRenamed("_row", "row")
    )
