"""Token ids in word-aligned binary files: Simple-8b words in blocks of 256 ids.

Format.  A 64-bit little-endian word holds a selector in its top four bits and, in the other 60, as many
ids of one width as fit, the first in the lowest bits:

    selector  1   2   3   4   5   6   7   8  9  10  11  12  13  14
    ids      60  30  20  15  12  10   8   7  6   5   4   3   2   1
    bits      1   2   3   4   5   6   7   8 10  12  15  20  30  60

Selector 15 is an escape: the word after it is one id of up to 64 bits as it is.  Selector 0 is not used.
A block is 256 ids of a segment (the last may have fewer) and begins a new word, so blocks decode
independently; their offsets are stored.  A segment is a row of a Parquet file: whole documents, in
order, with their ids and lengths.  Files are parts of the order: part, then place in the part.
Spark's writer commits each file once, whatever executors are lost.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.wordcode import UNSAFE, WordEncoder
from strata.llm.words import chunks, ragged

# Ids in a word and bits of each id, by selector.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0])
ESCAPE = 15
BLOCK = 256
_U = np.uint64

SEGMENT_BYTES = 1 << 19
MEMORY = 300_000
SEGMENTS = "part int, place int, doc_ids array<long>, lengths array<int>, block_offsets array<int>, payload binary"


def _widest(ids: np.ndarray) -> np.ndarray:
    most = np.zeros(len(ids), np.uint8)
    for selector in range(14, 0, -1):
        most[ids < _U(1 << int(BITS[selector]))] = COUNTS[selector]
    return most


_MOST = _widest(np.arange(1 << 16, dtype=_U))


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``ids`` and the word at which each block begins."""
    ids = np.ascontiguousarray(ids, dtype=_U)
    n = len(ids)
    if not n:
        return np.zeros(0, "<u8"), np.zeros(0, np.int64)
    # The most ids a word may hold if this one is among them; 0 asks for an escape.
    most = _MOST[np.minimum(ids, _U(len(_MOST) - 1)).astype(np.int64)]
    large = np.flatnonzero(ids >= _U(len(_MOST) - 1))
    if len(large):
        most[large] = _widest(ids[large])
    blocks = -(-n // BLOCK)
    most = np.append(most, np.zeros(blocks * BLOCK - n, np.uint8))
    better = np.zeros(blocks * BLOCK, np.uint8)  # 15 less the selector, as lower ones hold more
    for selector in range(14, 0, -1):
        count = int(COUNTS[selector])
        good = most >= count
        if not good.any():
            break
        reach = 1
        while reach < count:  # from "here and reach - 1 more" to up to twice as many
            step = min(reach, count - reach)
            good[:-step] &= good[step:]
            reach += step
        if count > 1:
            good.reshape(blocks, BLOCK)[:, 1 - count :] = False
        np.maximum(better, good.view(np.uint8) * np.uint8(15 - selector), out=better)
    choice = 15 - better
    # All blocks walk in step, one word each at a time.
    step = COUNTS[choice]
    at = np.arange(0, blocks * BLOCK, BLOCK)
    ends = np.minimum(at + BLOCK, n)
    begins = np.zeros(n, bool)
    while len(at):
        begins[at] = True
        at = at + step[at]
        going = at < ends
        at, ends = at[going], ends[going]
    start = np.flatnonzero(begins)
    picked = choice[start]
    size = np.where(picked == ESCAPE, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), _U)
    for selector in np.unique(picked):
        which = picked == selector
        here, first = place[which], start[which]
        word = np.full(len(here), int(selector) << 60, _U)
        if selector == ESCAPE:
            words[here + 1] = ids[first]
        else:
            for k in range(int(COUNTS[selector])):
                word |= ids[first + k] << _U(k * int(BITS[selector]))
        words[here] = word
    return words.astype("<u8"), place[np.searchsorted(start, np.arange(0, n, BLOCK))]


def unpack(words: np.ndarray, block_offsets: np.ndarray | None = None) -> np.ndarray:
    """The ids of some blocks; with offsets, a block's words are found without those before it."""
    words = np.ascontiguousarray(words, dtype=_U)
    if not len(words):
        return np.zeros(0, _U)
    selector = (words >> _U(60)).astype(np.int64)
    # A word after an escape is an id.  Inside a run of words that look like escapes, every second
    # is one; blocks begin a run anew, as they begin with a selector.
    looks = selector == ESCAPE
    if looks.any():
        fresh = looks & ~np.append(False, looks[:-1])
        if block_offsets is not None:
            fresh[block_offsets] |= looks[block_offsets]
        place = np.arange(len(words))
        run = np.maximum.accumulate(np.where(fresh, place, -1))
        escape = looks & ((place - run) % 2 == 0)
        raw = np.append(False, escape[:-1])
    else:
        raw = looks
    counts = np.where(raw, 1, np.where(looks & ~raw, 0, COUNTS[selector]))
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), _U)
    out[first[raw]] = words[raw]
    selector[raw] = 0
    for s in range(1, 15):
        which = np.flatnonzero(selector == s)
        if len(which):
            bits, mask = int(BITS[s]), _U((1 << int(BITS[s])) - 1)
            value, to = words[which], first[which]
            for k in range(int(COUNTS[s])):
                out[to + k] = (value >> _U(k * bits)) & mask
    return out


class Encoder(WordEncoder):
    """Ids of whole texts by the tokenizers library, which is asked once for each new word.

    Where white space is single spaces and line breaks between words, no merge and no cut of the
    library's pattern reaches over it, nor from a letter to a full stop or comma that ends a word.  So the
    ids of such a text are those of its words.  Any other text goes to the library whole.
    """

    def __init__(self, file: str, end_id: int):
        # A task has one core; the library's own threads would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        marks = tuple(self.tokenizer.encode(c, add_special_tokens=False).tokens[0] for c in " \n")
        self.begins = np.zeros(max(names.values()) + 1, bool)
        self.begins[[i for name, i in names.items() if name.startswith(marks)]] = True
        newline, stop, comma = (int(self.whole(c)[0]) for c in "\n.,")
        super().__init__(MEMORY, newline, bare_opening=True, end=end_id, cut={46: stop, 44: comma})

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, words: list[str], bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        safe = np.array([t.split() == [t] and not any(s in t for s in self.special) for t in words], bool)
        spaced = [("\n" if b else " ") + t for t, b, ok in zip(words, bare.tolist(), safe.tolist()) if ok]
        lines = ["".join(spaced[k : k + 50]) for k in range(0, len(spaced), 50)]
        lines = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.array([i for line in lines for i in line.ids], np.uint32)
        first = np.flatnonzero(self.begins[ids])
        sizes = np.full(len(words), UNSAFE)
        sizes[safe] = np.diff(np.append(first, len(ids))) - bare[safe]
        keep = np.ones(len(ids), bool)
        keep[first[bare[safe]]] = False
        return sizes, ids[keep]


_encoders: dict[str, Encoder] = {}


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text of ``docs`` and write the ids to files under ``path`` in ascending id order.

    ``tokenizer`` is the path of a tokenizers file on the driver (a few MB, fixed size).  A null or
    empty text has the end id only; rows without an id come first; rows that share an id are ordered by
    text.  An empty table gives no segments.  One shuffle deals the texts out by ranges of ids.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(shared.value, end_id)
        encoder, place = _encoders[tokenizer], 0
        for batch in chunks(batches, "text", SEGMENT_BYTES):
            ids, lengths = encoder.encode(batch.column("text").fill_null(""))
            words, offsets = pack(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("part").slice(0, 1),
                    pa.array([place], pa.int32()),
                    pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([offsets.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([words.tobytes()], pa.binary()),
                ],
                names=["part", "place", "doc_ids", "lengths", "block_offsets", "payload"],
            )
            place += 1

    (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", "text")
        .withColumn("part", F.spark_partition_id())
        .mapInArrow(segments, SEGMENTS)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document: its id, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``."""
    return _read(spark, path, id_col, "ids array<long>", lambda ids, cut: [np.split(ids.astype(np.int64), cut)])


def token_digests(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document: its id, ``start``, ``n_tokens`` and the ``ids_crc32`` of its ids as 32-bit integers."""

    def crc(ids: np.ndarray, cut: np.ndarray) -> list:
        data = memoryview(ids.astype("<u4").view(np.uint8))
        edges = [0, *(4 * cut).tolist(), len(data)]
        return [[zlib.crc32(data[a:b]) for a, b in zip(edges, edges[1:])]]

    return _read(spark, path, id_col, "ids_crc32 long", crc)


def _read(spark: SparkSession, path: str, id_col: str, column: str, make) -> DataFrame:
    name, kind = column.split(" ")
    arrow = pa.list_(pa.int64()) if kind.startswith("array") else pa.int64()
    segments = spark.read.parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                lengths, _ = ragged(one.column("lengths"))
                offsets, _ = ragged(one.column("block_offsets"))
                words = np.frombuffer(one.column("payload")[0].as_buffer(), "<u8")
                ids = unpack(words, offsets)
                ends = np.cumsum(lengths, dtype=np.int64)
                (values,) = make(ids, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), one.column("part")[0].as_py(), np.int32)),
                        pa.array(np.full(len(lengths), one.column("place")[0].as_py(), np.int32)),
                        one.column("doc_ids").flatten(),
                        pa.array(ends - lengths),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(values, arrow),
                    ],
                    names=["part", "place", id_col, "before", "n_tokens", name],
                )

    # One row per segment, of some MB of text each; a part's are summed where they are,
    # and the parts are as many as there were shuffle partitions.
    sizes = segments.select("part", "place", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("parts_before"))
    sizes = sizes.select(
        "part", "place", (F.sum("n").over(Window.partitionBy("part").orderBy("place")) - F.col("n")).alias("places_before")
    )
    starts = sizes.join(F.broadcast(parts), "part").select(
        "part", "place", (F.col("parts_before") + F.col("places_before")).alias("base")
    )
    rows = segments.mapInArrow(decode, f"part int, place int, `{id_col}` long, before long, n_tokens long, {column}")
    return rows.join(starts, ["part", "place"]).select(
        id_col, (F.col("base") + F.col("before")).alias("start"), "n_tokens", name
    )
