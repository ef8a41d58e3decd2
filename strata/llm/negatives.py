"""Hard negatives by slots of scores.

Each of an anchor's positives asks for the best rows of other labels in a window of scores below its own.  The upper
limits of these windows cut the scores into disjoint slots, descending.  Anchors are dealt into blocks that meet tiles of
all rows; in a task and in the merge after it, each anchor keeps the best ``k`` rows of each slot and no more.  A
window's rows are then those of its own slot and all lower ones: as slots descend, one list per anchor serves all of its
windows, each a tail of that list cut at the window's lower limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.topk import LEAST_WIDTH, SCALE, TILE, Best, Matrix, against, alike, bounds, integers, places, products, reached, stored_tiles
from strata.llm.words import ragged
from strata.session import scratch_dir

_LISTS = "anchor long, slot int, other long, score long"
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1
_TILES = "size int, ids array<long>, labels array<long>, small boolean, matrix binary"


def _pack(scale: int, extra: str = ""):
    """Rows of one length as tiles, sorted by label so that few labels meet in a tile; ``extra`` lists go along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, first = ragged(batch.column("vector"))
            ids, labels = np.asarray(batch.column("id")), np.asarray(batch.column("label"))
            with np.errstate(over="ignore"):
                values = np.floor(scale * values.astype(np.float64))
            misfits = np.append(0, np.cumsum(~(np.abs(values) < 2.0**62)))
            sizes = np.diff(first)
            good = misfits[first[1:]] == misfits[first[:-1]]
            for size in np.unique(sizes[good]):
                rows = np.flatnonzero(good & (sizes == size))
                rows = rows[np.lexsort((ids[rows], labels[rows]))]
                for at in range(0, len(rows), TILE):
                    part = rows[at : at + TILE]
                    matrix = values[first[part][:, None] + np.arange(size)].astype("<i8")
                    small = bool(np.abs(matrix).max(initial=0) < 2**15)
                    columns = {
                        "size": pa.array([int(size)], pa.int32()),
                        "ids": pa.array([ids[part]], pa.list_(pa.int64())),
                        "labels": pa.array([labels[part]], pa.list_(pa.int64())),
                        "small": pa.array([small]),
                        "matrix": pa.array([matrix.astype("<i2" if small else "<i8").tobytes()], pa.binary()),
                    }
                    if extra:
                        lists = batch.column(extra).take(pa.array(part)).to_pylist()
                        columns[extra] = pa.array([lists], pa.list_(pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_pydict(columns)

    return run


class _Anchors:
    """Anchors of one length in the order of their labels, at most as many as a tile has rows, and what they keep."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray, limits: list | None, k: int):
        self.ids, self.labels, self.matrix = ids, labels, Matrix(values)
        self.kinds = np.unique(labels)
        # Of each anchor: the least score asked for, then its slots' tops; without limits one slot takes all.
        limits = limits or [[_LOWEST, _HIGHEST]] * len(ids)
        self.slots = np.array([len(x) - 1 for x in limits])
        self.width = max(int(self.slots.max()), 1)
        self.tops = np.array([x[1:] + [_LOWEST] * (self.width - len(x) + 1) for x in limits], np.int64)
        above = np.append(self.tops[:, 1:], np.full((len(ids), 1), _LOWEST), axis=1)  # the next slot's top
        above = np.where(np.arange(1, self.width + 1) < self.slots[:, None], above + 1, _LOWEST)
        least = np.maximum(above, np.array([x[0] for x in limits], np.int64)[:, None])
        self.used = np.arange(self.width) < self.slots[:, None]
        self.best = Best(least.reshape(-1), k)

    def least(self) -> np.ndarray:
        """What each slot still takes."""
        return np.where(self.used, self.best.least.reshape(-1, self.width), _HIGHEST)

    def add(self, anchors: np.ndarray, scores: np.ndarray, others: np.ndarray) -> None:
        """Scores that lie below the first slot's top."""
        slots = np.maximum((self.tops[anchors] >= scores[:, None]).sum(axis=1), 1)
        slots = np.minimum(slots, self.slots[anchors]) - 1
        self.best.add(anchors * self.width + slots, scores, others)


def _walk(tile, k: int):
    """All tiles against the anchors of a block; ``tile`` names what may be among an anchor's best."""

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors: dict[int, list[_Anchors]] = {}

            def walk(batch: pa.RecordBatch) -> None:
                for row, size in enumerate(batch.column("size").to_pylist()):
                    others, labels = (np.asarray(batch.column(c)[row].values) for c in ("ids", "labels"))
                    matrix, kinds = Matrix(integers(batch, row, size)), np.unique(labels)
                    for own in anchors.get(size, ()):
                        tile(own, others, labels, kinds, matrix, k)

            table = shared.value
            for size, rows, ids, values in alike(table):
                labels = np.concatenate([np.asarray(table.column("labels")[r].values) for r in rows])
                limits = None
                if "limits" in table.column_names:
                    limits = [x for r in rows for x in table.column("limits")[r].as_py()]
                order = np.lexsort((ids, labels))
                for at in range(0, len(order), TILE):
                    part = order[at : at + TILE]
                    own = [limits[x] for x in part] if limits else None
                    anchors.setdefault(size, []).append(_Anchors(ids[part], labels[part], values[part], own, k))
            for batch in batches:
                walk(batch)
                del batch  # up to 64 MB, which would else stay while the next is read
            for own in (x for parts in anchors.values() for x in parts):
                lists, other, score = own.best.rows()
                anchor, slot = np.divmod(lists, own.width)
                columns = [pa.array(x) for x in (own.ids[anchor], slot.astype(np.int32), other, score)]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "slot", "other", "score"])

        return run

    return search


def _positives(own: _Anchors, others: np.ndarray, labels: np.ndarray, kinds: np.ndarray, matrix: Matrix, k: int) -> None:
    # Tiles are sorted by label, so most pairs of tiles share none, and a shared one is a block of rows.
    for label in np.intersect1d(own.kinds, kinds):
        q, c = (slice(*(int(np.searchsorted(x, label, side)) for side in ("left", "right"))) for x in (own.labels, labels))
        scores = products(own.matrix, matrix, q, c)
        least = own.best.least[q]
        rows = reached(scores, least)
        if len(rows):
            scores = scores[rows]
            at, to = places(scores, scores >= bounds(least[rows], scores), k, own.ids[q][rows], others[c])
            own.add(rows[at] + q.start, scores[at, to].astype(np.int64), others[c][to])


def _negatives(own: _Anchors, others: np.ndarray, labels: np.ndarray, kinds: np.ndarray, matrix: Matrix, k: int) -> None:
    shared = len(np.intersect1d(own.kinds, kinds))
    if shared and len(own.kinds) == len(kinds) == 1:
        return
    scores, least = products(own.matrix, matrix), own.least()
    rows = reached(scores, least.min(axis=1))
    if not len(rows):
        return
    if 2 * len(rows) > len(scores):
        rows = np.arange(len(scores))
    else:
        scores = scores[rows]
    least, tops = least[rows], own.tops[rows]
    usable = scores >= bounds(least.min(axis=1), scores)
    usable &= scores <= bounds(tops[:, 0], scores)
    if shared:
        usable &= own.labels[rows][:, None] != labels[None, :]
    if np.count_nonzero(usable) <= 4 * k * len(scores):
        inside = [usable]
    else:
        inside = (usable & (scores >= bounds(least[:, s], scores)) & (scores <= bounds(tops[:, s], scores)) for s in range(own.width))
    for wanted in inside:
        at, to = places(scores, wanted, k, own.ids[rows], others)
        own.add(rows[at], scores[at, to].astype(np.int64), others[to])


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each anchor and slot."""
    window = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "other")
    return lists.withColumn("place", F.row_number().over(window)).where(F.col("place") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become floor(scale * x); a row's score is its inner product with the anchor, a long (at its ends if it
    overflows).  An anchor's positives are its ``positives`` highest-scoring rows of the same label; for each the
    ``negatives`` highest-scoring rows of other labels with low * positive <= 100 * negative <= high * positive are
    returned.  Ties go to the smaller id.

    Rows whose id, label or vector is null, that hold a null or non-finite component, or one too large for a long, take
    no part; vectors of another length are not compared.  Rows with the anchor's id are not its positives, nor, of
    whatever label, its negatives.  Repeated rows are ranked each, as positives and as negatives; rows that share an id
    are one anchor, the least by label and vector.  An anchor without positives, a positive whose score is negative, and
    an empty table give no rows.
    """
    spark = vectors.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        is_anchor.alias("anchor"),
    ).where(
        "id is not null and label is not null and vector is not null"
        " and not exists(vector, x -> x is null or isnan(x) or abs(x) = double('Infinity'))"
    )
    tiles = stored_tiles(rows.select("id", "label", "vector").mapInArrow(_pack(scale), _TILES))
    anchors = rows.where("anchor").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    anchors = stored(anchors.select("id", "row.label", "row.vector"), "anchors")

    width = max(LEAST_WIDTH, positives)
    positive = _merged(against(anchors, tiles, _pack(scale), _TILES, _walk(_positives, positives), _LISTS, width), positives)
    # The same limits in exact arithmetic: the least and the greatest integer inside low % and high % of the score.
    share = "cast({} * cast(score as decimal(19, 0)) as decimal(38, 0))"
    positive = positive.where("score >= 0").select(
        "anchor",
        F.col("other").alias("positive"),
        F.col("place").alias("order"),
        F.col("score").alias("positive_score"),
        F.expr(f"ceil({share.format(low)} / 100)").cast("long").alias("bottom"),
        F.expr(f"floor({share.format(high)} / 100)").cast("long").alias("top"),
    )
    positive = stored(positive, "positives")
    limits = positive.groupBy("anchor").agg(
        F.min("bottom").alias("bottom"), F.sort_array(F.collect_set("top"), asc=False).alias("tops")
    )
    bounded = anchors.join(limits, anchors["id"] == limits["anchor"]).select(
        "id", "label", "vector", F.concat(F.array("bottom"), "tops").alias("limits")
    )
    kind = f"{_TILES}, limits array<array<long>>"
    bounded, width = stored(bounded, "bounded"), max(LEAST_WIDTH, positives * negatives)
    lists = _merged(against(bounded, tiles, _pack(scale, "limits"), kind, _walk(_negatives, negatives), _LISTS, width), negatives)

    # Slots descend and so do the rows of each: one sorted list per anchor, of at most positives * negatives rows.
    ranked = F.struct((-F.col("score")).alias("order"), "other", "score")
    lists = lists.groupBy("anchor").agg(F.sort_array(F.collect_list(ranked)).alias("rows"))
    window = F.filter("rows", lambda r: (r["score"] >= F.col("bottom")) & (r["score"] <= F.col("top")))
    chosen = positive.join(lists, "anchor").withColumn("chosen", F.slice(window, 1, negatives))
    return chosen.select("anchor", "positive", "positive_score", F.posexplode("chosen").alias("at", "row")).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("row.other").alias("negative_id"),
        "positive_score",
        F.col("row.score").alias("negative_score"),
    )
