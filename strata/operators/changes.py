"""Applying, checking and deriving insert / update / delete batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import draw, tuple_differs
from strata.operators.skew import fits_broadcast
from strata.schema import OP


def reduce_changes(
    changes: DataFrame,
    key: str,
    columns: Sequence[str],
    order_by: Sequence[str] = (),
    op: str = OP,
    on_duplicate: str = "last",
    sequence: str | None = None,
) -> DataFrame:
    """One row per key with what the batch does to it.

    ``_gone``   a delete is present, so whatever follows starts a fresh row
    ``_row``    the row to leave behind, null when the key ends deleted
    ``_first``  the first row of that fresh start, for columns that updates keep

    Rows with a null operation take no part.  The aggregation combines on the
    map side, so a key repeated over a large part of the batch costs one row
    per map task in the shuffle.  With ``sequence`` the batch is a series of
    batches to be applied in the order of that column (see ``_in_sequence``).
    """
    if on_duplicate not in ("last", "error"):
        raise ValueError("on_duplicate is 'last' or 'error'")
    is_delete = F.col(op) == "D"
    row = F.struct(*columns)
    order = F.struct(*order_by, row.alias("_row")) if order_by else row
    group = [key] if sequence is None else [key, sequence]
    if sequence is not None:
        unplaced = F.raise_error(F.lit(f"a change row has no {sequence}")).cast("boolean")
        changes = changes.filter(F.when(F.col(sequence).isNull(), unplaced).otherwise(F.lit(True)))
    reduced = (
        changes.filter(F.col(op).isNotNull() & F.col(key).isNotNull())
        .groupBy(*group)
        .agg(
            F.bool_or(is_delete).alias("_gone"),
            F.max_by(F.when(~is_delete, row), F.when(~is_delete, order)).alias("_row"),
            F.count_if(~is_delete).alias("_upserts"),
        )
    )
    if on_duplicate == "error":
        repeated = F.concat(F.lit(f"several rows to apply for {key} "), F.col(key).cast("string"))
        reduced = reduced.filter(
            F.when(F.col("_upserts") > 1, F.raise_error(repeated).cast("boolean")).otherwise(
                F.lit(True)
            )
        )
    reduced = reduced.drop("_upserts")
    if sequence is None:
        return reduced.withColumn("_first", F.col("_row"))
    return _in_sequence(reduced, key, sequence)


def _in_sequence(steps: DataFrame, key: str, sequence: str) -> DataFrame:
    """Fold the steps of each key into one, as if applied one after the other.

    The last step decides what is left.  A delete in some step makes all later
    rows a fresh start.  Both folds combine on the map side and meet in an equi
    join, so a key with very many steps is no single task's work.
    """
    last_delete = F.max(F.when(F.col("_gone"), F.col(sequence)))
    cuts = steps.groupBy(key).agg(last_delete.alias("_cut"))
    since = F.col("_row").isNotNull() & (
        F.col("_cut").isNull() | (F.col(sequence) >= F.col("_cut"))
    )
    return (
        steps.join(cuts, key)
        .groupBy(key)
        .agg(
            F.bool_or("_gone").alias("_gone"),
            F.max_by("_row", sequence).alias("_row"),
            F.min_by("_row", F.when(since, F.col(sequence))).alias("_first"),
        )
    )


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    preserve: Sequence[str] = (),
    order_by: Sequence[str] = (),
    op: str = OP,
    on_duplicate: str = "last",
    strategy: str = "auto",
    sequence: str | None = None,
) -> DataFrame:
    """``target`` after a change batch.

    Deletes go first, then every other row updates its key or is inserted.  An
    update writes all columns, nulls included, except ``preserve``.  A key with
    both a delete and another operation comes back as a fresh row.

    ``sequence`` names a column that orders several batches given at once: the
    result is that of applying them one after the other, in one pass.

    ``lookup`` streams the target past the batch and scans only the key column
    a second time: no shuffle of the target while the batch passes Spark's
    broadcast size check.  ``outer`` is one full outer join, for large batches
    (and no target shuffle when the target is bucketed by the key).  ``auto``
    picks by that size check.
    """
    columns = target.columns
    missing = [c for c in columns if c not in changes.columns]
    if missing:
        raise ValueError(f"change batch lacks columns {missing}")
    delta = reduce_changes(changes, key, columns, order_by, op, on_duplicate, sequence)
    if strategy == "auto":
        strategy = "lookup" if fits_broadcast(changes) else "outer"
    if strategy == "outer":
        joined = target.withColumn("_known", F.lit(True)).join(delta, key, "full_outer")
        return joined.filter(_survives()).select(*_merged(columns, key, preserve))
    if strategy != "lookup":
        raise ValueError(f"unknown strategy {strategy!r}")

    joined = target.withColumn("_known", F.lit(True)).join(delta, key, "left")
    kept = joined.filter(_survives()).select(*_merged(columns, key, preserve))
    upserts = delta.filter(F.col("_row").isNotNull())
    # The matched keys are no more than the batch's; the target is only probed.
    matched = target.select(key).join(upserts.select(key), key, "left_semi")
    inserts = upserts.join(matched, key, "left_anti").select(*_fresh(columns, preserve))
    return kept.unionByName(inserts)


def _survives() -> Column:
    only_deleted = F.coalesce(F.col("_gone"), F.lit(False)) & F.col("_row").isNull()
    return ~only_deleted


def _merged(columns: Sequence[str], key: str, preserve: Sequence[str]) -> list[Column]:
    has_row = F.col("_row").isNotNull()
    fresh = has_row & (F.col("_known").isNull() | F.col("_gone"))
    out = []
    for c in columns:
        if c == key:
            out.append(F.col(c))
        elif c in preserve:
            out.append(F.when(fresh, F.col("_first")[c]).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(has_row, F.col("_row")[c]).otherwise(F.col(c)).alias(c))
    return out


def _fresh(columns: Sequence[str], preserve: Sequence[str]) -> list[Column]:
    return [F.col("_first" if c in preserve else "_row")[c].alias(c) for c in columns]


def op_counts(changes: DataFrame, op: str = OP) -> DataFrame:
    """Rows per operation code."""
    return changes.groupBy(op).agg(F.count("*").alias("n_rows"))


def check_batch(changes: DataFrame, key: str, op: str = OP) -> DataFrame:
    """Keys that make a batch ambiguous: a delete beside another operation, or
    more than one row to apply."""
    is_delete = F.col(op) == "D"
    per_key = changes.groupBy(key).agg(
        F.count_if(is_delete).alias("n_deletes"),
        F.count_if(~is_delete).alias("n_upserts"),
    )
    conflict = (F.col("n_deletes") > 0) & (F.col("n_upserts") > 0)
    repeated = F.col("n_upserts") > 1
    return per_key.filter(conflict | repeated).select(
        key,
        "n_deletes",
        "n_upserts",
        conflict.alias("delete_and_upsert"),
        repeated.alias("repeated_upsert"),
    )


def diff_snapshots(
    before: DataFrame,
    after: DataFrame,
    key: str,
    compare: Sequence[str] | None = None,
    op: str = OP,
) -> DataFrame:
    """The change batch that turns ``before`` into ``after`` (one row per key in each).

    Deletes carry the old row, inserts and updates the new one.
    """
    columns = [c for c in before.columns if c != key]
    compare = list(compare or columns)
    old = before.select(key, F.struct(*columns).alias("_old"))
    new = after.select(key, F.struct(*columns).alias("_new"))
    was, now = F.col("_old"), F.col("_new")
    code = (
        F.when(now.isNull(), F.lit("D"))
        .when(was.isNull(), F.lit("I"))
        .when(tuple_differs([was[c] for c in compare], [now[c] for c in compare]), F.lit("U"))
    )
    return (
        old.join(new, key, "full_outer")
        .withColumn(op, code)
        .filter(F.col(op).isNotNull())
        .select(
            key,
            *[F.when(now.isNull(), was[c]).otherwise(now[c]).alias(c) for c in columns],
            op,
        )
    )


def exclusive_split(
    df: DataFrame,
    key: str,
    shares: Mapping[str, int],
    salt: int = 0,
    drawn: Column | None = None,
    buckets: int = 10_000,
    label: str = "split",
) -> DataFrame:
    """Label rows by one draw per row, so that the groups can never overlap.

    ``shares`` gives each label its width out of ``buckets``; rows beyond the
    last range get a null label.  ``drawn`` replaces the key hash.
    """
    value = drawn if drawn is not None else draw(key, salt=salt, buckets=buckets)
    start, chosen = 0, F.lit(None).cast("string")
    for name, width in shares.items():
        inside = (F.col("_draw") >= start) & (F.col("_draw") < start + width)
        chosen = F.when(inside, F.lit(name)).otherwise(chosen)
        start += width
    if start > buckets:
        raise ValueError("shares add up to more than the number of buckets")
    return df.withColumn("_draw", value).withColumn(label, chosen).drop("_draw")
