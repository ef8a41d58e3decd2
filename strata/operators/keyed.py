"""Patch updates and unique inserts on keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import first_per_key


def fold_latest(
    events: DataFrame,
    key: str,
    order_by: Sequence[str],
    columns: Sequence[str],
    overwrite: Sequence[str] = (),
) -> DataFrame:
    """One row per key with the last non-null value of each column.

    Columns in ``overwrite`` take the last value even when it is null.
    """
    order = F.struct(*order_by)
    aggregates = []
    for c in columns:
        when = order if c in overwrite else F.when(F.col(c).isNotNull(), order)
        aggregates.append(F.max_by(c, when).alias(c))
    return events.groupBy(key).agg(*aggregates)


def patch_rows(
    target: DataFrame,
    patches: DataFrame,
    key: str,
    order_by: Sequence[str],
    overwrite: Sequence[str] = (),
) -> DataFrame:
    """``target`` with the patched columns replaced where the patch has a value.

    Several patches of a key count in order; patches of unknown keys are
    ignored, as an update would.
    """
    columns = [c for c in target.columns if c != key and c in patches.columns]
    folded = fold_latest(patches, key, order_by, columns, overwrite)
    folded = folded.withColumnsRenamed({c: f"_new_{c}" for c in columns})
    joined = target.join(folded.withColumn("_patched", F.lit(True)), key, "left")
    out = []
    for c in target.columns:
        if c not in columns:
            out.append(F.col(c))
        elif c in overwrite:
            out.append(F.when(F.col("_patched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c))
    return joined.select(*out)


def resolve_unique(
    target: DataFrame, candidates: DataFrame, key: str, order_by: Sequence[str]
) -> DataFrame:
    """Candidates flagged ``accepted``: the first of each key not yet in ``target``.

    ``order_by`` must identify a candidate row and hold no nulls: the flag is
    joined back on key and order together, so a key that repeats a lot still
    spreads over all tasks.
    """
    identity = [key, *order_by]
    winners = first_per_key(candidates.select(*identity), key, list(order_by)).join(
        target.select(key).distinct(), key, "left_anti"
    )
    flagged = candidates.join(winners.withColumn("_won", F.lit(True)), identity, "left")
    return flagged.select(
        *candidates.columns, F.coalesce(F.col("_won"), F.lit(False)).alias("accepted")
    )


def insert_unique(
    target: DataFrame, candidates: DataFrame, key: str, order_by: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The target with the accepted candidates added, and the refused candidates."""
    resolved = resolve_unique(target, candidates, key, order_by)
    accepted = resolved.filter("accepted").select(*target.columns)
    refused = resolved.filter("not accepted").drop("accepted")
    return target.unionByName(accepted), refused
