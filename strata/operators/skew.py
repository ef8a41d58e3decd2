"""Joins that stay balanced when one key holds a large part of the rows.

No join here forces a broadcast of a side whose size is unknown: Spark
broadcasts a side only when its own size estimate is below
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import draw


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for ``df``."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size check would let it broadcast ``df``."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 < limit and planned_bytes(df) <= limit


def splits_skew(spark: SparkSession) -> bool:
    """Whether Spark splits hot join partitions at run time in this session."""
    settings = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(s).lower() == "true" for s in settings)


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    share: float = 0.001,
    slices: int = 64,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: at most ``1 / share`` of them.

    Counts are taken on one hash slice in ``slices`` of the rows.  The outcome
    only decides which keys get spread, never which rows are joined.
    """
    sliced = df.filter(draw(*(spread or df.columns), salt=7, buckets=slices) == 0)
    counts = sliced.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = sliced.agg(F.count("*")).scalar()
    return counts.filter(F.col("_n") > F.greatest(total * F.lit(share), F.lit(1.0))).select(*keys)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    how: str = "inner",
    splits: int = 64,
    share: float = 0.001,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Equi join whose hot left keys are spread over ``splits`` tasks.

    Right rows of hot keys are repeated once per split, all others are kept
    single, so only a bounded set of keys grows.  Rows with a null key are
    spread too, since a left join would send them all to one task.  The salt is
    a hash of the row, so a task that runs again sends each row the same way.
    ``how`` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left")
    keys = list(keys)
    spread = list(spread or left.columns)
    hot = hot_keys(left, keys, share=share, spread=spread).withColumn("_hot", F.lit(True))
    # At most 1 / share rows, by the definition of a share.
    hot = F.broadcast(hot)

    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    tagged = (
        left.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.when(
                F.coalesce(F.col("_hot"), F.lit(False)) | null_key,
                draw(*spread, salt=11, buckets=splits).cast("int"),
            ).otherwise(F.lit(0)),
        )
        .drop("_hot")
    )
    fanned = (
        right.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(
                    F.coalesce(F.col("_hot"), F.lit(False)),
                    F.sequence(F.lit(0), F.lit(splits - 1)),
                ).otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("_hot")
    )
    return _equi_join(tagged, fanned, keys + ["_salt"], condition, how).drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    how: str = "inner",
    method: str = "auto",
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Join a large, possibly skewed left side to a keyed right side.

    ``plain`` leaves the strategy to Spark: a broadcast if the right side is
    small, else a shuffle whose hot partitions the adaptive skew join splits.
    ``salted`` spreads the hot keys itself.  ``auto`` is plain when the session
    has the adaptive skew join or the right side passes Spark's broadcast size
    check, and salted otherwise.
    """
    if method == "auto":
        method = "plain" if splits_skew(left.sparkSession) or fits_broadcast(right) else "salted"
    if method == "plain":
        return _equi_join(left, right, list(keys), condition, how)
    if method == "salted":
        return salted_join(left, right, keys, condition, how, spread=spread)
    raise ValueError(f"unknown method {method!r}")


def _equi_join(
    left: DataFrame, right: DataFrame, keys: list[str], condition: Column | None, how: str
) -> DataFrame:
    if condition is None:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = condition
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])
