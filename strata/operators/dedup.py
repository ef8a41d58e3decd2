"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str] | str, order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key, nulls ordered last, ties settled by the whole row.

    Spark plans the rank filter as a group limit before the shuffle, so each
    map task sends at most one row per key however often the key repeats.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    named = [c for c in order_by if isinstance(c, str)]
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    order += [F.col(c).asc_nulls_last() for c in df.columns if c not in keys and c not in named]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
