"""Joining facts to the dimension version that was valid at the time of the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import draw, slot_of, tuple_differs
from strata.operators.history import DEFAULT, ControlColumns, covers, scd2_current
from strata.operators.skew import lookup_join

#: Keys with fewer versions are not cut into slots.
MANY_VERSIONS = 24
#: A key whose sampled facts say that it has more than so many is swept in slices of about so many.
SLICE_FACTS = 2_000_000
#: Facts are counted per key on one hash slice in so many of them.
SAMPLE = 64
_STEP = {s: f"interval 1 {s}" for s in ("year", "month", "week", "day")}


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    carry: Sequence[str] | None = None,
    how: str = "inner",
    method: str = "auto",
    slot: str = "month",
    names: ControlColumns = DEFAULT,
) -> DataFrame:
    """Each fact with the version of its key that covers the fact's time.

    Intervals are half open, so a fact on the instant of a change belongs to
    the new version.  ``carry`` names the version columns to add (default all).

    ``range``   equi join on the key, the interval as a residual condition.
    ``salted``  the same with hot fact keys spread over many tasks.
    ``slots``   both sides of keys with many versions also cut by calendar
                slot: a fact meets only the versions alive in its slot.
    ``sweep``   facts and versions in one sequence by key and time, in which each
                fact takes the last version before it: a sort instead of a
                join, whose cost does not grow with the versions per key.
                Versions of a key must not overlap.
    ``auto``    range where Spark splits hot partitions itself or can broadcast
                the versions, else salted.

    All methods give the same rows.  ``how`` is inner or left.
    """
    if carry is None:
        carry = [c for c in versions.columns if c != key]
    clash = set(carry) & set(facts.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    helper = [c for c in (names.valid_from, names.valid_to) if c not in carry]
    right = versions.select(key, *carry, *helper)
    left = facts.withColumn("_at", F.col(ts).cast("timestamp_ntz"))
    condition = covers(F.col("_at"), names)
    if method == "sweep":
        return _sweep(left, right, key, how, names).select(*facts.columns, *carry)
    if method == "slots":
        left, right = _slotted(left, right, key, slot, names)
        keys, method = [key, "_slot"], "auto"
    else:
        keys, method = [key], {"range": "plain"}.get(method, method)
    joined = lookup_join(left, right, keys, condition, how, method, spread=facts.columns)
    return joined.select(*facts.columns, *carry)


def _slotted(
    facts: DataFrame, versions: DataFrame, key: str, slot: str, names: ControlColumns
) -> tuple[DataFrame, DataFrame]:
    """Facts tagged with their slot, versions repeated for each slot they are alive in.

    Only keys with ``MANY_VERSIONS`` or more are cut; all others stay whole, in one
    slot that stands for all time.  The repetition is clipped to the span of the
    facts, so an open end or a start in 1900 costs no slots outside the data.
    """
    counts = versions.groupBy(key).agg(F.count("*").alias("_n"))
    many = counts.filter(F.col("_n") >= MANY_VERSIONS).select(key, F.lit(True).alias("_cut"))
    whole = slot_of(F.lit("1970-01-01").cast("timestamp_ntz"), slot)
    span = facts.agg(F.struct(F.min("_at").alias("lo"), F.max("_at").alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    alive = versions.filter(
        (F.col(names.valid_from) <= hi)
        & (F.col(names.valid_to).isNull() | (F.col(names.valid_to) > lo))
    )
    first = slot_of(F.greatest(F.col(names.valid_from), lo), slot)
    last = slot_of(F.least(F.coalesce(F.col(names.valid_to), hi), hi), slot)
    slots = F.when(F.col("_cut"), F.sequence(first, last, F.expr(_STEP[slot]))).otherwise(F.array(whole))
    own = F.when(F.col("_cut"), slot_of("_at", slot)).otherwise(whole)
    return (
        facts.join(many, key, "left").withColumn("_slot", own).drop("_cut"),
        alive.join(many, key, "left").withColumn("_slot", F.explode(slots)).drop("_cut"),
    )


def _sweep(
    facts: DataFrame, versions: DataFrame, key: str, how: str, names: ControlColumns
) -> DataFrame:
    """Facts (with their time as ``_at``) and the columns of the version that covers them.

    Keys with very many facts are cut into slices of time, each a task's work of its own.  A slice begins with
    the version carried over from the slices before it, one row per slice and key.
    """
    if how not in ("inner", "left"):
        raise ValueError("a sweep supports inner and left")
    start, end = F.col(names.valid_from), F.col(names.valid_to)
    # A version that covers no instant would hide the one it stands beside.
    usable = versions.filter(F.col(key).isNotNull() & start.isNotNull() & (end.isNull() | (start < end)))
    placed = facts.filter(F.col(key).isNotNull() & F.col("_at").isNotNull())
    version = F.struct(*[c for c in versions.columns if c != key])
    fact = F.struct(*facts.columns)
    facts_in, versions_in = _sliced(placed, usable.withColumn("_at", start).withColumn("_version", version), key)
    sequence = facts_in.select(key, "_slice", "_at", fact.alias("_fact")).unionByName(
        versions_in.select(key, "_slice", "_at", "_version"), allowMissingColumns=True
    )
    # Versions sort before facts of the same instant, as an interval holds its start.
    order = Window.partitionBy(key, "_slice").orderBy("_at", F.col("_fact").isNotNull())
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = F.last("_version", ignorenulls=True).over(so_far)
    swept = sequence.withColumn("_version", latest).filter(F.col("_fact").isNotNull())
    until = F.col(f"_version.{names.valid_to}")
    hit = F.col("_version").isNotNull() & (until.isNull() | (F.col("_at") < until))
    columns = [c for c in versions.columns if c != key]
    if how == "inner":
        return swept.filter(hit).select("_fact.*", *[F.col(f"_version.{c}").alias(c) for c in columns])
    found = swept.select("_fact.*", *[F.when(hit, F.col(f"_version.{c}")).alias(c) for c in columns])
    unplaced = facts.filter(F.col(key).isNull() | F.col("_at").isNull())
    return found.unionByName(unplaced, allowMissingColumns=True)


def _sliced(facts: DataFrame, versions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with their slice, and the versions that slices of hot keys begin with.

    A slice is an equal part of the time that a hot key's facts span.  Which keys are hot is
    estimated from a sample of the facts and changes no result, only how the work is dealt out.
    """
    sampled = facts.filter(draw(*facts.columns, salt=13, buckets=SAMPLE) == 0)
    hot = sampled.groupBy(key).agg(F.count("*").alias("n"), F.min("_at").alias("lo"), F.max("_at").alias("hi"))
    hot = hot.filter(F.col("n") > max(SLICE_FACTS // SAMPLE, 1)).select(
        key, "lo", "hi", F.ceil(F.col("n") * SAMPLE / SLICE_FACTS).alias("k")
    )
    hot = hot.collect()  # at most one row per SLICE_FACTS facts
    if not hot:
        zero = F.lit(0).cast("bigint").alias("_slice")
        return facts.select("*", zero), versions.select("*", zero)
    spark = facts.sparkSession
    kind = f"`{key}` {facts.schema[key].dataType.simpleString()}, _lo timestamp_ntz, _hi timestamp_ntz, _k bigint"
    hot = spark.createDataFrame([tuple(r) for r in hot], kind)

    def seconds(c):  # in no time zone
        return F.unix_date(F.col(c).cast("date")) * F.lit(86400) + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c))

    width = seconds("_hi") - seconds("_lo") + 1
    part = F.floor((seconds("_at") - seconds("_lo")) / width * F.col("_k"))
    own = F.coalesce(F.least(F.greatest(part, F.lit(0)), F.col("_k") - 1), F.lit(0)).cast("bigint")

    def cut(df: DataFrame) -> DataFrame:
        return df.join(hot, key, "left").withColumn("_slice", own)

    facts_in, versions_in = cut(facts).drop("_lo", "_hi", "_k"), cut(versions)
    # The last version that began in each slice, carried over the later slices up to the next one that has any.
    of_hot = versions_in.filter(F.col("_k").isNotNull())
    last = of_hot.groupBy(key, "_slice", "_k").agg(F.max_by("_version", "_at").alias("_version"), F.max("_at").alias("_at"))
    following = F.coalesce(F.lead("_slice").over(Window.partitionBy(key).orderBy("_slice")), F.col("_k") - 1)
    reach = last.withColumn("_to", following).filter(F.col("_to") > F.col("_slice"))
    carried = reach.withColumn("_slice", F.explode(F.sequence(F.col("_slice") + 1, "_to")))
    wanted = [key, "_slice", "_at", "_version"]
    return facts_in, versions_in.select(*wanted).unionByName(carried.select(*wanted))


def current_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    carry: Sequence[str],
    how: str = "inner",
    method: str = "auto",
    names: ControlColumns = DEFAULT,
) -> DataFrame:
    """Each fact with the present version of its key, whatever the fact's time."""
    right = scd2_current(versions, names).select(key, *carry)
    joined = lookup_join(facts, right, [key], None, how, method)
    return joined.select(*facts.columns, *carry)


def attribution_shift(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    owner: Sequence[str],
    method: str = "auto",
    names: ControlColumns = DEFAULT,
) -> DataFrame:
    """Facts whose owner at the time is not the present owner, with both.

    The two owners are compared on the dimension, before the facts come in, so
    the facts are joined once and only to versions that did change hands.
    """
    present = scd2_current(versions, names).select(
        key, *[F.col(c).alias(f"now_{c}") for c in owner]
    )
    then = versions.select(
        key, *[F.col(c).alias(f"then_{c}") for c in owner], names.valid_from, names.valid_to
    )
    moved = then.join(present, key).filter(
        tuple_differs([F.col(f"then_{c}") for c in owner], [F.col(f"now_{c}") for c in owner])
    )
    carry = [f"then_{c}" for c in owner] + [f"now_{c}" for c in owner]
    return point_in_time_join(facts, moved, key, ts, carry, method=method, names=names)
