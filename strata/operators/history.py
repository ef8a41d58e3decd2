"""Type-2 history kept from full snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import (
    EPOCH,
    change_hash,
    differs,
    instant,
    tuple_differs,
    version_key,
)


@dataclass(frozen=True)
class ControlColumns:
    """Names of the columns that carry the history."""

    hash: str = "scd_hash"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_current: str = "is_current"


DEFAULT = ControlColumns()


def as_versions(
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    valid_from,
    names: ControlColumns = DEFAULT,
    surrogate: str | None = None,
    null_token: str | None = None,
) -> DataFrame:
    """A one-row-per-key snapshot as open versions that start at ``valid_from``."""
    versions = snapshot.withColumns(
        {
            names.hash: change_hash(tracked, null_token),
            names.valid_from: instant(valid_from),
            names.valid_to: F.lit(None).cast("timestamp_ntz"),
            names.is_current: F.lit(True),
        }
    )
    if surrogate is None:
        return versions
    columns = versions.columns
    return versions.select(version_key(key, names.hash, names.valid_from).alias(surrogate), *columns)


def scd2_initial(
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    names: ControlColumns = DEFAULT,
    surrogate: str | None = None,
    epoch=EPOCH,
) -> DataFrame:
    """First load: every version is open since ``epoch``, so older facts find an owner."""
    return as_versions(snapshot, key, tracked, epoch, names, surrogate)


def batch_time(versions: DataFrame, batch_ts, names: ControlColumns = DEFAULT) -> Column:
    """The instant at which a batch closes old versions.

    Without an explicit time it is the start of the snapshot's versions, which
    makes the old end equal the new start; an empty snapshot closes at the
    present, fixed once here.
    """
    if batch_ts is not None:
        return instant(batch_ts)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return F.coalesce(versions.agg(F.max(names.valid_from)).scalar(), instant(str(now)))


def scd2_step(
    open_versions: DataFrame,
    versions: DataFrame,
    key: str,
    batch_ts=None,
    names: ControlColumns = DEFAULT,
) -> DataFrame:
    """What becomes of the open part of a dimension: kept, closed and new versions.

    Only open versions are read; closed history can never change and is left
    where it is.  One full outer join on the key emits up to two rows per key.
    """
    columns = open_versions.columns
    end = batch_time(versions, batch_ts, names)
    old = open_versions.select(key, F.struct(*columns).alias("_old"), end.alias("_end"))
    new = versions.select(key, F.struct(*columns).alias("_new"))
    was, now = F.col("_old"), F.col("_new")
    same = was.isNotNull() & now.isNotNull() & ~differs(was[names.hash], now[names.hash])
    changed = {names.valid_to: F.col("_end"), names.is_current: F.lit(False)}
    closed = F.struct(*[changed.get(c, was[c]).alias(c) for c in columns])
    first = F.when(same, was).when(was.isNotNull(), closed)
    second = F.when(now.isNotNull() & ~same, now)
    # An absent struct comes out as a row of nulls.
    emitted = old.join(new, key, "full_outer").select(F.inline(F.array(first, second)))
    return emitted.filter(F.col(key).isNotNull())


def scd2_backlog(
    open_versions: DataFrame,
    snapshots: Sequence[tuple[DataFrame, object]],
    key: str,
    names: ControlColumns = DEFAULT,
) -> DataFrame:
    """What becomes of the open versions after several waiting snapshots, in one pass.

    ``snapshots`` are (open versions of a snapshot, its instant) in order; the outcome is that of a ``scd2_step`` for
    each.  A version is an island: a key's unbroken run of rounds with one digest, the present open version counting as
    the round before the first.  It keeps the row it began with and ends at the instant of the round after its last,
    if there is one.  One shuffle and one sort by key, however many snapshots wait; a key has a row per round.
    """
    if not snapshots:
        return open_versions
    columns = open_versions.columns
    # The instants of an empty snapshot and of one without a given time are settled as in a single round.
    times = [batch_time(versions, ts, names) for versions, ts in snapshots]
    row = F.struct(*columns).alias("_row")
    rounds = [open_versions.select(key, F.col(names.hash).alias("_hash"), F.lit(-1).alias("_round"), row)]
    rounds += [
        versions.select(key, F.col(names.hash).alias("_hash"), F.lit(n).alias("_round"), row)
        for n, (versions, _) in enumerate(snapshots)
    ]
    rows = rounds[0]
    for more in rounds[1:]:
        rows = rows.union(more)
    rows = rows.filter(F.col(key).isNotNull())
    by_round = Window.partitionBy(key).orderBy("_round")
    before, digest = F.lag("_round").over(by_round), F.lag("_hash").over(by_round)
    goes_on = before.eqNullSafe(F.col("_round") - 1) & digest.eqNullSafe(F.col("_hash"))
    marked = rows.withColumns(
        {"_begins": ~goes_on, "_before": before, "_last": F.max("_round").over(Window.partitionBy(key))}
    )
    # Of the rows that begin an island: it lasts until the row before the next one.
    islands = marked.filter("_begins").withColumn("_until", F.coalesce(F.lead("_before").over(by_round), "_last"))
    final = F.col("_until") == len(snapshots) - 1
    ends = F.get(F.array(*times), F.col("_until") + 1)
    changed = {names.valid_to: F.when(~final, ends), names.is_current: final}
    return islands.select(*[changed.get(c, F.col("_row")[c]).alias(c) for c in columns])


def scd2_apply(
    dimension: DataFrame,
    versions: DataFrame,
    key: str,
    batch_ts=None,
    names: ControlColumns = DEFAULT,
) -> DataFrame:
    """The dimension after a full snapshot.

    Keys that vanished or changed are closed, changed, new and returning keys
    are opened, unchanged keys keep their row and its untracked columns.
    """
    closed = dimension.filter(~F.col(names.is_current))
    current = dimension.filter(F.col(names.is_current))
    return closed.unionByName(scd2_step(current, versions, key, batch_ts, names))


def scd2_current(dimension: DataFrame, names: ControlColumns = DEFAULT) -> DataFrame:
    return dimension.filter(F.col(names.is_current))


def covers(ts: Column, names: ControlColumns = DEFAULT) -> Column:
    """Half-open test: start <= ts < end, an absent end being open."""
    return (ts >= F.col(names.valid_from)) & (
        F.col(names.valid_to).isNull() | (ts < F.col(names.valid_to))
    )


def scd2_as_of(dimension: DataFrame, ts, names: ControlColumns = DEFAULT) -> DataFrame:
    """The versions valid at one instant."""
    return dimension.filter(covers(instant(ts), names))


def changed_keys(
    before: DataFrame, after: DataFrame, key: str, tracked: Sequence[str]
) -> DataFrame:
    """Keys in both snapshots whose tracked columns differ, nulls compared as values."""
    old = before.select(key, *[F.col(c).alias(f"old_{c}") for c in tracked])
    new = after.select(key, *[F.col(c).alias(f"new_{c}") for c in tracked])
    return old.join(new, key).filter(
        tuple_differs([F.col(f"old_{c}") for c in tracked], [F.col(f"new_{c}") for c in tracked])
    )
