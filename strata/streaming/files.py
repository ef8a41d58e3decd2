"""Change files and snapshot files applied in order of arrival, each once.

``foreachBatch`` may deliver a batch again after a failure, so each table
version records the batch it came from and a batch already recorded is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.changes import merge_changes
from strata.operators.conform import conform
from strata.operators.history import scd2_backlog, scd2_step
from strata.operators.quality import Rule
from strata.schema import ARRIVAL, Entity
from strata.sources.files import CORRUPT, read_csv_files, split_corrupt, stream_csv
from strata.sources.tables import HistoryTable, Table


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _run(
    rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Drain what has arrived, batch by batch, then stop."""
    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _seen(table: Table, batch_id: int) -> bool:
    last = table.last_batch()
    return last is not None and batch_id <= last


def apply_change_files(
    spark: SparkSession,
    folder: str,
    entity: Entity,
    table: Table,
    checkpoint: str,
    preserve: Sequence[str] = (),
    max_files: int = 100,
    archive: str | None = None,
    clock: Callable[[], datetime] | None = _utc_now,
    extra: Sequence[str] = (),
    rejects: str | None = None,
    once_by: Sequence[str] = (),
    within: str = "7 days",
    rules: Sequence[Rule] = (),
) -> StreamingQuery:
    """Merge the change files of a folder into a table that has a baseline.

    Files count in the order in which they were last written, those of one instant by
    their path, each as a batch of its own.  ``max_files`` says how many are merged
    by one write of the table and changes no row.  Inside a file a key's last
    row by the ``extra`` columns wins.

    ``rejects`` names a folder for lines that do not have the header's shape, each batch's beside
    the others'; without it they end the stream.  ``once_by``, ``within`` and
    ``rules`` are those of ``merge_stream``.
    """
    schema = entity.raw_schema(changes=True)
    for c in extra:
        schema = schema.add(c, "string")
    rows = stream_csv(spark, folder, schema, max_files, archive, lenient=rejects is not None)
    return merge_stream(
        rows, entity, table, checkpoint, preserve, clock, extra, ARRIVAL, rejects, once_by, within, rules
    )


def merge_stream(
    rows: DataFrame,
    entity: Entity,
    table: Table,
    checkpoint: str,
    preserve: Sequence[str] = (),
    clock: Callable[[], datetime] | None = _utc_now,
    order_by: Sequence[str] = (),
    sequence: str | None = None,
    rejects: str | None = None,
    once_by: Sequence[str] = (),
    within: str = "7 days",
    rules: Sequence[Rule] = (),
) -> StreamingQuery:
    """Merge any stream of raw change rows into a table that has a baseline.

    ``sequence`` orders the batches that one micro-batch may hold, ``order_by``
    the rows of a key inside each.

    ``once_by`` names columns (the key and the source's own sequence number, say) that tell one change
    from another, for sources that deliver a change again in a later batch or run: it counts the first time only.
    What was taken in is remembered in Spark's state store for ``within``, counted from when it arrived, so the
    state holds the changes of that span and no row is ever late.

    ``rejects`` names a folder for the corrupt lines of a leniently read stream.

    Row ``rules`` that a batch would break end the stream before the table shows the batch.
    """
    keep = [*order_by, *([sequence] if sequence else [])]
    if once_by:
        # Corrupt lines have no columns to tell them apart by, but their own text.
        told = [*once_by, *([CORRUPT] if rejects else [])]
        rows = rows.withColumn("_taken_at", F.current_timestamp()).withWatermark("_taken_at", within)
        rows = rows.dropDuplicatesWithinWatermark(told).drop("_taken_at")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if rejects is None and not once_by:
            merge(batch, batch_id)
            return
        # Read more than once: as a batch with state may not be, and so that files are not parsed again.
        batch.persist()
        try:
            rows = batch
            if rejects is not None:
                rows, bad = split_corrupt(batch)
                # A batch that is delivered again replaces its lines.
                bad.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            # A batch may only move the state's time on, or bring nothing new.
            if not (once_by and rows.isEmpty()):
                merge(rows, batch_id)
        finally:
            batch.unpersist()

    def merge(batch: DataFrame, batch_id: int) -> None:
        if _seen(table, batch_id):
            return
        changes = conform(batch, entity, clock() if clock else None, changes=True, keep=keep)
        # The merge may read the batch more than once.
        changes.persist()
        try:
            table.merge(
                changes.select(entity.key),
                lambda present: merge_changes(
                    present,
                    changes,
                    entity.key,
                    preserve=preserve,
                    order_by=list(order_by),
                    sequence=sequence,
                ),
                batch=batch_id,
                **({"rules": rules} if rules else {}),
            )
        finally:
            changes.unpersist()

    return _run(rows, apply, checkpoint)


def apply_snapshot_files(
    spark: SparkSession,
    folder: str,
    entity: Entity,
    table: HistoryTable,
    checkpoint: str,
    to_versions: Callable[[DataFrame, object], DataFrame],
    archive: str | None = None,
    batch_ts: Callable[[DataFrame], object] | None = None,
    by_folder: bool = False,
) -> StreamingQuery:
    """Apply full snapshots to a dimension in the order they were written, each a round of its own.

    A snapshot is one file of ``folder`` or, ``by_folder``, all files of one folder in
    it, which must arrive whole (as a committed write does).  ``to_versions(rows, ts)``
    builds the open versions of a snapshot; ``batch_ts(rows)`` gives the instant it
    counts from, by default when it was last written.  The first snapshot of a new
    table loads it.  All folders that wait are applied in one pass and one write of the table.
    A batch that is delivered again after a failure finds its snapshots applied and changes nothing.
    """
    if by_folder:
        rows = stream_csv(spark, f"{folder}/*", entity.raw_schema(), None, archive)
    else:
        rows = stream_csv(spark, folder, entity.raw_schema(), 1, archive)

    def moment(batch: DataFrame):
        if batch_ts is not None:
            return batch_ts(batch)
        return batch.agg(F.max("_source_time")).first()[0]

    def apply(batch: DataFrame, batch_id: int) -> None:
        if _seen(table, batch_id):
            return
        if not by_folder:
            round_of(batch, batch_id)
            return
        path = F.col(f"{ARRIVAL}.file_path")
        place = F.regexp_replace(path, "/[^/]*$", "")
        found = batch.groupBy(place.alias("place")).agg(F.max("_source_time").alias("at"), F.collect_set(path).alias("files"))
        # One row per snapshot.  Each reads its own files, so that no snapshot reads those of all others.
        found = found.orderBy("at", "place").collect()
        waiting = [read_csv_files(spark, sorted(r["files"]), entity.raw_schema()) for r in found]
        if len(waiting) == 1 or not table.exists():
            # The batch counts as seen with its last snapshot.
            round_of(waiting[0], batch_id if len(waiting) == 1 else None)
            waiting = waiting[1:]
        if waiting:
            times = [moment(snapshot) for snapshot in waiting]
            rounds = [(to_versions(snapshot, ts), ts) for snapshot, ts in zip(waiting, times)]
            table.advance(lambda present: scd2_backlog(present, rounds, entity.key), batch=batch_id)

    def round_of(snapshot: DataFrame, batch_id: int | None) -> None:
        if not table.exists():
            table.overwrite(to_versions(snapshot, None), batch=batch_id)
            return
        ts = moment(snapshot)
        versions = to_versions(snapshot, ts)
        table.advance(
            lambda present: scd2_step(present, versions, entity.key, batch_ts=ts),
            batch=batch_id,
        )

    return _run(rows, apply, checkpoint)
