"""Versioned parquet tables: a folder convention for stores without MERGE.

``<root>/<namespace>/<table>/data/v=<n>/w=<writer>/`` holds what a writer of
version n wrote and ``commits/<n>.json`` makes one of them visible.  A reader
takes the highest commit, so it never sees a half-written or missing table.
Creating the commit file fails if it exists, so of two writers one loses; its
rows lie in a folder of its own and harm nobody.
Where a table format is available, feed the same DataFrames to its MERGE.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import CheckFailed, Rule, watched


class Files:
    """The few file-system calls the layout needs, on whatever store the path names."""

    def __init__(self, spark: SparkSession, root: str):
        conf = spark._jsc.hadoopConfiguration()
        self._gateway, self._jvm = spark.sparkContext._gateway, spark._jvm
        self._fs = self._path(root).getFileSystem(conf)
        store = self._fs.makeQualified(self._path(root)).toUri()
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(store, conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._path(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(folder))]

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """Create a file that appears whole, failing if it is already there."""
        folder, name = path.rsplit("/", 1)
        draft = self._path(f"{folder}/.{name}.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        try:
            self._context.rename(draft, self._path(path), self._no_overwrite())
        except Exception:
            self._fs.delete(draft, False)
            raise

    def _no_overwrite(self):
        return self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def rename(self, path: str, to: str) -> None:
        """Give a folder a new name, failing if that is taken."""
        self._context.rename(self._path(path), self._path(to), self._no_overwrite())

    def size(self, path: str) -> int:
        """Bytes below a folder."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class Table:
    """A table replaced as a whole by each write.

    ``bucket_by=(column, n)`` stores the rows bucketed and sorted by a column:
    merges and joins on it then read the table without shuffling it.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        bucket_by: tuple[str, int] | None = None,
    ):
        self.spark = spark
        self.namespace, self.short_name = name.split(".")
        self.name = name
        self.path = f"{root.rstrip('/')}/{self.namespace}/{self.short_name}"
        self.bucket_by = bucket_by
        self._files = Files(spark, self.path)
        #: What the row rules of the last write found, one row per rule, and the error if they kept it back.
        self.report: list = []
        self.broken: CheckFailed | None = None

    # -- commits ---------------------------------------------------------
    def versions(self) -> list[int]:
        names = self._files.names(f"{self.path}/commits")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def exists(self) -> bool:
        return self.version() is not None

    def commit(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version is None:
            raise LookupError(f"{self.name} has no version yet")
        return json.loads(self._files.read_text(f"{self.path}/commits/{version}.json"))

    def last_batch(self) -> int | None:
        """The stream batch the current version came from."""
        return self.commit().get("batch") if self.exists() else None

    def _next(self) -> int:
        current = self.version()
        return 0 if current is None else current + 1

    def _folder(self, version: int, writer: str) -> str:
        return f"{self.path}/data/v={version}/w={writer}"

    def _publish(self, df: DataFrame, version: int, **entry) -> int:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        text = json.dumps({"version": version, "schema": ddl, **entry})
        self._files.create_text(f"{self.path}/commits/{version}.json", text)
        return version

    # -- data ------------------------------------------------------------
    def _holder(self, version: int, writer: str) -> str:
        """Catalog entry of what one writer wrote, which tells Spark its buckets."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}")
        place = hashlib.md5(self.path.encode()).hexdigest()[:8]
        return f"{self.namespace}.{self.short_name}__{place}_v{version}_{writer}"

    def read(self, version: int | None = None) -> DataFrame:
        entry = self.commit(version)
        if self.bucket_by is None:
            folder = self._folder(entry["version"], entry["writer"])
            return self.spark.read.schema(entry["schema"]).parquet(folder)
        return self.spark.table(self._external(self.spark, entry))

    def overwrite(self, df: DataFrame, batch: int | None = None, rules: Sequence[Rule] = ()) -> int:
        """Write ``df`` as the next version, also if it reads the present one.

        Row ``rules`` are judged while the rows are written; if one is broken, the rows go and ``CheckFailed`` is raised.
        """
        if self.bucket_by is not None:
            # One task per bucket writes one file per bucket, not one per task and bucket.
            column, n = self.bucket_by
            df = df.repartition(n, column)
        return self._write(df, batch, rules)

    def update(
        self, change: Callable[[DataFrame], DataFrame], batch: int | None = None, rules: Sequence[Rule] = ()
    ) -> int:
        """Write ``change(present rows)`` as the next version.

        The rows are written where the change left them: those of a bucketed
        table already sit in the task of their bucket.
        """
        return self._write(change(self.read()), batch, rules)

    def merge(
        self,
        keys: DataFrame,
        change: Callable[[DataFrame], DataFrame],
        batch: int | None = None,
        rules: Sequence[Rule] = (),
    ) -> int:
        """As ``update``, for a change that touches rows of ``keys`` only (its one column is the key)."""
        return self.update(change, batch, rules)

    def _write(self, df: DataFrame, batch: int | None, rules: Sequence[Rule] = ()) -> int:
        version, writer = self._next(), _new_writer()
        folder = self._folder(version, writer)
        rows, report = watched(df, rules)
        if self.bucket_by is None:
            rows.write.parquet(folder)
        else:
            column, n = self.bucket_by
            placed = rows.write.option("path", folder).bucketBy(n, column).sortBy(column)
            placed.saveAsTable(self._holder(version, writer))
        self._judge(report(), version, writer)
        return self._publish(df, version, writer=writer, batch=batch)

    def _judge(self, report: list, version: int, writer: str) -> None:
        """Keep back what breaks a rule: nobody can have seen it yet."""
        self.report, self.broken = report, None
        if any(r["failures"] for r in report):
            if self.bucket_by is not None:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._holder(version, writer)}")
            self._files.delete(self._folder(version, writer))
            self.broken = CheckFailed(report)
            raise self.broken

    def vacuum(self, keep: int = 1) -> list[int]:
        """Drop all but the last ``keep`` versions; returns the dropped ones."""
        if keep < 1:
            raise ValueError("keep at least one version")
        versions = self.versions()
        dropped, kept = versions[:-keep], versions[-keep:]
        for version in dropped:
            entry = self.commit(version)
            self._files.delete(f"{self.path}/commits/{version}.json")
            self._forget(entry, kept[0])
        return dropped

    def _forget(self, entry: dict, oldest_kept: int) -> None:
        version = entry["version"]
        self.spark.sql(f"DROP TABLE IF EXISTS {self._holder(version, entry['writer'])}")
        self._files.delete(f"{self.path}/data/v={version}")

    # -- catalog ---------------------------------------------------------
    def register(self, session: SparkSession | None = None) -> None:
        """Make the present version readable as ``namespace.table`` and ``table``.

        Each version has a catalog entry of its own and the names are views of it,
        replaced in one step: a session that reads the names meanwhile finds them.
        """
        spark = session or self.spark
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}")
        spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS {self._select(spark, self.commit())}")
        spark.table(self.name).createOrReplaceTempView(self.short_name)

    def _select(self, spark: SparkSession, entry: dict) -> str:
        return f"SELECT * FROM {self._external(spark, entry)}"

    def _parts_entry(self, spark: SparkSession, ddl: str, version: int, writer: str, by: str) -> str:
        """The catalog entry of a folder with parts; what a writer wrote does not change any more."""
        holder = self._holder(version, writer)
        column = by.split(" ")[0]
        more = "" if column == by else f", {by}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {holder} ({ddl}{more}) USING parquet "
            f"PARTITIONED BY ({column}) LOCATION '{self._folder(version, writer)}'"
        )
        try:
            spark.catalog.recoverPartitions(holder)
        except AnalysisException:
            pass  # this catalog lists the folders itself
        return holder

    def _external(self, spark: SparkSession, entry: dict) -> str:
        """The catalog entry of a version, made if it is not there."""
        buckets = ""
        if self.bucket_by is not None:
            column, n = self.bucket_by
            buckets = f"CLUSTERED BY ({column}) SORTED BY ({column}) INTO {n} BUCKETS"
        holder = self._holder(entry["version"], entry["writer"])
        folder = self._folder(entry["version"], entry["writer"])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {holder} ({entry['schema']}) USING parquet {buckets} "
            f"LOCATION '{folder}'"
        )
        return holder


class SlicedTable:
    """A table partitioned by a hash of its key into ``n`` slices; a merge reads and writes touched slices only.

    Spark's dynamic partition overwrite replaces the slices that a write has rows of, from rows of the same
    folder too, and leaves all others as they are.  Each written slice has one row without a key, so that a slice that
    lost its last row is replaced as well.  A write that is cut short is to be made again: merging a batch twice
    gives the same rows.  There are no older versions; readers that must not see a write happen read in between.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, key: str, n: int):
        self.spark, self.name, self.key, self.n = spark, name, key, n
        self.namespace, self.short_name = name.split(".")
        self.path = f"{root.rstrip('/')}/{self.namespace}/{self.short_name}"
        self._files = Files(spark, self.path)

    def exists(self) -> bool:
        return any(n.startswith("_slice=") for n in self._files.names(f"{self.path}/rows"))

    def _slice_of(self, column: str, kind: str):
        return F.pmod(F.xxhash64(F.col(column).cast(kind)), F.lit(self.n)).cast("int")

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def read(self, slices: Sequence[int] | None = None) -> DataFrame:
        rows = self._stored().filter(F.col(self.key).isNotNull())
        return (rows if slices is None else rows.filter(F.col("_slice").isin(list(slices)))).drop("_slice")

    def overwrite(self, df: DataFrame, batch: int | None = None) -> None:
        self._write(df, range(self.n), batch)

    def merge(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame], batch: int | None = None) -> None:
        """Write ``change(rows of the touched slices)``; it touches rows of ``keys`` only (its one column is the key)."""
        kind = self._stored().schema[self.key].dataType.simpleString()
        touched = keys.select(self._slice_of(keys.columns[0], kind).alias("k")).distinct()
        touched = sorted(r["k"] for r in touched.collect())  # at most n numbers
        if touched:
            self._write(change(self.read(touched)), touched, batch)

    def _write(self, df: DataFrame, slices: Sequence[int], batch: int | None) -> None:
        kind = df.schema[self.key].dataType.simpleString()
        marks = self.spark.createDataFrame([(k,) for k in slices], "_slice int")
        rows = df.withColumn("_slice", self._slice_of(self.key, kind)).unionByName(marks, allowMissingColumns=True)
        writer = rows.hint("rebalance", "_slice").write.mode("overwrite").partitionBy("_slice")
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/rows")
        if batch is not None:
            done = self.spark.createDataFrame([(batch,)], "batch long").coalesce(1)
            done.write.mode("overwrite").parquet(f"{self.path}/batch")

    def last_batch(self) -> int | None:
        """The stream batch that was written last; one that was cut short after its rows is merged again."""
        if not self._files.exists(f"{self.path}/batch/_SUCCESS"):
            return None
        return self.spark.read.parquet(f"{self.path}/batch").first()["batch"]

    def register(self, session: SparkSession | None = None) -> None:
        """Make the rows readable as ``namespace.table`` and ``table``."""
        spark = session or self.spark
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}")
        columns = ", ".join(f"`{f}`" for f in self._stored().columns if f != "_slice")
        holder = f"{self.namespace}.{self.short_name}__{hashlib.md5(self.path.encode()).hexdigest()[:8]}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {holder} USING parquet LOCATION '{self.path}/rows'")
        spark.catalog.recoverPartitions(holder)
        spark.catalog.refreshTable(holder)
        spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT {columns} FROM {holder} WHERE `{self.key}` IS NOT NULL")
        spark.table(self.name).createOrReplaceTempView(self.short_name)


class HistoryTable(Table):
    """A type-2 dimension: open versions are rewritten, closed ones only added.

    A round writes its rows once, partitioned by ``is_current``.  The present
    dimension is the open partition of the last round and the closed partitions
    of all rounds since the last full write, which the commit names; closed
    history is never read or written by a later round.
    """

    def __init__(self, spark: SparkSession, root: str, name: str):
        super().__init__(spark, root, name)

    def read(self, version: int | None = None) -> DataFrame:
        """The folders of the wanted rounds only, by their paths; older ones are not listed."""
        entry = self.commit(version)
        return self._part(entry, True).unionAll(self._part(entry, False))

    def open_versions(self, version: int | None = None) -> DataFrame:
        return self._part(self.commit(version), True)

    def closed_versions(self, version: int | None = None) -> DataFrame:
        return self._part(self.commit(version), False)

    def _part(self, entry: dict, current: bool) -> DataFrame:
        """The open versions of the last round, or the closed ones of all rounds."""
        rounds = entry["rounds"][-1:] if current else entry["rounds"]
        part = f"is_current={str(current).lower()}"
        paths = [f"{self._folder(v, writer)}/{part}" for v, writer, parts in rounds if part in parts]
        if not paths:
            return self.spark.createDataFrame([], entry["schema"])
        stored = T.StructType([f for f in _fields(entry["schema"]) if f.name != "is_current"])
        rows = self.spark.read.schema(stored).parquet(*paths)
        return rows.withColumn("is_current", F.lit(current)).select(*_names(entry["schema"]))

    def _write_round(self, df: DataFrame, rounds: list, batch: int | None, rules: Sequence[Rule]) -> int:
        version, writer = self._next(), _new_writer()
        folder = self._folder(version, writer)
        rows, report = watched(df, rules)
        rows.write.partitionBy("is_current").parquet(folder)
        self._judge(report(), version, writer)
        # Which parts a round has is noted once, so that no reader asks the store for each of them.
        parts = sorted(n for n in self._files.names(folder) if n.startswith("is_current="))
        rounds = [*rounds, [version, writer, parts]]
        return self._publish(df, version, writer=writer, rounds=rounds, batch=batch)

    def overwrite(self, df: DataFrame, batch: int | None = None, rules: Sequence[Rule] = ()) -> int:
        return self._write_round(df, [], batch, rules)

    def advance(
        self, step: Callable[[DataFrame], DataFrame], batch: int | None = None, rules: Sequence[Rule] = ()
    ) -> int:
        """Apply ``step`` to the open versions: its open rows replace them, its
        closed rows join the history.  ``rules`` are judged on the rows of this round."""
        rounds = self.commit()["rounds"]
        return self._write_round(step(self.open_versions()), rounds, batch, rules)

    def _forget(self, entry: dict, oldest_kept: int) -> None:
        # The closed versions of a round stay while a kept version has it among its rounds.
        version, writer = entry["version"], entry["writer"]
        if [version, writer] in [r[:2] for r in self.commit(oldest_kept)["rounds"]]:
            self._files.delete(f"{self._folder(version, writer)}/is_current=true")
        else:
            self._files.delete(f"{self.path}/data/v={version}")

    def _select(self, spark: SparkSession, entry: dict) -> str:
        columns = ", ".join(f"`{c}`" for c in _names(entry["schema"]))
        parts = []
        for v, writer, _ in entry["rounds"]:
            holder = self._parts_entry(spark, entry["schema"], v, writer, "is_current")
            wanted = "" if v == entry["version"] else " WHERE NOT is_current"
            parts.append(f"SELECT {columns} FROM {holder}{wanted}")
        return " UNION ALL ".join(parts)


def _new_writer() -> str:
    return uuid.uuid4().hex[:12]


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def _names(ddl: str) -> list[str]:
    return [f.name for f in _fields(ddl)]


class Lakehouse:
    """The tables of one root folder, by ``namespace.table`` name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str, bucket_by: tuple[str, int] | None = None) -> Table:
        return Table(self.spark, self.root, name, bucket_by)

    def sliced(self, name: str, key: str, n: int) -> SlicedTable:
        return SlicedTable(self.spark, self.root, name, key, n)

    def history(self, name: str) -> HistoryTable:
        return HistoryTable(self.spark, self.root, name)
