"""Bronze CSV readers, the landing append, and file sinks."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schema import ARRIVAL, SOURCE_FILE, Entity
from strata.sources.tables import Files

# One dialect for all readers and writers: a quote inside a quoted value is doubled, a backslash is a
# character like any other.  Blanks belong to the value; trimming is the conform step's work.
_DIALECT = {"header": "true", "quote": '"', "escape": '"'}
_CSV = {**_DIALECT, "mode": "FAILFAST", "enforceSchema": "false"}
#: Holds the text of a line that does not have the header's shape.
CORRUPT = "_corrupt"
# All columns are parsed, whichever are asked for, as a line is judged by all of them.  A quoted value goes on to a
# quote that ends it, so that one left open swallows the values after it and its line has too few.
_LENIENT = {
    **_CSV,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "columnPruning": "false",
    "unescapedQuoteHandling": "STOP_AT_CLOSING_QUOTE",
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Headered CSV files of one folder or glob; subfolders are not entered.

    A value that does not match the header's shape raises instead of shifting
    columns silently.  With ``multi_line`` values may hold line breaks inside
    quotes; a file is then one task's work, so keep such files small.
    """
    return spark.read.options(**_CSV, multiLine=multi_line).schema(schema).csv(path)


def read_csv_apart(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV files, and the lines that have too few or too many values.

    Where ``read_csv`` raises, this keeps such a line apart: ``line`` is its text, ``_source_file`` its file, and
    ``block_start`` and ``block_length`` say which bytes of the file it was read from.  A quote left open makes the
    rest of its line one value; in the last column that is no fault of shape.  A file whose header does not fit
    still raises.
    """
    lenient = _copy(schema).add(CORRUPT, "string")
    rows = spark.read.options(**_LENIENT, multiLine=multi_line).schema(lenient).csv(path)
    return split_corrupt(_with_origin(rows))


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leniently read rows without the corrupt ones, and those."""
    # Spark refuses a query that asks for nothing but the corrupt text, a count of such lines among them; naming the
    # file's other columns asks for them too.
    known = {CORRUPT, SOURCE_FILE, ARRIVAL, "_source_time", *_PLACE}
    rows = rows.filter(F.length(F.concat_ws("", *[c for c in rows.columns if c not in known])) >= 0)
    bad = rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), SOURCE_FILE, *_PLACE)
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, *_PLACE), bad


def read_full_load(spark: SparkSession, folder: str, entity: Entity) -> DataFrame:
    """The baseline files or the current snapshot of an entity, all columns as text."""
    return read_csv(spark, f"{folder}/*.csv", entity.raw_schema())


def read_change_files(spark: SparkSession, folder: str, entity: Entity) -> DataFrame:
    """All change files of a folder, with the file each row came from."""
    rows = read_csv(spark, f"{folder}/*.csv", entity.raw_schema(changes=True))
    return rows.withColumn(SOURCE_FILE, F.col("_metadata.file_name"))


def stream_csv(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    max_files: int | None = 1,
    archive: str | None = None,
    lenient: bool = False,
) -> DataFrame:
    """A file stream over a folder: each file is delivered once per checkpoint.

    Without ``max_files`` all files that are there make one batch.  ``lenient`` keeps lines
    that do not have the header's shape, for ``split_corrupt``; otherwise they end the stream.

    ``archive`` moves finished files there; exactly-once rests on the
    checkpoint, not on the move.
    """
    options, schema = (_LENIENT, _copy(schema).add(CORRUPT, "string")) if lenient else (_CSV, schema)
    reader = spark.readStream.options(**options).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return _with_origin(reader.csv(folder))


def read_csv_files(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Some CSV files with the columns that ``stream_csv`` gives their rows."""
    return _with_origin(spark.read.options(**_CSV).schema(schema).csv(paths))


_PLACE = ("block_start", "block_length")


def _copy(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields))


def _with_origin(rows: DataFrame) -> DataFrame:
    place = [F.col(f"_metadata.file_{c}").alias(c) for c in _PLACE] if CORRUPT in rows.columns else []
    return rows.select(
        "*",
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias("_source_time"),
        arrival().alias(ARRIVAL),
        *place,
    )


def arrival() -> Column:
    """What orders files: when each was last written, then its path."""
    return F.struct("_metadata.file_modification_time", "_metadata.file_path")


def land(spark: SparkSession, source: str, landing: str, entity: Entity, run_date: date) -> DataFrame:
    """Bring the CSV files of ``source`` into the landing table of the entity.

    Rows keep the file they came from and are partitioned by the day of arrival
    and the file, so landing a file of a day again replaces its rows.  A folder
    without CSV files raises.  Returns the landed day.
    """
    rows = read_csv(spark, f"{source}/*.csv", entity.raw_schema()).select(
        "*",
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.lit(run_date).alias("_ingest_date"),
    )
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_ingest_date", SOURCE_FILE).parquet(landing)
    landed = spark.read.schema(rows.schema).parquet(landing).select(*rows.columns)
    return landed.filter(F.col("_ingest_date") == F.lit(run_date))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Headered CSV; blanks around values are kept, as readers expect them."""
    df.write.mode(mode).options(
        **_DIALECT, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write a result and return its row count, from the same pass."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return seen.get["n"]


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Overwrite a snapshot folder, also with rows derived from that folder.

    The new rows are written beside the old, then the folders change names and the
    old one goes.  A crash on the way leaves the old rows, under their name or beside it.
    """
    path, token = path.rstrip("/"), uuid.uuid4().hex
    staged, old = f"{path}__new-{token}", f"{path}__old-{token}"
    write_csv(df, staged)
    files = Files(df.sparkSession, path)
    if files.exists(path):
        files.rename(path, old)
    files.rename(staged, path)
    files.delete(old)
    df.sparkSession.catalog.refreshByPath(path)
