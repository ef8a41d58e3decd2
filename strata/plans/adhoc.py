"""Read-only ad-hoc SQL as jobs with a status log."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.keyed import fold_latest
from strata.sources.files import write_parquet
from strata.sources.tables import Table

PREVIEW_ROWS = 500
RECENT_JOBS = 20

LOG_SCHEMA = T.StructType(
    [
        T.StructField("job_id", T.StringType(), False),
        T.StructField("sql", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("submitted_at", T.TimestampType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("result_key", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("logged_at", T.TimestampType(), False),
        T.StructField("step", T.IntegerType(), False),
    ]
)

# What can hide a keyword or an end mark from a first look at the text.  In a raw string a backslash hides nothing.
_COMMENT = r"--[^\n]*|/\*(?s:.*?)\*/"
_RAW = r"""(?<![A-Za-z0-9_])[rR](?:'[^']*'|"[^"]*")"""
_TEXT = r"""'(?s:[^'\\]|\\.)*'|"(?s:[^"\\]|\\.)*\""""
_NOISE = re.compile(rf"(?P<comment>{_COMMENT})|(?P<text>{_RAW}|{_TEXT})|`(?P<name>[^`]*)`")
# What a SELECT could use to reach outside the tables, or to call a function by a name that it makes up.
_LEAVES = r"\b(reflect|try_reflect|java_method|identifier)\s*\(|\busing\s*''"
_REFUSED = re.compile(_LEAVES, re.IGNORECASE)
#: Stands between code and what is none while a column of texts is judged; elsewhere it counts as a blank.
_FENCE = "\u0001"
_BLANK = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


class NotReadOnly(ValueError):
    """The text is not one read-only query."""


def _plain(found: re.Match) -> str:
    if found["comment"]:
        return " "
    if found["text"]:
        return "''"
    return re.sub(r"\W", "_", found["name"])


def check_read_only(sql: str) -> str:
    """The single SELECT or WITH statement in ``sql``, without its end mark.

    A filter that needs no session; beside it ``as_subquery`` keeps a statement from writing.
    """
    bare = _NOISE.sub(_plain, sql.replace(_FENCE, " ")).strip(_BLANK)
    body = bare.rstrip("; \t\r\n")
    word = re.match(r"\(*\s*([A-Za-z]*)", body)
    first = word[1].lower() if word else ""
    if first not in ("select", "with"):
        raise NotReadOnly(f"a query starts with SELECT or WITH, not with {first or 'nothing'!r}")
    if ";" in body:
        raise NotReadOnly("one statement per job")
    if _REFUSED.search(body):
        raise NotReadOnly("functions and scripts that leave the tables are refused")
    return _drop_end(sql)


def verdicts(sql: str | Column) -> Column:
    """Whether ``check_read_only`` accepts a text, for columns of texts: job logs, saved queries.

    The same patterns in the same order: comments, quoted texts and quoted names are fenced off from the code first.
    """
    fence = _FENCE
    noise = rf"""({_COMMENT})|((?:{_RAW}|{_TEXT}))|`([^`]*)`"""
    clean = F.translate(sql, fence, " ")
    # Between two pieces of code: the comment, the text and the name that stood there, two of them absent.
    marked = F.regexp_replace(clean, noise, rf"{fence}$1{fence}$2{fence}$3{fence}")
    absent = F.lit("")
    code = F.transform(
        F.split(marked, fence, -1),
        lambda x, k: F.when(k % 4 == 0, x)
        .when(k % 4 == 1, F.when(x != "", F.lit(" ")).otherwise(absent))
        .when(k % 4 == 2, F.when(x != "", F.lit("''")).otherwise(absent))
        .otherwise(F.regexp_replace(x, r"\W", "_")),
    )
    body = F.rtrim(F.trim(F.array_join(code, ""), F.lit(_BLANK)), F.lit("; \t\r\n"))
    first = F.lower(F.regexp_extract(body, r"^\(*\s*([A-Za-z]*)", 1))
    leaves = body.rlike("(?i)" + _LEAVES)
    return F.coalesce(first.isin("select", "with") & ~F.contains(body, F.lit(";")) & ~leaves, F.lit(False))


def _drop_end(sql: str) -> str:
    """``sql`` without the end marks after its last token."""
    last = 0
    pos = 0
    for m in _NOISE.finditer(sql):
        between = sql[pos : m.start()].rstrip("; \t\r\n")
        if between:
            last = pos + len(between)
        if not m["comment"]:
            last = m.end()
        pos = m.end()
    tail = sql[pos:].rstrip("; \t\r\n")
    return sql[: pos + len(tail)] if tail else sql[:last]


def as_subquery(sql: str) -> str:
    """A statement that writes cannot parse inside a FROM clause."""
    return f"SELECT * FROM (\n{sql}\n)"


def read_only_session(spark: SparkSession, tables: Iterable[Table] = ()) -> SparkSession:
    """A session of its own where the tables resolve as ``silver.x`` and ``x``,
    and where a path cannot be named as a table."""
    session = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(name, spark.conf.get(name))
    for table in tables:
        table.register(session)
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    return session


def query(session: SparkSession, sql: str) -> DataFrame:
    """The rows of a read-only query."""
    return session.sql(as_subquery(check_read_only(sql)))


def new_job_id() -> str:
    return uuid.uuid4().hex


def is_job_id(text: str) -> bool:
    """Whether ``text`` can be a job's id, and so a safe part of a path."""
    return re.fullmatch(r"[0-9a-f]{32}", text) is not None


class JobLog:
    """Status events, appended; the last value of each field counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def append(self, job_id: str, status: str, step: int, **fields) -> None:
        row = {f.name: fields.get(f.name) for f in LOG_SCHEMA}
        row |= {"job_id": job_id, "status": status, "step": step}
        row["logged_at"] = datetime.now(timezone.utc)
        event = self.spark.createDataFrame([tuple(row.values())], LOG_SCHEMA)
        event.coalesce(1).write.mode("append").parquet(self.path)

    def events(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)

    def text(self, job_id: str) -> str:
        """The SQL a job was submitted with."""
        if not is_job_id(job_id):
            raise ValueError("not a job id")
        seen = self.events().filter((F.col("job_id") == job_id) & F.col("sql").isNotNull())
        row = seen.orderBy("logged_at").select("sql").first()
        if row is None:
            raise LookupError(f"no job {job_id} was submitted")
        return row["sql"]

    def runs(self) -> DataFrame:
        return fold_runs(self.events())

    def recent(self, n: int = RECENT_JOBS) -> DataFrame:
        return recent_runs(self.runs(), n)

    def status(self, job_id: str) -> DataFrame:
        """The state of one job as a JSON record; no row for an unknown id."""
        if not is_job_id(job_id):
            raise ValueError("not a job id")
        run = fold_runs(self.events().filter(F.col("job_id") == job_id))
        return run.select("job_id", F.to_json(F.struct(*run.columns)).alias("record"))


def fold_runs(events: DataFrame, order_by: Sequence[str] = ("logged_at", "step")) -> DataFrame:
    """One row per job: the last status, and the last non-null value of every other field."""
    columns = [c for c in events.columns if c not in ("job_id", *order_by)]
    return fold_latest(events, "job_id", order_by, columns, overwrite=("status",))


def recent_runs(runs: DataFrame, n: int = RECENT_JOBS) -> DataFrame:
    """The ``n`` latest jobs, newest first."""
    return runs.orderBy(F.col("submitted_at").desc_nulls_last(), "job_id").limit(n)


def by_name(table: DataFrame, name: str = "name") -> DataFrame:
    """All rows in name order; rows of one name by their other columns, so that
    a frequent name does not sort in one task."""
    rest = [F.col(c).asc_nulls_last() for c in table.columns if c != name]
    return table.orderBy(F.col(name).asc_nulls_last(), *rest)


def preview(result: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows with every value a display format cannot carry as text."""
    plain = (T.StringType, T.BooleanType, T.IntegralType, T.DoubleType, T.FloatType)
    columns = [
        F.col(f"`{f.name}`")
        if isinstance(f.dataType, plain)
        else F.col(f"`{f.name}`").cast("string").alias(f.name)
        for f in result.schema
    ]
    return result.limit(n).select(*columns)


def submit(log: JobLog, sql: str) -> str:
    """Check a query and enter it in the log; a refused text gets no job."""
    check_read_only(sql)
    job_id = new_job_id()
    log.append(job_id, "queued", 0, sql=sql, submitted_at=datetime.now(timezone.utc))
    return job_id


def run_job(
    spark: SparkSession,
    log: JobLog,
    job_id: str,
    results: str,
    tables: Iterable[Table] = (),
) -> str:
    """Run the query that a job was submitted with, store its rows, and log how it went.

    Returns the final status.  A failing query is a status too and does not raise; an id
    that was never submitted does.
    """
    sql = log.text(job_id)
    started = datetime.now(timezone.utc)
    log.append(job_id, "running", 1, started_at=started)
    try:
        rows = query(read_only_session(spark, tables), sql)
        repeated = sorted({c for c in rows.columns if rows.columns.count(c) > 1})
        if repeated:
            raise NotReadOnly(f"result columns need names of their own: {repeated}")
        key = f"{job_id}/result.parquet"
        count = write_parquet(rows, f"{results}/{key}")
    except Exception as problem:
        log.append(
            job_id, "failed", 2, finished_at=datetime.now(timezone.utc), error=str(problem)
        )
        return "failed"
    log.append(
        job_id,
        "succeeded",
        2,
        finished_at=datetime.now(timezone.utc),
        row_count=count,
        result_key=key,
    )
    return "succeeded"


def read_result(spark: SparkSession, results: str, job_id: str) -> DataFrame:
    """The stored rows of a finished job."""
    if not is_job_id(job_id):
        raise ValueError("not a job id")
    return spark.read.parquet(f"{results}/{job_id}/result.parquet")
