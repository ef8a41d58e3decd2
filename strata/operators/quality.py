"""Data-quality rules: each returns the offending rows, none means it holds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F

from strata.functions.columns import slot_of
from strata.operators.changes import check_batch
from strata.operators.history import DEFAULT, ControlColumns, changed_keys
from strata.schema import OP

__all__ = [
    "Accepted",
    "CheckFailed",
    "CurrentFlag",
    "NoOverlap",
    "NotNull",
    "Related",
    "Unique",
    "accepted_failures",
    "assert_population",
    "check_batch",
    "current_flag_failures",
    "not_null_failures",
    "orphan_failures",
    "overlap_failures",
    "population",
    "reconcile_counts",
    "run_suite",
    "unique_failures",
    "version_growth",
    "watched",
]


def unique_failures(df: DataFrame, column: str | Sequence[str], where: str | None = None) -> DataFrame:
    """Values that occur more than once; nulls are not compared."""
    columns = [column] if isinstance(column, str) else list(column)
    rows = df.filter(where) if where else df
    return (
        rows.dropna(subset=columns)
        .groupBy(*columns)
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def _unaccepted(column: str, values: Sequence[str]) -> Column:
    return ~F.col(column).isin(*values)


def accepted_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their count; null passes."""
    return (
        df.filter(_unaccepted(column, values))
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )


def orphan_failures(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Foreign keys without a parent with their row count; null passes.

    Children are counted per key before the join, so a key shared by many rows
    crosses the shuffle as one row per map task.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


def overlap_failures(
    dimension: DataFrame, key: str, names: ControlColumns = DEFAULT, slot: str = "month"
) -> DataFrame:
    """Versions that run into their successor or were left open before one.

    Gaps are allowed.  The successor's start is looked up inside a calendar
    slot of the key, and across slots from the first start of each slot, so no
    task holds a whole key however many versions it has.
    """
    start, end = names.valid_from, names.valid_to
    rows = dimension.select(key, start, end).withColumn("_slot", slot_of(start, slot))
    inside = Window.partitionBy(key, "_slot").orderBy(start, F.col(end).asc_nulls_last())
    across = Window.partitionBy(key).orderBy("_slot")
    firsts = rows.groupBy(key, "_slot").agg(F.min(start).alias("_first"))
    following = firsts.select(
        F.col(key).alias("_key"),
        F.col("_slot").alias("_of"),
        F.lead("_first").over(across).alias("_next_slot_start"),
    )
    return (
        rows.withColumn("_next_here", F.lead(start).over(inside))
        # Versions without a key are checked against each other too.
        .join(following, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slot") == F.col("_of")))
        .withColumn("next_valid_from", F.coalesce("_next_here", "_next_slot_start"))
        .filter(
            F.col("next_valid_from").isNotNull()
            & (F.col(end).isNull() | (F.col(end) > F.col("next_valid_from")))
        )
        .select(key, start, end, "next_valid_from")
    )


def _flag_wrong(names: ControlColumns) -> Column:
    # A version is current exactly when it has no end.
    return F.col(names.is_current) != F.col(names.valid_to).isNull()


def current_flag_failures(dimension: DataFrame, names: ControlColumns = DEFAULT) -> DataFrame:
    """Versions whose flag disagrees with their end."""
    return dimension.filter(_flag_wrong(names))


def population(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """One row: rows out, keys out, keys in, and whether all three agree."""
    keys_in = before.agg(F.count_distinct(key)).scalar()
    return after.agg(
        F.count("*").alias("rows_out"), F.count_distinct(key).alias("keys_out")
    ).select(
        "rows_out",
        "keys_out",
        keys_in.alias("keys_in"),
        ((F.col("rows_out") == F.col("keys_out")) & (F.col("keys_out") == keys_in)).alias("holds"),
    )


def assert_population(before: DataFrame, after: DataFrame, key: str) -> None:
    found = population(before, after, key).first()
    if not found["holds"]:
        raise ValueError(
            f"snapshot does not keep its population: {found['rows_out']} rows and "
            f"{found['keys_out']} keys out, {found['keys_in']} keys in"
        )


def reconcile_counts(
    before: DataFrame, after: DataFrame, changes: DataFrame, op: str = OP
) -> DataFrame:
    """One row: rows after a batch against rows before - deletes + inserts."""
    ops = changes.agg(
        F.count_if(F.col(op) == "D").alias("deletes"),
        F.count_if(F.col(op) == "I").alias("inserts"),
    )
    n_before = before.agg(F.count("*")).scalar()
    n_after = after.agg(F.count("*")).scalar()
    return ops.select(
        n_before.alias("rows_before"),
        "deletes",
        "inserts",
        (n_before - F.col("deletes") + F.col("inserts")).alias("rows_expected"),
        n_after.alias("rows_after"),
    ).withColumn("balanced", F.col("rows_expected") == F.col("rows_after"))


def version_growth(
    snapshot_before: DataFrame,
    snapshot_after: DataFrame,
    dimension_before: DataFrame,
    dimension_after: DataFrame,
    key: str,
    tracked: Sequence[str],
) -> DataFrame:
    """One row: versions added by a round against changed plus new keys."""
    changed = changed_keys(snapshot_before, snapshot_after, key, tracked).agg(F.count("*")).scalar()
    arrived = (
        snapshot_after.select(key)
        .join(snapshot_before.select(key), key, "left_anti")
        .agg(F.count("*"))
        .scalar()
    )
    before = dimension_before.agg(F.count("*")).scalar()
    return (
        dimension_after.agg(F.count("*").alias("_after"))
        .select(
            (F.col("_after") - before).alias("versions_added"),
            changed.alias("keys_changed"),
            arrived.alias("keys_arrived"),
        )
        .withColumn(
            "holds", F.col("versions_added") == F.col("keys_changed") + F.col("keys_arrived")
        )
    )


@dataclass(frozen=True)
class Unique:
    table: str
    column: str
    where: str | None = None


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Accepted:
    table: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Related:
    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class NoOverlap:
    table: str
    column: str


@dataclass(frozen=True)
class CurrentFlag:
    table: str
    column: str = "is_current"


Rule = Unique | NotNull | Accepted | Related | NoOverlap | CurrentFlag


def _row_condition(rule: Rule) -> Column | None:
    if isinstance(rule, NotNull):
        return F.col(rule.column).isNull()
    if isinstance(rule, Accepted):
        return _unaccepted(rule.column, rule.values)
    if isinstance(rule, CurrentFlag):
        return _flag_wrong(DEFAULT)
    return None


class CheckFailed(Exception):
    """A quality rule found offending rows."""

    def __init__(self, report: Sequence):
        failed = [r for r in report if r["failures"]]
        texts = [f"{r['rule']} on {r['table_name']}.{r['column_name']}: {r['failures']}" for r in failed]
        super().__init__("; ".join(texts))


def is_row_rule(rule: Rule) -> bool:
    """Whether a row alone can break the rule, so that it can be judged while rows are written."""
    return _row_condition(rule) is not None


def watched(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Callable[[], list[Row]]]:
    """``df``, and what gives its report on the row rules once it has been written: no scan of its own.

    The report's rows are those of ``run_suite``.  A task that runs again may count rows twice, never miss one.
    """
    own = [r for r in rules if is_row_rule(r)]
    if not own:
        return df, list
    seen = Observation()
    df = df.observe(seen, *[F.count_if(_row_condition(r)).alias(f"_{i}") for i, r in enumerate(own)])

    def report() -> list[Row]:
        counts = seen.get
        return [
            Row(rule=_NAMES[type(r)], table_name=r.table, column_name=r.column, failures=counts[f"_{i}"])
            for i, r in enumerate(own)
        ]

    return df, report


_NAMES = {
    Unique: "unique",
    NotNull: "not_null",
    Accepted: "accepted_values",
    Related: "relationships",
    NoOverlap: "no_overlap",
    CurrentFlag: "current_flag",
}


def _entry(rule: Rule, failures: Column) -> list[Column]:
    return [
        F.lit(_NAMES[type(rule)]).alias("rule"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.column).alias("column_name"),
        failures.cast("bigint").alias("failures"),
    ]


def run_suite(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """A report with one row per rule: rule, table_name, column_name, failures.

    All row rules of a table share one scan and one aggregate, and so do all rules
    on its keys: their columns are turned into rows of (rule, value) and counted at
    once.  Values of a key are compared as text.
    """
    parts = []
    for table, df in tables.items():
        row_rules = [r for r in rules if r.table == table and _row_condition(r) is not None]
        if row_rules:
            counts = df.agg(
                *[F.count_if(_row_condition(r)).alias(f"_{i}") for i, r in enumerate(row_rules)]
            )
            entries = [F.struct(*_entry(r, F.col(f"_{i}"))) for i, r in enumerate(row_rules)]
            parts.append(counts.select(F.inline(F.array(*entries))))
        key_rules = [r for r in rules if r.table == table and isinstance(r, Unique | Related)]
        if key_rules:
            parts.append(_key_report(df, key_rules, tables))
    for r in rules:
        if isinstance(r, NoOverlap):
            found = overlap_failures(tables[r.table], r.column).agg(F.count("*").alias("_n"))
            parts.append(found.select(*_entry(r, F.col("_n"))))
    return reduce(DataFrame.unionByName, parts)


def _key_report(df: DataFrame, rules: Sequence[Unique | Related], tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of the report for all rules on the keys of one table."""

    def value(i: int, column: str, where: str | None = None) -> Column:
        text = F.col(column).cast("string")
        return F.struct(F.lit(i).alias("rule"), (F.when(F.expr(where), text) if where else text).alias("value"))

    entries = [value(i, r.column, r.where if isinstance(r, Unique) else None) for i, r in enumerate(rules)]
    rows = df.select(F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
    counted = rows.groupBy("rule", "value").agg(F.count("*").alias("n"))
    found = []
    unique = [(i, r) for i, r in enumerate(rules) if isinstance(r, Unique)]
    if unique:
        repeated = counted.agg(
            *[F.count_if((F.col("rule") == i) & (F.col("n") > 1)).alias(f"_{i}") for i, _ in unique]
        )
        found.append((repeated, unique))
    related = [(i, r) for i, r in enumerate(rules) if isinstance(r, Related)]
    if related:
        parents = reduce(
            DataFrame.unionAll,
            [tables[r.parent].select(F.inline(F.array(value(i, r.parent_column)))) for i, r in related],
        ).distinct()
        references = counted.filter(F.col("rule").isin([i for i, _ in related]))
        orphans = references.join(parents, ["rule", "value"], "left_anti")
        sums = [F.sum(F.when(F.col("rule") == i, F.col("n"))) for i, _ in related]
        lost = orphans.agg(*[F.coalesce(s, F.lit(0)).alias(f"_{i}") for s, (i, _) in zip(sums, related)])
        found.append((lost, related))
    reports = [
        one.select(F.inline(F.array(*[F.struct(*_entry(r, F.col(f"_{i}"))) for i, r in own]))) for one, own in found
    ]
    return reduce(DataFrame.unionByName, reports)
