"""Building the tables in order, each checked before the next one reads it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame

from strata.operators.history import scd2_step
from strata.operators.quality import CheckFailed, Related, Rule, is_row_rule, run_suite
from strata.plans import models as m
from strata.schema import PORTFOLIOS
from strata.sources.files import read_full_load
from strata.sources.tables import Files, Lakehouse
from strata.streaming.files import apply_change_files

MODES = ("run", "test", "build")


def _tables_of(rule: Rule) -> set[str]:
    return {rule.table, rule.parent} if isinstance(rule, Related) else {rule.table}


def build(
    lake: Lakehouse,
    bronze: str,
    batch_ts: datetime | None = None,
    mode: str = "build",
) -> list:
    """Run the models, the checks, or both, and return the check report rows.

    ``bronze`` holds ``orders/``, ``clients/``, ``inventory/`` and
    ``portfolios/`` with headered CSV files and change files in ``<entity>/cdc/``.
    A table without a version is loaded in full, otherwise the change files that
    no run has applied yet are, one after the other as they were written; which
    were is kept in ``_applied/`` beside the tables.  All audit and version times of a run are one instant.  In
    ``build`` the rules that a row alone can break are judged while a table is written, which is not shown if one is
    broken; all other rules of a table stop the run before a later table reads it.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    batch_ts = batch_ts or datetime.now(timezone.utc)
    version_ts = batch_ts.astimezone(timezone.utc).replace(tzinfo=None) if batch_ts.tzinfo else batch_ts
    report, done = [], set()

    def rules_of(name: str) -> list[Rule]:
        return [r for r in m.RULES if r.table == name and is_row_rule(r)] if mode == "build" else []

    def check(after: str, written: list | None = None) -> None:
        """All rules whose tables are now built, but for those that were judged by the write itself."""
        done.add(after)
        if mode == "run":
            return
        rules = [r for r in m.RULES if after in _tables_of(r) and _tables_of(r) <= done]
        if written:
            rules = [r for r in rules if not is_row_rule(r)]
            report.extend(written)
        tables = {t: _reader(lake, t) for r in rules for t in _tables_of(r)}
        rows = run_suite(tables, rules).collect() if rules else []  # one row per rule
        report.extend(rows)
        if mode == "build" and any(r["failures"] for r in rows):
            raise CheckFailed(rows)

    for name, entity in m.STAGED.items():
        written = _stage(lake, bronze, name, entity, batch_ts, rules_of(name)) if mode != "test" else None
        check(name, written)

    written = _dimension(lake, bronze, version_ts, rules_of(m.DIM_PORTFOLIO)) if mode != "test" else None
    check(m.DIM_PORTFOLIO, written)

    gold = lake.table(m.FCT_REVENUE)
    if mode != "test":
        revenue = m.fct_portfolio_revenue(
            _reader(lake, m.STG_ORDERS), _reader(lake, m.DIM_PORTFOLIO), version_ts
        )
        gold.overwrite(revenue, rules=rules_of(m.FCT_REVENUE))
    check(m.FCT_REVENUE, gold.report)
    return report


def _reader(lake: Lakehouse, name: str) -> DataFrame:
    return (lake.history(name) if name == m.DIM_PORTFOLIO else lake.table(name)).read()


def _stage(lake: Lakehouse, bronze: str, name: str, entity, batch_ts, rules: list[Rule]) -> list:
    """Load the table or bring in what has arrived; returns the report of its last write, if there was one."""
    table, folder = lake.table(name), f"{bronze}/{entity.name}"
    if not table.exists():
        raw = read_full_load(lake.spark, folder, entity)
        table.overwrite(m.staged_baseline(raw, entity, batch_ts), rules=rules)
        return table.report
    files = Files(lake.spark, folder)
    if not any(n.endswith(".csv") for n in files.names(f"{folder}/cdc")):
        return []
    stream = apply_change_files(
        lake.spark,
        f"{folder}/cdc",
        entity,
        table,
        f"{lake.root}/_applied/{name}",
        preserve=m.PRESERVED,
        clock=lambda: batch_ts,
        rules=rules,
    )
    try:
        stream.awaitTermination()
    except StreamingQueryException:
        if table.broken is not None:
            raise table.broken from None
        raise
    return table.report


def _dimension(lake: Lakehouse, bronze: str, version_ts, rules: list[Rule]) -> list:
    table = lake.history(m.DIM_PORTFOLIO)
    raw = read_full_load(lake.spark, f"{bronze}/{PORTFOLIOS.name}", PORTFOLIOS)
    if not table.exists():
        table.overwrite(m.portfolio_versions(raw), rules=rules)
        return table.report
    versions = m.portfolio_versions(raw, version_ts)
    table.advance(lambda present: scd2_step(present, versions, PORTFOLIOS.key, version_ts), rules=rules)
    return table.report
