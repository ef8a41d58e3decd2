"""Lakehouse table operators for PySpark.

Every operator takes DataFrames and returns a lazy DataFrame.  Only the table
layer, the streams, the ad-hoc jobs and the pipeline run Spark actions.
"""

from strata.functions.columns import (
    change_hash,
    clean,
    differs,
    draw,
    instant,
    month_of,
    version_key,
)
from strata.operators.attribution import (
    attribution_shift,
    current_join,
    point_in_time_join,
)
from strata.operators.changes import (
    check_batch,
    diff_snapshots,
    exclusive_split,
    merge_changes,
    op_counts,
)
from strata.operators.conform import conform, split_rejects
from strata.operators.dedup import first_per_key
from strata.operators.digests import diff_by_digests, range_digests
from strata.operators.distinct import count_members, distinct_bitmaps, merge_bitmaps
from strata.operators.history import (
    ControlColumns,
    as_versions,
    changed_keys,
    scd2_apply,
    scd2_as_of,
    scd2_backlog,
    scd2_current,
    scd2_initial,
    scd2_step,
)
from strata.operators.hierarchy import dense_index, extend_index, parent_catalog, propagate_parents
from strata.operators.keyed import insert_unique, patch_rows, resolve_unique
from strata.operators.rollup import portfolio_revenue
from strata.operators.rollup_parts import fold_parts, moved_since, revenue_delta, revenue_of_parts, revenue_parts

__all__ = [
    "ControlColumns",
    "as_versions",
    "attribution_shift",
    "change_hash",
    "changed_keys",
    "check_batch",
    "clean",
    "conform",
    "count_members",
    "current_join",
    "dense_index",
    "diff_by_digests",
    "diff_snapshots",
    "differs",
    "distinct_bitmaps",
    "draw",
    "exclusive_split",
    "extend_index",
    "first_per_key",
    "fold_parts",
    "insert_unique",
    "instant",
    "merge_bitmaps",
    "merge_changes",
    "month_of",
    "moved_since",
    "op_counts",
    "parent_catalog",
    "patch_rows",
    "point_in_time_join",
    "portfolio_revenue",
    "propagate_parents",
    "range_digests",
    "resolve_unique",
    "revenue_delta",
    "revenue_of_parts",
    "revenue_parts",
    "scd2_apply",
    "scd2_as_of",
    "scd2_backlog",
    "scd2_current",
    "scd2_initial",
    "scd2_step",
    "split_rejects",
    "version_key",
]
