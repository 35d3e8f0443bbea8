from silverline.operators.dedup import any_per_key, latest_per_key
from silverline.operators.feed import change_feed, daily_versions, union_days
from silverline.operators.reconcile import (
    column_diffs,
    comparable_columns,
    counts,
    digest_report,
    key_coverage,
    missing_keys,
    report,
)
from silverline.operators.upsert import align, require_unique_keys, upsert, upsert_summary

__all__ = [
    "align",
    "any_per_key",
    "change_feed",
    "column_diffs",
    "comparable_columns",
    "counts",
    "daily_versions",
    "digest_report",
    "key_coverage",
    "latest_per_key",
    "missing_keys",
    "report",
    "require_unique_keys",
    "union_days",
    "upsert",
    "upsert_summary",
]
