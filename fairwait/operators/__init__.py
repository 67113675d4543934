from .cleaning import (
    coerce_numeric,
    normalize_demographics,
    normalize_requests,
    null_sentinel,
    rename_case,
    stage_requests,
    stamp_refresh,
)
from .filters import closed_requests, date_range, in_set, min_count, not_in_set, search_reference
from .joins import (
    align_aggregates,
    categorize_types,
    enrich_dim,
    enrich_neighborhood,
    insert_if_absent,
    join_baseline,
    lookup_default,
    matched_fact,
    quintile_self_join,
    reindex_spine,
)
from .quality import Check, run_checks
from .quantiles import grouped_quantiles
from .series import result_fingerprint, series_text
from .spatial import point_in_polygon_join
from .upsert import get_watermark, incremental_filter, upsert_latest, watermark_frame
from .windows import dedup_latest, ntile_bucket, top_n_per_group

__all__ = [
    "Check",
    "align_aggregates",
    "categorize_types",
    "closed_requests",
    "coerce_numeric",
    "date_range",
    "dedup_latest",
    "enrich_dim",
    "enrich_neighborhood",
    "get_watermark",
    "grouped_quantiles",
    "in_set",
    "incremental_filter",
    "insert_if_absent",
    "join_baseline",
    "lookup_default",
    "matched_fact",
    "min_count",
    "normalize_demographics",
    "normalize_requests",
    "not_in_set",
    "ntile_bucket",
    "null_sentinel",
    "point_in_polygon_join",
    "quintile_self_join",
    "reindex_spine",
    "rename_case",
    "result_fingerprint",
    "run_checks",
    "search_reference",
    "series_text",
    "stage_requests",
    "stamp_refresh",
    "top_n_per_group",
    "upsert_latest",
    "watermark_frame",
]
