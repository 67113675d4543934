from .boundaries import read_boundaries, read_crosswalk
from .records import concat_batches, read_request_records, union_sources
from .tables import explore_raw, month_spine, read_parquet_table, scan_month, scan_since

__all__ = [
    "concat_batches",
    "explore_raw",
    "month_spine",
    "read_boundaries",
    "read_crosswalk",
    "read_parquet_table",
    "read_request_records",
    "scan_month",
    "scan_since",
    "union_sources",
]
