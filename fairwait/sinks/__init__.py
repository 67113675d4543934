from .tables import (
    append_raw,
    by_name,
    ensure_table,
    expire_versions,
    high_water_mark,
    materialise,
    read_snapshot,
    read_or_none,
    replace_partitions,
    replace_table,
    upsert_table,
    write_partition,
)

__all__ = [
    "append_raw",
    "by_name",
    "ensure_table",
    "expire_versions",
    "high_water_mark",
    "materialise",
    "read_snapshot",
    "read_or_none",
    "replace_partitions",
    "replace_table",
    "upsert_table",
    "write_partition",
]
