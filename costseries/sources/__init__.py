from .readers import (
    flatten_catalog,
    read_delimited,
    read_indexed_json,
    read_nested_observations,
    read_series_json,
)
from .sinks import (
    dry_run,
    read_latest,
    sanitize_for_sink,
    snapshot_versions,
    write_append,
    write_if_empty,
    write_insert_ignore,
    write_overwrite,
    write_upsert,
    write_upsert_partitions,
)

__all__ = [
    "dry_run",
    "flatten_catalog",
    "read_delimited",
    "read_indexed_json",
    "read_latest",
    "read_nested_observations",
    "read_series_json",
    "sanitize_for_sink",
    "snapshot_versions",
    "write_append",
    "write_if_empty",
    "write_insert_ignore",
    "write_overwrite",
    "write_upsert",
    "write_upsert_partitions",
]
