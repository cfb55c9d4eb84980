from .streams import (
    compact,
    current_flags,
    merged_view,
    run_available,
    stream_changes,
    stream_dedup,
    stream_quality,
    stream_series,
    stream_upsert,
)

__all__ = [
    "compact",
    "current_flags",
    "merged_view",
    "run_available",
    "stream_changes",
    "stream_dedup",
    "stream_quality",
    "stream_series",
    "stream_upsert",
]
