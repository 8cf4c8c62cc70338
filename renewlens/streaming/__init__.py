"""Structured Streaming drivers for the batch marts.

The marts are batch jobs; nothing here adds a new operator.  A file stream is
used as a trigger: each micro-batch names the members whose raw rows arrived,
the existing batch operators recompute just those members, and the result is
upserted into a new snapshot version (readers use ``read_latest_snapshot``).
"""

from renewlens.streaming.refresh import refresh_location_metrics

__all__ = ["refresh_location_metrics"]
