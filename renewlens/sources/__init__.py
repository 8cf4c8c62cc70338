"""Sources and sinks: parquet/JDBC scans, driver-table adapters, writers,
snapshots, mart schemas and data profiles."""

from renewlens.sources.profile import collection_counts, null_profile, schema_profile
from renewlens.sources.schemas import conform
from renewlens.sources.sinks import stamp_audit, upsert, write_csv, write_table
from renewlens.sources.snapshots import read_latest_snapshot, write_snapshot
from renewlens.sources.tables import Tables, scan, scan_between, scan_jdbc

__all__ = [
    "Tables", "collection_counts", "conform", "null_profile", "read_latest_snapshot", "scan", "scan_between",
    "scan_jdbc", "schema_profile", "stamp_audit", "upsert", "write_csv", "write_snapshot", "write_table",
]
