"""Sources: registry (S3), table scans (S1/S2), catalog (S4/S5), landed
CRM records (S6) and warehouse marks (S7)."""

from .catalog import allowlist_frame, allowlisted, existing_tables, jdbc_catalog_frame, spark_catalog_frame
from .jdbc import JdbcPartitioning
from .records import read_records, record_schema, string_fields, to_records
from .registry import SourceConfig, SourceRegistry

__all__ = [
    "JdbcPartitioning",
    "SourceConfig",
    "SourceRegistry",
    "allowlist_frame",
    "allowlisted",
    "existing_tables",
    "jdbc_catalog_frame",
    "read_records",
    "record_schema",
    "spark_catalog_frame",
    "string_fields",
    "to_records",
]
