"""Readers: Parquet (single, partitioned, multi-service), CSV, JDBC, literals."""

from farelake.sources.readers import (  # noqa: F401
    calendar_between, calendar_range, inline_table, is_empty, is_empty_frame, path_exists, preview, scan_csv,
    scan_jdbc, scan_jdbc_query, scan_multi_service, scan_parquet,
    scan_partitioned, table_shape,
)
