"""Writers: partitioned Parquet, whole tables, JDBC, partition replacement."""

from farelake.sinks.writers import (  # noqa: F401
    export_tables, limit_output_files, passthrough_copy, replace_partition,
    stamp_load_time, write_jdbc_append, write_jdbc_overwrite, write_partitioned,
    write_table,
)
