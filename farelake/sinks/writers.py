"""Sink operators.

Partitioned writes use dynamic partition overwrite: only the year/month
partitions present in the output are replaced, so re-running one month is
idempotent and leaves every other month alone. Output files are shaped by
an AQE ``rebalance`` on the partition columns (hot partitions split, small
ones merged) rather than ``coalesce(1)``, which would funnel a whole fact
through one task.
"""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def limit_output_files(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` output partitions. The rows are dealt out by a shuffle, so
    what comes before (joins, sorts) keeps its own number of tasks: a ``coalesce``
    would run all of it in ``n`` tasks."""
    return df.repartition(n)


def write_partitioned(df: DataFrame, path: str, year: int | None = None, month: int | None = None,
                      *, max_files: int | None = None, max_records_per_file: int | None = None,
                      partition_cols: Sequence[str] = ("year", "month")) -> None:
    """Write under ``year=/month=``, replacing only the partitions written.

    ``year``/``month`` given -> added as literal columns (one file's month).
    File layout:

    * default: a ``rebalance`` hint on the partition columns. AQE groups the
      rows of each partition value together and splits big ones (a month
      holding a third of the data) into advisory-sized tasks
      (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), so files are
      neither tiny nor huge at any scale;
    * ``max_files``: at most that many files per partition value (rows are
      hash-spread over ``max_files`` buckets) — the bounded layout for one
      monthly file.
    """
    out = df
    if year is not None:
        out = out.withColumn("year", F.lit(int(year)))
    if month is not None:
        out = out.withColumn("month", F.lit(int(month)))
    cols = list(partition_cols)
    if max_files:
        out = out.repartition(*[F.col(c) for c in cols],
                              (F.abs(F.xxhash64(*[F.col(c) for c in out.columns])) % max_files))
    else:
        out = out.hint("rebalance", *cols)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.partitionBy(*cols).parquet(path)


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] | None = None) -> None:
    """Overwrite a whole Parquet table."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def _jdbc_writer(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None, num_partitions: int | None):
    out = df.coalesce(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w


def write_jdbc_overwrite(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None,
                         num_partitions: int | None = 8) -> None:
    """Replace a JDBC table. ``num_partitions`` bounds the open connections."""
    _jdbc_writer(df, url, table, options, num_partitions).mode("overwrite").save()


def write_jdbc_append(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None,
                      num_partitions: int | None = 8) -> None:
    _jdbc_writer(df, url, table, options, num_partitions).mode("append").save()


def export_tables(spark: SparkSession, base: str, tables: Sequence[str], url: str,
                  options: Mapping[str, str] | None = None, num_partitions: int | None = 8) -> DataFrame:
    """Each warehouse table: Parquet -> JDBC; returns (table, n_rows, n_written)."""
    from farelake.sinks.commits import read_table, table_exists
    from farelake.sources.readers import scan_jdbc
    report = []
    for t in tables:
        df = read_table(spark, base, t) if table_exists(spark, base, t) else spark.read.parquet(f"{base.rstrip('/')}/{t}")
        n = df.count()
        write_jdbc_overwrite(df, url, t, options, num_partitions)
        written = scan_jdbc(spark, url, t, options).count()
        report.append((t, n, written))
    return spark.createDataFrame(report, "table string, n_rows bigint, n_written bigint")


def replace_partition(df: DataFrame, path: str, year: int, month: int) -> None:
    """Replace exactly one year/month partition of a partitioned table."""
    part = df.where((F.col("year") == int(year)) & (F.col("month") == int(month)))
    write_partitioned(part, path)


def drop_partition(spark: SparkSession, path: str, year: int, month: int) -> bool:
    """Delete one year/month partition; False where there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/year={int(year)}/month={int(month)}")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stamp_load_time(df: DataFrame, tz: str = "America/Sao_Paulo", now: _dt.datetime | None = None,
                    out: str = "load_datetime") -> DataFrame:
    """Wall-clock load time in ``tz`` (``timestamp_ntz``, independent of the
    session time zone); ``now`` (a naive UTC instant) can be injected for tests."""
    if now is None:
        stamp = F.convert_timezone(None, F.lit(tz), F.current_timestamp().cast("timestamp_ntz"))
    else:
        utc = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
        stamp = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return df.withColumn(out, stamp)


def passthrough_copy(spark: SparkSession, src: str, dst: str, year: int, month: int) -> None:
    """Publish a raw monthly file unchanged into the partitioned next layer."""
    write_partitioned(spark.read.parquet(src), dst, year, month)
