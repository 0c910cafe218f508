"""Deterministic keys.

* ``dense_index``: 1..n in the order of a natural key, computed without a
  global window. Rows are range-partitioned on the key and written once with
  their partition number; numbers inside a partition and the row counts of the
  earlier ones (one small row per partition) are both read from that table, so
  they always fit each other. The result is the global rank: it does not depend
  on the sampled range bounds and is the same on every run.
* ``trip_key``: the fact key from the raw row's identity (source file +
  row position within the file), ``file_no * 2^40 + row``. Needs no sort and
  no shuffle of the fact, and is stable across task retries. With a file
  registry (``files``) it is unique over all runs that share the registry.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.operators.joins import checked_broadcast
from farelake.session import shared_table

FEW_ROWS = 2_000  # numbered without a stored layout
ROW_BITS = 40  # up to 2^40 rows per source file


def dense_index(df: DataFrame, order_cols: Sequence[str], name: str, start: int = 1,
                num_partitions: int | None = None, few_rows: int = FEW_ROWS) -> DataFrame:
    """Add ``name`` = position of each row in ``order_cols`` order (from ``start``).

    ``order_cols`` should be unique per row for a deterministic numbering. At most
    ``few_rows`` rows, by an exact count while they are fetched, are numbered
    as they are, without a stored layout; the numbers are the same.
    """
    order_cols = list(order_cols)
    rows = df.limit(few_rows + 1).collect()
    if len(rows) <= few_rows:
        local = df.sparkSession.createDataFrame(rows, schema=df.schema, verifySchema=False)
        return local.withColumn(name, (F.row_number().over(Window.orderBy(*order_cols)) + F.lit(start - 1)).cast("bigint"))
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored: a second evaluation could sample other bounds, and offsets would not fit the rows
    ranged = shared_table(df.repartitionByRange(n_parts, *order_cols).withColumn("__pid", F.spark_partition_id()), "dense-index")
    local = ranged.withColumn("__ln", F.row_number().over(Window.partitionBy("__pid").orderBy(*order_cols)))
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__pn"))
    # one row per partition: the bound is the partition count
    offsets = sizes.select("__pid", F.coalesce(
        F.sum("__pn").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("__off"))
    out = local.join(F.broadcast(offsets), "__pid", "inner")
    return out.withColumn(name, (F.col("__off") + F.col("__ln") + F.lit(start - 1)).cast("bigint")).drop(
        "__pid", "__ln", "__off")


def trip_key(df: DataFrame, name: str = "sk_trip", file_col: str = "src_file", row_col: str = "src_row",
             max_files_broadcast: int = 100_000, files: DataFrame | None = None) -> DataFrame:
    """``file_no * 2^40 + row`` from the raw row identity columns.

    File numbers come from ``files`` (file_col, file_no), a registry kept over
    the runs, else from ``dense_index`` over the distinct file names (one row
    per source file). That table is broadcast behind a size check; with
    more files a shuffle join on the file name is planned, which cannot skew
    (a file holds a bounded number of rows).
    """
    if files is None:
        files = dense_index(df.select(file_col).distinct(), [file_col], "__file_no", start=0)
    else:
        files = files.select(file_col, F.col("file_no").alias("__file_no"))
    files = checked_broadcast(files, max_files_broadcast)
    out = df.join(files, file_col, "left")
    key = F.shiftleft(F.col("__file_no"), ROW_BITS) + F.col(row_col)
    return out.withColumn(name, key.cast("bigint")).drop("__file_no")


def natural_hash_key(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """64-bit hash of natural columns: stable, shuffle-free, but only unique
    with high probability; use for dimension-sized tables."""
    return df.withColumn(name, F.xxhash64(*[F.col(c) for c in cols]))
