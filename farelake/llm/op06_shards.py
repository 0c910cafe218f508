"""Sharding by global byte-size prefix sums (DataFrame functions only).

Rows are laid out once in key order and written to the shared folder, so that
totals and positions come from the very same layout. A running sum inside each
stored partition plus the totals of the partitions before it gives every row
its global byte offset; cutting the offsets at equal targets gives contiguous
shards whose sizes differ by at most about one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.common import stage

ROW_OVERHEAD = 8


def shard_by_bytes(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    ``size`` is the text's UTF-8 bytes (null: none) plus 8, ``text_crc32`` the
    unsigned CRC-32 of those bytes. Shards follow the order of the id (nulls
    first; equal ids by size and checksum), ``slot`` counts from 0 inside a
    shard. Empty input gives no rows; a row larger than a whole target leaves
    the shards it spans empty. Other columns are ignored.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("id"), (F.octet_length(body) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
                         F.crc32(body).cast("long").alias("crc"))
    order = ["id", "size", "crc", "tie"]  # tie: a third of all rows may share an id
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = stage(narrow.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, *order)
                 .withColumn("pid", F.spark_partition_id()), "op6-layout")
    w = Window.partitionBy("pid").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = laid.withColumns({"run": F.sum("size").over(upto), "pos": F.row_number().over(w).cast("long")})
    totals = laid.groupBy("pid").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("c"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    everything = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("pid", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"),
                            F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"), F.sum("b").over(everything).alias("all_b"))
    # the shard is that of the row's middle byte
    cut = stage(local.join(F.broadcast(offsets), "pid").select(
        "id", "size", "crc", (F.col("c0") + F.col("pos") - 1).alias("row"),
        F.expr(f"cast(least({n_shards - 1}, ((2 * b0 + 2 * run - size) * {n_shards}) div (2 * all_b)) as int)").alias("shard")), "op6-cut")
    first = cut.groupBy("shard").agg(F.min("row").alias("row0"))  # one row per shard
    return cut.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("row0")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))



def op6_byte_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"), 24)
