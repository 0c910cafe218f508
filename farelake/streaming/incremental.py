"""Incremental raw -> trusted loading with Structured Streaming.

The original pipeline loads month by month and skips files that are already
loaded. With a file source, Spark keeps that bookkeeping itself: the
checkpoint records every file already processed, so each run
(``trigger(availableNow=True)``) picks up only new monthly files, cleans them
and merges them into their year/month partitions: the rows that other files gave
a month stay, those of the batch's own files are replaced, so neither a second
file of a month nor a replayed micro-batch loses or repeats rows. Files whose
name holds no month are listed under ``<trusted>/_rejects`` and not loaded. The
checkpoint lives in the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators.quality import apply_cleaning
from farelake.plans.jobs import FILE_NAME_PATTERN
from farelake.session import ensure_checkpoint_dir, shared_table
from farelake.sinks.writers import write_partitioned
from farelake.sources.readers import is_empty_folder, path_exists


def stream_raw_to_trusted(spark: SparkSession, raw_dir: str, trusted_dir: str, service: str,
                          schema: T.StructType, *, checkpoint: str | None = None,
                          files_per_batch: int = 12, fhv_profile: str = "current", max_files: int | None = None):
    """Process every not-yet-seen monthly file of ``service`` under ``raw_dir``
    (``<prefix>_<yyyy>-<mm>.parquet``, any depth) and return the finished query."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-raw-to-trusted/{service}"
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
           .option("recursiveFileLookup", "true").parquet(raw_dir))
    src = src.select("*", F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.row_index").alias("src_row"))
    src = src.withColumns({"year": F.regexp_extract("src_file", FILE_NAME_PATTERN, 1).try_cast("int"),
                           "month": F.regexp_extract("src_file", FILE_NAME_PATTERN, 2).try_cast("int")})
    named = F.col("year").isNotNull() & F.col("month").isNotNull()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        bad = batch.where(~named).select("src_file").distinct()
        if bad.take(1):
            (bad.select(F.lit(service).alias("service_type"), F.col("src_file").alias("filename"),
                        F.lit("no year and month in the name").alias("error"))
             .write.mode("overwrite").parquet(f"{trusted_dir.rstrip('/')}/_rejects/{service}-{batch_id}"))
        rows = apply_cleaning(batch.where(named), service, fhv_profile=fhv_profile)
        if path_exists(session, trusted_dir) and not is_empty_folder(session, trusted_dir):
            # at most files_per_batch months and files
            periods = batch.where(named).select("year", "month").distinct().collect()
            files = batch.where(named).select("src_file").distinct()
            if periods:
                here = reduce(lambda a, b: a | b, [(F.col("year") == p.year) & (F.col("month") == p.month) for p in periods])
                kept = session.read.option("mergeSchema", "true").parquet(trusted_dir).where(here)
                if "src_file" in kept.columns:
                    kept = kept.join(F.broadcast(files), "src_file", "left_anti")
                # stored: the months are replaced while they are read
                rows = shared_table(rows.unionByName(kept, allowMissingColumns=True), "stream-months")
        write_partitioned(rows, trusted_dir, max_files=max_files)

    query = (src.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
