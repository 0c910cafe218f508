"""Which raw files have been loaded, and with what content.

A name is not enough to know that a monthly file is loaded: publishers replace
files. The registry keeps of every logical file its parts, size, newest
modification time and, where it was looked at, a digest of its rows. A file whose
parts, size and time are as registered is not opened. One that differs is decoded
once: with the registered digest it was only touched and is not loaded again,
otherwise it has changed. Files that the registry names and that are not there any
more are gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.sinks.commits import Transaction, read_table, table_exists
from farelake.sources.raw_files import footer_faults, read_raw

TABLE = "files"
NEW, SAME, TOUCHED, CHANGED, GONE = "new", "same", "touched", "changed", "gone"
TO_DO = (NEW, CHANGED, GONE)
KEY = ["service_type", "filename"]
STAMP = ["parts", "size", "modified"]
SCHEMA = ("service_type string, filename string, year int, month int, parts bigint, size bigint, modified timestamp, "
          "digest decimal(38,0)")


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """The registered files; none before the first commit."""
    return read_table(spark, root, TABLE) if table_exists(spark, root, TABLE) else spark.createDataFrame([], SCHEMA)


def write_registry(spark: SparkSession, root: str, states: DataFrame) -> int:
    """Commit the files of ``states`` as the registry; the manifest's number."""
    tx = Transaction(spark, root)
    tx.stage(TABLE, states.selectExpr(*[f"cast({f.split()[0]} as {f.split()[1]}) {f.split()[0]}" for f in SCHEMA.split(", ")]).coalesce(1))
    return tx.commit()


def content_digests(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(filename, digest) of logical files (path, src_file, filename): the sum of
    their rows' hashes, whatever the order of rows and columns and the split into
    parts. A column without values changes nothing. Rows behind a fault don't
    count; a file without a readable footer has no digest."""
    files = footer_faults(spark, files).where("error is null")
    paths = [r.path for r in files.select("path").collect()]      # a row a file
    if not paths:
        return spark.createDataFrame([], "filename string, digest decimal(38,0)")
    rows = read_raw(spark, paths, ignore_corrupt=True)
    data = sorted((c for c in rows.columns if c not in ("src_file", "src_row", "year", "month")), key=str.lower)
    hashed = rows.groupBy("src_file").agg(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in data]).cast("decimal(20,0)")).alias("d"))
    return files.join(hashed, "src_file", "left").groupBy("filename").agg(F.coalesce(F.sum("d"), F.lit(0)).cast("decimal(38,0)").alias("digest"))


def file_states(spark: SparkSession, found: DataFrame, registry: DataFrame, digest_new: bool = False) -> DataFrame:
    """One row a logical file of ``found`` (``raw_files.logical_files`` with
    ``service_type``) or ``registry``, with its ``state``. ``digest_new`` decodes
    new files too, so that even their first touch is told from a change; without
    it a file that differs and has no digest yet counts as changed. The state is
    fixed when this returns (a row a file)."""
    now = found.groupBy(*KEY, "year", "month").agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("size"),
                                                   F.max("modified").alias("modified"))
    old = registry.select(*KEY, F.col("year").alias("o_year"), F.col("month").alias("o_month"),
                          *[F.col(c).alias(f"o_{c}") for c in (*STAMP, "digest")])
    both = now.join(old, KEY, "full")
    alike = (F.col("parts") == F.col("o_parts")) & (F.col("size") == F.col("o_size")) & (F.col("modified") == F.col("o_modified"))
    state = (F.when(F.col("parts").isNull(), GONE).when(F.col("o_parts").isNull(), NEW).when(alike, SAME).otherwise(CHANGED))
    both = both.withColumn("state", state)
    both = spark.createDataFrame(both.collect(), both.schema)
    look = both.where(F.col("state").isin(CHANGED, NEW) if digest_new else F.col("state") == CHANGED).select(*KEY)
    digests = content_digests(spark, found.join(look, KEY, "left_semi"))
    out = both.join(digests, "filename", "left").withColumn(
        "state", F.when((F.col("state") == CHANGED) & (F.col("digest") == F.col("o_digest")), TOUCHED).otherwise(F.col("state")))
    out = out.select(*KEY, F.coalesce("year", "o_year").alias("year"), F.coalesce("month", "o_month").alias("month"),
                     *[F.coalesce(c, f"o_{c}").alias(c) for c in (*STAMP, "digest")], "state")
    return spark.createDataFrame(out.collect(), out.schema)
