"""Source operators.

All readers return lazy DataFrames: Catalyst pushes later filters and column
selections into the Parquet/JDBC scan, and partition filters on ``year`` /
``month`` prune directories instead of listing them by hand.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (any Hadoop file system) exists; no data is read."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def is_empty_folder(spark: SparkSession, path: str) -> bool:
    """True when the folder ``path`` holds no data: nothing, or only names that
    Spark's readers skip."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(jpath)]
    return all(x.startswith(("_", ".")) for x in names)


def scan_parquet(spark: SparkSession, path: str | Sequence[str], *,
                 ignore_corrupt: bool = False, with_source: bool = False) -> DataFrame:
    """Read one (or several) Parquet files/directories.

    ``with_source`` adds ``src_file`` and ``src_row`` from the scan's hidden
    ``_metadata`` struct: a stable identity of each raw row that later gives
    deterministic trip keys without any global sort.
    """
    reader = spark.read
    if ignore_corrupt:
        reader = reader.option("ignoreCorruptFiles", "true")
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.parquet(*paths)
    if with_source:
        df = df.select("*", F.col("_metadata.file_path").alias("src_file"),
                       F.col("_metadata.row_index").alias("src_row"))
    return df


def scan_partitioned(spark: SparkSession, base: str, years: Iterable[int] | None = None,
                     months: Iterable[int] | None = None, *, merge_schema: bool = False) -> DataFrame:
    """Read a Hive-style ``year=/month=`` dataset and keep the chosen partitions.

    The predicate is on partition columns only, so Spark prunes directories
    (``PartitionFilters`` in the plan) rather than reading everything.
    ``merge_schema`` unions the column sets of all files (written by different
    runs) instead of trusting one file's footer.
    """
    reader = spark.read.option("basePath", base)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.parquet(base)
    if years is not None:
        df = df.filter(F.col("year").isin([int(y) for y in years]))
    if months is not None:
        df = df.filter(F.col("month").isin([int(m) for m in months]))
    return df


def scan_multi_service(spark: SparkSession, paths: Mapping[str, str], years=None, months=None,
                       *, partitioned: bool = True, missing: str = "skip") -> DataFrame:
    """Read each service's dataset, tag ``service_type`` and union by name.

    Services whose path is absent are skipped; if none is present, raise
    (``missing='error'`` raises on the first absent one).
    """
    frames = []
    for service, path in paths.items():
        if not path_exists(spark, path):
            if missing == "error":
                raise FileNotFoundError(path)
            continue
        df = scan_partitioned(spark, path, years, months) if partitioned else spark.read.parquet(path)
        frames.append(df.withColumn("service_type", F.lit(service)))
    if not frames:
        raise FileNotFoundError("no input found for any service: " + ", ".join(paths))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line; all strings unless a schema is given."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def scan_jdbc(spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None,
              *, partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read a table over JDBC; give a numeric ``partition_column`` and bounds
    for parallel range reads on big tables."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions or 8))
    return reader.load()


def scan_jdbc_query(spark: SparkSession, url: str, query: str,
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """Push a SQL text to the database and read its result."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """Literal rows with a schema (StructType or DDL string)."""
    return spark.createDataFrame(list(rows), schema)


def calendar_range(spark: SparkSession, start, end, name: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, generated on executors."""
    def as_date(x):
        if isinstance(x, _dt.datetime):
            return x.date()
        if isinstance(x, _dt.date):
            return x
        return _dt.date.fromisoformat(str(x)[:10])
    s, e = as_date(start), as_date(end)
    return (spark.range(1)
            .select(F.explode(F.sequence(F.lit(s), F.lit(e), F.expr("interval 1 day"))).alias(name)))


def calendar_between(df: DataFrame, start: str, end: str, name: str = "date") -> DataFrame:
    """One row per day from the earliest ``start`` to the latest ``end`` in
    ``df`` (a one-row aggregate, then ``sequence`` + ``explode``)."""
    span = df.agg(F.min(F.to_date(start)).alias("__s"), F.max(F.to_date(end)).alias("__e"))
    return span.select(F.explode(F.sequence("__s", "__e", F.expr("interval 1 day"))).alias(name))


def preview(df: DataFrame, n: int = 5, keys: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stable order (top-k, not a full sort)."""
    keys = list(keys) if keys else list(df.columns)
    return df.orderBy(*keys).limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    """One row: n_rows, n_cols, columns (comma separated)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def is_empty(df: DataFrame) -> bool:
    """True when there is no row (reads at most one row)."""
    return df.isEmpty()


def is_empty_frame(df: DataFrame, out: str = "is_empty") -> DataFrame:
    """Lazy form of ``is_empty``: one row, one boolean; reads at most one row."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias(out))
