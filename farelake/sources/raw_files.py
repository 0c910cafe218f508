"""Raw monthly files, one by one: which are there, which can be read.

A file may fail in three ways: it is missing, its footer can't be read (a
truncated upload), or a data page can't be read (the footer is fine, so the
fault shows only when the page is decoded). All are found by Spark jobs over
many files at once:

* ``list_files``: path, size, time (the file source's own listing, no content);
* ``footer_rows``: rows a file by its footer. No column is read, so the scan
  takes the counts from the footers; a file without a readable one gives no row;
* ``decoded_rows``: rows a file that can really be decoded. The scan skips the
  rest of a file at the first fault, so a file with a broken page gives fewer
  rows than its footer says. Page checksums are verified, where the file has
  them, so flipped bits that still decode are found too.

A logical file is ``<prefix>_<year>-<month>.parquet``: one Parquet file, or a
folder of part files of that name (its parts share its fate).
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.operators.setops import union_by_name
from farelake.sources.readers import path_exists

#: <prefix>_<year>-<month>.parquet as a file or a (partition) folder
LOGICAL_FILE = r"/(?:[^/=]*=)?(([a-z]+_tripdata)_(\d{4})-(\d{2})\.parquet)(?:/[^/]*)?$"
NOT_FOUND, NO_FOOTER, NO_DATA = "file not found", "unreadable footer", "unreadable data"
_CHECKED = {"parquet.page.verify-checksum.enabled": "true"}
_LISTING = "path string, src_file string, size bigint, modified timestamp"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, src_file, size, modified) of every file below ``root``. ``src_file``
    is the name that scans give in ``_metadata.file_path``."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], _LISTING)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("_metadata.file_path").alias("src_file"), F.col("length").alias("size"),
                        F.col("modificationTime").alias("modified"))


def logical_files(files: DataFrame, src_file: str = "src_file") -> DataFrame:
    """Add filename, prefix, year and month; other files are dropped."""
    part = lambda i: F.regexp_extract(src_file, LOGICAL_FILE, i)
    return files.where(part(1) != "").withColumns(
        {"filename": part(1), "prefix": part(2), "year": part(3).cast("int"), "month": part(4).cast("int")})


def wanted_files(spark: SparkSession, services: Mapping[str, str], years: Iterable[int], months: Iterable[int]) -> DataFrame:
    """(service_type, prefix, year, month, filename) of every month asked for."""
    grid = spark.createDataFrame([(p, s) for p, s in services.items()], "prefix string, service_type string")
    for name, values in (("year", years), ("month", months)):
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(int(v)) for v in values])))
    return grid.withColumn("filename", F.format_string("%s_%d-%02d.parquet", "prefix", "year", "month"))


def footer_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(src_file, footer_rows) of the files whose footer can be read; files
    without rows give none."""
    scan = spark.read.schema("`_` int").option("ignoreCorruptFiles", "true").parquet(*paths)
    return scan.groupBy(F.col("_metadata.file_path").alias("src_file")).agg(F.count(F.lit(1)).alias("footer_rows"))


def decoded_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(src_file, decoded_rows, digest): every column of every row is decoded,
    up to a file's first fault."""
    df = read_raw(spark, paths, ignore_corrupt=True)
    data = [c for c in df.columns if c not in ("src_file", "src_row", "year", "month")]
    return df.groupBy("src_file").agg(F.count(F.lit(1)).alias("decoded_rows"),
                                      F.bit_xor(F.xxhash64(*[F.col(c) for c in data])).alias("digest"))


def read_raw(spark: SparkSession, paths: Sequence[str], ignore_corrupt: bool = False) -> DataFrame:
    """The rows of the files with their identity (``src_file``, ``src_row``) and
    the file's year and month. Columns of all files are united; where a column's
    types can't be merged, each logical file is opened on its own and the union
    widens them."""
    reader = spark.read.options(**_CHECKED).option("ignoreCorruptFiles", str(ignore_corrupt).lower())
    identity = [F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.row_index").alias("src_row")]
    try:
        df = reader.option("mergeSchema", "true").parquet(*paths).select("*", *identity)
    except (PySparkException, Py4JJavaError):
        by_name: dict[str, list[str]] = {}
        for p in paths:
            by_name.setdefault(p.rsplit("/", 1)[0] if "/part-" in p else p, []).append(p)
        df = union_by_name([reader.option("mergeSchema", "false").parquet(*p).select("*", *identity) for p in by_name.values()])
    part = lambda i: F.regexp_extract("src_file", LOGICAL_FILE, i).cast("int")
    return df.withColumns({"year": part(3), "month": part(4)})


def _empty_or_error(spark: SparkSession, path: str) -> str | None:
    """Why a file that gave no row can't be opened; None for one without rows."""
    try:
        spark.read.parquet(path)
        return None
    except (PySparkException, Py4JJavaError) as e:
        cause = getattr(e, "java_exception", None)
        while cause is not None and cause.getCause() is not None:
            cause = cause.getCause()
        return f"{NO_FOOTER}: {(cause.getMessage() if cause is not None else str(e)).splitlines()[0]}"


def footer_faults(spark: SparkSession, found: DataFrame) -> DataFrame:
    """``found`` (path, src_file, ...) with footer_rows and ``error``, null where
    the footer can be read."""
    paths = [r.path for r in found.select("path").collect()]      # a row a file
    if not paths:
        return found.withColumns({"footer_rows": F.lit(None).cast("bigint"), "error": F.lit(None).cast("string")})
    rows = footer_rows(spark, paths).collect()
    counts = spark.createDataFrame(rows, "src_file string, footer_rows bigint")
    silent = found.join(counts, "src_file", "left_anti").select("path").collect()
    errors = spark.createDataFrame([(r.path, _empty_or_error(spark, r.path)) for r in silent], "path string, error string")
    out = found.join(counts, "src_file", "left").join(errors, "path", "left")
    return out.withColumn("footer_rows", F.when(F.col("error").isNull(), F.coalesce("footer_rows", F.lit(0))))


def data_faults(spark: SparkSession, checked: DataFrame) -> DataFrame:
    """``checked`` (of ``footer_faults``) with ``error`` also where fewer rows can
    be decoded than the footer names."""
    paths = [r.path for r in checked.where("error is null").select("path").collect()]
    if not paths:
        return checked
    got = spark.createDataFrame([(r.src_file, r.decoded_rows) for r in decoded_rows(spark, paths).collect()],
                                "src_file string, decoded_rows bigint")
    n = F.coalesce("decoded_rows", F.lit(0))
    text = F.format_string(NO_DATA + ": %d of %d rows", n, "footer_rows")
    return checked.join(got, "src_file", "left").withColumn(
        "error", F.when(F.col("error").isNull() & (n < F.col("footer_rows")), text).otherwise(F.col("error"))).drop("decoded_rows")


def rejects(wanted: DataFrame, checked: DataFrame) -> DataFrame:
    """(service_type, year, filename, error): months asked for without a file,
    and files with a fault (a logical file's first, by part)."""
    faults = checked.groupBy("filename").agg(F.min(F.when(F.col("error").isNotNull(), F.struct("src_file", "error"))).alias("f"),
                                             F.lit(True).alias("there"))
    out = wanted.join(faults, "filename", "left").withColumn(
        "error", F.when(F.col("there").isNull(), F.lit(NOT_FOUND)).otherwise(F.col("f.error")))
    return out.where("error is not null").select("service_type", F.col("year").cast("string").alias("year"), "filename", "error")


def sound_paths(checked: DataFrame) -> list[str]:
    """Paths of the logical files without a fault in any part (a row a file)."""
    bad = checked.where("error is not null").select("filename").distinct()
    return [r.path for r in checked.join(bad, "filename", "left_anti").select("path").orderBy("path").collect()]

