"""Ingestion planning as Spark jobs over crawled pages.

The HTTP download itself is not built (single-machine network I/O); what is
built is the planning around it: which dataset links a page holds, which
service/year/month each names, which wanted months exist, and which are not
loaded yet.
"""

from __future__ import annotations

import datetime as _dt
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.sources.raw_files import rejects

HREF_PATTERN = r'href="([^"]+)"'


def extract_links(pages: DataFrame, suffix: str | None = None, contains: str | None = None,
                  html: str = "html", page_id: str = "page_id") -> DataFrame:
    """Every ``<a href>`` of each page (one row per link), kept by suffix and
    substring when given."""
    links = pages.select(page_id, F.explode(F.regexp_extract_all(F.col(html), F.lit(HREF_PATTERN), 1)).alias("href"))
    if suffix:
        links = links.where(F.col("href").endswith(F.lit(suffix)))
    if contains:
        links = links.where(F.col("href").contains(F.lit(contains)))
    return links


def absolute_url(df: DataFrame, href: str = "href", host: str = "", out: str = "url") -> DataFrame:
    """Prefix relative links with ``host``."""
    return df.withColumn(out, F.when(F.col(href).startswith("http"), F.col(href))
                         .otherwise(F.concat(F.lit(host), F.col(href))))


def parse_dataset_name(df: DataFrame, url: str = "url", pattern: str = fixed.DATASET_FILE_PATTERN,
                       names: Sequence[str] = ("prefix", "year", "month")) -> DataFrame:
    """Groups of ``pattern`` as columns; rows that do not match are dropped."""
    out = df.withColumns({n: F.regexp_extract(F.col(url), pattern, i + 1) for i, n in enumerate(names)})
    return out.where(F.col(names[0]) != "")


def service_folder(df: DataFrame, prefix: str = "prefix", out: str = "service_type",
                   mapping: Mapping[str, str] = fixed.SERVICE_BY_FILE_PREFIX) -> DataFrame:
    return df.withColumn(out, C.translate_label(prefix, mapping))


def target_key(df: DataFrame, root: str = "raw", service: str = "service_type", year: str = "year",
               filename: str = "filename", out: str = "key") -> DataFrame:
    """``root/service/year/filename``."""
    return df.withColumn(out, F.concat_ws("/", F.lit(root), F.col(service), F.col(year).cast("string"),
                                          F.col(filename)))


def month_grid(months: DataFrame, start: str = "start", end: str = "end",
               services: Sequence[str] = fixed.SERVICE_TYPES) -> DataFrame:
    """Every month from ``start`` to ``end`` of each row x each service.

    ``months`` is a frame with start/end dates (e.g. the min and max of a
    data column); the grid is generated by ``sequence`` + ``explode`` on the
    executors, and services by a second ``explode`` (no cross join).
    """
    g = months.select(F.explode(F.sequence(F.trunc(F.col(start), "month").cast("date"),
                                           F.trunc(F.col(end), "month").cast("date"),
                                           F.expr("interval 1 month"))).alias("m"))
    g = g.select(F.explode(F.array(*[F.lit(s) for s in services])).alias("service_type"),
                 F.year("m").alias("year"), F.month("m").alias("month"))
    return g


def month_range(spark: SparkSession, start, end, services: Sequence[str] = fixed.SERVICE_TYPES) -> DataFrame:
    """Grid service x year x month between two dates (inclusive)."""
    def as_date(x):
        return x if isinstance(x, _dt.date) else _dt.date.fromisoformat(str(x)[:10])
    seed = spark.createDataFrame([(as_date(start), as_date(end))], "start date, end date")
    return month_grid(seed, services=services)


def available_in_range(grid: DataFrame, links: DataFrame,
                       keys: Sequence[str] = ("service_type", "year", "month")) -> DataFrame:
    """Grid + ``found``: whether a link exists for that service/year/month.

    Links are keyed by service + year + month (not by month alone)."""
    keys = list(keys)
    have = links.select(*keys).distinct().withColumn("found", F.lit(True))
    out = grid.join(have, keys, "left")
    return out.withColumn("found", F.coalesce(F.col("found"), F.lit(False)))


def pending_files(wanted: DataFrame, loaded: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Wanted entries not loaded yet (``left_anti``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return wanted.join(loaded.select(*keys).distinct(), keys, "left_anti")


def ingest_rejects(wanted: DataFrame, checked: DataFrame) -> DataFrame:
    """(service_type, year, filename, error) of the wanted monthly files that are
    missing or faulty; ``checked`` holds each found file's state
    (``sources.raw_files``)."""
    return rejects(wanted, checked)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Keep the rejects as JSON lines next to the raw layer."""
    rejects.coalesce(1).write.mode("append").json(path)
