"""A table of distinct rows that grows run by run without moving its history.

The table is bucketed by a 64-bit fingerprint of the whole row. A run's rows are
made distinct among themselves, then meet the stored fingerprints bucket by
bucket: Spark reads the history in its stored partitioning, so only the run's own
rows are shuffled, and of the history only the fingerprint column is read. Rows
whose fingerprint is there are compared with the full stored rows (nulls equal),
so two rows that merely share a fingerprint both stay.

A run that stops on the way or is repeated adds nothing twice: what it had added
is history for the next one. Buckets are uniform whatever the data, since a
fingerprint is a hash of distinct rows.

A task works on one bucket, so the number of buckets follows the rows: the first
run takes as many as its rows ask for, and the history is dealt out anew, into a
folder of its own, when it or a run has outgrown twice ``ROWS`` a bucket. The
layout file, replaced last, names that folder; the old one stays for those who
still read it. History so moves once each time the table has doubled.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.sources.readers import path_exists

FP = "row_fp"
LAYOUT = "_layout.json"      # scans skip names that begin with an underscore
BUCKETS = 64                 # at least
ROWS = 200_000               # of a bucket, about


def _layout(spark: SparkSession, root: str) -> dict | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/{LAYOUT}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    text = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    return json.loads(text)


def _write_layout(spark: SparkSession, root: str, at: dict) -> None:
    """Written beside the layout, then put in its place."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/{LAYOUT}")
    beside = jvm.org.apache.hadoop.fs.Path(f"{root}/{LAYOUT}.{uuid.uuid4().hex}")
    fs = p.getFileSystem(conf)
    fs.mkdirs(p.getParent())
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(at).encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(beside), fs.makeQualified(p), how)


def _table(spark: SparkSession, root: str, at: dict | None = None) -> str:
    """The stored rows as a bucketed table of the session's catalog. The folder
    holds all there is to know of it, so any session can name it anew."""
    at = at or _layout(spark, root)
    folder = f"{root}/{at['folder']}" if at.get("folder") else root
    quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
    name = "distinct_rows_" + hashlib.md5(folder.encode()).hexdigest()
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({at['schema']}) USING parquet "
              f"CLUSTERED BY ({FP}) INTO {at['buckets']} BUCKETS LOCATION '{quoted}'")
    spark.catalog.refreshTable(name)
    return name


def _with_buckets(spark: SparkSession, root: str, at: dict, n: int) -> dict:
    """The layout after the stored rows have been dealt out to ``n`` buckets. Until
    it is written the old one holds, and what a stopped run has left is not read."""
    new = {**at, "buckets": n, "folder": f"_rows-{n}-{uuid.uuid4().hex}"}
    spark.table(_table(spark, root, at)).repartition(n, FP).write.insertInto(_table(spark, root, new))
    _write_layout(spark, root, new)
    return new


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def read_distinct(spark: SparkSession, root: str) -> DataFrame:
    """The rows stored so far."""
    return spark.table(_table(spark, root.rstrip("/"))).drop(FP)


def new_rows(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """Distinct ``rows`` (with their fingerprint) that the store does not hold."""
    cols = rows.columns
    fresh = rows.distinct().withColumn(FP, F.xxhash64(*cols))
    history = spark.table(_table(spark, root))
    seen = history.select(FP)
    unseen = fresh.join(seen.hint("merge"), FP, "left_anti")
    # the same fingerprint: the full rows decide
    met = fresh.join(seen.hint("merge"), FP, "left_semi").select(FP, F.struct(*cols).alias("__r"))
    full = history.select(FP, F.struct(*cols).alias("__h")).hint("merge")
    # rows as values: nulls and NaN are equal, and the join's only key is the buckets'
    same = F.array_contains(F.array("__h"), F.col("__r"))
    collided = met.join(full, (met[FP] == full[FP]) & same, "left_anti")
    return unseen.select(*cols, FP).unionByName(collided.select("__r.*", FP))


def add_distinct(spark: SparkSession, root: str, rows: DataFrame, buckets: int = BUCKETS) -> None:
    """Add the distinct ``rows`` that the store at ``root`` lacks. The first run
    fixes the columns and takes ``buckets`` buckets, more if it has more than
    ``ROWS`` rows for each; rows with other columns or types are an error.
    ``rows`` are counted first; those without any row add nothing."""
    root = root.rstrip("/")
    if FP in rows.columns:
        raise ValueError(f"{FP} is the store's own column")
    schema = _ddl(rows) + f", `{FP}` bigint"
    at = _layout(spark, root) if path_exists(spark, root) else None
    if at is not None and at["schema"] != schema:
        raise ValueError(f"{root}: the store's columns are {at['schema']}, the run's {schema}")
    asked = -(-rows.count() // ROWS)
    if first := at is None:
        at = {"schema": schema, "buckets": max(buckets, asked)}
        _write_layout(spark, root, at)
    else:
        asked = max(asked, -(-spark.table(_table(spark, root)).count() // ROWS))
        if asked > 2 * at["buckets"]:
            at = _with_buckets(spark, root, at, asked)
    name = _table(spark, root)
    fresh = rows.distinct().withColumn(FP, F.xxhash64(*rows.columns)) if first else new_rows(spark, root, rows)
    # a task a bucket, so a run adds one file to each
    fresh.repartition(at["buckets"], FP).write.insertInto(name)
    spark.catalog.refreshTable(name)
