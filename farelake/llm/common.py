"""Shared-folder tables, connected components and word hashing used by the
operators of this subpackage."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# tables in the shared folder
# ---------------------------------------------------------------------------

def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, a plain local
    master gets a temporary one (tests); a cluster must name one."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="farelake-llm-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


BATCH_ROWS = "1000"       # texts are long: Spark's default batch of 10,000 rows takes tens of MB on both sides


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, as ``--py-files`` does; once a
    context. Arrow batches of rows become smaller, unless the session sets them."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if not getattr(sc, "_farelake_shipped", False):
        here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        base = os.path.join(tempfile.mkdtemp(prefix="farelake-py-"), "farelake_llm")
        copy = os.path.join(base, "farelake")
        shutil.copytree(os.path.join(here, "llm"), os.path.join(copy, "llm"), ignore=shutil.ignore_patterns("__pycache__"))
        shutil.copy(os.path.join(here, "__init__.py"), copy)
        sc.addPyFile(shutil.make_archive(base, "zip", base))
        sc._farelake_shipped = True


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Collect frames that nothing refers to any more, so that Spark's cleaner
    deletes their shuffle files before the next job writes its own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame, tag: str, **options) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the
    lineage and survives lost executors."""
    spark, path, schema = df.sparkSession, scratch(df.sparkSession, tag), df.schema
    clean(spark)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.staged_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        spark, path = df.sparkSession, getattr(df, "staged_path", None)
        if path:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def only_ids(df: DataFrame, ids: DataFrame, col: str, most: int = 1_000_000) -> DataFrame:
    """Rows of ``df`` whose ``col`` is among the long ``ids`` (one column of that
    name). Ids are broadcast where they were counted to be at most ``most``
    (8 MB a million); more are joined by a shuffle. The rows are the same."""
    ids = stage(ids.distinct(), "ids")
    return df.join(F.broadcast(ids) if ids.count() <= most else ids, col, "left_semi")


# ---------------------------------------------------------------------------
# connected components
# ---------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of ``edges`` (u, v): (node, root).

    Each round points every node at its smallest neighbour, shortcuts the
    pointers, and contracts the edges by them; edges inside a tree vanish, so
    their number falls geometrically. A node and its pointer stay joined by the
    images of its edge, so when no edge is left every label is a root. All of it is aggregation and equi-joins;
    one side of each join is unique in the key, so a hot node can be split.
    """
    edges = stage(edges.where("u <> v").selectExpr("least(u, v) u", "greatest(u, v) v").distinct(), "edges")
    label = None
    while edges.take(1):
        p = (edges.unionByName(edges.selectExpr("v u", "u v")).groupBy("u").agg(F.min("v").alias("p"))
             .selectExpr("u", "least(u, p) p"))
        p = stage(p, "parent")
        jump = p.selectExpr("u p", "p pp")
        for _ in range(2):
            p = p.join(jump, "p", "left").selectExpr("u", "coalesce(pp, p) p")
            jump = p.selectExpr("u p", "p pp")
        p = stage(p, "parent")
        if label is None:
            label = p.selectExpr("u node", "p root")
        else:
            label = label.join(p.selectExpr("u root", "p up"), "root", "left").selectExpr(
                "node", "coalesce(up, root) root")
        label = stage(label, "label")
        nxt = (edges.join(p.selectExpr("u", "p pu"), "u").join(p.selectExpr("u v", "p pv"), "v")
               .where("pu <> pv").selectExpr("least(pu, pv) u", "greatest(pu, pv) v").distinct())
        old, edges = edges, stage(nxt, "edges")
        discard(old, p)
    if label is None:
        return edges.selectExpr("u node", "v root")
    return label


# ---------------------------------------------------------------------------
# hashing of words
# ---------------------------------------------------------------------------

_M = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x5851F42D4C957F2D)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POW = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """``_BASE ** 0 .. n-1`` modulo 2^64."""
    global _POW
    if len(_POW) < n:
        _POW = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1024), _BASE))])
    return _POW[:n]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    buf = np.frombuffer(text, np.uint8)
    if not len(buf):
        return np.zeros(0, np.uint64)
    word = ~SPACE[buf]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    offs = np.cumsum(lens) - lens
    pos = np.arange(lens.sum()) - np.repeat(offs, lens)
    vals = (LOWER[buf[word]].astype(np.uint64) + np.uint64(1)) * powers(int(lens.max()))[pos]
    return mix64(np.add.reduceat(vals, offs) + lens.astype(np.uint64) * _M)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes (signed order) of the ``words``-word shingles; of
    the whole sequence where there are fewer words; none without words."""
    h = word_hashes(text)
    if not len(h):
        return np.zeros(0, np.int64)
    w = min(words, len(h))
    s = np.full(len(h) - w + 1, np.uint64(w), np.uint64)
    for i in range(w):
        s = mix64(s * _M + h[i:len(h) - w + 1 + i])
    return np.unique(s.view(np.int64))
