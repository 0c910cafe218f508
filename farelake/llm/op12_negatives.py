"""Hard negatives by angular triangle filtering.

Every row keeps its angles to a few reference directions (rows chosen by the
hash of their id). For an anchor and a row, angle(anchor, row) lies between the
largest difference and the smallest sum of their angles to a reference. The
cosines of these ends, multiplied by the two norms and widened by more than any
rounding, bound the integer inner product. An anchor is compared

* with its own label's rows whose upper bound reaches the last of the best
  positives found so far,
* with other labels' rows whose bounds overlap a window that its positives'
  scores open, above the last of the best negatives found there so far,

first for stretches of rows that lie together (ordered by nearest reference and
angle), then row by row. What is left is scored on integers, exactly.

Anchors are taken in blocks of a bounded number of bytes, each broadcast to one
pass over the rows; a task returns its best rows a target, and the best of those
are taken by a window of group limits. So nothing is shuffled but the rows, once,
into their order, and the tasks' best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.common import discard, scratch, ship, stage

REFERENCES = 16
ANCHOR_ROWS, ANCHOR_BYTES = 1024, 4 << 20   # of a block
STRETCH = 256                               # rows bounded together
SLACK = 4e-6                                # radians; angles are kept in single precision
LEAST = np.iinfo(np.int64).min


def _quantised(scale: float):
    """Integer vectors and their norms; rows that can't take part are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, vec, norm = [], [], []
            for k, v in enumerate(b.column(2)):
                x = np.array(v.as_py(), dtype=np.float64)  # a null component becomes nan
                q = np.floor(scale * x) if np.isfinite(x).all() else x
                with np.errstate(over="ignore"):
                    n = math.sqrt(float(q @ q))
                if n < 2.0 ** 31:  # else, or where it is not a number, scores have no long
                    keep.append(k)
                    vec.append(q.astype("<i4").tobytes())
                    norm.append(n)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(vec, pa.binary()), pa.array(norm, pa.float64())],
                                             ["id", "label", "q", "norm"])
    return run


def _ints(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<i4").reshape(len(col), -1)


def _angles(refs: np.ndarray):
    """Angles to the references, the nearest and the angle to it."""
    units = refs / np.maximum(np.linalg.norm(refs, axis=1), 1.0)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cos = _ints(b["q"]) @ units.T / np.maximum(b["norm"].to_numpy(), 1.0)[:, None]
                a = np.arccos(np.clip(cos, -1.0, 1.0)).astype("<f4")
                near = a.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in a], pa.binary()), pa.array(near.astype(np.int32)),
                                                  pa.array(a[np.arange(len(a)), near])], ["id", "label", "q", "norm", "angles", "near", "turn"])
    return run


def bounds(angles: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray,
           most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of each anchor (rows) with each stretch (columns),
    whose angles lie in [low, high] and whose norms in [least, most]."""
    near = np.zeros((len(angles), len(low)))
    far = np.full_like(near, math.pi)
    for r in range(angles.shape[1]):
        a, lo, hi = angles[:, r, None].astype(float), low[None, :, r].astype(float), high[None, :, r].astype(float)
        np.maximum(near, np.maximum(a - hi, lo - a), out=near)
        np.minimum(far, np.minimum(a + hi, 2 * math.pi - a - lo), out=far)
    top, bottom = np.cos(np.maximum(near - SLACK, 0.0)), np.cos(np.minimum(far + SLACK, math.pi))
    upper = norms[:, None] * np.where(top > 0, top * most, top * least)
    lower = norms[:, None] * np.where(bottom < 0, bottom * most, bottom * least)
    return lower - np.abs(lower) * 1e-9 - 1.0, upper + np.abs(upper) * 1e-9 + 1.0


def scores(a: np.ndarray, x: np.ndarray, most: float) -> np.ndarray:
    """Integer inner products. Doubles hold them where no partial sum can pass 2^53."""
    if most < 2.0 ** 52:
        return (a.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ x.T.astype(np.int64)


class Best:
    """The best ``k`` (score, then smaller id) of each target."""

    def __init__(self, targets: int, k: int):
        self.k, self.targets = k, targets
        self.target = self.score = self.id = np.zeros(0, np.int64)
        self.bar = np.full(targets, LEAST)  # the last score that is among the best, once there are k

    def add(self, target: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        t, s, i = (np.concatenate(x) for x in ((self.target, target), (self.score, score), (self.id, ids)))
        by = np.lexsort([i, -s, t])
        t, s, i = t[by], s[by], i[by]
        first = np.searchsorted(t, np.arange(self.targets))
        keep = np.arange(len(t)) - first[t] < self.k
        self.target, self.score, self.id = t[keep], s[keep], i[keep]
        full = np.bincount(self.target, minlength=self.targets) == self.k
        last = np.searchsorted(self.target, np.arange(self.targets), side="right") - 1
        self.bar[full] = self.score[last[full]]


class Anchors:
    """A block of anchors, and their targets: windows (low to high score) of
    rows of the same or of other labels, several an anchor."""

    def __init__(self, rows: list):
        self.id = np.array([r.id for r in rows], np.int64)
        self.label = np.array([r.label for r in rows], np.int64)
        self.norm = np.array([r.norm for r in rows], np.float64)
        self.q = np.stack([np.frombuffer(r.q, "<i4") for r in rows])
        self.angles = np.stack([np.frombuffer(r.angles, "<f4") for r in rows])

    def search(self, batches: Iterator[pa.RecordBatch], same: bool, low: np.ndarray, high: np.ndarray, k: int) -> Best:
        """``low`` and ``high`` are (anchor, slot) arrays; a slot with low above high is none."""
        n, slots = low.shape
        best = Best(n * slots, k)
        for b in batches:
            ids, labels, norm = b["id"].to_numpy(), b["label"].to_numpy(), b["norm"].to_numpy()
            q, angles = _ints(b["q"]), np.frombuffer(b"".join(b["angles"].to_pylist()), "<f4").reshape(len(ids), -1)
            cut = np.arange(0, len(ids), STRETCH)
            if not len(cut):
                continue
            lo, hi = bounds(self.angles, self.norm, np.minimum.reduceat(angles, cut), np.maximum.reduceat(angles, cut),
                            np.minimum.reduceat(norm, cut), np.maximum.reduceat(norm, cut))
            for j, a in enumerate(cut):
                z = slice(a, a + STRETCH)
                floor = np.maximum(low, best.bar.reshape(n, slots))
                floor[low > high] = np.iinfo(np.int64).max
                least, most = floor.min(axis=1), high.max(axis=1)
                who = np.flatnonzero((hi[:, j] >= least) & (lo[:, j] <= most))
                if not len(who):
                    continue
                mine = (labels[z] == self.label[who, None]) if same else (labels[z] != self.label[who, None])
                if same:
                    mine &= ids[z] != self.id[who, None]
                if not mine.any():
                    continue
                l, u = bounds(self.angles[who], self.norm[who], angles[z], angles[z], norm[z], norm[z])
                mine &= (u >= least[who, None]) & (l <= most[who, None])
                rows, cols = np.flatnonzero(mine.any(axis=1)), np.flatnonzero(mine.any(axis=0))
                if not len(rows):
                    continue
                who, mine = who[rows], mine[np.ix_(rows, cols)]
                s = scores(self.q[who], q[z][cols], float(self.norm[who].max() * norm[z][cols].max()))
                found = ids[z][cols]
                for slot in range(slots):
                    at, to = np.nonzero(mine & (s >= floor[who, slot, None]) & (s <= high[who, slot, None]))
                    if len(at):
                        best.add(who[at] * slots + slot, s[at, to], found[to])
        return best


def _search(shared, same: bool, low: np.ndarray, high: np.ndarray, k: int):
    slots = low.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = shared.value.search(batches, same, low, high, k)
        yield pa.RecordBatch.from_arrays([pa.array(best.target // slots), pa.array(best.target % slots), pa.array(best.id), pa.array(best.score)],
                                         ["anchor", "slot", "id", "score"])
    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: str = "id % 100 = 0", positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become ``floor(scale * x)``; a row's score is its integer inner
    product with the anchor, higher first, ties by smaller id. An anchor's
    positives are its first rows of the same label; for each, the first rows of
    other labels with low * positive_score <= 100 * negative_score <= high *
    positive_score are returned. ``anchor`` is SQL over the column ``id``.

    Rows without id, label or vector, with null or non-finite components, or
    with a norm from 2^31 on (after scaling) take no part. Of rows that repeat
    an id, the one of the smallest (label, vector bytes) takes part. Vectors of
    different lengths are not compared. An anchor without positives, or a
    positive score that leaves an empty window, gives no row; nor does an
    empty table. Other columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and label is not null and v is not null")
    rows = rows.mapInArrow(_quantised(scale), "id long, label long, q binary, norm double")
    rows = stage(rows.groupBy("id").agg(F.min(F.struct("label", "q", "norm")).alias("r")).select("id", "r.*"), "op12-rows")
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = scratch(spark, "op12-negatives")
    spark.createDataFrame([], schema).write.parquet(out)
    for (width,) in rows.select(F.octet_length("q").alias("w")).distinct().collect():  # one row a vector length
        same = rows.where(F.octet_length("q") == width)
        refs = same.orderBy(F.xxhash64("id"), "id").limit(REFERENCES).collect()
        refs = np.stack([np.frombuffer(r.q, "<i4") for r in refs]).astype(np.float64)
        laid = stage(same.mapInArrow(_angles(refs), "id long, label long, q binary, norm double, angles binary, near int, turn float")
                     .repartitionByRange(parts, "near", "turn", "id").sortWithinPartitions("near", "turn", "id"), "op12-angles")
        search = laid.select("id", "label", "norm", "q", "angles")
        asked = laid.where(anchor)
        step = max(1, min(ANCHOR_ROWS, ANCHOR_BYTES // max(width, 1)))
        blocks = -(-asked.count() // step)
        for block in range(blocks):
            got = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id").collect()  # about ``step`` rows
            for a in range(0, len(got), step):
                _pass(spark, search, Anchors(got[a:a + step]), positives, negatives, low, high, out)
        discard(laid)
    discard(rows)
    return spark.read.schema(schema).parquet(out)


def _pass(spark: SparkSession, rows: DataFrame, anchors: Anchors, positives: int, negatives: int, low: int, high: int, out: str) -> None:
    """One block of anchors against all rows; the result is added to ``out``."""
    kinds = "anchor long, slot long, id long, score long"
    shared, n = spark.sparkContext.broadcast(anchors), len(anchors.id)
    bottom, top = np.full((n, 1), LEAST), np.full((n, 1), np.iinfo(np.int64).max)
    best = _first(rows.mapInArrow(_search(shared, True, bottom, top, positives), kinds), positives).collect()
    score, ids = np.zeros((n, positives), np.int64), np.zeros((n, positives), np.int64)
    bottom, top = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
    for r in best:  # at most ``positives`` an anchor of the block
        at = (r.anchor, r.rank - 1)
        score[at], ids[at] = r.score, r.id
        bottom[at], top[at] = -(-low * r.score // 100), high * r.score // 100
    if (bottom <= top).any():
        found = _first(rows.mapInArrow(_search(shared, False, bottom, top, negatives), kinds), negatives)
        known = spark.createDataFrame([(a, s, int(anchors.id[a]), int(ids[a, s]), int(score[a, s])) for a in range(n) for s in range(positives)
                                       if bottom[a, s] <= top[a, s]], "anchor long, slot long, anchor_id long, positive_id long, positive_score long")
        (found.join(F.broadcast(known), ["anchor", "slot"])
         .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(out))
    shared.unpersist()


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives(rows.withColumn("label", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")))
