"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to the signs of random projections, orders the
vectors lexicographically by the concatenated bits, and compares each with the
next ``window`` in that order. Pairs of cosine >= ``threshold`` (double
precision) are links; the links of all passes are united.

Equal vectors are collapsed first, so copies don't fill the windows. Afterwards
the members of each component are compared with each other, in blocks, because
a window shorter than a group can't show all its links: most are settled by the
angles to the component's centre (two angles that add up to less than the
threshold's need no comparison), the rest by matrix products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import components, ship, stage

BLOCK = 1024


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length one; null where they can't be compared."""
    for b in batches:
        out = []
        for v in b.column(1):
            x = np.array(v.as_py() if v.is_valid else [], dtype=np.float64)  # None becomes nan
            norm = 0.0
            if len(x) and np.isfinite(x).all() and (big := np.abs(x).max()) > 0:
                x = x / big  # else squares may overflow or vanish
                norm = math.sqrt(float(x @ x))
            out.append((x / norm).tobytes() if norm else None)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["id", "vec"])


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), -1)


def _hash(dim: int, passes: int, seed: int):
    """Rows (pass, key, id, vec); the key's order is that of the bits."""
    planes = np.random.default_rng(seed).standard_normal((passes, dim, 63))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = 1 << np.arange(62, -1, -1, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1))
                for p in range(passes):
                    key = ((x @ planes[p]) > 0).astype(np.int64) @ weight
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), pa.array(key), b.column(0), b.column(1)],
                                                     ["pass", "key", "id", "vec"])
    return run


def _windows(window: int, threshold: float):
    """Links among rows at most ``window`` apart in one pass. The ends of each
    partition are handed on (u null), so that the windows across partitions can
    be closed."""
    def pairs(p: np.ndarray, ids: np.ndarray, x: np.ndarray, old: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The first ``old`` rows have been compared with each other before."""
        u, v = [], []
        for d in range(1, min(window, len(ids) - 1) + 1):
            ok = (p[d:] == p[:-d]) & (np.einsum("ij,ij->i", x[d:], x[:-d]) >= threshold)
            ok[:max(0, old - d)] = False
            u.append(ids[:-d][ok])
            v.append(ids[d:][ok])
        return (np.concatenate(u), np.concatenate(v)) if u else (ids[:0], ids[:0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, kept, head, n_head = TaskContext.get().partitionId(), None, [], 0
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("side", pa.int64()), ("at", pa.int64()), ("pass", pa.int32()), ("vec", pa.binary())])

        def ends(rows: pa.Table, side: int, end: int) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), rows["id"].combine_chunks(), pa.array([side] * n, pa.int64()),
                 pa.array(np.arange(n) + end * window), rows["pass"].combine_chunks(), rows["vec"].combine_chunks()], schema=schema)

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b.select(["pass", "id", "vec"])])
            if n_head < window:
                head.append(t.slice(0, window - n_head))
                n_head += head[-1].num_rows
            t = pa.concat_tables([kept, t]) if kept is not None else t
            old = kept.num_rows if kept is not None else 0
            p, ids, x = t["pass"].to_numpy(), t["id"].to_numpy(), _matrix(t["vec"])
            u, v = pairs(p, ids, x, old)
            n = len(u)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                                              pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=schema)
            kept = t.slice(max(0, t.num_rows - window))
        if kept is not None:
            yield ends(kept, part, 0)
            yield ends(pa.concat_tables(head), part - 1, 1)

    def border(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        u, v = pairs(t["pass"].to_numpy(), t["id"].to_numpy(), _matrix(t["vec"]))
        return pa.table({"u": u, "v": v})
    return run, border


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A component's vector sum, one row a batch and component."""
    for b in batches:
        if b.num_rows:
            root, where = np.unique(b.column(0).to_numpy(), return_inverse=True)
            x = _matrix(b.column(1))
            total = np.zeros((len(root), x.shape[1]))
            np.add.at(total, where, x)
            yield pa.RecordBatch.from_arrays([pa.array(root), pa.array([r.tobytes() for r in total], pa.binary())], ["root", "vec"])


def _centre(t: pa.Table) -> pa.Table:
    c = _matrix(t["vec"]).sum(axis=0)
    return pa.table({"root": t["root"][:1], "centre": pa.array([(c / (np.sqrt(c @ c) or 1.0)).tobytes()], pa.binary())})


def _mark_core(threshold: float):
    """Members whose angle to the centre is below half the threshold's: any two are linked."""
    bound = math.cos(math.acos(threshold) / 2 - 1e-6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                core = np.array([c is not None and float(np.frombuffer(v) @ np.frombuffer(c)) >= bound
                                 for v, c in zip(b["vec"].to_pylist(), b["centre"].to_pylist())])
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(core)], ["root", "id", "copies", "vec", "size", "core"])
    return run


def _block_links(threshold: float):
    """Copies linked to each member, from one block of members (side 0) against
    one block of members outside the core (side 1), component by component."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("root", "ascending"), ("side", "ascending")])
        root, side = t["root"].to_numpy(), t["side"].to_numpy()
        ids, copies, core = t["id"].to_numpy(), t["copies"].to_numpy(), t["core"].to_numpy()
        x, who, n = _matrix(t["vec"]), [], []
        cut = np.flatnonzero(np.diff(root, prepend=root[:1] - 1, append=root[-1:] + 1))
        for a, b in zip(cut, cut[1:]):
            m = a + int(np.searchsorted(side[a:b], 1))
            for lo in range(a, m, 256):
                at, to = slice(lo, min(lo + 256, m)), slice(m, b)
                hit = (x[at] @ x[to].T >= threshold) & (ids[at, None] != ids[None, to])
                who += [ids[at], ids[to]]
                n += [hit @ copies[to], (copies[at] * core[at]) @ hit]
        return pa.table({"id": np.concatenate(who) if who else ids[:0], "n": np.concatenate(n) if n else copies[:0]})
    return run


def vector_components(vectors: DataFrame, threshold: float = 0.95, passes: int = 24, window: int = 48, seed: int = 7,
                      id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; vectors of different lengths never link. Rows without
    an id link with nothing (component null, not kept). Copies link with each
    other. ``passes`` and ``window`` set the recall of pairs: a pair whose bits
    each agree with probability q meets in a pass with about q to the power
    log2(rows / window). An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    unit = stage(rows.mapInArrow(_unit, "id long, vec binary"), "op8-unit")
    good = unit.where("vec is not null and id is not null")
    reps = stage(good.groupBy("vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")).select("id", "copies", "vec"), "op8-reps")
    links = None
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for (width,) in reps.select(F.octet_length("vec").alias("w")).distinct().collect():  # one row a vector length
        same = reps.where(F.octet_length("vec") == width).select("id", "vec")
        run, border = _windows(window, threshold)
        hashed = same.mapInArrow(_hash(width // 8, passes, seed), "pass int, key long, id long, vec binary")
        ordered = hashed.repartitionByRange(n, "pass", "key", "id").sortWithinPartitions("pass", "key", "id")
        found = stage(ordered.mapInArrow(run, "u long, v long, side long, at long, pass int, vec binary"), "op8-pass")
        # the last window of a partition with the first of the next
        edge = (found.where("u is null").selectExpr("side", "at", "pass", "v id", "vec")
                .groupBy("side").applyInArrow(border, "u long, v long"))
        pairs = found.where("u is not null").select("u", "v").unionByName(edge)
        links = pairs if links is None else links.unionByName(pairs)
    if links is None:
        links = reps.selectExpr("id u", "id v").where("false")
    comp = components(links)
    member = stage(reps.join(comp.selectExpr("node id", "root"), "id"), "op8-member")

    # the other links of a component: the core is settled by its size, the rest block against block
    size = member.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sized = member.join(size, "root")
    centre = (sized.where(f"size > {BLOCK}").select("root", "vec").mapInArrow(_sums, "root long, vec binary")
              .groupBy("root").applyInArrow(_centre, "root long, centre binary"))
    marked = stage(sized.join(centre, "root", "left").select("root", "id", "copies", "vec", "size", "centre")
                   .mapInArrow(_mark_core(threshold), "root long, id long, copies long, vec binary, size long, core boolean"), "op8-core")
    count = marked.groupBy("root").agg(F.sum(F.when(~F.col("core"), 1).otherwise(0)).alias("outer"),
                                       F.sum(F.when(F.col("core"), F.col("copies")).otherwise(0)).alias("core_copies"))
    marked = marked.join(count, "root").withColumns(
        {"nb": F.expr(f"cast(ceil(size / {BLOCK}) as int)"), "nc": F.expr(f"cast(ceil(outer / {BLOCK}) as int)"),
         "h": F.xxhash64("id")}).where("outer > 0 or core")
    cols = ["id", "copies", "vec", "core"]
    left = marked.where("nc > 0").select("root", F.expr("cast(pmod(h, nb) as int) b"), F.explode(F.expr("sequence(0, nc - 1)")).alias("c"),
                                         F.lit(0).alias("side"), "nb", *cols)
    right = marked.where("not core").select("root", F.explode(F.expr("sequence(0, nb - 1)")).alias("b"), F.expr("cast(pmod(h, nc) as int) c"),
                                            F.lit(1).alias("side"), "nb", *cols)
    # a group holds one pair of blocks, or many small components
    both = left.unionByName(right).withColumn("g", F.when(F.col("nb") > 1, F.xxhash64("root", "b", "c")).otherwise(F.pmod(F.xxhash64("root"), F.lit(n))))
    inner = (both.groupBy("g").applyInArrow(_block_links(threshold), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")))
    inner = inner.join(marked.where("core").selectExpr("id", "core_copies - copies as own"), "id", "full").selectExpr(
        "id", "coalesce(n, 0) + coalesce(own, 0) as n")
    rep = (reps.join(comp.selectExpr("node id", "root"), "id", "left").join(inner, "id", "left")
           .selectExpr("vec", "coalesce(root, id) root", "coalesce(n, 0) + copies - 1 as n"))
    done = unit.join(rep, "vec", "left").select(
        F.col("id").alias(id_col), F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"))
    return done.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def op8_projection_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
