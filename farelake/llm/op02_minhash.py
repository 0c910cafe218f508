"""Near-duplicate documents by bottom-k sketches.

One hash function maps each shingle to 64 bits; a document retains its ``k``
smallest values. Inverted lists of retained values give candidate pairs, the
sketch of a pair's union estimates its similarity, and the full shingle sets
decide.

* Equal sets are collapsed first, so copies never meet in a list.
* A pair that reaches the threshold shares at least ``t`` retained values, so
  only the ``m - t + 1`` rarest values of a sketch of ``m`` need a list
  (prefix filter). For whole sets ``t`` is exact; for sketches it is the mean
  overlap less six standard deviations; a whole set that may meet either takes
  the longer prefix.
* A list is linked in two rounds: first every member with the list's smallest
  document, then, in lists that still hold several components, members of
  different components. Pairs inside a component can change nothing, so a
  large group of copies costs its size, not its square.
* The second round takes sketches of ``FINE`` values of the documents in such
  lists, whole sets for most. Their lists are built anew, and two whole sets
  meet only where the places of the shared value leave room for the overlap
  that the threshold asks of their sizes (positional filter), so variants of a
  text that stay below the threshold seldom meet. Those that do are told apart
  inside the join by the parities of ``PARITIES`` buckets of their full sets:
  two sets differ in at least as many values as parities (no pair is lost).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm.common import components, discard, mix64, only_ids, shingle_set, ship, stage

SIGMAS = 6.0
FINE = 256           # values of a sketch in the second round
PARITIES = 1024      # buckets, a multiple of 64


def sketches(docs: DataFrame, words: int, k: int, parities: int = 0) -> DataFrame:
    """(id, n, f1, f2, sketch): set size, 128-bit set fingerprint, the k smallest
    hashes. Where ``parities`` is given, also (odd0, odd1, ...), 64 buckets of
    the set's hashes each: whether the set holds an odd number of their values."""
    odd = [f"odd{i}" for i in range(parities // 64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, f1, f2, sk, bits = [], [], [], [], np.zeros((b.num_rows, parities), bool)
            for i, t in enumerate(b.column(1)):
                s = shingle_set(t.as_buffer().to_pybytes() if t.is_valid else b"", words)
                u = s.view(np.uint64)
                n.append(len(s))
                f1.append(int(mix64(u).sum(dtype=np.uint64).view(np.int64)))
                f2.append(int(np.bitwise_xor.reduce(mix64(u + np.uint64(1)), initial=np.uint64(0)).view(np.int64)))
                sk.append(s[:k])
                if parities:
                    bucket = mix64(u + np.uint64(2)) % np.uint64(parities)
                    bits[i] = np.bincount(bucket.view(np.int64), minlength=parities) & 1
            longs = np.packbits(bits, axis=1).view(np.int64).reshape(b.num_rows, len(odd))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(sk, pa.list_(pa.int64())), *(pa.array(np.ascontiguousarray(longs[:, i])) for i in range(len(odd)))],
                ["id", "n", "f1", "f2", "sketch", *odd])
    return docs.mapInArrow(run, ", ".join(["id long, n long, f1 long, f2 long, sketch array<long>", *(f"{c} long" for c in odd)]))


def least_overlap(k: int, percent: int) -> int:
    """Values that sketches of ``k`` share at the threshold, less the deviations."""
    share = percent / 100
    return max(1, math.ceil(share * k - SIGMAS * math.sqrt(k * share * (1 - share))))


def inverted_lists(reps: DataFrame, k: int, percent: int) -> DataFrame:
    """(value, id, n, place) of the rarest retained values of each sketch, as
    many as a pair at the threshold can't avoid; ``place`` counts from 1 in the
    order of rarity, values that occur once first (they need no list)."""
    exact = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    sampled = F.least(F.col("n"), F.lit(k)) - least_overlap(k, percent) + 1
    # a whole set may meet a smaller whole set (exact) or a larger one's sketch
    prefix = F.when(100 * F.col("n") <= percent * k, exact).when(F.col("n") <= k, F.greatest(exact, sampled)).otherwise(sampled)
    values = reps.select("id", "n", F.least(F.col("n"), F.lit(k)).alias("m"), F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = Window.partitionBy("id", "n")
    ranked = values.join(shared, "value").withColumns({
        "r": F.row_number().over(own.orderBy("df", "value")), "c": F.count(F.lit(1)).over(own)})
    return ranked.withColumn("place", F.col("r") + F.col("m") - F.col("c")).where(F.col("place") <= prefix).select(
        "value", "id", "n", "place")


def _verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sa = None, None
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column(2), batch.column(3)):
                text = ta.as_buffer().to_pybytes()  # an id may have several texts
                if text != last:
                    last, sa = text, shingle_set(text, words)
                sb = shingle_set(tb.as_buffer().to_pybytes(), words)
                both = len(np.intersect1d(sa, sb, assume_unique=True))
                keep.append(100 * both >= percent * (len(sa) + len(sb) - both))
            m = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(m), batch.column(1).filter(m)], ["u", "v"])
    full = (pairs.join(texts.selectExpr("id b", "text tb"), "b").join(texts.selectExpr("id a", "text ta"), "a")
            .select("a", "b", "ta", "tb").sortWithinPartitions("a"))
    return full.mapInArrow(run, "u long, v long")


def near_components(docs: DataFrame, words: int, percent: int = 80, k: int = 64,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents whose distinct ``words``-word shingle sets have
    ``100 * intersection >= percent * union`` are linked; ``component_id`` is
    the smallest id reachable, ``kept`` marks that document. Null and empty
    texts have no shingles and link with nothing. Rows that repeat an id are
    one document. A row without an id links with nothing: component null, not
    kept. An empty table gives an empty one; other columns are ignored.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sk = stage(sketches(docs, words, k), "op2-sketch")
    linked = sk.where("n > 0 and id is not null")
    sets = stage(linked.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")), "op2-sets")
    same = linked.join(sets, ["n", "f1", "f2"]).select("id", "rep")
    reps = stage(linked.join(sets, ["n", "f1", "f2"]).where("id = rep").select("id", "n", "sketch").dropDuplicates(["id", "n"]),
                 "op2-reps")

    lists = stage(inverted_lists(reps, k, percent).drop("place"), "op2-lists")

    def near(pairs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
        """Filter (a, b) by the sketch of the union, then by the full sets."""
        s = reps.select("id", "n", "sketch")
        e = (pairs.join(s.selectExpr("id a", "n na", "sketch sa"), "a").join(s.selectExpr("id b", "n nb", "sketch sb"), "b")
             .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
             .withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k))
             .withColumn("x", F.size(F.array_intersect(F.array_intersect("u", "sa"), "sb"))))
        sure = F.size("u") < k  # then the union's sketch is the whole union
        bound = F.when(sure, F.lit(float(percent))).otherwise(F.lit(100 * least_overlap(k, percent) / k))
        e = stage(e.where(F.col("x") * 100.0 >= bound * F.size("u")).select("a", "b").distinct(), "op2-pairs")
        need = e.selectExpr("a id").unionByName(e.selectExpr("b id"))
        texts = stage(only_ids(docs, need, "id").dropDuplicates(["id", "text"]), "op2-texts")
        out = stage(_verify(e, texts, words, percent).distinct(), "op2-links")
        discard(texts, e)
        return out

    pivot = lists.groupBy("value").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1")
    first = stage(lists.join(pivot, "value").where("id <> a").select("a", F.col("id").alias("b")).distinct(), "op2-first")
    links = near(first, reps, k)
    comp = components(links)
    mixed = lists.join(comp.selectExpr("node id", "root"), "id", "left").selectExpr(
        "value", "id", "n", "coalesce(root, id) comp")
    open_ = mixed.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("value")
    undecided = mixed.join(open_, "value", "left_semi").select("id")
    fine = sketches(only_ids(docs, undecided, "id"), words, FINE, PARITIES).where("n > 0").dropDuplicates(["id", "n"])
    fine = stage(fine, "op2-fine")
    odd = [f"odd{i}" for i in range(PARITIES // 64)]
    places = stage(inverted_lists(fine, FINE, percent).join(comp.selectExpr("node id", "root"), "id", "left").selectExpr(
        "value", "id", "n", "place", "coalesce(root, id) comp"), "op2-places")
    open_ = places.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("value")
    mixed = stage(places.join(open_, "value", "left_semi").join(fine.select("id", "n", *odd), ["id", "n"]), "op2-mixed")
    discard(places)
    x, y = (mixed.selectExpr("value", f"id {i}", f"n n{i}", f"place p{i}", f"comp c{i}", *(f"{c} {c}{i}" for c in odd)) for i in "xy")
    both = f"ceil({percent} * (nx + ny) / {100 + percent})"  # what whole sets at the threshold share
    differ = " + ".join(f"bit_count({c}x ^ {c}y)" for c in odd)
    rest = (x.join(y, "value").where(f"cx < cy and 100 * least(nx, ny) >= {percent} * greatest(nx, ny)")
            .where(f"greatest(nx, ny) > {FINE} or (px <= nx - {both} + 1 and py <= ny - {both} + 1)")
            .where(f"{differ} <= nx + ny - 2 * {both}")
            .selectExpr("least(x, y) a", "greatest(x, y) b").distinct()
            .join(first, ["a", "b"], "left_anti"))
    links = links.unionByName(near(stage(rest, "op2-rest"), fine, FINE))
    root = components(links).selectExpr("node rep", "root")
    member = same.distinct().join(root, "rep", "left").selectExpr("id", "coalesce(root, rep) root")
    # an id that occurs with several texts joins their components
    multi = member.distinct().groupBy("id").agg(F.min("root").alias("root"), F.max("root").alias("hi"))
    multi = stage(multi, "op2-member")
    fuse = multi.where("root < hi")
    if fuse.take(1):
        joins = member.join(fuse.select("id"), "id", "left_semi").selectExpr("id u", "root v")
        root = components(links.unionByName(joins)).selectExpr("node root", "root up")
        multi = multi.join(root, "root", "left").selectExpr("id", "coalesce(up, root) root")
    out = sk.select("id", "n").join(multi.select("id", "root"), "id", "left").withColumn("component_id", F.coalesce("root", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op2_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies stays. Rows
    without an id can't be told apart by one and stay too."""
    drop = near_components(docs, words=5).where("not kept and doc_id is not null").select(
        F.col("doc_id").alias("dropped")).distinct()
    return docs.join(drop, F.col("doc_id") == F.col("dropped"), "left_anti")
