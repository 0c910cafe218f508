"""Top-k over keys too many to shuffle (origin-destination pairs, pairs by day).

``topk.top_k_counts`` groups by the key: right for zones, but for pairs it moves
every distinct key of every task. Here three bounded passes give the same rows:

1. a mergeable frequent-items summary a period names candidates (summaries of
   months merge, so stored ones serve again);
2. one pass counts the candidates exactly and everything else by hash bucket. A
   bucket's count is an upper bound of every key in it;
3. only keys of buckets that reach the k-th candidate's count could still belong
   to the top, ties included; they alone are counted by key.

The result never depends on how good the summary is: a poor one leaves more
buckets to the third pass, in the worst case all, which is the plain grouping.
Exchanges carry at most ``items`` candidates and ``buckets`` counts a task and
the keys of the third pass.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEMS = 20_000            # items a summary tracks
BUCKETS = 1 << 18         # counts of the rest: 2 MB a task


def _digest(cols: Sequence[str]) -> Column:
    return F.xxhash64(*cols)


def _set(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols), how="any")


def key_summaries(df: DataFrame, cols: Sequence[str], by: Sequence[Column | str] = (), items: int = ITEMS) -> DataFrame:
    """(by..., summary): one frequent-items summary of the key's 64-bit digest a
    group; rows with a null in the key are left out. One small row a group, which
    can be stored and merged with those of other inputs."""
    return _set(df, cols).withColumn("__h", _digest(cols)).groupBy(*by).agg(
        F.expr(f"approx_top_k_accumulate(__h, {items})").alias("summary"))


def candidates(summaries: DataFrame, items: int = ITEMS) -> DataFrame:
    """(digest) of the keys that the merged summaries hold: ``items`` at most."""
    merged = summaries.agg(F.expr(f"approx_top_k_combine(summary, {items})").alias("summary"))
    return merged.select(F.expr(f"inline(approx_top_k_estimate(summary, {items}))")).select(F.col("item").alias("digest")).distinct()


def top_k_keys(df: DataFrame, cols: Sequence[str], k: int = 10, out: str = "n", *, summaries: DataFrame | None = None,
               items: int = ITEMS, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` most frequent keys ``cols`` with their exact counts, ties by the
    key's columns in order; keys with a null are left out.

    ``summaries`` are those of ``key_summaries`` over parts of ``df`` (the same
    ``cols``); without them ``df`` is summarised here. An empty input, or one
    with null keys only, gives no rows.
    """
    cols = list(cols)
    order = [F.desc(out), *[F.asc(c) for c in cols]]
    keyed = _set(df, cols).select(*cols, _digest(cols).alias("__h"))
    named = candidates(key_summaries(df, cols, items=items) if summaries is None else summaries, items)
    # ``items`` digests at most: a bounded broadcast
    named = F.broadcast(named.select(F.col("digest").alias("__h"), F.lit(True).alias("__c")))
    split = keyed.join(named, "__h", "left")
    rest = F.col("__c").isNull()
    counted = split.groupBy(F.when(~rest, F.struct(*cols)).alias("__key"),
                            F.when(rest, F.pmod("__h", F.lit(buckets))).alias("__b")).agg(F.count(F.lit(1)).alias(out))
    from farelake.session import shared_table
    counted = shared_table(counted, "top-k")      # two readers, one pass over the trips
    exact = counted.where("__key is not null").select("__key.*", out)
    kth = exact.orderBy(F.desc(out)).limit(k).agg(F.count(F.lit(1)), F.min(out)).first()     # one row
    bound = kth[1] if kth[0] == k else 0
    open_ = counted.where(F.col("__b").isNotNull() & (F.col(out) >= F.lit(bound))).select("__b")
    if open_.take(1):
        # ``buckets`` numbers at most: a bounded broadcast
        late = split.where(rest).withColumn("__b", F.pmod("__h", F.lit(buckets))).join(F.broadcast(open_), "__b", "left_semi")
        exact = exact.unionByName(late.groupBy(*cols).agg(F.count(F.lit(1)).alias(out)))
    return exact.orderBy(*order).limit(k)


def pair_evolution(df: DataFrame, cols: Sequence[str], period: Column, k: int = 5, out: str = "trips", *,
                   reference: DataFrame | None = None, **kw) -> DataFrame:
    """Counts per ``period`` of the ``k`` most frequent keys of ``reference`` (rows
    of ``df``; all by default). The top keys are a broadcast of ``k`` rows."""
    top = top_k_keys(df if reference is None else reference, cols, k, **kw).select(*cols)
    return df.join(F.broadcast(top), list(cols), "left_semi").groupBy(period, *cols).agg(F.count(F.lit(1)).alias(out))
