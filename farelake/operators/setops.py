"""Set operations and densifying."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns absent from a frame become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(dfs))


def union_strict(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by name; every frame must have the same columns."""
    return reduce(lambda a, b: a.unionByName(b), list(dfs))


def union_labelled(parts: Mapping[str, tuple[DataFrame, str, str]], axis: str = "axis",
                   value: str = "trips", label: str = "dimension") -> DataFrame:
    """Stack series with a label: ``{label: (df, axis_col, value_col)}`` ->
    (axis as text, value, label)."""
    frames = [df.select(F.col(a).cast("string").alias(axis), F.col(v).alias(value), F.lit(name).alias(label))
              for name, (df, a, v) in parts.items()]
    return union_strict(frames)


COPY_CHUNK = 10_000


def rows_removed(before: DataFrame, after: DataFrame, cols: Sequence[str] | None = None,
                 distinct: bool = True, chunk: int = COPY_CHUNK) -> DataFrame:
    """Rows of ``before`` not in ``after`` on ``before``'s columns.

    ``distinct=True``: EXCEPT DISTINCT. Both sides are de-duplicated first
    (partial aggregation collapses copies before any shuffle), then a
    null-safe anti join, so a group of copies never lands whole in one task.

    ``distinct=False``: EXCEPT ALL. Net copies per distinct row are
    ``count(before) - count(after)`` (one aggregation over a tagged union).
    Rows are re-expanded in chunks of at most ``chunk`` copies, and the chunks
    are spread over tasks before the final expansion, so a row with millions of
    copies is not generated by one task.
    """
    cols = list(cols) if cols else list(before.columns)
    b, a = before.select(*cols), after.select(*cols)
    if distinct:
        left, right = b.distinct(), a.distinct().select(*[F.col(c).alias(f"__r_{c}") for c in cols])
        cond = [left[c].eqNullSafe(right[f"__r_{c}"]) for c in cols]
        return left.join(right, cond, "left_anti")
    tagged = b.withColumn("__w", F.lit(1)).unionByName(a.withColumn("__w", F.lit(-1)))
    net = tagged.groupBy(*cols).agg(F.sum("__w").alias("__n")).where(F.col("__n") > 0)
    chunks = net.select(*cols, F.col("__n"), F.explode(
        F.sequence(F.lit(0).cast("bigint"), ((F.col("__n") - 1) / chunk).cast("bigint"))).alias("__k"))
    sized = chunks.withColumn("__m", F.least(F.lit(chunk).cast("bigint"), F.col("__n") - F.col("__k") * chunk))
    spread = sized.repartition(F.col("__k"), *[F.col(c) for c in cols]) if chunk else sized
    return spread.select(*cols, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__m"))).alias("__i")).drop("__i")


def densify_domain(agg: DataFrame, domain: DataFrame | Sequence, key: str,
                   fill: Mapping[str, object] | object = 0) -> DataFrame:
    """Keep every domain value; missing aggregate values -> ``fill``.

    ``domain`` is a list of values or a one-column frame. The aggregate side
    has at most one row per domain key here, so the domain is the probe side.
    """
    spark = agg.sparkSession
    if not isinstance(domain, DataFrame):
        dtype = agg.schema[key].dataType.simpleString()
        domain = spark.createDataFrame([(v,) for v in domain], f"{key} {dtype}")
    else:
        domain = domain.select(F.col(domain.columns[0]).alias(key))
    out = domain.join(agg, key, "left")
    cols = [c for c in agg.columns if c != key]
    fills = fill if isinstance(fill, Mapping) else {c: fill for c in cols}
    return out.select(key, *[F.coalesce(F.col(c), F.lit(fills[c]).cast(agg.schema[c].dataType)).alias(c)
                             if c in fills else F.col(c) for c in cols])
