"""As-of join: each fact meets the version of its key that is valid at its time.

Versions and facts are united, ordered by key and time, and the last version is
carried forward over the facts that follow it, so there is no inequality join.
A key with more than ``hot_rows`` facts would be one window in one task; its
time axis is cut into slices at sketched quantiles, and the version valid at a
slice's start is put there too. Cold keys keep one slice. Facts are shuffled
once; the list of hot keys (fewer than facts / hot_rows) is joined by equality.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.operators.joins import checked_broadcast

HOT_ROWS = 10_000_000     # facts of a key in one task


def _hot_slices(facts: DataFrame, key: str, ts: str, hot_rows: int) -> DataFrame:
    """(__k, __cuts): for each key with more than ``hot_rows`` facts, the times
    at which it is cut into parts of about that many."""
    many = facts.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
    many = checked_broadcast(many)
    parts = many.agg(F.max(F.ceil(F.col("__n") / hot_rows))).first()[0]
    if not parts:
        return many.select("__k", F.expr("cast(array() as array<bigint>)").alias("__cuts"))
    grid = [i / int(parts) for i in range(1, int(parts))]     # the hottest key's parts; fewer rows make smaller ones
    hot = facts.select(F.col(key).alias("__k"), _micros(ts).alias("__us")).join(many, "__k")
    cuts = hot.groupBy("__k").agg(F.array_distinct(F.percentile_approx("__us", grid, 10_000)).alias("__cuts"))
    return checked_broadcast(cuts)


def _micros(ts: str):
    """Microseconds of a timestamp or date, whatever its time zone kind."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))


def asof_join(facts: DataFrame, versions: DataFrame, key: str, ts: str, attrs: Sequence[str], *, eff: str = "effective_date",
              end: str | None = "end_date", version_key: str | None = None, prefix: str = "", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row of ``facts`` with ``attrs`` (named ``prefix`` + name) of the
    version of its key that holds at ``ts``: the last with ``eff`` <= ts, if ts is
    before its ``end`` (null or no column: open). Null where there is none, where
    the key or the time is null, or in a gap between versions. Of versions of one
    key and time of start, the one that ends last holds (open: last of all).
    """
    vkey, attrs = version_key or key, list(attrs)
    kind = facts.schema[key].dataType
    v = versions.where(F.col(vkey).isNotNull() & F.col(eff).isNotNull()).select(
        F.col(vkey).cast(kind).alias("__k"), _micros(eff).alias("__t"),
        (_micros(end) if end else F.lit(None).cast("bigint")).alias("__end"), *[F.col(a).alias(f"__a{i}") for i, a in enumerate(attrs)])
    # one version a key and start, with the start of the next
    body = F.struct(F.coalesce("__end", F.lit(2 ** 63 - 1)).alias("last"), "__end", *[f"__a{i}" for i in range(len(attrs))])
    v = v.groupBy("__k", "__t").agg(F.max(body).alias("__v"))
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    f = facts.withColumn("__us", _micros(ts))
    slices = _hot_slices(facts.where(usable), key, ts, hot_rows)

    def slice_of(t):
        """How many cuts lie at or before ``t``; 0 for cold keys."""
        return F.coalesce(F.size(F.filter("__cuts", lambda c: c <= t)), F.lit(0))
    rows = f.where(usable).join(slices.withColumnRenamed("__k", "__fk"), F.col(key) == F.col("__fk"), "left").select(
        F.col(key).alias("__k"), slice_of(F.col("__us")).alias("__s"), F.col("__us").alias("__t"), F.lit(1).alias("__kind"),
        F.struct(*facts.columns).alias("__f"))
    following = F.lead("__t").over(Window.partitionBy("__k").orderBy("__t"))
    held = v.withColumn("__next", following).join(slices, "__k", "left")
    # a version is put into its own slice and into those that start while it is the last
    upto = F.coalesce(slice_of(F.col("__next") - 1), F.lit(0))
    upto = F.when(F.col("__next").isNull(), F.coalesce(F.size("__cuts"), F.lit(0))).otherwise(upto)
    held = held.select("__k", F.explode(F.sequence(slice_of(F.col("__t")), upto)).alias("__s"), "__t", F.lit(0).alias("__kind"), "__v")
    both = rows.withColumn("__v", F.lit(None).cast(held.schema["__v"].dataType)).unionByName(
        held.withColumn("__f", F.lit(None).cast(rows.schema["__f"].dataType)))
    before = Window.partitionBy("__k", "__s").orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("__v", F.last("__v", ignorenulls=True).over(before)).where(F.col("__kind") == 1)
    holds = F.col("__v.__end").isNull() | (F.col("__t") < F.col("__v.__end"))
    types = {a: versions.schema[a].dataType for a in attrs}
    got = carried.select("__f.*", *[F.when(holds, F.col(f"__v.__a{i}")).alias(f"{prefix}{a}") for i, a in enumerate(attrs)])
    rest = facts.where(~usable).select("*", *[F.lit(None).cast(types[a]).alias(f"{prefix}{a}") for a in attrs])
    return got.unionByName(rest)
