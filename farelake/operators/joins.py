"""Join operators.

Dimension lookups are left joins of a big trip frame to a small table. A side
is broadcast only behind a size check (``checked_broadcast``): a row-count
bound read from the table itself; above it the join falls back to a shuffle
join, where AQE's skew-join split takes care of a hot key (a zone holding a
third of all trips).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.session import shared_table

DEFAULT_BROADCAST_ROWS = 100_000


def checked_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Return the dimension as a broadcast side if it has at most ``max_rows``
    rows, else as a table written once (a shuffle join is planned). Either way
    the rows and keys that are joined are fixed here.

    The check fetches at most ``max_rows + 1`` rows. When they fit, those very
    rows become the broadcast relation, so the size proof and the broadcast
    data are the same thing and the dimension's plan is not run a second time
    for the join.
    """
    rows = dim.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return shared_table(dim, "dimension")
    local = dim.sparkSession.createDataFrame(rows, schema=dim.schema, verifySchema=False)
    return F.broadcast(local)


def join_payment_description(df: DataFrame, payment_dim: DataFrame, key: str = "payment_type") -> DataFrame:
    """Left join to the payment code table; unknown codes get a null description."""
    return df.join(checked_broadcast(payment_dim), on=key, how="left")


def join_dim_keys(df: DataFrame, dim: DataFrame, natural: str, sk: str, fk: str | None = None,
                  *, fact_natural: str | None = None, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Put the dimension's surrogate key on the fact (left join, name ``fk``)."""
    fk = fk or sk
    fact_natural = fact_natural or natural
    side = dim.select(F.col(natural).alias("__nk"), F.col(sk).alias(fk))
    side = checked_broadcast(side, max_broadcast_rows)
    return (df.join(side, F.col(fact_natural) == F.col("__nk"), "left").drop("__nk"))


def join_zone(df: DataFrame, zones: DataFrame, loc_col: str, out: str, *,
              zone_id: str = "id_location", zone_name: str = "zone",
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left join the zone name for one location column; ids are compared as
    bigint on both sides (the fact keeps them numeric, the lookup as text)."""
    side = zones.select(F.col(zone_id).try_cast("bigint").alias("__zid"), F.col(zone_name).alias(out))
    side = checked_broadcast(side, max_broadcast_rows)
    return df.join(side, F.col(loc_col).try_cast("bigint") == F.col("__zid"), "left").drop("__zid")


def join_zone_pickup(df: DataFrame, zones: DataFrame, loc_col: str = "id_location_pickup",
                     out: str = "region", **kw) -> DataFrame:
    return join_zone(df, zones, loc_col, out, **kw)


def join_zone_both(df: DataFrame, zones: DataFrame, pickup: str = "id_location_pickup",
                   dropoff: str = "id_location_dropoff", **kw) -> DataFrame:
    """The same zone table joined twice, as pickup_zone and dropoff_zone."""
    out = join_zone(df, zones, pickup, "pickup_zone", **kw)
    return join_zone(out, zones, dropoff, "dropoff_zone", **kw)


def join_full_outer_diff(new: DataFrame, current: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """New vs current by natural key; columns prefixed ``new_`` / ``cur_``."""
    keys = [key] if isinstance(key, str) else list(key)
    n = new.select(*[F.col(c).alias(c if c in keys else f"new_{c}") for c in new.columns])
    n = n.withColumn("__in_new", F.lit(True))
    c = current.select(*[F.col(x).alias(x if x in keys else f"cur_{x}") for x in current.columns])
    c = c.withColumn("__in_cur", F.lit(True))
    out = n.join(c, on=keys, how="full_outer")
    return (out.withColumn("in_new", F.coalesce(F.col("__in_new"), F.lit(False)))
               .withColumn("in_current", F.coalesce(F.col("__in_cur"), F.lit(False)))
               .drop("__in_new", "__in_cur"))


def join_anti_unchanged(current: DataFrame, changed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose key is not in ``changed``."""
    keys = [key] if isinstance(key, str) else list(key)
    return current.join(changed.select(*keys), on=keys, how="left_anti")


def join_semi_hotspots(df: DataFrame, top: DataFrame, zone_col: str, top_col: str | None = None) -> DataFrame:
    """Keep trips whose zone is in ``top`` (a top-k result: k rows, so the
    broadcast is bounded by k)."""
    top_col = top_col or zone_col
    side = F.broadcast(top.select(F.col(top_col).alias("__z")).distinct())
    return df.join(side, F.col(zone_col) == F.col("__z"), "left_semi")
