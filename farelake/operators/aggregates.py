"""Grouped counts and means behind the dashboard screens and the profiling.

Every grouping here is a hash aggregate with map-side partial aggregation:
a key that holds a third of all trips (one month, one service) is collapsed
to one partial row per task before the shuffle, so it cannot skew it.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C


def count_rows(df: DataFrame, out: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def count_by(df: DataFrame, keys: Sequence[Column | str], out: str = "trips") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def count_by_month(df: DataFrame, ts: str = "pickup_datetime", out: str = "trips") -> DataFrame:
    return count_by(df, [C.month_of(ts).alias("month")], out)


def count_by_weekday(df: DataFrame, ts: str = "pickup_datetime", out: str = "trips",
                     names: Mapping[str, str] = fixed.WEEKDAY_PT,
                     order: Sequence[str] = fixed.WEEKDAY_ORDER_PT) -> DataFrame:
    """Trips per translated weekday, all 7 days kept (absent -> 0), with the
    display position as ``weekday_order``. The name is translated once."""
    counts = count_by(df, [C.translate_label(C.day_name(ts), names).alias("weekday")], out)
    domain = df.sparkSession.createDataFrame([(d, i) for i, d in enumerate(order)],
                                             "weekday string, weekday_order int")
    # at most 7 (+ null) rows: bounded broadcast
    return (domain.join(F.broadcast(counts), "weekday", "left")
                  .select("weekday", F.coalesce(F.col(out), F.lit(0)).cast("bigint").alias(out), "weekday_order"))


def count_by_hour(df: DataFrame, ts: str = "pickup_datetime", out: str = "trips") -> DataFrame:
    return count_by(df, [C.hour_of(ts).alias("hour")], out)


def count_by_month_service(df: DataFrame, ts: str = "pickup_datetime", service: str = "service_type",
                           out: str = "trips") -> DataFrame:
    return count_by(df, [C.month_of(ts).alias("month"), F.col(service).alias("service_type")], out)


def heatmap_weekday_hour(df: DataFrame, ts: str = "pickup_datetime", out: str = "trips") -> DataFrame:
    return count_by(df, [C.day_name(ts).alias("day_of_week"), C.hour_of(ts).alias("hour")], out)


def heatmap_matrix(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """Weekday x hour as a matrix: one row per weekday, columns h0..h23."""
    hours = list(range(24))
    return (df.withColumn("__h", C.hour_of(ts)).groupBy(C.day_name(ts).alias("day_of_week"))
              .pivot("__h", hours).agg(F.count(F.lit(1)))
              .select("day_of_week", *[F.coalesce(F.col(str(h)), F.lit(0)).alias(f"h{h}") for h in hours]))


def count_by_season_zone(df: DataFrame, ts: str = "pickup_datetime", zone: str = "pickup_zone",
                         labels: Mapping[int, str] = fixed.SEASON_INDEX_PT, out: str = "trips") -> DataFrame:
    return count_by(df, [C.season_label(C.month_of(ts), labels).alias("season"), F.col(zone).alias("zone")], out)


def category_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """value_counts: nulls dropped, most frequent first (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
              .agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), F.asc("value")))


def mean_by(df: DataFrame, keys: Sequence[Column | str], value: Column | str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(C.col_of(value)).alias(out))


def mean_by_month(df: DataFrame, ts: str, value: Column | str, out: str) -> DataFrame:
    return mean_by(df, [C.month_of(ts).alias("month")], value, out)


def mean_duration_by_month(df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime",
                           out: str = "mean_duration_min") -> DataFrame:
    return mean_by_month(df, start, C.duration_minutes(start, end), out)


def mean_distance_by_month(df: DataFrame, ts: str = "pickup_datetime", dist: str = "trip_distance",
                           out: str = "mean_distance") -> DataFrame:
    return mean_by_month(df, ts, dist, out)


def mean_revenue_per_trip(df: DataFrame, ts: str = "pickup_datetime", total: str = "total_amount",
                          out: str = "mean_revenue_trip") -> DataFrame:
    return mean_by_month(df, ts, total, out)


def mean_revenue_per_hour(df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime",
                          total: str = "total_amount", out: str = "mean_revenue_hour") -> DataFrame:
    """Mean of per-trip total / hours (a mean of ratios, as the screen shows)."""
    return mean_by_month(df, start, C.revenue_per_hour(total, C.duration_minutes(start, end)), out)


def revenue_hour_by_service(df: DataFrame, services: Sequence[str] = fixed.SERVICE_TYPES,
                            start: str = "pickup_datetime", end: str = "dropoff_datetime",
                            total: str = "total_amount", service: str = "service_type",
                            out: str = "mean_revenue_hour") -> DataFrame:
    """Mean revenue per hour for each service of a fixed list; absent -> 0."""
    agg = mean_by(df, [F.col(service).alias("service_type")],
                  C.revenue_per_hour(total, C.duration_minutes(start, end)), out)
    from farelake.operators.setops import densify_domain
    return densify_domain(agg, list(services), "service_type", {out: 0.0})


def mean_fare_by_month(df: DataFrame, ts: str = "pickup_datetime", fare: str = "fare_amount",
                       out: str = "mean_fare") -> DataFrame:
    return mean_by_month(df, ts, fare, out)


def mean_tip_by_month(df: DataFrame, ts: str = "pickup_datetime", tip: str = "tip_amount",
                      out: str = "mean_tip") -> DataFrame:
    return mean_by_month(df, ts, tip, out)


def od_pair_stats(df: DataFrame, origin: str = "id_location_pickup", dest: str = "id_location_dropoff",
                  measures: Sequence[str] = ("trip_distance", "total_amount", "fare_amount"),
                  km_measure: str | None = "trip_distance",
                  km_factor: float = fixed.MILES_TO_KM_PROFILE) -> DataFrame:
    """Per pickup/drop-off pair: mean, max, min, count, sum of each measure,
    named ``<measure>_<stat>``; plus ``<km_measure>_mean_km``."""
    aggs = []
    for m in measures:
        x = F.col(m)
        aggs += [F.avg(x).alias(f"{m}_mean"), F.max(x).alias(f"{m}_max"), F.min(x).alias(f"{m}_min"),
                 F.count(x).alias(f"{m}_count"), F.sum(x).alias(f"{m}_sum")]
    out = df.groupBy(F.col(origin).alias(origin), F.col(dest).alias(dest)).agg(*aggs)
    if km_measure:
        out = out.withColumn(f"{km_measure}_mean_km", F.col(f"{km_measure}_mean") * F.lit(km_factor))
    return out


def value_share(df: DataFrame, col: str, value, digits: int = 2) -> DataFrame:
    """How many rows have ``col == value``: n, total, pct (rounded)."""
    agg = df.agg(F.count_if(F.col(col) == F.lit(value)).alias("n"), F.count(F.lit(1)).alias("total"))
    return agg.withColumn("pct", F.round(F.try_divide(F.col("n") * 100.0, F.col("total")), digits))


def removed_rows_audit(before: DataFrame, after: DataFrame, digits: int = 2) -> DataFrame:
    """Rows before, after, removed and % removed, in one aggregation over a
    tagged union (no join)."""
    tagged = (before.select(F.lit(1).alias("__b"), F.lit(0).alias("__a"))
              .unionByName(after.select(F.lit(0).alias("__b"), F.lit(1).alias("__a"))))
    agg = tagged.agg(F.sum("__b").cast("bigint").alias("n_before"), F.sum("__a").cast("bigint").alias("n_after"))
    agg = agg.select(F.coalesce("n_before", F.lit(0)).alias("n_before"),
                     F.coalesce("n_after", F.lit(0)).alias("n_after"))
    agg = agg.withColumn("n_removed", F.col("n_before") - F.col("n_after"))
    return agg.withColumn("pct_removed", F.round(F.try_divide(F.col("n_removed") * 100.0, F.col("n_before")), digits))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop full duplicates (of ``cols`` when given). Partial aggregation
    collapses copies before the shuffle."""
    return (df.select(*cols) if cols else df).distinct()


def distinct_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; the kept row is the smallest of the other columns, so
    the choice is deterministic (a partial-aggregatable ``min`` of a struct)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    agg = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__r"))
    return agg.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


def distinct_sorted_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted non-null choices for a filter list."""
    return df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct().orderBy("value")
