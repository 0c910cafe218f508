"""The four dashboard screens and the service profile, as lazy plans.

Each screen takes the trip fact (conformed trips) and the zone dimension,
applies the screen's base query and the optional UI filters (``None`` = no
filter; hour 0 is a real value), and returns named DataFrames — the data of
each chart. No chart is collected: the caller pulls the small results. The fares
screen stores its filtered trips once, since its box plot takes several passes.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.operators import aggregates as A
from farelake.operators import joins as J
from farelake.operators import quality as Q
from farelake.operators import setops as S
from farelake.operators import stats as ST
from farelake.operators import topk as K
from farelake.session import shared_table


def _years(df: DataFrame, years: Sequence[int] | None) -> DataFrame:
    return Q.filter_year_in(df, "pickup_datetime", years) if years else df


def demand_base(trips: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    ts = "pickup_datetime"
    df = _years(trips, years).select(
        ts, C.year_of(ts).alias("year"), C.month_of(ts).alias("month"),
        C.translate_label(C.day_name(ts), fixed.WEEKDAY_PT).alias("day_of_week"),
        C.hour_of(ts).alias("pickup_hour"), F.col("service_type"))
    return Q.drop_null_rows(df, ["month", "day_of_week", "pickup_hour", "service_type"])


def screen_demand(trips: DataFrame, years: Sequence[int] | None = None, *, year=None, month=None,
                  weekday=None, hour=None, service=None) -> dict[str, DataFrame]:
    """Screen 1: trips by month and weekday (one labelled series), by hour,
    and by month x service (only the year and service filters apply there)."""
    base = demand_base(trips, years)
    dff = Q.filter_optional(base, {"year": year, "month": month, "day_of_week": weekday,
                                   "pickup_hour": hour, "service_type": service})
    by_month = A.count_by(dff, ["month"]).withColumn("axis", C.month_abbr("month"))
    counts = A.count_by(dff, ["day_of_week"])
    by_weekday = S.densify_domain(counts.withColumnRenamed("day_of_week", "weekday"),
                                  fixed.WEEKDAY_ORDER_PT, "weekday", 0)
    temporal = S.union_labelled({fixed.DIMENSION_LABEL_MONTH: (by_month, "axis", "trips"),
                                 fixed.DIMENSION_LABEL_WEEKDAY: (by_weekday, "weekday", "trips")})
    by_hour = A.count_by(dff, ["pickup_hour"])
    serv = Q.filter_optional(base, {"year": year, "service_type": service})
    by_month_service = A.count_by(serv, ["month", "service_type"])
    return {"temporal": temporal, "by_hour": by_hour, "by_month_service": by_month_service}


def efficiency_base(trips: DataFrame, zones: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    df = J.join_zone_pickup(_years(trips, years), zones)
    df = Q.filter_time_order(Q.filter_positive(df, ["total_amount", "trip_distance"]))
    df = df.withColumns({"year": C.year_of("pickup_datetime"), "month": C.month_of("pickup_datetime"),
                         "duration": C.duration_minutes("pickup_datetime", "dropoff_datetime")})
    df = Q.filter_positive_duration(df, "duration")
    return df.withColumn("revenue_hour", C.revenue_per_hour("total_amount", "duration"))


def screen_efficiency(trips: DataFrame, zones: DataFrame, years: Sequence[int] | None = None, *,
                      year=None, month=None, service=None, region=None,
                      services: Sequence[str] = fixed.SERVICE_TYPES, k: int = 10) -> dict[str, DataFrame]:
    """Screen 2: monthly means of duration, distance, revenue per trip and per
    hour; revenue per hour by service (year filter only, absent -> 0); top
    regions by revenue per hour."""
    base = efficiency_base(trips, zones, years)
    dff = Q.filter_optional(base, {"year": year, "month": month, "service_type": service, "region": region})
    by_year = Q.filter_optional(base, {"year": year})
    return {
        "duration": A.mean_by(dff, ["month"], "duration", "mean_duration_min"),
        "distance": A.mean_by(dff, ["month"], "trip_distance", "mean_distance"),
        "revenue_trip": A.mean_by(dff, ["month"], "total_amount", "mean_revenue_trip"),
        "revenue_hour": A.mean_by(dff, ["month"], "revenue_hour", "mean_revenue_hour"),
        "by_service": S.densify_domain(A.mean_by(by_year, ["service_type"], "revenue_hour", "mean_revenue_hour"),
                                       list(services), "service_type", 0.0),
        "top_regions": K.top_regions_revenue(dff, "region", "revenue_hour", k),
    }


def hotspots_base(trips: DataFrame, zones: DataFrame) -> DataFrame:
    df = J.join_zone_both(Q.filter_not_null(trips, ["pickup_datetime", "dropoff_datetime"]), zones)
    df = Q.filter_time_order(df)
    ts = "pickup_datetime"
    return df.withColumns({"year": C.year_of(ts), "hour": C.hour_of(ts), "day_of_week": C.day_name(ts),
                           "season": C.season_label(C.month_of(ts))})


def screen_hotspots(trips: DataFrame, zones: DataFrame, *, year=None, season=None, service=None,
                    ref_year: int = 2024, k: int = 10, k_hot: int = 5) -> dict[str, DataFrame]:
    """Screen 3: top pickup and drop-off zones, weekday x hour heat map,
    season evolution of the reference year's top pickup zones, filter lists."""
    base = hotspots_base(trips, zones)
    dff = Q.filter_optional(base, {"year": year, "season": season, "service_type": service})
    return {
        "top_pickup": K.top_k_counts(dff, "pickup_zone", k),
        "top_dropoff": K.top_k_counts(dff, "dropoff_zone", k),
        "heatmap": A.count_by(dff, ["day_of_week", "hour"]),
        "evolution": K.hotspot_evolution(dff, "pickup_zone", "pickup_datetime", ref_year, k_hot),
        "years": A.distinct_sorted_values(base, "year"),
        "seasons": A.distinct_sorted_values(base, "season"),
        "services": A.distinct_sorted_values(base, "service_type"),
    }


def fares_base(trips: DataFrame) -> DataFrame:
    df = Q.filter_not_null(trips, ["pickup_datetime", "dropoff_datetime"])
    df = Q.filter_time_order(Q.filter_nonnegative(Q.filter_positive(df, ["fare_amount"]), ["tip_amount"]))
    ts = "pickup_datetime"
    return df.withColumns({"year": C.year_of(ts), "month": C.month_of(ts), "hour": C.hour_of(ts),
                           "season": C.season_label(C.month_of(ts)),
                           "trip_duration": C.duration_minutes(ts, "dropoff_datetime")})


def screen_fares(trips: DataFrame, *, year=None, season=None, service=None) -> dict[str, DataFrame]:
    """Screen 4: mean fare and tip by month, tip trends on duration and
    distance, tip box plot by service."""
    dff = Q.filter_optional(fares_base(trips), {"year": year, "season": season, "service_type": service})
    # stored once: the box plot's passes and the other frames read the same rows
    dff = shared_table(dff.select("month", "service_type", "fare_amount", "tip_amount", "trip_distance", "trip_duration"), "fares")
    return {
        "fare": A.mean_by(dff, ["month"], "fare_amount", "mean_fare"),
        "tip": A.mean_by(dff, ["month"], "tip_amount", "mean_tip"),
        "trend_duration": ST.ols_trend(dff, "tip_amount", "trip_duration"),
        "box_by_service": ST.box_stats(dff, "tip_amount", ["service_type"], stored=True),
        "trend_distance": ST.ols_trend(dff, "tip_amount", "trip_distance"),
    }


def profile_service(df: DataFrame, numeric: Sequence[str], *, category: str | None = None,
                    hist_col: str | None = None, p_lo: float = 0.005, p_hi: float = 0.995,
                    bins: int = 40) -> dict[str, DataFrame]:
    """Profiling of one service: shape, describe, category counts, trimmed
    histogram."""
    out = {"describe": ST.describe_numeric(df, numeric)}
    if category:
        out["categories"] = A.category_counts(df, category)
    if hist_col:
        values = shared_table(df.select(hist_col), "profile")
        lo, hi = ST.quantile_scalars(values, hist_col, [p_lo, p_hi], stored=True)
        out["histogram"] = ST.histogram(values, hist_col, bins, lo, hi)
    return out
