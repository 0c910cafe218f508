"""The dashboard screens read from a stored cube (``operators.cube``).

``refresh_cube`` scans the trips of a run once and commits their cells by month;
months of earlier runs stay as they are, and a month that is loaded again is
replaced whole. The screens then read the cells: their work grows with the
calendar and the locations, not with the trips. Frames equal those of
``plans.screens``; box plots need the trips' quantiles and stay there.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.operators import aggregates as A
from farelake.operators import cube as CU
from farelake.operators import joins as J
from farelake.operators import quality as Q
from farelake.operators import setops as S
from farelake.sinks.commits import Transaction, read_table, snapshot

TABLE = "trip_cube"
SHAPE = "trip_cube_shape"     # its columns, read while no month has cells


def refresh_cube(spark: SparkSession, root: str, trips: DataFrame) -> int:
    """Commit the cells of ``trips`` below ``root``; the manifest's number."""
    tx, cells = Transaction(spark, root), CU.trip_cells(trips)
    if not tx.base.get(TABLE):
        tx.stage(SHAPE, cells.limit(0))
    tx.stage_partitions(TABLE, cells)
    return tx.commit()


def read_cube(spark: SparkSession, root: str, years: Sequence[int] | None = None, months: Sequence[int] | None = None) -> DataFrame:
    """The committed cells, of all periods or of those chosen (only their folders
    are listed). Runs without trips leave a cube without cells."""
    if not snapshot(spark, root.rstrip("/")).get(TABLE):
        return read_table(spark, root, SHAPE)
    return read_table(spark, root, TABLE, years, months)


def _cells(cells: DataFrame, kind: str) -> DataFrame:
    """Cells of one grouping set; the names the screens use for year and month."""
    return (cells.where(F.col("kind") == kind).drop("year", "month")
            .withColumnsRenamed({"pickup_year": "year", "pickup_month": "month"}))


def _weekday_name(names: Sequence[str]):
    """Name of ``weekday`` (1 = Sunday), ``names`` beginning with Monday."""
    return F.element_at(F.array(*[F.lit(n) for n in (names[-1], *names[:-1])]), F.col("weekday"))


def demand(cells: DataFrame, *, year=None, month=None, weekday=None, hour=None, service=None) -> dict[str, DataFrame]:
    """Screen 1, as ``screens.screen_demand``."""
    base = _cells(cells, "time").withColumns({"day_of_week": _weekday_name(fixed.WEEKDAY_ORDER_PT)}).withColumnRenamed("hour", "pickup_hour")
    dff = Q.filter_optional(base, {"year": year, "month": month, "day_of_week": weekday, "pickup_hour": hour, "service_type": service})
    by_month = CU.merge_counts(dff, ["month"], "demand").withColumn("axis", C.month_abbr("month"))
    by_weekday = S.densify_domain(CU.merge_counts(dff, [F.col("day_of_week").alias("weekday")], "demand"),
                                  fixed.WEEKDAY_ORDER_PT, "weekday", 0)
    temporal = S.union_labelled({fixed.DIMENSION_LABEL_MONTH: (by_month, "axis", "trips"),
                                 fixed.DIMENSION_LABEL_WEEKDAY: (by_weekday, "weekday", "trips")})
    serv = Q.filter_optional(base, {"year": year, "service_type": service})
    return {"temporal": temporal, "by_hour": CU.merge_counts(dff, ["pickup_hour"], "demand"),
            "by_month_service": CU.merge_counts(serv, ["month", "service_type"], "demand")}


def efficiency(cells: DataFrame, zones: DataFrame, *, year=None, month=None, service=None, region=None,
               services: Sequence[str] = fixed.SERVICE_TYPES, k: int = 10) -> dict[str, DataFrame]:
    """Screen 2, as ``screens.screen_efficiency``; zones meet the cells."""
    base = J.join_zone_pickup(_cells(cells, "pickup"), zones)
    dff = Q.filter_optional(base, {"year": year, "month": month, "service_type": service, "region": region})
    by_service = CU.merge_means(Q.filter_optional(base, {"year": year}), ["service_type"], "revenue_hour", "mean_revenue_hour")
    regions = CU.merge_means(dff.where(F.col("region").isNotNull()), ["region"], "revenue_hour", "mean_revenue_hour")
    return {
        "duration": CU.merge_means(dff, ["month"], "duration", "mean_duration_min"),
        "distance": CU.merge_means(dff, ["month"], "distance", "mean_distance"),
        "revenue_trip": CU.merge_means(dff, ["month"], "total", "mean_revenue_trip"),
        "revenue_hour": CU.merge_means(dff, ["month"], "revenue_hour", "mean_revenue_hour"),
        "by_service": S.densify_domain(by_service, list(services), "service_type", 0.0),
        "top_regions": regions.where(F.col("mean_revenue_hour").isNotNull())
                              .orderBy(F.desc("mean_revenue_hour"), F.asc("region")).limit(k),
    }


def hotspots(cells: DataFrame, zones: DataFrame, *, year=None, season=None, service=None, ref_year: int = 2024,
             k: int = 10, k_hot: int = 5) -> dict[str, DataFrame]:
    """Screen 3, as ``screens.screen_hotspots``."""
    def part(kind: str) -> DataFrame:
        return _cells(cells, kind).where("n_hotspots > 0").withColumn("season", C.season_label("month"))

    def chosen(df: DataFrame) -> DataFrame:
        return Q.filter_optional(df, {"year": year, "season": season, "service_type": service})

    def top(df: DataFrame, zone: str, k: int) -> DataFrame:
        counts = CU.merge_counts(df.where(F.col(zone).isNotNull()), [zone], "hotspots", "n")
        return counts.orderBy(F.desc("n"), F.asc(zone)).limit(k)
    time = part("time").withColumn("day_of_week", _weekday_name(list(fixed.WEEKDAY_PT)))
    pickup = chosen(J.join_zone_pickup(part("pickup"), zones, out="pickup_zone"))
    dropoff = chosen(J.join_zone_pickup(part("dropoff"), zones, "id_location_dropoff", "dropoff_zone"))
    hot = J.join_semi_hotspots(pickup, top(pickup.where(F.col("year") == ref_year), "pickup_zone", k_hot), "pickup_zone")
    return {
        "top_pickup": top(pickup, "pickup_zone", k),
        "top_dropoff": top(dropoff, "dropoff_zone", k),
        "heatmap": CU.merge_counts(chosen(time), ["day_of_week", "hour"], "hotspots"),
        "evolution": CU.merge_counts(hot, ["season", F.col("pickup_zone").alias("zone")], "hotspots"),
        "years": A.distinct_sorted_values(time, "year"),
        "seasons": A.distinct_sorted_values(time, "season"),
        "services": A.distinct_sorted_values(time, "service_type"),
    }


def fares(cells: DataFrame, *, year=None, season=None, service=None) -> dict[str, DataFrame]:
    """Screen 4 without the box plot, as ``screens.screen_fares``."""
    base = _cells(cells, "time").withColumn("season", C.season_label("month"))
    dff = Q.filter_optional(base, {"year": year, "season": season, "service_type": service})
    return {
        "fare": CU.merge_means(dff, ["month"], "fare", "mean_fare"),
        "tip": CU.merge_means(dff, ["month"], "tip", "mean_tip"),
        "trend_duration": CU.merge_line(dff, "tip_duration"),
        "trend_distance": CU.merge_line(dff, "tip_distance"),
    }
