"""The trips' mergeable cube: counts, sums and centred squares by small cells.

``trip_cells`` reads the trips once and groups them by three grouping sets: by
weekday and hour, by pickup location, by drop-off location, each with the
pickup's year, month and service. A cell holds, for each screen's row filter,
what a mean or a least-squares line needs and nothing that would have to look at
a trip again. Cells are mergeable: those of two inputs add up to those of their
union (``merge_means``, ``merge_line``), so months are stored one by one and a
new month never touches the others (``plans.cube_screens``).

A cell's size is bounded by the calendar, the services and the locations, not by
the trips: every grouping is a hash aggregate with map-side partial aggregation,
and zone names are joined to the cells, never to the trips.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions import columns as C

KEYS = ["year", "month", "pickup_year", "pickup_month", "service_type"]
AXES = ["weekday", "hour", "id_location_pickup", "id_location_dropoff"]
KINDS = {"time": ["weekday", "hour"], "pickup": ["id_location_pickup"], "dropoff": ["id_location_dropoff"]}

# means: measure -> (the filter whose trips it covers, the value)
MEANS = {"duration": "efficiency", "distance": "efficiency", "total": "efficiency", "revenue_hour": "efficiency",
         "fare": "fares", "tip": "fares"}
LINES = {"tip_duration": ("tip", "duration"), "tip_distance": ("tip", "distance")}


def _filters(ts: str, end: str) -> dict[str, Column]:
    """Each screen's row filter."""
    ordered = F.col(end) > F.col(ts)
    return {
        "demand": F.col("service_type").isNotNull(),
        "efficiency": ordered & (F.col("total_amount") > 0) & (F.col("trip_distance") > 0),
        "hotspots": ordered,
        "fares": ordered & (F.col("fare_amount") > 0) & (F.col("tip_amount") >= 0),
    }


def trip_cells(trips: DataFrame, ts: str = "pickup_datetime", end: str = "dropoff_datetime") -> DataFrame:
    """One row per cell, told apart by ``kind`` (time, pickup, dropoff).

    ``year``/``month`` are the period of the trips' file where they carry it, else
    that of the pickup; ``pickup_year``/``pickup_month`` are the pickup's, so a
    stray trip of another month counts in its own month and is replaced with its
    file. Trips without a pickup time are in no screen and in no cell. An empty
    input gives no cells.
    """
    own = {} if {"year", "month"} <= set(trips.columns) else {"year": C.year_of(ts), "month": C.month_of(ts)}
    df = trips.where(F.col(ts).isNotNull()).withColumns({
        **own, "pickup_year": C.year_of(ts), "pickup_month": C.month_of(ts),
        "weekday": C.day_of_week(ts), "hour": C.hour_of(ts), "duration": C.duration_minutes(ts, end)})
    value = {"duration": F.col("duration"), "distance": F.col("trip_distance"), "total": F.col("total_amount"),
             "revenue_hour": C.revenue_per_hour("total_amount", "duration"), "fare": F.col("fare_amount"), "tip": F.col("tip_amount")}
    rows = _filters(ts, end)
    df = df.select(*KEYS, *AXES, *[F.coalesce(f, F.lit(False)).alias(f"is_{name}") for name, f in rows.items()],
                   *[v.cast("double").alias(f"v_{m}") for m, v in value.items()])
    aggs = [F.count_if(F.col(f"is_{name}")).alias(f"n_{name}") for name in rows]
    for m, name in MEANS.items():
        x = F.when(F.col(f"is_{name}"), F.col(f"v_{m}"))
        aggs += [F.count(x).alias(f"c_{m}"), F.sum(x).alias(f"s_{m}")]
    for line, (y, x) in LINES.items():
        y, x = (F.when(F.col("is_fares"), F.col(f"v_{c}")) for c in (y, x))
        aggs += [F.regr_count(y, x).alias(f"{line}_n"), F.regr_avgx(y, x).alias(f"{line}_x"), F.regr_avgy(y, x).alias(f"{line}_y"),
                 F.regr_sxx(y, x).alias(f"{line}_xx"), F.regr_sxy(y, x).alias(f"{line}_xy"), F.regr_syy(y, x).alias(f"{line}_yy")]
    sets = [[F.col(c) for c in KEYS + axes] for axes in KINDS.values()]
    kind = F.when(F.grouping("weekday") == 0, "time").when(F.grouping("id_location_pickup") == 0, "pickup").otherwise("dropoff")
    return df.groupingSets(sets, *[F.col(c) for c in KEYS + AXES]).agg(kind.alias("kind"), *aggs)


def merge_counts(cells: DataFrame, keys: Sequence[Column | str], name: str, out: str = "trips") -> DataFrame:
    """Trips of the filter ``name`` per key; keys without any are absent, as in a
    count of the trips themselves."""
    cells = cells.where(F.col(f"n_{name}") > 0)
    return cells.groupBy(*keys).agg(F.sum(f"n_{name}").alias(out))


def merge_means(cells: DataFrame, keys: Sequence[Column | str], measure: str, out: str) -> DataFrame:
    """Mean of a measure per key: the cells' sums over their counts. A key whose
    trips have no value has a null mean."""
    cells = cells.where(F.col(f"n_{MEANS[measure]}") > 0)
    return cells.groupBy(*keys).agg(F.try_divide(F.sum(f"s_{measure}"), F.sum(f"c_{measure}")).alias(out))


def merge_line(cells: DataFrame, line: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept, r2 and n of a least-squares line from the cells' centred
    squares: those inside the cells plus those between their means. Null where
    the line is not defined, as over the trips."""
    n, x, y = (F.col(f"{line}_{c}") for c in ("n", "x", "y"))
    sums: Mapping[str, Column] = {"n": n, "x": n * x, "y": n * y, "xx": n * x * x, "xy": n * x * y, "yy": n * y * y}
    inner = {f"in_{c}": F.sum(f"{line}_{c}") for c in ("xx", "xy", "yy")}
    cells = cells.where(n > 0)
    grouped = cells.groupBy(*by) if by else cells
    m = grouped.agg(*[F.sum(v).alias(f"t_{c}") for c, v in sums.items()], *[v.alias(c) for c, v in inner.items()])
    total = F.col("t_n")

    def centred(a: str, b: str) -> Column:
        between = F.col(f"t_{a}{b}") - F.try_divide(F.col(f"t_{a}") * F.col(f"t_{b}"), total)
        between = F.greatest(between, F.lit(0.0)) if a == b else between
        return F.col(f"in_{a}{b}") + between
    m = m.withColumns({"xx": centred("x", "x"), "xy": centred("x", "y"), "yy": centred("y", "y")})
    # what rounding leaves of no spread at all is no spread
    flat = lambda s, raw: F.col(s) <= F.lit(1e-13) * F.col(raw)
    slope = F.when(~flat("xx", "t_xx"), F.col("xy") / F.col("xx"))
    r2 = F.when(flat("xx", "t_xx"), None).when(flat("yy", "t_yy"), F.lit(1.0)).otherwise(
        F.col("xy") * F.col("xy") / (F.col("xx") * F.col("yy")))
    return m.select(*by, slope.alias("slope"), ((F.col("t_y") - slope * F.col("t_x")) / total).alias("intercept"),
                    r2.alias("r2"), F.coalesce(total, F.lit(0)).cast("bigint").alias("n"))
