"""Registered queries: aggregations, statistics, top-k, sampling and the
dashboard screens (inventory sections 2.7, 2.9, 2.13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake import fixed
from farelake.operators import aggregates as A
from farelake.operators import audit as AU
from farelake.operators import quality as Q
from farelake.operators import stats as ST
from farelake.operators import topk as K
from farelake.plans import fixtures as fx
from farelake.plans import screens as SC
from farelake.plans.catalog import DUR, R, SEASON_PT, SQL_IN, SQL_LIST, WE, WT, WZ, E, T, Z, register, rnd
from farelake.plans.q_sources import T_ORDER
from farelake.session import shared_table

S2 = f"""{WT}, {WZ},
s2 AS (SELECT t.*, z.zone AS region, CAST(year(pickup_datetime) AS INTEGER) AS year,
              CAST(month(pickup_datetime) AS INTEGER) AS month, {DUR()} AS duration
       FROM t LEFT JOIN z ON t.id_location_pickup = z.id_location
       WHERE total_amount > 0 AND trip_distance > 0 AND dropoff_datetime > pickup_datetime),
s2f AS (SELECT *, total_amount / (duration / CAST(60 AS DOUBLE)) AS revenue_hour FROM s2 WHERE duration > 0)"""

S3 = f"""{WT}, {WZ},
s3 AS (SELECT t.*, z1.zone AS pickup_zone, z2.zone AS dropoff_zone, CAST(year(pickup_datetime) AS INTEGER) AS year,
              CAST(hour(pickup_datetime) AS INTEGER) AS hour, dayname(pickup_datetime) AS day_of_week,
              {SEASON_PT('month(pickup_datetime)')} AS season
       FROM t LEFT JOIN z z1 ON t.id_location_pickup = z1.id_location
              LEFT JOIN z z2 ON t.id_location_dropoff = z2.id_location
       WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND dropoff_datetime > pickup_datetime)"""

S4 = f"""{WT},
s4 AS (SELECT t.*, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
              CAST(hour(pickup_datetime) AS INTEGER) AS hour, {SEASON_PT('month(pickup_datetime)')} AS season,
              {DUR()} AS trip_duration
       FROM t WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND fare_amount > 0
         AND tip_amount >= 0 AND dropoff_datetime > pickup_datetime)"""


def s2(spark, d):
    return SC.efficiency_base(T(spark, d), Z(spark, d))


def s3(spark, d):
    return SC.hotspots_base(T(spark, d), Z(spark, d))


def s4(spark, d):
    return SC.fares_base(T(spark, d))


# ---- 2.7 counts ---------------------------------------------------------------

@register("count_rows", f"{WT} SELECT count(*) AS n FROM t")
def q_count_rows(spark, d):
    return A.count_rows(T(spark, d))


@register("count_by_month", f"{WT} SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS trips FROM t GROUP BY 1")
def q_count_by_month(spark, d):
    return A.count_by_month(T(spark, d))


WEEKDAY_DOMAIN = ", ".join(f"('{w}', {i})" for i, w in enumerate(fixed.WEEKDAY_ORDER_PT))
WEEKDAY_PT_CASE = "CASE " + " ".join(f"WHEN dayname(pickup_datetime) = '{k}' THEN '{v}'" for k, v in fixed.WEEKDAY_PT.items()) + " END"


@register("count_by_weekday", f"""{WT},
dom AS (SELECT * FROM (VALUES {WEEKDAY_DOMAIN}) v(weekday, weekday_order)),
c AS (SELECT {WEEKDAY_PT_CASE} AS weekday, count(*) AS trips FROM t GROUP BY 1)
SELECT dom.weekday, COALESCE(c.trips, 0) AS trips, CAST(dom.weekday_order AS INTEGER) AS weekday_order
FROM dom LEFT JOIN c USING (weekday)""")
def q_count_by_weekday(spark, d):
    return A.count_by_weekday(T(spark, d))


@register("count_by_hour", f"{WE} SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour, count(*) AS trips FROM e GROUP BY 1")
def q_count_by_hour(spark, d):
    return A.count_by_hour(E(spark, d))


@register("count_by_month_service", f"""{WT}
SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, service_type, count(*) AS trips FROM t
WHERE trip_distance > 0 AND dropoff_datetime > pickup_datetime GROUP BY 1, 2""")
def q_count_by_month_service(spark, d):
    t = Q.filter_time_order(Q.filter_positive(T(spark, d), ["trip_distance"]))
    return A.count_by_month_service(t)


@register("heatmap_weekday_hour", f"""{WE}
SELECT dayname(pickup_datetime) AS day_of_week, CAST(hour(pickup_datetime) AS INTEGER) AS hour, count(*) AS trips
FROM e GROUP BY 1, 2""")
def q_heatmap(spark, d):
    return A.heatmap_weekday_hour(E(spark, d))


HOUR_COLS = ", ".join(f"count_if(hour(pickup_datetime) = {h}) AS h{h}" for h in range(24))


@register("heatmap_matrix", f"{WE} SELECT dayname(pickup_datetime) AS day_of_week, {HOUR_COLS} FROM e GROUP BY 1")
def q_heatmap_matrix(spark, d):
    return A.heatmap_matrix(E(spark, d))


@register("count_by_season_zone", f"{S3} SELECT season, pickup_zone AS zone, count(*) AS trips FROM s3 GROUP BY 1, 2")
def q_count_by_season_zone(spark, d):
    return A.count_by_season_zone(s3(spark, d))


@register("category_counts", f"{WT} SELECT service_type AS value, count(*) AS n FROM t WHERE service_type IS NOT NULL GROUP BY 1")
def q_category_counts(spark, d):
    return A.category_counts(T(spark, d), "service_type")


# ---- 2.7 means ----------------------------------------------------------------

def _mean_sql(base: str, table: str, value: str, out: str) -> str:
    return f"{base} SELECT month, {R(f'avg({value})')} AS {out} FROM {table} GROUP BY 1"


@register("mean_duration_by_month", _mean_sql(S2, "s2f", "duration", "mean_duration_min"))
def q_mean_duration(spark, d):
    return rnd(A.mean_duration_by_month(s2(spark, d)), "mean_duration_min")


@register("mean_distance_by_month", _mean_sql(S2, "s2f", "trip_distance", "mean_distance"))
def q_mean_distance(spark, d):
    return rnd(A.mean_distance_by_month(s2(spark, d)), "mean_distance")


@register("mean_revenue_per_trip", _mean_sql(S2, "s2f", "total_amount", "mean_revenue_trip"))
def q_mean_revenue_trip(spark, d):
    return rnd(A.mean_revenue_per_trip(s2(spark, d)), "mean_revenue_trip")


@register("mean_revenue_per_hour", _mean_sql(S2, "s2f", "revenue_hour", "mean_revenue_hour"))
def q_mean_revenue_hour(spark, d):
    return rnd(A.mean_revenue_per_hour(s2(spark, d)), "mean_revenue_hour")


SERVICE_DOMAIN = f"SELECT unnest({SQL_LIST(fixed.SERVICE_TYPES)}) AS service_type"


@register("revenue_hour_by_service", f"""{S2},
agg AS (SELECT service_type, avg(revenue_hour) AS m FROM s2f GROUP BY 1)
SELECT dom.service_type, {R('COALESCE(agg.m, 0.0)')} AS mean_revenue_hour
FROM ({SERVICE_DOMAIN}) dom LEFT JOIN agg USING (service_type)""")
def q_revenue_hour_by_service(spark, d):
    return rnd(A.revenue_hour_by_service(s2(spark, d)), "mean_revenue_hour")


@register("mean_fare_by_month", _mean_sql(S4, "s4", "fare_amount", "mean_fare"))
def q_mean_fare(spark, d):
    return rnd(A.mean_fare_by_month(s4(spark, d)), "mean_fare")


@register("mean_tip_by_month", _mean_sql(S4, "s4", "tip_amount", "mean_tip"))
def q_mean_tip(spark, d):
    return rnd(A.mean_tip_by_month(s4(spark, d)), "mean_tip")


OD_MEASURES = ("trip_distance", "total_amount", "fare_amount")


def _od_sql() -> str:
    parts = []
    for m in OD_MEASURES:
        parts += [f"{R(f'avg({m})')} AS {m}_mean", f"max({m}) AS {m}_max", f"min({m}) AS {m}_min",
                  f"count({m}) AS {m}_count", f"{R(f'sum({m})')} AS {m}_sum"]
    parts.append(f"{R('avg(trip_distance) * 1.609')} AS trip_distance_mean_km")
    return f"{WT} SELECT id_location_pickup, id_location_dropoff, {', '.join(parts)} FROM t GROUP BY 1, 2"


def _od(spark, d):
    out = A.od_pair_stats(T(spark, d))
    return rnd(out, [f"{m}_{s}" for m in OD_MEASURES for s in ("mean", "sum")] + ["trip_distance_mean_km"])


@register("od_pair_stats", _od_sql())
def q_od_pair_stats(spark, d):
    return _od(spark, d)


# ---- 2.7 distributions ----------------------------------------------------------

DESC_COLS = ["trip_distance", "fare_amount", "tip_amount", "total_amount"]


def describe_sql(base: str, table: str, cols) -> str:
    stats = [("count", "CAST(count({c}) AS DOUBLE)"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"),
             ("min", "min({c})"), ("25%", "quantile_cont({c}, 0.25)"), ("50%", "quantile_cont({c}, 0.5)"),
             ("75%", "quantile_cont({c}, 0.75)"), ("max", "max({c})")]
    sel = []
    for i, (name, f) in enumerate(stats):
        body = ", ".join(f"{R(f.format(c=c), 2)} AS {c}" for c in cols)
        sel.append(f"SELECT '{name}' AS stat, {body}, CAST({i} AS INTEGER) AS stat_order FROM {table}")
    return base + " " + " UNION ALL ".join(sel)


@register("describe_numeric", describe_sql(WT, "t", DESC_COLS))
def q_describe(spark, d):
    return ST.describe_numeric(T(spark, d), DESC_COLS)


@register("percentile_exact", f"""{WT}
SELECT service_type, {R('quantile_cont(total_amount, 0.25)')} AS p25, {R('quantile_cont(total_amount, 0.5)')} AS p50,
       {R('quantile_cont(total_amount, 0.75)')} AS p75, {R('quantile_cont(total_amount, 0.9)')} AS p90
FROM t GROUP BY 1""")
def q_percentile_exact(spark, d):
    out = ST.percentile_exact(T(spark, d), "total_amount", [0.25, 0.5, 0.75, 0.9], ["service_type"])
    return rnd(out, ["p25", "p50", "p75", "p90"])


@register("histogram", f"""{WT},
q AS (SELECT quantile_cont(total_amount, 0.005) AS lo, quantile_cont(total_amount, 0.995) AS hi FROM t),
w AS (SELECT lo, hi, (hi - lo) / 40 AS width FROM q),
b AS (SELECT CAST(least(floor((total_amount - lo) / width), 39) AS BIGINT) AS bin FROM t, w
      WHERE total_amount BETWEEN lo AND hi),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
g AS (SELECT unnest(generate_series(0, 39)) AS bin)
SELECT g.bin, {R('w.lo + g.bin * w.width')} AS bin_lo, {R('w.lo + (g.bin + 1) * w.width')} AS bin_hi,
       COALESCE(c.n, 0) AS n
FROM g CROSS JOIN w LEFT JOIN c ON g.bin = c.bin""")
def q_histogram(spark, d):
    t = shared_table(T(spark, d).select("total_amount"), "amounts")     # read by each pass
    lo, hi = ST.quantile_scalars(t, "total_amount", [0.005, 0.995], stored=True)
    return rnd(ST.histogram(t, "total_amount", 40, lo, hi), ["bin_lo", "bin_hi"])


BOX_SQL = f"""{S4},
q AS (SELECT service_type, quantile_cont(tip_amount, 0.25) AS q1, quantile_cont(tip_amount, 0.5) AS median,
             quantile_cont(tip_amount, 0.75) AS q3 FROM s4 WHERE tip_amount IS NOT NULL GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS hf FROM q)
SELECT f.service_type, {R('f.q1')} AS q1, {R('f.median')} AS median, {R('f.q3')} AS q3,
       {R('min(CASE WHEN tip_amount >= lf THEN tip_amount END)')} AS whisker_lo,
       {R('max(CASE WHEN tip_amount <= hf THEN tip_amount END)')} AS whisker_hi,
       count(CASE WHEN tip_amount < lf OR tip_amount > hf THEN 1 END) AS n_out, count(*) AS n
FROM s4 JOIN f USING (service_type) WHERE tip_amount IS NOT NULL
GROUP BY f.service_type, f.q1, f.median, f.q3"""

BOX_COLS = ["q1", "median", "q3", "whisker_lo", "whisker_hi"]


@register("box_stats", BOX_SQL)
def q_box_stats(spark, d):
    return rnd(ST.box_stats(s4(spark, d), "tip_amount", ["service_type"]), BOX_COLS)


def _ols_sql(x: str, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return (f"{S4} SELECT {g}{R(f'regr_slope(tip_amount, {x})', 6)} AS slope, "
            f"{R(f'regr_intercept(tip_amount, {x})', 4)} AS intercept, {R(f'regr_r2(tip_amount, {x})', 6)} AS r2, "
            f"CAST(regr_count(tip_amount, {x}) AS BIGINT) AS n FROM s4{tail}")


def _ols(df, x, by=()):
    out = ST.ols_trend(df, "tip_amount", x, by)
    return out.withColumns({"slope": F.round("slope", 6), "intercept": F.round("intercept", 4),
                            "r2": F.round("r2", 6)})


@register("ols_trend", _ols_sql("trip_duration"))
def q_ols_trend(spark, d):
    return _ols(s4(spark, d), "trip_duration")


@register("ols_trend_distance", _ols_sql("trip_distance", "service_type"))
def q_ols_trend_distance(spark, d):
    return _ols(s4(spark, d), "trip_distance", ["service_type"])


@register("value_share", f"""{WT}
SELECT count_if(trip_distance = 0) AS n, count(*) AS total,
       {R('CAST(count_if(trip_distance = 0) AS DOUBLE) * 100 / count(*)', 2)} AS pct FROM t""")
def q_value_share(spark, d):
    return A.value_share(T(spark, d), "trip_distance", 0.0)


@register("removed_rows_audit", f"""{WT},
c AS (SELECT count(*) AS n_before, count_if(trip_distance > 0 AND dropoff_datetime > pickup_datetime) AS n_after FROM t)
SELECT n_before, n_after, n_before - n_after AS n_removed,
       {R('CAST(n_before - n_after AS DOUBLE) * 100 / n_before', 2)} AS pct_removed FROM c""")
def q_removed_rows_audit(spark, d):
    t = T(spark, d)
    return A.removed_rows_audit(t, Q.filter_time_order(Q.filter_positive(t, ["trip_distance"])))


#: the cleaning rules as SQL that both engines read, in the order they are applied
AUDIT_RULES = {"distance": "trip_distance > 0", "time_order": "dropoff_datetime > pickup_datetime", "passengers": "passenger_count > 0",
               "location": "id_location_pickup > 0 AND id_location_dropoff > 0"}


def _audit_sql() -> str:
    bad = {r: f"NOT COALESCE({e}, FALSE)" for r, e in AUDIT_RULES.items()}
    broken = " + ".join(f"CAST({e} AS INTEGER)" for e in bad.values())
    rows, names = [], list(bad)
    for i, r in enumerate(names):
        before = " AND ".join([f"NOT ({bad[x]})" for x in names[:i]] + ["TRUE"])
        rows.append(f"SELECT '{r}' AS rule, {i + 1} AS position, count_if({bad[r]}) AS n_broken, count_if({bad[r]} AND {broken} = 1) AS n_alone, "
                    f"count_if({bad[r]} AND {before}) AS n_first, count(*) AS n_before, count_if({broken} = 0) AS n_after FROM t")
    return f"{WT} " + " UNION ALL ".join(rows)


@register("audit_rules", _audit_sql())
def q_audit_rules(spark, d):
    """Which rule removes which rows, counted while the kept rows are written."""
    from farelake.plans.q_sources import scratch
    return AU.write_audited(T(spark, d), AUDIT_RULES, scratch(spark, "audited"))


@register("distinct_rows", f"{WT} SELECT DISTINCT * FROM t")
def q_distinct_rows(spark, d):
    return A.distinct_rows(T(spark, d))


REST = ("pickup_datetime, dropoff_datetime, id_location_pickup, id_location_dropoff, id_payment_type, id_rate, "
        "passenger_count, trip_distance, fare_amount, tip_amount, total_amount")


@register("distinct_by_key", f"""{WT}
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY service_type, id_vendor ORDER BY {REST}) AS rn
FROM t) WHERE rn = 1""")
def q_distinct_by_key(spark, d):
    return A.distinct_by_key(T(spark, d), ["service_type", "id_vendor"])


@register("distinct_sorted_values", f"{WT} SELECT DISTINCT service_type AS value FROM t WHERE service_type IS NOT NULL ORDER BY 1")
def q_distinct_sorted_values(spark, d):
    return A.distinct_sorted_values(T(spark, d), "service_type")


# ---- 2.9 sort / top-k / sampling --------------------------------------------------

@register("sort_desc", f"""{WT}
SELECT id_location_pickup, id_location_dropoff, count(*) AS trips FROM t GROUP BY 1, 2
ORDER BY trips DESC, id_location_pickup, id_location_dropoff""")
def q_sort_desc(spark, d):
    pairs = A.count_by(T(spark, d), ["id_location_pickup", "id_location_dropoff"])
    return K.sort_desc(pairs, "trips", ["id_location_pickup", "id_location_dropoff"])


def _top_sql(col: str) -> str:
    return (f"{S3} SELECT {col}, count(*) AS n FROM s3 WHERE {col} IS NOT NULL GROUP BY 1 "
            f"ORDER BY n DESC, {col} LIMIT 10")


@register("top_pickup_zones", _top_sql("pickup_zone"))
def q_top_pickup(spark, d):
    return K.top_pickup_zones(s3(spark, d))


@register("top_dropoff_zones", _top_sql("dropoff_zone"))
def q_top_dropoff(spark, d):
    return K.top_dropoff_zones(s3(spark, d))


@register("top_regions_revenue", f"""{S2}
SELECT region, {R('avg(revenue_hour)')} AS mean_revenue_hour FROM s2f WHERE region IS NOT NULL GROUP BY 1
ORDER BY avg(revenue_hour) DESC, region LIMIT 10""")
def q_top_regions(spark, d):
    return rnd(K.top_regions_revenue(s2(spark, d)), "mean_revenue_hour")


def _hotspot_sql(where: str = "TRUE") -> str:
    return f"""{S3},
f AS (SELECT * FROM s3 WHERE {where}),
top AS (SELECT pickup_zone FROM f WHERE year(pickup_datetime) = 1998 AND pickup_zone IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, pickup_zone LIMIT 5)
SELECT {SEASON_PT('month(pickup_datetime)')} AS season, pickup_zone AS zone, count(*) AS trips
FROM f WHERE pickup_zone IN (SELECT pickup_zone FROM top) GROUP BY 1, 2"""


@register("hotspot_evolution", _hotspot_sql())
def q_hotspot_evolution(spark, d):
    return K.hotspot_evolution(s3(spark, d), "pickup_zone", "pickup_datetime", 1998, 5)


@register("limit_rows", f"{WT} SELECT * FROM t ORDER BY {T_ORDER} LIMIT 1000")
def q_limit_rows(spark, d):
    t = T(spark, d)
    return K.limit_rows(t, 1000, t.columns)


@register("sample_per_service", f"""WITH r AS ({fx.RIDES_SQL}),
h AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|', CAST(order_no AS VARCHAR), CAST(line_no AS VARCHAR), '42')), 1, 13) AS BIGINT) AS draw
      FROM r WHERE service_type IN {SQL_IN(fixed.SERVICE_TYPES)})
SELECT * EXCLUDE (draw) FROM h WHERE draw < {int(0.08 * 16 ** 13)}
QUALIFY row_number() OVER (PARTITION BY service_type ORDER BY draw, order_no, line_no) <= 1000""")
def q_sample_per_service(spark, d):
    """Samples of each year, merged: the sample of all."""
    rides, identity = fx.rides(spark, d), ["order_no", "line_no"]
    lo, hi = rides.agg(F.min(F.year("pickup_datetime")), F.max(F.year("pickup_datetime"))).first()
    years = [K.sample_per_service(Q.filter_year_in(rides, "pickup_datetime", [y]), fraction=0.08, n=1000, seed=42, identity=identity)
             for y in range(lo, hi + 1)]
    return K.merge_samples(years, n=1000, seed=42, identity=identity)


@register("ordered_category", f"""{WT},
dom AS (SELECT * FROM (VALUES {WEEKDAY_DOMAIN}) v(weekday, weekday_order)),
c AS (SELECT {WEEKDAY_PT_CASE} AS weekday, count(*) AS trips FROM t GROUP BY 1)
SELECT dom.weekday, COALESCE(c.trips, 0) AS trips, CAST(dom.weekday_order AS INTEGER) AS weekday_order,
       CAST(dom.weekday_order + 1 AS INTEGER) AS sort_key
FROM dom LEFT JOIN c USING (weekday) ORDER BY sort_key""")
def q_ordered_category(spark, d):
    return K.ordered_category(A.count_by_weekday(T(spark, d)), "weekday", fixed.WEEKDAY_ORDER_PT)


# ---- 2.13 screens and profile -------------------------------------------------------

MONTH_ABBR_CASE = "CASE " + " ".join(f"WHEN m = {k} THEN '{v}'" for k, v in fixed.MONTH_ABBR_PT.items()) + " END"


@register("screen_demand", f"""{WT},
b AS (SELECT CAST(month(pickup_datetime) AS INTEGER) AS m, {WEEKDAY_PT_CASE} AS wd FROM t
      WHERE service_type = 'greenTaxi'),
dom AS (SELECT * FROM (VALUES {WEEKDAY_DOMAIN}) v(weekday, weekday_order)),
wc AS (SELECT wd AS weekday, count(*) AS trips FROM b GROUP BY 1)
SELECT {MONTH_ABBR_CASE} AS axis, count(*) AS trips, 'Mês' AS dimension FROM b GROUP BY m
UNION ALL
SELECT dom.weekday AS axis, COALESCE(wc.trips, 0) AS trips, 'Dia da Semana' AS dimension
FROM dom LEFT JOIN wc USING (weekday)""")
def q_screen_demand(spark, d):
    return SC.screen_demand(T(spark, d), service="greenTaxi")["temporal"]


@register("screen_efficiency", f"""{S2},
agg AS (SELECT service_type, avg(revenue_hour) AS m FROM s2f WHERE year = 1997 GROUP BY 1)
SELECT dom.service_type, {R('COALESCE(agg.m, 0.0)')} AS mean_revenue_hour
FROM ({SERVICE_DOMAIN}) dom LEFT JOIN agg USING (service_type)""")
def q_screen_efficiency(spark, d):
    return rnd(SC.screen_efficiency(T(spark, d), Z(spark, d), year=1997)["by_service"], "mean_revenue_hour")


@register("screen_hotspots", _hotspot_sql("service_type = 'yellowTaxi'"))
def q_screen_hotspots(spark, d):
    return SC.screen_hotspots(T(spark, d), Z(spark, d), service="yellowTaxi", ref_year=1998)["evolution"]


@register("screen_fares", BOX_SQL.replace("FROM s4 WHERE tip_amount IS NOT NULL GROUP BY 1",
                                          "FROM s4 WHERE tip_amount IS NOT NULL AND year = 1997 GROUP BY 1")
          .replace("FROM s4 JOIN f USING (service_type) WHERE tip_amount IS NOT NULL",
                   "FROM s4 JOIN f USING (service_type) WHERE tip_amount IS NOT NULL AND year = 1997"))
def q_screen_fares(spark, d):
    return rnd(SC.screen_fares(T(spark, d), year=1997)["box_by_service"], BOX_COLS)


# the other frames of the four screens

def _demand(spark, d, frame):
    return SC.screen_demand(T(spark, d), service="greenTaxi", weekday="Segunda-feira")[frame]


@register("screen_demand_by_hour", f"""{WT}
SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, count(*) AS trips FROM t
WHERE service_type = 'greenTaxi' AND {WEEKDAY_PT_CASE} = 'Segunda-feira' GROUP BY 1""")
def q_screen_demand_by_hour(spark, d):
    return _demand(spark, d, "by_hour")


@register("screen_demand_by_month_service", f"""{WT}
SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, service_type, count(*) AS trips FROM t
WHERE service_type = 'greenTaxi' GROUP BY 1, 2""")
def q_screen_demand_by_month_service(spark, d):
    return _demand(spark, d, "by_month_service")


def _screen_frame(name, sql, screen, frame, *rounded, **filters):
    """Register one frame of a screen over the trips and the zones."""
    @register(name, sql)
    def q(spark, d):
        zones = (Z(spark, d),) if screen is not SC.screen_fares else ()
        out = screen(T(spark, d), *zones, **filters)[frame]
        return rnd(out, *rounded) if rounded else out


for _frame, _value, _mean in (("duration", "duration", "mean_duration_min"), ("distance", "trip_distance", "mean_distance"),
                              ("revenue_trip", "total_amount", "mean_revenue_trip"), ("revenue_hour", "revenue_hour", "mean_revenue_hour")):
    _screen_frame(f"screen_efficiency_{_frame}", f"""{S2}
SELECT month, {R(f'avg({_value})')} AS {_mean} FROM s2f WHERE service_type = 'yellowTaxi' GROUP BY 1""",
                  SC.screen_efficiency, _frame, _mean, service="yellowTaxi")

_screen_frame("screen_efficiency_top_regions", f"""{S2}
SELECT region, {R('avg(revenue_hour)')} AS mean_revenue_hour FROM s2f
WHERE service_type = 'yellowTaxi' AND region IS NOT NULL GROUP BY 1 ORDER BY avg(revenue_hour) DESC, region LIMIT 10""",
              SC.screen_efficiency, "top_regions", "mean_revenue_hour", service="yellowTaxi")

for _frame, _zone in (("top_pickup", "pickup_zone"), ("top_dropoff", "dropoff_zone")):
    _screen_frame(f"screen_hotspots_{_frame}", f"""{S3} SELECT {_zone}, count(*) AS n FROM s3
WHERE service_type = 'yellowTaxi' AND {_zone} IS NOT NULL GROUP BY 1 ORDER BY n DESC, {_zone} LIMIT 10""",
                  SC.screen_hotspots, _frame, service="yellowTaxi")

_screen_frame("screen_hotspots_heatmap", f"""{S3}
SELECT dayname(pickup_datetime) AS day_of_week, CAST(hour(pickup_datetime) AS INTEGER) AS hour, count(*) AS trips
FROM s3 WHERE service_type = 'yellowTaxi' GROUP BY 1, 2""", SC.screen_hotspots, "heatmap", service="yellowTaxi")

for _frame, _value in (("years", "CAST(year(pickup_datetime) AS INTEGER)"), ("seasons", SEASON_PT("month(pickup_datetime)")),
                       ("services", "service_type")):
    _screen_frame(f"screen_hotspots_{_frame}", f"{S3} SELECT DISTINCT {_value} AS value FROM s3 WHERE {_value} IS NOT NULL",
                  SC.screen_hotspots, _frame)

for _frame, _value, _mean in (("fare", "fare_amount", "mean_fare"), ("tip", "tip_amount", "mean_tip")):
    _screen_frame(f"screen_fares_{_frame}", f"""{S4}
SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, {R(f'avg({_value})')} AS {_mean} FROM s4
WHERE service_type = 'greenTaxi' GROUP BY 1""", SC.screen_fares, _frame, _mean, service="greenTaxi")


def _screen_trend(name, frame, x):
    @register(name, _ols_sql(x) + " WHERE service_type = 'greenTaxi'")
    def q(spark, d):
        out = SC.screen_fares(T(spark, d), service="greenTaxi")[frame]
        return out.withColumns({"slope": F.round("slope", 6), "intercept": F.round("intercept", 4), "r2": F.round("r2", 6)})


_screen_trend("screen_fares_trend_duration", "trend_duration", "trip_duration")
_screen_trend("screen_fares_trend_distance", "trend_distance", "trip_distance")


HV_COLS = ["trip_miles", "trip_time", "base_passenger_fare", "tips"]


@register("profile_service", describe_sql(f"WITH rh AS ({fx.raw_service_sql('highVolumeForHire')})", "rh", HV_COLS))
def q_profile_service(spark, d):
    return SC.profile_service(fx.raw_service(spark, d, "highVolumeForHire"), HV_COLS)["describe"]


@register("job_audit", f"""{WT},
c AS (SELECT count(*) AS n_before, count_if(trip_distance > 0 AND dropoff_datetime > pickup_datetime) AS n_after FROM t)
SELECT n_before, n_after, n_before - n_after AS n_removed,
       {R('CAST(n_before - n_after AS DOUBLE) * 100 / n_before', 2)} AS pct_removed FROM c""")
def q_job_audit(spark, d):
    from farelake.plans.jobs import job_audit
    t = T(spark, d)
    return job_audit(t, Q.filter_time_order(Q.filter_positive(t, ["trip_distance"])))["report"]


@register("job_dedup_publish", f"""{WT}
SELECT DISTINCT service_type, pickup_datetime, dropoff_datetime, id_location_pickup, id_location_dropoff, id_vendor,
       id_payment_type, id_rate, CAST(passenger_count AS DOUBLE) AS passenger_count, trip_distance, fare_amount,
       tip_amount, total_amount
FROM t WHERE service_type IS NOT NULL AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
  AND id_location_pickup IS NOT NULL AND id_location_dropoff IS NOT NULL AND id_vendor IS NOT NULL
  AND id_payment_type IS NOT NULL AND id_rate IS NOT NULL AND passenger_count IS NOT NULL
  AND trip_distance IS NOT NULL AND fare_amount IS NOT NULL AND tip_amount IS NOT NULL AND total_amount IS NOT NULL""")
def q_job_dedup_publish(spark, d):
    from farelake.plans.jobs import job_dedup_publish
    from farelake.plans.q_sources import scratch
    out = scratch(spark, "dedup-publish")
    job_dedup_publish(T(spark, d), out, {"passenger_count": "double"})
    return spark.read.parquet(out)
