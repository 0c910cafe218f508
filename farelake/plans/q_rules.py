"""Registered queries: filters and cleaning rules, joins, set operations
(inventory sections 2.5, 2.6, 2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.operators import joins as J
from farelake.operators import quality as Q
from farelake.operators import setops as S
from farelake.operators import stats as ST
from farelake.operators import aggregates as A
from farelake.plans import fixtures as fx
from farelake.plans.catalog import DUR, SQL_LIST, WE, WT, WZ, E, T, Z, register
from farelake.plans.q_sources import conformed_all, CONFORMED_SQL
from farelake.sources import readers as RD

RY = f"ry AS ({fx.raw_service_sql('yellowTaxi')})"
RG = f"rg AS ({fx.raw_service_sql('greenTaxi')})"
RF = f"rf AS ({fx.raw_service_sql('forHireVehicle')})"
RH = f"rh AS ({fx.raw_service_sql('highVolumeForHire')})"
PAY_VALUES = ", ".join(f"({k}, '{v}')" for k, v in fixed.TRUSTED_PAYMENT_TYPES)
PAY = f"pay AS (SELECT * FROM (VALUES {PAY_VALUES}) v(payment_type, payment_type_description))"


def raw(spark, d, s):
    return fx.raw_service(spark, d, s)


# ---- 2.5 filters --------------------------------------------------------------

@register("filter_positive", f"{WT} SELECT * FROM t WHERE trip_distance > 0 AND total_amount > 0")
def q_filter_positive(spark, d):
    return Q.filter_positive(T(spark, d), ["trip_distance", "total_amount"])


@register("filter_nonnegative", f"{WT} SELECT * FROM t WHERE tip_amount >= 0 AND passenger_count >= 0")
def q_filter_nonnegative(spark, d):
    return Q.filter_nonnegative(T(spark, d), ["tip_amount", "passenger_count"])


@register("filter_time_order", f"{WT} SELECT * FROM t WHERE dropoff_datetime > pickup_datetime")
def q_filter_time_order(spark, d):
    return Q.filter_time_order(T(spark, d))


@register("filter_positive_duration", f"""{WT}
SELECT * FROM (SELECT *, {DUR()} AS duration FROM t) WHERE duration > 0""")
def q_filter_positive_duration(spark, d):
    t = T(spark, d).withColumn("duration", C.duration_minutes("pickup_datetime", "dropoff_datetime"))
    return Q.filter_positive_duration(t, "duration")


@register("filter_not_null", f"SELECT * FROM ({CONFORMED_SQL}) WHERE trip_distance IS NOT NULL AND id_vendor IS NOT NULL")
def q_filter_not_null(spark, d):
    return Q.filter_not_null(conformed_all(spark, d), ["trip_distance", "id_vendor"])


@register("drop_null_rows", f"""SELECT * FROM ({CONFORMED_SQL})
WHERE id_location_pickup IS NOT NULL AND id_location_dropoff IS NOT NULL AND fare_amount IS NOT NULL""")
def q_drop_null_rows(spark, d):
    return Q.drop_null_rows(conformed_all(spark, d), ["id_location_pickup", "id_location_dropoff", "fare_amount"])


@register("filter_year_in", f"{WT} SELECT * FROM t WHERE year(pickup_datetime) IN (1996, 1998)")
def q_filter_year_in(spark, d):
    return Q.filter_year_in(T(spark, d), "pickup_datetime", [1996, 1998])


@register("filter_optional", f"""{WE}
SELECT *, CAST(hour(pickup_datetime) AS INTEGER) AS hour FROM e
WHERE service_type = 'click' AND hour(pickup_datetime) = 0""")
def q_filter_optional(spark, d):
    e = E(spark, d).withColumn("hour", C.hour_of("pickup_datetime"))
    return Q.filter_optional(e, {"service_type": "click", "hour": 0, "month": None})


@register("filter_in_set", f"{WT} SELECT * FROM t WHERE service_type IN ('yellowTaxi', 'greenTaxi')")
def q_filter_in_set(spark, d):
    return Q.filter_in_set(T(spark, d), "service_type", ["yellowTaxi", "greenTaxi"])


@register("trim_outliers", f"""{WT},
q AS (SELECT quantile_cont(total_amount, 0.005) AS lo, quantile_cont(total_amount, 0.995) AS hi FROM t)
SELECT t.* FROM t, q WHERE t.total_amount BETWEEN q.lo AND q.hi""")
def q_trim_outliers(spark, d):
    return ST.trim_outliers(T(spark, d), "total_amount", 0.005, 0.995)


@register("fix_passenger_count", f"""WITH {RY}
SELECT * REPLACE (CASE WHEN passenger_count <= 0 THEN 1.0 ELSE passenger_count END AS passenger_count) FROM ry""")
def q_fix_passenger_count(spark, d):
    return Q.fix_passenger_count(raw(spark, d, "yellowTaxi"))


@register("fill_null_default", f"""SELECT * REPLACE (COALESCE(passenger_count, 1.0) AS passenger_count,
  COALESCE(trip_distance, 0.0) AS trip_distance) FROM ({CONFORMED_SQL})""")
def q_fill_null_default(spark, d):
    return Q.fill_null_default(conformed_all(spark, d), {"passenger_count": 1, "trip_distance": 0.0})


FLAG_SQL = ("COALESCE(PULocationID <= 0 OR DOLocationID <= 0, FALSE)")


@register("flag_invalid_location", f"""WITH {RY}
SELECT *, {FLAG_SQL} AS has_problem,
       CASE WHEN {FLAG_SQL} THEN '{fixed.INVALID_LOCATION_REASON}' END AS problem_description FROM ry""")
def q_flag_invalid_location(spark, d):
    return Q.flag_invalid_location(raw(spark, d, "yellowTaxi"))


@register("normalize_text", "SELECT * REPLACE (trim(lower(c_mktsegment)) AS c_mktsegment) FROM customer")
def q_normalize_text(spark, d):
    return Q.normalize_text(RD.scan_parquet(spark, f"{d}/customer.parquet"), "c_mktsegment")


def _clean_yg_sql(alias: str, p: str) -> str:
    return f"""SELECT VendorID, {p}_pickup_datetime AS pickup_datetime, {p}_dropoff_datetime AS dropoff_datetime,
      CASE WHEN passenger_count <= 0 THEN 1.0 ELSE passenger_count END AS passenger_count, trip_distance, RatecodeID,
      PULocationID, DOLocationID, CAST(r.payment_type AS INTEGER) AS payment_type, fare_amount, tip_amount, total_amount,
      {FLAG_SQL} AS has_problem,
      CASE WHEN {FLAG_SQL} THEN '{fixed.INVALID_LOCATION_REASON}' END AS problem_description,
      pay.payment_type_description, trip_distance * 1.60934 AS trip_distance_km
    FROM {alias} r LEFT JOIN pay ON CAST(r.payment_type AS INTEGER) = pay.payment_type
    WHERE trip_distance > 0 AND {p}_dropoff_datetime > {p}_pickup_datetime"""


@register("clean_yellow_green", f"""WITH {RY}, {RG}, {PAY}
SELECT *, 'yellowTaxi' AS service_type FROM ({_clean_yg_sql('ry', 'tpep')})
UNION ALL SELECT *, 'greenTaxi' AS service_type FROM ({_clean_yg_sql('rg', 'lpep')})""")
def q_clean_yellow_green(spark, d):
    y = Q.clean_yellow_green(raw(spark, d, "yellowTaxi"), "yellowTaxi").withColumn("service_type", F.lit("yellowTaxi"))
    g = Q.clean_yellow_green(raw(spark, d, "greenTaxi"), "greenTaxi").withColumn("service_type", F.lit("greenTaxi"))
    return S.union_by_name([y, g])


@register("filter_flagged", f"""WITH {RY}, {PAY} SELECT * FROM ({_clean_yg_sql('ry', 'tpep')}) WHERE has_problem""")
def q_filter_flagged(spark, d):
    return Q.filter_flagged(Q.clean_yellow_green(raw(spark, d, "yellowTaxi"), "yellowTaxi"))


QC = "FALSE AS has_problem, CAST(NULL AS VARCHAR) AS problem_description"


@register("clean_fhv", f"WITH {RF} SELECT * REPLACE (COALESCE(SR_Flag, 0) AS SR_Flag), {QC} FROM rf")
def q_clean_fhv(spark, d):
    return Q.clean_fhv(raw(spark, d, "forHireVehicle"), "current")


@register("clean_fhv_strict", f"WITH {RF} SELECT *, {QC} FROM rf WHERE PUlocationID IS NOT NULL AND DOlocationID IS NOT NULL")
def q_clean_fhv_strict(spark, d):
    return Q.clean_fhv(raw(spark, d, "forHireVehicle"), "strict")


@register("clean_high_volume", f"""WITH {RH}
SELECT *, trip_miles * 1.60934 AS trip_miles_km, {QC} FROM rh
WHERE trip_miles > 0 AND trip_time > 0 AND dropoff_datetime > pickup_datetime""")
def q_clean_high_volume(spark, d):
    return Q.clean_high_volume(raw(spark, d, "highVolumeForHire"))


# ---- 2.6 joins ----------------------------------------------------------------

@register("join_payment_description", f"""{WT}, {PAY}
SELECT t.*, CAST(t.id_payment_type AS INTEGER) AS payment_type, pay.payment_type_description
FROM t LEFT JOIN pay ON CAST(t.id_payment_type AS INTEGER) = pay.payment_type""")
def q_join_payment(spark, d):
    t = T(spark, d).withColumn("payment_type", F.col("id_payment_type").cast("int"))
    return J.join_payment_description(t, Q.payment_table(spark), "payment_type")


@register("join_dim_keys", f"""{WT},
dv AS (SELECT row_number() OVER (ORDER BY id_vendor) AS sk_vendor, id_vendor
       FROM (SELECT DISTINCT id_vendor FROM t WHERE id_vendor IS NOT NULL))
SELECT t.*, dv.sk_vendor AS fk_vendor FROM t LEFT JOIN dv ON t.id_vendor = dv.id_vendor""")
def q_join_dim_keys(spark, d):
    from farelake.operators.dims import dim_vendor
    t = T(spark, d)
    return J.join_dim_keys(t, dim_vendor(t), "id_vendor", "sk_vendor", "fk_vendor")


@register("join_zone_pickup", f"""{WT}, {WZ}
SELECT t.*, z.zone AS region FROM t LEFT JOIN z ON t.id_location_pickup = z.id_location""")
def q_join_zone_pickup(spark, d):
    return J.join_zone_pickup(T(spark, d), Z(spark, d))


ZB = """SELECT t.*, z1.zone AS pickup_zone, z2.zone AS dropoff_zone FROM t
LEFT JOIN z z1 ON t.id_location_pickup = z1.id_location LEFT JOIN z z2 ON t.id_location_dropoff = z2.id_location"""


@register("join_zone_both", f"{WT}, {WZ} {ZB}")
def q_join_zone_both(spark, d):
    return J.join_zone_both(T(spark, d), Z(spark, d))


@register("join_full_outer_diff", f"""WITH cur AS ({fx.SCD2_CURRENT_SQL}), snap AS ({fx.SCD2_SNAPSHOT_SQL})
SELECT COALESCE(snap.id, cur.id) AS id, snap.name AS new_name, snap.segment AS new_segment,
       cur.name AS cur_name, cur.segment AS cur_segment, cur.effective_date AS cur_effective_date,
       cur.end_date AS cur_end_date, cur.is_current AS cur_is_current,
       snap.id IS NOT NULL AS in_new, cur.id IS NOT NULL AS in_current
FROM snap FULL OUTER JOIN cur ON snap.id = cur.id""")
def q_join_full_outer_diff(spark, d):
    return J.join_full_outer_diff(fx.scd2_snapshot(spark, d), fx.scd2_current(spark, d), "id")


@register("join_anti_unchanged", f"""WITH cur AS ({fx.SCD2_CURRENT_SQL}), snap AS ({fx.SCD2_SNAPSHOT_SQL}),
changed AS (SELECT snap.id FROM snap JOIN cur ON snap.id = cur.id
            WHERE snap.segment IS DISTINCT FROM cur.segment OR snap.name IS DISTINCT FROM cur.name)
SELECT * FROM cur WHERE id NOT IN (SELECT id FROM changed)""")
def q_join_anti_unchanged(spark, d):
    cur, snap = fx.scd2_current(spark, d), fx.scd2_snapshot(spark, d)
    changed = (snap.alias("n").join(cur.alias("c"), "id")
                  .where(~F.col("n.segment").eqNullSafe(F.col("c.segment")) | ~F.col("n.name").eqNullSafe(F.col("c.name")))
                  .select("id"))
    return J.join_anti_unchanged(cur, changed, "id")


@register("join_semi_hotspots", f"""{WT}, {WZ}, zb AS ({ZB}),
top AS (SELECT pickup_zone FROM zb WHERE pickup_zone IS NOT NULL GROUP BY pickup_zone
        ORDER BY count(*) DESC, pickup_zone LIMIT 5)
SELECT * FROM zb WHERE pickup_zone IN (SELECT pickup_zone FROM top)""")
def q_join_semi_hotspots(spark, d):
    from farelake.operators.topk import top_k_counts
    zb = J.join_zone_both(T(spark, d), Z(spark, d))
    return J.join_semi_hotspots(zb, top_k_counts(zb, "pickup_zone", 5), "pickup_zone")


# ---- 2.10 set operations --------------------------------------------------------

@register("union_by_name", f"""WITH {RY}, {RF} SELECT * FROM ry UNION ALL BY NAME SELECT * FROM rf""")
def q_union_by_name(spark, d):
    return S.union_by_name([raw(spark, d, "yellowTaxi"), raw(spark, d, "forHireVehicle")])


@register("union_strict", f"""SELECT * FROM ({CONFORMED_SQL}) WHERE service_type IN ('yellowTaxi', 'greenTaxi')""")
def q_union_strict(spark, d):
    from farelake.operators.conform import conform_service
    return S.union_strict([conform_service(fx.raw_from_trips(T(spark, d), s, full=True), s) for s in ("yellowTaxi", "greenTaxi")])


@register("union_labelled", f"""{WT}
SELECT CAST(month(pickup_datetime) AS VARCHAR) AS axis, count(*) AS trips, 'Mês' AS dimension FROM t GROUP BY 1
UNION ALL
SELECT dayname(pickup_datetime) AS axis, count(*) AS trips, 'Dia da Semana' AS dimension FROM t GROUP BY 1""")
def q_union_labelled(spark, d):
    t = T(spark, d)
    m = A.count_by_month(t)
    w = A.count_by(t, [C.day_name("pickup_datetime").alias("weekday")])
    return S.union_labelled({fixed.DIMENSION_LABEL_MONTH: (m, "month", "trips"),
                             fixed.DIMENSION_LABEL_WEEKDAY: (w, "weekday", "trips")})


REMOVED_COLS = ("service_type, pickup_datetime, dropoff_datetime, id_location_pickup, id_location_dropoff, "
                "id_vendor, passenger_count, trip_distance, fare_amount, total_amount")


@register("rows_removed", f"""{WT}
SELECT {REMOVED_COLS} FROM t
EXCEPT
SELECT {REMOVED_COLS} FROM t WHERE trip_distance > 0 AND dropoff_datetime > pickup_datetime""")
def q_rows_removed(spark, d):
    t = T(spark, d)
    after = Q.filter_time_order(Q.filter_positive(t, ["trip_distance"]))
    return S.rows_removed(t, after, [c.strip() for c in REMOVED_COLS.split(",")])


@register("rows_removed_all", f"""{WT}
SELECT {REMOVED_COLS} FROM t
EXCEPT ALL
SELECT {REMOVED_COLS} FROM t WHERE trip_distance > 0 AND dropoff_datetime > pickup_datetime""")
def q_rows_removed_all(spark, d):
    t = T(spark, d)
    after = Q.filter_time_order(Q.filter_positive(t, ["trip_distance"]))
    return S.rows_removed(t, after, [c.strip() for c in REMOVED_COLS.split(",")], distinct=False)


@register("densify_domain", f"""{WT},
dom AS (SELECT unnest({SQL_LIST(fixed.SERVICE_TYPES + ['noService'])}) AS service_type),
agg AS (SELECT service_type, count(*) AS trips FROM t GROUP BY 1)
SELECT dom.service_type, COALESCE(agg.trips, 0) AS trips FROM dom LEFT JOIN agg USING (service_type)""")
def q_densify_domain(spark, d):
    agg = A.count_by(T(spark, d), ["service_type"])
    return S.densify_domain(agg, fixed.SERVICE_TYPES + ["noService"], "service_type", 0)
