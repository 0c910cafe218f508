"""Registered queries: dimensions, facts, keys and type-2 history
(inventory section 2.12)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from farelake import fixed
from farelake.operators import dims as D
from farelake.operators import facts as FT
from farelake.operators.scd2 import scd2_merge
from farelake.plans import fixtures as fx
from farelake.plans.catalog import DUR, SEASON_NORTH, WT, T, register
from farelake.plans.q_sources import CONFORMED_SQL, conformed_all


def _dense_sql(sk: str, col: str, src: str) -> str:
    return (f"SELECT row_number() OVER (ORDER BY {col}) AS {sk}, {col} "
            f"FROM (SELECT DISTINCT CAST({col} AS BIGINT) AS {col} FROM {src} WHERE {col} IS NOT NULL)")


def _label_sql(col: str, labels: dict, default: str) -> str:
    def q(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in labels.items())
    return f"CASE {whens} ELSE '{default}' END"


def _coded_sql(sk, col, label_col, labels, default, src="t"):
    return (f"SELECT {sk}, {col}, {_label_sql(col, labels, default)} AS {label_col} "
            f"FROM ({_dense_sql(sk, col, src)})")


@register("dim_vendor", f"{WT} {_coded_sql('sk_vendor', 'id_vendor', 'vendor_description', fixed.VENDOR_LABELS, fixed.VENDOR_DEFAULT)}")
def q_dim_vendor(spark, d):
    return D.dim_vendor(T(spark, d))


@register("dim_payment_type", f"{WT} {_coded_sql('sk_payment_type', 'id_payment_type', 'payment_type_description', fixed.PAYMENT_LABELS, fixed.PAYMENT_DEFAULT)}")
def q_dim_payment_type(spark, d):
    return D.dim_payment_type(T(spark, d))


@register("dim_rate", f"{WT} {_coded_sql('sk_ratecode', 'id_rate', 'ratecode_description', fixed.RATE_LABELS, fixed.RATE_DEFAULT)}")
def q_dim_rate(spark, d):
    return D.dim_rate(T(spark, d))


def _svc_sql(i: int, col: str = "id_service_type") -> str:
    labels = {k: v[i] for k, v in fixed.SERVICE_LABELS.items()}
    return _label_sql(col, labels, fixed.SERVICE_DEFAULT)


SERVICE_DIM_SQL = f"""SELECT row_number() OVER (ORDER BY id_service_type) AS sk_service_type, id_service_type,
  {_svc_sql(0)} AS description, {_svc_sql(1)} AS category, {_svc_sql(2)} AS regulation_body
FROM (SELECT DISTINCT service_type AS id_service_type FROM {{src}} WHERE service_type IS NOT NULL)"""


@register("dim_service_type", f"{WT} {SERVICE_DIM_SQL.format(src='t')}")
def q_dim_service_type(spark, d):
    return D.dim_service_type(T(spark, d))


@register("dim_location", f"""
SELECT row_number() OVER (ORDER BY id_location, borough, zone, service_zone) AS sk_location,
       id_location, borough, zone, service_zone
FROM (SELECT DISTINCT TRY_CAST(LocationID AS BIGINT) AS id_location, Borough AS borough, Zone AS zone, service_zone
      FROM ({fx.ZONES_SQL}))""")
def q_dim_location(spark, d):
    return D.dim_location(fx.zones(spark, d))


COMPANY_DIM_SQL = f"""SELECT row_number() OVER (ORDER BY id_hvfhs_license_num, app_company_affiliation) AS sk_company_hv,
  id_hvfhs_license_num, app_company_affiliation
FROM (SELECT DISTINCT "High Volume" AS id_hvfhs_license_num, upper("App Company Affiliation") AS app_company_affiliation
      FROM ({fx.COMPANIES_SQL}) WHERE "High Volume" IS NOT NULL AND "App Company Affiliation" IS NOT NULL)"""

LICENCE_DIM_SQL = f"""SELECT row_number() OVER (ORDER BY id_license_number, app_company_affiliation) AS sk_license_number,
  id_license_number, app_company_affiliation
FROM (SELECT DISTINCT "LICENSEE NUMBER" AS id_license_number, "NAME OF LICENSEE NORMALIZED" AS app_company_affiliation
      FROM ({fx.LICENCES_SQL}) WHERE "LICENSEE NUMBER" IS NOT NULL AND "NAME OF LICENSEE NORMALIZED" IS NOT NULL)"""


@register("dim_companies_hv", COMPANY_DIM_SQL)
def q_dim_companies_hv(spark, d):
    return D.dim_companies_hv(fx.companies(spark, d))


@register("dim_license_number", LICENCE_DIM_SQL)
def q_dim_license_number(spark, d):
    return D.dim_license_number(fx.licences(spark, d))


@register("dim_date", f"""{WT},
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
         FROM (SELECT min(CAST(pickup_datetime AS DATE)) AS lo, max(CAST(dropoff_datetime AS DATE)) AS hi FROM t))
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS sk_date, date, CAST(day(date) AS INTEGER) AS day,
       CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year, dayname(date) AS day_of_week,
       CAST(dayofweek(date) + 1 AS INTEGER) AS week_day FROM days""")
def q_dim_date(spark, d):
    return D.dim_date_between(T(spark, d))


@register("dim_time", f"""{WT},
days AS (SELECT DISTINCT CAST(dropoff_datetime AS DATE) AS d FROM t WHERE dropoff_datetime IS NOT NULL)
SELECT CAST(strftime(d, '%d%m%Y') AS INTEGER) AS sk_time, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date,
       dayname(d) AS weekday, CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year,
       {SEASON_NORTH('month(d)')} AS season,
       dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday FROM days""")
def q_dim_time(spark, d):
    return D.dim_time(T(spark, d))


FACT_SQL = f"""WITH c AS ({CONFORMED_SQL}),
dv AS ({_dense_sql('sk', 'id_vendor', 'c')}),
dp AS ({_dense_sql('sk', 'id_payment_type', 'c')}),
dr AS ({_dense_sql('sk', 'id_rate', 'c')}),
ds AS ({SERVICE_DIM_SQL.format(src='c')}),
co AS ({COMPANY_DIM_SQL}),
li AS ({LICENCE_DIM_SQL})
SELECT dp.sk AS fk_payment_type, dr.sk AS fk_ratecode, dv.sk AS fk_vendor, ds.sk_service_type AS fk_service_type,
       c.service_type, li.sk_license_number AS fk_license_number, co.sk_company_hv AS fk_company_hv,
       c.pickup_datetime, CAST(strftime(c.pickup_datetime, '%Y%m%d') AS INTEGER) AS pickup_date,
       c.dropoff_datetime, CAST(strftime(c.dropoff_datetime, '%Y%m%d') AS INTEGER) AS dropoff_date,
       c.id_location_pickup, c.id_location_dropoff, c.passenger_count, c.trip_distance, c.fare_amount, c.extra,
       c.mta_tax, c.tip_amount, c.tolls_amount, c.total_amount,
       CAST(year(c.pickup_datetime) AS INTEGER) AS year, CAST(month(c.pickup_datetime) AS INTEGER) AS month
FROM c LEFT JOIN dv ON c.id_vendor = dv.id_vendor LEFT JOIN dp ON c.id_payment_type = dp.id_payment_type
LEFT JOIN dr ON c.id_rate = dr.id_rate LEFT JOIN ds ON c.service_type = ds.id_service_type
LEFT JOIN co ON c.id_hvfhs_license_num = co.id_hvfhs_license_num
LEFT JOIN li ON c.id_license_number = li.id_license_number"""


def build_fact(spark, d):
    # the trips view is staged once inside ``conformed_all``; the dimensions
    # and the fact read the staged table (narrow conform on top)
    trips = conformed_all(spark, d, with_source=True)
    return FT.fact_trip(trips, D.dim_vendor(trips), D.dim_payment_type(trips), D.dim_rate(trips),
                        D.dim_service_type(trips), D.dim_companies_hv(fx.companies(spark, d)),
                        D.dim_license_number(fx.licences(spark, d)))


def _has_key(fact):
    """A fact with its key replaced by whether it is given."""
    return fact.withColumn("has_key", F.col("sk_trip").isNotNull()).drop("sk_trip")


@register("fact_trip", FACT_SQL.replace("SELECT dp.sk AS fk_payment_type", "SELECT TRUE AS has_key, dp.sk AS fk_payment_type"))
def q_fact_trip(spark, d):
    return _has_key(build_fact(spark, d))


@register("fact_trip_keys", f"SELECT service_type, count(*) AS n_rows, count(*) AS n_keys FROM ({CONFORMED_SQL}) GROUP BY service_type")
def q_fact_trip_keys(spark, d):
    """The fact's key alone: rows and distinct keys of each service."""
    from farelake.operators.keys import trip_key
    keys = trip_key(conformed_all(spark, d, with_source=True).select("service_type", "src_file", "src_row"))
    one = keys.groupBy("service_type", "sk_trip").agg(F.count(F.lit(1)).alias("n"))
    return one.groupBy("service_type").agg(F.sum("n").alias("n_rows"), F.count("sk_trip").alias("n_keys"))


def _keyed(fact):
    """A fact with its key replaced by what holds of it: given, and on how many rows."""
    n = F.count(F.lit(1)).over(Window.partitionBy("sk_trip"))
    return fact.withColumns({"has_key": F.col("sk_trip").isNotNull(), "rows_of_key": n}).drop("sk_trip")


KEYED_SQL = "TRUE AS has_key, CAST(1 AS BIGINT) AS rows_of_key"

WIDE_SQL = f"""SELECT c.*, {KEYED_SQL}, CAST(NULL AS BOOLEAN) AS has_problem, CAST(NULL AS VARCHAR) AS problem_description, {DUR()} AS trip_duration_minutes, CAST(pickup_datetime AS DATE) AS pickup_date,
  CAST(dropoff_datetime AS DATE) AS dropoff_date, dayname(pickup_datetime) AS weekday,
  CAST(hour(pickup_datetime) AS INTEGER) AS hour, CAST(strftime(dropoff_datetime, '%d%m%Y') AS INTEGER) AS fk_time,
  CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month
FROM ({CONFORMED_SQL}) c"""


@register("fact_trip_wide", WIDE_SQL)
def q_fact_trip_wide(spark, d):
    return _keyed(FT.fact_trip_wide(conformed_all(spark, d, with_source=True)))


SCD2_SQL = f"""WITH cur AS ({fx.SCD2_CURRENT_SQL}), snap AS ({fx.SCD2_SNAPSHOT_SQL}),
hist AS (SELECT * FROM cur WHERE NOT is_current),
op AS (SELECT * FROM cur WHERE is_current),
j AS (SELECT COALESCE(op.id, snap.id) AS id, op.name AS c_name, op.segment AS c_segment, op.effective_date AS c_eff,
             op.end_date AS c_end, op.id IS NOT NULL AS in_c, snap.name AS n_name, snap.segment AS n_segment,
             snap.id IS NOT NULL AS in_n
      FROM op FULL OUTER JOIN snap ON op.id = snap.id),
k AS (SELECT *, in_c AND in_n AND (c_name IS DISTINCT FROM n_name OR c_segment IS DISTINCT FROM n_segment) AS changed FROM j)
SELECT id, name, segment, effective_date, end_date, is_current FROM hist
UNION ALL
SELECT id, c_name, c_segment, c_eff, CASE WHEN changed THEN DATE '2024-06-01' ELSE c_end END, NOT changed FROM k WHERE in_c
UNION ALL
SELECT id, n_name, n_segment, DATE '2024-06-01', CAST(NULL AS DATE), TRUE FROM k WHERE in_n AND (NOT in_c OR changed)"""


@register("scd2_merge", SCD2_SQL)
def q_scd2_merge(spark, d):
    return scd2_merge(fx.scd2_snapshot(spark, d), fx.scd2_current(spark, d), "id", ["name", "segment"], "2024-06-01")


@register("asof_customer_version", fx.CUSTOMER_AT_SQL)
def q_asof_customer_version(spark, d):
    """Each trip with the customer version valid at its pickup."""
    from farelake.operators.asof import asof_join
    return asof_join(fx.rides(spark, d), fx.customer_history(spark, d), "customer", "pickup_datetime", ["segment"],
                     version_key="id", prefix="customer_")


@register("surrogate_key", "SELECT row_number() OVER (ORDER BY c_nationkey, c_custkey) AS sk_customer, * FROM customer")
def q_surrogate_key(spark, d):
    from farelake.operators.keys import dense_index
    c = fx.table(spark, d, "customer")
    return dense_index(c, ["c_nationkey", "c_custkey"], "sk_customer")


# ---- 2.13 job over a trusted layer built from the trips --------------------------

_FLAG = "COALESCE(PULocationID <= 0 OR DOLocationID <= 0, FALSE)"


def _clean_conformed_sql() -> str:
    yg = [f"""SELECT '{s}' AS service_type, {p}_pickup_datetime AS pickup_datetime,
      {p}_dropoff_datetime AS dropoff_datetime, TRY_CAST(PULocationID AS BIGINT) AS id_location_pickup,
      TRY_CAST(DOLocationID AS BIGINT) AS id_location_dropoff, VendorID AS id_vendor,
      CAST(CAST(payment_type AS INTEGER) AS BIGINT) AS id_payment_type, TRY_CAST(RatecodeID AS BIGINT) AS id_rate,
      {fx.conformed_sql(s, 'trip_type')}, CASE WHEN passenger_count <= 0 THEN 1.0 ELSE passenger_count END AS passenger_count,
      trip_distance, fare_amount, {fx.conformed_sql(s, 'extra')}, {fx.conformed_sql(s, 'mta_tax')}, tip_amount,
      {fx.conformed_sql(s, 'tolls_amount')}, total_amount, CAST(NULL AS VARCHAR) AS id_license_number,
      CAST(NULL AS VARCHAR) AS id_hvfhs_license_num, {fx.new_fields_sql(s)}, {_FLAG} AS has_problem,
      CASE WHEN {_FLAG} THEN '{fixed.INVALID_LOCATION_REASON}' END AS problem_description
    FROM ({fx.raw_service_sql(s, True)}) WHERE trip_distance > 0 AND {p}_dropoff_datetime > {p}_pickup_datetime"""
          for s, p in (("yellowTaxi", "tpep"), ("greenTaxi", "lpep"))]
    nulls = ("CAST(NULL AS BIGINT) AS id_vendor, CAST(NULL AS BIGINT) AS id_payment_type, CAST(NULL AS BIGINT) AS id_rate, "
             "CAST(NULL AS BIGINT) AS trip_type, CAST(NULL AS DOUBLE) AS passenger_count, "
             "CAST(NULL AS DOUBLE) AS trip_distance, CAST(NULL AS DOUBLE) AS fare_amount, CAST(NULL AS DOUBLE) AS extra, "
             "CAST(NULL AS DOUBLE) AS mta_tax, CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS DOUBLE) AS tolls_amount, "
             "CAST(NULL AS DOUBLE) AS total_amount")
    flags = "FALSE AS has_problem, CAST(NULL AS VARCHAR) AS problem_description"
    fhv = f"""SELECT 'forHireVehicle' AS service_type, pickup_datetime, dropOff_datetime AS dropoff_datetime,
      TRY_CAST(PUlocationID AS BIGINT) AS id_location_pickup, TRY_CAST(DOlocationID AS BIGINT) AS id_location_dropoff,
      {nulls}, Affiliated_base_number AS id_license_number, CAST(NULL AS VARCHAR) AS id_hvfhs_license_num,
      {fx.new_fields_sql('forHireVehicle')}, {flags}
    FROM ({fx.raw_service_sql('forHireVehicle', True)})"""
    hv = f"""SELECT 'highVolumeForHire' AS service_type, pickup_datetime, dropoff_datetime,
      TRY_CAST(PULocationID AS BIGINT) AS id_location_pickup, TRY_CAST(DOLocationID AS BIGINT) AS id_location_dropoff,
      {nulls}, CAST(NULL AS VARCHAR) AS id_license_number, hvfhs_license_num AS id_hvfhs_license_num,
      {fx.new_fields_sql('highVolumeForHire')}, {flags}
    FROM ({fx.raw_service_sql('highVolumeForHire', True)})
    WHERE trip_miles > 0 AND trip_time > 0 AND dropoff_datetime > pickup_datetime"""
    return "\nUNION ALL\n".join(yg + [fhv, hv])


def stored_trips(spark, d):
    """The trips, written once under the shared folder and read back."""
    from farelake.plans.q_sources import scratch
    staged = scratch(spark, "trips")
    T(spark, d).write.parquet(staged)
    return spark.read.parquet(staged)


def trusted_from_trips(spark, d, t=None) -> str:
    """A trusted layer built from the trips (``t``, where they are stored already):
    each service's cleaning profile, written partitioned by year/month under the
    shared folder; returns its root."""
    from farelake.functions import columns as C
    from farelake.operators.quality import apply_cleaning
    from farelake.plans.q_sources import scratch
    from farelake.sinks.writers import write_partitioned
    t = stored_trips(spark, d) if t is None else t
    trusted = scratch(spark, "trusted")
    for s in fixed.SERVICE_TYPES:
        raw = fx.raw_from_trips(t, s, full=True)
        ts = next(c for c in raw.columns if c.lower().endswith("pickup_datetime"))
        raw = raw.withColumns({"year": C.year_of(ts), "month": C.month_of(ts)})
        write_partitioned(apply_cleaning(raw, s), f"{trusted}/{s}")
    return trusted


@register("job_unify_trips", f"SELECT DISTINCT * FROM ({_clean_conformed_sql()})")
def q_job_unify_trips(spark, d):
    """The unify job over a trusted layer built from the trips, read back."""
    from farelake.plans.jobs import job_unify_trips
    from farelake.plans.q_sources import scratch
    out = scratch(spark, "unified")
    job_unify_trips(spark, trusted_from_trips(spark, d), out)
    return spark.read.parquet(out)


@register("job_unify_trips_two_runs", f"SELECT DISTINCT * FROM ({_clean_conformed_sql()})")
def q_job_unify_trips_two_runs(spark, d):
    """The unify job for the first half of the years, then for all of them: rows
    of the first run are found in the history and not added again."""
    from farelake.plans.jobs import job_unify_runs
    from farelake.plans.q_sources import scratch
    t = stored_trips(spark, d)
    trusted, out = trusted_from_trips(spark, d, t), scratch(spark, "unified-runs")
    lo, hi = t.agg(F.min(F.year("pickup_datetime")), F.max(F.year("pickup_datetime"))).first()
    job_unify_runs(spark, trusted, out, range(lo, (lo + hi) // 2 + 1), buckets=16)
    return job_unify_runs(spark, trusted, out, range(lo, hi + 1))


@register("job_trusted_to_dw", FACT_SQL.replace(f"WITH c AS ({CONFORMED_SQL})", f"WITH c AS ({_clean_conformed_sql()})")
          .replace("SELECT dp.sk AS fk_payment_type", f"SELECT {KEYED_SQL}, dp.sk AS fk_payment_type"))
def q_job_trusted_to_dw(spark, d):
    """The warehouse job (staging, dimensions, partitioned fact, commit) over a
    trusted layer built from the trips; the committed fact is read back."""
    from farelake.plans.jobs import job_trusted_to_dw
    from farelake.plans.q_sources import scratch
    fact = job_trusted_to_dw(spark, trusted_from_trips(spark, d), scratch(spark, "dw"),
                             companies=fx.companies(spark, d), licences=fx.licences(spark, d))
    return _keyed(fact)


def _extended(source: str) -> str:
    """Keys of two runs: codes of the first years, then those that the later years add."""
    return (f"WITH c0 AS ({source}), c AS (SELECT *, CASE WHEN year(pickup_datetime) <= (SELECT (min(year(pickup_datetime)) + max(year(pickup_datetime))) // 2 "
            f"FROM ({fx.TRIPS_SQL})) THEN 1 ELSE 2 END AS run FROM c0)")


def _extended_dim(sk: str, col: str, kind: str, name: str) -> str:
    return (f"SELECT row_number() OVER (ORDER BY run, {col}) AS {sk}, {col} AS {name} "
            f"FROM (SELECT CAST({col} AS {kind}) AS {col}, min(run) AS run FROM c WHERE {col} IS NOT NULL GROUP BY 1)")


TWO_RUNS_SQL = (FACT_SQL.replace(f"WITH c AS ({CONFORMED_SQL})", _extended(_clean_conformed_sql()))
                .replace(_dense_sql("sk", "id_vendor", "c"), _extended_dim("sk", "id_vendor", "BIGINT", "id_vendor"))
                .replace(_dense_sql("sk", "id_payment_type", "c"), _extended_dim("sk", "id_payment_type", "BIGINT", "id_payment_type"))
                .replace(_dense_sql("sk", "id_rate", "c"), _extended_dim("sk", "id_rate", "BIGINT", "id_rate"))
                .replace(SERVICE_DIM_SQL.format(src="c"), _extended_dim("sk_service_type", "service_type", "VARCHAR", "id_service_type"))
                .replace("SELECT dp.sk AS fk_payment_type", f"SELECT {KEYED_SQL}, dp.sk AS fk_payment_type"))


@register("job_trusted_to_dw_two_runs", TWO_RUNS_SQL)
def q_job_trusted_to_dw_two_runs(spark, d):
    """The warehouse job for the first half of the years, then for the second:
    the fact of both, with the keys of the first run kept."""
    from farelake.plans.jobs import job_trusted_to_dw
    from farelake.plans.q_sources import scratch
    from farelake.sinks.commits import read_table
    t = stored_trips(spark, d)
    trusted, dw = trusted_from_trips(spark, d, t), scratch(spark, "dw")
    lo, hi = t.agg(F.min(F.year("pickup_datetime")), F.max(F.year("pickup_datetime"))).first()
    for years in (range(lo, (lo + hi) // 2 + 1), range((lo + hi) // 2 + 1, hi + 1)):
        job_trusted_to_dw(spark, trusted, dw, years, companies=fx.companies(spark, d), licences=fx.licences(spark, d))
    return _keyed(read_table(spark, dw, "fact_taxi_trip"))


# ---- 2.13 raw -> trusted over a raw layer with faulty files -----------------------

def raw_to_trusted(spark, d):
    """The job over monthly raw files written from the trips, three of them
    faulty: (report, rejects)."""
    from farelake.plans.jobs import job_raw_to_trusted
    from farelake.plans.q_sources import scratch
    raw = scratch(spark, "raw")
    fx.write_raw_layer(spark, d, raw)
    lo, hi = T(spark, d).agg(F.min(F.year("pickup_datetime")), F.max(F.year("pickup_datetime"))).first()
    return job_raw_to_trusted(spark, raw, scratch(spark, "trusted"), range(lo, hi + 1))


@register("job_raw_to_trusted", f"""WITH c AS (SELECT *, year(pickup_datetime) AS y, month(pickup_datetime) AS m FROM ({_clean_conformed_sql()}))
SELECT c.service_type, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, count(*) AS n_rows
FROM c LEFT JOIN ({fx.RAW_FAULTS_SQL}) f ON f.service_type = c.service_type AND f.ym = y * 100 + m
WHERE f.ym IS NULL GROUP BY c.service_type, y, m""")
def q_job_raw_to_trusted(spark, d):
    return raw_to_trusted(spark, d)[0]


@register("ingest_rejects", fx.RAW_REJECTS_SQL)
def q_ingest_rejects(spark, d):
    """The rejects of that job; the error without its details."""
    return raw_to_trusted(spark, d)[1].withColumn("error", F.substring_index("error", ":", 1))


# ---- 2.13 loading what has changed ------------------------------------------------

_STATE_SQL = f"""WITH c AS (SELECT service_type, year(pickup_datetime) AS year, month(pickup_datetime) AS month, count(*) AS n
  FROM ({fx.TRIPS_SQL}) WHERE service_type IN ('greenTaxi', 'yellowTaxi') GROUP BY 1, 2, 3),
e AS (SELECT service_type, min(year * 100 + month) AS lo, max(year * 100 + month) AS hi FROM c GROUP BY 1)"""


@register("job_load_changes", f"""{_STATE_SQL}
SELECT c.service_type, CAST(c.year AS INTEGER) AS year, CAST(c.month AS INTEGER) AS month,
  CASE WHEN c.service_type = 'yellowTaxi' AND year * 100 + month = lo THEN 'changed'
       WHEN c.service_type = 'greenTaxi' AND year * 100 + month = hi THEN 'gone' ELSE 'same' END AS state,
  (SELECT count(*) FROM ({_clean_conformed_sql()}) f WHERE f.service_type = c.service_type
     AND year(f.pickup_datetime) = c.year AND month(f.pickup_datetime) = c.month
     AND NOT (c.service_type = 'greenTaxi' AND c.year * 100 + c.month = e.hi)
     AND NOT (c.service_type = 'yellowTaxi' AND c.year * 100 + c.month = e.lo AND COALESCE(f.id_location_pickup % 2 = 0, FALSE))) AS trips
FROM c JOIN e USING (service_type)""")
def q_job_load_changes(spark, d):
    """Yellow and green monthly files of the trips are loaded; then yellow's first
    file is replaced by its trips from odd locations, green's last one is deleted,
    and what has changed is loaded: each file's state and its trips in the fact."""
    from farelake.plans.jobs import job_load_changes
    from farelake.plans.q_sources import scratch
    from farelake.session import shared_table
    from farelake.sinks.commits import read_table
    from farelake.sources import raw_files as RF
    raw, trusted, dw = (scratch(spark, x) for x in ("raw", "trusted", "dw"))
    services = {p: s for p, s in fixed.SERVICE_BY_FILE_PREFIX.items() if s in ("yellowTaxi", "greenTaxi")}
    fx.write_raw_layer(spark, d, raw, faults=False, services=services)
    job_load_changes(spark, raw, trusted, dw, services=services)
    named = {s: RF.logical_files(RF.list_files(spark, f"{raw}/{s}")) for s in services.values()}
    first = named["yellowTaxi"].orderBy("filename").first().path.rsplit("/", 1)[0]
    odd = shared_table(spark.read.parquet(first).where("PULocationID % 2 <> 0 or PULocationID is null"), "odd")
    odd.coalesce(1).write.mode("overwrite").parquet(first)
    last = named["greenTaxi"].orderBy(F.desc("filename")).first().path.rsplit("/", 1)[0]
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(last)
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    states = job_load_changes(spark, raw, trusted, dw, services=services)
    fact = read_table(spark, dw, "fact_taxi_trip").groupBy("service_type", "year", "month").agg(F.count(F.lit(1)).alias("trips"))
    return states.select("service_type", "year", "month", "state").join(fact, ["service_type", "year", "month"], "left").select(
        "service_type", "year", "month", "state", F.coalesce("trips", F.lit(0)).alias("trips"))
