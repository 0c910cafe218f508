"""Registered queries: sources, ingestion planning, sinks, conforming, scalar
functions (inventory sections 2.1-2.4 and 2.11)."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.operators import conform as CF
from farelake.operators import ingest as IG
from farelake.plans import fixtures as fx
from farelake.plans.catalog import (DUR, R, SEASON_NORTH, SEASON_PT, SQL_IN, SQL_LIST, SQL_MAP, WE, WT, E, T,
                                     register)
from farelake.session import ensure_checkpoint_dir
from farelake.sinks import writers as W
from farelake.sources import readers as RD


def scratch(spark, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/farelake-scratch/{tag}-{uuid.uuid4().hex[:12]}"


# ---- 2.1 sources -------------------------------------------------------------

@register("scan_parquet", "SELECT * FROM lineitem")
def q_scan_parquet(spark, d):
    return RD.scan_parquet(spark, f"{d}/lineitem.parquet")


LINEITEM_COLS = ("l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,"
                 "l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate")


@register("table_shape", f"SELECT COUNT(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols, '{LINEITEM_COLS}' AS columns FROM lineitem")
def q_table_shape(spark, d):
    return RD.table_shape(RD.scan_parquet(spark, f"{d}/lineitem.parquet"))


T_ORDER = ("service_type, pickup_datetime, dropoff_datetime, id_location_pickup, id_location_dropoff, "
           "id_vendor, id_payment_type, id_rate, passenger_count, trip_distance, fare_amount, tip_amount, total_amount")


@register("preview", f"{WT} SELECT * FROM t ORDER BY {T_ORDER} LIMIT 5")
def q_preview(spark, d):
    return RD.preview(T(spark, d), 5)


@register("calendar_range", f"""{WT}
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT min(CAST(pickup_datetime AS DATE)) AS lo, max(CAST(dropoff_datetime AS DATE)) AS hi FROM t)""")
def q_calendar_range(spark, d):
    return RD.calendar_between(T(spark, d), "pickup_datetime", "dropoff_datetime")


@register("scan_multi_service", """
SELECT *, 'yellowTaxi' AS service_type FROM customer
UNION ALL BY NAME SELECT *, 'greenTaxi' AS service_type FROM supplier""")
def q_scan_multi_service(spark, d):
    paths = {"yellowTaxi": f"{d}/customer.parquet", "greenTaxi": f"{d}/supplier.parquet",
             "highVolumeForHire": f"{d}/no_such_service"}
    return RD.scan_multi_service(spark, paths, partitioned=False)


@register("scan_csv", fx.ZONES_SQL)
def q_scan_csv(spark, d):
    path = scratch(spark, "zones-csv")
    fx.zones(spark, d).write.option("header", "true").csv(path)
    return RD.scan_csv(spark, path)


# ---- 2.3 sinks (write, then read back) ----------------------------------------

def _trips_partitioned(spark, d):
    t = T(spark, d).withColumns({"year": C.year_of("pickup_datetime"), "month": C.month_of("pickup_datetime")})
    path = scratch(spark, "trips-part")
    W.write_partitioned(t, path, max_files=4)
    return path


@register("write_partitioned", f"""{WT}
SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month FROM t""")
def q_write_partitioned(spark, d):
    return RD.scan_partitioned(spark, _trips_partitioned(spark, d))


@register("scan_partitioned", f"""{WT}
SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month
FROM t WHERE year(pickup_datetime) IN (1996, 1997) AND month(pickup_datetime) IN (1, 2, 3)""")
def q_scan_partitioned(spark, d):
    return RD.scan_partitioned(spark, _trips_partitioned(spark, d), years=[1996, 1997], months=[1, 2, 3])


@register("replace_partition", f"""{WT}
SELECT service_type, pickup_datetime, dropoff_datetime, id_location_pickup, id_location_dropoff, id_vendor,
       id_payment_type, id_rate, passenger_count, trip_distance,
       CASE WHEN year(pickup_datetime) = 1996 AND month(pickup_datetime) = 5 THEN fare_amount * 2 ELSE fare_amount END AS fare_amount,
       tip_amount, total_amount,
       CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month FROM t""")
def q_replace_partition(spark, d):
    path = _trips_partitioned(spark, d)
    t = RD.scan_partitioned(spark, path, [1996], [5])
    # read the month, change it, and write it back under the same partition;
    # it is staged as a written table first, since source and sink are the same folder
    staged = scratch(spark, "stage")
    t.withColumn("fare_amount", F.col("fare_amount") * 2).write.parquet(staged)
    W.replace_partition(RD.scan_partitioned(spark, staged), path, 1996, 5)
    return RD.scan_partitioned(spark, path)


@register("write_table", f"{WT} SELECT * FROM t")
def q_write_table(spark, d):
    path = scratch(spark, "table")
    W.write_table(T(spark, d), path)
    return spark.read.parquet(path)


@register("limit_output_files", f"{WT} SELECT * FROM t")
def q_limit_output_files(spark, d):
    return W.limit_output_files(T(spark, d), 4)


@register("stamp_load_time", "SELECT *, TIMESTAMP '2024-05-01 09:00:00' AS load_datetime FROM customer")
def q_stamp_load_time(spark, d):
    c = RD.scan_parquet(spark, f"{d}/customer.parquet")
    return W.stamp_load_time(c, "America/Sao_Paulo", now=_dt.datetime(2024, 5, 1, 12, 0, 0))


# ---- 2.2 ingestion planning ---------------------------------------------------

@register("extract_links", """SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages""")
def q_extract_links(spark, d):
    return IG.extract_links(RD.scan_parquet(spark, f"{d}/pages.parquet"))


@register("absolute_url", """
SELECT page_id, href, CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://www.nyc.gov' || href END AS url
FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages)
WHERE contains(href, '/')""")
def q_absolute_url(spark, d):
    links = IG.extract_links(RD.scan_parquet(spark, f"{d}/pages.parquet"), contains="/")
    return IG.absolute_url(links, "href", "https://www.nyc.gov")


URL_PATTERN = r"^https?://([^/?#]+)/([a-z]{2})/(\d+)"


@register("parse_dataset_name", f"""
SELECT * FROM (SELECT page_id, url, regexp_extract(url, '{URL_PATTERN}', 1) AS host,
       regexp_extract(url, '{URL_PATTERN}', 2) AS lang, regexp_extract(url, '{URL_PATTERN}', 3) AS num
FROM pages) WHERE host <> ''""")
def q_parse_dataset_name(spark, d):
    pages = RD.scan_parquet(spark, f"{d}/pages.parquet").select("page_id", "url")
    return IG.parse_dataset_name(pages, "url", URL_PATTERN, ("host", "lang", "num"))


def _dataset_files(spark, d):
    """Monthly file names the trips would come from (one per service/month)."""
    t = T(spark, d).where(F.col("service_type").isin(fixed.SERVICE_TYPES))
    rev = {v: k for k, v in fixed.SERVICE_BY_FILE_PREFIX.items()}
    months = t.select("service_type", C.year_of("pickup_datetime").alias("y"),
                      C.month_of("pickup_datetime").alias("m")).distinct()
    files = months.select(F.format_string("%s_%04d-%02d.parquet", C.translate_label("service_type", rev),
                                          F.col("y"), F.col("m")).alias("filename"))
    files = IG.parse_dataset_name(files, "filename")
    return IG.service_folder(files, "prefix")


FILES_SQL = f"""{WT},
months AS (SELECT DISTINCT service_type, year(pickup_datetime) AS y, month(pickup_datetime) AS m FROM t
           WHERE service_type IN {SQL_IN(fixed.SERVICE_TYPES)}),
files AS (SELECT printf('%s_%04d-%02d.parquet',
            {SQL_MAP('service_type', {v: k for k, v in fixed.SERVICE_BY_FILE_PREFIX.items()})}, y, m) AS filename
          FROM months),
parsed AS (SELECT filename,
  regexp_extract(filename, '{fixed.DATASET_FILE_PATTERN}', 1) AS prefix,
  regexp_extract(filename, '{fixed.DATASET_FILE_PATTERN}', 2) AS year,
  regexp_extract(filename, '{fixed.DATASET_FILE_PATTERN}', 3) AS month FROM files),
svc AS (SELECT *, {SQL_MAP('prefix', fixed.SERVICE_BY_FILE_PREFIX)} AS service_type
  FROM parsed WHERE prefix <> '')"""


@register("service_folder", f"{FILES_SQL} SELECT * FROM svc")
def q_service_folder(spark, d):
    return _dataset_files(spark, d)


@register("target_key", f"{FILES_SQL} SELECT *, concat_ws('/', 'raw', service_type, year, filename) AS key FROM svc")
def q_target_key(spark, d):
    return IG.target_key(_dataset_files(spark, d), "raw")


def _grid(spark, d):
    t = T(spark, d)
    span = t.agg(F.min("pickup_datetime").alias("start"), F.max("pickup_datetime").alias("end"))
    return IG.month_grid(span)


GRID_SQL = f"""{WT},
span AS (SELECT date_trunc('month', min(pickup_datetime)) AS lo, date_trunc('month', max(pickup_datetime)) AS hi FROM t),
mm AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM span),
svc AS (SELECT unnest({SQL_LIST(fixed.SERVICE_TYPES)}) AS service_type),
grid AS (SELECT service_type, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month FROM mm, svc),
have AS (SELECT DISTINCT service_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(month(pickup_datetime) AS INTEGER) AS month FROM t),
avail AS (SELECT g.*, h.service_type IS NOT NULL AS found FROM grid g LEFT JOIN have h
          ON g.service_type = h.service_type AND g.year = h.year AND g.month = h.month)"""


@register("month_range", f"{GRID_SQL} SELECT * FROM grid")
def q_month_range(spark, d):
    return _grid(spark, d)


def _available(spark, d):
    t = T(spark, d)
    links = t.select("service_type", C.year_of("pickup_datetime").alias("year"),
                     C.month_of("pickup_datetime").alias("month"))
    return IG.available_in_range(_grid(spark, d), links)


@register("available_in_range", f"{GRID_SQL} SELECT * FROM avail")
def q_available_in_range(spark, d):
    return _available(spark, d)


@register("pending_files", f"""{GRID_SQL},
loaded AS (SELECT DISTINCT service_type, CAST(year(dropoff_datetime) AS INTEGER) AS year,
           CAST(month(dropoff_datetime) AS INTEGER) AS month FROM t)
SELECT a.* FROM avail a WHERE a.found AND NOT EXISTS (SELECT 1 FROM loaded l
  WHERE l.service_type = a.service_type AND l.year = a.year AND l.month = a.month)""")
def q_pending_files(spark, d):
    t = T(spark, d)
    wanted = _available(spark, d).where("found")
    loaded = t.select("service_type", C.year_of("dropoff_datetime").alias("year"),
                      C.month_of("dropoff_datetime").alias("month"))
    return IG.pending_files(wanted, loaded, ["service_type", "year", "month"])


# ---- 2.4 conforming -----------------------------------------------------------

RAW_YELLOW = f"WITH ry AS ({fx.raw_service_sql('yellowTaxi')})"
RAW_FHV = f"WITH rf AS ({fx.raw_service_sql('forHireVehicle')})"


@register("rename_columns", f"""{RAW_YELLOW}
SELECT VendorID AS id_vendor, tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
       passenger_count, trip_distance, RatecodeID AS id_rate, PULocationID AS id_location_pickup,
       DOLocationID AS id_location_dropoff, payment_type AS id_payment_type, fare_amount, tip_amount, total_amount
FROM ry""")
def q_rename_columns(spark, d):
    return CF.rename_columns(fx.raw_service(spark, d, "yellowTaxi"), fixed.CONFORM_RENAMES)


@register("cast_columns", f"""{RAW_FHV}
SELECT dispatching_base_num, pickup_datetime, dropOff_datetime, CAST(PUlocationID AS BIGINT) AS PUlocationID,
       CAST(DOlocationID AS BIGINT) AS DOlocationID, SR_Flag, Affiliated_base_number FROM rf""")
def q_cast_columns(spark, d):
    return CF.cast_columns(fx.raw_service(spark, d, "forHireVehicle"),
                           {"PULocationID": "bigint", "DOLocationID": "bigint"}, safe=True)


@register("pad_missing_columns", f"""{RAW_FHV}
SELECT *, CAST(NULL AS VARCHAR) AS service_type, CAST(NULL AS BIGINT) AS id_location_pickup,
       CAST(NULL AS BIGINT) AS id_location_dropoff, CAST(NULL AS BIGINT) AS id_vendor,
       CAST(NULL AS BIGINT) AS id_payment_type, CAST(NULL AS BIGINT) AS id_rate, CAST(NULL AS BIGINT) AS trip_type,
       CAST(NULL AS DOUBLE) AS passenger_count, CAST(NULL AS DOUBLE) AS trip_distance,
       CAST(NULL AS DOUBLE) AS fare_amount, CAST(NULL AS DOUBLE) AS extra, CAST(NULL AS DOUBLE) AS mta_tax,
       CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS DOUBLE) AS tolls_amount, CAST(NULL AS DOUBLE) AS total_amount,
       CAST(NULL AS VARCHAR) AS id_license_number, CAST(NULL AS VARCHAR) AS id_hvfhs_license_num,
       {fx.new_fields_sql('forHireVehicle')}
FROM rf""")
def q_pad_missing_columns(spark, d):
    # dropOff_datetime already present (case-insensitive): not padded, not overwritten
    return CF.pad_missing_columns(fx.raw_service(spark, d, "forHireVehicle"), fixed.CONFORMED_TRIP_SCHEMA)


@register("tag_constant", "SELECT *, 'customer' AS source, 1 AS batch FROM customer")
def q_tag_constant(spark, d):
    return CF.tag_constant(RD.scan_parquet(spark, f"{d}/customer.parquet"), {"source": "customer", "batch": 1})


@register("lowercase_columns", f"SELECT LocationID AS locationid, Borough AS borough, Zone AS zone, service_zone FROM ({fx.ZONES_SQL})")
def q_lowercase_columns(spark, d):
    return CF.lowercase_columns(fx.zones(spark, d))


@register("project_alias", f"SELECT DISTINCT LocationID AS pk_location, Borough AS borough, Zone AS zone, service_zone FROM ({fx.ZONES_SQL})")
def q_project_alias(spark, d):
    return CF.project_alias(fx.zones(spark, d), ["LocationID AS pk_location", "Borough AS borough",
                                                   "Zone AS zone", "service_zone"]).distinct()


@register("select_reorder", f"{WT} SELECT total_amount, fare_amount, service_type, pickup_datetime FROM t")
def q_select_reorder(spark, d):
    return CF.select_reorder(T(spark, d), ["total_amount", "fare_amount", "service_type", "pickup_datetime"])


def conformed_all(spark, d, with_source=False):
    """All four raw-shaped services conformed and unioned.

    The trips view (a 5-table join) is written once to the shared folder and
    the four raw-shaped branches read it back, instead of each branch
    repeating the join."""
    staged = scratch(spark, "trips")
    W.write_table(fx.trips(spark, d, with_source), staged)
    t = spark.read.parquet(staged)
    parts = [CF.conform_service(fx.raw_from_trips(t, s, full=True), s, keep_extra=with_source) for s in fixed.SERVICE_TYPES]
    if with_source:
        keep = [f.name for f in fixed.CONFORMED_TRIP_SCHEMA.fields] + ["src_file", "src_row"]
        parts = [p.select(*keep) for p in parts]
    from farelake.operators.setops import union_by_name
    return union_by_name(parts)


CONFORMED_SQL = "\nUNION ALL\n".join([
    f"""SELECT '{s}' AS service_type, {p}_pickup_datetime AS pickup_datetime, {p}_dropoff_datetime AS dropoff_datetime,
      TRY_CAST(PULocationID AS BIGINT) AS id_location_pickup, TRY_CAST(DOLocationID AS BIGINT) AS id_location_dropoff,
      VendorID AS id_vendor, payment_type AS id_payment_type, TRY_CAST(RatecodeID AS BIGINT) AS id_rate,
      {fx.conformed_sql(s, 'trip_type')}, passenger_count, trip_distance, fare_amount, {fx.conformed_sql(s, 'extra')},
      {fx.conformed_sql(s, 'mta_tax')}, tip_amount, {fx.conformed_sql(s, 'tolls_amount')}, total_amount,
      CAST(NULL AS VARCHAR) AS id_license_number, CAST(NULL AS VARCHAR) AS id_hvfhs_license_num, {fx.new_fields_sql(s)}
    FROM ({fx.raw_service_sql(s, True)})""" for s, p in (("yellowTaxi", "tpep"), ("greenTaxi", "lpep"))
] + [
    f"""SELECT 'forHireVehicle' AS service_type, pickup_datetime, dropOff_datetime AS dropoff_datetime,
      TRY_CAST(PUlocationID AS BIGINT) AS id_location_pickup, TRY_CAST(DOlocationID AS BIGINT) AS id_location_dropoff,
      CAST(NULL AS BIGINT) AS id_vendor, CAST(NULL AS BIGINT) AS id_payment_type, CAST(NULL AS BIGINT) AS id_rate,
      CAST(NULL AS BIGINT) AS trip_type, CAST(NULL AS DOUBLE) AS passenger_count, CAST(NULL AS DOUBLE) AS trip_distance,
      CAST(NULL AS DOUBLE) AS fare_amount, CAST(NULL AS DOUBLE) AS extra, CAST(NULL AS DOUBLE) AS mta_tax,
      CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS DOUBLE) AS tolls_amount, CAST(NULL AS DOUBLE) AS total_amount,
      Affiliated_base_number AS id_license_number, CAST(NULL AS VARCHAR) AS id_hvfhs_license_num, {fx.new_fields_sql('forHireVehicle')}
    FROM ({fx.raw_service_sql('forHireVehicle', True)})""",
    f"""SELECT 'highVolumeForHire' AS service_type, pickup_datetime, dropoff_datetime,
      TRY_CAST(PULocationID AS BIGINT) AS id_location_pickup, TRY_CAST(DOLocationID AS BIGINT) AS id_location_dropoff,
      CAST(NULL AS BIGINT) AS id_vendor, CAST(NULL AS BIGINT) AS id_payment_type, CAST(NULL AS BIGINT) AS id_rate,
      CAST(NULL AS BIGINT) AS trip_type, CAST(NULL AS DOUBLE) AS passenger_count, CAST(NULL AS DOUBLE) AS trip_distance,
      CAST(NULL AS DOUBLE) AS fare_amount, CAST(NULL AS DOUBLE) AS extra, CAST(NULL AS DOUBLE) AS mta_tax,
      CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS DOUBLE) AS tolls_amount, CAST(NULL AS DOUBLE) AS total_amount,
      CAST(NULL AS VARCHAR) AS id_license_number, hvfhs_license_num AS id_hvfhs_license_num, {fx.new_fields_sql('highVolumeForHire')}
    FROM ({fx.raw_service_sql('highVolumeForHire', True)})""",
])


@register("conform_service", CONFORMED_SQL)
def q_conform_service(spark, d):
    return conformed_all(spark, d)


# ---- 2.11 scalar functions ----------------------------------------------------

@register("fn_year_month_hour", f"""{WE}
SELECT pickup_datetime, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
       CAST(hour(pickup_datetime) AS INTEGER) AS hour, CAST(day(pickup_datetime) AS INTEGER) AS day FROM e""")
def q_fn_ymh(spark, d):
    ts = "pickup_datetime"
    return E(spark, d).select(ts, C.year_of(ts).alias("year"), C.month_of(ts).alias("month"),
                              C.hour_of(ts).alias("hour"), C.day_of_month(ts).alias("day"))


@register("fn_day_name", f"{WE} SELECT pickup_datetime, dayname(pickup_datetime) AS day_name FROM e")
def q_fn_day_name(spark, d):
    return E(spark, d).select("pickup_datetime", C.day_name("pickup_datetime").alias("day_name"))


@register("fn_day_of_week", f"""{WE}
SELECT pickup_datetime, CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week,
       dayofweek(pickup_datetime) IN (0, 6) AS is_weekend FROM e""")
def q_fn_day_of_week(spark, d):
    ts = "pickup_datetime"
    return E(spark, d).select(ts, C.day_of_week(ts).alias("day_of_week"), C.is_weekend(ts).alias("is_weekend"))


@register("fn_is_weekend", f"{WE} SELECT CAST(pickup_datetime AS DATE) AS date, dayofweek(pickup_datetime) IN (0, 6) AS is_weekend FROM e")
def q_fn_is_weekend(spark, d):
    return E(spark, d).select(C.to_date("pickup_datetime").alias("date"), C.is_weekend("pickup_datetime").alias("is_weekend"))


@register("fn_to_date", f"{WE} SELECT pickup_datetime, CAST(pickup_datetime AS DATE) AS date FROM e")
def q_fn_to_date(spark, d):
    return E(spark, d).select("pickup_datetime", C.to_date("pickup_datetime").alias("date"))


@register("fn_date_key", f"""{WT}
SELECT pickup_datetime, CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(strftime(dropoff_datetime, '%d%m%Y') AS INTEGER) AS time_key FROM t""")
def q_fn_date_key(spark, d):
    return T(spark, d).select("pickup_datetime", C.date_key("pickup_datetime").alias("date_key"),
                              C.date_key("dropoff_datetime", "ddMMyyyy").alias("time_key"))


@register("fn_duration_minutes", f"{WT} SELECT pickup_datetime, dropoff_datetime, {DUR()} AS duration_min FROM t")
def q_fn_duration(spark, d):
    return T(spark, d).select("pickup_datetime", "dropoff_datetime",
                              C.duration_minutes("pickup_datetime", "dropoff_datetime").alias("duration_min"))


@register("fn_duration_floor0", f"""{WT}
SELECT pickup_datetime, dropoff_datetime, CASE WHEN {DUR()} < 0 THEN 0.0 ELSE {DUR()} END AS travel_min FROM t""")
def q_fn_floor0(spark, d):
    return T(spark, d).select("pickup_datetime", "dropoff_datetime",
                              C.duration_floor0("pickup_datetime", "dropoff_datetime").alias("travel_min"))


@register("fn_wait_minutes", f"""{WT}
SELECT pickup_datetime AS request_datetime, dropoff_datetime AS pickup_datetime,
       CASE WHEN {DUR()} < 0 THEN 0.0 ELSE {DUR()} END AS wait_min FROM t""")
def q_fn_wait(spark, d):
    t = T(spark, d).select(F.col("pickup_datetime").alias("request_datetime"),
                           F.col("dropoff_datetime").alias("pickup_datetime"))
    return t.select("*", C.wait_minutes("request_datetime", "pickup_datetime").alias("wait_min"))


@register("fn_season_north", f"""{WT}
SELECT pickup_datetime, {SEASON_NORTH('month(pickup_datetime)')} AS season FROM t""")
def q_fn_season_north(spark, d):
    return T(spark, d).select("pickup_datetime", C.season_north(C.month_of("pickup_datetime")).alias("season"))


@register("fn_season_index", f"""{WT}
SELECT pickup_datetime, CAST((month(pickup_datetime) % 12) // 3 + 1 AS INTEGER) AS season_index,
  {SEASON_PT('month(pickup_datetime)')} AS season FROM t""")
def q_fn_season_index(spark, d):
    m = C.month_of("pickup_datetime")
    return T(spark, d).select("pickup_datetime", C.season_index(m).alias("season_index"),
                              C.season_label(m).alias("season"))


@register("fn_miles_to_km", f"""{WT}
SELECT trip_distance, trip_distance * 1.60934 AS trip_distance_km,
       {R('trip_distance * 1.609', 2)} AS trip_distance_km_profile FROM t""")
def q_fn_km(spark, d):
    return T(spark, d).select("trip_distance", C.miles_to_km("trip_distance").alias("trip_distance_km"),
                              C.miles_to_km("trip_distance", fixed.MILES_TO_KM_PROFILE, 2).alias("trip_distance_km_profile"))


@register("fn_revenue_per_hour", f"""{WT}
SELECT total_amount, {DUR()} AS duration_min,
       CASE WHEN {DUR()} / CAST(60 AS DOUBLE) = 0 THEN NULL ELSE total_amount / ({DUR()} / CAST(60 AS DOUBLE)) END AS revenue_hour
FROM t""")
def q_fn_rph(spark, d):
    t = T(spark, d).select("total_amount", C.duration_minutes("pickup_datetime", "dropoff_datetime").alias("duration_min"))
    return t.select("*", C.revenue_per_hour("total_amount", "duration_min").alias("revenue_hour"))


def _label_sql(col: str, labels: dict, default: str) -> str:
    whens = " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in labels.items())
    return f"CASE {whens} ELSE '{default}' END"


@register("fn_code_label", f"""{WT}
SELECT id_vendor, {_label_sql('id_vendor', fixed.VENDOR_LABELS, fixed.VENDOR_DEFAULT)} AS vendor_description,
       id_payment_type, {_label_sql('id_payment_type', fixed.PAYMENT_LABELS, fixed.PAYMENT_DEFAULT)} AS payment_type_description,
       id_rate, {_label_sql('id_rate', fixed.RATE_LABELS, fixed.RATE_DEFAULT)} AS ratecode_description
FROM t""")
def q_fn_code_label(spark, d):
    return T(spark, d).select(
        "id_vendor", C.code_label("id_vendor", fixed.VENDOR_LABELS, fixed.VENDOR_DEFAULT).alias("vendor_description"),
        "id_payment_type", C.code_label("id_payment_type", fixed.PAYMENT_LABELS, fixed.PAYMENT_DEFAULT).alias("payment_type_description"),
        "id_rate", C.code_label("id_rate", fixed.RATE_LABELS, fixed.RATE_DEFAULT).alias("ratecode_description"))


def _map_sql(col: str, mapping: dict) -> str:
    def q(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN {col} = {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {whens} END"


@register("fn_translate_label", f"""{WE}
SELECT pickup_datetime, {_map_sql('dayname(pickup_datetime)', fixed.WEEKDAY_PT)} AS dia_semana,
       {_map_sql('month(pickup_datetime)', fixed.MONTH_ABBR_PT)} AS mes FROM e""")
def q_fn_translate(spark, d):
    ts = "pickup_datetime"
    return E(spark, d).select(ts, C.translate_label(C.day_name(ts), fixed.WEEKDAY_PT).alias("dia_semana"),
                              C.month_abbr(C.month_of(ts)).alias("mes"))


@register("fn_upper_lower_trim", """
SELECT c_name, upper(c_name) AS upper_name, lower(c_mktsegment) AS lower_segment,
       trim(lower(' ' || c_mktsegment || ' ')) AS norm_segment FROM customer""")
def q_fn_ult(spark, d):
    c = RD.scan_parquet(spark, f"{d}/customer.parquet")
    return c.select("c_name", C.upper_text("c_name").alias("upper_name"), C.lower_text("c_mktsegment").alias("lower_segment"),
                    C.normalize_id(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" "))).alias("norm_segment"))


@register("fn_concat_ws", "SELECT c_custkey, concat_ws(';', c_name, c_mktsegment) AS label FROM customer")
def q_fn_concat(spark, d):
    c = RD.scan_parquet(spark, f"{d}/customer.parquet")
    return c.select("c_custkey", C.join_text(";", "c_name", "c_mktsegment").alias("label"))


@register("fn_round", f"{WT} SELECT tip_amount, {R('tip_amount', 2)} AS tip_rounded, {R('total_amount', 1)} AS total_rounded FROM t")
def q_fn_round(spark, d):
    return T(spark, d).select("tip_amount", C.round_to("tip_amount", 2).alias("tip_rounded"),
                              C.round_to("total_amount", 1).alias("total_rounded"))


@register("fn_conditional", f"{WT} SELECT trip_distance, CASE WHEN trip_distance < 0 THEN 0.0 ELSE trip_distance END AS distance_floor0 FROM t")
def q_fn_conditional(spark, d):
    return T(spark, d).select("trip_distance", C.conditional(F.col("trip_distance") < 0, 0.0, F.col("trip_distance"))
                              .alias("distance_floor0"))


@register("passthrough_copy", "SELECT *, 1996 AS year, 7 AS month FROM orders")
def q_passthrough_copy(spark, d):
    dst = scratch(spark, "passthrough")
    W.passthrough_copy(spark, f"{d}/orders.parquet", dst, 1996, 7)
    return RD.scan_partitioned(spark, dst)


@register("is_empty", f"""{WT}
SELECT count(*) = 0 AS is_empty FROM (SELECT 1 FROM t WHERE total_amount < 0 LIMIT 1)""")
def q_is_empty(spark, d):
    return RD.is_empty_frame(T(spark, d).where(F.col("total_amount") < 0))


PAY_ROWS = ", ".join(f"({k}, '{v}')" for k, v in fixed.TRUSTED_PAYMENT_TYPES)


@register("inline_table", f"""{WT},
pay AS (SELECT * FROM (VALUES {PAY_ROWS}) v(payment_type, payment_type_description))
SELECT c.payment_type, pay.payment_type_description
FROM (SELECT DISTINCT CAST(id_payment_type AS INTEGER) AS payment_type FROM t) c
LEFT JOIN pay ON c.payment_type = pay.payment_type""")
def q_inline_table(spark, d):
    pay = RD.inline_table(spark, fixed.TRUSTED_PAYMENT_TYPES, fixed.PAYMENT_SCHEMA)
    codes = T(spark, d).select(F.col("id_payment_type").cast("int").alias("payment_type")).distinct()
    return codes.join(F.broadcast(pay), "payment_type", "left")
