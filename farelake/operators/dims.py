"""Warehouse dimensions.

Data-derived dimensions (vendor, payment, rate, service) are the distinct
non-null codes seen in the trips: a partial-aggregated ``distinct``, then a
label and a dense surrogate key in natural-key order (same keys on every run).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.operators.conform import find_column, lowercase_columns, rename_columns
from farelake.operators.keys import dense_index
from farelake.sources.readers import calendar_range, inline_table


def _coded_dim(trips: DataFrame, code: str, sk: str, label_col: str, labels, default) -> DataFrame:
    codes = trips.select(F.col(code).cast("bigint").alias(code)).where(F.col(code).isNotNull()).distinct()
    codes = codes.withColumn(label_col, C.code_label(code, labels, default))
    return dense_index(codes, [code], sk).select(sk, code, label_col)


def dim_vendor(trips: DataFrame, code: str = "id_vendor") -> DataFrame:
    return _coded_dim(trips, code, "sk_vendor", "vendor_description", fixed.VENDOR_LABELS, fixed.VENDOR_DEFAULT)


def dim_payment_type(trips: DataFrame, code: str = "id_payment_type") -> DataFrame:
    return _coded_dim(trips, code, "sk_payment_type", "payment_type_description",
                      fixed.PAYMENT_LABELS, fixed.PAYMENT_DEFAULT)


def dim_rate(trips: DataFrame, code: str = "id_rate") -> DataFrame:
    return _coded_dim(trips, code, "sk_ratecode", "ratecode_description", fixed.RATE_LABELS, fixed.RATE_DEFAULT)


def dim_service_type(trips: DataFrame, col: str = "service_type") -> DataFrame:
    """Distinct services with description, category and regulator."""
    svc = trips.select(F.col(col).alias("id_service_type")).where(F.col("id_service_type").isNotNull()).distinct()
    desc = {k: v[0] for k, v in fixed.SERVICE_LABELS.items()}
    cat = {k: v[1] for k, v in fixed.SERVICE_LABELS.items()}
    reg = {k: v[2] for k, v in fixed.SERVICE_LABELS.items()}
    svc = svc.select("id_service_type",
                     C.code_label("id_service_type", desc, fixed.SERVICE_DEFAULT).alias("description"),
                     C.code_label("id_service_type", cat, fixed.SERVICE_DEFAULT).alias("category"),
                     C.code_label("id_service_type", reg, fixed.SERVICE_DEFAULT).alias("regulation_body"))
    return dense_index(svc, ["id_service_type"], "sk_service_type").select(
        "sk_service_type", "id_service_type", "description", "category", "regulation_body")


def dim_trip_type(spark: SparkSession) -> DataFrame:
    return inline_table(spark, fixed.STATIC_TRIP_TYPES, "trip_type_id bigint, description string")


def dim_ratecode_static(spark: SparkSession) -> DataFrame:
    return inline_table(spark, fixed.STATIC_RATECODES, "ratecode_id bigint, description string")


def dim_location(zones: DataFrame) -> DataFrame:
    """Zone lookup with lower-case names and a key in LocationID order
    (one row an id, the smallest of its rows, so that facts never multiply)."""
    z = lowercase_columns(zones).withColumnRenamed("locationid", "id_location")
    z = z.withColumn("id_location", F.col("id_location").try_cast("bigint"))
    z = z.groupBy("id_location").agg(F.min(F.struct("borough", "zone", "service_zone")).alias("r")).select("id_location", "r.*")
    return dense_index(z, ["id_location", "borough", "zone", "service_zone"], "sk_location").select(
        "sk_location", "id_location", "borough", "zone", "service_zone")


def _licence_dim(src: DataFrame, id_src: str, name_src: str, id_out: str, name_out: str, sk: str,
                 upper: bool) -> DataFrame:
    d = rename_columns(src.select(find_column(src, id_src), find_column(src, name_src)),
                       {id_src: id_out, name_src: name_out}).dropna().distinct()
    if upper:
        d = d.withColumn(name_out, F.upper(name_out))
    d = d.groupBy(id_out).agg(F.min(name_out).alias(name_out))  # one row an id
    return dense_index(d, [id_out, name_out], sk).select(sk, id_out, name_out)


def dim_companies_hv(companies: DataFrame, id_col: str = "High Volume",
                     name_col: str = "App Company Affiliation") -> DataFrame:
    """High-volume licence -> company (upper case)."""
    return _licence_dim(companies, id_col, name_col, "id_hvfhs_license_num", "app_company_affiliation",
                        "sk_company_hv", upper=True)


def dim_license_number(licences: DataFrame, id_col: str = "LICENSEE NUMBER",
                       name_col: str = "NAME OF LICENSEE NORMALIZED") -> DataFrame:
    """Base licence -> licensee name."""
    return _licence_dim(licences, id_col, name_col, "id_license_number", "app_company_affiliation",
                        "sk_license_number", upper=False)


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """Calendar: sk_date (yyyyMMdd), date, day, month, year, day_of_week, week_day."""
    d = calendar_range(spark, start, end, "date")
    return d.select(C.date_key("date").alias("sk_date"), "date", C.day_of_month("date").alias("day"),
                    C.month_of("date").alias("month"), C.year_of("date").alias("year"),
                    C.day_name("date").alias("day_of_week"), C.day_of_week("date").alias("week_day"))


def dim_time(trips: DataFrame, ts: str = "dropoff_datetime") -> DataFrame:
    """Days seen in the data: sk_time (ddMMyyyy), date (yyyyMMdd), weekday,
    month, year, season, is_weekend, is_holiday."""
    days = trips.select(C.to_date(ts).alias("d")).where(F.col("d").isNotNull()).distinct()
    return days.select(C.date_key("d", "ddMMyyyy").alias("sk_time"), C.date_key("d").alias("date"),
                       C.day_name("d").alias("weekday"), C.month_of("d").alias("month"),
                       C.year_of("d").alias("year"), C.season_north(C.month_of("d")).alias("season"),
                       C.is_weekend("d").alias("is_weekend"), F.lit(False).alias("is_holiday"))


def dim_date_between(trips: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime") -> DataFrame:
    """``dim_date`` over the span of the data (earliest start to latest end)."""
    from farelake.sources.readers import calendar_between
    d = calendar_between(trips, start, end, "date")
    return d.select(C.date_key("date").alias("sk_date"), "date", C.day_of_month("date").alias("day"),
                    C.month_of("date").alias("month"), C.year_of("date").alias("year"),
                    C.day_name("date").alias("day_of_week"), C.day_of_week("date").alias("week_day"))


def extend_dimension(existing: DataFrame | None, incoming: DataFrame, natural: str, sk: str) -> DataFrame:
    """Keep the keys already given and number only the new natural keys,
    after the current maximum: keys stay stable across monthly runs."""
    if existing is None:
        return dense_index(incoming, [natural], sk)
    new = incoming.join(existing.select(natural), natural, "left_anti")
    top = existing.agg(F.max(sk)).first()[0] or 0       # one scalar
    numbered = dense_index(new, [natural], sk, start=int(top) + 1)
    return existing.unionByName(numbered.select(*existing.columns))
