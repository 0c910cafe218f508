"""Trip fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.operators.conform import pad_missing_columns
from farelake.operators.joins import join_dim_keys
from farelake.operators.keys import trip_key


def fact_trip(trips: DataFrame, vendor: DataFrame, payment: DataFrame, rate: DataFrame,
              service: DataFrame, companies: DataFrame | None = None,
              licences: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
    """Conformed trips -> fact with dimension keys, int date keys and the
    ``year``/``month`` partition columns: the period of the file where the trips
    carry it, else that of the pickup.

    Keeps the service text (``service_type``) next to the real surrogate key
    ``fk_service_type``. ``sk_trip`` comes from the raw row identity
    (``src_file``/``src_row``) when the trips carry it, numbered by ``files``
    (the registry of the warehouse) where that is given.
    """
    df = pad_missing_columns(trips, fixed.CONFORMED_TRIP_SCHEMA)
    df = join_dim_keys(df, vendor, "id_vendor", "sk_vendor", "fk_vendor")
    df = join_dim_keys(df, payment, "id_payment_type", "sk_payment_type", "fk_payment_type")
    df = join_dim_keys(df, rate, "id_rate", "sk_ratecode", "fk_ratecode")
    df = join_dim_keys(df, service, "id_service_type", "sk_service_type", "fk_service_type",
                       fact_natural="service_type")
    if companies is not None:
        df = join_dim_keys(df, companies, "id_hvfhs_license_num", "sk_company_hv", "fk_company_hv")
    else:
        df = df.withColumn("fk_company_hv", F.lit(None).cast("bigint"))
    if licences is not None:
        df = join_dim_keys(df, licences, "id_license_number", "sk_license_number", "fk_license_number")
    else:
        df = df.withColumn("fk_license_number", F.lit(None).cast("bigint"))
    if "src_file" in df.columns and "src_row" in df.columns:
        df = trip_key(df, files=files)
    else:
        df = df.withColumn("sk_trip", F.lit(None).cast("bigint"))
    df = df.withColumns({
        "pickup_date": C.date_key("pickup_datetime"),
        "dropoff_date": C.date_key("dropoff_datetime"),
    })
    if "year" not in df.columns or "month" not in df.columns:
        df = df.withColumns({"year": C.year_of("pickup_datetime"), "month": C.month_of("pickup_datetime")})
    return df.select(*fixed.FACT_COLUMNS)


def fact_trip_wide(trips: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``sk_trip``, the conformed columns, the quality flags, duration, dates,
    weekday, hour, ``fk_time`` (ddMMyyyy of the drop-off), year and month.

    ``sk_trip`` is made of the raw row identity (``src_file``/``src_row``,
    numbered by ``files`` where given), null where the trips don't carry it.
    Flags a layer lacks are null; year and month are those of the trips' file
    where they carry them, else of the pickup.
    """
    df = pad_missing_columns(trips, fixed.CONFORMED_TRIP_SCHEMA)
    if "src_file" in df.columns and "src_row" in df.columns:
        df = trip_key(df, files=files)
    ts = "pickup_datetime"
    period = {"year": C.year_of(ts), "month": C.month_of(ts)}
    absent = {"sk_trip": F.lit(None).cast("bigint"), "has_problem": F.lit(None).cast("boolean"),
              "problem_description": F.lit(None).cast("string"), **period}
    df = df.withColumns({name: value for name, value in absent.items() if name not in df.columns})
    return df.select(
        "sk_trip", *[f.name for f in fixed.CONFORMED_TRIP_SCHEMA.fields], "has_problem", "problem_description",
        C.duration_minutes(ts, "dropoff_datetime").alias("trip_duration_minutes"),
        C.to_date(ts).alias("pickup_date"),
        C.to_date("dropoff_datetime").alias("dropoff_date"),
        C.day_name(ts).alias("weekday"),
        C.hour_of(ts).alias("hour"),
        C.date_key("dropoff_datetime", "ddMMyyyy").alias("fk_time"),
        "year", "month",
    )
