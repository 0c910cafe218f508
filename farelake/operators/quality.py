"""Filters, cleaning rules and quality flags of the trusted layer.

Filters are plain predicates, so Catalyst pushes them into the Parquet scan;
the year filter is written as half-open timestamp ranges (not ``year(ts)``)
for the same reason.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.operators.conform import find_column


def _all(preds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, list(preds))


def filter_positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every column is > 0 (null is dropped)."""
    return df.filter(_all(F.col(c) > 0 for c in cols))


def filter_nonnegative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(_all(F.col(c) >= 0 for c in cols))


def filter_time_order(df: DataFrame, start: str = "pickup_datetime", end: str = "dropoff_datetime") -> DataFrame:
    """Keep trips whose drop-off is after the pickup."""
    return df.filter(F.col(end) > F.col(start))


def filter_positive_duration(df: DataFrame, minutes: str = "duration") -> DataFrame:
    return df.filter(F.col(minutes) > 0)


def filter_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(_all(F.col(c).isNotNull() for c in cols))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def year_range_predicate(df: DataFrame, ts: str, years: Iterable[int]) -> Column:
    """``year(ts) IN years`` as OR of ``[Jan 1, next Jan 1)`` ranges (pushable)."""
    dtype = df.schema[ts].dataType
    preds = []
    for y in sorted({int(y) for y in years}):
        lo = F.lit(_dt.datetime(y, 1, 1).strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)
        hi = F.lit(_dt.datetime(y + 1, 1, 1).strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)
        preds.append((F.col(ts) >= lo) & (F.col(ts) < hi))
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def filter_year_in(df: DataFrame, ts: str, years: Iterable[int]) -> DataFrame:
    return df.filter(year_range_predicate(df, ts, years))


def filter_optional(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """Equality filters applied only when the value is not None (hour 0 is a
    real filter value)."""
    preds = [F.col(c) == F.lit(v) for c, v in filters.items() if v is not None]
    return df.filter(_all(preds)) if preds else df


def filter_in_set(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def filter_flagged(df: DataFrame) -> DataFrame:
    """Rows flagged ``has_problem``; empty frame if the column is absent."""
    if find_column(df, "has_problem") is None:
        return df.limit(0)
    return df.filter(F.col("has_problem"))


def fix_passenger_count(df: DataFrame, col: str = "passenger_count") -> DataFrame:
    """``<= 0`` -> 1; null stays null."""
    c = F.col(col)
    return df.withColumn(col, F.when(c <= 0, F.lit(1).cast(df.schema[col].dataType)).otherwise(c))


def fill_null_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    present = {find_column(df, k): v for k, v in defaults.items() if find_column(df, k)}
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v).cast(df.schema[k].dataType))
                           for k, v in present.items()})


def flag_invalid_location(df: DataFrame, pickup: str = "PULocationID", dropoff: str = "DOLocationID",
                          reason: str = fixed.INVALID_LOCATION_REASON) -> DataFrame:
    """Set ``has_problem`` and append ``reason`` when either location id is <= 0.

    Null ids are not flagged. Reasons are joined by ';' without a leading
    separator; an existing flag/description is kept.
    """
    bad = F.coalesce((F.col(pickup) <= 0) | (F.col(dropoff) <= 0), F.lit(False))
    has_prev = "has_problem" in df.columns
    desc_prev = "problem_description" in df.columns
    prev_flag = F.coalesce(F.col("has_problem"), F.lit(False)) if has_prev else F.lit(False)
    prev_desc = F.nullif(F.col("problem_description"), F.lit("")) if desc_prev else F.lit(None).cast("string")
    new_desc = F.when(bad, F.concat_ws(";", prev_desc, F.lit(reason))).otherwise(prev_desc)
    return df.withColumns({"has_problem": prev_flag | bad, "problem_description": new_desc})


def with_quality_columns(df: DataFrame) -> DataFrame:
    """Every cleaned service carries ``has_problem`` (false) and
    ``problem_description`` (null) unless a rule already set them."""
    add = {}
    if find_column(df, "has_problem") is None:
        add["has_problem"] = F.lit(False)
    if find_column(df, "problem_description") is None:
        add["problem_description"] = F.lit(None).cast("string")
    return df.withColumns(add) if add else df


def normalize_text(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, C.normalize_id(col))



def payment_table(spark):
    from farelake.sources.readers import inline_table
    return inline_table(spark, fixed.TRUSTED_PAYMENT_TYPES, fixed.PAYMENT_SCHEMA)


def clean_yellow_green(df: DataFrame, service: str, payment_dim: DataFrame | None = None,
                       km_factor: float = fixed.MILES_TO_KM) -> DataFrame:
    """Trusted-layer rule profile for yellow and green taxis.

    passenger fix -> distance > 0 and drop-off > pickup -> location flag ->
    integer payment code + description (broadcast of the 6-row literal table)
    -> distance in km -> common pickup/drop-off names.
    """
    prefix = "tpep" if service == "yellowTaxi" else "lpep"
    pickup = find_column(df, f"{prefix}_pickup_datetime")
    dropoff = find_column(df, f"{prefix}_dropoff_datetime")
    pu = find_column(df, "PULocationID")
    do = find_column(df, "DOLocationID")
    out = fix_passenger_count(df, find_column(df, "passenger_count"))
    out = out.filter((F.col(find_column(df, "trip_distance")) > 0) & (F.col(dropoff) > F.col(pickup)))
    out = flag_invalid_location(out, pu, do)
    pay = find_column(out, "payment_type")
    out = out.withColumn(pay, F.col(pay).try_cast("int"))
    dim = payment_dim if payment_dim is not None else payment_table(df.sparkSession)
    # 6 literal rows: the size bound is the table itself, so broadcasting is safe.
    out = out.join(F.broadcast(dim.withColumnRenamed("payment_type", pay)), on=pay, how="left")
    out = out.withColumn("trip_distance_km", F.col(find_column(df, "trip_distance")) * F.lit(km_factor))
    return out.withColumnsRenamed({pickup: "pickup_datetime", dropoff: "dropoff_datetime"})


def clean_fhv(df: DataFrame, profile: str = "current") -> DataFrame:
    """For-hire profile: ``current`` fills null SR_Flag with 0; ``strict`` drops
    rows with a null pickup or drop-off location."""
    if profile == "strict":
        return with_quality_columns(
            filter_not_null(df, [find_column(df, "PUlocationID"), find_column(df, "DOlocationID")]))
    sr = find_column(df, "SR_Flag")
    if sr is not None:
        df = df.withColumn(sr, F.coalesce(F.col(sr), F.lit(0).cast(df.schema[sr].dataType)))
    return with_quality_columns(df)


def clean_high_volume(df: DataFrame, km_factor: float = fixed.MILES_TO_KM) -> DataFrame:
    """High-volume profile: km column, miles > 0, trip_time > 0, drop-off > pickup."""
    miles = find_column(df, "trip_miles")
    out = with_quality_columns(df.withColumn("trip_miles_km", F.col(miles) * F.lit(km_factor)))
    return out.filter((F.col(miles) > 0) & (F.col(find_column(df, "trip_time")) > 0)
                      & (F.col(find_column(df, "dropoff_datetime")) > F.col(find_column(df, "pickup_datetime"))))


def apply_cleaning(df: DataFrame, service: str, *, fhv_profile: str = "current",
                   payment_dim: DataFrame | None = None) -> DataFrame:
    """Dispatch to the rule profile of ``service``; unknown services pass through."""
    if service in ("yellowTaxi", "greenTaxi"):
        return clean_yellow_green(df, service, payment_dim)
    if service == "forHireVehicle":
        return clean_fhv(df, fhv_profile)
    if service == "highVolumeForHire":
        return clean_high_volume(df)
    return df
