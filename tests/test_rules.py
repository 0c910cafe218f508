"""Cleaning rules, conforming and functions on tiny literal frames (edge cases)."""

import datetime as dt

from pyspark.sql import functions as F

from farelake import fixed
from farelake.functions import columns as C
from farelake.operators import aggregates as A
from farelake.operators import conform as CF
from farelake.operators import quality as Q
from farelake.operators import setops as S
from farelake.operators import topk as K

T0 = dt.datetime(2024, 1, 7, 0, 30)      # a Sunday, hour 0
T1 = dt.datetime(2024, 1, 7, 1, 0)

YELLOW = ("VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
          "passenger_count double, trip_distance double, PULocationID int, DOLocationID int, payment_type long, "
          "total_amount double")


def yellow(spark, rows):
    return spark.createDataFrame(rows, YELLOW)


def test_passenger_fix_keeps_null(spark):
    df = yellow(spark, [(1, T0, T1, None, 1.0, 1, 1, 1, 5.0), (1, T0, T1, 0.0, 1.0, 1, 1, 1, 5.0),
                        (1, T0, T1, -2.0, 1.0, 1, 1, 1, 5.0), (1, T0, T1, 3.0, 1.0, 1, 1, 1, 5.0)])
    got = [r[0] for r in Q.fix_passenger_count(df).orderBy("passenger_count").select("passenger_count").collect()]
    assert got == [None, 1.0, 1.0, 3.0]


def test_location_flag_is_null_aware_and_has_no_leading_separator(spark):
    df = yellow(spark, [(1, T0, T1, 1.0, 1.0, 0, 5, 1, 5.0), (1, T0, T1, 1.0, 1.0, -1, 5, 1, 5.0),
                        (1, T0, T1, 1.0, 1.0, None, 5, 1, 5.0), (1, T0, T1, 1.0, 1.0, 3, 5, 1, 5.0)])
    rows = Q.flag_invalid_location(df).select("PULocationID", "has_problem", "problem_description").collect()
    by = {r[0]: (r[1], r[2]) for r in rows}
    assert by[0] == (True, fixed.INVALID_LOCATION_REASON)
    assert by[-1] == (True, fixed.INVALID_LOCATION_REASON)
    assert by[None] == (False, None)
    assert by[3] == (False, None)


def test_flag_appends_to_existing_reason(spark):
    df = yellow(spark, [(1, T0, T1, 1.0, 1.0, 0, 5, 1, 5.0)]).withColumns(
        {"has_problem": F.lit(True), "problem_description": F.lit("earlier")})
    r = Q.flag_invalid_location(df).first()
    assert r["problem_description"] == "earlier;" + fixed.INVALID_LOCATION_REASON


def test_clean_yellow_filters_and_payment_labels(spark):
    later = T0 - dt.timedelta(minutes=5)
    df = yellow(spark, [
        (1, T0, T1, 1.0, 0.0, 1, 1, 1, 5.0),       # distance 0 -> dropped
        (1, T0, T0, 1.0, 2.0, 1, 1, 1, 5.0),       # equal timestamps -> dropped
        (1, T0, later, 1.0, 2.0, 1, 1, 1, 5.0),    # drop-off before pickup -> dropped
        (1, None, T1, 1.0, 2.0, 1, 1, 1, 5.0),     # null pickup -> dropped
        (1, T0, T1, 1.0, 2.0, 1, 1, 0, 5.0),       # payment 0 -> no description
        (1, T0, T1, 1.0, 2.0, 1, 1, 6, 5.0),
        (1, T0, T1, 1.0, 2.0, 1, 1, 99, 5.0),
        (1, T0, T1, 1.0, 2.0, 1, 1, None, 5.0),
    ])
    out = Q.clean_yellow_green(df, "yellowTaxi")
    assert set(out.columns) >= {"pickup_datetime", "dropoff_datetime", "trip_distance_km",
                                "payment_type_description", "has_problem"}
    got = {r["payment_type"]: r["payment_type_description"] for r in out.collect()}
    assert got == {0: None, 6: "Voided trip", 99: None, None: None}


def test_fhv_profiles(spark):
    df = spark.createDataFrame([(T0, T1, 1.0, None, None), (T0, T1, None, 2.0, 1)],
                               "pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz, "
                               "PUlocationID double, DOlocationID double, SR_Flag int")
    cur = Q.clean_fhv(df, "current").orderBy("PUlocationID").collect()
    assert [r["SR_Flag"] for r in cur] == [1, 0]
    assert Q.clean_fhv(df, "strict").count() == 0


def test_conform_is_case_insensitive_and_does_not_overwrite(spark):
    df = spark.createDataFrame([(T0, T1, 3.0, 4.0, 7.5, "B1")],
                               "pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz, "
                               "PUlocationID double, DOlocationID double, Airport_fee double, Affiliated_base_number string")
    out = CF.conform_service(df, "forHireVehicle", keep_extra=True).first()
    assert out["dropoff_datetime"] == T1
    assert out["id_location_pickup"] == 3 and out["id_location_dropoff"] == 4
    assert out["id_license_number"] == "B1"
    assert out["airport_fee"] == 7.5           # the raw Airport_fee, not a padded null
    padded = CF.pad_missing_columns(df, fixed.CONFORMED_TRIP_SCHEMA)
    assert "airport_fee" not in [c for c in padded.columns if c != "Airport_fee"]


def test_safe_cast_of_dirty_codes(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "RatecodeID string")
    got = [r[0] for r in CF.cast_columns(df, {"RatecodeID": "bigint"}, safe=True).collect()]
    assert got == [1, None, None]


def test_hour_zero_is_a_filter_value(spark):
    df = spark.createDataFrame([(0,), (1,), (0,)], "hour int")
    assert Q.filter_optional(df, {"hour": 0, "month": None}).count() == 2
    assert Q.filter_optional(df, {"hour": None}).count() == 3


def test_weekday_translated_once_and_densified(spark):
    df = spark.createDataFrame([(T0,), (T1,)], "pickup_datetime timestamp_ntz")
    rows = {r["weekday"]: r["trips"] for r in A.count_by_weekday(df).collect()}
    assert rows["Domingo"] == 2
    assert len(rows) == 7 and sum(rows.values()) == 2


def test_season_and_functions(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)] + [(None,)], "m int")
    out = df.select("m", C.season_index("m").alias("i"), C.season_label("m").alias("pt"),
                    C.season_north("m").alias("n")).collect()
    by = {r["m"]: (r["i"], r["pt"], r["n"]) for r in out}
    assert by[12] == (1, "Verão", "Winter") and by[1][0] == 1 and by[3] == (2, "Outono", "Spring")
    assert by[6][2] == "Summer" and by[9] == (4, "Primavera", "Fall")
    assert by[None] == (None, None, None)


def test_duration_and_revenue_per_hour(spark):
    df = spark.createDataFrame([(T0, T1, 10.0), (T0, T0, 10.0)], "a timestamp_ntz, b timestamp_ntz, total double")
    r = df.select(C.duration_minutes("a", "b").alias("m")).collect()
    assert [x[0] for x in r] == [30.0, 0.0]
    rh = df.select(C.revenue_per_hour("total", C.duration_minutes("a", "b")).alias("r")).collect()
    assert rh[0][0] == 20.0 and rh[1][0] is None


def test_date_keys(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),)], "t timestamp_ntz")
    r = df.select(C.date_key("t").alias("a"), C.date_key("t", "ddMMyyyy").alias("b")).first()
    assert (r["a"], r["b"]) == (20240101, 1012024)


def test_code_labels_default(spark):
    df = spark.createDataFrame([(0,), (6,), (99,), (None,)], "c long")
    got = {r[0]: r[1] for r in df.select("c", C.code_label("c", fixed.PAYMENT_LABELS, fixed.PAYMENT_DEFAULT)).collect()}
    assert got == {0: "Flex Fare trip", 6: "Voided trip", 99: "Other", None: "Other"}


def test_empty_input_and_densify(spark):
    empty = spark.createDataFrame([], "service_type string, trips long")
    out = S.densify_domain(empty, fixed.SERVICE_TYPES, "service_type", 0)
    assert sorted(r["trips"] for r in out.collect()) == [0, 0, 0, 0]
    assert K.top_k_counts(spark.createDataFrame([], "z string"), "z").count() == 0


def test_distinct_by_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "k int, s string, v int")
    got = sorted(tuple(r) for r in A.distinct_by_key(df, ["k"]).collect())
    assert got == [(1, "a", 9), (2, "c", 1)]


def test_except_distinct_and_all_with_nulls_and_many_copies(spark):
    b = spark.createDataFrame([(1, None)] * 25 + [(2, "x")] * 3 + [(3, "y")], "a int, s string")
    a = spark.createDataFrame([(1, None)] * 4 + [(2, "x")] * 5, "a int, s string")
    assert [tuple(r) for r in S.rows_removed(b, a).collect()] == [(3, "y")]
    counts = {r["a"]: r["count"] for r in S.rows_removed(b, a, distinct=False, chunk=7).groupBy("a").count().collect()}
    assert counts == {1: 21, 3: 1}


def test_static_dimensions(spark):
    from farelake.operators import dims as D
    assert [tuple(r) for r in D.dim_trip_type(spark).orderBy("trip_type_id").collect()] == list(fixed.STATIC_TRIP_TYPES)
    assert D.dim_ratecode_static(spark).count() == len(fixed.STATIC_RATECODES)
