"""Queries do their whole work, and do it once."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.plans import q_warehouse as QW


def test_wide_fact_counts_the_rows_of_each_key(spark, monkeypatch):
    from farelake import fixed
    at = dt.datetime(2024, 1, 5, 8)
    one = {"service_type": "yellowTaxi", "pickup_datetime": at, "dropoff_datetime": at + dt.timedelta(minutes=9)}
    rows = [(*[one.get(f.name) for f in fixed.CONFORMED_TRIP_SCHEMA.fields], file, row) for file, row in (("a", 1), ("a", 1), ("a", 2), ("b", 1))]
    source = [T.StructField("src_file", T.StringType()), T.StructField("src_row", T.LongType())]
    trips = spark.createDataFrame(rows, T.StructType(fixed.CONFORMED_TRIP_SCHEMA.fields + source))
    monkeypatch.setattr(QW, "conformed_all", lambda *a, **k: trips)
    got = QW.q_fact_trip_wide(spark, "")
    assert sorted(r.rows_of_key for r in got.collect()) == [1, 1, 2, 2]
    assert got.where(F.col("has_key")).count() == 4


def test_few_output_files_leave_the_join_its_tasks(spark):
    from farelake.sinks.writers import limit_output_files
    a = spark.range(0, 2000, 1, 6).withColumn("x", F.col("id") % 7).hint("merge")
    joined = a.join(spark.range(0, 3000, 1, 6), "id")
    few = limit_output_files(joined, 2)
    assert few.rdd.getNumPartitions() <= 2
    assert sorted(few.collect()) == sorted(joined.collect())
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 2, true" in plan        # a shuffle of its own, above the join


def _counted(spark):
    """100 rows, and how often one of them was computed."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(100).selectExpr("cast(id % 2 as string) g", "id * 1.0D x", "id * 2.0D y")
    return df.mapInArrow(count, df.schema), seen


def test_passes_read_their_input_once(spark):
    from farelake.operators import stats as ST
    for work in (lambda df: ST.trim_outliers(df, "x", 0.1, 0.9), lambda df: ST.box_stats(df, "x", ["g"]), lambda df: ST.box_stats(df, "x"),
                 lambda df: ST.describe_numeric(df, ["x", "y"]), lambda df: ST.percentile_exact(df, "x", [0.5], ["g"])):
        df, seen = _counted(spark)
        assert work(df).collect()
        assert seen.value == 100
    df, seen = _counted(spark)
    assert [r.x for r in ST.trim_outliers(df, "x", 0.1, 0.9).orderBy("x").collect()] == [float(i) for i in range(10, 90)]


def test_fares_screen_reads_the_trips_once(spark):
    from farelake.plans import screens as SC
    df, seen = _counted(spark)
    trips = df.selectExpr("g service_type", "timestamp'2024-03-01 08:00:00' pickup_datetime", "timestamp'2024-03-01 09:00:00' dropoff_datetime",
                          "x + 1 fare_amount", "y tip_amount", "x trip_distance")
    frames = SC.screen_fares(trips, service="1")
    assert {n: f.count() for n, f in frames.items()} == {"fare": 1, "tip": 1, "trend_duration": 1, "box_by_service": 1, "trend_distance": 1}
    assert frames["tip"].first().mean_tip == 100.0 and frames["box_by_service"].first().n == 50
    assert seen.value == 100


def test_trips_join_customers_to_orders_first(spark):
    from farelake.plans import fixtures as fx
    plan = fx.trips(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    depth = lambda s: next(len(x) - len(x.lstrip(" :+-")) for x in plan.splitlines() if s in x)
    assert depth("Join Inner, (o_custkey") > depth("Join Inner, (l_orderkey")
