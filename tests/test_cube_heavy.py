"""The mergeable cube and the top keys of large domains."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from farelake import fixed
from farelake.operators import cube as CU
from farelake.operators import heavy as H
from farelake.operators import stats as ST
from farelake.operators.topk import top_k_counts
from farelake.plans import cube_screens as CS
from farelake.plans import screens as SC

SCHEMA = ("service_type string, pickup_datetime timestamp, dropoff_datetime timestamp, id_location_pickup bigint, "
          "id_location_dropoff bigint, trip_distance double, fare_amount double, tip_amount double, total_amount double")


def _trips(spark, n=400, seed=5, years=(2023, 2024)):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        at = datetime(r.choice(years), r.randint(1, 12), r.randint(1, 28), r.randint(0, 23), r.randint(0, 59))
        rows.append((r.choice([*fixed.SERVICE_TYPES, None]), r.choice([at] * 9 + [None]),
                     r.choice([at + timedelta(minutes=r.randint(-2, 90))] * 9 + [None]),
                     r.choice([1, 2, 3, 4, None, 99]), r.choice([1, 2, 3, None]), r.choice([0.0, 1.5, 2.25, 7.0, None]),
                     r.choice([-1.0, 5.0, 9.5, 20.0, None]), r.choice([-1.0, 0.0, 1.0, 3.5, None]), r.choice([0.0, 8.0, 30.0, None])))
    return spark.createDataFrame(rows, SCHEMA)


def _zones(spark):
    return spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "A")], "id_location string, zone string")


def _rows(df):
    cols = sorted(df.columns)
    shown = [tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()]
    return cols, sorted(shown, key=str)


def _same(cube, plain):
    for name, frame in cube.items():
        assert _rows(frame) == _rows(plain[name]), name


def test_frames_equal_those_of_the_trips(spark, tmp_dir):
    trips, zones = _trips(spark).cache(), _zones(spark)
    for year in (2023, 2024):
        CS.refresh_cube(spark, tmp_dir, trips.where(F.year("pickup_datetime") == year))
    cells = CS.read_cube(spark, tmp_dir)
    for kw in ({}, {"year": 2024, "service": "yellowTaxi"}):
        _same(CS.demand(cells, **kw, hour=0), SC.screen_demand(trips, **kw, hour=0))
        _same(CS.efficiency(cells, zones, **kw), SC.screen_efficiency(trips, zones, **kw))
        _same(CS.hotspots(cells, zones, **kw), SC.screen_hotspots(trips, zones, **kw))
        _same(CS.fares(cells, **kw), SC.screen_fares(trips, **kw))
    _same(CS.efficiency(cells, zones, region="A", month=3), SC.screen_efficiency(trips, zones, region="A", month=3))


def test_a_month_loaded_again_is_replaced_and_strays_go_with_their_file(spark, tmp_dir):
    one = _trips(spark, 200, 1, (2023,)).withColumns({"year": F.lit(2024), "month": F.lit(1)})     # all stray pickups
    two = _trips(spark, 200, 2, (2024,)).withColumns({"year": F.lit(2024), "month": F.lit(2)})
    for part in (one, two, one):
        CS.refresh_cube(spark, tmp_dir, part)
    _same(CS.demand(CS.read_cube(spark, tmp_dir)), SC.screen_demand(one.unionByName(two)))
    CS.refresh_cube(spark, tmp_dir, two.withColumn("month", F.lit(1)))       # the file of month 1 was replaced
    _same(CS.demand(CS.read_cube(spark, tmp_dir)), SC.screen_demand(two.unionByName(two)))


def test_one_scan_and_small_exchange(spark):
    plan = CU.trip_cells(_trips(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_empty_cube_and_flat_lines(spark, tmp_dir):
    trips = _trips(spark, 50)
    empty = CU.trip_cells(trips.limit(0))
    assert empty.count() == 0
    CS.refresh_cube(spark, tmp_dir, trips.limit(0))
    _same(CS.demand(CS.read_cube(spark, tmp_dir)), SC.screen_demand(trips.limit(0)))
    for part in (trips, trips.limit(0)):
        CS.refresh_cube(spark, tmp_dir, part)
    _same(CS.demand(CS.read_cube(spark, tmp_dir)), SC.screen_demand(trips))
    assert CU.merge_line(empty, "tip_duration").first().asDict() == {"slope": None, "intercept": None, "r2": None, "n": 0}
    at = datetime(2024, 1, 1)
    for tips, minutes in (([1.1] * 7, [3] * 7), ([0.1] * 7, list(range(1, 8))), ([0.3, 1.7], [5, 9])):
        t = spark.createDataFrame([("yellowTaxi", at + timedelta(days=31 * i), at + timedelta(days=31 * i, minutes=m), 1, 2, 1.0, 5.0, tip, 6.0)
                                   for i, (tip, m) in enumerate(zip(tips, minutes))], SCHEMA)
        cube = CU.merge_line(CU.trip_cells(t).where("kind = 'time'"), "tip_duration")
        plain = ST.ols_trend(SC.fares_base(t), "tip_amount", "trip_duration")
        assert _rows(cube) == _rows(plain)


def test_top_keys_whatever_the_summary(spark):
    r = random.Random(3)
    keys = [(int(r.paretovariate(0.8)) % 300, r.randint(0, 40)) for _ in range(6000)] + [(None, 1), (2, None)] * 3000
    df = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(keys)], "a int, b int, digest int").repartition(5)
    for k in (1, 25, 10_000_000):
        want = _rows(df.dropna(subset=["a", "b"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
                     .orderBy(F.desc("n"), "a", "b").limit(k))
        for items, buckets in ((7, 3), (50, 64), (20_000, 1 << 18)):
            assert _rows(H.top_k_keys(df, ["a", "b"], k, items=items, buckets=buckets)) == want
    parts = H.key_summaries(df, ["a", "b"], [F.expr("digest % 4").alias("p")], 500)
    assert _rows(H.top_k_keys(df, ["a", "b"], 9, summaries=parts, items=500)) == _rows(H.top_k_keys(df, ["a", "b"], 9))
    assert _rows(H.top_k_keys(df, ["a"], 5)) == _rows(top_k_counts(df, "a", 5))


def test_top_keys_with_ties_and_without_keys(spark):
    df = spark.range(1000).selectExpr("id a", "cast(null as string) b")
    assert [x.a for x in H.top_k_keys(df, ["a"], 5, items=20, buckets=16).collect()] == [0, 1, 2, 3, 4]
    assert H.top_k_keys(df, ["a", "b"], 5).count() == 0
    assert H.top_k_keys(df.limit(0), ["a"], 5).count() == 0
