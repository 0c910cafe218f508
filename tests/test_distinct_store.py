"""Distinct rows kept over runs."""

import pytest
from pyspark.sql import functions as F

from farelake.sinks import distinct_store as DS

SCHEMA = "a int, b string, x double"


def _rows(df):
    return sorted(str(tuple(r)) for r in df.collect())      # nan is equal to nan


def test_runs_add_up_to_distinct(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    one = spark.createDataFrame([(1, "p", 0.0), (1, "p", 0.0), (2, None, None), (None, None, None)], SCHEMA)
    two = spark.createDataFrame([(1, "p", -0.0), (2, None, None), (3, "", float("nan")), (3, None, 1.0), (None, None, None)], SCHEMA)
    empty = one.limit(0)
    for run in (empty, one, two, empty, two, one):
        DS.add_distinct(spark, root, run, buckets=4)
    assert _rows(DS.read_distinct(spark, root)) == _rows(one.unionByName(two).distinct())
    with pytest.raises(ValueError):
        DS.add_distinct(spark, root, one.withColumn("a", F.col("a").cast("long")))
    with pytest.raises(ValueError):
        DS.add_distinct(spark, root, one.withColumn(DS.FP, F.lit(1)))


def test_rows_that_share_a_fingerprint_both_stay(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/store"
    real = F.xxhash64
    monkeypatch.setattr(DS.F, "xxhash64", lambda *cols: real(F.lit(7)))
    DS.add_distinct(spark, root, spark.createDataFrame([(1, "p", 1.0), (2, None, None)], SCHEMA), buckets=4)
    DS.add_distinct(spark, root, spark.createDataFrame([(1, "p", 1.0), (1, "q", 1.0), (2, None, None), (2, "", None)], SCHEMA))
    assert _rows(DS.read_distinct(spark, root)) == _rows(
        spark.createDataFrame([(1, "p", 1.0), (2, None, None), (1, "q", 1.0), (2, "", None)], SCHEMA))


def test_history_is_not_shuffled(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    df = spark.range(2000).selectExpr("cast(id as int) a", "cast(id % 7 as string) b", "id * 0.5 x")
    DS.add_distinct(spark, root, df.where("a < 1500"), buckets=8)
    fresh = DS.new_rows(spark, root, df.where("a >= 1000"))
    assert fresh.count() == 500
    plan = fresh._jdf.queryExecution().executedPlan().toString().splitlines()
    # above a scan of the store there is no exchange before its join
    for i, line in enumerate(plan):
        if "FileScan parquet" in line and "distinct_rows_" in line:
            above, depth = [], line.index("FileScan")
            for upper in reversed(plan[:i]):
                at = len(upper) - len(upper.lstrip(" :+-"))
                if at < depth:
                    above.append(upper.strip(" :+-"))
                    depth = at
                if "Join" in upper and at <= depth:
                    break
            assert above and not any("Exchange" in u for u in above), above
            assert "Bucketed: true" in line


def test_buckets_follow_the_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(DS, "ROWS", 100)
    root = f"{tmp_dir}/store"
    df = spark.range(3000).selectExpr("cast(id as int) a", "cast(id % 7 as string) b", "id * 0.5 x")
    held = []
    for upto in (1000, 1100, 3000, 3000):
        DS.add_distinct(spark, root, df.where(f"a < {upto}"), buckets=4)
        held.append(DS._layout(spark, root)["buckets"])
        assert _rows(DS.read_distinct(spark, root)) == _rows(df.where(f"a < {upto}"))
    assert held == [10, 10, 30, 30]
    files = spark.table(DS._table(spark, root)).withColumn("f", F.input_file_name()).groupBy("f").count()
    assert files.agg(F.max("count")).first()[0] < 200


def test_a_run_stopped_while_dealing_out_anew_changes_nothing(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/store"
    df = spark.range(900).selectExpr("cast(id as int) a", "cast(id % 7 as string) b", "id * 0.5 x")
    DS.add_distinct(spark, root, df.where("a < 500"), buckets=2)
    monkeypatch.setattr(DS, "ROWS", 100)
    with monkeypatch.context() as m:
        m.setattr(DS, "_write_layout", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            DS.add_distinct(spark, root, df)
    assert _rows(DS.read_distinct(spark, root)) == _rows(df.where("a < 500"))
    DS.add_distinct(spark, root, df)
    assert DS._layout(spark, root)["buckets"] == 9 and _rows(DS.read_distinct(spark, root)) == _rows(df)
