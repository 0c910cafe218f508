"""Properties: subsets, conservation, key integrity, idempotence, exactness."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farelake.operators import aggregates as A
from farelake.operators import dims as D
from farelake.operators import keys as K
from farelake.operators import quality as Q
from farelake.operators import stats as ST
from farelake.operators.scd2 import scd2_merge
from farelake.plans import fixtures as fx
from farelake.plans.q_warehouse import build_fact
from farelake.sinks import writers as W
from farelake.sources import readers as RD
from tests.conftest import SF_SMALL


def test_clean_is_subset_and_counts_conserve(spark):
    t = fx.trips(spark, SF_SMALL)
    clean = Q.filter_time_order(Q.filter_positive(t, ["trip_distance"]))
    assert clean.exceptAll(t).count() == 0
    r = A.removed_rows_audit(t, clean).first()
    assert r["n_before"] == r["n_after"] + r["n_removed"]


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).distinct()
    got = K.dense_index(df, ["k"], "sk", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
    assert got.join(ref, "k").where(F.col("sk") != F.col("rn")).count() == 0
    assert got.count() == df.count()


@pytest.mark.parametrize("parts,reuse", [(4, "true"), (7, "false"), (16, "true"), (200, "false")])
def test_dense_index_on_a_wide_table_at_any_partition_count(spark, parts, reuse):
    c = spark.read.parquet("/root/testdata/sf0.1/customer.parquet")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = K.dense_index(c, ["c_nationkey", "c_custkey"], "sk", num_partitions=parts)
        rows = [(r.c_nationkey, r.c_custkey) for r in got.orderBy("sk").select("c_nationkey", "c_custkey", "sk").collect()]
        keys = [r.sk for r in got.select("sk").orderBy("sk").collect()]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert keys == list(range(1, c.count() + 1))
    assert rows == sorted(rows)


def test_quantiles_without_exchange_reuse_and_with_a_null_group(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_extendedprice")
    want = np.quantile(np.array([r[0] for r in li.collect()], dtype=float), [0.25, 0.5, 0.75])
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r["p"]: r["value"] for r in ST.exact_quantiles(li, "l_extendedprice", [0.25, 0.5, 0.75], num_partitions=8).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert np.allclose([got[p] for p in (0.25, 0.5, 0.75)], want)
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "g string, v double")
    assert {(r.g, r.value) for r in ST.exact_quantiles(df, "v", [0.5], ["g"]).collect()} == {("a", 2.0), (None, 5.0)}


def test_exact_quantiles_match_numpy_on_a_skewed_group(spark):
    rng = np.random.default_rng(7)
    hot = rng.normal(50, 10, 4000).round(2)
    cold = rng.normal(5, 1, 40).round(2)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]
    got = {(r["g"], r["p"]): r["value"] for r in ST.exact_quantiles(df, "v", probs, ["g"], num_partitions=5).collect()}
    for g, arr in (("hot", hot), ("cold", cold)):
        for p in probs:
            assert abs(got[(g, p)] - np.quantile(arr, p)) < 1e-9


def test_fact_keys_found_in_dims_and_unique(spark):
    trips = fx.trips(spark, SF_SMALL, with_source=True)
    vendor = D.dim_vendor(trips)
    from farelake.operators.facts import fact_trip
    fact = fact_trip(trips, vendor, D.dim_payment_type(trips), D.dim_rate(trips), D.dim_service_type(trips))
    assert fact.count() == trips.count()
    assert fact.select("sk_trip").distinct().count() == fact.count()
    assert fact.where(F.col("sk_trip").isNull()).count() == 0
    orphans = fact.where(F.col("fk_vendor").isNotNull()).join(vendor, F.col("fk_vendor") == F.col("sk_vendor"), "left_anti")
    assert orphans.count() == 0
    assert vendor.select("sk_vendor").distinct().count() == vendor.count()


def test_fact_without_source_has_no_key_but_all_rows(spark):
    assert build_fact(spark, SF_SMALL).count() > 0


def test_partition_write_is_idempotent_and_keeps_other_months(spark, tmp_dir):
    t = fx.trips(spark, SF_SMALL).withColumns({"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    W.write_partitioned(t, tmp_dir)
    before = RD.scan_partitioned(spark, tmp_dir).count()
    one = RD.scan_partitioned(spark, tmp_dir, [1996], [3])
    staged = tmp_dir + "_stage"
    one.write.parquet(staged)
    W.replace_partition(spark.read.parquet(staged), tmp_dir, 1996, 3)
    W.replace_partition(spark.read.parquet(staged), tmp_dir, 1996, 3)
    assert RD.scan_partitioned(spark, tmp_dir).count() == before


def test_scd2_cases_and_idempotence(spark):
    cur = spark.createDataFrame(
        [(1, "a", "x", "2024-01-01", None, True), (2, "b", None, "2024-01-01", None, True),
         (3, "c", "z", "2024-01-01", None, True), (4, "d", "old", "2023-01-01", "2024-01-01", False)],
        "id int, name string, seg string, effective_date string, end_date string, is_current boolean"
    ).withColumns({"effective_date": F.to_date("effective_date"), "end_date": F.to_date("end_date")})
    new = spark.createDataFrame([(1, "a", "x"), (2, "b", "now"), (3, "c", None), (5, "e", "n")],
                                "id int, name string, seg string")
    out = scd2_merge(new, cur, "id", ["name", "seg"], "2024-06-01")
    rows = sorted(((r["id"], r["seg"], r["is_current"]) for r in out.collect()), key=repr)
    assert rows == sorted([(1, "x", True), (2, None, False), (2, "now", True), (3, "z", False),
                           (3, None, True), (4, "old", False), (5, "n", True)], key=repr)
    again = scd2_merge(new, out, "id", ["name", "seg"], "2024-07-01")
    assert again.exceptAll(out).count() == 0 and out.exceptAll(again).count() == 0


def test_dimension_keys_extend_stably(spark):
    first = D.extend_dimension(None, spark.createDataFrame([(5,), (1,)], "c long"), "c", "sk")
    second = D.extend_dimension(first, spark.createDataFrame([(3,), (1,), (9,)], "c long"), "c", "sk")
    got = {r["c"]: r["sk"] for r in second.collect()}
    assert got[1] == 1 and got[5] == 2 and {got[3], got[9]} == {3, 4}


def test_checked_broadcast_falls_back(spark):
    from farelake.operators.joins import checked_broadcast
    big = spark.range(100)
    plan = big.join(checked_broadcast(spark.range(5), 10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    same = checked_broadcast(big, 10)
    # above the limit the rows are written once and joined by a shuffle
    assert same.count() == 100 and "hint" not in same._jdf.queryExecution().logical().toString().lower()


def test_sample_per_service_is_bounded_and_repeatable(spark):
    from farelake.operators.topk import sample_per_service
    rows = spark.range(0, 20_000, 1, 8).selectExpr("id", "case when id % 10 < 8 then 'a' when id % 10 = 8 then 'b' else 'c' end as service_type")
    got = [sorted((r.id, r.service_type) for r in sample_per_service(rows, services=["a", "b"], fraction=0.2, n=500).collect()) for _ in range(2)]
    assert got[0] == got[1] and len({i for i, _ in got[0]}) == len(got[0])
    count = {s: sum(x == s for _, x in got[0]) for s in "abc"}
    assert count["a"] == 500 and 280 < count["b"] < 520 and count["c"] == 0
    assert all((s == "a") == (i % 10 < 8) for i, s in got[0])
