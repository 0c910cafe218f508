"""Edge cases of the distributed statistics helpers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake.operators import aggregates as A
from farelake.operators import stats as ST


def test_quantiles_single_value_constant_group_and_nulls(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 2.0), ("b", 2.0), ("b", 2.0), ("b", None), ("c", None)],
                               "g string, v double")
    got = {(r["g"], r["p"]): r["value"] for r in ST.exact_quantiles(df, "v", [0.0, 0.5, 1.0], ["g"]).collect()}
    assert got[("a", 0.0)] == got[("a", 0.5)] == got[("a", 1.0)] == 5.0
    assert got[("b", 0.5)] == 2.0
    assert not any(k[0] == "c" for k in got)          # all-null group has no quantile


def test_quantiles_without_groups_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = rng.integers(0, 50, 3000).astype(float)      # many repeated values
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0.1, 0.25, 0.5, 0.9, 0.999]
    got = dict(zip(probs, ST.quantile_scalars(df, "v", probs)))
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(vals, p), abs=1e-9)


def test_approx_quantiles_close(spark):
    df = spark.range(0, 10001).selectExpr("cast(id as double) as v")
    got = {r["p"]: r["value"] for r in ST.approx_quantiles(df, "v", [0.5, 0.9]).collect()}
    assert abs(got[0.5] - 5000) <= 10 and abs(got[0.9] - 9000) <= 10


def test_histogram_last_bin_closed_and_empty_bins_kept(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (10.0,)], "x double")
    rows = {r["bin"]: r["n"] for r in ST.histogram(df, "x", bins=5).collect()}
    assert len(rows) == 5 and rows[4] == 2 and rows[0] == 2 and rows[2] == 0


def test_box_stats_without_groups(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    r = ST.box_stats(spark.createDataFrame([(v,) for v in vals], "x double"), "x").first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (r["q1"], r["q3"]) == (q1, q3)
    assert r["whisker_hi"] == 4.0 and r["n_out"] == 1 and r["n"] == 5


def test_trim_outliers_empty_and_ols(spark):
    empty = spark.createDataFrame([], "x double")
    assert ST.trim_outliers(empty, "x", 0.01, 0.99).count() == 0
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(10)], "x double, y double")
    r = ST.ols_trend(df, "y", "x").first()
    assert r["slope"] == pytest.approx(2.0) and r["intercept"] == pytest.approx(1.0) and r["n"] == 10


def test_describe_matches_pandas(spark):
    import pandas as pd
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(10, 3, 500).round(2), "b": rng.integers(0, 9, 500).astype(float)})
    got = {r["stat"]: (r["a"], r["b"]) for r in ST.describe_numeric(spark.createDataFrame(pdf), ["a", "b"]).collect()}
    want = pdf.describe().round(2)
    for stat in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
        assert got[stat][0] == pytest.approx(want.loc[stat, "a"], abs=0.011)
        assert got[stat][1] == pytest.approx(want.loc[stat, "b"], abs=0.011)


def test_heatmap_matrix_shape(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, h),) for h in (0, 0, 5, 23)], "pickup_datetime timestamp_ntz")
    r = A.heatmap_matrix(df).first()
    assert r["day_of_week"] == "Sunday" and r["h0"] == 2 and r["h5"] == 1 and r["h23"] == 1 and r["h1"] == 0


def test_hot_group_is_split_over_range_partitions(spark):
    rng = np.random.default_rng(11)
    hot = rng.normal(100, 20, 9000).round(3)
    cold = rng.normal(1, 1, 1000).round(3)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold]
    df = spark.createDataFrame(rows, "g string, v double")
    ranged = ST.ranged_value_counts(df, "v", ["g"], num_partitions=8)
    spread = {r["g"]: r["n"] for r in ranged.groupBy("g").agg(F.countDistinct("__pid").alias("n")).collect()}
    assert spread["hot"] >= 4            # the hot group is not gathered into one task
    got = {r["p"]: r["value"] for r in ST.exact_quantiles(df, "v", [0.5], ["g"], num_partitions=8)
           .where("g = 'hot'").collect()}
    assert got[0.5] == pytest.approx(np.quantile(hot, 0.5), abs=1e-9)


def test_approx_method_for_box_and_describe(spark):
    df = spark.range(0, 2001).selectExpr("cast(id as double) as x", "cast(id % 2 as string) as g")
    box = {r["g"]: r for r in ST.box_stats(df, "x", ["g"], method="approx").collect()}
    assert abs(box["0"]["median"] - 1000) <= 10 and box["0"]["n"] == 1001
    d = {r["stat"]: r["x"] for r in ST.describe_numeric(df, ["x"], method="approx").collect()}
    assert d["count"] == 2001 and abs(d["50%"] - 1000) <= 10


@pytest.mark.parametrize("accuracy,few", [(10_000, 200_000), (20, 40), (200, 100)])
def test_brackets_narrow_to_the_exact_values(spark, accuracy, few):
    """Coarse sketches and small limits force several narrowing passes; one group
    holds nine tenths of the rows, one value a third of it."""
    rng = np.random.default_rng(21)
    hot = np.where(rng.random(9000) < 0.33, 7.0, rng.normal(0, 50, 9000))
    groups = {"hot": (hot, rng.integers(0, 3, 9000).astype(float)), None: (rng.normal(1, 1, 700), rng.normal(5, 1, 700)),
              "one": (np.array([3.5]), np.array([2.0])), "none": (np.array([]), np.array([]))}
    rows = [(g, float(a), float(b)) for g, (x, y) in groups.items() for a, b in zip(x, y)] + [("none", None, None), ("hot", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    groups["hot"] = (hot, np.append(groups["hot"][1], 1.0))
    probs = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]
    got = {(r.g, r.column, r.p): r.value for r in ST.bracket_quantiles(df, ["x", "y"], probs, ["g"], accuracy=accuracy, few=few).collect()}
    want = {(g, c, p): np.quantile(v, p) for g, (x, y) in groups.items() for c, v in (("x", x), ("y", y)) for p in probs if len(v)}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9), k
    alone = {(r.column, r.p): r.value for r in ST.bracket_quantiles(df, ["x"], probs, accuracy=accuracy, few=few).collect()}
    every = np.concatenate([x for x, _ in groups.values()])
    assert alone == {("x", p): pytest.approx(np.quantile(every, p), abs=1e-9) for p in probs}
    assert ST.bracket_quantiles(df.limit(0), ["x"], probs).collect() == []


def test_very_many_groups_take_the_range_layout(spark, monkeypatch):
    monkeypatch.setattr(ST, "MAX_GROUPS", 3)
    df = spark.range(50).selectExpr("id % 5 g", "cast(id as double) v")
    assert ST.bracket_quantiles(df, ["v"], [0.5], ["g"]) is None
    assert {r.g: r.value for r in ST.exact_quantiles(df, "v", [0.5], ["g"]).collect()} == {g: g + 22.5 for g in range(5)}
