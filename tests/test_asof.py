"""The as-of join against a look-up of every version, with hot keys cut into slices."""

import datetime as dt

import numpy as np
import pytest

from farelake.operators.asof import asof_join

DAY = dt.datetime(2024, 1, 1)


def at(n):
    return None if n is None else DAY + dt.timedelta(hours=int(n))


def want(key, t, versions):
    held = [(e, float("inf") if x is None else x, a) for k, e, x, a in versions if key is not None and t is not None and k == key and e is not None and e <= t]
    if not held:
        return None
    _, end, a = max(held, key=lambda v: (v[0], v[1]))
    return a if t < end else None


@pytest.mark.parametrize("hot_rows", [20, 10_000_000])
def test_against_every_version(spark, hot_rows):
    rng = np.random.default_rng(2)
    versions = []
    for k in range(12):
        starts = sorted(rng.choice(200, int(rng.integers(0, 9)), replace=False).tolist())
        for a, b in zip(starts, starts[1:] + [None]):
            # some end before the next starts, the last one may be closed
            end = b if rng.random() < 0.7 else a + int(rng.integers(1, 9))
            versions.append((k, a, end, f"v{k}-{a}" if rng.random() < 0.9 else None))
    versions += [(3, 50, 90, "twin"), (3, 50, None, "twin, open"), (None, 5, None, "no key"), (4, None, None, "no start")]
    facts = [(i, int(rng.choice([1, 1, 1, 2, 5, 7, 99, rng.integers(0, 12)])), int(rng.integers(-5, 210))) for i in range(900)]
    facts += [(1000, None, 5), (1001, 1, None), (1002, None, None)] + [(1100 + i, 7, 60) for i in range(60)]
    f = spark.createDataFrame([(i, k, at(t), "x") for i, k, t in facts], "i int, k int, ts timestamp_ntz, segment string")
    v = spark.createDataFrame([(k, at(a), at(b), s) for k, a, b, s in versions], "id long, effective_date timestamp_ntz, end_date timestamp_ntz, segment string")
    got = {r.i: r.v_segment for r in asof_join(f, v, "k", "ts", ["segment"], version_key="id", prefix="v_", hot_rows=hot_rows).collect()}
    assert got == {i: want(k, t, versions) for i, k, t in facts}


def test_plan_has_no_inequality_join(spark):
    from farelake.plans import fixtures as fx
    d = "/root/testdata/sf0.001"
    out = asof_join(fx.rides(spark, d), fx.customer_history(spark, d), "customer", "pickup_datetime", ["segment"], version_key="id", prefix="c_")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.count() == fx.rides(spark, d).count()


def test_empty_sides(spark):
    f = spark.createDataFrame([(1, 1, at(3))], "i int, k int, ts timestamp_ntz")
    v = spark.createDataFrame([], "k int, effective_date date, end_date date, a string")
    assert asof_join(f, v, "k", "ts", ["a"]).first().a is None
    assert asof_join(f.limit(0), v, "k", "ts", ["a"]).collect() == []
