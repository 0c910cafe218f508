"""Rule attribution and mergeable samples on small tables."""

import os

from farelake.operators import audit as AU
from farelake.operators import topk as K

RULES = {"a": "a > 0", "b": "b > 0", "c": "a < 10"}
ROWS = [(1, 1), (0, 1), (0, 0), (None, 1), (20, 0), (5, None), (1, 1)]


def want():
    broken = [[a is None or not a > 0, b is None or not b > 0, a is None or not a < 10] for a, b in ROWS]
    return sorted((r, i + 1, sum(x[i] for x in broken), sum(x[i] and sum(x) == 1 for x in broken),
                   sum(x[i] and not any(x[:i]) for x in broken), len(ROWS), sum(not any(x) for x in broken)) for i, r in enumerate(RULES))


def test_rules_in_one_pass_and_while_writing(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, "a int, b int")
    assert sorted(map(tuple, AU.audit_rules(df, RULES).collect())) == want()
    out = os.path.join(tmp_dir, "kept")
    assert sorted(map(tuple, AU.write_audited(df, RULES, out).collect())) == want()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 1), (1, 1)] == sorted(map(tuple, AU.kept_rows(df, RULES).collect()))
    empty = AU.write_audited(df.limit(0), RULES, os.path.join(tmp_dir, "none")).collect()
    assert [(r.n_broken, r.n_before) for r in empty] == [(0, 0)] * 3


def test_samples_do_not_depend_on_splits_and_merge(spark):
    df = spark.range(0, 6000).selectExpr("id", "case when id % 10 < 8 then 'a' else 'b' end service_type")
    draw = lambda d: K.sample_per_service(d, services=["a", "b"], fraction=0.5, n=100, seed=3)
    rows = lambda d: sorted(map(tuple, d.collect()))
    whole = rows(draw(df))
    assert len(whole) == 200 and whole == rows(draw(df.repartition(7)))
    assert rows(K.merge_samples([draw(df.where("id < 2500")), draw(df.where("id >= 2500"))], n=100, seed=3)) == whole
    assert whole != rows(K.sample_per_service(df, services=["a", "b"], fraction=0.5, n=100, seed=4))
