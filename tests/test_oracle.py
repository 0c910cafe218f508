"""Every registered query against its DuckDB oracle on the smallest scale."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.compare import TABLES, rows_of

import __spark_entry__ as E
from farelake.plans import fixtures as fx
from farelake.plans.catalog import load_all

QUERIES, ORACLE = load_all()    # the training-data queries have tests of their own
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle_or_is_nondeterministic():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "service_type", "trips"]
    assert df.count() > 0


def test_sample_is_bounded_and_made_of_trips(spark):
    from farelake.operators.topk import sample_per_service
    trips = fx.trips(spark, SF_SMALL).where("service_type <> 'other'")
    sample = sample_per_service(trips, n=50, seed=7)
    sizes = {r[0]: r[1] for r in sample.groupBy("service_type").count().collect()}
    assert sizes == {s: 50 for s in sizes} and len(sizes) == 4
    assert sample.exceptAll(trips).count() == 0
    assert sorted(map(str, sample.collect())) == sorted(map(str, sample_per_service(trips, n=50, seed=7).collect()))


@pytest.mark.parametrize("name", [n for n in NAMES if n in ORACLE])
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    ddf = con.execute(ORACLE[name]).df()
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
