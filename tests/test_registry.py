"""Raw files that are replaced, touched or deleted."""

import os
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelake.plans.fixtures import damage
from farelake.plans.jobs import job_load_changes
from farelake.sinks.commits import read_table
from farelake.sources import raw_files as RF
from farelake.sources import registry as RG

SERVICES = {"yellow_tripdata": "yellowTaxi", "green_tripdata": "greenTaxi"}


def _put(spark, root, prefix, month, total, n=3, good=True, when=0):
    """A monthly file of ``n`` trips; ``when`` moves its modification time."""
    service, letter = SERVICES[prefix], {"yellow_tripdata": "t", "green_tripdata": "l"}[prefix]
    at = datetime(2024, month, 5, 8)
    rows = [(1, at + timedelta(hours=i), at + timedelta(hours=i, minutes=10), 1.0, 2.0 if good else 0.0, 1, 5, 6, 1, 9.0, 1.0, total)
            for i in range(n)]
    df = spark.createDataFrame(rows, f"VendorID bigint, {letter}pep_pickup_datetime timestamp, {letter}pep_dropoff_datetime timestamp, "
                                     "passenger_count double, trip_distance double, RatecodeID bigint, PULocationID bigint, DOLocationID bigint, "
                                     "payment_type bigint, fare_amount double, tip_amount double, total_amount double")
    name = f"{root}/{service}/2024/{prefix}_2024-{month:02d}.parquet"
    os.makedirs(os.path.dirname(name), exist_ok=True)
    tmp = f"{root}-tmp-{prefix}-{month}-{total}-{when}"
    df.coalesce(1).write.mode("overwrite").parquet(tmp)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    shutil.copyfile(f"{tmp}/{part}", name)
    side = f"{os.path.dirname(name)}/.{os.path.basename(name)}.crc"      # Hadoop's checksum of the damaged file
    if os.path.exists(side):
        os.remove(side)
    os.utime(name, (1.7e9 + when, 1.7e9 + when))
    return name


def _states(df):
    return {r.filename.replace("_tripdata_2024-", ""): r.state for r in df.collect()}


def _fact(spark, dw):
    return sorted(map(tuple, read_table(spark, dw, "fact_taxi_trip").groupBy("service_type", "month", "total_amount").count().collect()))


def test_replaced_touched_gone_and_broken_files(spark, tmp_dir):
    raw, trusted, dw = (f"{tmp_dir}/{x}" for x in ("raw", "trusted", "dw"))
    load = lambda: _states(job_load_changes(spark, raw, trusted, dw, services=SERVICES, digest_new=True))
    for month in (1, 2):
        _put(spark, raw, "yellow_tripdata", month, 10.0)
    green = _put(spark, raw, "green_tripdata", 1, 20.0)
    assert load() == {"yellow01.parquet": "new", "yellow02.parquet": "new", "green01.parquet": "new"}
    assert _fact(spark, dw) == [("greenTaxi", 1, 20.0, 3), ("yellowTaxi", 1, 10.0, 3), ("yellowTaxi", 2, 10.0, 3)]

    assert set(load().values()) == {"same"}
    _put(spark, raw, "yellow_tripdata", 2, 10.0, when=60)                      # the same content again
    yellow = _put(spark, raw, "yellow_tripdata", 1, 11.0, n=2, when=60)        # replaced
    assert load() == {"yellow01.parquet": "changed", "yellow02.parquet": "touched", "green01.parquet": "same"}
    assert _fact(spark, dw) == [("greenTaxi", 1, 20.0, 3), ("yellowTaxi", 1, 11.0, 2), ("yellowTaxi", 2, 10.0, 3)]

    os.remove(green)                                                            # deleted
    _put(spark, raw, "yellow_tripdata", 2, 10.0, good=False, when=120)          # cleaning leaves nothing
    assert load() == {"yellow01.parquet": "same", "yellow02.parquet": "changed", "green01.parquet": "gone"}
    assert _fact(spark, dw) == [("yellowTaxi", 1, 11.0, 2)]

    _put(spark, raw, "yellow_tripdata", 1, 12.0, when=180)
    damage(spark, yellow, "tail")                                               # replaced by a broken one: earlier rows stay
    assert load()["yellow01.parquet"] == "rejected"
    assert _fact(spark, dw) == [("yellowTaxi", 1, 11.0, 2)]
    _put(spark, raw, "yellow_tripdata", 1, 12.0, when=240)
    assert load()["yellow01.parquet"] == "changed"
    assert _fact(spark, dw) == [("yellowTaxi", 1, 12.0, 3)]


def test_a_stopped_run_finds_its_work_again(spark, tmp_dir, monkeypatch):
    raw, trusted, dw = (f"{tmp_dir}/{x}" for x in ("raw", "trusted", "dw"))
    _put(spark, raw, "yellow_tripdata", 1, 10.0)
    job_load_changes(spark, raw, trusted, dw, services=SERVICES)
    _put(spark, raw, "yellow_tripdata", 1, 11.0, n=2, when=60)
    with monkeypatch.context() as m:
        m.setattr("farelake.plans.jobs.job_trusted_to_dw", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            job_load_changes(spark, raw, trusted, dw, services=SERVICES)
    assert _fact(spark, dw) == [("yellowTaxi", 1, 10.0, 3)]
    assert _states(job_load_changes(spark, raw, trusted, dw, services=SERVICES)) == {"yellow01.parquet": "changed"}
    assert _fact(spark, dw) == [("yellowTaxi", 1, 11.0, 2)]


def test_a_digest_ignores_the_order_of_rows_parts_and_columns(spark, tmp_dir):
    df = spark.range(50).selectExpr("id % 7 a", "cast(id as string) b", "cast(null as int) c")
    for i, x in enumerate((df.coalesce(1), df.orderBy(F.desc("b")).repartition(3).select("b", "a"), df.where("b <> '3'"))):
        x.write.parquet(f"{tmp_dir}/{i}/yellow_tripdata_2024-01.parquet")
    got = []
    for i in range(3):
        files = RF.logical_files(RF.list_files(spark, f"{tmp_dir}/{i}"))
        got.append(RG.content_digests(spark, files).first()["digest"])
    assert got[0] == got[1] != got[2]
