"""End-to-end jobs on raw-shaped monthly files written from the fixtures."""

import os

import pytest

from pyspark.sql import functions as F

from farelake import fixed
from farelake.plans import fixtures as fx
from farelake.plans import jobs as J
from farelake.sinks import commits
from farelake.sinks.commits import read_table
from farelake.sources import readers as RD
from tests.conftest import SF_SMALL

MONTHS = [(1996, 1), (1996, 2)]


def write_raw(spark, root):
    """One raw file per service and month, named like the published files."""
    for prefix, service in fixed.SERVICE_BY_FILE_PREFIX.items():
        raw = fx.raw_service(spark, SF_SMALL, service)
        ts = [c for c in raw.columns if c.lower().endswith("pickup_datetime")][0]
        for y, m in MONTHS:
            if service == "greenTaxi" and m == 2:
                continue                       # a month without a file
            part = raw.where((F.year(ts) == y) & (F.month(ts) == m))
            part.coalesce(1).write.parquet(J.raw_file_path(root, service, prefix, y, m))


def test_raw_to_trusted_to_dw(spark, tmp_dir):
    raw, trusted, dw = (os.path.join(tmp_dir, x) for x in ("raw", "trusted", "dw"))
    write_raw(spark, raw)
    report, rejects = J.job_raw_to_trusted(spark, raw, trusted, [1996], [1, 2])
    rep = {(r["service_type"], r["month"]): r["n_rows"] for r in report.collect()}
    assert ("greenTaxi", 2) not in rep and ("greenTaxi", 1) in rep
    assert [r["filename"] for r in rejects.collect()] == ["green_tripdata_1996-02.parquet"]
    yellow = RD.scan_partitioned(spark, f"{trusted}/yellowTaxi")
    assert yellow.where("trip_distance <= 0 OR dropoff_datetime <= pickup_datetime").count() == 0
    assert "payment_type_description" in yellow.columns
    n_yellow = yellow.count()

    # second run of the same months: same data, nothing duplicated
    J.job_raw_to_trusted(spark, raw, trusted, [1996], [1, 2])
    assert RD.scan_partitioned(spark, f"{trusted}/yellowTaxi").count() == n_yellow

    fact = J.job_trusted_to_dw(spark, trusted, dw, [1996], [1, 2], zones=fx.zones(spark, SF_SMALL),
                               companies=fx.companies(spark, SF_SMALL), licences=fx.licences(spark, SF_SMALL))
    n = fact.count()
    assert n == J.conform_trusted(spark, trusted, [1996], [1, 2]).count()
    assert fact.where(F.col("fk_service_type").isNull()).count() == 0
    keys_before = {r["id_vendor"]: r["sk_vendor"] for r in read_table(spark, dw, "dim_vendor").collect()}
    J.job_trusted_to_dw(spark, trusted, dw, [1996], [1, 2])
    keys_after = {r["id_vendor"]: r["sk_vendor"] for r in read_table(spark, dw, "dim_vendor").collect()}
    assert keys_before == keys_after
    assert read_table(spark, dw, "fact_taxi_trip").count() == n


def test_unify_and_audit(spark, tmp_dir):
    raw, trusted, out = (os.path.join(tmp_dir, x) for x in ("raw", "trusted", "unified"))
    write_raw(spark, raw)
    J.job_raw_to_trusted(spark, raw, trusted, [1996], [1])
    J.job_unify_trips(spark, trusted, out, [1996], [1])
    u = spark.read.parquet(out)
    assert u.count() == u.distinct().count() > 0
    before = spark.read.parquet(J.raw_file_path(raw, "yellowTaxi", "yellow_tripdata", 1996, 1))
    before = before.withColumnsRenamed({"tpep_pickup_datetime": "pickup_datetime",
                                        "tpep_dropoff_datetime": "dropoff_datetime"})
    after = RD.scan_partitioned(spark, f"{trusted}/yellowTaxi", [1996], [1])
    rep = J.job_audit(before, after.drop("year", "month"), ["pickup_datetime", "dropoff_datetime", "trip_distance"])
    r = rep["report"].first()
    assert r["n_before"] == r["n_after"] + r["n_removed"]
    assert rep["removed"].where("trip_distance > 0 AND dropoff_datetime > pickup_datetime").count() == 0


def test_dedup_publish_stops_on_empty(spark, tmp_dir):
    empty = spark.createDataFrame([], "a int")
    assert J.job_dedup_publish(empty, os.path.join(tmp_dir, "x")) is False
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "a int, b string")
    assert J.job_dedup_publish(df, os.path.join(tmp_dir, "y"), {"a": "bigint"}) is True
    assert spark.read.parquet(os.path.join(tmp_dir, "y")).count() == 1


def test_incremental_stream_only_loads_new_files(spark, tmp_dir):
    from farelake.streaming.incremental import stream_raw_to_trusted
    raw, trusted = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "trusted")
    write_raw(spark, raw)
    src = f"{raw}/yellowTaxi"
    schema = spark.read.parquet(J.raw_file_path(raw, "yellowTaxi", "yellow_tripdata", 1996, 1)).schema
    ckpt = os.path.join(tmp_dir, "ckpt")
    stream_raw_to_trusted(spark, src, trusted, "yellowTaxi", schema, checkpoint=ckpt)
    first = RD.scan_partitioned(spark, trusted).count()
    assert first > 0
    # a new month arrives; the already-loaded files are not read again
    extra = fx.raw_service(spark, SF_SMALL, "yellowTaxi").where(
        (F.year("tpep_pickup_datetime") == 1996) & (F.month("tpep_pickup_datetime") == 3))
    extra.coalesce(1).write.parquet(J.raw_file_path(raw, "yellowTaxi", "yellow_tripdata", 1996, 3))
    stream_raw_to_trusted(spark, src, trusted, "yellowTaxi", schema, checkpoint=ckpt)
    months = sorted(r["month"] for r in RD.scan_partitioned(spark, trusted).select("month").distinct().collect())
    assert months == [1, 2, 3]


def test_command_line_raw_to_trusted(spark, tmp_dir, capsys):
    from farelake.__main__ import main
    raw, trusted = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "trusted")
    write_raw(spark, raw)
    assert main(["raw-to-trusted", "--raw", raw, "--trusted", trusted, "--years", "1996", "--months", "1", "2"]) == 0
    out = capsys.readouterr().out
    assert '"rejected"' in out and "green_tripdata_1996-02.parquet" in out


def test_type_drift_between_months_and_corrupt_file(spark, tmp_dir):
    raw, trusted = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "trusted")
    y = fx.raw_service(spark, SF_SMALL, "yellowTaxi")
    jan = y.where((F.year("tpep_pickup_datetime") == 1996) & (F.month("tpep_pickup_datetime") == 1))
    feb = y.where((F.year("tpep_pickup_datetime") == 1996) & (F.month("tpep_pickup_datetime") == 2))
    jan.coalesce(1).write.parquet(J.raw_file_path(raw, "yellowTaxi", "yellow_tripdata", 1996, 1))
    # February stores passenger_count as an integer and has an extra column
    feb.withColumn("passenger_count", F.col("passenger_count").cast("bigint")) \
       .withColumn("Airport_fee", F.lit(1.25)).coalesce(1) \
       .write.parquet(J.raw_file_path(raw, "yellowTaxi", "yellow_tripdata", 1996, 2))
    bad = J.raw_file_path(raw, "yellowTaxi", "yellow_tripdata", 1996, 3)
    os.makedirs(os.path.dirname(bad), exist_ok=True)
    with open(bad, "wb") as f:
        f.write(b"not a parquet file")
    report, rejects = J.job_raw_to_trusted(spark, raw, trusted, [1996], [1, 2, 3],
                                           services={"yellow_tripdata": "yellowTaxi"})
    months = {r["month"]: r["n_rows"] for r in report.collect()}
    assert set(months) == {1, 2} and all(n > 0 for n in months.values())
    errs = {r["filename"]: r["error"] for r in rejects.collect()}
    assert "yellow_tripdata_1996-03.parquet" in errs and errs["yellow_tripdata_1996-03.parquet"] != "file not found"
    out = RD.scan_partitioned(spark, f"{trusted}/yellowTaxi")
    assert dict(out.dtypes)["passenger_count"] == "double"


def test_wide_fact_keeps_quality_flags(spark, tmp_dir):
    from farelake.operators.facts import fact_trip_wide
    raw, trusted = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "trusted")
    write_raw(spark, raw)
    J.job_raw_to_trusted(spark, raw, trusted, [1996], [1])
    wide = fact_trip_wide(J.conform_trusted(spark, trusted, [1996], [1]))
    assert {"has_problem", "problem_description", "trip_duration_minutes", "fk_time"} <= set(wide.columns)
    assert wide.where("has_problem IS NULL AND service_type IN ('yellowTaxi', 'greenTaxi')").count() == 0


def test_wide_fact_carries_every_column_and_keys(spark):
    from farelake import fixed
    from farelake.operators.aggregates import distinct_rows
    from farelake.operators.facts import fact_trip_wide
    from farelake.plans.q_warehouse import trusted_from_trips
    trips = J.conform_trusted(spark, trusted_from_trips(spark, "/root/testdata/sf0.001"))
    wide = fact_trip_wide(trips)
    assert len(wide.columns) == len(set(wide.columns)) == 44
    assert {f.name for f in fixed.CONFORMED_TRIP_SCHEMA.fields} <= set(wide.columns)
    n, keys, filled = wide.selectExpr(
        "count(*)", "count(DISTINCT sk_trip)",
        "array(count(improvement_surcharge), count(ehail_fee), count(congestion_surcharge), count(airport_fee), count(sales_tax), count(bcf), "
        "count(driver_pay), count(store_and_fwd_flag), count(wav_match_flag), count(originating_base_number))").first()
    assert n == keys and min(filled) > 0
    # two trips that differ in one of these columns alone both stay
    two = trips.where("service_type = 'highVolumeForHire'").limit(1).drop("src_file", "src_row")
    two = two.unionByName(two.withColumn("driver_pay", F.lit(-1.0)))
    assert distinct_rows(two).count() == 2


def test_a_later_month_keeps_earlier_rows_and_keys(spark, tmp_dir):
    """The second monthly file holds trips of the first month, and the second run another service."""
    from farelake.plans.jobs import job_trusted_to_dw
    from farelake.plans.q_warehouse import trusted_from_trips
    from farelake.sinks.writers import write_partitioned
    root = trusted_from_trips(spark, "/root/testdata/sf0.001")
    trusted, dw = f"{tmp_dir}/trusted", f"{tmp_dir}/dw"
    yellow = spark.read.parquet(f"{root}/yellowTaxi")
    year, month = [(r.year, r.month) for r in yellow.groupBy("year", "month").count().orderBy(F.desc("count")).collect() if r.month < 12][0]
    rows = yellow.where((F.col("year") == year) & (F.col("month") == month)).limit(13).collect()
    first, late = (spark.createDataFrame(r, yellow.schema) for r in (rows[:10], rows[10:]))
    write_partitioned(first, f"{trusted}/yellowTaxi")
    job_trusted_to_dw(spark, trusted, dw, [year], [month])
    before = {r.id_service_type: r.sk_service_type for r in read_table(spark, dw, "dim_service_type").collect()}
    days = read_table(spark, dw, "dim_time").count()
    write_partitioned(late.withColumn("month", F.lit(month + 1).cast("int")), f"{trusted}/yellowTaxi")
    fhv = spark.read.parquet(f"{root}/forHireVehicle").limit(5).withColumns({"year": F.lit(year).cast("int"), "month": F.lit(month + 1).cast("int")})
    write_partitioned(fhv, f"{trusted}/forHireVehicle")
    job_trusted_to_dw(spark, trusted, dw, [year], [month + 1])
    fact = read_table(spark, dw, "fact_taxi_trip")
    assert fact.where("service_type = 'yellowTaxi'").count() == 13 and fact.where("service_type = 'forHireVehicle'").count() == 5
    after = {r.id_service_type: r.sk_service_type for r in read_table(spark, dw, "dim_service_type").collect()}
    assert after["yellowTaxi"] == before["yellowTaxi"] and len(set(after.values())) == 2
    time = read_table(spark, dw, "dim_time")
    assert time.count() >= days and time.count() == time.select("sk_time").distinct().count()


def test_trip_keys_are_unique_over_runs(spark, tmp_dir):
    raw, trusted, dw = (os.path.join(tmp_dir, x) for x in ("raw", "trusted", "dw"))
    write_raw(spark, raw)
    for month in (1, 2):
        J.job_raw_to_trusted(spark, raw, trusted, [1996], [month])
        J.job_trusted_to_dw(spark, trusted, dw, [1996], [month])
    keys = [r.sk_trip for r in read_table(spark, dw, "fact_taxi_trip").select("sk_trip").collect()]
    assert keys and None not in keys and len(set(keys)) == len(keys)
    # a run again gives the same keys
    J.job_trusted_to_dw(spark, trusted, dw, [1996], [1])
    again = [r.sk_trip for r in read_table(spark, dw, "fact_taxi_trip").select("sk_trip").collect()]
    assert sorted(again) == sorted(keys)


def test_stream_merges_a_second_file_and_rejects_unmatched_names(spark, tmp_dir):
    from farelake.streaming.incremental import stream_raw_to_trusted
    src, trusted, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "trusted", "ckpt"))
    y = fx.raw_service(spark, SF_SMALL, "yellowTaxi").where("passenger_count > 0 and trip_distance > 0 and fare_amount > 0")
    rows = y.limit(60).collect()

    def land(folder, name, part):
        spark.createDataFrame(part, y.schema).coalesce(1).write.parquet(os.path.join(src, folder, name))

    def run():
        stream_raw_to_trusted(spark, src, trusted, "yellowTaxi", y.schema, checkpoint=ckpt)
        return spark.read.parquet(trusted).count()
    land("a", "yellow_1996-01.parquet", rows[:40])
    land("a", "notes.parquet", rows[:5])
    first = run()
    land("b", "yellow_1996-01.parquet", rows[40:])
    second = run()
    assert 0 < first < second
    assert spark.read.parquet(trusted).select("src_file", "src_row").distinct().count() == second
    rejects = spark.read.parquet(f"{trusted}/_rejects/*").collect()
    assert rejects and all("notes.parquet" in r.filename for r in rejects)
    assert run() == second


def test_a_broken_page_stops_its_file_only(spark, tmp_dir):
    """Footer fine, a page flipped: found by decoding, the other files are written."""
    from farelake.sources import raw_files as RF
    raw, trusted = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "trusted")
    fx.write_raw_layer(spark, SF_SMALL, raw)
    last = RF.logical_files(RF.list_files(spark, f"{raw}/greenTaxi")).agg(F.max("year")).first()[0]
    years = [last - 1, last]
    report, rejects = J.job_raw_to_trusted(spark, raw, trusted, years, services={"green_tripdata": "greenTaxi"})
    bad = [r for r in rejects.collect() if r.error != RF.NOT_FOUND]
    assert len(bad) == 1 and bad[0].error.startswith(RF.NO_DATA) and " of " in bad[0].error
    months = {f"green_tripdata_{r.year}-{r.month:02d}.parquet" for r in report.collect()}
    assert bad[0].filename not in months and len(months) > 12
    # the same when every file is decoded first
    again, more = J.job_raw_to_trusted(spark, raw, os.path.join(tmp_dir, "t2"), years, services={"green_tripdata": "greenTaxi"}, check_data=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, report.collect()))
    assert sorted(map(tuple, more.collect())) == sorted(map(tuple, rejects.collect()))


def test_files_without_rows_and_without_footer(spark, tmp_dir):
    from farelake.sources import raw_files as RF
    raw = os.path.join(tmp_dir, "raw")
    y = fx.raw_service(spark, SF_SMALL, "yellowTaxi")
    y.limit(0).coalesce(1).write.parquet(J.raw_file_path(raw, "yellowTaxi", "yellow_tripdata", 1996, 1))
    y.limit(5).coalesce(1).write.parquet(J.raw_file_path(raw, "yellowTaxi", "yellow_tripdata", 1996, 2))
    files = RF.logical_files(RF.list_files(spark, raw))
    fx.damage(spark, files.where("month = 2").first()["path"], "tail")
    state = {r.month: (r.footer_rows, r.error) for r in RF.footer_faults(spark, files).collect()}
    assert state[1] == (0, None) and state[2][0] is None and state[2][1].startswith(RF.NO_FOOTER)
    assert RF.list_files(spark, os.path.join(tmp_dir, "none")).collect() == []
    report, rejects = J.job_raw_to_trusted(spark, raw, os.path.join(tmp_dir, "t"), [1996], [1, 2, 3], services={"yellow_tripdata": "yellowTaxi"})
    assert report.collect() == []
    assert {r.filename[-10:-8]: r.error.split(":")[0] for r in rejects.collect()} == {"02": RF.NO_FOOTER, "03": RF.NOT_FOUND}


def _state(spark, dw):
    names = ("dim_vendor", "dim_payment_type", "dim_service_type", "dim_license_number", "source_files", "fact_taxi_trip")
    return {n: sorted((tuple(r) for r in read_table(spark, dw, n).collect()), key=repr) for n in names}


def test_a_run_that_stops_changes_nothing(spark, tmp_dir, monkeypatch):
    """The second month brings new services and files. It stops after the
    dimensions, after the fact and after the claim; then it runs again."""
    raw, trusted, dw = (os.path.join(tmp_dir, x) for x in ("raw", "trusted", "dw"))
    write_raw(spark, raw)
    J.job_raw_to_trusted(spark, raw, trusted, [1996], [1, 2])
    run = lambda month: J.job_trusted_to_dw(spark, trusted, dw, [1996], [month], licences=fx.licences(spark, SF_SMALL))
    run(1)
    before = _state(spark, dw)

    def stop(*a, **k):
        raise RuntimeError("stopped")
    for what in ("stage_partitions", "commit"):
        with monkeypatch.context() as m:
            m.setattr(commits.Transaction, what, stop)
            with pytest.raises(RuntimeError):
                run(2)
        assert _state(spark, dw) == before
    with monkeypatch.context() as m:
        m.setattr(commits.json, "dumps", stop)      # the number is claimed, the manifest is not written
        with pytest.raises(RuntimeError):
            run(2)
    assert _state(spark, dw) == before
    run(2)
    after = _state(spark, dw)
    for name in ("dim_vendor", "dim_payment_type", "dim_service_type", "dim_license_number", "source_files"):
        assert set(before[name]) <= set(after[name])
    assert set(before["fact_taxi_trip"]) < set(after["fact_taxi_trip"])
    run(1)
    assert _state(spark, dw) == after


def test_transactions(spark, tmp_dir):
    dw = os.path.join(tmp_dir, "dw")
    df = spark.createDataFrame([(1, 1996, 1), (2, 1996, 2)], "a int, year int, month int")
    one, two = commits.Transaction(spark, dw), commits.Transaction(spark, dw)
    assert one.read("t") is None and commits.snapshot(spark, dw) == {}
    one.stage("dim", df.select("a"))
    one.stage_partitions("t", df)
    two.stage("dim", df.select("a").limit(0))
    one.commit()
    with pytest.raises(commits.ConcurrentCommit):
        two.commit()
    assert read_table(spark, dw, "dim").count() == 2
    three = commits.Transaction(spark, dw)
    three.stage_partitions("t", spark.createDataFrame([(7, 1996, 2), (8, 1997, 1)], df.schema))
    assert three.read("dim").count() == 2
    three.commit()
    rows = lambda **k: sorted(tuple(r) for r in read_table(spark, dw, "t", **k).select("a", "year", "month").collect())
    assert rows() == [(1, 1996, 1), (7, 1996, 2), (8, 1997, 1)]
    assert rows(years=[1996], months=[2]) == [(7, 1996, 2)] and rows(years=[2001]) == []
    for _ in range(2):
        last = commits.Transaction(spark, dw)
        last.stage("dim", df.select("a"))
        last.commit()
    gone = commits.vacuum(spark, dw, keep=1)
    assert len(gone) == 2 and all(g.startswith("dim/") for g in gone)
    assert rows() == [(1, 1996, 1), (7, 1996, 2), (8, 1997, 1)] and read_table(spark, dw, "dim").count() == 2
