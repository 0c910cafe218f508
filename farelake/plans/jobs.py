"""User-level jobs: raw -> trusted -> warehouse -> serving, and the audit.

Design for a large cluster:

* one Spark job per service covers all requested months (not a driver loop
  of one small job per file); months whose types differ are widened by the
  union; the write replaces only the year/month partitions present;
* a missing file, a bad footer or a bad data page is reported (rejects frame)
  and does not stop the other files (``sources.raw_files``);
* the conformed union is written once as a staging table and read back, so
  the dimensions and the fact do not each recompute the scans (and the job
  survives executor loss without recomputing from raw);
* dimension keys are extended, not recomputed, so keys of existing codes are
  the same in every monthly run;
* all tables of a run are committed at once by a manifest (``sinks.commits``).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import fixed
from farelake.operators.keys import dense_index
from farelake.operators import aggregates as A
from farelake.operators import dims as D
from farelake.operators import facts as FT
from farelake.operators import ingest as IG
from farelake.operators import quality as Q
from farelake.operators import setops as S
from farelake.functions.columns import code_label
from farelake.operators.conform import cast_columns, conform_service
from farelake.session import shared_table
from farelake.sinks import distinct_store as DS
from farelake.sinks import writers as W
from farelake.sinks.commits import Transaction, read_table
from farelake.sources import raw_files as RF
from farelake.sources import readers as RD
from farelake.sources import registry as RG

FILE_NAME_PATTERN = r"_(\d{4})-(\d{2})\.parquet"


def raw_file_path(raw_root: str, service: str, prefix: str, year: int, month: int) -> str:
    return f"{raw_root.rstrip('/')}/{service}/{year}/{prefix}_{year}-{month:02d}.parquet"


def job_raw_to_trusted(spark: SparkSession, raw_root: str, trusted_root: str, years: Sequence[int],
                       months: Sequence[int] = range(1, 13), *,
                       services: Mapping[str, str] = fixed.SERVICE_BY_FILE_PREFIX,
                       fhv_profile: str = "current", max_files: int | None = None, check_data: bool = False,
                       only: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean every wanted monthly file into ``trusted_root/<service>/year=/month=``;
    with ``only``, those of these file names.

    Returns (report, rejects): rows written per service/year/month (read
    back from the written partitions), and the months without a file or whose
    file can't be read.

    A bad footer is found before anything is read. A bad data page ends the
    write of its service (nothing is committed then); only in that case every
    file of the service is decoded once to find the bad ones, and the service is
    written without them. ``check_data`` decodes first in any case.
    """
    report, checks = None, None
    wanted = RF.wanted_files(spark, services, years, months)
    if only is not None:
        wanted = wanted.where(F.col("filename").isin(list(only)))
    for prefix, service in services.items():
        found = RF.logical_files(RF.list_files(spark, f"{raw_root.rstrip('/')}/{service}"))
        found = found.join(F.broadcast(wanted.where(F.col("prefix") == prefix)), ["prefix", "year", "month", "filename"], "left_semi")
        checked = _fixed(RF.footer_faults(spark, found))
        if check_data:
            checked = _fixed(RF.data_faults(spark, checked))
        target = f"{trusted_root.rstrip('/')}/{service}"

        def write(paths: list[str]) -> None:
            cleaned = Q.apply_cleaning(RF.read_raw(spark, paths), service, fhv_profile=fhv_profile)
            W.write_partitioned(cleaned, target, max_files=max_files)

        paths = RF.sound_paths(checked)
        if paths:
            try:
                write(paths)
            except (PySparkException, Py4JJavaError):
                checked = _fixed(RF.data_faults(spark, checked))
                sound = RF.sound_paths(checked)
                if len(sound) == len(paths):
                    raise               # not the fault of a file
                paths = sound
                if paths:
                    write(paths)
        if paths and not RD.is_empty_folder(spark, target):   # files without rows leave nothing
            r = (RD.scan_partitioned(spark, target, years, months).groupBy("year", "month")
                 .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("service_type", F.lit(service)))
            report = r if report is None else report.unionByName(r)
        checks = checked if checks is None else checks.unionByName(checked)
    if report is None:
        report = spark.createDataFrame([], "year int, month int, n_rows bigint, service_type string")
    return report, IG.ingest_rejects(wanted, checks)


def _fixed(checked: DataFrame) -> DataFrame:
    """The files' state as it was found (a row a file): later reads of the rejects
    don't look at the files again."""
    return checked.sparkSession.createDataFrame(checked.collect(), checked.schema)


def trusted_paths(trusted_root: str, services: Sequence[str] = fixed.SERVICE_TYPES) -> dict[str, str]:
    return {s: f"{trusted_root.rstrip('/')}/{s}" for s in services}


def list_partitions(spark: SparkSession, path: str) -> list[str]:
    """The year/month folders of a trusted service (a few dozen names)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return ["/".join(s.getPath().toString().split("/")[-2:]) for s in found or []]


def conform_trusted(spark: SparkSession, trusted_root: str, years=None, months=None,
                    extra_renames: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """Read each service's trusted data (absent services skipped), conform and
    union. Rows keep their raw identity; a layer without it gives that of its
    own files."""
    parts = []
    for service, path in trusted_paths(trusted_root).items():
        if not RD.path_exists(spark, path) or not list_partitions(spark, path):
            continue
        df = RD.scan_partitioned(spark, path, years, months, merge_schema=True)
        if "src_file" not in df.columns:
            df = df.select("*", F.col("_metadata.file_path").alias("src_file"), F.col("_metadata.row_index").alias("src_row"))
        conformed = conform_service(df, service, extra_renames=(extra_renames or {}).get(service),
                                    keep_extra=True)
        # conformed columns, the quality flags (the wide fact keeps them), the file's period, the row's identity
        keep = [f.name for f in fixed.CONFORMED_TRIP_SCHEMA.fields]
        keep += [c for c in ("has_problem", "problem_description", "year", "month", "src_file", "src_row") if c in conformed.columns]
        parts.append(conformed.select(*keep))
    if not parts:
        raise FileNotFoundError(f"no trusted data under {trusted_root}")
    return S.union_by_name(parts)


def job_unify_trips(spark: SparkSession, trusted_root: str, out: str, years=None, months=None) -> None:
    """All services in one schema, full duplicates removed, one table."""
    W.write_table(A.distinct_rows(conform_trusted(spark, trusted_root, years, months).drop("year", "month", "src_file", "src_row")), out,
                  partition_cols=None)


def job_unify_runs(spark: SparkSession, trusted_root: str, out: str, years=None, months=None, buckets: int = DS.BUCKETS) -> DataFrame:
    """``job_unify_trips`` run by run: the rows of the chosen months that no
    earlier run has stored are added, the history is not moved
    (``sinks.distinct_store``). Returns the table."""
    rows = conform_trusted(spark, trusted_root, years, months).drop("year", "month", "src_file", "src_row")
    DS.add_distinct(spark, out, rows, buckets)
    return DS.read_distinct(spark, out)


def _update_coded_dim(tx: Transaction, name: str, trips: DataFrame, code: str, sk: str, label_col: str,
                      labels, default) -> DataFrame:
    codes = trips.select(F.col(code).cast("bigint").alias(code)).where(F.col(code).isNotNull()).distinct()
    named = codes.withColumn(label_col, code_label(code, labels, default))
    return _update_dim(tx, name, named, code, sk, [sk, code, label_col])


def _update_dim(tx: Transaction, name: str, fresh: DataFrame, natural: str, sk: str | None,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Add the rows of ``fresh`` whose natural key is new, numbered behind the
    keys given so far; rows and keys that are there stay, and a table without
    new rows is not written again."""
    existing = tx.read(name)
    top = 0
    if existing is not None:
        fresh = shared_table(fresh.join(existing.select(natural), natural, "left_anti"), name)
        if not fresh.take(1):
            return existing
        top = (existing.agg(F.max(sk)).first()[0] or 0) if sk else 0       # one scalar
    if sk:
        fresh = dense_index(fresh.drop(sk), [natural], sk, start=int(top) + 1)
    columns = columns or ([sk] if sk else []) + [c for c in fresh.columns if c != sk]
    fresh = fresh.select(*columns)
    return tx.stage(name, fresh if existing is None else existing.unionByName(fresh))


def job_trusted_to_dw(spark: SparkSession, trusted_root: str, dw_root: str, years=None, months=None, *,
                      zones: DataFrame | None = None, companies: DataFrame | None = None,
                      licences: DataFrame | None = None, whole: bool = False) -> DataFrame:
    """Conform + union once (staged), dimensions (keys extended), fact by
    year/month (only the months of this run are replaced; with ``whole`` also
    those of ``years`` x ``months`` that have no trips any more), committed together:
    a run that stops on the way leaves the warehouse as it was
    (``sinks.commits``; tables are read by ``read_table``)."""
    dw = dw_root.rstrip("/")
    tx = Transaction(spark, dw)
    trips = shared_table(conform_trusted(spark, trusted_root, years, months), "dw-trips")

    vendor = _update_coded_dim(tx, "dim_vendor", trips, "id_vendor", "sk_vendor", "vendor_description",
                               fixed.VENDOR_LABELS, fixed.VENDOR_DEFAULT)
    payment = _update_coded_dim(tx, "dim_payment_type", trips, "id_payment_type", "sk_payment_type",
                                "payment_type_description", fixed.PAYMENT_LABELS, fixed.PAYMENT_DEFAULT)
    rate = _update_coded_dim(tx, "dim_rate", trips, "id_rate", "sk_ratecode", "ratecode_description",
                             fixed.RATE_LABELS, fixed.RATE_DEFAULT)
    service = _update_dim(tx, "dim_service_type", D.dim_service_type(trips), "id_service_type", "sk_service_type")
    comp = lic = None
    if zones is not None:
        _update_dim(tx, "dim_location", D.dim_location(zones), "id_location", "sk_location")
    if companies is not None:
        comp = _update_dim(tx, "dim_companies_hv", D.dim_companies_hv(companies), "id_hvfhs_license_num", "sk_company_hv")
    if licences is not None:
        lic = _update_dim(tx, "dim_license_number", D.dim_license_number(licences), "id_license_number", "sk_license_number")
    _update_dim(tx, "dim_time", D.dim_time(trips), "sk_time", None)

    # source files are numbered once for all runs, so keys of different runs never meet
    files = _update_dim(tx, "source_files", trips.select("src_file").where("src_file is not null").distinct(), "src_file", "file_no")

    mine = [f"year={y}/month={m}" for y in years or () for m in months or ()] if whole else []
    tx.stage_partitions("fact_taxi_trip", FT.fact_trip(trips, vendor, payment, rate, service, comp, lic, files), instead=mine)
    tx.commit()
    return read_table(spark, dw, "fact_taxi_trip", years, months)


def job_load_changes(spark: SparkSession, raw_root: str, trusted_root: str, dw_root: str, *,
                     services: Mapping[str, str] = fixed.SERVICE_BY_FILE_PREFIX, fhv_profile: str = "current",
                     digest_new: bool = False, **dims) -> DataFrame:
    """Bring trusted layer and warehouse up to the raw files' content; returns the
    files with their ``state`` (``sources.registry``), ``rejected`` those that
    can't be read.

    New and changed files are cleaned again, the month of a file that is gone is
    taken out of the trusted layer, and the fact's months they touch are replaced
    whole: rows of a replaced or deleted file leave the fact. Other files are
    not opened. A file that can't be read stays registered with what it had when it
    could, if ever, so it comes up again; the rows its month had stay until then. The registry is committed last, so a
    run that stops on the way finds the same work again. ``dims`` go to
    ``job_trusted_to_dw``. A raw layer without any readable file is an error.
    """
    trusted, registry = trusted_root.rstrip("/"), f"{trusted_root.rstrip('/')}/_registry"
    found = None
    for service in services.values():
        files = RF.list_files(spark, f"{raw_root.rstrip('/')}/{service}").withColumn("service_type", F.lit(service))
        found = files if found is None else found.unionByName(files)
    logical = RF.logical_files(found)
    registered = RG.read_registry(spark, registry)
    states = RG.file_states(spark, logical, registered, digest_new)
    work = states.where(F.col("state").isin(*RG.TO_DO)).collect()      # a row a file
    replaced = logical.join(F.broadcast(states.where(F.col("state") == RG.CHANGED).select("service_type", "filename")), ["service_type", "filename"], "left_semi")
    checked = RF.data_faults(spark, _fixed(RF.footer_faults(spark, replaced)))
    rejected = [r.filename for r in checked.where("error is not null").select("filename").distinct().collect()]
    for w in work:      # where cleaning leaves nothing of a replaced file, nothing would overwrite its earlier rows
        if w.state != RG.NEW and w.filename not in rejected:
            W.drop_partition(spark, f"{trusted}/{w.service_type}", w.year, w.month)
    load = [w for w in work if w.state != RG.GONE and w.filename not in rejected]
    if load:
        names = [w.filename for w in load]
        _, rejects = job_raw_to_trusted(spark, raw_root, trusted, sorted({w.year for w in load}), sorted({w.month for w in load}),
                                        services=services, fhv_profile=fhv_profile, only=names)
        rejected += sorted({r.filename for r in rejects.collect()} & set(names))
    done = [w for w in work if w.filename not in rejected]
    by_year: dict[int, set[int]] = {}
    for w in done:
        by_year.setdefault(w.year, set()).add(w.month)
    for months in {frozenset(m) for m in by_year.values()}:          # years that change in the same months go together
        job_trusted_to_dw(spark, trusted, dw_root, sorted(y for y, m in by_year.items() if m == months), sorted(months),
                          whole=True, **dims)
    bad = F.col("filename").isin(rejected)
    kept = states.where(~bad & (F.col("state") != RG.GONE)).drop("state")
    RG.write_registry(spark, registry, kept.unionByName(registered.where(bad)))
    return states.withColumn("state", F.when(bad, "rejected").otherwise(F.col("state")))


def job_publish(spark: SparkSession, dw_root: str, url: str, options: Mapping[str, str] | None = None,
                tables: Sequence[str] = ("dim_vendor", "dim_payment_type", "dim_rate", "dim_service_type", "dim_location",
                                         "dim_companies_hv", "dim_license_number", "dim_time", "fact_taxi_trip")) -> DataFrame:
    """Warehouse tables -> JDBC, with a row-count check per table."""
    return W.export_tables(spark, dw_root, tables, url, options)


def job_dedup_publish(df: DataFrame, out: str, casts: Mapping[str, str] | None = None) -> bool:
    """Older short path: drop full duplicates and rows with any null, cast,
    write. Returns False (nothing written) when there is no input row."""
    if RD.is_empty(df):
        return False
    clean = Q.drop_null_rows(A.distinct_rows(df))
    if casts:
        clean = cast_columns(clean, casts)
    W.write_table(clean, out)
    return True


def job_audit(raw: DataFrame, trusted: DataFrame, cols: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Raw vs trusted: counts and % removed, the removed rows (on raw's
    columns, after mapping names), and the flagged rows."""
    cols = list(cols) if cols else [c for c in raw.columns if c in trusted.columns]
    return {"report": A.removed_rows_audit(raw, trusted),
            "removed": S.rows_removed(raw, trusted, cols),
            "flagged": Q.filter_flagged(trusted)}
