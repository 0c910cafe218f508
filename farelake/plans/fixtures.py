"""Trip-shaped views over the driver's test tables (see FIXTURES.md).

Each view exists twice: as a DataFrame builder (what the Spark queries read)
and as SQL text (what the DuckDB oracle reads). They must stay in step.

* T  trips: lineitem + orders + customer + supplier + part
* N  zone lookup: nation + region
* E  trips with a time of day: events
* C  licence / company / SCD2 inputs: customer, supplier
* raw_*  raw-shaped monthly files per service (odd-case names included)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import fixed


def table(spark: SparkSession, d: str, name: str, with_source: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")
    if with_source:
        df = df.select("*", F.col("_metadata.file_path").alias("src_file"),
                       F.col("_metadata.row_index").alias("src_row"))
    return df


def _service_case():
    p = F.col("o_orderpriority")
    return (F.when(p == "1-URGENT", "yellowTaxi").when(p == "2-HIGH", "greenTaxi")
            .when(p == "3-MEDIUM", "forHireVehicle").when(p == "4-NOT SPECIFIED", "highVolumeForHire")
            .otherwise("other"))


def trips(spark: SparkSession, d: str, with_source: bool = False) -> DataFrame:
    """Fixture T. Joins are plain equi-joins: Catalyst prunes every table to
    the few columns used and picks broadcast (by measured size) or
    sort-merge per join. Orders meet their customers first, so that no join on
    the customer moves line items."""
    li = table(spark, d, "lineitem", with_source)
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    p = table(spark, d, "part")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    j = (li.join(oc, li.l_orderkey == o.o_orderkey)
           .join(s, li.l_suppkey == s.s_suppkey)
           .join(p, li.l_partkey == p.p_partkey))
    cols = [
        _service_case().alias("service_type"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("s_nationkey").alias("id_location_pickup"),
        F.col("c_nationkey").alias("id_location_dropoff"),
        (F.col("l_suppkey") % 9).cast("bigint").alias("id_vendor"),
        (F.col("l_linenumber").cast("bigint") - 1).alias("id_payment_type"),
        (F.col("p_size").cast("bigint") % 8).alias("id_rate"),
        (F.col("l_linenumber").cast("bigint") - 2).alias("passenger_count"),
        (F.col("l_quantity") - 3).alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("total_amount"),
    ]
    if with_source:
        cols += [F.col("src_file"), F.col("src_row")]
    return j.select(*cols)


TRIPS_SQL = """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'yellowTaxi' WHEN '2-HIGH' THEN 'greenTaxi'
            WHEN '3-MEDIUM' THEN 'forHireVehicle' WHEN '4-NOT SPECIFIED' THEN 'highVolumeForHire'
            ELSE 'other' END AS service_type,
       o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
       s_nationkey AS id_location_pickup, c_nationkey AS id_location_dropoff,
       CAST(l_suppkey % 9 AS BIGINT) AS id_vendor,
       CAST(l_linenumber AS BIGINT) - 1 AS id_payment_type,
       CAST(p_size AS BIGINT) % 8 AS id_rate,
       CAST(l_linenumber AS BIGINT) - 2 AS passenger_count,
       l_quantity - 3 AS trip_distance, l_extendedprice AS fare_amount,
       l_extendedprice * l_discount AS tip_amount,
       l_extendedprice * (1 + l_tax) AS total_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
"""


def zones(spark: SparkSession, d: str) -> DataFrame:
    """Fixture N in the zone-lookup CSV shape (all text)."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    return j.select(F.col("n_nationkey").cast("string").alias("LocationID"),
                    F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"),
                    F.when(F.col("n_nationkey") % 2 == 0, "Boro Zone").otherwise("Yellow Zone").alias("service_zone"))


ZONES_SQL = """
SELECT CAST(n_nationkey AS VARCHAR) AS LocationID, r_name AS Borough, n_name AS Zone,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""


def dim_location_view(spark: SparkSession, d: str) -> DataFrame:
    """Zone lookup as the warehouse's ``dim_location`` columns (id_location, zone)."""
    z = zones(spark, d)
    return z.select(F.col("LocationID").cast("bigint").alias("id_location"),
                    F.col("Borough").alias("borough"), F.col("Zone").alias("zone"))


DIM_LOCATION_SQL = """
SELECT CAST(n_nationkey AS BIGINT) AS id_location, r_name AS borough, n_name AS zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""


def events_trips(spark: SparkSession, d: str) -> DataFrame:
    """Fixture E: trips with a time of day."""
    e = table(spark, d, "events")
    return e.select(F.col("event_type").alias("service_type"), F.col("ts").alias("pickup_datetime"),
                    (F.col("user_id") % 25).cast("bigint").alias("id_location_pickup"),
                    F.col("value").alias("total_amount"))


EVENTS_SQL = """
SELECT event_type AS service_type, ts AS pickup_datetime,
       CAST(user_id % 25 AS BIGINT) AS id_location_pickup, value AS total_amount
FROM events
"""


def companies(spark: SparkSession, d: str) -> DataFrame:
    """Fixture C, high-volume companies file shape."""
    c = table(spark, d, "customer")
    return c.select(F.concat(F.lit("HV"), F.col("c_custkey").cast("string")).alias("High Volume"),
                    F.lower(F.col("c_mktsegment")).alias("App Company Affiliation"))


COMPANIES_SQL = """
SELECT 'HV' || CAST(c_custkey AS VARCHAR) AS "High Volume", lower(c_mktsegment) AS "App Company Affiliation"
FROM customer
"""


def licences(spark: SparkSession, d: str) -> DataFrame:
    """Fixture C, base licence file shape."""
    s = table(spark, d, "supplier")
    return s.select(F.concat(F.lit("B"), F.col("s_suppkey").cast("string")).alias("LICENSEE NUMBER"),
                    F.col("s_name").alias("NAME OF LICENSEE NORMALIZED"))


LICENCES_SQL = """
SELECT 'B' || CAST(s_suppkey AS VARCHAR) AS "LICENSEE NUMBER", s_name AS "NAME OF LICENSEE NORMALIZED"
FROM supplier
"""


def scd2_current(spark: SparkSession, d: str) -> DataFrame:
    """Fixture C: the open customer dimension (all versions open since 2024-01-01)."""
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("segment"),
                    F.lit("2024-01-01").cast("date").alias("effective_date"),
                    F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"))


SCD2_CURRENT_SQL = """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment,
       DATE '2024-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current
FROM customer
"""


def scd2_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Fixture C: the new snapshot. Keys ending in 0 change segment, in 5 lose
    it (null); suppliers arrive as new keys (negative ids)."""
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    seg = (F.when(F.col("c_custkey") % 10 == 0, F.lower("c_mktsegment"))
           .when(F.col("c_custkey") % 10 == 5, F.lit(None).cast("string"))
           .otherwise(F.col("c_mktsegment")))
    cur = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), seg.alias("segment"))
    new = s.select((-F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"),
                   F.lit("SUPPLIER").alias("segment"))
    return cur.unionByName(new)


SCD2_SNAPSHOT_SQL = """
SELECT c_custkey AS id, c_name AS name,
       CASE WHEN c_custkey % 10 = 0 THEN lower(c_mktsegment)
            WHEN c_custkey % 10 = 5 THEN NULL ELSE c_mktsegment END AS segment
FROM customer
UNION ALL
SELECT -s_suppkey AS id, s_name AS name, 'SUPPLIER' AS segment FROM supplier
"""


def rides(spark: SparkSession, d: str) -> DataFrame:
    """Trips with their customer: service, order and line, pickup, customer, total."""
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        _service_case().alias("service_type"), F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("line_no"), F.col("o_orderdate").alias("pickup_datetime"),
        F.col("o_custkey").alias("customer"), (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("total_amount"))


RIDES_SQL = """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'yellowTaxi' WHEN '2-HIGH' THEN 'greenTaxi' WHEN '3-MEDIUM' THEN 'forHireVehicle'
            WHEN '4-NOT SPECIFIED' THEN 'highVolumeForHire' ELSE 'other' END AS service_type, l_orderkey AS order_no, l_linenumber AS line_no, o_orderdate AS pickup_datetime, o_custkey AS customer,
       l_extendedprice * (1 + l_tax) AS total_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


#: days of the three snapshots of the customer history
HISTORY_DAYS = ("1993-01-01", "1995-06-01", "1997-03-15")


def customer_history(spark: SparkSession, d: str) -> DataFrame:
    """Type-2 history of customers, merged from three snapshots: keys divisible
    by 7 come with the second, by 10 change segment there, by 3 in the third."""
    from farelake.operators.scd2 import scd2_initial, scd2_merge
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    second = c.withColumn("segment", F.when(F.col("id") % 10 == 0, F.lower("segment")).otherwise(F.col("segment")))
    third = second.withColumn("segment", F.when(F.col("id") % 3 == 0, F.concat(F.lit("NEW "), "segment")).otherwise(F.col("segment")))
    first, middle, last = HISTORY_DAYS
    history = scd2_initial(c.where("id % 7 <> 0"), "id", ["segment"], first)
    for day, snap in ((middle, second), (last, third)):
        history = scd2_merge(snap, history, "id", ["segment"], day)
    return history


CUSTOMER_AT_SQL = f"""SELECT r.*, CASE
    WHEN pickup_datetime < DATE '{HISTORY_DAYS[0]}' OR (customer % 7 = 0 AND pickup_datetime < DATE '{HISTORY_DAYS[1]}') THEN NULL
    ELSE (CASE WHEN pickup_datetime >= DATE '{HISTORY_DAYS[2]}' AND customer % 3 = 0 THEN 'NEW ' ELSE '' END)
      || (CASE WHEN pickup_datetime >= DATE '{HISTORY_DAYS[1]}' AND customer % 10 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END)
    END AS customer_segment
  FROM ({RIDES_SQL}) r LEFT JOIN customer ON c_custkey = customer"""


# ---- raw-shaped inputs: aliases of T filtered by service ---------------------

def _flag(col: str) -> str:
    return f"CASE WHEN {col} % 2 = 0 THEN 'Y' ELSE 'N' END"


# further columns of the raw files, as SQL over T that Spark and DuckDB share
MORE_COLUMNS = {
    "yellowTaxi": {"store_and_fwd_flag": _flag("id_payment_type"), "extra": "CAST(passenger_count AS DOUBLE)",
                   "mta_tax": "CAST(id_rate AS DOUBLE)", "tolls_amount": "CAST(id_vendor AS DOUBLE)",
                   "improvement_surcharge": "total_amount", "congestion_surcharge": "trip_distance", "Airport_fee": "fare_amount"},
    "greenTaxi": {"store_and_fwd_flag": _flag("id_rate"), "extra": "CAST(id_vendor AS DOUBLE)",
                  "mta_tax": "CAST(passenger_count AS DOUBLE)", "tolls_amount": "CAST(id_rate AS DOUBLE)", "ehail_fee": "fare_amount",
                  "improvement_surcharge": "trip_distance", "trip_type": "id_vendor", "congestion_surcharge": "total_amount"},
    "forHireVehicle": {},
    "highVolumeForHire": {"originating_base_num": "'B' || CAST(id_vendor AS STRING)", "bcf": "trip_distance", "sales_tax": "total_amount",
                          "congestion_surcharge": "CAST(passenger_count AS DOUBLE)", "airport_fee": "CAST(id_rate AS DOUBLE)",
                          "driver_pay": "fare_amount", "shared_request_flag": _flag("id_payment_type"), "shared_match_flag": _flag("id_rate"),
                          "access_a_ride_flag": _flag("id_vendor"), "wav_request_flag": _flag("id_location_pickup"),
                          "wav_match_flag": _flag("id_location_dropoff")},
}


def raw_service(spark: SparkSession, d: str, service: str) -> DataFrame:
    return raw_from_trips(trips(spark, d), service)


def raw_from_trips(trips_df: DataFrame, service: str, full: bool = False) -> DataFrame:
    """Raw-shaped monthly-file view of one service, from a trips frame; ``full``
    adds its further columns and the row identity where the trips carry it."""
    t = trips_df.where(F.col("service_type") == service)
    if not full:
        return _raw_columns(t, service)
    more = [F.expr(e).alias(f"__{c}") for c, e in MORE_COLUMNS[service].items()]
    source = [c for c in ("src_file", "src_row") if c in t.columns]
    base = _raw_columns(t, service).columns
    wide = _raw_columns(t.select("*", *more), service, [f"__{c}" for c in MORE_COLUMNS[service]] + source)
    return wide.toDF(*base, *MORE_COLUMNS[service], *source)


def _raw_columns(t: DataFrame, service: str, more=()) -> DataFrame:
    if service in ("yellowTaxi", "greenTaxi"):
        p = "tpep" if service == "yellowTaxi" else "lpep"
        return t.select(F.col("id_vendor").alias("VendorID"),
                        F.col("pickup_datetime").alias(f"{p}_pickup_datetime"),
                        F.col("dropoff_datetime").alias(f"{p}_dropoff_datetime"),
                        F.col("passenger_count").cast("double").alias("passenger_count"),
                        "trip_distance", F.col("id_rate").cast("double").alias("RatecodeID"),
                        F.col("id_location_pickup").alias("PULocationID"),
                        F.col("id_location_dropoff").alias("DOLocationID"),
                        F.col("id_payment_type").alias("payment_type"),
                        "fare_amount", "tip_amount", "total_amount", *more)
    if service == "forHireVehicle":
        return t.select(F.concat(F.lit("B"), F.col("id_vendor").cast("string")).alias("dispatching_base_num"),
                        "pickup_datetime", F.col("dropoff_datetime").alias("dropOff_datetime"),
                        F.col("id_location_pickup").cast("double").alias("PUlocationID"),
                        F.col("id_location_dropoff").cast("double").alias("DOlocationID"),
                        F.when(F.col("id_payment_type") % 2 == 0, F.lit(None)).otherwise(F.lit(1))
                         .cast("int").alias("SR_Flag"),
                        F.concat(F.lit("B"), F.col("id_vendor").cast("string")).alias("Affiliated_base_number"), *more)
    return t.select(F.concat(F.lit("HV"), F.col("id_vendor").cast("string")).alias("hvfhs_license_num"),
                    "pickup_datetime", "dropoff_datetime",
                    F.col("id_location_pickup").alias("PULocationID"),
                    F.col("id_location_dropoff").alias("DOLocationID"),
                    F.col("trip_distance").alias("trip_miles"),
                    F.timestamp_diff("SECOND", F.col("pickup_datetime"), F.col("dropoff_datetime")).alias("trip_time"),
                    F.col("fare_amount").alias("base_passenger_fare"), F.col("tip_amount").alias("tips"), *more)


def raw_service_sql(service: str, full: bool = False) -> str:
    base = f"(SELECT * FROM ({TRIPS_SQL}) WHERE service_type = '{service}')"
    more = "".join(f", {e} AS {c}" for c, e in MORE_COLUMNS[service].items()) if full else ""
    if service in ("yellowTaxi", "greenTaxi"):
        p = "tpep" if service == "yellowTaxi" else "lpep"
        return f"""SELECT id_vendor AS VendorID, pickup_datetime AS {p}_pickup_datetime,
            dropoff_datetime AS {p}_dropoff_datetime, CAST(passenger_count AS DOUBLE) AS passenger_count,
            trip_distance, CAST(id_rate AS DOUBLE) AS RatecodeID, id_location_pickup AS PULocationID,
            id_location_dropoff AS DOLocationID, id_payment_type AS payment_type,
            fare_amount, tip_amount, total_amount{more} FROM {base}"""
    if service == "forHireVehicle":
        return f"""SELECT 'B' || CAST(id_vendor AS VARCHAR) AS dispatching_base_num, pickup_datetime,
            dropoff_datetime AS dropOff_datetime, CAST(id_location_pickup AS DOUBLE) AS PUlocationID,
            CAST(id_location_dropoff AS DOUBLE) AS DOlocationID,
            CAST(CASE WHEN id_payment_type % 2 = 0 THEN NULL ELSE 1 END AS INTEGER) AS SR_Flag,
            'B' || CAST(id_vendor AS VARCHAR) AS Affiliated_base_number{more} FROM {base}"""
    return f"""SELECT 'HV' || CAST(id_vendor AS VARCHAR) AS hvfhs_license_num, pickup_datetime, dropoff_datetime,
        id_location_pickup AS PULocationID, id_location_dropoff AS DOLocationID, trip_distance AS trip_miles,
        date_diff('second', pickup_datetime, dropoff_datetime) AS trip_time,
        fare_amount AS base_passenger_fare, tip_amount AS tips{more} FROM {base}"""


def conformed_sql(service: str, name: str) -> str:
    """Select item of a conformed column from the further raw columns: null
    where the service lacks it."""
    field = fixed.CONFORMED_TRIP_SCHEMA[name]
    kind = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR"}[field.dataType.simpleString()]
    raw = {fixed.CONFORM_RENAMES.get(c, c).lower(): c for c in MORE_COLUMNS[service]}
    return f"CAST({raw.get(name, 'NULL')} AS {kind}) AS {name}"


NEW_FIELDS = [f.name for f in fixed.CONFORMED_TRIP_SCHEMA.fields][19:]


def new_fields_sql(service: str) -> str:
    return ", ".join(conformed_sql(service, n) for n in NEW_FIELDS)


# ---- raw layer: monthly files, some of them faulty ------------------------------

def write_raw_layer(spark: SparkSession, d: str, root: str, faults: bool = True,
                    services=fixed.SERVICE_BY_FILE_PREFIX) -> None:
    """Monthly raw files of every service and month of the trips, in folders of
    their names. With ``faults``: yellow's first file is truncated, green's last
    one has a broken page, for-hire's first month has no file."""
    from farelake.sources.raw_files import list_files, logical_files
    from farelake.session import shared_table
    t = shared_table(trips(spark, d), "trips")
    for prefix, service in services.items():
        raw = raw_from_trips(t, service)
        ts = F.col(next(c for c in raw.columns if c.lower().endswith("pickup_datetime")))
        raw = raw.withColumns({"year": F.year(ts), "file": F.concat(F.lit(f"{prefix}_"), F.date_format(ts, "yyyy-MM"), F.lit(".parquet"))})
        if faults and service == "forHireVehicle":
            first = raw.agg(F.min("file").alias("f")).first()["f"]
            raw = raw.where(F.col("file") != first)
        raw.repartition(16, "file").write.partitionBy("year", "file").parquet(f"{root}/{service}")
    if faults:
        for service, last in (("yellowTaxi", False), ("greenTaxi", True)):
            files = logical_files(list_files(spark, f"{root}/{service}")).orderBy(F.desc("filename") if last else "filename")
            damage(spark, files.first()["path"], "page" if last else "tail")


def damage(spark: SparkSession, path: str, where: str) -> None:
    """Cut a Parquet file's tail off, or flip bytes in the middle of its pages."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(p)
    data = bytearray(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    stream.close()
    if where == "tail":
        data = data[:len(data) // 2]
    else:
        pages = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
        for i in range(pages // 2, min(pages // 2 + 16, pages)):
            data[i] ^= 0xA5
    out = fs.create(p, True)
    out.write(data)
    out.close()


_FILE_OF = "CASE service_type " + " ".join(f"WHEN '{s}' THEN '{p}'" for p, s in fixed.SERVICE_BY_FILE_PREFIX.items()) + " END"

#: (service_type, ym, error) of the months of the trips whose file is faulty
RAW_FAULTS_SQL = f"""SELECT service_type, CASE service_type WHEN 'greenTaxi' THEN max(year(pickup_datetime) * 100 + month(pickup_datetime))
      ELSE min(year(pickup_datetime) * 100 + month(pickup_datetime)) END AS ym,
    CASE service_type WHEN 'greenTaxi' THEN 'unreadable data' WHEN 'yellowTaxi' THEN 'unreadable footer' ELSE 'file not found' END AS error
  FROM ({TRIPS_SQL}) WHERE service_type IN ('greenTaxi', 'yellowTaxi', 'forHireVehicle') GROUP BY service_type"""

RAW_REJECTS_SQL = f"""WITH t AS ({TRIPS_SQL}),
there AS (SELECT DISTINCT service_type, year(pickup_datetime) * 100 + month(pickup_datetime) AS ym FROM t),
grid AS (SELECT service_type, y, m, y * 100 + m AS ym FROM (SELECT DISTINCT service_type FROM t WHERE service_type <> 'other'),
  (SELECT unnest(generate_series(min(year(pickup_datetime)), max(year(pickup_datetime)))) AS y FROM t),
  (SELECT unnest(generate_series(1, 12)) AS m))
SELECT g.service_type, CAST(y AS VARCHAR) AS year, {_FILE_OF.replace('service_type', 'g.service_type')} || printf('_%d-%02d.parquet', y, m) AS filename,
  COALESCE(f.error, 'file not found') AS error
FROM grid g LEFT JOIN there ON there.service_type = g.service_type AND there.ym = g.ym
LEFT JOIN ({RAW_FAULTS_SQL}) f ON f.service_type = g.service_type AND f.ym = g.ym
WHERE there.ym IS NULL OR f.ym IS NOT NULL"""
