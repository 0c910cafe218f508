"""Fixed values, layer schemas and conform maps.

Everything under "Fixed values" must equal what the trip-record pipeline this
library re-implements uses, or results (labels, keys, file layouts) differ.
They are stated plainly, in their natural order, as data — the operators read
them from here and never restate them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the original pipeline's outputs)
# ---------------------------------------------------------------------------

# Monthly file prefix -> service type folder / label.
SERVICE_BY_FILE_PREFIX = {
    "fhv_tripdata": "forHireVehicle",
    "green_tripdata": "greenTaxi",
    "yellow_tripdata": "yellowTaxi",
    "fhvhv_tripdata": "highVolumeForHire",
}

# Known service types, in the order the dashboards list them.
SERVICE_TYPES = ["yellowTaxi", "greenTaxi", "forHireVehicle", "highVolumeForHire"]

# Monthly dataset file name: prefix, 4-digit year, 2-digit month.
DATASET_FILE_PATTERN = r"(fhv_tripdata|green_tripdata|yellow_tripdata|fhvhv_tripdata)_(\d{4})-(\d{2})\.parquet"

# Payment codes joined onto yellow/green trips in the trusted layer.
TRUSTED_PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# Warehouse dimension labels: code -> text, with the default for other codes.
VENDOR_LABELS = {
    1: "Creative Mobile Technologies, LLC",
    2: "Curb Mobility, LLC",
    6: "Myle Technologies Inc",
    7: "Helix",
}
VENDOR_DEFAULT = "Unknown"

PAYMENT_LABELS = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT = "Other"

RATE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/unknown",
}
RATE_DEFAULT = "Other"

# service -> (description, category, regulation body)
SERVICE_LABELS = {
    "yellowTaxi": ("Yellow Taxi", "Taxi", "TLC"),
    "greenTaxi": ("Green Taxi", "Taxi", "TLC"),
    "forHireVehicle": ("For-Hire Vehicle (FHV)", "For-Hire", "Empresas Privadas"),
    "highVolumeForHire": ("High-Volume For-Hire Vehicle", "For-Hire", "Empresas Privadas"),
}
SERVICE_DEFAULT = "Desconhecido"

# Older static dimensions.
STATIC_RATECODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]
STATIC_TRIP_TYPES = [(1, "Street-hail"), (2, "Dispatch")]

# Dashboard translations and display orders (Portuguese UI).
WEEKDAY_PT = {
    "Monday": "Segunda-feira",
    "Tuesday": "Terça-feira",
    "Wednesday": "Quarta-feira",
    "Thursday": "Quinta-feira",
    "Friday": "Sexta-feira",
    "Saturday": "Sábado",
    "Sunday": "Domingo",
}
WEEKDAY_ORDER_PT = [
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado", "Domingo",
]
MONTH_ABBR_PT = {
    1: "Jan", 2: "Fev", 3: "Mar", 4: "Abr", 5: "Mai", 6: "Jun",
    7: "Jul", 8: "Ago", 9: "Set", 10: "Out", 11: "Nov", 12: "Dez",
}
# season index = month % 12 // 3 + 1 -> dashboard label (southern-hemisphere names)
SEASON_INDEX_PT = {1: "Verão", 2: "Outono", 3: "Inverno", 4: "Primavera"}
DIMENSION_LABEL_MONTH = "Mês"
DIMENSION_LABEL_WEEKDAY = "Dia da Semana"

# Northern-hemisphere season names used by the warehouse time dimension.
SEASON_NORTH = ("Winter", "Spring", "Summer", "Fall")

MILES_TO_KM = 1.60934          # trusted layer factor, unrounded
MILES_TO_KM_PROFILE = 1.609    # profiling factor, rounded to 2 digits

INVALID_LOCATION_REASON = "invalid PULocationID or DOLocationID"

# Raw -> conformed column names (matched case-insensitively).
CONFORM_RENAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
    "PULocationID": "id_location_pickup",
    "DOLocationID": "id_location_dropoff",
    "RatecodeID": "id_rate",
    "VendorID": "id_vendor",
    "originating_base_num": "originating_base_number",
    "payment_type": "id_payment_type",
    "Affiliated_base_number": "id_license_number",
    "hvfhs_license_num": "id_hvfhs_license_num",
}

# Fact table columns, in published order.
FACT_COLUMNS = [
    "sk_trip", "fk_payment_type", "fk_ratecode", "fk_vendor", "fk_service_type",
    "service_type", "fk_license_number", "fk_company_hv", "pickup_datetime",
    "pickup_date", "dropoff_datetime", "dropoff_date", "id_location_pickup",
    "id_location_dropoff", "passenger_count", "trip_distance", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "total_amount",
    "year", "month",
]

# ---------------------------------------------------------------------------
# Layer schemas (ours)
# ---------------------------------------------------------------------------

# Conformed trip schema: every service is brought to these columns.
CONFORMED_TRIP_SCHEMA = T.StructType([
    T.StructField("service_type", T.StringType()),
    T.StructField("pickup_datetime", T.TimestampNTZType()),
    T.StructField("dropoff_datetime", T.TimestampNTZType()),
    T.StructField("id_location_pickup", T.LongType()),
    T.StructField("id_location_dropoff", T.LongType()),
    T.StructField("id_vendor", T.LongType()),
    T.StructField("id_payment_type", T.LongType()),
    T.StructField("id_rate", T.LongType()),
    T.StructField("trip_type", T.LongType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("id_license_number", T.StringType()),
    T.StructField("id_hvfhs_license_num", T.StringType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("ehail_fee", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
    T.StructField("sales_tax", T.DoubleType()),
    T.StructField("bcf", T.DoubleType()),
    T.StructField("driver_pay", T.DoubleType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("shared_request_flag", T.StringType()),
    T.StructField("shared_match_flag", T.StringType()),
    T.StructField("access_a_ride_flag", T.StringType()),
    T.StructField("wav_request_flag", T.StringType()),
    T.StructField("wav_match_flag", T.StringType()),
    T.StructField("originating_base_number", T.StringType()),
])

PAYMENT_SCHEMA = T.StructType([
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("payment_type_description", T.StringType()),
])

ZONE_SCHEMA = T.StructType([
    T.StructField("LocationID", T.StringType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])
