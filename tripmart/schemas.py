"""Data model of the trip pipeline: expected columns, enumerations, names.

Everything below the "fixed values" marker must equal the values of the
pipeline this package re-implements, or the checks, renames and outputs
would differ. They are kept together, in their natural order, as text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Expected raw trip columns with the SQL type a value must be castable to.
TRIP_SPEC: list[tuple[str, str]] = [
    ("VendorID", "INT"),
    ("tpep_pickup_datetime", "TIMESTAMP"),
    ("tpep_dropoff_datetime", "TIMESTAMP"),
    ("passenger_count", "BIGINT"),
    ("trip_distance", "DOUBLE"),
    ("RatecodeID", "BIGINT"),
    ("store_and_fwd_flag", "STRING"),
    ("PULocationID", "INT"),
    ("DOLocationID", "INT"),
    ("payment_type", "BIGINT"),
    ("fare_amount", "DOUBLE"),
    ("extra", "DOUBLE"),
    ("mta_tax", "DOUBLE"),
    ("tip_amount", "DOUBLE"),
    ("tolls_amount", "DOUBLE"),
    ("improvement_surcharge", "DOUBLE"),
    ("total_amount", "DOUBLE"),
    ("congestion_surcharge", "DOUBLE"),
    ("airport_fee", "DOUBLE"),
    ("cbd_congestion_fee", "DOUBLE"),
]

# Trip string columns whose blanks become NULL before any check.
TRIP_BLANK_COLUMNS: list[str] = ["store_and_fwd_flag"]

# Domain enumerations.
VALID_VENDORS: tuple[int, ...] = (1, 2, 6, 7)
VALID_RATE_CODES: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 99)
VALID_PAYMENT_TYPES: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 6)
VALID_STORE_FLAGS: tuple[str, ...] = ("Y", "N")

# Amount columns that must be >= 0 when present (both airport spellings).
AMOUNT_COLUMNS: list[str] = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
    "airport_fee", "Airport_fee", "cbd_congestion_fee",
]

# A trip longer than this many seconds fails the duration check.
MAX_TRIP_SECONDS: int = 24 * 3600

# Raw zone lookup: four string columns, all read as text.
ZONE_COLUMNS: list[str] = ["LocationID", "Borough", "Zone", "service_zone"]

# Bronze -> silver column names (others keep their name).
SILVER_RENAMES: dict[str, str] = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "Airport_fee": "airport_fee",
}

# Silver trip columns and their enforced types.
SILVER_TYPES: list[tuple[str, str]] = [
    ("vendor_id", "INT"),
    ("pickup_datetime", "TIMESTAMP"),
    ("dropoff_datetime", "TIMESTAMP"),
    ("passenger_count", "INT"),
    ("trip_distance", "DOUBLE"),
    ("rate_code_id", "INT"),
    ("store_and_fwd_flag", "STRING"),
    ("pu_location_id", "INT"),
    ("do_location_id", "INT"),
    ("payment_type", "INT"),
    ("fare_amount", "DOUBLE"),
    ("extra", "DOUBLE"),
    ("mta_tax", "DOUBLE"),
    ("tip_amount", "DOUBLE"),
    ("tolls_amount", "DOUBLE"),
    ("improvement_surcharge", "DOUBLE"),
    ("total_amount", "DOUBLE"),
    ("congestion_surcharge", "DOUBLE"),
    ("airport_fee", "DOUBLE"),
    ("cbd_congestion_fee", "DOUBLE"),
]

# Curated silver column order (42 columns).
SILVER_ORDER: list[str] = [
    "ride_id", "vendor_id", "pickup_datetime", "dropoff_datetime",
    "pickup_date", "pickup_hour", "pickup_day_of_week", "pickup_year",
    "pickup_week_of_year", "pickup_week_start", "pickup_week_id",
    "passenger_count", "trip_distance", "trip_minutes", "trip_hours",
    "rate_code_id", "store_and_fwd_flag",
    "pu_location_id", "pu_borough", "pu_zone", "pu_service_zone",
    "do_location_id", "do_borough", "do_zone", "do_service_zone",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    "revenue_per_mile", "revenue_per_minute", "trip_mph",
    "is_peak_hour", "is_night", "is_weekend",
]

# ride_id is the SHA-256 of these parts joined by RIDE_ID_SEPARATOR.
RIDE_ID_SEPARATOR: str = "::"
RIDE_ID_TIME_FORMAT: str = "yyyy-MM-dd'T'HH:mm:ss"

# Week id text: calendar year and ISO week.
WEEK_ID_FORMAT: str = "%04d-W%02d"

# Hour flags. Silver: peak 7-8 and 17-18, night from 20:00 to 05:59.
PEAK_HOUR_RANGES: list[tuple[int, int]] = [(7, 8), (17, 18)]
SILVER_NIGHT_FROM_HOUR: int = 20
SILVER_NIGHT_BEFORE_HOUR: int = 6
# Gold fallback when silver flags are absent: peak hours, night 22-23 and 0-5.
GOLD_PEAK_HOURS: tuple[int, ...] = (7, 8, 17, 18)
GOLD_NIGHT_RANGES: list[tuple[int, int]] = [(22, 23), (0, 5)]

# Gold needs these silver columns.
GOLD_REQUIRED: list[str] = [
    "pickup_week_id", "pickup_week_start", "pu_borough",
    "pickup_datetime", "trip_minutes", "trip_distance", "total_amount",
]
UNKNOWN_BOROUGH: str = "UNKNOWN"

# Gold KPI columns in output order.
KPI_ORDER: list[str] = [
    "pickup_week_id", "pickup_week_start", "pu_borough", "weekly_trips",
    "weekly_revenue", "sum_trip_distance", "avg_trip_distance_miles",
    "avg_trip_time_minutes", "peak_hour_trips", "peak_hour_pct",
    "night_trips", "night_trip_pct", "avg_revenue_per_mile",
]

# KPI columns that get their own preview slice.
KPI_SLICES: list[str] = [
    "weekly_trips", "weekly_revenue", "peak_hour_pct", "night_trip_pct",
    "avg_revenue_per_mile",
]
PREVIEW_ROWS: int = 500
SAMPLE_ROWS: int = 20
TOP_ROWS: int = 10
LAYER_SAMPLE_ROWS: int = 5000

# Folders of the layers' outputs: zone job, trip job, silver, previews.
ZONES_DIR: str = "full_dq_checked"
ZONE_SUMMARY_DIR: str = "run_summary_parquet"
ZONE_NULLS_DIR: str = "null_summary_parquet"
SPLIT_DIRS: dict[str, str] = {"pass": "pass", "reject": "_rejects", "indeterminate": "_indeterminate"}
RUN_SUMMARY_DIRS: dict[str, str] = {
    "_run_summary_counts": "counts",
    "_run_summary_nulls": "nulls",
    "_run_summary_checks": "checks",
    "_run_summary_domain_range": "domain_range",
}
RUN_SUMMARY_ALL_DIR: str = "_run_summary_all"
METRIC_STATE_DIR = "_metric_state"
CURATED_DIR: str = "curated"
WEEKLY_DIR: str = "_run_summary_weekly"
FULL_PREVIEW: str = "full_kpis"

# Pass rate text format; a check that saw no decided row has rate 1.0.
PASS_RATE_FORMAT: str = "%.6f"

# ---------------------------------------------------------------------------
# Spark schemas derived from the values above
# ---------------------------------------------------------------------------

ZONE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in ZONE_COLUMNS])

# Unified long metric table of the trip job.
METRIC_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("pass_count", T.LongType(), True),
    T.StructField("fail_count", T.LongType(), True),
    T.StructField("pass_rate", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("run_ts", T.TimestampType(), True),
])

# Metric table of the zone job and of the null-percentage helpers.
SIMPLE_METRIC_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("run_ts", T.TimestampType(), True),
])

CHECK_PREFIX = "chk_"
TYPE_CHECK_SUFFIX = "_type_ok"
DQ_PASS = "dq_pass"
DQ_STATUS = "dq_status"
