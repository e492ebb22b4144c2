"""Column layouts, names and codes of the record files.

Everything under a "fixed values" comment is a published format that results must agree with.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}


def _layout(columns: str) -> T.StructType:
    """``name TYPE, ...`` as a schema of nullable fields, without needing a session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[t], True) for name, t in pairs])


# --- fixed values: raw layouts -------------------------------------------------------------
YELLOW_RAW = _layout(
    "vendor_id INT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, "
    "passenger_count INT, trip_distance DOUBLE, ratecode_id INT, store_and_fwd_flag STRING, "
    "pu_location_id INT, do_location_id INT, payment_type INT, fare_amount DOUBLE, extra DOUBLE, "
    "mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE, improvement_surcharge DOUBLE, "
    "total_amount DOUBLE, congestion_surcharge DOUBLE, airport_fee DOUBLE, cbd_congestion_fee DOUBLE"
)
GREEN_RAW = _layout(
    "vendor_id INT, lpep_pickup_datetime TIMESTAMP, lpep_dropoff_datetime TIMESTAMP, "
    "store_and_fwd_flag STRING, ratecode_id INT, pu_location_id INT, do_location_id INT, "
    "passenger_count INT, trip_distance DOUBLE, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, "
    "tip_amount DOUBLE, tolls_amount DOUBLE, ehail_fee DOUBLE, improvement_surcharge DOUBLE, "
    "total_amount DOUBLE, payment_type INT, trip_type INT, congestion_surcharge DOUBLE, "
    "cbd_congestion_fee DOUBLE"
)
RAW_SCHEMAS = {"yellow": YELLOW_RAW, "green": GREEN_RAW}

# --- fixed values: landing name -> raw name --------------------------------------------------
RENAMES = {
    "yellow": {
        "VendorID": "vendor_id",
        "RatecodeID": "ratecode_id",
        "PULocationID": "pu_location_id",
        "DOLocationID": "do_location_id",
        "Airport_fee": "airport_fee",
    },
    "green": {
        "VendorID": "vendor_id",
        "RatecodeID": "ratecode_id",
        "PULocationID": "pu_location_id",
        "DOLocationID": "do_location_id",
    },
}

# --- fixed values: raw name -> clean name ----------------------------------------------------
CLEAN_RENAMES = {
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
    },
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
    },
}

# --- fixed values: clean layout, in order ------------------------------------------------------
CLEAN = _layout(
    "taxi_type STRING, vendor_id INT, pickup_datetime TIMESTAMP, dropoff_datetime TIMESTAMP, "
    "trip_duration_minutes DOUBLE, passenger_count INT, trip_distance DOUBLE, ratecode_id INT, "
    "store_and_fwd_flag STRING, pu_location_id INT, do_location_id INT, payment_type INT, "
    "trip_type INT, fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE, "
    "tolls_amount DOUBLE, ehail_fee DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE, "
    "congestion_surcharge DOUBLE, cbd_congestion_fee DOUBLE, airport_fee DOUBLE"
)
PROVENANCE = _layout(
    "source_dataset STRING, source_file STRING, source_year INT, source_month INT, "
    "ingestion_timestamp STRING"
)
NARROW_COLUMNS = [
    "taxi_type",
    "pickup_datetime",
    "pu_location_id",
    "dropoff_datetime",
    "trip_duration_minutes",
    "do_location_id",
    "trip_distance",
    "passenger_count",
    "ratecode_id",
    "is_extreme_trip_distance",
    "is_extreme_trip_duration",
]

# --- fixed values: file names and month words ------------------------------------------------
FILE_PATTERNS = {
    "yellow": r"^Yellow Taxi Data ([A-Za-z]+) (\d{4})\.parquet$",
    "green": r"^Green Trip Data ([A-Za-z]+) (\d{4})\.parquet$",
}
MONTH_WORDS = ["jan", "feb", "mar", "apr", "may", "june", "july", "aug", "sept", "oct", "nov", "dec"]

# --- fixed values: valid codes -----------------------------------------------------------------
VENDOR_CODES = {"yellow": (1, 2, 6, 7), "green": (1, 2, 6)}
RATECODE_CODES = (1, 2, 3, 4, 5, 6, 99)
PAYMENT_CODES = (0, 1, 2, 3, 4, 5, 6)
FLAG_CODES = ("Y", "N")
TRIP_TYPE_CODES = (1, 2)

# --- fixed values: place range, periods, windows -----------------------------------------------
PLACE_RANGE = (1, 265)
PLACEHOLDER_PLACES = (264, 265)
PERIOD_START = "2024-01-01 00:00:00"
PERIOD_END = "2026-06-01 00:00:00"
TRAIN_END = "2026-01-01 00:00:00"
VALIDATION_START = "2025-11-01 00:00:00"
WINDOW_WEEKS = 8
MIN_NONZERO_WEEKS = 8

# --- fixed values: side tables ---------------------------------------------------------------------
ZONE_LOOKUP = _layout("LocationID INT, Borough STRING, Zone STRING, service_zone STRING")
WEATHER_RAW = _layout(
    "station STRING, valid STRING, tmpf STRING, dwpf STRING, relh STRING, sknt STRING, gust STRING, "
    "vsby STRING, p01i STRING, skyc1 STRING, wxcodes STRING"
)
WEATHER_READINGS = ["tmpf", "dwpf", "relh", "sknt", "gust", "vsby", "p01i"]
WEATHER_CLEAN = _layout(
    "date_hour TIMESTAMP, tmpf DOUBLE, dwpf DOUBLE, relh DOUBLE, sknt DOUBLE, gust DOUBLE, "
    "vsby DOUBLE, p01i DOUBLE, skyc1 STRING, wxcodes STRING, weather_severity STRING"
)
HOLIDAYS_RAW = _layout("Date STRING, Holiday STRING")
GEOCODES = _layout("location_key STRING, borough STRING, lat DOUBLE, lon DOUBLE")
EVENT_COLUMNS = [
    "event_id",
    "event_name",
    "start_date_time",
    "end_date_time",
    "event_borough",
    "event_location",
]
