"""Files in and out: month files with drifting layouts, typed CSV, partitioned layers, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, externals
from ..session import stage, staging_path
from ..sources import dimensions, landing, reports, tables

from . import tables as t
from .cleaning_queries import audited, trip_rules
from .registry import query

# Landing files are per month; the lines are spread over these.
MONTHS = {"Jan": 1, "Feb": 2, "June": 6, "Sept": 9}


def landing_folder(spark, sf_dir) -> str:
    """Order lines written as month files whose layouts differ, as downloads do.

    Early files have whole-number codes; later ones have fractional codes, another letter case of a
    name and one more column.
    """
    lines = t.load(spark, sf_dir, "lineitem")
    folder = staging_path(spark, "landing")
    numbers = list(MONTHS.values())
    bucket = F.element_at(
        F.array(*[F.lit(m) for m in numbers]), (F.month("l_shipdate") % len(numbers) + 1).cast("int")
    )
    early = [
        F.col("l_linenumber").cast("long").alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        (F.col("l_suppkey") % 265 + 1).alias("PULocationID"),
        F.col("l_extendedprice").alias("fare_amount"),
    ]
    late = [
        F.col("l_linenumber").cast("double").alias("VendorID"),
        *early[1:4],
        (F.col("l_suppkey") % 265 + 1).cast("int").alias("PULocationID"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_tax").alias("Airport_fee"),
        F.col("l_discount").alias("cbd_congestion_fee"),
    ]
    for word, number in MONTHS.items():
        columns = early if number < 6 else late
        month = lines.where(bucket == number).select(*columns)
        _named_files(spark, month, folder, f"Yellow Taxi Data {word} 2025.parquet")
    return folder


def _named_files(spark, df, folder: str, name: str) -> None:
    """Written files under the published name of a download, one folder per file."""
    written = staging_path(spark, "download")
    df.write.parquet(written)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [s.getPath() for s in fs.listStatus(path(written))]
    for i, part in enumerate(p for p in parts if p.getName().startswith("part-")):
        target = f"{folder}/{name.split('.')[0].replace(' ', '-')}-{i}"
        fs.mkdirs(path(target))
        fs.rename(part, path(f"{target}/{name}"))


_MONTH_SQL = "list_extract([1, 2, 6, 9], CAST(month(l_shipdate) % 4 + 1 AS INT))"
_FILE_SQL = f"""CASE {_MONTH_SQL} {' '.join(f"WHEN {n} THEN 'Yellow Taxi Data {w} 2025.parquet'" for w, n in MONTHS.items())} END"""
_RAW_SQL = f"""
raw AS (
  SELECT l_linenumber AS vendor_id, l_shipdate AS pickup, l_quantity AS trip_distance,
    CAST(l_suppkey % 265 + 1 AS INT) AS pu_location_id, l_extendedprice AS fare_amount,
    CASE WHEN m >= 6 THEN l_tax END AS airport_fee, CASE WHEN m >= 6 THEN l_discount END AS cbd_congestion_fee,
    CAST(NULL AS INT) AS passenger_count, f AS source_file, 2025 AS source_year, CAST(m AS INT) AS source_month
  FROM (SELECT *, {_MONTH_SQL} AS m, {_FILE_SQL} AS f FROM lineitem)
)"""
RAW_COLUMNS = [
    "vendor_id", "trip_distance", "pu_location_id", "fare_amount", "airport_fee", "cbd_congestion_fee",
    "passenger_count", "source_file", "source_year", "source_month",
]


@query(
    f"WITH {_RAW_SQL} SELECT {', '.join(RAW_COLUMNS)}, {t.text_sql('pickup', 'tpep_pickup_datetime')} FROM raw"
)
def drift_union(spark, sf_dir):
    raw = landing.read_landing(spark, "yellow", landing_folder(spark, sf_dir), "now")
    return raw.select(*RAW_COLUMNS, t.text("tpep_pickup_datetime"))


@query(
    f"""WITH {_RAW_SQL}
SELECT 'yellow' AS taxi_type, source_file, source_year AS year, source_month AS month, count(*) AS landing_row_count,
  count(*) AS raw_row_count, CASE WHEN source_month < 6 THEN 6 ELSE 8 END AS landing_column_count,
  20 AS raw_column_count, 'ok' AS status
FROM raw GROUP BY ALL"""
)
def ingest_log(spark, sf_dir):
    folder = landing_folder(spark, sf_dir)
    found = landing.layouts(spark, "yellow", folder)
    raw = landing.read_landing(spark, "yellow", folder, "now", found)
    log = landing.ingest_log(landing.landing_profile(spark, "yellow", folder, found), raw, "yellow")
    return log.select(
        "taxi_type", "source_file", "year", "month", "landing_row_count", "raw_row_count",
        "landing_column_count", "raw_column_count", "status",
    )


@query(
    f"""WITH {_RAW_SQL}
SELECT k AS taxi_type, count(*) AS landing_rows, count(*) AS raw_rows, 6 AS min_columns, 8 AS max_columns,
  CAST(0 AS BIGINT) AS mismatching_files FROM raw CROSS JOIN (SELECT unnest(['yellow', 'combined']) AS k) GROUP BY 1"""
)
def ingest_totals(spark, sf_dir):
    folder = landing_folder(spark, sf_dir)
    found = landing.layouts(spark, "yellow", folder)
    raw = landing.read_landing(spark, "yellow", folder, "now", found)
    log = landing.ingest_log(landing.landing_profile(spark, "yellow", folder, found), raw, "yellow")
    return landing.ingest_totals(log)


@query(
    f"""WITH {_RAW_SQL}
SELECT source_month, count(*) AS n, {t.rnd_sql('sum(fare_amount)', 2)} AS fares FROM raw
WHERE pickup >= TIMESTAMP '1998-01-01' AND pickup < TIMESTAMP '1999-01-01' AND source_month >= 6 GROUP BY 1"""
)
def file_scan_with_period(spark, sf_dir):
    """Raw layer written by partition, then scanned with pruned folders and a pushed period."""
    path = staging_path(spark, "raw")
    tables.write_raw(landing.read_landing(spark, "yellow", landing_folder(spark, sf_dir), "now"), path)
    raw = tables.read_table(spark, path, kind="yellow").where(F.col("source_month") >= 6)
    year = tables.between_times(raw, "tpep_pickup_datetime", "1998-01-01 00:00:00", "1999-01-01 00:00:00")
    return year.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n"), t.rnd(F.sum("fare_amount"), 2).alias("fares")
    )


@query(
    f"""WITH {t.AUDIT_SQL}
SELECT taxi_type, CAST(year(pickup_datetime) AS INT) AS source_year, CAST(month(pickup_datetime) AS INT) AS source_month,
  count(*) AS n, CAST(sum(order_key) AS BIGINT) AS keys FROM clean GROUP BY ALL"""
)
def partitioned_round_trip(spark, sf_dir):
    """Clean layer written by kind, year and month; a rerun of some kinds replaces only those."""
    path = staging_path(spark, "clean")
    kept = cleaning.clean_rows(audited(spark, sf_dir)).withColumns(
        {"source_year": F.year("pickup_datetime"), "source_month": F.month("pickup_datetime")}
    )
    tables.write_clean(kept, path)
    tables.write_clean(kept.where(F.col("taxi_type") == "F"), path)
    return (
        tables.read_table(spark, path)
        .groupBy("taxi_type", "source_year", "source_month")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("order_key").alias("keys"))
    )


@query(
    f"""WITH {t.HOUR_GRID_SQL}
SELECT taxi_type, strftime(pickup_hour, '%Y-%m') AS year_month, count(*) AS n,
  CAST(sum(pickup_count) AS BIGINT) AS demand FROM grid GROUP BY 1, 2"""
)
def processed_round_trip(spark, sf_dir):
    path = staging_path(spark, "processed")
    tables.write_processed(t.hour_grid(spark, sf_dir), path)
    back = tables.read_table(spark, path, columns=["taxi_type", "year_month", "pickup_count"])
    return back.groupBy("taxi_type", "year_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pickup_count").alias("demand")
    )


@query(
    """SELECT event_id, value AS tmpf,
  CASE WHEN event_type = 'click' THEN 0.005 WHEN event_type = 'view' THEN value WHEN event_type = 'error' THEN NULL ELSE NULL END AS p01i,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS sknt,
  CASE WHEN event_type = 'purchase' THEN NULL ELSE event_type END AS wxcodes FROM events"""
)
def typed_weather_csv(spark, sf_dir):
    """Reports written as text (M, T, blanks, junk) and read back with types."""
    kind, value = F.col("event_type"), F.col("value").cast("string")
    rows = t.load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("station"),
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("valid"),
        value.alias("tmpf"), value.alias("dwpf"), value.alias("relh"),
        F.when(kind == "error", "M").otherwise(value).alias("sknt"),
        F.lit("M").alias("gust"), value.alias("vsby"),
        F.when(kind == "click", "T").when(kind == "view", value).when(kind == "error", "n/a").otherwise("M").alias("p01i"),
        F.lit("OVC").alias("skyc1"),
        F.when(kind == "purchase", "M").otherwise(kind).alias("wxcodes"),
    )
    path = staging_path(spark, "weather-csv")
    rows.write.option("header", True).csv(path)
    back = dimensions.read_weather_raw(spark, path)
    return back.select(F.col("station").cast("long").alias("event_id"), "tmpf", "p01i", "sknt", "wxcodes")


@query(
    f"""WITH {t.HOLIDAYS_SQL},
zones AS (SELECT n_nationkey AS pu_location_id, nullif(r_name, 'ASIA') AS borough FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey NOT IN (23, 24))
SELECT 'holiday' AS side, {t.text_sql('date', 'k')}, holiday_name AS v FROM holidays
UNION ALL SELECT 'zone', CAST(pu_location_id AS VARCHAR), borough FROM zones
UNION ALL SELECT 'weather', strftime(date_hour, '%Y-%m-%d %H:%M:%S'), weather_severity FROM (WITH {t.WEATHER_SQL} SELECT * FROM weather)"""
)
def typed_csv_dimensions(spark, sf_dir):
    """Side tables written as CSV and read back under their schemas."""
    zones_path, days_path = staging_path(spark, "zones"), staging_path(spark, "days")
    weather_path = staging_path(spark, "weather")
    place = t.places(spark, sf_dir)
    place.select(
        F.col("pu_location_id").alias("LocationID"),
        F.when(F.col("borough") == "ASIA", "N/A").otherwise(F.col("borough")).alias("Borough"),
        F.col("zone_name").alias("Zone"),
        F.lit("N/A").alias("service_zone"),
    ).write.option("header", True).csv(zones_path)
    t.holidays_raw(spark, sf_dir).orderBy("position").select("Date", "Holiday").coalesce(1).write.option(
        "header", True
    ).csv(days_path)
    externals.clean_weather(t.weather_reports(spark, sf_dir)).write.option("header", True).option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss"
    ).csv(weather_path)

    zones = dimensions.read_zones(spark, zones_path)
    kept = dimensions.place_groups(zones).join(dimensions.real_places(zones, (23, 24)), "pu_location_id")
    days = externals.holiday_days(dimensions.read_holidays_raw(spark, days_path))
    weather = dimensions.read_weather(spark, weather_path)
    parts = [
        days.select(F.lit("holiday").alias("side"), F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("k"),
                    F.col("holiday_name").alias("v")),
        kept.select(F.lit("zone").alias("side"), F.col("pu_location_id").cast("string").alias("k"),
                    F.col("borough").alias("v")),
        weather.select(F.lit("weather").alias("side"),
                       F.date_format("pickup_hour", "yyyy-MM-dd HH:mm:ss").alias("k"),
                       F.col("weather_severity").alias("v")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    """WITH e AS (SELECT event_id, user_id % 25 AS place, ts AS a,
    ts + to_microseconds(CAST(floor(value * 60000000 + 0.5) AS BIGINT)) AS b FROM events)
SELECT event_id, CAST(place AS INT) AS pu_location_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS start_date_time,
  strftime(b, '%Y-%m-%d %H:%M:%S') AS end_date_time
FROM e WHERE place <> 7 AND a >= TIMESTAMP '2024-01-05' AND a < TIMESTAMP '2024-01-20'"""
)
def placed_event_scan(spark, sf_dir):
    """Cleaned events written as a table, scanned for a period, restricted to those with a place."""
    length = F.floor(F.col("value") * 60_000_000 + 0.5).cast("long")
    rows = t.load(spark, sf_dir, "events").select(
        "event_id",
        F.nullif((F.col("user_id") % 25).cast("double"), F.lit(7.0)).alias("pu_location_id"),
        F.col("ts").alias("start_date_time"),
        F.timestamp_micros(F.unix_micros("ts") + length).alias("end_date_time"),
    )
    path = staging_path(spark, "events")
    dimensions.write_dimension(rows, path)
    back = spark.read.parquet(path)
    period = dimensions.events_in_period(back, "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    placed = period.where(F.col("pu_location_id").isNotNull())
    return placed.select(
        "event_id", F.col("pu_location_id").cast("int").alias("pu_location_id"),
        t.text("start_date_time"), t.text("end_date_time"),
    )


@query(
    f"""WITH {t.AUDIT_SQL},
totals AS (SELECT taxi_type AS dataset, count(*) AS n FROM trips GROUP BY 1),
removed AS (SELECT taxi_type AS dataset, removed_by AS ordinal, count(*) AS c FROM audited GROUP BY 1, 2),
ordinals AS (SELECT unnest(generate_series(1, 10)) AS ordinal)
SELECT f AS format, CAST(ordinal AS INT) AS ordinal, dataset, coalesce(c, 0) AS records_removed
FROM ordinals CROSS JOIN totals LEFT JOIN removed USING (dataset, ordinal)
CROSS JOIN (SELECT unnest(['json', 'csv']) AS f)"""
)
def report_tables(spark, sf_dir):
    """The ledger written per kind, stacked, as JSON and as CSV, and read back."""
    # Every kind and format reads the ledger, so it is stored; the audit runs once.
    ledger = stage(cleaning.ledger(audited(spark, sf_dir), trip_rules(), "taxi_type"), "ledger")
    kinds = [ledger.where(F.col("dataset") == k) for k in ("F", "O", "P")]
    stacked = reports.stack_reports(*kinds)
    parts = []
    for fmt in ("json", "csv"):
        path = staging_path(spark, f"report-{fmt}")
        reports.write_report(stacked, path, fmt)
        reader = spark.read.schema(stacked.schema)
        back = reader.json(path) if fmt == "json" else reader.option("header", True).csv(path)
        parts.append(back.select(F.lit(fmt).alias("format"), "ordinal", "dataset", "records_removed"))
    return parts[0].unionByName(parts[1])
