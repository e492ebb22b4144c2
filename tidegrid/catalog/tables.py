"""The driver's tables in the roles the operators expect, once as DataFrames and once as SQL.

Records to clean are order lines. Demand by day is shipped lines per return flag and supplier nation.
Demand by hour is events per type and customer nation; weather reports, interval events and holidays
for it come from the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import demand_ratio
from ..operators import baseline, externals, grid
from ..session import configure, stage

DAY_PERIOD = ("1995-01-01 00:00:00", "2001-11-05 00:00:00")
DAY_TRAIN_END = "2000-01-01 00:00:00"
DAY_KINDS = ["A", "N", "R"]
HOUR_PERIOD = ("2024-01-01 00:00:00", "2024-01-31 00:00:00")
HOUR_TRAIN_END = "2024-01-22 00:00:00"
HOUR_VALIDATION_START = "2024-01-15 00:00:00"
HOUR_KINDS = ["click", "error", "purchase", "signup", "view"]
HOUR_WEEKS = 2
TRIP_PERIOD = ("1996-01-01 00:00:00", "2001-01-01 00:00:00")
TRIP_PLACES = (1, 23)
TRIP_MAX_MINUTES = 2_000_000


_schemas: dict[str, StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, its wall-clock times as UTC timestamps.

    The schema of a file is looked up once; later reads need no job for it.
    """
    configure(spark)
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_schemas[path]).parquet(path)
    times = [n for n, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in times})


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Round so that both engines agree: the cut lies beside every representable tie."""
    c = F.col(c) if isinstance(c, str) else c
    scale = 10.0**digits
    return F.floor(c * scale + 0.501) / scale


def rnd_sql(expr: str, digits: int = 6) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.501) / 1e{digits}"


def text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def text_sql(c: str, name: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {name or c}"


# --- records to clean ------------------------------------------------------------------------------


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the clean layout (the columns that exist), with their keys."""
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers before the lines come in, so that lines are shuffled for one join and not for two.
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    joined = lines.join(placed, lines.l_orderkey == placed.o_orderkey).join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
    return joined.select(
        F.col("o_orderstatus").alias("taxi_type"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("vendor_id"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        (
            (F.unix_timestamp("l_shipdate") - F.unix_timestamp("o_orderdate")) / F.lit(60.0)
        ).alias("trip_duration_minutes"),
        (F.col("l_linenumber") - 2).alias("passenger_count"),
        (F.col("l_quantity") - 3).alias("trip_distance"),
        F.nullif(F.col("l_linenumber"), F.lit(7)).alias("ratecode_id"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        (F.nullif(F.col("c_nationkey"), F.lit(9)) + 1).alias("pu_location_id"),
        (F.nullif(F.col("s_nationkey"), F.lit(4)) + 1).alias("do_location_id"),
        F.col("l_linenumber").alias("payment_type"),
        (F.col("l_extendedprice") - 2000).alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("tip_amount"),
        F.col("l_extendedprice").alias("total_amount"),
    )


TRIPS_SQL = """
trips AS (
  SELECT o_orderstatus AS taxi_type, l_orderkey AS order_key, l_linenumber AS vendor_id,
         l_partkey AS part_key, l_suppkey AS supp_key, o_orderdate AS pickup_datetime,
         l_shipdate AS dropoff_datetime,
         (epoch(l_shipdate) - epoch(o_orderdate)) / 60.0 AS trip_duration_minutes,
         l_linenumber - 2 AS passenger_count, l_quantity - 3 AS trip_distance,
         nullif(l_linenumber, 7) AS ratecode_id, l_returnflag AS store_and_fwd_flag,
         nullif(c_nationkey, 9) + 1 AS pu_location_id, nullif(s_nationkey, 4) + 1 AS do_location_id,
         l_linenumber AS payment_type, l_extendedprice - 2000 AS fare_amount, l_discount AS extra,
         l_tax AS tip_amount, l_extendedprice AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
)"""

# The rules one after the other, each over what the ones before it left.
AUDIT_SQL = (
    TRIPS_SQL
    + """,
tagged AS (
  SELECT *, CASE
    WHEN pickup_datetime IS NULL THEN 1
    WHEN pu_location_id IS NULL THEN 2
    WHEN pu_location_id < 1 OR pu_location_id > 23 THEN 3
    WHEN do_location_id < 1 OR do_location_id > 23 THEN 4
    WHEN trip_distance <= 0 THEN 5
    WHEN passenger_count < 0 THEN 6
    WHEN fare_amount < 0 THEN 7
    WHEN trip_duration_minutes <= 0 OR trip_duration_minutes > 2000000 THEN 8
    END AS first_rule
  FROM trips
),
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY first_rule IS NULL, order_key, vendor_id
    ORDER BY part_key, supp_key, dropoff_datetime, trip_distance, total_amount) AS rn
  FROM tagged
),
audited AS (
  SELECT *, CASE
    WHEN first_rule IS NOT NULL THEN first_rule
    WHEN rn > 1 THEN 9
    WHEN pickup_datetime < TIMESTAMP '1996-01-01' OR pickup_datetime >= TIMESTAMP '2001-01-01' THEN 10
    END AS removed_by
  FROM numbered
),
clean AS (SELECT * FROM audited WHERE removed_by IS NULL)"""
)

# --- demand by day ----------------------------------------------------------------------------------


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as places, regions as their groups."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("pu_location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone_name"),
    )


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select("pu_location_id", "borough")


def group_names(spark: SparkSession, sf_dir: str) -> list[str]:
    rows = load(spark, sf_dir, "region").select("r_name").orderBy("r_name").collect()
    return [r.r_name for r in rows]


def day_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).select(
        F.col("l_returnflag").alias("taxi_type"),
        F.col("s_nationkey").alias("pu_location_id"),
        F.col("l_shipdate").alias("pickup_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").cast("double").alias("trip_duration_minutes"),
        F.col("l_linenumber").alias("passenger_count"),
        (F.col("l_quantity") > 45).alias("is_extreme_trip_distance"),
        (F.col("l_linenumber") > 6).alias("is_extreme_trip_duration"),
    )


def day_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = grid.to_cells(day_records(spark, sf_dir), unit="day")
    dense = grid.dense_grid(places(spark, sf_dir), DAY_KINDS, *DAY_PERIOD, unit="day")
    return grid.zero_fill(dense, stage(cells, "cells"))


def day_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.add_rolling_baseline(
        day_grid(spark, sf_dir), groups(spark, sf_dir), DAY_TRAIN_END
    )


def with_predictions(df: DataFrame) -> DataFrame:
    """Stand-in predictions: fixed arithmetic of the baseline, so that every score has an exact twin."""
    out = df.withColumns(
        {
            "actual": F.col("pickup_count").cast("double"),
            "pred_damped": F.col("baseline_pickup_count") * 0.75 + 0.25,
            "pred_lifted": F.col("baseline_pickup_count") * 1.5,
        }
    )
    return out.withColumns(
        {
            "dtdi": demand_ratio("actual", "baseline_pickup_count"),
            "dtdi_damped": demand_ratio("pred_damped", "baseline_pickup_count"),
            "dtdi_lifted": demand_ratio("pred_lifted", "baseline_pickup_count"),
        }
    )


def day_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_predictions(day_rolling(spark, sf_dir))


PLACES_SQL = """
places AS (
  SELECT n_nationkey AS pu_location_id, r_name AS borough, n_name AS zone_name
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

DAY_GRID_SQL = (
    PLACES_SQL
    + """,
cells AS (
  SELECT l_returnflag AS taxi_type, s_nationkey AS pu_location_id, date_trunc('day', l_shipdate) AS pickup_hour,
         count(*) AS pickup_count, avg(l_quantity) AS avg_trip_distance,
         avg(l_linenumber) AS avg_passenger_count,
         count(*) FILTER (WHERE l_quantity > 45) AS extreme_trip_distance_count
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3
),
days AS (
  SELECT CAST(d AS TIMESTAMP) AS pickup_hour
  FROM (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-11-04', INTERVAL 1 DAY)) AS d)
),
kinds AS (SELECT unnest(['A', 'N', 'R']) AS taxi_type),
grid AS (
  SELECT k.taxi_type, p.pu_location_id, p.borough, d.pickup_hour,
         CAST(dayofweek(d.pickup_hour) + 1 AS INT) AS day_of_week,
         CAST(hour(d.pickup_hour) AS INT) AS hour_of_day,
         coalesce(c.pickup_count, 0) AS pickup_count, c.avg_trip_distance, c.avg_passenger_count,
         c.extreme_trip_distance_count
  FROM kinds k CROSS JOIN places p CROSS JOIN days d
  LEFT JOIN cells c ON c.taxi_type = k.taxi_type AND c.pu_location_id = p.pu_location_id
    AND c.pickup_hour = d.pickup_hour
)"""
)


def rolling_sql(train_end: str, weeks: int) -> str:
    """CTEs ``windowed`` and ``based`` over a CTE ``grid``."""
    return f"""
windowed AS (
  SELECT *,
    avg(pickup_count) OVER (PARTITION BY taxi_type, pu_location_id, day_of_week, hour_of_day
      ORDER BY pickup_hour ROWS BETWEEN {weeks} PRECEDING AND 1 PRECEDING) AS slot_mean,
    count(*) OVER (PARTITION BY taxi_type, pu_location_id, day_of_week, hour_of_day
      ORDER BY pickup_hour ROWS BETWEEN {weeks} PRECEDING AND 1 PRECEDING) AS n_prior,
    avg(pickup_count) OVER (PARTITION BY taxi_type, pu_location_id, hour_of_day
      ORDER BY pickup_hour ROWS BETWEEN {7 * weeks} PRECEDING AND 1 PRECEDING) AS daily_mean
  FROM grid
),
group_level AS (
  SELECT taxi_type, borough, day_of_week, hour_of_day, avg(pickup_count) AS group_mean
  FROM grid WHERE pickup_hour < TIMESTAMP '{train_end}' GROUP BY ALL
),
kind_level AS (
  SELECT taxi_type, avg(pickup_count) AS kind_mean
  FROM grid WHERE pickup_hour < TIMESTAMP '{train_end}' GROUP BY ALL
),
based AS (
  SELECT w.*,
    CASE WHEN n_prior >= {weeks} THEN slot_mean
         WHEN daily_mean IS NOT NULL THEN daily_mean
         WHEN group_mean IS NOT NULL THEN group_mean ELSE kind_mean END AS baseline_pickup_count,
    CASE WHEN n_prior >= {weeks} THEN 'zone_dow_hour'
         WHEN daily_mean IS NOT NULL THEN 'zone_hour'
         WHEN group_mean IS NOT NULL THEN 'borough_dow_hour' ELSE 'global' END AS baseline_source
  FROM windowed w
  LEFT JOIN group_level USING (taxi_type, borough, day_of_week, hour_of_day)
  LEFT JOIN kind_level USING (taxi_type)
)"""


DAY_ROLLING_SQL = DAY_GRID_SQL + "," + rolling_sql(DAY_TRAIN_END, 8)


def predictions_sql(source: str) -> str:
    """CTE ``ev`` over a CTE with a baseline."""
    return f"""
predicted AS (
  SELECT *, CAST(pickup_count AS DOUBLE) AS actual, baseline_pickup_count * 0.75 + 0.25 AS pred_damped,
         baseline_pickup_count * 1.5 AS pred_lifted
  FROM {source}
),
ev AS (
  SELECT *, actual / nullif(baseline_pickup_count, 0) AS dtdi,
         pred_damped / nullif(baseline_pickup_count, 0) AS dtdi_damped,
         pred_lifted / nullif(baseline_pickup_count, 0) AS dtdi_lifted
  FROM predicted
)"""


DAY_EVALUATION_SQL = DAY_ROLLING_SQL + "," + predictions_sql("based")

# --- demand by hour, enriched ------------------------------------------------------------------------


def placed_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the nation of their user."""
    events = load(spark, sf_dir, "events")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return events.join(customers, events.user_id == customers.c_custkey)


def hour_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed_user_events(spark, sf_dir).select(
        F.col("event_type").alias("taxi_type"),
        F.col("c_nationkey").alias("pu_location_id"),
        F.col("ts").alias("pickup_datetime"),
        F.col("value").alias("trip_distance"),
        (F.col("value") * 2).alias("trip_duration_minutes"),
        (F.col("user_id") % 7).alias("passenger_count"),
        (F.col("value") > 20).alias("is_extreme_trip_distance"),
        (F.col("value") > 40).alias("is_extreme_trip_duration"),
    )


def hour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = grid.to_cells(hour_records(spark, sf_dir))
    dense = grid.dense_grid(places(spark, sf_dir), HOUR_KINDS, *HOUR_PERIOD)
    return grid.zero_fill(dense, stage(cells, "cells"))


def weather_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as station reports."""
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        F.col("ts").alias("valid"),
        F.col("value").alias("tmpf"),
        (F.col("value") - (F.col("user_id") % 3) + 1).alias("dwpf"),
        (F.col("value") + 10).alias("relh"),
        (F.col("value") / 4).alias("sknt"),
        F.when(F.col("value") > 60, F.col("value") / 3).alias("gust"),
        (F.col("user_id") % 13).cast("double").alias("vsby"),
        F.when(kind == "click", F.col("value") / 1000).otherwise(0.0).alias("p01i"),
        F.lit("OVC").alias("skyc1"),
        F.when((kind == "error") & (F.col("user_id") % 4 == 0), "+SN BR")
        .when((kind == "signup") & (F.col("user_id") % 2 == 0), "-RA")
        .alias("wxcodes"),
    )


def interval_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that last as many minutes as their value."""
    length = F.floor(F.col("value") * 60_000_000 + 0.5).cast("long")
    return placed_user_events(spark, sf_dir).select(
        F.col("c_nationkey").alias("pu_location_id"),
        F.col("ts").alias("start_date_time"),
        F.timestamp_micros(F.unix_micros("ts") + length).alias("end_date_time"),
    )


def holidays_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as names of days in January; every third day has two or three."""
    day = (F.col("n_nationkey") % 10) * 3 + 1
    return load(spark, sf_dir, "nation").select(
        F.concat(F.lit("1/"), day.cast("string"), F.lit("/24")).alias("Date"),
        F.col("n_name").alias("Holiday"),
        F.col("n_nationkey").alias("position"),
    )


def hour_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid, rolling baseline, weather, events and holidays: the processed table."""
    based = baseline.add_rolling_baseline(
        hour_grid(spark, sf_dir), groups(spark, sf_dir), HOUR_TRAIN_END, HOUR_WEEKS
    )
    weather = externals.clean_weather(weather_reports(spark, sf_dir)).withColumnRenamed(
        "date_hour", "pickup_hour"
    )
    running = externals.interval_cells(externals.clean_events(interval_events(spark, sf_dir)))
    return externals.enrich(
        based,
        stage(weather, "weather"),
        stage(running, "event-cells"),
        externals.holiday_days(holidays_raw(spark, sf_dir), position="position"),
    )


HOUR_GRID_SQL = (
    PLACES_SQL
    + """,
user_events AS (SELECT e.*, c_nationkey FROM events e JOIN customer ON user_id = c_custkey),
cells AS (
  SELECT event_type AS taxi_type, c_nationkey AS pu_location_id, date_trunc('hour', ts) AS pickup_hour,
         count(*) AS pickup_count, avg(value) AS avg_trip_distance,
         avg(value * 2) AS avg_trip_duration_minutes, avg(user_id % 7) AS avg_passenger_count,
         count(*) FILTER (WHERE value > 20) AS extreme_trip_distance_count,
         count(*) FILTER (WHERE value > 40) AS extreme_trip_duration_count
  FROM user_events GROUP BY 1, 2, 3
),
hours AS (
  SELECT CAST(h AS TIMESTAMP) AS pickup_hour
  FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS h)
),
kinds AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS taxi_type),
grid AS (
  SELECT k.taxi_type, p.pu_location_id, p.borough, h.pickup_hour,
         CAST(dayofweek(h.pickup_hour) + 1 AS INT) AS day_of_week,
         CAST(hour(h.pickup_hour) AS INT) AS hour_of_day,
         coalesce(c.pickup_count, 0) AS pickup_count,
         c.avg_trip_distance, c.avg_trip_duration_minutes, c.avg_passenger_count,
         c.extreme_trip_distance_count, c.extreme_trip_duration_count
  FROM kinds k CROSS JOIN places p CROSS JOIN hours h
  LEFT JOIN cells c ON c.taxi_type = k.taxi_type AND c.pu_location_id = p.pu_location_id
    AND c.pickup_hour = h.pickup_hour
)"""
)

WEATHER_SQL = """
reports AS (
  SELECT ts AS valid, value AS tmpf, value - (user_id % 3) + 1 AS dwpf, value + 10 AS relh,
         value / 4 AS sknt, CASE WHEN value > 60 THEN value / 3 END AS gust,
         CAST(user_id % 13 AS DOUBLE) AS vsby,
         CASE WHEN event_type = 'click' THEN value / 1000 ELSE 0.0 END AS p01i, 'OVC' AS skyc1,
         CASE WHEN event_type = 'error' AND user_id % 4 = 0 THEN '+SN BR'
              WHEN event_type = 'signup' AND user_id % 2 = 0 THEN '-RA' END AS wxcodes
  FROM events
),
weather AS (
  SELECT *, CASE
      WHEN contains(coalesce(wxcodes, ''), '+SN') OR vsby < 1 OR sknt >= 34 OR gust >= 34 OR p01i >= 0.3 THEN 'severe'
      WHEN contains(coalesce(wxcodes, ''), 'SN') OR contains(coalesce(wxcodes, ''), 'RA')
        OR contains(coalesce(wxcodes, ''), 'BR') OR vsby < 3 OR sknt >= 20 OR p01i > 0 THEN 'mild'
      ELSE 'normal' END AS weather_severity
  FROM (SELECT date_trunc('hour', valid) AS date_hour, * FROM reports
        QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', valid) ORDER BY valid DESC) = 1)
)"""

INTERVALS_SQL = """
intervals AS (
  SELECT c_nationkey AS pu_location_id, ts AS start_date_time,
         ts + to_microseconds(CAST(floor(value * 60000000 + 0.5) AS BIGINT)) AS end_date_time
  FROM events JOIN customer ON user_id = c_custkey
),
event_cells AS (
  SELECT pu_location_id, CAST(h AS TIMESTAMP) AS pickup_hour, count(*) AS event_count
  FROM (SELECT pu_location_id, unnest(generate_series(date_trunc('hour', start_date_time),
          date_trunc('hour', end_date_time), INTERVAL 1 HOUR)) AS h FROM intervals)
  GROUP BY 1, 2
)"""

HOLIDAYS_SQL = """
holidays AS (
  SELECT strptime('1/' || CAST((n_nationkey % 10) * 3 + 1 AS VARCHAR) || '/24', '%m/%d/%y') AS date,
         string_agg(n_name, '; ' ORDER BY n_nationkey) AS holiday_name
  FROM nation GROUP BY 1
)"""

HOUR_ENRICHED_SQL = (
    HOUR_GRID_SQL
    + ","
    + rolling_sql(HOUR_TRAIN_END, HOUR_WEEKS)
    + ","
    + WEATHER_SQL
    + ","
    + INTERVALS_SQL
    + ","
    + HOLIDAYS_SQL
    + """,
enriched AS (
  SELECT b.*, w.tmpf, w.dwpf, w.relh, w.sknt, w.gust, w.vsby, w.p01i, w.skyc1, w.wxcodes, w.weather_severity,
         coalesce(e.event_count, 0) AS event_count, coalesce(e.event_count, 0) > 0 AS event_present,
         h.holiday_name, h.holiday_name IS NOT NULL AS is_holiday
  FROM based b
  LEFT JOIN weather w ON w.date_hour = b.pickup_hour
  LEFT JOIN event_cells e ON e.pu_location_id = b.pu_location_id AND e.pickup_hour = b.pickup_hour
  LEFT JOIN holidays h ON h.date = date_trunc('day', b.pickup_hour)
)"""
)


def hour_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_predictions(hour_enriched(spark, sf_dir))


HOUR_EVALUATION_SQL = HOUR_ENRICHED_SQL + "," + predictions_sql("enriched")
