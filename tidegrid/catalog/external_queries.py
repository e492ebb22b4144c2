"""Weather, interval events, calendar, places."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import simpler_key
from ..operators import externals, geo
from ..session import stage
from ..sources import schemas as S
from . import tables as t
from .registry import query

READINGS = [*S.WEATHER_READINGS, "skyc1", "wxcodes", "weather_severity"]


def hourly_weather(spark, sf_dir):
    return externals.clean_weather(t.weather_reports(spark, sf_dir))


@query(
    f"""WITH {t.WEATHER_SQL}
SELECT {t.text_sql('date_hour')}, {', '.join(READINGS)} FROM weather"""
)
def last_per_hour(spark, sf_dir):
    return hourly_weather(spark, sf_dir).select(t.text("date_hour"), *READINGS)


@query(
    f"""WITH {t.WEATHER_SQL}
SELECT weather_severity, count(*) AS hours FROM weather GROUP BY 1"""
)
def severity_mix(spark, sf_dir):
    return hourly_weather(spark, sf_dir).groupBy("weather_severity").agg(
        F.count(F.lit(1)).alias("hours")
    )


_EVENT_HOURS = "SELECT DISTINCT date_trunc('hour', ts) AS date_hour FROM events"


@query(
    f"""WITH present AS ({_EVENT_HOURS}),
expected AS (SELECT CAST(h AS TIMESTAMP) AS date_hour FROM (
  SELECT unnest(generate_series(min(date_hour), max(date_hour), INTERVAL 1 HOUR)) AS h FROM present))
SELECT {t.text_sql('date_hour')} FROM expected WHERE date_hour NOT IN (SELECT date_hour FROM present)"""
)
def observation_gaps(spark, sf_dir):
    events = t.load(spark, sf_dir, "events")
    hourly = externals.last_per_hour(events.select("ts", "value"), "ts", severity=False)
    return externals.hour_gaps(hourly).select(t.text("date_hour"))


@query(
    f"""WITH {t.WEATHER_SQL},
n AS (SELECT (SELECT count(*) FROM reports) AS raw_rows, count(*) AS rows_kept,
        CAST(date_diff('hour', min(date_hour), max(date_hour)) + 1 AS BIGINT) AS hours FROM weather)
SELECT 'rows' AS section, 'raw_row_count' AS measure, raw_rows AS value FROM n
UNION ALL SELECT 'rows', 'duplicate_hour_rows_collapsed', raw_rows - rows_kept FROM n
UNION ALL SELECT 'rows', 'missing_hours_gap', hours - rows_kept FROM n
UNION ALL SELECT 'rows', 'clean_row_count', rows_kept FROM n
UNION ALL SELECT 'rows', 'expected_hours_in_range', hours FROM n
UNION ALL SELECT 'implausible', 'negative_precipitation', count(*) FILTER (WHERE p01i < 0) FROM weather
UNION ALL SELECT 'implausible', 'humidity_outside_0_100', count(*) FILTER (WHERE relh < 0 OR relh > 100) FROM weather
UNION ALL SELECT 'implausible', 'negative_wind', count(*) FILTER (WHERE sknt < 0) FROM weather
UNION ALL SELECT 'implausible', 'negative_visibility', count(*) FILTER (WHERE vsby < 0) FROM weather
UNION ALL SELECT 'implausible', 'temperature_outside_minus40_130', count(*) FILTER (WHERE tmpf < -40 OR tmpf > 130) FROM weather
UNION ALL SELECT 'implausible', 'dewpoint_above_temperature', count(*) FILTER (WHERE dwpf > tmpf) FROM weather
UNION ALL SELECT 'missing', 'gust', count(*) FILTER (WHERE gust IS NULL) FROM weather
UNION ALL SELECT 'missing', 'wxcodes', count(*) FILTER (WHERE wxcodes IS NULL) FROM weather
UNION ALL SELECT 'missing', 'core_readings', CAST(count(*) * 5 - count(tmpf) - count(dwpf) - count(relh) - count(sknt) - count(vsby) AS BIGINT) FROM weather
UNION ALL SELECT 'severity', 'normal', count(*) FILTER (WHERE weather_severity = 'normal') FROM weather
UNION ALL SELECT 'severity', 'mild', count(*) FILTER (WHERE weather_severity = 'mild') FROM weather
UNION ALL SELECT 'severity', 'severe', count(*) FILTER (WHERE weather_severity = 'severe') FROM weather"""
)
def weather_report(spark, sf_dir):
    raw = t.weather_reports(spark, sf_dir)
    return externals.weather_report(raw, externals.clean_weather(raw))


@query(
    f"""WITH {t.INTERVALS_SQL}
SELECT pu_location_id, {t.text_sql('pickup_hour')}, event_count FROM event_cells"""
)
def interval_cells(spark, sf_dir):
    events = externals.clean_events(t.interval_events(spark, sf_dir))
    return externals.interval_cells(events).select("pu_location_id", t.text("pickup_hour"), "event_count")


@query(
    f"""WITH {t.HOLIDAYS_SQL}
SELECT {t.text_sql('date')}, holiday_name FROM holidays"""
)
def calendar_rollup(spark, sf_dir):
    days = externals.holiday_days(t.holidays_raw(spark, sf_dir), position="position")
    return days.select(t.text("date"), "holiday_name")


@query(
    f"""WITH {t.HOUR_ENRICHED_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, pickup_count,
  {t.rnd_sql('baseline_pickup_count')} AS baseline_pickup_count, baseline_source,
  tmpf, gust, wxcodes, weather_severity, event_count, event_present, holiday_name, is_holiday
FROM enriched"""
)
def enriched_grid(spark, sf_dir):
    return t.hour_enriched(spark, sf_dir).select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), "pickup_count",
        t.rnd("baseline_pickup_count").alias("baseline_pickup_count"), "baseline_source",
        "tmpf", "gust", "wxcodes", "weather_severity", "event_count", "event_present", "holiday_name", "is_holiday",
    )


@query(
    f"""WITH {t.HOUR_ENRICHED_SQL}
SELECT count(*) AS total_rows, count(tmpf) AS weather_matched_rows,
  round(100.0 * count(tmpf) / count(*), 4) AS pct_weather_matched,
  count(*) FILTER (WHERE event_present) AS event_present_rows,
  round(100.0 * count(*) FILTER (WHERE event_present) / count(*), 4) AS pct_event_present,
  count(*) FILTER (WHERE is_holiday) AS holiday_rows,
  round(100.0 * count(*) FILTER (WHERE is_holiday) / count(*), 4) AS pct_holiday
FROM enriched"""
)
def join_coverage(spark, sf_dir):
    return externals.join_coverage(t.hour_enriched(spark, sf_dir))


# Orders and their lines as events with text times: some end before they start, some times are no
# times, some names and places are missing.
_TEXT_EVENTS_SQL = """
text_events AS (
  SELECT l_orderkey AS event_id,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END AS event_name,
    CASE WHEN l_linenumber = 5 THEN NULL ELSE o_orderdate END AS start_time,
    CASE WHEN l_linenumber = 6 THEN NULL
         WHEN l_linenumber = 2 THEN o_orderdate ELSE l_shipdate END AS end_time,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE o_orderpriority END AS event_location
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def text_events(spark, sf_dir):
    lines = t.load(spark, sf_dir, "lineitem")
    orders = t.load(spark, sf_dir, "orders")
    number = F.col("l_linenumber")
    start, end = F.col("o_orderdate").cast("string"), F.col("l_shipdate").cast("string")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("event_id"),
        F.when(number != 3, F.col("l_returnflag")).alias("event_name"),
        F.when(number == 5, "some day").otherwise(start).alias("start_date_time"),
        F.when(number == 6, "").when(number == 2, start).otherwise(end).alias("end_date_time"),
        F.when(number != 7, F.col("o_orderpriority")).alias("event_location"),
    )


_EVENT_CHECKS = {
    "removed_end_before_start": "end_time < start_time",
    "missing_event_location": "(end_time < start_time) IS NOT TRUE AND event_location IS NULL",
    "missing_event_name": "(end_time < start_time) IS NOT TRUE AND event_name IS NULL",
    "duration_over_30_days": "end_time - start_time > INTERVAL 30 DAY",
    "duration_over_90_days": "epoch(end_time) - epoch(start_time) > 90 * 86400",
    "duration_over_365_days": "epoch(end_time) - epoch(start_time) > 365 * 86400",
    "zero_length": "end_time = start_time",
    "kept": "(end_time < start_time) IS NOT TRUE",
}
_EVENT_CHECKS["duration_over_30_days"] = "epoch(end_time) - epoch(start_time) > 30 * 86400"


@query(
    f"WITH {_TEXT_EVENTS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT '{m}' AS measure, count(*) FILTER (WHERE {c}) AS record_count, "
        f"round(100.0 * count(*) FILTER (WHERE {c}) / count(*), 4) AS pct_of_original FROM text_events"
        for m, c in _EVENT_CHECKS.items()
    )
)
def event_cleaning(spark, sf_dir):
    return externals.events_report(externals.parse_event_times(text_events(spark, sf_dir)))


@query(
    f"""WITH {_TEXT_EVENTS_SQL}
SELECT event_id, event_name, event_location, {t.text_sql('start_time', 'start_date_time')},
  {t.text_sql('end_time', 'end_date_time')}
FROM text_events WHERE (end_time < start_time) IS NOT TRUE"""
)
def clean_events(spark, sf_dir):
    kept = externals.clean_events(externals.parse_event_times(text_events(spark, sf_dir)))
    return kept.select(
        "event_id", "event_name", "event_location", t.text("start_date_time"), t.text("end_date_time")
    )


_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_KEY_SQL = _STRIP.format(
    r"regexp_replace(" + _STRIP.format("split_part(text, ':', 1)") + r", '(?is)\bbetween\b.*$', '')"
)


@query(
    f"""SELECT location_key, event_borough, count(*) AS event_count
FROM (SELECT {_KEY_SQL} AS location_key, source AS event_borough FROM documents)
WHERE location_key <> '' AND event_borough IS NOT NULL GROUP BY 1, 2"""
)
def location_keys(spark, sf_dir):
    docs = t.load(spark, sf_dir, "documents").select(
        F.col("text").alias("event_location"), F.col("source").alias("event_borough")
    )
    return externals.location_keys(docs)


_SUFFIXES = [" West", " and Parkway", " (Main)", "/Annex", "", " north"]


@query(
    f"""WITH keys AS (
  SELECT c_custkey, c_mktsegment || CASE c_custkey % 6 {' '.join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SUFFIXES))} END
    || CASE WHEN c_nationkey = 3 THEN ' South' ELSE '' END AS k
  FROM customer
),
step1 AS (SELECT *, trim(split_part(regexp_replace(k, '\\s*\\([^)]*\\)', '', 'g'), '/', 1)) AS s FROM keys),
step2 AS (SELECT *, trim(regexp_replace(regexp_replace(s, '\\s+and\\s+\\w+$', '', 'i'),
            '\\s+(West|East|North|South)$', '', 'i')) AS simple FROM step1)
SELECT c_custkey, k AS location_key, CASE WHEN simple <> '' AND simple <> k THEN simple END AS simpler_key FROM step2"""
)
def simpler_keys(spark, sf_dir):
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in _SUFFIXES]), (F.col("c_custkey") % 6 + 1).cast("int")
    )
    key = F.concat(
        "c_mktsegment", suffix, F.when(F.col("c_nationkey") == 3, " South").otherwise("")
    )
    keys = t.load(spark, sf_dir, "customer").select("c_custkey", key.alias("location_key"))
    return keys.withColumn("simpler_key", simpler_key(F.col("location_key")))


# --- places from coordinates ------------------------------------------------------------------------

_CORNERS = [(-0.07, -0.05), (0.07, -0.07), (0.05, 0.06), (0.0, 0.02), (-0.06, 0.07), (-0.07, -0.05)]


def outlines(spark, sf_dir):
    """A five-cornered, dented outline per nation, on a 5 by 5 layout; neighbours overlap a little."""
    key = F.col("n_nationkey")
    x = (key % 5).cast("double") * 0.1 - 0.2
    y = F.floor(key / 5).cast("double") * 0.1 - 0.2
    ring = F.array(
        *[F.struct((x + F.lit(dx)).alias("x"), (y + F.lit(dy)).alias("y")) for dx, dy in _CORNERS]
    )
    return t.load(spark, sf_dir, "nation").select(key.alias("pu_location_id"), ring.alias("ring"))


def _d(v: float) -> str:
    return f"({v}::DOUBLE)"


_CENTRE = (
    "(n_nationkey % 5)::DOUBLE * 1e-1 - 2e-1 AS cx, floor(n_nationkey / 5)::DOUBLE * 1e-1 - 2e-1 AS cy"
)
OUTLINES_SQL = f"""
centres AS (SELECT n_nationkey AS pu_location_id, {_CENTRE} FROM nation),
edges AS ({' UNION ALL '.join(
    f"SELECT pu_location_id, cx + {_d(a[0])} AS x1, cy + {_d(a[1])} AS y1, cx + {_d(b[0])} AS x2, cy + {_d(b[1])} AS y2 FROM centres"
    for a, b in zip(_CORNERS, _CORNERS[1:])
)}),
inside AS (
  SELECT point_id, min(pu_location_id) AS pu_location_id FROM (
    SELECT point_id, pu_location_id FROM points JOIN edges ON (y1 > py) <> (y2 > py)
      AND px < x1 + (py - y1) * (x2 - x1) / (y2 - y1)
    GROUP BY 1, 2 HAVING count(*) % 2 = 1)
  GROUP BY 1
)"""


@query(
    f"""WITH points AS (
  SELECT vec_id AS point_id, embedding[1]::DOUBLE AS px, embedding[2]::DOUBLE AS py FROM embeddings),
{OUTLINES_SQL}
SELECT p.point_id, i.pu_location_id FROM points p LEFT JOIN inside i USING (point_id)"""
)
def point_in_polygon(spark, sf_dir):
    points = t.load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"),
        F.col("embedding")[0].cast("double").alias("lon"),
        F.col("embedding")[1].cast("double").alias("lat"),
    )
    located = geo.locate_points(points, outlines(spark, sf_dir), cell_degrees=0.05)
    return located.select("point_id", "pu_location_id")


def geocodes(spark, sf_dir):
    """Vectors as looked-up locations of five groups; every seventh look-up found nothing."""
    found = F.col("vec_id") % 7 != 0
    return t.load(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("PLACE "), F.floor(F.col("vec_id") / 5).cast("string")).alias("location_key"),
        F.when(F.col("vec_id") % 5 > 0, F.concat(F.lit("G"), (F.col("vec_id") % 5).cast("string")))
        .otherwise("")
        .alias("borough"),
        F.when(found, F.col("embedding")[1].cast("double")).alias("lat"),
        F.when(found, F.col("embedding")[0].cast("double")).alias("lon"),
    )


def located_events(spark, sf_dir):
    events = t.load(spark, sf_dir, "events").select(
        "event_id",
        F.concat(
            F.lit("PLACE "), (F.col("user_id") % 120).cast("string"), F.lit(": lawn "),
            (F.col("event_id") % 3).cast("string"),
        ).alias("event_location"),
        F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("G"), (F.col("event_id") % 5).cast("string")))
        .alias("event_borough"),
    )
    located = geo.locate_geocodes(geocodes(spark, sf_dir), outlines(spark, sf_dir), 0.05)
    return geo.assign_places(events, stage(located, "located-keys"))


_LOCATED_SQL = f"""
points AS (
  SELECT vec_id AS point_id, 'PLACE ' || (vec_id // 5) AS location_key,
    CASE WHEN vec_id % 5 > 0 THEN 'G' || (vec_id % 5) ELSE '' END AS borough,
    CASE WHEN vec_id % 7 <> 0 THEN embedding[1]::DOUBLE END AS px,
    CASE WHEN vec_id % 7 <> 0 THEN embedding[2]::DOUBLE END AS py FROM embeddings),
{OUTLINES_SQL},
located AS (
  SELECT event_id, 'PLACE ' || (user_id % 120) AS location_key,
    CASE WHEN event_id % 5 > 0 THEN 'G' || (event_id % 5) END AS event_borough
  FROM events),
assigned AS (
  SELECT l.*, p.py AS latitude, p.px AS longitude, i.pu_location_id
  FROM located l
  LEFT JOIN points p ON p.location_key = l.location_key AND p.borough = coalesce(l.event_borough, '')
  LEFT JOIN inside i USING (point_id)
)"""


@query(
    f"""WITH {_LOCATED_SQL}
SELECT event_id, location_key, event_borough, latitude, longitude, pu_location_id FROM assigned"""
)
def geocode_lookup(spark, sf_dir):
    return located_events(spark, sf_dir).select(
        "event_id", "location_key", "event_borough", "latitude", "longitude", "pu_location_id"
    )


@query(
    f"""WITH {_LOCATED_SQL}
SELECT (SELECT count(*) FROM (SELECT DISTINCT location_key, event_borough FROM assigned
          WHERE event_borough IS NOT NULL)) AS unique_location_keys,
  count(pu_location_id) AS events_geocoded, count(*) - count(pu_location_id) AS events_not_geocoded,
  round(100.0 * count(pu_location_id) / count(*), 2) AS pct_geocoded FROM assigned"""
)
def geocode_coverage(spark, sf_dir):
    return geo.geocode_coverage(located_events(spark, sf_dir))


@query(
    f"""WITH {t.DAY_GRID_SQL},
means AS (SELECT pu_location_id, avg(pickup_count) AS mean_demand FROM grid GROUP BY 1)
SELECT pu_location_id, zone_name, borough, {t.rnd_sql('mean_demand')} AS mean_demand
FROM places JOIN means USING (pu_location_id)"""
)
def zone_completeness(spark, sf_dir):
    means = t.day_grid(spark, sf_dir).groupBy("pu_location_id").agg(
        F.avg("pickup_count").alias("mean_demand")
    )
    shapes = geo.zones_from_shapes(outlines(spark, sf_dir), t.places(spark, sf_dir))
    return geo.complete_by_place(shapes, means, "mean_demand").select(
        "pu_location_id", "zone_name", "borough", t.rnd("mean_demand").alias("mean_demand")
    )
