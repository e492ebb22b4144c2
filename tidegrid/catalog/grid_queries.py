"""Cells, zeros and baselines."""

from __future__ import annotations


from ..functions.columns import slot_columns
from ..operators import baseline, grid
from . import tables as t
from .registry import query


@query(
    f"""WITH {t.HOUR_GRID_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, pickup_count,
  {t.rnd_sql('avg_trip_distance')} AS avg_trip_distance,
  {t.rnd_sql('avg_trip_duration_minutes')} AS avg_trip_duration_minutes,
  {t.rnd_sql('avg_passenger_count')} AS avg_passenger_count,
  extreme_trip_distance_count, extreme_trip_duration_count
FROM cells"""
)
def hourly_counts(spark, sf_dir):
    cells = grid.to_cells(t.hour_records(spark, sf_dir))
    return cells.select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), "pickup_count",
        *[t.rnd(c).alias(c) for c in ("avg_trip_distance", "avg_trip_duration_minutes", "avg_passenger_count")],
        "extreme_trip_distance_count", "extreme_trip_duration_count",
    )


@query(
    f"""WITH {t.DAY_GRID_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, pickup_count,
  {t.rnd_sql('avg_trip_distance')} AS avg_trip_distance, pickup_count = 0 AS is_zero_demand_hour
FROM grid"""
)
def zero_filled_grid(spark, sf_dir):
    return t.day_grid(spark, sf_dir).select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), "pickup_count",
        t.rnd("avg_trip_distance").alias("avg_trip_distance"), "is_zero_demand_hour",
    )


@query(
    f"""WITH {t.DAY_ROLLING_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, pickup_count,
  {t.rnd_sql('slot_mean')} AS baseline_zone_dow_hour, n_prior AS n_prior_weeks,
  {t.rnd_sql('daily_mean')} AS baseline_zone_hour
FROM windowed"""
)
def rolling_slot_baseline(spark, sf_dir):
    df = baseline.add_rolling_columns(slot_columns(t.day_grid(spark, sf_dir)))
    return df.select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), "pickup_count",
        t.rnd("baseline_zone_dow_hour").alias("baseline_zone_dow_hour"), "n_prior_weeks",
        t.rnd("baseline_zone_hour").alias("baseline_zone_hour"),
    )


@query(
    f"""WITH {t.DAY_ROLLING_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, pickup_count, day_of_week, hour_of_day,
  {t.rnd_sql('baseline_pickup_count')} AS baseline_pickup_count, baseline_source
FROM based"""
)
def rolling_baseline_fallback(spark, sf_dir):
    return t.day_rolling(spark, sf_dir).select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), "pickup_count", "day_of_week", "hour_of_day",
        t.rnd("baseline_pickup_count").alias("baseline_pickup_count"), "baseline_source",
    )


STATIC_SQL = (
    t.HOUR_GRID_SQL
    + f""",
train AS (SELECT * FROM grid WHERE pickup_hour < TIMESTAMP '{t.HOUR_TRAIN_END}'),
l1 AS (SELECT taxi_type, pu_location_id, day_of_week, hour_of_day, avg(pickup_count) AS m1,
         count(*) FILTER (WHERE pickup_count > 0) AS nonzero FROM train GROUP BY ALL),
l2 AS (SELECT taxi_type, pu_location_id, hour_of_day, avg(pickup_count) AS m2 FROM train GROUP BY ALL),
l3 AS (SELECT taxi_type, borough, day_of_week, hour_of_day, avg(pickup_count) AS m3 FROM train GROUP BY ALL),
l4 AS (SELECT taxi_type, avg(pickup_count) AS m4 FROM train GROUP BY ALL),
static AS (
  SELECT g.*, CASE WHEN nonzero >= 2 THEN m1 WHEN m2 IS NOT NULL THEN m2 WHEN m3 IS NOT NULL THEN m3 ELSE m4 END
           AS baseline_pickup_count,
         CASE WHEN nonzero >= 2 THEN 'zone_dow_hour' WHEN m2 IS NOT NULL THEN 'zone_hour'
              WHEN m3 IS NOT NULL THEN 'borough_dow_hour' ELSE 'global' END AS baseline_source
  FROM grid g
  LEFT JOIN l1 USING (taxi_type, pu_location_id, day_of_week, hour_of_day)
  LEFT JOIN l2 USING (taxi_type, pu_location_id, hour_of_day)
  LEFT JOIN l3 USING (taxi_type, borough, day_of_week, hour_of_day)
  LEFT JOIN l4 USING (taxi_type)
)"""
)


@query(
    f"""WITH {STATIC_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, pickup_count,
  {t.rnd_sql('baseline_pickup_count')} AS baseline_pickup_count, baseline_source
FROM static"""
)
def static_baseline_fallback(spark, sf_dir):
    df = baseline.add_static_baseline(
        t.hour_grid(spark, sf_dir), t.groups(spark, sf_dir), t.HOUR_TRAIN_END, min_nonzero_weeks=2
    )
    return df.select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), "pickup_count",
        t.rnd("baseline_pickup_count").alias("baseline_pickup_count"), "baseline_source",
    )


@query(
    f"""WITH {t.DAY_ROLLING_SQL}
SELECT baseline_source, count(*) AS row_count FROM based GROUP BY 1"""
)
def baseline_source_mix(spark, sf_dir):
    return baseline.source_mix(t.day_rolling(spark, sf_dir))


@query(
    f"""WITH {t.DAY_ROLLING_SQL},
static_level AS (
  SELECT taxi_type, pu_location_id, day_of_week, hour_of_day, avg(pickup_count) AS m,
         count(*) FILTER (WHERE pickup_count > 0) AS nonzero
  FROM grid WHERE pickup_hour < TIMESTAMP '{t.DAY_TRAIN_END}' GROUP BY ALL),
static_zone AS (
  SELECT taxi_type, pu_location_id, hour_of_day, avg(pickup_count) AS mz
  FROM grid WHERE pickup_hour < TIMESTAMP '{t.DAY_TRAIN_END}' GROUP BY ALL),
cells2 AS (
  SELECT b.pu_location_id, b.pickup_hour, sum(b.pickup_count) AS demand,
         sum(b.baseline_pickup_count) AS rolling, sum(CASE WHEN nonzero >= 8 THEN m ELSE mz END) AS static
  FROM based b
  LEFT JOIN static_level USING (taxi_type, pu_location_id, day_of_week, hour_of_day)
  LEFT JOIN static_zone USING (taxi_type, pu_location_id, hour_of_day)
  GROUP BY 1, 2)
SELECT pu_location_id, {t.rnd_sql('avg(demand - rolling)')} AS rolling_deviation,
  {t.rnd_sql('avg(demand - static)')} AS static_deviation
FROM cells2 GROUP BY 1"""
)
def baseline_deviation_by_zone(spark, sf_dir):
    grid, groups = slot_columns(t.day_grid(spark, sf_dir)), t.groups(spark, sf_dir)
    levels = baseline.slot_levels(grid, groups, t.DAY_TRAIN_END)
    rolling = baseline.add_rolling_baseline(grid, groups, t.DAY_TRAIN_END, levels=levels)
    both = baseline.add_static_baseline(
        rolling.withColumnRenamed("baseline_pickup_count", "rolling_baseline").drop("baseline_source"),
        groups, t.DAY_TRAIN_END, levels=levels,
    )
    out = baseline.deviation_by_place(
        both, {"rolling": "rolling_baseline", "static": "baseline_pickup_count"}
    )
    return out.select(
        "pu_location_id",
        t.rnd("rolling_deviation").alias("rolling_deviation"),
        t.rnd("static_deviation").alias("static_deviation"),
    )


@query(
    f"""WITH {t.DAY_GRID_SQL}
SELECT taxi_type, count(*) AS grid_row_count, count(*) FILTER (WHERE pickup_count > 0) AS non_zero_count,
  round(100.0 * count(*) FILTER (WHERE pickup_count = 0) / count(*), 4) AS pct_zero_demand
FROM grid GROUP BY 1"""
)
def zero_rate_summary(spark, sf_dir):
    return grid.grid_summary(t.day_grid(spark, sf_dir))


@query(
    f"""WITH {t.HOUR_GRID_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, day_of_week, hour_of_day FROM grid"""
)
def dense_hour_grid(spark, sf_dir):
    seeds = grid.dense_grid(t.places(spark, sf_dir), t.HOUR_KINDS, *t.HOUR_PERIOD)
    return slot_columns(seeds).select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), "day_of_week", "hour_of_day"
    )
