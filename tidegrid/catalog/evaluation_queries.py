"""Errors, demand-ratio classes, rankings, and descriptive tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import slot_columns
from ..operators import dtdi, explore, metrics, topk
from . import tables as t
from .registry import query

PREDICTED = {"damped": "pred_damped", "lifted": "pred_lifted"}
KEY = ["taxi_type", "pu_location_id", "pickup_hour"]


def test_rows(df, boundary):
    return df.where(F.col("pickup_hour") >= F.lit(boundary).cast("timestamp"))


def train_rows(df, boundary):
    return df.where(F.col("pickup_hour") < F.lit(boundary).cast("timestamp"))


def day_test(spark, sf_dir):
    return test_rows(t.day_evaluation(spark, sf_dir), t.DAY_TRAIN_END)


DAY_SQL = (
    t.DAY_EVALUATION_SQL
    + f""",
test AS (SELECT * FROM ev WHERE pickup_hour >= TIMESTAMP '{t.DAY_TRAIN_END}'),
train AS (SELECT * FROM ev WHERE pickup_hour < TIMESTAMP '{t.DAY_TRAIN_END}')"""
)


def _metrics_sql(source: str, by: str | None = None) -> str:
    lead = f"{by}, " if by else ""
    tail = f" WHERE {by} IS NOT NULL GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {lead}'{m}' AS model, {t.rnd_sql(f'avg(abs(actual - {c}))')} AS mae,
  {t.rnd_sql(f'sqrt(avg((actual - {c}) * (actual - {c})))')} AS rmse,
  {t.rnd_sql(f'1 - sum((actual - {c}) * (actual - {c})) / nullif(var_pop(actual) * count(*), 0)')} AS r2,
  count(*) AS n FROM {source}{tail}"""
        for m, c in PREDICTED.items()
    )


def _rounded(df, names):
    return df.select(*[t.rnd(c).alias(c) if c in names else c for c in df.columns])


@query(f"WITH {DAY_SQL}\n" + _metrics_sql("test"))
def regression_metrics(spark, sf_dir):
    out = metrics.regression_metrics(day_test(spark, sf_dir), "actual", PREDICTED)
    return _rounded(out, ["mae", "rmse", "r2"])


@query(f"WITH {DAY_SQL}\n" + _metrics_sql("test", "pu_location_id"))
def metrics_by_group(spark, sf_dir):
    out = metrics.regression_metrics(day_test(spark, sf_dir), "actual", PREDICTED, by="pu_location_id")
    return _rounded(out, ["mae", "rmse", "r2"])


@query(
    f"WITH {t.HOUR_EVALUATION_SQL}\n"
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS model, {t.rnd_sql(
            f"avg(abs(actual - {c})) FILTER (WHERE weather_severity = 'severe') / "
            f"avg(abs(actual - {c})) FILTER (WHERE weather_severity = 'normal')")} AS mae_ratio FROM ev"""
        for m, c in PREDICTED.items()
    )
)
def weather_mae_ratio(spark, sf_dir):
    by = metrics.regression_metrics(
        t.hour_evaluation(spark, sf_dir), "actual", PREDICTED, by="weather_severity"
    )
    out = metrics.mae_ratio(by, "weather_severity", "severe", "normal")
    return _rounded(out, ["mae_ratio"])


@query(
    f"""WITH {DAY_SQL}
SELECT count(*) AS n, {t.rnd_sql('avg(actual)')} AS actual_mean,
  {t.rnd_sql('avg(pred_damped)')} AS damped_mean, {t.rnd_sql('avg(pred_lifted)')} AS lifted_mean FROM test"""
)
def prediction_levels(spark, sf_dir):
    means = {"actual_mean": "actual", "damped_mean": "pred_damped", "lifted_mean": "pred_lifted"}
    return _rounded(metrics.mean_levels(day_test(spark, sf_dir), means), list(means))


@query(
    f"""WITH {DAY_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, {t.rnd_sql('dtdi')} AS dtdi FROM test"""
)
def demand_ratio(spark, sf_dir):
    return day_test(spark, sf_dir).select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), t.rnd("dtdi").alias("dtdi")
    )


@query(
    f"""WITH {DAY_SQL}
SELECT CASE WHEN dtdi <= 1 THEN 'below_normal' WHEN dtdi <= 1.5 THEN 'normal' WHEN dtdi <= 2 THEN 'elevated'
  WHEN dtdi > 2 THEN 'very_elevated' END AS category, taxi_type, pu_location_id, count(*) AS n
FROM test GROUP BY ALL"""
)
def dtdi_fixed_classes(spark, sf_dir):
    rows = day_test(spark, sf_dir).withColumn("category", dtdi.classify(F.col("dtdi")))
    return rows.groupBy("category", "taxi_type", "pu_location_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {DAY_SQL}
SELECT {t.rnd_sql('quantile_cont(dtdi, 0.75)')} AS p_low, {t.rnd_sql('quantile_cont(dtdi, 0.95)')} AS p_high,
  count(*) AS n_obs FROM train WHERE baseline_pickup_count >= 1 AND dtdi IS NOT NULL"""
)
def dtdi_city_thresholds(spark, sf_dir):
    out = dtdi.city_thresholds(train_rows(t.day_evaluation(spark, sf_dir), t.DAY_TRAIN_END))
    return _rounded(out, ["p_low", "p_high"])


# On the daily grid the slot of a place is the weekday.
SLOT = ["pu_location_id", "day_of_week"]
LEVELS_SQL = (
    DAY_SQL
    + """,
sure AS (SELECT * FROM train WHERE baseline_pickup_count >= 0.5 AND dtdi IS NOT NULL),
fine AS (SELECT pu_location_id, day_of_week, quantile_cont(dtdi, 0.75) AS lo1, quantile_cont(dtdi, 0.95) AS hi1,
           count(*) AS n1 FROM sure GROUP BY 1, 2),
place AS (SELECT pu_location_id, quantile_cont(dtdi, 0.75) AS lo2, quantile_cont(dtdi, 0.95) AS hi2,
            count(*) AS n2 FROM sure GROUP BY 1),
city AS (SELECT quantile_cont(dtdi, 0.75) AS lo3, quantile_cont(dtdi, 0.95) AS hi3, count(*) AS n3 FROM sure),
judged AS (
  SELECT t.*,
    CASE WHEN coalesce(n1, 0) >= 50 THEN lo1 WHEN coalesce(n2, 0) >= 50 THEN lo2 ELSE lo3 END AS p_low,
    CASE WHEN coalesce(n1, 0) >= 50 THEN hi1 WHEN coalesce(n2, 0) >= 50 THEN hi2 ELSE hi3 END AS p_high,
    CASE WHEN coalesce(n1, 0) >= 50 THEN 'zone_hour' WHEN coalesce(n2, 0) >= 50 THEN 'zone' ELSE 'global' END AS threshold_level
  FROM test t LEFT JOIN fine USING (pu_location_id, day_of_week) LEFT JOIN place USING (pu_location_id) CROSS JOIN city
),
labelled AS (
  SELECT *,
    CASE WHEN dtdi < 1 THEN 'below_normal' WHEN dtdi >= p_high THEN 'very_elevated' WHEN dtdi >= p_low THEN 'elevated'
      WHEN dtdi IS NOT NULL THEN 'normal' END AS class_actual,
    CASE WHEN dtdi_damped < 1 THEN 'below_normal' WHEN dtdi_damped >= p_high THEN 'very_elevated'
      WHEN dtdi_damped >= p_low THEN 'elevated' WHEN dtdi_damped IS NOT NULL THEN 'normal' END AS class_damped
  FROM judged
)"""
)


def _levels(evaluation):
    train = train_rows(evaluation, t.DAY_TRAIN_END)
    return dtdi.group_thresholds(train, SLOT, min_baseline=0.5)


def labelled(spark, sf_dir):
    evaluation = t.stage(t.day_evaluation(spark, sf_dir), "evaluation")
    judged = dtdi.resolve_thresholds(test_rows(evaluation, t.DAY_TRAIN_END), _levels(evaluation), SLOT)
    limits = (F.col("p_low"), F.col("p_high"))
    return judged.withColumns(
        {
            "class_actual": dtdi.classify_by_group(F.col("dtdi"), *limits),
            "class_damped": dtdi.classify_by_group(F.col("dtdi_damped"), *limits),
        }
    )


@query(
    f"""WITH {LEVELS_SQL}
SELECT 'zone_hour' AS level, pu_location_id, CAST(day_of_week AS INT) AS day_of_week, {t.rnd_sql('lo1')} AS p_low,
  {t.rnd_sql('hi1')} AS p_high, n1 AS n_obs FROM fine
UNION ALL SELECT 'zone', pu_location_id, NULL, {t.rnd_sql('lo2')}, {t.rnd_sql('hi2')}, n2 FROM place
UNION ALL SELECT 'global', NULL, NULL, {t.rnd_sql('lo3')}, {t.rnd_sql('hi3')}, n3 FROM city"""
)
def dtdi_group_thresholds(spark, sf_dir):
    evaluation = t.stage(t.day_evaluation(spark, sf_dir), "evaluation")
    out = None
    for name, level in _levels(evaluation).items():
        part = level.withColumn("level", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.select(
        "level", *SLOT, t.rnd("p_low").alias("p_low"), t.rnd("p_high").alias("p_high"), "n_obs"
    )


@query(
    f"""WITH {LEVELS_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, threshold_level, class_actual, class_damped
FROM labelled"""
)
def dtdi_group_classes(spark, sf_dir):
    return labelled(spark, sf_dir).select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), "threshold_level", "class_actual", "class_damped"
    )


@query(
    f"WITH {LEVELS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT 'actual_{a}' AS actual_category, "
        + ", ".join(
            f"count(*) FILTER (WHERE class_actual = '{a}' AND class_damped = '{p}') AS pred_{p}"
            for p in dtdi.LABELS
        )
        + " FROM labelled"
        for a in dtdi.LABELS
    )
)
def confusion_matrix(spark, sf_dir):
    return dtdi.confusion_matrix(labelled(spark, sf_dir), "class_actual", "class_damped")


@query(
    f"""WITH {LEVELS_SQL},
pairs AS (SELECT class_actual AS a, class_damped AS p FROM labelled WHERE class_actual IS NOT NULL AND class_damped IS NOT NULL),
labels AS (SELECT unnest({dtdi.LABELS}) AS category),
counts AS (
  SELECT category, (SELECT count(*) FROM pairs WHERE a = category AND p = category) AS tp,
    (SELECT count(*) FROM pairs WHERE p = category) AS called,
    (SELECT count(*) FROM pairs WHERE a = category) AS support FROM labels
),
scored AS (
  SELECT category, coalesce(tp / nullif(called, 0), 0)::DOUBLE AS precision,
    coalesce(tp / nullif(support, 0), 0)::DOUBLE AS recall,
    coalesce(2 * tp / nullif(called + support, 0), 0)::DOUBLE AS f1, support FROM counts
),
every AS (
  SELECT * FROM scored
  UNION ALL SELECT 'macro_avg', avg(precision), avg(recall), avg(f1), (SELECT count(*) FROM pairs) FROM scored
  UNION ALL SELECT 'micro_avg', m, m, m, n FROM (
    SELECT count(*) FILTER (WHERE a = p) / count(*) AS m, count(*) AS n FROM pairs)
)
SELECT category, {t.rnd_sql('precision')} AS precision, {t.rnd_sql('recall')} AS recall, {t.rnd_sql('f1')} AS f1,
  support FROM every"""
)
def class_report(spark, sf_dir):
    out = dtdi.classification_report(labelled(spark, sf_dir), "class_actual", "class_damped")
    return _rounded(out, ["precision", "recall", "f1"])


HOUR_SURE_SQL = (
    t.HOUR_EVALUATION_SQL + ", sure AS (SELECT * FROM ev WHERE baseline_pickup_count >= 0.25)"
)


def hour_sure(spark, sf_dir):
    return dtdi.reliable(t.hour_evaluation(spark, sf_dir), 0.25)


@query(
    f"""WITH {HOUR_SURE_SQL}
SELECT weather_severity, {t.rnd_sql('avg(dtdi)')} AS mean_dtdi, count(dtdi) AS n_obs,
  {t.rnd_sql('quantile_cont(dtdi, 0.5)')} AS median_dtdi
FROM sure WHERE weather_severity IS NOT NULL GROUP BY 1"""
)
def severity_effect(spark, sf_dir):
    out = dtdi.by_severity(hour_sure(spark, sf_dir))
    return _rounded(out, ["mean_dtdi", "median_dtdi"])


def _drop_sql(c: str) -> str:
    return (
        f"(avg({c}) FILTER (WHERE weather_severity = 'normal') - avg({c}) FILTER (WHERE weather_severity = 'severe'))"
    )


@query(
    f"WITH {HOUR_SURE_SQL}\n"
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS model, {t.rnd_sql(f'stddev_samp(dtdi) / nullif(stddev_samp(dtdi_{m}), 0)', 4)} AS std_ratio,
  {t.rnd_sql(_drop_sql('dtdi'))} AS actual_drop, {t.rnd_sql(_drop_sql(f'dtdi_{m}'))} AS predicted_drop,
  {t.rnd_sql(f"100 * {_drop_sql(f'dtdi_{m}')} / {_drop_sql('dtdi')}", 4)} AS pct_drop_captured
  FROM (SELECT *, baseline_pickup_count * day_of_week / nullif(baseline_pickup_count, 0) AS dtdi_weekday FROM sure)"""
        for m in ("damped", "weekday")
    )
)
def severity_compression(spark, sf_dir):
    sure = hour_sure(spark, sf_dir)
    weekday = dtdi.demand_ratio(F.col("baseline_pickup_count") * F.col("day_of_week"), F.col("baseline_pickup_count"))
    out = dtdi.compression(sure.withColumn("dtdi_weekday", weekday), "dtdi", {"damped": "dtdi_damped", "weekday": "dtdi_weekday"})
    return out.select(
        "model", t.rnd("std_ratio", 4).alias("std_ratio"), t.rnd("actual_drop").alias("actual_drop"),
        t.rnd("predicted_drop").alias("predicted_drop"),
        t.rnd("pct_drop_captured", 4).alias("pct_drop_captured"),
    )


KS = [50, 200, 1000, 5000]
_RANKS_SQL = f"""
ranked AS (
  SELECT row_number() OVER (ORDER BY actual DESC, {', '.join(KEY)}) AS ra,
    row_number() OVER (ORDER BY pred_damped DESC, {', '.join(KEY)}) AS r_damped,
    row_number() OVER (ORDER BY baseline_pickup_count * day_of_week DESC, {', '.join(KEY)}) AS r_weekday
  FROM test)"""


@query(
    f"WITH {DAY_SQL},{_RANKS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT '{m}' AS model, {k} AS k, {t.rnd_sql(f'100.0 * count(*) FILTER (WHERE ra <= {k} AND r_{m} <= {k}) / {k}')} AS pct_overlap FROM ranked"
        for m in ("damped", "weekday")
        for k in KS
    )
    + "".join(
        f" UNION ALL SELECT 'random', {k}, {t.rnd_sql(f'100.0 * {k} / count(*)')} FROM ranked" for k in KS
    )
)
def topk_overlap(spark, sf_dir):
    rows = day_test(spark, sf_dir).withColumn(
        "pred_weekday", F.col("baseline_pickup_count") * F.col("day_of_week")
    )
    # Four rankings read these rows: written once.
    rows = t.stage(rows.select(*KEY, "actual", "pred_damped", "pred_weekday"), "ranking")
    found = topk.overlap(
        rows, KS, "actual", {"damped": "pred_damped", "weekday": "pred_weekday"}, KEY
    )
    return _rounded(found.unionByName(topk.random_overlap(rows, KS)), ["pct_overlap"])


@query(
    f"""WITH {DAY_SQL}
SELECT strftime(pickup_hour, '%Y-%m-%d') AS pickup_date, sum(actual) AS total FROM test
WHERE taxi_type = 'A' GROUP BY 1 ORDER BY total DESC, pickup_date LIMIT 1"""
)
def busiest_day(spark, sf_dir):
    out = topk.busiest_day(day_test(spark, sf_dir), "A")
    return out.select(F.col("pickup_date").cast("string").alias("pickup_date"), "total")


@query(
    f"""WITH {t.HOUR_EVALUATION_SQL},
day AS (SELECT date_trunc('day', pickup_hour) AS d, sum(actual) AS s FROM ev WHERE taxi_type = 'click'
        GROUP BY 1 ORDER BY s DESC, d LIMIT 1),
rows_of_day AS (SELECT * FROM ev WHERE taxi_type = 'click' AND date_trunc('day', pickup_hour) = (SELECT d FROM day)),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY actual DESC, pu_location_id, pickup_hour) AS ra,
    row_number() OVER (ORDER BY pred_damped DESC, pu_location_id, pickup_hour) AS rp FROM rows_of_day)
SELECT pu_location_id, zone_name, r.borough, {t.text_sql('pickup_hour')}, hour_of_day, actual,
  {t.rnd_sql('pred_damped')} AS pred_damped, CASE WHEN ra <= 20 THEN CAST(ra AS INT) END AS actual_rank,
  CASE WHEN rp <= 20 THEN CAST(rp AS INT) END AS predicted_rank, ra <= 20 AND rp <= 20 AS in_both
FROM ranked r JOIN places p USING (pu_location_id) WHERE ra <= 20 OR rp <= 20"""
)
def busiest_day_topk(spark, sf_dir):
    rows = t.stage(t.hour_evaluation(spark, sf_dir), "evaluation")
    out = topk.busiest_day_lists(rows, t.places(spark, sf_dir), "click", "actual", "pred_damped")
    return out.select(
        "pu_location_id", "zone_name", "borough", t.text("pickup_hour"), "hour_of_day", "actual",
        t.rnd("pred_damped").alias("pred_damped"), "actual_rank", "predicted_rank", "in_both",
    )


# --- descriptive tables -----------------------------------------------------------------------------

ALL_KINDS_SQL = """
all_kinds AS (SELECT pu_location_id, borough, pickup_hour, day_of_week, hour_of_day, sum(pickup_count) AS demand
              FROM grid GROUP BY ALL)"""


@query(
    f"""WITH {t.DAY_GRID_SQL},{ALL_KINDS_SQL}
SELECT {t.rnd_sql('quantile_cont(demand::DOUBLE, 0.5)')} AS median,
  {t.rnd_sql('100.0 * count(*) FILTER (WHERE demand = 0) / count(*)')} AS pct_zero,
  {t.rnd_sql('avg(demand)')} AS mean, {t.rnd_sql('quantile_cont(demand::DOUBLE, 0.99)')} AS p99,
  CAST(max(demand) AS BIGINT) AS max FROM all_kinds"""
)
def demand_distribution(spark, sf_dir):
    out = explore.demand_distribution(t.day_grid(spark, sf_dir))
    return _rounded(out, ["median", "pct_zero", "mean", "p99"])


@query(
    f"""WITH {t.DAY_GRID_SQL},{ALL_KINDS_SQL},
means AS (SELECT pu_location_id, borough, avg(demand) AS m FROM all_kinds GROUP BY 1, 2)
SELECT {t.rnd_sql("avg(m) FILTER (WHERE borough = 'ASIA' OR pu_location_id IN (1, 3))")} AS core_mean,
  {t.rnd_sql("avg(m) FILTER (WHERE NOT (borough = 'ASIA' OR pu_location_id IN (1, 3)))")} AS outer_mean,
  {t.rnd_sql("avg(m) FILTER (WHERE borough = 'ASIA' OR pu_location_id IN (1, 3)) / avg(m) FILTER (WHERE NOT (borough = 'ASIA' OR pu_location_id IN (1, 3)))")} AS ratio
FROM means"""
)
def spatial_concentration(spark, sf_dir):
    out = explore.spatial_concentration(
        t.day_grid(spark, sf_dir), t.places(spark, sf_dir), "ASIA", [1, 3]
    )
    return _rounded(out, out.columns)


@query(
    f"""WITH {t.HOUR_GRID_SQL},{ALL_KINDS_SQL}
SELECT day_of_week, hour_of_day, {t.rnd_sql('avg(demand)')} AS mean_demand FROM all_kinds GROUP BY 1, 2"""
)
def temporal_patterns(spark, sf_dir):
    slots = explore.slot_means(slot_columns(t.hour_grid(spark, sf_dir)))
    return _rounded(slots, ["mean_demand"])


@query(
    f"""WITH {t.HOUR_GRID_SQL},{ALL_KINDS_SQL},
slots AS (SELECT day_of_week, hour_of_day, avg(demand) AS m FROM all_kinds GROUP BY 1, 2),
days AS (SELECT day_of_week, avg(m) AS m FROM slots GROUP BY 1),
curves AS (SELECT day_of_week BETWEEN 2 AND 6 AS weekday, hour_of_day, avg(m) AS m FROM slots GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY weekday ORDER BY m DESC, hour_of_day) AS rn FROM curves)
SELECT {t.rnd_sql('(SELECT m FROM days WHERE day_of_week = 2)')} AS monday,
  {t.rnd_sql('(SELECT m FROM days WHERE day_of_week = 5)')} AS thursday,
  {t.rnd_sql('100 * ((SELECT m FROM days WHERE day_of_week = 5) / (SELECT m FROM days WHERE day_of_week = 2) - 1)', 4)} AS swing_pct,
  {t.rnd_sql('(SELECT m FROM ranked WHERE weekday AND rn = 1)')} AS weekday_peak,
  (SELECT hour_of_day FROM ranked WHERE weekday AND rn = 1) AS weekday_peak_hour,
  {t.rnd_sql('(SELECT m FROM ranked WHERE NOT weekday AND rn = 1)')} AS weekend_peak,
  (SELECT hour_of_day FROM ranked WHERE NOT weekday AND rn = 1) AS weekend_peak_hour,
  {t.rnd_sql('(SELECT m FROM curves WHERE weekday AND hour_of_day = 0)')} AS weekday_midnight,
  {t.rnd_sql('(SELECT m FROM curves WHERE NOT weekday AND hour_of_day = 0)')} AS weekend_midnight,
  {t.rnd_sql('(SELECT m FROM curves WHERE NOT weekday AND hour_of_day = 0) / (SELECT m FROM curves WHERE weekday AND hour_of_day = 0)')} AS midnight_ratio"""
)
def rhythm_summary(spark, sf_dir):
    slots = t.stage(explore.slot_means(slot_columns(t.hour_grid(spark, sf_dir))), "slots")
    out = explore.rhythm_summary(slots)
    return out.select(
        *[
            t.rnd(c, 4 if c == "swing_pct" else 6).alias(c) if not c.endswith("peak_hour") else c
            for c in out.columns
        ]
    )


@query(
    f"""WITH {t.HOUR_ENRICHED_SQL},
binned AS (SELECT pickup_count, floor((tmpf - 32) * 5 / 9 / 5) * 5 AS temp_bin,
             (tmpf - 32) * 5 / 9 AS tmpc FROM enriched)
SELECT temp_bin, {t.rnd_sql('avg(pickup_count)')} AS mean_demand, count(*) AS n
FROM binned WHERE tmpc >= -20 AND tmpc < 45 GROUP BY 1"""
)
def demand_by_temperature(spark, sf_dir):
    return _rounded(explore.demand_by_temperature(t.hour_enriched(spark, sf_dir)), ["mean_demand"])


@query(
    f"""WITH {t.HOUR_ENRICHED_SQL}
SELECT CASE WHEN event_count = 0 THEN '0' WHEN event_count = 1 THEN '1' WHEN event_count = 2 THEN '2'
  WHEN event_count <= 5 THEN '3-5' ELSE '6+' END AS event_bin,
  {t.rnd_sql('avg(pickup_count)')} AS mean_demand, count(*) AS n FROM enriched GROUP BY 1"""
)
def demand_by_events(spark, sf_dir):
    return _rounded(explore.demand_by_events(t.hour_enriched(spark, sf_dir)), ["mean_demand"])
