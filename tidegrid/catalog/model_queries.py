"""Feature tables and models on the enriched hourly grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, metrics, models
from ..session import stage, staging_path
from . import tables as t
from .registry import query

SEVERITIES = ("normal", "mild", "severe")


def domains(spark, sf_dir) -> features.Domains:
    return features.Domains(
        taxi_type=tuple(t.HOUR_KINDS), borough=tuple(t.group_names(spark, sf_dir))
    )


def processed(spark, sf_dir):
    """The enriched grid, written once: every model query reads it several times."""
    return stage(t.hour_enriched(spark, sf_dir), "processed")


def _table(spark, sf_dir, df, feature_set):
    return features.feature_table(df, feature_set, domains(spark, sf_dir), t.groups(spark, sf_dir))


# --- feature tables -----------------------------------------------------------------------------------

_NUMBERS_SQL = f"""{t.rnd_sql('ln(1 + baseline_pickup_count)')} AS log1p_baseline_pickup_count,
  CAST(event_count AS DOUBLE) AS event_count, tmpf, dwpf, relh, sknt, coalesce(gust, 0.0) AS gust, vsby, p01i,
  CAST(event_present AS INT) AS event_present, CAST(is_holiday AS INT) AS is_holiday,
  {t.rnd_sql('ln(1 + pickup_count)')} AS log1p_pickup_count"""
_WEATHER_ROWS = "tmpf IS NOT NULL AND sknt IS NOT NULL AND vsby IS NOT NULL"
_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_DOMAIN_SQL = {
    "taxi_type": t.HOUR_KINDS, "hour_of_day": range(24), "day_of_week": range(1, 8), "month": range(1, 13),
    "weather_severity": SEVERITIES,
}
_SOURCE_SQL = (
    t.HOUR_ENRICHED_SQL
    + f""",
source AS (SELECT *, CAST(month(pickup_hour) AS INT) AS month FROM enriched WHERE {_WEATHER_ROWS})"""
)


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _onehot_sql() -> str:
    return ", ".join(
        f'coalesce(CAST({c} = {_lit(v)} AS INT), 0) AS "{c}_{v}"'
        for c, values in {**_DOMAIN_SQL, "borough": _REGIONS}.items()
        for v in values
    )


def _codes_sql() -> str:
    return ", ".join(
        f"CASE {c} "
        + " ".join(f"WHEN {_lit(v)} THEN {i}" for i, v in enumerate(values))
        + f" END AS {c}_code"
        for c, values in _DOMAIN_SQL.items()
    )


def _shown(df):
    logs = ["log1p_baseline_pickup_count", "log1p_pickup_count"]
    return df.select(
        *[t.text(c) if c == "pickup_hour" else t.rnd(c).alias(c) if c in logs else F.col(f"`{c}`") for c in df.columns]
    )


@query(
    f"""WITH {_SOURCE_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, {_NUMBERS_SQL}, {_onehot_sql()} FROM source"""
)
def features_linear(spark, sf_dir):
    return _shown(_table(spark, sf_dir, t.hour_enriched(spark, sf_dir), "linear"))


@query(
    f"""WITH {_SOURCE_SQL}
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')}, {_NUMBERS_SQL}, {_codes_sql()} FROM source"""
)
def features_tree(spark, sf_dir):
    return _shown(_table(spark, sf_dir, t.hour_enriched(spark, sf_dir), "gradient_boosting"))


@query(
    f"""WITH {_SOURCE_SQL}
SELECT CASE WHEN pickup_hour >= TIMESTAMP '{t.HOUR_TRAIN_END}' THEN 'test'
  WHEN pickup_hour >= TIMESTAMP '{t.HOUR_VALIDATION_START}' THEN 'validation' ELSE 'fit' END AS part,
  taxi_type, count(*) AS n, CAST(sum(pickup_count) AS BIGINT) AS demand
FROM source GROUP BY 1, 2"""
)
def time_split(spark, sf_dir):
    rows = features.with_weather(t.hour_enriched(spark, sf_dir))
    rows = stage(rows.select("taxi_type", "pickup_hour", "pickup_count"), "split")
    train, test = features.split_train_test(rows, t.HOUR_TRAIN_END)
    fit, validation = features.split_train_validation(train, t.HOUR_VALIDATION_START, t.HOUR_TRAIN_END)
    parts = {"fit": fit, "validation": validation, "test": test}
    out = None
    for name, df in parts.items():
        part = df.groupBy(F.lit(name).alias("part"), "taxi_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum("pickup_count").alias("demand")
        )
        out = part if out is None else out.unionByName(part)
    return out


SCALED = ["log1p_baseline_pickup_count", "event_count", "tmpf", "sknt", "gust", "p01i"]


@query(
    f"""WITH {_SOURCE_SQL},
inputs AS (SELECT taxi_type, pu_location_id, pickup_hour, ln(1 + baseline_pickup_count) AS log1p_baseline_pickup_count,
  CAST(event_count AS DOUBLE) AS event_count, tmpf, sknt, coalesce(gust, 0.0) AS gust, p01i FROM source),
fitted AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in SCALED)}
  FROM inputs WHERE pickup_hour < TIMESTAMP '{t.HOUR_TRAIN_END}')
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')},
  {', '.join(t.rnd_sql(f'({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END', 5) + f' AS {c}' for c in SCALED)}
FROM inputs CROSS JOIN fitted WHERE pickup_hour >= TIMESTAMP '{t.HOUR_TRAIN_END}'"""
)
def scaled_features(spark, sf_dir):
    table = _table(spark, sf_dir, processed(spark, sf_dir), "linear")
    train, test = features.split_train_test(table, t.HOUR_TRAIN_END)
    scaled = features.apply_scaler(test, features.fit_scaler(train, SCALED), SCALED)
    return scaled.select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), *[t.rnd(c, 5).alias(c) for c in SCALED]
    )


# --- models: one input, where least squares has a closed form in SQL -----------------------------------



def _moments_sql(end: str) -> str:
    return (
        _SOURCE_SQL
        + f""",
xy AS (SELECT *, ln(1 + baseline_pickup_count) AS x, ln(1 + pickup_count) AS y FROM source),
moments AS (
  SELECT avg(x) AS mx, avg(y) AS my, sum(x * x) - count(*) * avg(x) * avg(x) AS sxx,
    sum(x * y) - count(*) * avg(x) * avg(y) AS sxy, count(*) AS n
  FROM xy WHERE pickup_hour < TIMESTAMP '{end}')"""
    )


_ONE_INPUT_SQL = _moments_sql(t.HOUR_TRAIN_END)


def _one_input_sql(slope: str) -> str:
    return f"""WITH {_ONE_INPUT_SQL},
model AS (SELECT *, {slope} AS w FROM moments)
SELECT taxi_type, pu_location_id, {t.text_sql('pickup_hour')},
  {t.rnd_sql('greatest(exp(my + w * (x - mx)) - 1, 0)', 5)} AS predicted
FROM xy CROSS JOIN model WHERE pickup_hour >= TIMESTAMP '{t.HOUR_TRAIN_END}'"""


def _one_input(spark, sf_dir, fit):
    table = _table(spark, sf_dir, processed(spark, sf_dir), "linear")
    table = features.assemble(table, ["log1p_baseline_pickup_count"])
    train, test = features.split_train_test(table, t.HOUR_TRAIN_END)
    predicted = models.predict_demand(fit(train.select("features", features.TARGET)), test)
    return predicted.select(
        "taxi_type", "pu_location_id", t.text("pickup_hour"), t.rnd("predicted", 5).alias("predicted")
    )


@query(_one_input_sql("sxy / sxx"))
def ols_fit(spark, sf_dir):
    return _one_input(spark, sf_dir, models.fit_ols)


@query(_one_input_sql("sxy / (sxx + 50.0)"))
def ridge_fit(spark, sf_dir):
    return _one_input(spark, sf_dir, lambda train: models.fit_ridge(train, alpha=50.0))


@query(_one_input_sql("greatest(sxy / n - 0.001, 0) / (sxx / n)"))
def lasso_fit(spark, sf_dir):
    return _one_input(spark, sf_dir, lambda train: models.fit_lasso(train, alpha=0.001))


# --- models: all inputs --------------------------------------------------------------------------------

PERIODS = models.Periods(t.HOUR_VALIDATION_START, t.HOUR_TRAIN_END)


def _linear_split(spark, sf_dir):
    """Linear inputs of the fitting and the validation part."""
    table = stage(_table(spark, sf_dir, t.hour_enriched(spark, sf_dir), "linear"), "features-linear")
    train, _ = features.split_train_test(table, t.HOUR_TRAIN_END)
    return features.split_train_validation(train, t.HOUR_VALIDATION_START, t.HOUR_TRAIN_END)


def _search(spark, sf_dir):
    columns = features.feature_columns("linear", domains(spark, sf_dir))
    return columns, models.tune_lasso(*_linear_split(spark, sf_dir), columns, scaled=features.CONTINUOUS_COLUMNS)


@query()
def lasso_path(spark, sf_dir):
    return _search(spark, sf_dir)[1].results


@query()
def lasso_retained(spark, sf_dir):
    columns, search = _search(spark, sf_dir)
    return models.retained_by_group(spark, columns, search.best.coefficients)


ALPHAS_SQL = "SELECT CAST(unnest(range(25)) AS INT) AS i"


@query(f"""WITH {_moments_sql(t.HOUR_VALIDATION_START)},
spread AS (SELECT stddev_pop(x) AS sx FROM xy WHERE pickup_hour < TIMESTAMP '{t.HOUR_VALIDATION_START}'),
alphas AS ({ALPHAS_SQL}),
path AS (
  SELECT i, power(10, -5 + i / 4.0) AS alpha, mx, my, sx, greatest(sxy / n / sx - power(10, -5 + i / 4.0), 0) AS w
  FROM moments CROSS JOIN spread CROSS JOIN alphas)
SELECT i AS position, {t.rnd_sql('avg(abs(greatest(exp(my + w * (x - mx) / sx) - 1, 0) - (exp(y) - 1)))', 5)} AS validation_mae,
  CAST(max(CASE WHEN w > 0 THEN 1 ELSE 0 END) AS INT) AS n_nonzero_coefs
FROM xy CROSS JOIN path
WHERE pickup_hour >= TIMESTAMP '{t.HOUR_VALIDATION_START}' AND pickup_hour < TIMESTAMP '{t.HOUR_TRAIN_END}' GROUP BY i""")
def lasso_path_one_input(spark, sf_dir):
    """The search over one scaled input, which has a closed form."""
    one = ["log1p_baseline_pickup_count"]
    found = models.tune_lasso(*_linear_split(spark, sf_dir), one, scaled=one).results
    return found.select(
        F.round((F.log10("alpha") + 5) * 4).cast("int").alias("position"), t.rnd("validation_mae", 5).alias("validation_mae"), "n_nonzero_coefs"
    )


def _fitted(spark, sf_dir, df, names):
    """Fitted models on the training period."""
    train, _ = features.split_train_test(df, t.HOUR_TRAIN_END)
    out, tables = {}, {}
    for name in names:
        feature_set = models.REGISTRY[name].feature_set
        if feature_set not in tables:
            tables[feature_set] = stage(_table(spark, sf_dir, train, feature_set), f"train-{feature_set}")
        columns = features.feature_columns(feature_set, domains(spark, sf_dir))
        out[name] = models.REGISTRY[name].fit(tables[feature_set], columns, PERIODS)
    return out


@query()
def gbt_fit(spark, sf_dir):
    df = processed(spark, sf_dir)
    model = _fitted(spark, sf_dir, df, ["gradient_boosting"])["gradient_boosting"]
    _, test = features.split_train_test(df, t.HOUR_TRAIN_END)
    return models.predict_demand(model, _table(spark, sf_dir, test, "gradient_boosting")).select(*features.ROW_KEY, "predicted")


@query()
def evaluation_frame(spark, sf_dir):
    df = processed(spark, sf_dir)
    fitted = _fitted(spark, sf_dir, df, list(models.REGISTRY))
    _, test = features.split_train_test(df, t.HOUR_TRAIN_END)
    return models.evaluation_frame(test, fitted, domains(spark, sf_dir), t.groups(spark, sf_dir))


@query()
def model_comparison(spark, sf_dir):
    frame = stage(evaluation_frame(spark, sf_dir), "evaluation")
    return metrics.regression_metrics(frame, "actual", {n: f"pred_{n}" for n in models.REGISTRY})


@query()
def permutation_importance(spark, sf_dir):
    df = processed(spark, sf_dir)
    model = _fitted(spark, sf_dir, df, ["gradient_boosting"])["gradient_boosting"]
    _, test = features.split_train_test(df, t.HOUR_TRAIN_END)
    columns = features.feature_columns("gradient_boosting", domains(spark, sf_dir))
    return models.importance(models.regression(model), _table(spark, sf_dir, test, "gradient_boosting"), columns)


@query(_one_input_sql("sxy / sxx"))
def model_round_trip(spark, sf_dir):
    def fit_and_reload(train):
        path = staging_path(spark, "model")
        models.save_model(models.fit_ols(train), path)
        return models.load_model(path)

    return _one_input(spark, sf_dir, fit_and_reload)
