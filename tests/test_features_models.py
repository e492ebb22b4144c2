from datetime import timedelta

import numpy as np
import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from tidegrid.operators import features, models

DOMAINS = features.Domains(borough=("Bronx", "Queens"))
SCHEMA = (
    "taxi_type string, pu_location_id int, pickup_hour timestamp, pickup_count long, day_of_week int, hour_of_day int, "
    "baseline_pickup_count double, baseline_source string, tmpf double, dwpf double, relh double, sknt double, gust double, "
    "vsby double, p01i double, skyc1 string, wxcodes string, weather_severity string, event_count long, event_present boolean, "
    "holiday_name string, is_holiday boolean, avg_trip_distance double, is_zero_demand_hour boolean"
)


def row(hour, count=3, base=4.0, kind="yellow", place=1, gust=None, severity="normal", **weather):
    w = {"tmpf": 40.0, "dwpf": 30.0, "relh": 50.0, "sknt": 5.0, "vsby": 10.0, "p01i": 0.0, **weather}
    at = ts(hour) if isinstance(hour, str) else hour
    return (
        kind, place, at, count, at.isoweekday() % 7 + 1, at.hour, base, "zone_hour", w["tmpf"], w["dwpf"], w["relh"],
        w["sknt"], gust, w["vsby"], w["p01i"], "CLR", None, severity, 1, True, None, False, 2.0, count == 0,
    )


def groups(spark):
    return spark.createDataFrame([(1, "Bronx"), (2, "Queens")], "pu_location_id int, borough string")


@pytest.fixture(scope="module")
def processed(spark):
    data = [
        row("2025-12-31 23:00:00"), row("2026-01-01 00:00:00", kind="green"),
        row("2026-01-01 05:00:00", tmpf=None, sknt=None, vsby=None), row("2024-06-15 12:00:00", place=2, gust=30.0, severity="mild"),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_linear_features(spark, processed):
    out = features.feature_table(processed, "linear", DOMAINS, groups(spark))
    inputs = features.feature_columns("linear", DOMAINS)
    assert out.columns == [*features.ROW_KEY, *inputs, features.TARGET]
    assert out.count() == 3  # the row without weather is gone
    assert not set(features.LEAKAGE_COLUMNS + features.NON_FEATURE_COLUMNS) & set(inputs)
    one = out.where("pu_location_id = 2").first().asDict()
    assert (one["month_6"], one["month_7"], one["borough_Queens"], one["weather_severity_mild"], one["gust"]) == (1, 0, 1, 1, 30.0)
    assert one["log1p_baseline_pickup_count"] == pytest.approx(np.log1p(4.0))
    assert one[features.TARGET] == pytest.approx(np.log1p(3))
    assert out.where("gust is null").count() == 0
    nulls = out.select(sum((F.count_if(F.col(c).isNull()) for c in out.columns), F.lit(0))).first()[0]
    assert nulls == 0


def test_width_of_the_feature_sets():
    six = features.Domains(borough=("Bronx", "Brooklyn", "EWR", "Manhattan", "Queens", "Staten Island"))
    assert len(features.feature_columns("linear", six)) == 65
    assert len(features.feature_columns("gradient_boosting", six)) == 17


def test_train_and_test_have_the_same_columns(spark, processed):
    train, test = features.split_train_test(processed)
    assert (train.count(), test.count()) == (2, 2)
    for name in features.FEATURE_SETS:
        a = features.feature_table(train, name, DOMAINS, groups(spark))
        b = features.feature_table(test, name, DOMAINS, groups(spark))
        assert a.columns == b.columns


def test_codes_follow_the_domain_and_are_nominal(spark, processed):
    out = features.feature_table(processed, "gradient_boosting", DOMAINS)
    got = rows(out.select("taxi_type", "taxi_type_code", "month_code", "pu_location_id"), "pickup_hour")
    assert got == [("yellow", 0, 5, 2), ("yellow", 0, 11, 1), ("green", 1, 0, 1)]
    assert out.schema["month_code"].metadata["ml_attr"]["type"] == "nominal"


def test_unknown_category_is_zero_everywhere(spark):
    df = spark.createDataFrame([(None,), ("purple",)], "taxi_type string")
    hot = features.one_hot(df, {"taxi_type": ["yellow", "green"]})
    assert rows(df.select(*[c.alias(n) for n, c in hot.items()])) == [(0, 0), (0, 0)]


def test_unknown_feature_set_raises(spark, processed):
    with pytest.raises(ValueError):
        features.feature_table(processed, "deep", DOMAINS)


def test_validation_split(spark):
    hours = ["2025-10-01", "2025-10-31 23:00:00", "2025-09-01", "2025-11-01", "2025-12-01", "2025-12-31 23:00:00"]
    df = spark.createDataFrame([(ts(h),) for h in hours], "pickup_hour timestamp")
    fit, validation = features.split_train_validation(df)
    assert (fit.count(), validation.count()) == (3, 3)
    with pytest.raises(ValueError):
        features.split_train_validation(df, "2026-01-01 00:00:00")


def test_scaler_uses_the_population_deviation_of_training_rows(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(10.0, 7.0)], "a double, b double")
    scaler = features.fit_scaler(train, ["a", "b"])
    assert rows(features.apply_scaler(train, scaler, ["a", "b"]), "a") == [(-1.0, 0.0), (1.0, 0.0)]
    assert rows(features.apply_scaler(test, scaler, ["a", "b"])) == [(8.0, 2.0)]


# --- models --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    n = 400
    x = np.column_stack([rng.normal(2, 1, n), rng.normal(0, 3, n), rng.integers(0, 2, n), rng.normal(0, 1, n)])
    y = 0.4 + 0.8 * x[:, 0] - 0.1 * x[:, 1] + 0.3 * x[:, 2] + rng.normal(0, 0.05, n)
    columns = ["a", "b", "c", "noise"]
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"{c} double" for c in [*columns, features.TARGET]))
    return df, features.assemble(df, columns).cache(), columns, x, y


def closed_form(x, y, alpha=0.0):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return y.mean() - x.mean(0) @ w, w


def test_ols_and_ridge_equal_the_closed_form(table):
    _, vectors, _, x, y = table
    for model, alpha in ((models.fit_ols(vectors), 0.0), (models.fit_ridge(vectors, 25.0), 25.0)):
        b, w = closed_form(x, y, alpha)
        assert np.allclose(model.coefficients.toArray(), w, atol=1e-8) and model.intercept == pytest.approx(b, abs=1e-8)
    assert np.linalg.norm(models.fit_ridge(vectors, 1000.0).coefficients.toArray()) < np.linalg.norm(models.fit_ols(vectors).coefficients.toArray())


def test_search_equals_single_fits_and_coordinate_descent(table):
    df, vectors, columns, x, y = table
    grid = [0.0001, 0.001, 0.05, 0.5, 50.0]
    search = models.tune_lasso(df, df, columns, grid)
    got = {r.alpha: r for r in search.results.collect()}
    for alpha, model in zip(grid, search.models):
        single = models.fit_lasso(vectors, alpha)
        assert np.allclose(model.coefficients.toArray(), single.coefficients.toArray(), atol=1e-6)
        w = descent(x, y, alpha)
        assert np.allclose(model.coefficients.toArray(), w, atol=1e-5)
        expected = np.abs(np.maximum(np.expm1((x - x.mean(0)) @ w + y.mean()), 0) - np.expm1(y)).mean()
        assert got[alpha].validation_mae == pytest.approx(expected, rel=1e-4)
        assert got[alpha].n_nonzero_coefs == np.count_nonzero(w)
    assert search.alpha == min(grid, key=lambda a: got[a].validation_mae) == search.best.getRegParam()
    strong = search.models[2].coefficients
    assert strong[3] == 0.0 and strong[0] != 0.0


def descent(x, y, alpha, rounds=4000):
    """Textbook coordinate descent."""
    x, y, n = x - x.mean(0), y - y.mean(), len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        for j in range(len(w)):
            pull = x[:, j] @ (y - x @ w + x[:, j] * w[j]) / n
            w[j] = np.sign(pull) * max(abs(pull) - alpha, 0) / (x[:, j] @ x[:, j] / n)
    return w


def test_ties_of_the_search_and_no_validation_rows(table):
    df, _, columns, _, _ = table
    assert models.tune_lasso(df, df, columns, [100.0, 50.0, 70.0]).alpha == 50.0
    with pytest.raises(ValueError):
        models.tune_lasso(df, df.limit(0), columns, [0.1])


def test_search_on_dependent_inputs(spark, year):
    """Full one-hot sets, all 65 inputs and the smallest alpha of the grid: every fit ends, errors fall towards least squares."""
    columns = features.feature_columns("linear", DOMAINS)
    rows_ = features.feature_table(year, "linear", DOMAINS, groups(spark))
    fit, validation = features.split_train_test(rows_, "2026-01-02 00:00:00")
    search = models.tune_lasso(fit, validation, columns, [1e-5, 1e-3, 10.0], features.CONTINUOUS_COLUMNS)
    errors = [r.validation_mae for r in search.results.orderBy("alpha").collect()]
    assert errors[2] > 2 * errors[1] and search.models[2].coefficients.numNonzeros() == 0
    single = models.fit_demand(fit, columns, lambda v: models.fit_lasso(v, 1e-3), features.CONTINUOUS_COLUMNS)
    error = single.transform(validation).agg(F.avg(F.abs(F.col("predicted") - F.expm1(features.TARGET)))).first()[0]
    assert errors[1] == pytest.approx(error, rel=1e-6)


def test_scaled_pipeline_survives_a_round_trip(table, tmp_path):
    df, _, columns, x, y = table
    model = models.fit_demand(df, columns, lambda v: models.fit_lasso(v, 0.01), ["a", "b"])
    models.save_model(model, str(tmp_path / "lasso"))
    loaded = models.load_model(str(tmp_path / "lasso"))
    out = loaded.transform(df)
    assert out.columns == [*df.columns, "predicted"]
    assert [r.predicted for r in out.collect()] == [r.predicted for r in model.transform(df).collect()]
    scaled = x.copy()
    scaled[:, :2] = (x[:, :2] - x[:, :2].mean(0)) / x[:, :2].std(0)
    want = np.maximum(np.expm1((scaled - scaled.mean(0)) @ descent(scaled, y, 0.01) + y.mean()), 0)
    assert np.allclose([r.predicted for r in out.collect()], want, rtol=1e-4)


def test_scaler_of_constant_and_unknown_columns(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = models.Standardize(columns=["a", "b"]).fit(train).transform(spark.createDataFrame([(10.0, 7.0)], "a double, b double")).first()
    assert (got.a__z, got.b__z) == (8.0, 2.0)
    with pytest.raises(ValueError):
        models.Standardize(columns=["a"]).fit(train.limit(0))


def test_unknown_inputs_are_an_error(table):
    df, _, columns, _, _ = table
    model = models.fit_demand(df, columns, models.fit_ols)
    broken = df.withColumn("b", F.when(F.col("a") < 2, F.col("b")))
    for action in (lambda: model.transform(broken).collect(), lambda: models.fit_demand(broken, columns, models.fit_ols)):
        with pytest.raises(Exception, match="null while assembling"):
            action()


def test_predictions_are_counts_and_survive_a_round_trip(table, tmp_path):
    _, vectors, _, x, y = table
    model = models.fit_ols(vectors)
    models.save_model(model, str(tmp_path / "m"))
    loaded = models.load_model(str(tmp_path / "m"))
    a = [r.predicted for r in models.predict_demand(model, vectors).collect()]
    b = [r.predicted for r in models.predict_demand(loaded, vectors).collect()]
    assert a == b and min(a) >= 0.0
    low = features.assemble(vectors.drop("features").withColumn("a", F.lit(-50.0)), ["a", "b", "c", "noise"])
    assert {r.predicted for r in models.predict_demand(model, low).collect()} == {0.0}


def test_importance_ranks_the_inputs(spark, table):
    df, vectors, columns, _, _ = table
    keyed = df.withColumns(
        {
            "taxi_type": F.lit("y"),
            "pu_location_id": F.hash("a", "b").cast("int"),
            "pickup_hour": F.lit("2024-01-01").cast("timestamp"),
        }
    )
    out = models.importance(models.fit_ols(vectors), keyed, columns, repeats=2)
    got = {r.feature: r.importance for r in out.collect()}
    assert got["a"] > got["b"] > got["c"] > abs(got["noise"]) and got["noise"] < 0.01
    top = models.top_to_second(out).first()
    assert top.largest == got["a"] and top.ratio == pytest.approx(got["a"] / got["b"])


def test_retained_by_group(spark):
    columns = ["log1p_baseline_pickup_count", "hour_of_day_0", "hour_of_day_1", "tmpf", "event_count"]
    got = rows(models.retained_by_group(spark, columns, [1.0, 0.0, 0.2, 0.0, 0.0]), "feature_group")
    assert got == [
        ("Baseline", "Retained", 1, 1), ("Events", "Eliminated", 0, 1), ("Hour of day", "Retained", 1, 2),
        ("Weather (numeric)", "Eliminated", 0, 1),
    ]


@pytest.fixture(scope="module")
def year(spark):
    rng = np.random.default_rng(1)
    start = ts("2025-12-20 00:00:00")
    data = []
    for i in range(24 * 20):
        at = start + timedelta(hours=i)
        for place in (1, 2):
            base = float(rng.uniform(1, 30))
            severity = ["normal", "mild", "severe"][i % 3]
            data.append(row(at, int(rng.poisson(base)), base, place=place, severity=severity, tmpf=float(rng.normal(40, 9))))
    return spark.createDataFrame(data, SCHEMA).cache()


def test_evaluation_frame_holds_every_model_on_the_same_rows(spark, year):
    train, test = features.split_train_test(year)
    fitted = {}
    periods = models.Periods("2025-12-28 00:00:00", "2026-01-01 00:00:00")
    for name, spec in models.REGISTRY.items():
        columns = features.feature_columns(spec.feature_set, DOMAINS)
        t = features.feature_table(train, spec.feature_set, DOMAINS, groups(spark))
        quick = name == "gradient_boosting"
        fitted[name] = models.fit_demand(t, columns, lambda v: models.fit_boosting(v, maxIter=5)) if quick else spec.fit(t, columns, periods)
    frame = models.evaluation_frame(test, fitted, DOMAINS, groups(spark))
    assert frame.columns == [*models.EVALUATION_CONTEXT, "actual", *[f"pred_{n}" for n in models.REGISTRY]]
    assert frame.count() == test.count()
    check = frame.agg(
        F.max(F.abs(F.col("pred_ridge") - F.col("pred_linear_regression"))),
        F.avg(F.abs(F.col("actual") - F.col("pred_linear_regression"))), F.avg("actual"),
    ).first()
    assert check[0] < 5 and check[1] < check[2] / 2
    lasso = frame.agg(F.avg(F.abs(F.col("actual") - F.col("pred_lasso")))).first()[0]
    assert lasso < check[2] / 2
    broken = test.withColumn("dwpf", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null while assembling"):
        models.evaluation_frame(broken, fitted, DOMAINS, groups(spark)).collect()
