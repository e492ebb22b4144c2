"""Demand models on ``pyspark.ml``: fit, tune, predict, persist, compare, explain.

Targets are log1p counts. A fitted demand model is one ``PipelineModel`` over a feature table: scaler (where the
regression needs one), assembler, regression, and the way back to counts that are never below zero. It saves and
loads as one. Rows with an unknown input are an error when a model is fitted as well as when it scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from ..sources import schemas as S
from .features import CONTINUOUS_COLUMNS, ROW_KEY, TARGET, Domains, assemble, feature_table, split_train_validation

# --- fixed values: model settings --------------------------------------------------------------
RIDGE_ALPHA = 1.0
LASSO_ALPHA_GRID = [10 ** (-5 + i / 4) for i in range(25)]
BOOSTING = {"stepSize": 0.1, "maxIter": 100, "maxDepth": 5, "maxBins": 64, "seed": 42}
EVALUATION_CONTEXT = [
    "taxi_type",
    "pu_location_id",
    "pickup_hour",
    "day_of_week",
    "hour_of_day",
    "baseline_pickup_count",
    "event_present",
    "is_holiday",
    "weather_severity",
]
IMPORTANCE_REPEATS = 3
# Fits of a search that run at the same time; each is one pass over a stored table.
PARALLEL_FITS = 4


def _linear(**settings) -> LinearRegression:
    # The normal-equation solver needs one pass over the data, whatever the penalty.
    return LinearRegression(
        featuresCol="features", labelCol=TARGET, solver="normal", standardization=False, **settings
    )


def fit_ols(train: DataFrame) -> Model:
    """Least squares. Full one-hot sets are rank deficient: compare predictions, not coefficients."""
    return _linear(regParam=0.0).fit(train)


def fit_ridge(train: DataFrame, alpha: float = RIDGE_ALPHA) -> Model:
    """Minimises sum(e^2) + alpha * |w|^2. Spark weighs the penalty by rows and label deviation."""
    label = train.agg(F.stddev_pop(TARGET).alias("std"), F.count(F.lit(1)).alias("n")).first()
    return _linear(regParam=alpha * label["std"] / label["n"], elasticNetParam=0.0).fit(train)


def fit_lasso(train: DataFrame, alpha: float) -> Model:
    """Minimises sum(e^2) / 2n + alpha * |w|. No default: the value comes from a search."""
    return _linear(regParam=alpha, elasticNetParam=1.0, maxIter=10_000, tol=1e-9).fit(train)


def fit_boosting(train: DataFrame, **settings) -> Model:
    """Boosted trees on the ``gradient_boosting`` feature set."""
    return GBTRegressor(
        featuresCol="features", labelCol=TARGET, **{**BOOSTING, **settings}
    ).fit(train)


# --- steps of a demand model ----------------------------------------------------------------------


class _ScaledColumns(Params):
    columns = Param(Params._dummy(), "columns", "columns to scale; each gives a column with __z behind its name", TypeConverters.toListString)


class Standardize(Estimator, _ScaledColumns, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population deviation of the rows it is fitted on; a constant column is only centred."""

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> StandardizeModel:
        names = self.getOrDefault("columns")
        row = dataset.agg(*[F.avg(c) for c in names], *[F.stddev_pop(c) for c in names]).first()
        means, deviations = list(row[: len(names)]), list(row[len(names) :])
        if None in means:
            raise ValueError("nothing to scale by: no known value in some column")
        return StandardizeModel(columns=names, means=means, deviations=[d or 1.0 for d in deviations])


class StandardizeModel(Model, _ScaledColumns, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviation per column, 1 for a constant one", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None, means: list[float] | None = None, deviations: list[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(*(self.getOrDefault(p) for p in ("columns", "means", "deviations")))
        return dataset.withColumns({f"{c}__z": (F.col(c) - F.lit(m)) / F.lit(d) for c, m, d in fitted})


def to_count(raw: Column) -> Column:
    """Back from the log scale, at least zero."""
    return F.greatest(F.expm1(raw), F.lit(0.0))


class ToCounts(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``predicted`` as a count; what the steps before have added goes."""

    dropped = Param(Params._dummy(), "dropped", "columns that only the steps before need", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, dropped: list[str] | None = None):
        super().__init__()
        self._setDefault(dropped=[])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("predicted", to_count(F.col("prediction"))).drop("prediction", *self.getOrDefault("dropped"))


class CountError(Evaluator):
    """Mean absolute error in counts of predictions on the log scale, also of many at once in one job."""

    def errors(self, dataset: DataFrame, predictions: Sequence[str]) -> list[float]:
        return list(dataset.agg(*[F.avg(F.abs(to_count(F.col(p)) - F.expm1(TARGET))) for p in predictions]).first())

    def _evaluate(self, dataset: DataFrame) -> float:
        return self.errors(dataset, ["prediction"])[0]

    def isLargerBetter(self) -> bool:
        return False


def _inputs(table: DataFrame, columns: Sequence[str], scaled: Sequence[str]) -> list[Transformer]:
    """Scaler, fitted on these rows, and assembler."""
    names = [f"{c}__z" if c in scaled else c for c in columns]
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")
    return [Standardize(columns=list(scaled)).fit(table), assembler] if scaled else [assembler]


def fit_demand(table: DataFrame, columns: Sequence[str], fit: Callable[[DataFrame], Model], scaled: Sequence[str] = ()) -> PipelineModel:
    """A demand model over named inputs; ``fit`` gets vectors and target, stored once."""
    steps = _inputs(table, columns, scaled)
    vectors = stage(PipelineModel(steps).transform(table).select("features", TARGET), "vectors")
    return PipelineModel([*steps, fit(vectors), ToCounts(dropped=["features", *[f"{c}__z" for c in scaled]])])


def regression(model: PipelineModel) -> Model:
    """The regression inside a demand model; it takes ``features`` and gives ``prediction``."""
    return model.stages[-2]


def predict_demand(model: Transformer, df: DataFrame, output: str = "predicted") -> DataFrame:
    """Predicted count, from a demand model or a bare regression."""
    out = model.transform(df)
    if "prediction" in out.columns:
        out = ToCounts().transform(out)
    return out.withColumnRenamed("predicted", output)


def save_model(model: Model, path: str) -> None:
    whole = model if isinstance(model, PipelineModel) else PipelineModel([model])
    whole.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- L1 search -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Search:
    """What an L1 search found: the best alpha, one row per alpha, and all models in the order of the grid."""

    alpha: float
    results: DataFrame
    models: list[Model]

    @property
    def best(self) -> Model:
        return next(m for m in self.models if m.getRegParam() == self.alpha)


def fit_grid(vectors: DataFrame, alphas: Sequence[float], parallelism: int = PARALLEL_FITS) -> list[Model]:
    """One L1 model per alpha over the same stored vectors, several at a time."""
    estimator = _linear(elasticNetParam=1.0, maxIter=10_000, tol=1e-9)
    fits = estimator.fitMultiple(vectors, ParamGridBuilder().addGrid(estimator.regParam, list(alphas)).build())
    found: dict[int, Model] = {}
    with ThreadPool(min(parallelism, len(alphas))) as pool:
        step = inheritable_thread_target(vectors.sparkSession)(lambda _: next(fits))
        for position, model in pool.imap_unordered(step, range(len(alphas))):
            found[position] = model
    return [found[i] for i in range(len(alphas))]


def tune_lasso(
    fit: DataFrame,
    validation: DataFrame,
    columns: Sequence[str],
    alphas: Sequence[float] = tuple(LASSO_ALPHA_GRID),
    scaled: Sequence[str] = (),
) -> Search:
    """The alpha with the lowest error in counts on the validation rows; the smallest on a tie.

    The scaler comes from the fitting rows. All models score the validation rows in one job.
    """
    prepare = PipelineModel(_inputs(fit, columns, scaled))
    vectors = stage(prepare.transform(fit).select("features", TARGET), "lasso-fit")
    found = fit_grid(vectors, alphas)
    names = [f"_p{i}" for i in range(len(found))]
    scored = prepare.transform(validation).select("features", TARGET)
    for model, name in zip(found, names):
        scored = model.copy({model.predictionCol: name}).transform(scored)
    errors = CountError().errors(scored, names)
    if None in errors:
        raise ValueError("no validation rows")
    rows = [(float(a), e, int(m.coefficients.numNonzeros())) for a, e, m in zip(alphas, errors, found)]
    results = fit.sparkSession.createDataFrame(rows, "alpha double, validation_mae double, n_nonzero_coefs int")
    return Search(min(rows, key=lambda r: (r[1], r[0]))[0], results, found)


# --- the models of a study -----------------------------------------------------------------------


@dataclass(frozen=True)
class Periods:
    """Where the validation part of the training period starts, and where that period ends."""

    validation_start: str = S.VALIDATION_START
    train_end: str = S.TRAIN_END


def fit_tuned_lasso(table: DataFrame, columns: Sequence[str], periods: Periods) -> PipelineModel:
    """Alpha from the tail of the training period, then a fit on all of it with a scaler of all of it."""
    scaled = [c for c in columns if c in CONTINUOUS_COLUMNS]
    parts = split_train_validation(table, periods.validation_start, periods.train_end)
    alpha = tune_lasso(*parts, columns, scaled=scaled).alpha
    return fit_demand(table, columns, lambda vectors: fit_lasso(vectors, alpha), scaled)


@dataclass(frozen=True)
class ModelSpec:
    feature_set: str
    fit: Callable[[DataFrame, Sequence[str], Periods], PipelineModel]


def _untuned(fit: Callable[[DataFrame], Model]) -> Callable[[DataFrame, Sequence[str], Periods], PipelineModel]:
    return lambda table, columns, periods: fit_demand(table, columns, fit)


REGISTRY: dict[str, ModelSpec] = {
    "linear_regression": ModelSpec("linear", _untuned(fit_ols)),
    "ridge": ModelSpec("linear", _untuned(fit_ridge)),
    "gradient_boosting": ModelSpec("gradient_boosting", _untuned(fit_boosting)),
    "lasso": ModelSpec("linear", fit_tuned_lasso),
}


# --- comparison ----------------------------------------------------------------------------------


def evaluation_frame(
    test: DataFrame,
    models: dict[str, Transformer],
    domains: Domains,
    groups: DataFrame,
    feature_sets: dict[str, str] | None = None,
) -> DataFrame:
    """Actual demand, context and ``pred_<model>`` for every test row.

    All models run over the same rows: their feature sets are columns of one table, so nothing is joined back. An input
    that is NULL in either set is an error, which is what keeps the row sets equal.
    """
    sets = feature_sets or {name: REGISTRY[name].feature_set for name in models}
    context = test.select("*", F.struct(*EVALUATION_CONTEXT).alias("_context"))
    out = feature_table(context, sorted(set(sets.values())), domains, groups, carry=["_context"])
    out = out.withColumn("actual", F.expm1(TARGET))
    for name, model in models.items():
        out = predict_demand(model, out, f"pred_{name}")
    return out.select("_context.*", "actual", *[f"pred_{name}" for name in models])


def importance(
    model: Transformer,
    rows: DataFrame,
    columns: Sequence[str],
    repeats: int = IMPORTANCE_REPEATS,
    seed: int = 42,
) -> DataFrame:
    """Permutation importance: mean loss of R2 (log scale) when one input is shuffled.

    All rows take part; rows with an unknown input are an error. Rows are ranked by a hash of their key.
    Every (input, repeat) is a variant of the rows in which that input comes from another rank: ranks go
    round a circle by a step that has no divisor in common with their number, so each value is used
    once. All variants are scored in one job.
    """
    order = F.xxhash64(*[F.col(k) for k in ROW_KEY], F.lit(seed))
    known = rows.select(order.alias("_order"), F.struct(*ROW_KEY).alias("_key"), *columns, TARGET)
    unknown = F.greatest(*[F.col(c).isNull().cast("int") for c in [*columns, TARGET]])
    n, n_unknown = known.agg(F.count(F.lit(1)), F.sum(unknown)).first()
    if n_unknown:
        raise ValueError(f"{n_unknown} of {n} rows have an unknown input")
    picked = stage(ranked(known, "_order", "_key"), "importance-rows")
    # Variant 0 is the sample as it is; input i is shuffled in the variants (i + 1, repeat).
    variants = [(0, 0)] + [(i, r) for i in range(1, len(columns) + 1) for r in range(repeats)]
    labelled = picked.select(
        "*",
        F.inline(
            F.array(*[
                F.struct(
                    F.lit(i).alias("_input"), F.lit(r).alias("_repeat"),
                    F.lit(_step(n, i, r, seed)).cast("decimal(19,0)").alias("_step"),
                )
                for i, r in variants
            ])
        ),
    )
    # Exact for any number of rows: the product has at most 38 digits.
    donor = F.pmod(F.col("_rank").cast("decimal(19,0)") * F.col("_step"), F.lit(n).cast("decimal(38,0)")).cast("long")
    donors = picked.select(
        F.col("_rank").alias("_donor"),
        F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("_position", "_value"),
    ).select("_donor", (F.col("_position") + 1).alias("_input"), "_value")
    mixed = labelled.withColumn("_donor", donor).join(donors, ["_donor", "_input"], "left")
    replaced = mixed.withColumns(
        {
            c: F.when(F.col("_input") == i, F.col("_value")).otherwise(F.col(c).cast("double"))
            for i, c in enumerate(columns, 1)
        }
    )
    scored = model.transform(assemble(_keep_metadata(replaced, rows, columns), list(columns)))
    error = F.pow(F.col(TARGET) - F.col("prediction"), 2)
    r2 = scored.groupBy("_input", "_repeat").agg(
        (1 - F.sum(error) / (F.var_pop(TARGET) * F.count(F.lit(1)))).alias("_r2")
    )
    names = F.array(*[F.lit(c) for c in columns])
    # One row per variant; they are written so that base and rest share one scoring run.
    losses = stage(r2, "importance-scores")
    base = losses.where(F.col("_input") == 0).select(F.col("_r2").alias("_base"))
    return (
        losses.where(F.col("_input") > 0)
        .join(F.broadcast(base), F.lit(True))
        .groupBy(F.element_at(names, F.col("_input")).alias("feature"))
        .agg(F.avg(F.col("_base") - F.col("_r2")).alias("importance"))
    )


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``_rank``, its place from 0 in the order; no task sees more than its own range of rows."""
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    # One row per range, so this window is small whatever the rows.
    before = placed.groupBy("_part").count().withColumn(
        "_before", F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return placed.join(F.broadcast(before), "_part").withColumn("_rank", inner + F.col("_before")).drop("_part", "_before")


def _step(n: int, number: int, repeat: int, seed: int) -> int:
    """A step round ``n`` ranks for one variant: far from 0 and n, and without a divisor of n."""
    share = (0.618033988749895 * (1 + number + 101 * repeat + seed)) % 0.8 + 0.1
    step = max(1, int(n * share))
    while math.gcd(step, n) != 1:
        step += 1
    return step


def _keep_metadata(df: DataFrame, like: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Category metadata survives a rewrite of the values."""
    meta = {c: like.schema[c].metadata for c in columns if like.schema[c].metadata}
    return df.withColumns({c: F.col(c).alias(c, metadata=m) for c, m in meta.items()})


def top_to_second(importances: DataFrame) -> DataFrame:
    """Largest importance, next largest, and their ratio. One row per input: a tiny table."""
    top = importances.orderBy(F.desc("importance"), "feature").limit(2)
    return top.agg(
        F.max("importance").alias("largest"),
        F.min("importance").alias("next_largest"),
        (F.max("importance") / F.nullif(F.min("importance"), F.lit(0.0))).alias("ratio"),
    )


def feature_groups(columns: Sequence[str]) -> dict[str, str]:
    """Which group of inputs a column belongs to."""
    # Labels of the groups.
    prefixes = {
        "hour_of_day_": "Hour of day",
        "day_of_week_": "Day of week",
        "month_": "Month",
        "borough_": "Zone/Borough",
        "taxi_type_": "Taxi type",
        "weather_severity_": "Weather severity",
    }
    named = {
        "log1p_baseline_pickup_count": "Baseline",
        "is_holiday": "Holiday flag",
        "event_count": "Events",
        "event_present": "Events",
    }
    return {
        c: named.get(c)
        or next((g for p, g in prefixes.items() if c.startswith(p)), "Weather (numeric)")
        for c in columns
    }


def retained_by_group(spark, columns: Sequence[str], coefficients: Sequence[float]) -> DataFrame:
    """Non-zero coefficients per group of inputs."""
    group = feature_groups(columns)
    rows = [(group[c], c, float(w)) for c, w in zip(columns, coefficients)]
    kept = F.count_if(F.col("coefficient") != 0)
    return (
        spark.createDataFrame(rows, "feature_group string, feature string, coefficient double")
        .groupBy("feature_group")
        .agg(
            F.when(kept > 0, "Retained").otherwise("Eliminated").alias("status"),
            kept.alias("retained"),
            F.count(F.lit(1)).alias("total"),
        )
    )
