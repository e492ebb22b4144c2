"""Feature tables for the demand models: fixed domains, no leakage, train-only scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import schemas as S

# --- fixed values: column roles and category domains --------------------------------------------
LEAKAGE_COLUMNS = [
    "avg_trip_distance",
    "avg_trip_duration_minutes",
    "avg_passenger_count",
    "extreme_trip_distance_count",
    "extreme_trip_duration_count",
    "is_zero_demand_hour",
]
NON_FEATURE_COLUMNS = ["holiday_name", "baseline_source", "skyc1", "wxcodes"]
CONTINUOUS_COLUMNS = ["log1p_baseline_pickup_count", "event_count", *S.WEATHER_READINGS]
BOOLEAN_COLUMNS = ["event_present", "is_holiday"]
REQUIRED_WEATHER = ["tmpf", "sknt", "vsby"]
TARGET = "log1p_pickup_count"
ROW_KEY = ["taxi_type", "pu_location_id", "pickup_hour"]


@dataclass(frozen=True)
class Domains:
    """Every category a feature may take, independent of the rows at hand."""

    taxi_type: Sequence[str] = ("yellow", "green")
    hour_of_day: Sequence[int] = tuple(range(24))
    day_of_week: Sequence[int] = tuple(range(1, 8))
    month: Sequence[int] = tuple(range(1, 13))
    weather_severity: Sequence[str] = ("normal", "mild", "severe")
    borough: Sequence[str] = field(default_factory=tuple)

    def shared(self) -> dict[str, Sequence]:
        return {
            n: getattr(self, n)
            for n in ("taxi_type", "hour_of_day", "day_of_week", "month", "weather_severity")
        }


FEATURE_SETS = ("linear", "gradient_boosting")


def add_month(df: DataFrame, time: str = "pickup_hour") -> DataFrame:
    return df.withColumn("month", F.month(time))


def add_log_baseline(df: DataFrame) -> DataFrame:
    """log1p of the baseline as one more column; the baseline itself stays."""
    return df.withColumn("log1p_baseline_pickup_count", F.log1p("baseline_pickup_count"))


def with_weather(df: DataFrame) -> DataFrame:
    """Drop rows the station has no core readings for."""
    return df.na.drop(subset=REQUIRED_WEATHER)


def fill_gust(df: DataFrame) -> DataFrame:
    """No reported gust means no gust."""
    return df.withColumn("gust", F.coalesce("gust", F.lit(0.0)))


def one_hot(df: DataFrame, domains: dict[str, Sequence]) -> dict:
    """``column_value`` indicator per domain value; unknown or NULL is zero everywhere."""
    return {
        f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
        for c, values in domains.items()
        for v in values
    }


def category_codes(domains: dict[str, Sequence]) -> dict:
    """Position in the domain as one column per category; unknown or NULL is NULL.

    The columns say that they are nominal, so tree models treat them as categories.
    """
    out = {}
    for c, values in domains.items():
        position = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c)).cast("int")
        nominal = {"ml_attr": {"type": "nominal", "name": f"{c}_code", "vals": [str(v) for v in values]}}
        out[f"{c}_code"] = (F.nullif(position, F.lit(0)) - 1).alias(f"{c}_code", metadata=nominal)
    return out


def feature_columns(feature_set: str, domains: Domains) -> list[str]:
    """Names of the model inputs, in vector order."""
    _check([feature_set])
    numbers = [*CONTINUOUS_COLUMNS, *BOOLEAN_COLUMNS]
    if feature_set == "linear":
        domain = {**domains.shared(), "borough": domains.borough}
        return [*numbers, *[f"{c}_{v}" for c, values in domain.items() for v in values]]
    return [*numbers, "pu_location_id", *[f"{c}_code" for c in domains.shared()]]


def _check(sets: Sequence[str]) -> None:
    unknown = [s for s in sets if s not in FEATURE_SETS]
    if unknown or not sets:
        raise ValueError(f"feature sets are {FEATURE_SETS}, got {unknown or sets}")


def feature_table(
    processed: DataFrame,
    feature_set: str | Sequence[str],
    domains: Domains,
    groups: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Row key, named numeric inputs and target; ``carry`` columns ride along untouched.

    ``linear`` knows a place by its group and one-hot encodes; ``gradient_boosting`` keeps the place
    id as a number and codes categories by position. Several sets may share one table.
    """
    sets = [feature_set] if isinstance(feature_set, str) else list(feature_set)
    _check(sets)
    df = add_log_baseline(fill_gust(with_weather(add_month(processed))))
    inputs = {
        **{c: F.col(c).cast("double") for c in CONTINUOUS_COLUMNS},
        **{c: F.col(c).cast("int") for c in BOOLEAN_COLUMNS},
    }
    if "linear" in sets:
        if groups is None:
            raise ValueError("the linear feature set needs the place groups")
        df = df.join(groups, "pu_location_id", "left")
        inputs |= one_hot(df, {**domains.shared(), "borough": domains.borough})
    if "gradient_boosting" in sets:
        inputs |= category_codes(domains.shared())
    kept = [*ROW_KEY, *[c for c in carry if c not in ROW_KEY and c not in inputs]]
    return df.select(
        *kept,
        *[e.alias(n) if not n.endswith("_code") else e for n, e in inputs.items()],
        F.log1p("pickup_count").alias(TARGET),
    )


def assemble(
    df: DataFrame, columns: list[str], output: str = "features", invalid: str = "error"
) -> DataFrame:
    """The inputs as one vector column; a row with an unknown input is an error, or is kept or skipped on request."""
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid=invalid).transform(df)


def split_train_test(
    df: DataFrame, train_end: str = S.TRAIN_END, time: str = "pickup_hour"
) -> tuple[DataFrame, DataFrame]:
    boundary = F.lit(train_end).cast("timestamp")
    return df.where(F.col(time) < boundary), df.where(F.col(time) >= boundary)


def split_train_validation(
    train: DataFrame,
    validation_start: str = S.VALIDATION_START,
    train_end: str = S.TRAIN_END,
    time: str = "pickup_hour",
) -> tuple[DataFrame, DataFrame]:
    """The tail of the training period for tuning; it may not touch the test period."""
    if validation_start >= train_end:
        raise ValueError(f"validation must start before the training period ends ({train_end})")
    return split_train_test(train, validation_start, time)


def fit_scaler(train: DataFrame, columns: Sequence[str] = tuple(CONTINUOUS_COLUMNS)) -> DataFrame:
    """One row: mean and population deviation per column, from the rows given."""
    return train.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    )


def apply_scaler(
    df: DataFrame, scaler: DataFrame, columns: Sequence[str] = tuple(CONTINUOUS_COLUMNS)
) -> DataFrame:
    """(x - mean) / deviation; a constant column is only centred. The scaler is a one-row side."""
    joined = df.join(F.broadcast(scaler), F.lit(True))
    scaled = {
        c: (F.col(c) - F.col(f"{c}__mean"))
        / F.when(F.col(f"{c}__std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__std"))
        for c in columns
    }
    return joined.withColumns(scaled).select(*df.columns)
