"""Regression errors, as one aggregate for any number of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _measures(actual: str, predicted: str) -> dict[str, Column]:
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    n = F.count(F.lit(1))
    squared = F.sum((a - p) * (a - p))
    spread = F.var_pop(a) * n
    # One row has no R2; constant demand scores 1 when every prediction is right, else 0.
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(spread == 0, F.when(squared == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(1 - squared / F.nullif(spread, F.lit(0.0)))
    )
    return {"mae": F.avg(F.abs(a - p)), "rmse": F.sqrt(squared / F.nullif(n, F.lit(0))), "r2": r2, "n": n}


def regression_metrics(
    df: DataFrame, actual: str, predicted: dict[str, str], by: str | None = None
) -> DataFrame:
    """MAE, RMSE, R2 and row count per model, and per value of ``by`` when given.

    All models are measured in the same scan. Rows with a NULL group have no group.
    """
    source = df.where(F.col(by).isNotNull()) if by else df
    measures = {m: _measures(actual, c) for m, c in predicted.items()}
    wide = source.groupBy(*([by] if by else [])).agg(
        *[e.alias(f"_{i}_{k}") for i, m in enumerate(measures) for k, e in measures[m].items()]
    )
    return wide.select(
        *([by] if by else []),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("model"), *[F.col(f"_{i}_{k}").alias(k) for k in measures[m]])
                    for i, m in enumerate(measures)
                ]
            )
        ),
    )


def mae_ratio(by_group: DataFrame, by: str, high: str, low: str) -> DataFrame:
    """How much larger the error is in one group than in another, per model."""

    def of(value: str) -> Column:
        return F.max(F.when(F.col(by) == value, F.col("mae")))

    return by_group.groupBy("model").agg((of(high) / F.nullif(of(low), F.lit(0.0))).alias("mae_ratio"))


def mean_levels(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Mean of the actual and of every predicted column (a sanity line for a prediction run)."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(n) for n, c in columns.items()])
