"""Top-k comparisons. Each ranking keeps k rows per task, then k rows in all; nothing is sorted whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: list sizes of the comparison ---------------------------------------------------
LIST_SIZES = [50, 200, 1000, 5000]


def top_rows(df: DataFrame, k: int, value: str, key: list[str], rank: str = "_rank") -> DataFrame:
    """Row keys and ranks of the k largest values; the row key decides ties."""
    order = [F.desc_nulls_last(value), *key]
    best = df.select(*key, value).orderBy(*order).limit(k)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order))).select(*key, rank)


def overlap(
    df: DataFrame, ks: list[int], actual: str, predicted: dict[str, str], key: list[str]
) -> DataFrame:
    """Share of the true top k that each ranking finds, for several k at once.

    One ranked list of the largest k per column serves every k.
    """
    most = max(ks)
    truth = top_rows(df, most, actual, key, "_true")
    out = None
    for model, column in predicted.items():
        both = truth.join(top_rows(df, most, column, key, "_pred"), key)
        hits = both.agg(
            *[F.count_if((F.col("_true") <= k) & (F.col("_pred") <= k)).alias(f"_{k}") for k in ks]
        ).select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(model).alias("model"),
                            F.lit(k).alias("k"),
                            (100 * F.col(f"_{k}") / F.lit(k)).alias("pct_overlap"),
                        )
                        for k in ks
                    ]
                )
            )
        )
        out = hits if out is None else out.unionByName(hits)
    return out


def random_overlap(df: DataFrame, ks: list[int]) -> DataFrame:
    """What a list of k rows picked blindly would find."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("random").alias("model"),
                        F.lit(k).alias("k"),
                        (F.lit(100.0) * k / F.nullif("n", F.lit(0))).alias("pct_overlap"),
                    )
                    for k in ks
                ]
            )
        )
    )


def busiest_day(df: DataFrame, kind: str, value: str = "actual", time: str = "pickup_hour") -> DataFrame:
    """The day with the largest total of one kind; the earlier day on a tie."""
    return (
        df.where(F.col("taxi_type") == kind)
        .groupBy(F.to_date(time).alias("pickup_date"))
        .agg(F.sum(value).alias("total"))
        .orderBy(F.desc("total"), "pickup_date")
        .limit(1)
    )


def busiest_day_lists(
    df: DataFrame,
    zones: DataFrame,
    kind: str,
    actual: str,
    predicted: str,
    k: int = 20,
    time: str = "pickup_hour",
) -> DataFrame:
    """Top-k cells of the busiest day by actual and by predicted value, with place names.

    Rows say which list they are from and whether the other list has the cell too.
    """
    day = busiest_day(df, kind, actual, time).select("pickup_date")
    key = ["pu_location_id", time]
    # One date: the day filter is a broadcast semi-join, pushed under the projections.
    rows = df.where(F.col("taxi_type") == kind).withColumn("pickup_date", F.to_date(time))
    rows = rows.join(F.broadcast(day), "pickup_date", "left_semi")
    truth = top_rows(rows, k, actual, key, "actual_rank")
    guess = top_rows(rows, k, predicted, key, "predicted_rank")
    both = truth.join(guess, key, "full")
    values = rows.select(*key, "hour_of_day", actual, predicted)
    return (
        values.join(F.broadcast(both), key)  # at most 2k rows
        .join(zones.select("pu_location_id", "zone_name", "borough"), "pu_location_id", "left")
        .select(
            "pu_location_id", "zone_name", "borough", time, "hour_of_day", actual, predicted,
            "actual_rank", "predicted_rank",
            (F.col("actual_rank").isNotNull() & F.col("predicted_rank").isNotNull()).alias("in_both"),
        )
    )
