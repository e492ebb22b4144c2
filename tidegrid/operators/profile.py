"""Data-quality profiles. Each is one aggregate over one scan; nothing is removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import percent, unknown_is_false
from ..sources import schemas as S
from .percentiles import column_summaries

# --- fixed values: percentiles of the numeric profile -----------------------------------------
PROFILE_PERCENTILES = {
    "p1": 0.01, "p5": 0.05, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99, "p99_9": 0.999,
}


def unpivot(df: DataFrame, columns: list[str], dtype: str, by: list[str] | None = None) -> DataFrame:
    """(column_name, value) rows for several columns of one type."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast(dtype).alias("value")) for c in columns
    ]
    return df.select(*(by or []), F.inline(F.array(*pairs)))


def _rows_from(row: DataFrame, entries: dict[str, list[Column]], names: list[str], key: str) -> DataFrame:
    """One wide aggregate row to one row per entry."""
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias(key), *[c.alias(n) for c, n in zip(cols, names)])
                    for k, cols in entries.items()
                ]
            )
        )
    )


def missingness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(columns)],
    )
    entries = {
        c: [F.col(f"_c{i}"), percent(F.col(f"_c{i}"), F.col("_n"))] for i, c in enumerate(columns)
    }
    return _rows_from(row, entries, ["null_count", "pct_null"], "column_name")


def numeric_profile(
    df: DataFrame, columns: list[str], exact: bool = True, accuracy: int = 10_000
) -> DataFrame:
    """Count, range and percentiles per column; a column without values has count 0 and no more.

    ``exact=False`` takes the percentiles from a sketch of the given accuracy, in the same pass as
    the range. The exact form needs a second pass and also resolves the far tail.
    """
    found = column_summaries(df, columns, list(PROFILE_PERCENTILES.values()), accuracy=accuracy, exact=exact)
    return found.select(
        "column_name",
        "count",
        "min",
        *[F.col("percentiles")[i].alias(n) for i, n in enumerate(PROFILE_PERCENTILES)],
        "max",
    )


def summary_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, range and quartiles per column."""
    return column_summaries(df, columns, [0.25, 0.5, 0.75]).select(
        "column_name", "count", "mean", "stddev", "min",
        *[F.col("percentiles")[i].alias(n) for i, n in enumerate(["p25", "p50", "p75"])],
        "max",
    )


def code_distribution(df: DataFrame, valid: dict[str, tuple | None]) -> DataFrame:
    """Rows per code of each coded field, with a flag for codes outside the valid set.

    NULL stays NULL and is never unexpected.
    """
    expected = F.lit(False)
    for column, codes in valid.items():
        known = (
            F.col("value").isin(*[str(c) for c in codes]) if codes is not None else F.lit(True)
        )
        expected = F.when(F.col("column_name") == column, known).otherwise(expected)
    return (
        unpivot(df, list(valid), "string")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("is_unexpected", F.col("value").isNotNull() & unknown_is_false(~expected))
    )


def place_validity(
    df: DataFrame,
    columns: list[str],
    place_range: tuple[int, int] = S.PLACE_RANGE,
    placeholders: tuple[int, ...] = S.PLACEHOLDER_PLACES,
) -> DataFrame:
    """Missing, out-of-range and placeholder ids per place column."""
    low, high = place_range
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            agg
            for i, c in enumerate(columns)
            for agg in (
                F.count_if(F.col(c).isNull()).alias(f"_null{i}"),
                F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(f"_out{i}"),
                F.count_if(F.col(c).isin(*placeholders)).alias(f"_place{i}"),
            )
        ],
    )
    n = F.col("_n")
    entries = {
        c: [
            F.col(f"_null{i}"), F.col(f"_out{i}"), F.col(f"_place{i}"),
            percent(F.col(f"_null{i}"), n), percent(F.col(f"_out{i}"), n),
        ]
        for i, c in enumerate(columns)
    }
    names = ["null_count", "out_of_range_count", "placeholder_count", "pct_null", "pct_out_of_range"]
    return _rows_from(row, entries, names, "column_name")


def period_profile(
    df: DataFrame,
    column: str = "pickup_datetime",
    start: str = S.PERIOD_START,
    end_exclusive: str = S.PERIOD_END,
) -> DataFrame:
    """Earliest and latest time, and how many rows lie outside the period."""
    c = F.col(column)
    outside = (c < F.lit(start).cast("timestamp")) | (c >= F.lit(end_exclusive).cast("timestamp"))
    return df.agg(
        F.min(c).alias("earliest"),
        F.max(c).alias("latest"),
        F.count_if(outside).alias("records_outside_study_period"),
        percent(F.count_if(outside), F.count(F.lit(1))).alias("pct_outside_study_period"),
    )


def temporal_profile(
    df: DataFrame,
    start: str = "pickup_datetime",
    end: str = "dropoff_datetime",
    minutes: str = "trip_duration_minutes",
) -> DataFrame:
    both = F.col(start).isNotNull() & F.col(end).isNotNull()
    m = F.col(minutes)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(both).alias("rows_with_both_timestamps"),
        F.count_if(~both).alias("rows_missing_a_timestamp"),
        F.count_if(both & (F.col(end) < F.col(start))).alias("negative_duration"),
        F.count_if(both & (m == 0)).alias("zero_duration"),
        F.count_if(both & (m > 180)).alias("duration_over_3h"),
        F.count_if(both & (m > 1440)).alias("duration_over_24h"),
    )


def schema_table(spark, schemas: dict[str, T.StructType]) -> DataFrame:
    """Schemas as (table_name, column_name, data_type) rows; driver metadata only."""
    rows = [(t, f.name, f.dataType.simpleString()) for t, s in schemas.items() for f in s.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def schema_diff(listing: DataFrame, left: str, right: str) -> DataFrame:
    """Columns found on one side only, and columns whose types differ."""
    l = listing.where(F.col("table_name") == left).select("column_name", F.col("data_type").alias("left_type"))
    r = listing.where(F.col("table_name") == right).select("column_name", F.col("data_type").alias("right_type"))
    return (
        l.join(r, "column_name", "full")
        .where(~F.col("left_type").eqNullSafe(F.col("right_type")))
        .withColumn(
            "difference",
            F.when(F.col("right_type").isNull(), "only_left")
            .when(F.col("left_type").isNull(), "only_right")
            .otherwise("type_mismatch"),
        )
    )
