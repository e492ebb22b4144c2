"""Parquet tables of the raw, clean and processed layers: partitioned sinks and pruned scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _write(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _rebalanced(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a key together, as far as one task can hold them.

    Adaptive execution splits keys that are too large and merges keys that are small, so a month
    with a third of all rows becomes several well-sized files and not one huge task.
    """
    return df.hint("rebalance", *keys)


def write_raw(df: DataFrame, path: str) -> None:
    """Raw layer: folders by kind, year and month. Scan tasks are per month already: no shuffle."""
    kind = F.regexp_replace("source_dataset", "_taxi$", "")
    _write(df.withColumn("taxi_type", kind), path, ["taxi_type", "source_year", "source_month"])


def write_clean(df: DataFrame, path: str, in_place: bool = False) -> None:
    """Clean layer: year and month stay readable as partition columns.

    ``in_place`` skips the shuffle. It suits rows that still lie month by month, as they do after a
    prefiltered audit of the raw layer; for scattered rows it would make many small files.
    """
    keys = ["taxi_type", "source_year", "source_month"]
    _write(df if in_place else _rebalanced(df, keys), path, keys)


def write_processed(df: DataFrame, path: str, time: str = "pickup_hour") -> None:
    """Processed layer: folders by kind and calendar month of the cell."""
    keys = ["taxi_type", "year_month"]
    _write(_rebalanced(df.withColumn("year_month", F.date_format(time, "yyyy-MM")), keys), path, keys)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    kind: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """A layer as one table; ``kind`` prunes folders, ``columns`` prunes the scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if kind is not None:
        df = df.where(F.col("taxi_type") == kind)
    return df.select(*columns) if columns else df


def between_times(df: DataFrame, column: str, start: str, end_exclusive: str) -> DataFrame:
    """Half-open period as a plain comparison, so it reaches the scan as a pushed filter."""
    dtype = df.schema[column].dataType
    return df.where(
        (F.col(column) >= F.lit(start).cast(dtype)) & (F.col(column) < F.lit(end_exclusive).cast(dtype))
    )
