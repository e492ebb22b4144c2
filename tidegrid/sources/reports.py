"""Report tables as JSON or CSV folders. Each report is an aggregate, so one file is right."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """``df`` must be an aggregate report (ledger, summary, log): a bounded number of rows."""
    writer = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)


def stack_reports(*reports: DataFrame) -> DataFrame:
    """Several ledgers or logs under each other, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)
