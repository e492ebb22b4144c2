"""Monthly record files: period from the file name, drift-proof schema, provenance, ingest log."""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas as S


_PERIOD_FIELDS = [
    T.StructField("_file", T.StringType()),
    T.StructField("_year", T.IntegerType()),
    T.StructField("_month", T.IntegerType()),
]


def parse_file_name(kind: str, name: str) -> tuple[int, int]:
    """(year, month) of one file name; anything unexpected is an error, never a guess."""
    found = re.match(S.FILE_PATTERNS[kind], name)
    if found is None:
        raise ValueError(f"not a {kind} month file: {name!r}")
    word = found.group(1).lower()
    if word not in S.MONTH_WORDS:
        raise ValueError(f"unknown month {word!r} in {name!r}")
    return int(found.group(2)), S.MONTH_WORDS.index(word) + 1


def period_columns(kind: str, name: Column) -> tuple[Column, Column]:
    """The same rule as :func:`parse_file_name`, as (year, month) columns that raise on no match."""
    pattern = S.FILE_PATTERNS[kind]
    position = F.array_position(
        F.array(*[F.lit(m) for m in S.MONTH_WORDS]), F.lower(F.regexp_extract(name, pattern, 1))
    ).cast("int")
    year = F.regexp_extract(name, pattern, 2)
    bad = F.raise_error(F.concat(F.lit(f"not a {kind} month file: "), name)).cast("int")
    return F.when(year != "", year.cast("int")).otherwise(bad), F.when(
        position > 0, position
    ).otherwise(bad)


def file_name() -> Column:
    """Name of the file a row came from, with its blanks (the metadata column escapes them)."""
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename, cast and order to ``schema``; absent fields become typed NULL, extra ones go."""
    source_of = {(renames or {}).get(c, c): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{source_of[f.name]}`") if f.name in source_of else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def standardise(df: DataFrame, kind: str) -> DataFrame:
    """One landing table in the raw layout of ``kind``."""
    return conform(df, S.RAW_SCHEMAS[kind], S.RENAMES[kind])


def with_provenance(
    df: DataFrame, kind: str, file_name: Column, year: Column, month: Column, stamp: str
) -> DataFrame:
    return df.withColumns(
        {
            "source_dataset": F.lit(f"{kind}_taxi"),
            "source_file": file_name,
            "source_year": year,
            "source_month": month,
            "ingestion_timestamp": F.lit(stamp),
        }
    )


def list_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """(path) of every file under ``folder`` as Spark's own listing sees it; no content is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return listing.select("path")


def _footer(path: str) -> str:
    """Column names and types in the footer of one file, and the types Spark wrote there if it made the file."""
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        system, place = pafs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    else:
        # Object stores have other scheme names in Arrow than in Hadoop.
        named = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
        system, place = pafs.FileSystem.from_uri(f"{named}:{quote(rest)}")
    schema = pq.read_schema(place, filesystem=system)
    written = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    return f"{schema.remove_metadata()}\n{written.decode()}"


def footers(files: DataFrame) -> DataFrame:
    """(path, layout) of each file; tasks open the footers."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            with ThreadPoolExecutor(8) as pool:
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(list(pool.map(_footer, paths)), pa.string())], ["path", "layout"])

    return files.mapInArrow(task, "path string, layout string")


@dataclass(frozen=True)
class Bundle:
    """Files of one layout."""

    schema: T.StructType
    paths: list[str]


def layouts(spark: SparkSession, kind: str, folder: str) -> list[Bundle]:
    """Month files of ``kind`` by layout, so the plan has one scan per layout and not per file.

    One job lists the files, reads all footers and groups them. The driver opens one file per layout; of the others it gets
    the paths, which Spark's scan holds there in any case. A file of another name is an error.
    """
    name = F.regexp_extract("path", "[^/]*$", 0)
    month = F.lower(F.regexp_extract(name, S.FILE_PATTERNS[kind], 1))
    wrong = F.min(F.when(~month.isin([m.lower() for m in S.MONTH_WORDS]), name))
    groups = footers(list_files(spark, folder)).groupBy("layout").agg(F.sort_array(F.collect_list("path")).alias("paths"), wrong.alias("wrong")).collect()
    for group in groups:
        if group.wrong is not None:
            raise ValueError(f"not a {kind} month file: {group.wrong!r}")
    return [Bundle(spark.read.parquet(g.paths[0]).schema, g.paths) for g in sorted(groups, key=lambda g: g.paths[0])]


def read_landing(
    spark: SparkSession, kind: str, folder: str, stamp: str | None = None, found: list[Bundle] | None = None
) -> DataFrame:
    """Every month file of ``kind`` as one raw-layout table with provenance.

    Types may differ between months, so each layout is cast on its own before the union. ``found`` are the
    ``layouts`` of the folder, if they are known already.
    """
    stamp = stamp or datetime.now(timezone.utc).isoformat()
    found = layouts(spark, kind, folder) if found is None else found
    if not found:
        return with_provenance(
            spark.createDataFrame([], S.RAW_SCHEMAS[kind]),
            kind,
            F.lit(None).cast("string"),
            F.lit(None).cast("int"),
            F.lit(None).cast("int"),
            stamp,
        )
    parts = []
    for bundle in found:
        scan = spark.read.schema(bundle.schema).parquet(*bundle.paths)
        name = file_name()
        year, month = period_columns(kind, name)
        tagged = scan.select(
            "*", name.alias("_file"), year.alias("_year"), month.alias("_month")
        )
        raw = conform(
            tagged,
            T.StructType([*S.RAW_SCHEMAS[kind].fields, *_PERIOD_FIELDS]),
            S.RENAMES[kind],
        )
        parts.append(
            with_provenance(raw, kind, F.col("_file"), F.col("_year"), F.col("_month"), stamp).drop(
                "_file", "_year", "_month"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def profile_table(df: DataFrame, by: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows, column count and NULL count per column, in one aggregate; per group when asked."""
    columns = columns or [c for c in df.columns if c not in (by or [])]
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(columns)).alias("column_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns],
    )


def landing_profile(spark: SparkSession, kind: str, folder: str, found: list[Bundle] | None = None) -> DataFrame:
    """One row per landing file: row count, column count, total NULLs (columns of that file)."""
    parts = []
    for bundle in layouts(spark, kind, folder) if found is None else found:
        schema = bundle.schema
        scan = spark.read.schema(schema).parquet(*bundle.paths)
        parts.append(
            scan.groupBy(file_name().alias("source_file")).agg(
                F.count(F.lit(1)).alias("landing_row_count"),
                F.lit(len(schema)).alias("landing_column_count"),
                sum((F.count_if(F.col(f"`{c}`").isNull()) for c in schema.names), F.lit(0)).alias(
                    "landing_null_count"
                ),
            )
        )
    if not parts:
        return spark.createDataFrame(
            [],
            "source_file string, landing_row_count bigint, landing_column_count int, "
            "landing_null_count bigint",
        )
    return reduce(DataFrame.unionByName, parts)


def ingest_log(landing: DataFrame, raw: DataFrame, kind: str) -> DataFrame:
    """Landing against raw, file by file: counts before and after, and whether they agree."""
    columns = S.RAW_SCHEMAS[kind].names
    after = raw.groupBy("source_file", "source_year", "source_month", "ingestion_timestamp").agg(
        F.count(F.lit(1)).alias("raw_row_count"),
        F.lit(len(columns)).alias("raw_column_count"),
        sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0)).alias("raw_null_count"),
    )
    return landing.join(after, "source_file", "left").select(
        F.lit(kind).alias("taxi_type"),
        "source_file",
        F.col("source_year").alias("year"),
        F.col("source_month").alias("month"),
        "landing_row_count",
        F.coalesce("raw_row_count", F.lit(0)).alias("raw_row_count"),
        "landing_column_count",
        "raw_column_count",
        "landing_null_count",
        "raw_null_count",
        "ingestion_timestamp",
        F.when(F.col("landing_row_count") == F.coalesce("raw_row_count", F.lit(0)), "ok")
        .otherwise("ROW_COUNT_MISMATCH")
        .alias("status"),
    )


def ingest_totals(log: DataFrame) -> DataFrame:
    """Per kind and combined: rows in and out, range of column counts, mismatching files."""
    return (
        log.rollup("taxi_type")
        .agg(
            F.sum("landing_row_count").alias("landing_rows"),
            F.sum("raw_row_count").alias("raw_rows"),
            F.min("landing_column_count").alias("min_columns"),
            F.max("landing_column_count").alias("max_columns"),
            F.count_if(F.col("status") != "ok").alias("mismatching_files"),
        )
        .withColumn("taxi_type", F.coalesce("taxi_type", F.lit("combined")))
    )
