"""Side tables: weather, interval events, calendar days, places, geocodes, outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas as S
from .tables import between_times

# --- fixed value: what a trace of rain counts as, in inches -----------------------------------
TRACE_PRECIPITATION = 0.005


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Header CSV under an explicit schema: no inference pass over the file."""
    reader = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.csv(path)


def weather_types(raw: DataFrame) -> DataFrame:
    """Text readings to numbers: ``M``/blank/any other text is NULL, rain ``T`` is a trace."""
    readings = {
        c: F.nanvl(F.expr(f"try_cast(nullif(nullif(trim({c}), ''), 'M') as double)"), F.lit(None).cast("double"))
        for c in S.WEATHER_READINGS
        if c != "p01i"
    }
    rain = F.when(F.trim("p01i") == "T", F.lit(TRACE_PRECIPITATION)).otherwise(
        F.nanvl(F.expr("try_cast(trim(p01i) as double)"), F.lit(None).cast("double"))
    )
    texts = {c: F.expr(f"nullif(nullif(trim({c}), ''), 'M')") for c in ("skyc1", "wxcodes")}
    return raw.withColumns(
        {"valid": F.expr("try_cast(valid as timestamp)"), **readings, "p01i": rain, **texts}
    )


def read_weather_raw(spark: SparkSession, path: str, schema: T.StructType = S.WEATHER_RAW) -> DataFrame:
    """Observation file; every cell is text until :func:`weather_types` has looked at it."""
    return weather_types(read_csv(spark, path, schema))


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned hourly weather (CSV), keyed for the grid."""
    return read_csv(
        spark, path, S.WEATHER_CLEAN, timestampFormat="yyyy-MM-dd HH:mm:ss"
    ).withColumnRenamed("date_hour", "pickup_hour")


def read_events_raw(spark: SparkSession, path: str, columns: list[str] = S.EVENT_COLUMNS) -> DataFrame:
    """Interval events as text; nothing is parsed or dropped on load."""
    return read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def placed_events(df: DataFrame) -> DataFrame:
    """Events that have a place, in the three typed columns the grid needs."""
    return df.where(F.col("pu_location_id").isNotNull()).select(
        F.col("pu_location_id").cast("double").cast("int").alias("pu_location_id"),
        F.col("start_date_time").cast("timestamp").alias("start_date_time"),
        F.col("end_date_time").cast("timestamp").alias("end_date_time"),
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned events written by :func:`write_dimension`."""
    return placed_events(spark.read.parquet(path))


def events_in_period(df: DataFrame, start: str, end_exclusive: str, column: str = "start_date_time") -> DataFrame:
    """The period a download would ask for; the filter is pushed to the scan."""
    return between_times(df, column, start, end_exclusive)


def read_holidays_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.HOLIDAYS_RAW)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Place table: id, group, name. ``N/A`` in the file is a missing value."""
    return read_csv(spark, path, S.ZONE_LOOKUP, nullValue="N/A").select(
        F.col("LocationID").alias("pu_location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        "service_zone",
    )


def real_places(zones: DataFrame, placeholders: tuple[int, ...] = S.PLACEHOLDER_PLACES) -> DataFrame:
    """Place ids with an outline, i.e. without the placeholder ids."""
    return zones.where(~F.col("pu_location_id").isin(*placeholders)).select("pu_location_id")


def place_groups(zones: DataFrame) -> DataFrame:
    """Place id to group (borough)."""
    return zones.select("pu_location_id", "borough")


def group_domain(zones: DataFrame, placeholders: tuple[int, ...] = S.PLACEHOLDER_PLACES) -> list[str]:
    """Sorted group names of the real places: the one-hot domain (a handful of values)."""
    rows = (
        zones.where(~F.col("pu_location_id").isin(*placeholders) & F.col("borough").isNotNull())
        .select("borough")
        .distinct()
        .orderBy("borough")
        .collect()
    )
    return [r.borough for r in rows]


def read_geocodes(spark: SparkSession, path: str) -> DataFrame:
    """Location key and group to coordinates; NULL coordinates mean "looked up, not found"."""
    return spark.read.schema(S.GEOCODES).parquet(path)


def geocodes_from_cache(spark: SparkSession, path: str) -> DataFrame:
    """The lookup cache as JSON, ``{"key|||group": {"lat": .., "lon": ..} | null}``, as a table.

    The file is one JSON object with one entry per looked-up key.
    """
    text = spark.read.text(path, wholetext=True)
    entries = text.select(
        F.explode(F.from_json("value", "map<string, struct<lat: double, lon: double>>")).alias("k", "v")
    )
    return entries.select(
        F.substring_index("k", "|||", 1).alias("location_key"),
        F.element_at(F.split("k", r"\|\|\|"), -1).alias("borough"),
        F.col("v.lat").alias("lat"),
        F.col("v.lon").alias("lon"),
    )


def write_dimension(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
