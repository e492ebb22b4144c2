"""Descriptive tables of the grid: distribution, concentration, rhythm, weather and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import celsius, event_count_bin, range_bins
from ..session import stage
from .percentiles import exact_percentiles

# --- fixed values: bins and day classes ------------------------------------------------------------
TEMPERATURE_EDGES = [float(t) for t in range(-20, 46, 5)]
WEEKDAYS = [2, 3, 4, 5, 6]
MONDAY, THURSDAY = 2, 5


def all_kinds(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Demand per (place, hour) over all kinds. ``extra`` are columns the hour determines."""
    return df.groupBy("pu_location_id", "pickup_hour", *(extra or [])).agg(
        F.sum("pickup_count").alias("pickup_count")
    )


def demand_distribution(df: DataFrame) -> DataFrame:
    """Median, zero share, mean, P99 and maximum of demand per (place, hour); sums are stored, for three reads."""
    cells = stage(all_kinds(df).select("pickup_count"), "demand")
    shape = cells.agg(
        (100.0 * F.count_if(F.col("pickup_count") == 0) / F.count(F.lit(1))).alias("pct_zero"),
        F.avg("pickup_count").alias("mean"),
        F.max("pickup_count").alias("max"),
    )
    ranks = exact_percentiles(cells, "pickup_count", [0.5, 0.99])
    return shape.join(F.broadcast(ranks), F.lit(True)).select(  # one row each
        F.col("percentiles")[0].alias("median"), "pct_zero", "mean",
        F.col("percentiles")[1].alias("p99"), "max",
    )


def spatial_concentration(
    df: DataFrame, zones: DataFrame, core_group: str, core_places: list[int]
) -> DataFrame:
    """Mean place demand in the core (a group plus named places) against the rest."""
    means = all_kinds(df).groupBy("pu_location_id").agg(F.avg("pickup_count").alias("_mean"))
    core = (F.coalesce(F.col("borough") == core_group, F.lit(False))) | F.col("pu_location_id").isin(
        *core_places
    )
    places = means.join(zones.select("pu_location_id", "borough"), "pu_location_id", "left")
    inner = F.avg(F.when(core, F.col("_mean")))
    outer = F.avg(F.when(~core, F.col("_mean")))
    return places.agg(
        inner.alias("core_mean"),
        outer.alias("outer_mean"),
        (inner / F.nullif(outer, F.lit(0.0))).alias("ratio"),
    )


def slot_means(df: DataFrame) -> DataFrame:
    """Mean demand per (weekday, hour) over places and weeks."""
    return all_kinds(df, ["day_of_week", "hour_of_day"]).groupBy("day_of_week", "hour_of_day").agg(
        F.avg("pickup_count").alias("mean_demand")
    )


def weekday_means(slots: DataFrame) -> DataFrame:
    """Mean of the hour means per weekday."""
    return slots.groupBy("day_of_week").agg(F.avg("mean_demand").alias("mean_demand"))


def day_class_curves(slots: DataFrame) -> DataFrame:
    """Hourly curve of weekdays and of weekends."""
    day_class = F.when(F.col("day_of_week").isin(*WEEKDAYS), "weekday").otherwise("weekend")
    return slots.groupBy(day_class.alias("day_class"), "hour_of_day").agg(
        F.avg("mean_demand").alias("mean_demand")
    )


def rhythm_summary(slots: DataFrame) -> DataFrame:
    """Monday-to-Thursday swing, peak hours, and the weekend-to-weekday ratio at midnight.

    ``slots`` has at most 168 rows.
    """
    curves = day_class_curves(slots)

    def curve(name: str) -> Column:
        return F.when(F.col("day_class") == name, F.col("mean_demand"))

    def peak(name: str) -> Column:
        # On equal demand the earlier hour.
        return F.max(F.when(F.col("day_class") == name, F.struct("mean_demand", -F.col("hour_of_day"))))

    midnight = F.col("hour_of_day") == 0
    hours = curves.agg(
        F.max(curve("weekday")).alias("weekday_peak"),
        (-peak("weekday")["col2"]).alias("weekday_peak_hour"),
        F.max(curve("weekend")).alias("weekend_peak"),
        (-peak("weekend")["col2"]).alias("weekend_peak_hour"),
        F.avg(F.when(midnight, curve("weekday"))).alias("weekday_midnight"),
        F.avg(F.when(midnight, curve("weekend"))).alias("weekend_midnight"),
    ).withColumn("midnight_ratio", F.col("weekend_midnight") / F.nullif("weekday_midnight", F.lit(0.0)))

    def day(number: int) -> Column:
        return F.max(F.when(F.col("day_of_week") == number, F.col("mean_demand")))

    days = weekday_means(slots).agg(
        day(MONDAY).alias("monday"),
        day(THURSDAY).alias("thursday"),
        (100 * (day(THURSDAY) - day(MONDAY)) / F.nullif(day(MONDAY), F.lit(0.0))).alias("swing_pct"),
    )
    return days.join(F.broadcast(hours), F.lit(True))  # one row each


def demand_by_temperature(df: DataFrame, fahrenheit: str = "tmpf") -> DataFrame:
    """Mean demand per 5-degree bin (Celsius); outside the bins is left out."""
    lower = range_bins(celsius(fahrenheit), TEMPERATURE_EDGES)
    return (
        df.withColumn("temp_bin", lower)
        .where(F.col("temp_bin").isNotNull())
        .groupBy("temp_bin")
        .agg(F.avg("pickup_count").alias("mean_demand"), F.count(F.lit(1)).alias("n"))
    )


def demand_by_events(df: DataFrame) -> DataFrame:
    """Mean demand per class of concurrent event counts."""
    return df.groupBy(event_count_bin(F.col("event_count")).alias("event_bin")).agg(
        F.avg("pickup_count").alias("mean_demand"), F.count(F.lit(1)).alias("n")
    )
