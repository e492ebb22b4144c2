"""Row-level expressions. All of them are built-in column functions; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: weather severity --------------------------------------------------------------
SEVERE_CODES = ["+SN", "+RA", "TS", "FZRA", "FZDZ", "GR", "FC", "SQ", "+SG", "PL"]
MILD_CODES = ["SN", "RA", "BR", "FG", "DZ", "HZ", "FU", "SG"]
SEVERE_LIMITS = {"visibility_below": 1, "wind_from": 34, "gust_from": 34, "rain_from": 0.3}
MILD_LIMITS = {"visibility_below": 3, "wind_from": 20, "rain_above": 0}


def duration_minutes(start: str, end: str) -> Column:
    """Whole seconds between two timestamps, in minutes; negative when they are swapped."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def unknown_is_false(condition: Column) -> Column:
    """A condition that cannot be decided proves nothing."""
    return F.coalesce(condition, F.lit(False))


def slot_columns(df: DataFrame, time: str = "pickup_hour") -> DataFrame:
    """Weekly slot of a cell: day of week (1 = Sunday) and hour of day.

    A slot column that is there already is kept, and with it the partitioning on it.
    """
    slots = {"day_of_week": F.dayofweek(time), "hour_of_day": F.hour(time)}
    return df.withColumns({n: c for n, c in slots.items() if n not in df.columns})


def _mentions(text: Column, codes: list[str]) -> Column:
    return text.rlike("|".join(c.replace("+", r"\+") for c in codes))


def weather_severity(
    codes: str = "wxcodes",
    visibility: str = "vsby",
    wind: str = "sknt",
    gust: str = "gust",
    rain: str = "p01i",
) -> Column:
    """severe, mild or normal; a missing reading never raises the class."""
    text = F.coalesce(F.col(codes).cast("string"), F.lit(""))
    severe = (
        _mentions(text, SEVERE_CODES)
        | unknown_is_false(F.col(visibility) < SEVERE_LIMITS["visibility_below"])
        | unknown_is_false(F.col(wind) >= SEVERE_LIMITS["wind_from"])
        | unknown_is_false(F.col(gust) >= SEVERE_LIMITS["gust_from"])
        | unknown_is_false(F.col(rain) >= SEVERE_LIMITS["rain_from"])
    )
    mild = (
        _mentions(text, MILD_CODES)
        | unknown_is_false(F.col(visibility) < MILD_LIMITS["visibility_below"])
        | unknown_is_false(F.col(wind) >= MILD_LIMITS["wind_from"])
        | unknown_is_false(F.col(rain) > MILD_LIMITS["rain_above"])
    )
    return F.when(severe, "severe").when(mild, "mild").otherwise("normal")


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\r\x0b\f"))


def location_key(text: Column) -> Column:
    """Place part of a location text: up to the first colon, then up to the word "between"."""
    head = _strip(F.substring_index(text, ":", 1))
    return F.coalesce(_strip(F.regexp_replace(head, r"(?is)\bbetween\b.*$", "")), F.lit(""))


def simpler_key(key: Column) -> Column:
    """Shorter spelling to look up when a key was not found; NULL when there is none."""
    # What goes, in this order.
    parentheses, second_name, side = r"\s*\([^)]*\)", r"(?i)\s+and\s+\w+$", r"(?i)\s+(West|East|North|South)$"
    text = _strip(F.substring_index(F.regexp_replace(key, parentheses, ""), "/", 1))
    text = _strip(F.regexp_replace(F.regexp_replace(text, second_name, ""), side, ""))
    return F.when((text != "") & (text != key), text)


def demand_ratio(demand: str | Column, baseline: str | Column) -> Column:
    """Demand over baseline (DTDI); a zero baseline has no ratio."""
    demand = F.col(demand) if isinstance(demand, str) else demand
    baseline = F.col(baseline) if isinstance(baseline, str) else baseline
    return demand / F.nullif(baseline.cast("double"), F.lit(0.0))


def celsius(fahrenheit: str) -> Column:
    return (F.col(fahrenheit) - 32) * 5 / 9


def percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded percentage; 0.0 of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)
    )


def outlier_multiplier(n: Column) -> Column:
    """How many interquartile ranges above Q3 is extreme, for a sample of ``n``."""
    return F.when(n <= 100, F.lit(1.5)).otherwise(F.sqrt(F.log(F.greatest(n, F.lit(2)))) - 0.5)


def range_bins(value: Column, edges: list[float]) -> Column:
    """Lower edge of the left-closed bin ``value`` falls in; NULL outside the edges."""
    out = F.lit(None).cast("double")
    for low, high in zip(edges, edges[1:]):
        out = F.when((value >= low) & (value < high), F.lit(float(low))).otherwise(out)
    return out


def event_count_bin(count: Column) -> Column:
    return (
        F.when(count == 0, "0")
        .when(count == 1, "1")
        .when(count == 2, "2")
        .when(count <= 5, "3-5")
        .otherwise("6+")
    )
