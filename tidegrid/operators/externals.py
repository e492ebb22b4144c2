"""Weather, interval events and calendar days: clean them, and join them to the grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import location_key, percent, unknown_is_false, weather_severity
from ..sources import schemas as S

# --- weather ---------------------------------------------------------------------------------------


def last_per_hour(raw: DataFrame, valid: str = "valid", severity: bool = True) -> DataFrame:
    """The last report of each clock hour. A maximum per hour, combined on the map side; text columns make it a sorting aggregate."""
    others = [c for c in raw.columns if c != valid]
    kept = (
        raw.groupBy(F.date_trunc("hour", valid).alias("date_hour"))
        .agg(F.max(F.struct(valid, *others)).alias("_last"))
        .select("date_hour", *[F.col(f"_last.{c}").alias(c) for c in others])
    )
    return kept.withColumn("weather_severity", weather_severity()) if severity else kept


def clean_weather(raw: DataFrame) -> DataFrame:
    """Hourly weather in the clean layout."""
    return last_per_hour(raw).select(*S.WEATHER_CLEAN.names)


def hour_gaps(clean: DataFrame, hour: str = "date_hour") -> DataFrame:
    """Hours between the first and the last report that have none."""
    span = clean.agg(F.min(hour).alias("a"), F.max(hour).alias("b"))
    expected = span.where(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias(hour)
    )
    return expected.join(clean.select(hour), hour, "left_anti")


def weather_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(section, measure, value) rows: collapsed reports, gaps, plausibility, missingness, classes."""
    raw_rows = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    c = F.col
    # Names and bounds of the report.
    measures = {
        ("rows", "clean_row_count"): F.count(F.lit(1)),
        ("rows", "expected_hours_in_range"): F.coalesce(
            (F.unix_timestamp(F.max("date_hour")) - F.unix_timestamp(F.min("date_hour"))) / 3600 + 1,
            F.lit(0),
        ).cast("long"),
        ("implausible", "negative_precipitation"): F.count_if(c("p01i") < 0),
        ("implausible", "humidity_outside_0_100"): F.count_if((c("relh") < 0) | (c("relh") > 100)),
        ("implausible", "negative_wind"): F.count_if(c("sknt") < 0),
        ("implausible", "negative_visibility"): F.count_if(c("vsby") < 0),
        ("implausible", "temperature_outside_minus40_130"): F.count_if((c("tmpf") < -40) | (c("tmpf") > 130)),
        ("implausible", "dewpoint_above_temperature"): F.count_if(c("dwpf") > c("tmpf")),
        ("missing", "gust"): F.count_if(c("gust").isNull()),
        ("missing", "wxcodes"): F.count_if(c("wxcodes").isNull()),
        ("missing", "core_readings"): sum(
            (F.count_if(c(n).isNull()) for n in ("tmpf", "dwpf", "relh", "sknt", "vsby")), F.lit(0)
        ),
        ("severity", "normal"): F.count_if(c("weather_severity") == "normal"),
        ("severity", "mild"): F.count_if(c("weather_severity") == "mild"),
        ("severity", "severe"): F.count_if(c("weather_severity") == "severe"),
    }
    row = clean.agg(*[m.alias(f"_m{i}") for i, m in enumerate(measures.values())]).join(
        F.broadcast(raw_rows), F.lit(True)  # both sides are one row
    )
    col_of = {k: F.col(f"_m{i}") for i, k in enumerate(measures)}
    rows, hours = col_of[("rows", "clean_row_count")], col_of[("rows", "expected_hours_in_range")]
    entries = [
        ("rows", "raw_row_count", F.col("raw_rows")),
        ("rows", "duplicate_hour_rows_collapsed", F.col("raw_rows") - rows),
        ("rows", "missing_hours_gap", hours - rows),
        *[(s, m, v) for (s, m), v in col_of.items()],
    ]
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(s).alias("section"), F.lit(m).alias("measure"), v.alias("value"))
                    for s, m, v in entries
                ]
            )
        )
    )


# --- interval events ------------------------------------------------------------------------------


def parse_event_times(raw: DataFrame) -> DataFrame:
    """Times as timestamps; text that is no time becomes NULL and the row stays."""
    return raw.withColumns(
        {c: F.expr(f"try_cast({c} as timestamp)") for c in ("start_date_time", "end_date_time")}
    )


def clean_events(parsed: DataFrame) -> DataFrame:
    """Drop events that end before they start; an unknown time proves nothing."""
    return parsed.where(~unknown_is_false(F.col("end_date_time") < F.col("start_date_time")))


def events_report(parsed: DataFrame) -> DataFrame:
    """(measure, record_count, pct_of_original) rows: the removal, and what is kept but unusual.

    Events of no length are a class of their own, apart from the removed ones.
    """
    seconds = F.unix_timestamp("end_date_time") - F.unix_timestamp("start_date_time")
    removed = unknown_is_false(F.col("end_date_time") < F.col("start_date_time"))
    day = 86_400
    # Names and bounds of the report.
    checks = {
        "removed_end_before_start": removed,
        "missing_event_location": ~removed & F.col("event_location").isNull(),
        "missing_event_name": ~removed & F.col("event_name").isNull(),
        "duration_over_30_days": seconds > 30 * day,
        "duration_over_90_days": seconds > 90 * day,
        "duration_over_365_days": seconds > 365 * day,
        "zero_length": seconds == 0,
        "kept": ~removed,
    }
    row = parsed.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(v).alias(f"_c{i}") for i, v in enumerate(checks.values())],
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("measure"),
                        F.col(f"_c{i}").alias("record_count"),
                        percent(F.col(f"_c{i}"), F.col("_n")).alias("pct_of_original"),
                    )
                    for i, k in enumerate(checks)
                ]
            )
        )
    )


def location_keys(events: DataFrame) -> DataFrame:
    """Distinct (location key, group) pairs to look up, with their event counts."""
    return (
        events.select(location_key(F.col("event_location")).alias("location_key"), "event_borough")
        .where((F.col("location_key") != "") & F.col("event_borough").isNotNull())
        .groupBy("location_key", "event_borough")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def interval_cells(events: DataFrame, unit: str = "hour") -> DataFrame:
    """Events running in each (place, hour) cell, first and last hour included.

    An event is two changes, whatever its length: one more from its first hour, one less after its
    last. Changes add up per place and hour on the map side; their running sum is the number of
    events until the next change, and only that stretch unfolds. A place has at most one row per hour
    of the period in its window, however many events it has.
    """
    step = F.expr(f"interval 1 {unit}")
    first, last = F.date_trunc(unit, "start_date_time"), F.date_trunc(unit, "end_date_time")

    def change(at: Column, by: int) -> Column:
        return F.struct(at.alias("at"), F.lit(by).cast("long").alias("by"))

    changes = (
        events.where(first <= last)
        .select("pu_location_id", F.inline(F.array(change(first, 1), change(last + step, -1))))
        .groupBy("pu_location_id", "at")
        .agg(F.sum("by").alias("by"))
    )
    order = Window.partitionBy("pu_location_id").orderBy("at")
    return (
        changes.withColumns({"event_count": F.sum("by").over(order), "until": F.lead("at").over(order)})
        .where("event_count > 0")
        .select("pu_location_id", F.explode(F.sequence("at", F.col("until") - step, step)).alias("pickup_hour"), "event_count")
    )


# --- calendar ---------------------------------------------------------------------------------------


def holiday_days(raw: DataFrame, pattern: str = "M/d/yy", position: str | None = None) -> DataFrame:
    """One row per date; several names of a date are joined by ``"; "`` in file order.

    ``position`` names a column that holds the order; without it the order of reading one file is
    taken. The file is a calendar: a handful of names per date.
    """
    order = F.col(position) if position else F.monotonically_increasing_id()
    return (
        raw.select(
            F.to_date("Date", pattern).cast("timestamp").alias("date"),
            order.alias("_pos"),
            "Holiday",
        )
        .groupBy("date")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("_pos", "Holiday"))), lambda s: s["Holiday"]),
                "; ",
            ).alias("holiday_name")
        )
    )


# --- on the grid ------------------------------------------------------------------------------------


def city_hours(weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per hour that has weather or is in a holiday: what holds for the whole city.

    A few thousand rows a year. A union and an aggregate, and not an outer join, so that the planner's
    estimate stays near the size of the files and the grid is not shuffled for it.
    """
    midnight = F.date_trunc("day", "date")
    named = holidays.select(
        F.explode(F.sequence(midnight, midnight + F.expr("interval 23 hours"), F.expr("interval 1 hour"))).alias("pickup_hour"),
        "holiday_name",
    )
    both = weather.unionByName(named, allowMissingColumns=True)
    return both.groupBy("pickup_hour").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in both.columns if c != "pickup_hour"]
    )


def enrich(grid: DataFrame, weather: DataFrame, event_cells: DataFrame, holidays: DataFrame) -> DataFrame:
    """City hours and event counts on the grid: two joins, then all defaults and flags at once.

    Unknown weather stays NULL; no event is 0, and no holiday is false.
    """
    cells = event_cells.select("pu_location_id", "pickup_hour", F.col("event_count").alias("_events"))
    joined = grid.join(city_hours(weather, holidays), "pickup_hour", "left").join(
        cells, ["pu_location_id", "pickup_hour"], "left"
    )
    return joined.select(
        *[c for c in joined.columns if c != "_events"],
        F.nvl("_events", F.lit(0)).alias("event_count"),
        F.col("_events").isNotNull().alias("event_present"),
        F.col("holiday_name").isNotNull().alias("is_holiday"),
    )


def join_coverage(enriched: DataFrame) -> DataFrame:
    """Share of cells that found weather, an event, a holiday."""
    n = F.count(F.lit(1))
    weather, event, holiday = (
        F.count("tmpf"), F.count_if("event_present"), F.count_if("is_holiday"),
    )
    return enriched.agg(
        n.alias("total_rows"),
        weather.alias("weather_matched_rows"),
        percent(weather, n).alias("pct_weather_matched"),
        event.alias("event_present_rows"),
        percent(event, n).alias("pct_event_present"),
        holiday.alias("holiday_rows"),
        percent(holiday, n).alias("pct_holiday"),
    )
