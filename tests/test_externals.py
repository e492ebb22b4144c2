import random
from datetime import timedelta

import pytest
from helpers import rows, ts
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegrid.functions.columns import location_key, simpler_key, weather_severity
from tidegrid.operators import externals, geo
from tidegrid.sources import dimensions

WEATHER = "wxcodes string, vsby double, sknt double, gust double, p01i double"


@pytest.mark.parametrize(
    "row, expected",
    [
        (("+SN", 10.0, 5.0, None, 0.0), "severe"),
        (("TSRA", 10.0, 5.0, None, 0.0), "severe"),
        (("FZRA", 10.0, 5.0, None, 0.0), "severe"),
        ((None, 0.5, 5.0, None, 0.0), "severe"),
        ((None, 10.0, 34.0, None, 0.0), "severe"),
        ((None, 10.0, 5.0, 34.0, 0.0), "severe"),
        ((None, 10.0, 5.0, None, 0.3), "severe"),
        (("-SN", 10.0, 5.0, None, 0.0), "mild"),
        (("BR", 10.0, 5.0, None, 0.0), "mild"),
        ((None, 2.5, 5.0, None, 0.0), "mild"),
        ((None, 10.0, 20.0, None, 0.0), "mild"),
        ((None, 10.0, 5.0, None, 0.005), "mild"),
        ((None, 10.0, 5.0, 33.0, 0.0), "normal"),
        (("", 10.0, 5.0, None, 0.0), "normal"),
        ((None, None, None, None, None), "normal"),
    ],
)
def test_severity(spark, row, expected):
    assert spark.createDataFrame([row], WEATHER).select(weather_severity()).first()[0] == expected


def test_raw_weather_text(spark, tmp_path):
    (tmp_path / "w.csv").write_text(
        "station,valid,tmpf,dwpf,relh,sknt,gust,vsby,p01i,skyc1,wxcodes\n"
        "LGA,2024-01-01 05:51,41.0,M,80,5,M,10,T,OVC,M\n"
        "LGA,2024-01-01 06:51,M,30,80,5,,10,bad,M,RA\n"
    )
    got = rows(dimensions.read_weather_raw(spark, str(tmp_path / "w.csv")).select("valid", "tmpf", "dwpf", "gust", "p01i", "skyc1", "wxcodes"), "valid")
    assert got == [
        (ts("2024-01-01 05:51:00"), 41.0, None, None, 0.005, "OVC", None),
        (ts("2024-01-01 06:51:00"), None, 30.0, None, None, None, "RA"),
    ]


def reports(spark):
    data = [("2024-01-01 05:51:00", 40.0), ("2024-01-01 05:53:00", 41.0), ("2024-01-01 07:51:00", 39.0)]
    return spark.createDataFrame(
        [(ts(v), t, 30.0, 50.0, 5.0, None, 10.0, 0.0, "CLR", None) for v, t in data],
        "valid timestamp, tmpf double, dwpf double, relh double, sknt double, gust double, vsby double, p01i double, skyc1 string, wxcodes string",
    )


def test_last_report_of_the_hour_and_gaps(spark):
    clean = externals.clean_weather(reports(spark))
    assert rows(clean.select("date_hour", "tmpf", "weather_severity"), "date_hour") == [
        (ts("2024-01-01 05:00:00"), 41.0, "normal"), (ts("2024-01-01 07:00:00"), 39.0, "normal"),
    ]
    assert rows(externals.hour_gaps(clean)) == [(ts("2024-01-01 06:00:00"),)]
    report = {(r.section, r.measure): r.value for r in externals.weather_report(reports(spark), clean).collect()}
    assert report[("rows", "duplicate_hour_rows_collapsed")] == 1
    assert report[("rows", "missing_hours_gap")] == 1
    assert report[("missing", "gust")] == 2 and report[("severity", "normal")] == 2


def test_interval_cells_include_both_ends(spark):
    events = spark.createDataFrame(
        [(4, ts("2024-01-01 00:10:00"), ts("2024-01-01 02:00:00")), (4, ts("2024-01-01 01:05:00"), ts("2024-01-01 01:05:00")),
         (4, None, ts("2024-01-01 01:00:00"))],
        "pu_location_id int, start_date_time timestamp, end_date_time timestamp",
    )
    got = rows(externals.interval_cells(events), "pickup_hour")
    assert got == [(4, ts(f"2024-01-01 0{h}:00:00"), n) for h, n in ((0, 1), (1, 2), (2, 1))]


def test_interval_cells_equal_unfolded_events(spark):
    events = spark.range(400).select(
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id") % 7).cast("int").alias("pu_location_id"),
        F.timestamp_seconds(1_704_067_200 + (F.col("id") * 7_919) % 500_000).alias("start_date_time"),
        F.timestamp_seconds(1_704_067_200 + (F.col("id") * 7_919) % 500_000 + (F.col("id") * 104_729) % 90_000 - 5_000).alias("end_date_time"),
    ).withColumn("pu_location_id", F.nullif("pu_location_id", F.lit(5)))
    for unit in ("hour", "day"):
        brute = {}
        step = timedelta(**{f"{unit}s": 1})
        for place, a, b in events.collect():
            at, end = (x.replace(minute=0, second=0, **({"hour": 0} if unit == "day" else {})) for x in (a, b))
            while at <= end:
                brute[place, at] = brute.get((place, at), 0) + 1
                at += step
        got = externals.interval_cells(events, unit).collect()
        assert {(r.pu_location_id, r.pickup_hour): r.event_count for r in got} == brute and len(got) == len(brute)


def test_enrich_keeps_every_cell_with_defaults_and_flags(spark):
    grid = spark.createDataFrame(
        [(4, ts("2024-01-01 05:00:00")), (4, ts("2024-01-01 01:00:00")), (5, ts("2024-01-01 01:00:00")), (5, ts("2024-01-02 05:00:00"))],
        "pu_location_id int, pickup_hour timestamp",
    )
    weather = externals.clean_weather(reports(spark)).withColumnRenamed("date_hour", "pickup_hour")
    cells = spark.createDataFrame([(4, ts("2024-01-01 01:00:00"), 2)], "pu_location_id int, pickup_hour timestamp, event_count long")
    days = spark.createDataFrame([(ts("2024-01-01 00:00:00"), "New Year")], "date timestamp, holiday_name string")
    out = externals.enrich(grid, weather, cells, days)
    got = rows(out.select("pu_location_id", "pickup_hour", "tmpf", "event_count", "event_present", "holiday_name", "is_holiday"), "pu_location_id", "pickup_hour")
    assert got == [
        (4, ts("2024-01-01 01:00:00"), None, 2, True, "New Year", True), (4, ts("2024-01-01 05:00:00"), 41.0, 0, False, "New Year", True),
        (5, ts("2024-01-01 01:00:00"), None, 0, False, "New Year", True), (5, ts("2024-01-02 05:00:00"), None, 0, False, None, False),
    ]


def test_event_cleaning(spark):
    raw = spark.createDataFrame(
        [("1", "A", "2024-01-01T10:00:00", "2024-01-01T12:00:00", "Bronx", "Park"),
         ("2", None, "2024-01-02T10:00:00", "2024-01-01T12:00:00", "Bronx", "Park"),
         ("3", None, "2024-01-02T10:00:00", "2024-01-02T10:00:00", None, None),
         ("4", "B", "not a time", "2024-03-02T10:00:00", "Bronx", "Park")],
        "event_id string, event_name string, start_date_time string, end_date_time string, event_borough string, event_location string",
    )
    parsed = externals.parse_event_times(raw)
    assert [r.event_id for r in externals.clean_events(parsed).orderBy("event_id").collect()] == ["1", "3", "4"]
    report = {r.measure: r.record_count for r in externals.events_report(parsed).collect()}
    assert report == {
        "removed_end_before_start": 1, "missing_event_location": 1, "missing_event_name": 1, "duration_over_30_days": 0,
        "duration_over_90_days": 0, "duration_over_365_days": 0, "zero_length": 1, "kept": 3,
    }


def test_holidays(spark):
    raw = spark.createDataFrame([("1/20/25", "B day"), ("1/20/25", "A day"), ("12/25/25", "Christmas")], "Date string, Holiday string").coalesce(1)
    days = externals.holiday_days(raw)
    assert rows(days, "date") == [(ts("2025-01-20"), "B day; A day"), (ts("2025-12-25"), "Christmas")]
    weather = spark.createDataFrame([(ts("2025-01-20 23:00:00"), 1.0), (ts("2025-01-21 00:00:00"), 2.0)], "pickup_hour timestamp, tmpf double")
    hours = rows(externals.city_hours(weather, days).where("pickup_hour < '2025-02-01'"), "pickup_hour")
    assert len(hours) == 25
    assert hours[0] == (ts("2025-01-20 00:00:00"), None, "B day; A day")
    assert hours[-2:] == [(ts("2025-01-20 23:00:00"), 1.0, "B day; A day"), (ts("2025-01-21 00:00:00"), 2.0, None)]


@pytest.mark.parametrize(
    "text, key",
    [
        ("Central Park: Great Lawn-01", "Central Park"),
        ("62 STREET between 13 AVENUE and 14 AVENUE", "62 STREET"),
        ("5 AVENUE Between A and B", "5 AVENUE"),
        ("Union Square", "Union Square"),
        ("Inbetween Place", "Inbetween Place"),
        ("  \n", ""),
        (None, ""),
        ("", ""),
    ],
)
def test_location_key(spark, text, key):
    assert spark.createDataFrame([(text,)], "s string").select(location_key(F.col("s"))).first()[0] == key


@pytest.mark.parametrize(
    "key, simpler",
    [
        ("Shore Road Park and Parkway", "Shore Road Park"),
        ("Kissena Corridor West", "Kissena Corridor"),
        ("Field (North)", "Field"),
        ("A / B", "A"),
        ("Central Park", None),
        ("(all)", None),
    ],
)
def test_simpler_key(spark, key, simpler):
    assert spark.createDataFrame([(key,)], "s string").select(simpler_key(F.col("s"))).first()[0] == simpler


def test_location_keys_are_counted(spark):
    df = spark.createDataFrame([("Central Park: A", "M"), ("Central Park: B", "M"), ("X", "Q"), ("X", None), (None, "Q")], "event_location string, event_borough string")
    assert rows(externals.location_keys(df), "location_key") == [("Central Park", "M", 2), ("X", "Q", 1)]


# --- places from coordinates --------------------------------------------------------------------------

SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]
DENTED = [(0.8, 0.2), (2.0, 0.1), (1.5, 0.5), (2.0, 1.4), (0.9, 1.2), (0.8, 0.2)]


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def shapes(spark):
    return spark.createDataFrame([(7, SQUARE), (3, DENTED)], "pu_location_id int, ring array<struct<x double, y double>>")


@pytest.mark.parametrize("cell", [0.05, 0.3, 5.0])
def test_points_find_their_place(spark, cell):
    rng = random.Random(5)
    points = [(i, rng.uniform(-0.5, 2.5), rng.uniform(-0.5, 2.0)) for i in range(400)] + [(400, None, None)]
    df = spark.createDataFrame(points, "i int, lon double, lat double")
    got = {r.i: r.pu_location_id for r in geo.locate_points(df, shapes(spark), cell_degrees=cell).collect()}
    assert len(got) == 401
    for i, x, y in points:
        hits = [] if x is None else [z for z, ring in ((3, DENTED), (7, SQUARE)) if inside(ring, x, y)]
        assert got[i] == (min(hits) if hits else None)


def test_events_get_places_through_their_key(spark):
    geocodes = spark.createDataFrame([("Park", "Bronx", 0.5, 0.5), ("Park", "", 0.5, 0.9), ("Lost West", "Bronx", None, None)],
                                     "location_key string, borough string, lat double, lon double")
    located = geo.locate_geocodes(geocodes, shapes(spark), 0.1)
    events = spark.createDataFrame([("1", "Park: lawn", "Bronx"), ("2", "Park", None), ("3", "Lost West", "Bronx"), ("4", "Elsewhere", "Bronx")],
                                   "event_id string, event_location string, event_borough string")
    out = geo.assign_places(events, located)
    assert rows(out.select("event_id", "pu_location_id"), "event_id") == [("1", 7), ("2", 3), ("3", None), ("4", None)]
    assert tuple(geo.geocode_coverage(out).first()) == (3, 2, 2, 50.0)
    assert rows(geo.keys_to_retry(geocodes)) == [("Lost West", "Bronx", "Lost")]


def test_geocode_cache_as_table(spark, tmp_path):
    (tmp_path / "cache.json").write_text('{\n "Park|||Bronx": {"lat": 1.5, "lon": -2},\n "Lost|||": null\n}')
    got = rows(dimensions.geocodes_from_cache(spark, str(tmp_path / "cache.json")), "location_key")
    assert got == [("Lost", "", None, None), ("Park", "Bronx", 1.5, -2.0)]


def test_a_place_without_a_value_is_an_error(spark):
    zones = spark.createDataFrame([(1, "a"), (2, "b")], "pu_location_id int, zone_name string")
    full = spark.createDataFrame([(1, 1.0), (2, 2.0)], "pu_location_id int, m double")
    assert geo.complete_by_place(zones, full, "m").count() == 2
    with pytest.raises(PySparkException):
        geo.complete_by_place(zones, full.where("pu_location_id = 1"), "m").collect()


def test_zone_lookup(spark, tmp_path):
    (tmp_path / "z.csv").write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n2,"Queens","Jamaica Bay","Boro Zone"\n'
        '264,"Unknown","N/A","N/A"\n265,"N/A","Outside","N/A"\n'
    )
    zones = dimensions.read_zones(spark, str(tmp_path / "z.csv"))
    assert rows(dimensions.real_places(zones), "pu_location_id") == [(1,), (2,)]
    assert zones.where("pu_location_id = 265").first().borough is None
    assert dimensions.group_domain(zones) == ["EWR", "Queens"]
