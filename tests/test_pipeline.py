"""All layers on small month files: landing, raw, clean, processed, models, evaluation."""

import random
from datetime import timedelta

import pandas as pd
import pytest
from helpers import ts
from pyspark.sql import functions as F

from tidegrid.operators import externals, models
from tidegrid.plans import medallion


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    rng = random.Random(11)

    def month(kind, number, days):
        start = ts(f"2024-{number:02d}-01 00:00:00")
        out = []
        for i in range(600):
            at = start + timedelta(minutes=rng.randrange(days * 24 * 60))
            out.append((1, at, at + timedelta(minutes=rng.choice([5, 20, 0])), rng.choice([1, 2, None]), rng.choice([0.0, 1.5, 4.0]),
                        rng.choice([1, 2, 3, 264]), rng.choice([2, 300]), rng.choice([-1.0, 10.0])))
        out += out[:5]  # copies
        prefix = "tpep" if kind == "yellow" else "lpep"
        columns = ["VendorID", f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime", "passenger_count", "trip_distance",
                   "PULocationID", "DOLocationID", "fare_amount"]
        return pd.DataFrame(out, columns=columns)

    names = {"yellow": "Yellow Taxi Data", "green": "Green Trip Data"}
    for kind, stem in names.items():
        folder = root / "landing" / kind
        folder.mkdir(parents=True)
        for word, number in (("Jan", 1), ("Feb", 2)):
            df = month(kind, number, 28)
            if number == 2:
                df["cbd_congestion_fee"] = 0.75
            df.to_parquet(folder / f"{stem} {word} 2024.parquet", coerce_timestamps="us")
    return medallion.Layout(
        str(root), period=("2024-01-01 00:00:00", "2024-03-01 00:00:00"), train_end="2024-02-15 00:00:00",
        validation_start="2024-02-01 00:00:00", window_weeks=2,
    )


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame(
        [(1, "Bronx", "a"), (2, "Queens", "b"), (3, "Queens", "c"), (264, None, None)], "pu_location_id int, borough string, zone_name string"
    )


@pytest.fixture(scope="module")
def processed(spark, layout, zones):
    log = medallion.ingest(spark, layout, "now")
    assert {r.status for r in log.collect()} == {"ok"}
    ledger = medallion.clean(spark, layout)
    removed = {(r.dataset, r.ordinal): r.records_removed for r in ledger.collect()}
    raw = {k: medallion.load_raw(spark, layout, k).count() for k in layout.kinds}
    assert raw == {"yellow": 1210, "green": 1210}
    for kind in layout.kinds:
        kept = medallion.load_clean(spark, layout, kind).count()
        assert raw[kind] == kept + sum(n for (d, _), n in removed.items() if d == kind)
    hours = spark.range(24 * 60).select((F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)).alias("pickup_hour"))
    weather = hours.select(
        "pickup_hour", *[F.lit(v).alias(c) for c, v in dict(tmpf=40.0, dwpf=30.0, relh=50.0, sknt=5.0, vsby=10.0, p01i=0.0).items()],
        F.lit(None).cast("double").alias("gust"), F.lit("CLR").alias("skyc1"), F.lit(None).cast("string").alias("wxcodes"),
        F.when(F.hour("pickup_hour") % 3 == 0, "severe").otherwise("normal").alias("weather_severity"),
    )
    events = spark.createDataFrame([(1, ts("2024-01-05 10:30:00"), ts("2024-01-05 12:00:00"))], "pu_location_id int, start_date_time timestamp, end_date_time timestamp")
    holidays = externals.holiday_days(spark.createDataFrame([("1/1/24", "New Year")], "Date string, Holiday string"))
    return medallion.process(spark, layout, zones, weather, events, holidays)


def test_processed_table(spark, layout, processed):
    assert processed.count() == 2 * 3 * 60 * 24
    clean = medallion.load_clean(spark, layout)
    real = clean.where("pu_location_id <> 264").count()
    total = processed.agg(F.sum("pickup_count"), F.sum("event_count"), F.count_if("is_holiday")).first()
    assert tuple(total) == (real, 2 * 3, 2 * 3 * 24)
    assert "source_year" in clean.columns and "source_month" in clean.columns


def test_profiles_of_raw(spark, layout, processed):
    tables = medallion.profile_raw(spark, layout, "yellow")
    null = {r.column_name: r.null_count for r in tables["missingness"].collect()}
    assert null["ehail_fee"] == 1210 and null["pickup_datetime"] == 0
    assert tables["temporal"].first().total_rows == 1210
    assert tables["numeric"].count() == 5


def test_models_and_evaluation(spark, layout, zones, processed):
    linear = {n: models.REGISTRY[n] for n in ("linear_regression", "ridge")}
    fitted = medallion.fit_all(spark, layout, zones, linear)
    loaded = {n: models.load_model(layout.path("models", n)) for n in fitted}
    out = medallion.evaluate(spark, layout, zones, loaded)
    assert out["frame"].count() == 2 * 3 * 15 * 24
    assert {r.model for r in out["metrics"].collect()} == set(linear)
    assert out["topk"].count() == (len(linear) + 1) * 4
    assert out["classes_ridge"].count() == 6
    assert {r.weather_severity for r in out["metrics_by_weather"].collect()} == {"severe", "normal"}
