import math

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from tidegrid.operators import dtdi, explore, metrics, topk


def test_metrics_by_group(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 1.0), ("A", 2.0, 2.0), ("B", 0.0, 0.0), ("B", 0.0, 5.0), ("one", 3.0, 4.0), ("flat", 2.0, 2.0), ("flat", 2.0, 2.0), (None, 9.0, 1.0)],
        "zone string, actual double, pred double",
    )
    got = {r.zone: r for r in metrics.regression_metrics(df, "actual", {"m": "pred"}, by="zone").collect()}
    assert sorted(got) == ["A", "B", "flat", "one"]
    assert (got["A"].mae, got["A"].rmse, got["A"].r2, got["A"].n) == (0.0, 0.0, 1.0, 2)
    assert got["B"].mae == 2.5 and got["B"].r2 == 0.0
    assert got["one"].r2 is None and got["flat"].r2 == 1.0


def test_metrics_of_several_models_and_ratio(spark):
    df = spark.createDataFrame([("severe", 1.0, 3.0, 1.5), ("normal", 2.0, 3.0, 2.0), ("normal", 4.0, 4.0, 4.0)], "w string, actual double, p double, q double")
    overall = {r.model: r for r in metrics.regression_metrics(df, "actual", {"p": "p", "q": "q"}).collect()}
    assert overall["p"].mae == 1.0 and overall["p"].rmse == pytest.approx(math.sqrt(5 / 3))
    assert overall["p"].r2 == pytest.approx(1 - 5 / (14 / 3))
    by = metrics.regression_metrics(df, "actual", {"p": "p", "q": "q"}, by="w")
    assert {r.model: r.mae_ratio for r in metrics.mae_ratio(by, "w", "severe", "normal").collect()} == {"p": 4.0, "q": None}


def test_ratio_needs_a_baseline(spark):
    df = spark.createDataFrame([(4, 2.0), (4, 0.0), (6, 2.0)], "pickup_count long, baseline_pickup_count double")
    assert [r.dtdi for r in dtdi.with_ratio(df).collect()] == [2.0, None, 3.0]


@pytest.mark.parametrize(
    "ratio, fixed, grouped",
    [
        (0.5, "below_normal", "below_normal"), (1.0, "below_normal", "normal"), (1.2, "normal", "normal"),
        (1.5, "normal", "elevated"), (1.7, "elevated", "elevated"), (2.0, "elevated", "very_elevated"),
        (2.5, "very_elevated", "very_elevated"), (None, None, None),
    ],
)
def test_both_edge_rules(spark, ratio, fixed, grouped):
    df = spark.createDataFrame([(ratio, 1.5, 2.0)], "r double, lo double, hi double")
    got = df.select(dtdi.classify(F.col("r")), dtdi.classify_by_group(F.col("r"), F.col("lo"), F.col("hi"))).first()
    assert tuple(got) == (fixed, grouped)


def test_custom_edges(spark):
    df = spark.createDataFrame([(1.05,), (1.15,), (1.25,)], "r double")
    assert [r[0] for r in df.select(dtdi.classify(F.col("r"), [1.0, 1.1, 1.2])).collect()] == ["normal", "elevated", "very_elevated"]


def test_city_thresholds_leave_tiny_baselines_out(spark):
    data = [(10 + i, 10.0) for i in range(10)] + [(100, 0.01), (50, 0.5)]
    df = spark.createDataFrame(data, "pickup_count long, baseline_pickup_count double")
    limits = dtdi.city_thresholds(df)
    assert dtdi.city_edges(limits) == [1.0, pytest.approx(1.675), pytest.approx(1.855)]
    assert limits.first().n_obs == 10


def test_group_thresholds_fall_back(spark):
    data = [(100, 8, 100 + i % 5, 100.0) for i in range(60)]  # enough in its own slot
    data += [(300, 8, 20 + i, 10.0) for i in range(10)]  # thin slot in a full zone
    data += [(300, 9, 10 + i % 30, 10.0) for i in range(60)]
    data += [(400, 1, 50, 10.0)]  # thin zone
    df = spark.createDataFrame(data, "pu_location_id int, hour_of_day int, pickup_count long, baseline_pickup_count double")
    levels = dtdi.group_thresholds(df)
    assert {(r.pu_location_id, r.hour_of_day): r.n_obs for r in levels["zone_hour"].collect()}[(300, 8)] == 10
    probe = spark.createDataFrame([(100, 8, 1.04), (300, 8, 1.04), (400, 1, 1.04), (999, 1, None)], "pu_location_id int, hour_of_day int, r double")
    out = dtdi.resolve_thresholds(probe, levels)
    assert rows(out.select("pu_location_id", "threshold_level"), "pu_location_id") == [(100, "zone_hour"), (300, "zone"), (400, "global"), (999, "global")]
    zone = levels["zone"].where("pu_location_id = 300").first()
    assert rows(out.where("pu_location_id = 300").select("p_low", "p_high")) == [(zone.p_low, zone.p_high)]


def pairs(spark):
    return spark.createDataFrame([("normal", "normal"), ("normal", "normal"), ("elevated", "normal"), (None, "normal")], "a string, p string")


def test_confusion_matrix(spark):
    got = {r.actual_category: tuple(r)[1:] for r in dtdi.confusion_matrix(pairs(spark), "a", "p").collect()}
    assert got == {
        "actual_below_normal": (0, 0, 0, 0), "actual_normal": (0, 2, 0, 0), "actual_elevated": (0, 1, 0, 0), "actual_very_elevated": (0, 0, 0, 0),
    }


def test_classification_report(spark):
    got = {r.category: r for r in dtdi.classification_report(pairs(spark), "a", "p").collect()}
    assert (got["normal"].recall, got["normal"].support) == (1.0, 2)
    assert got["normal"].precision == pytest.approx(2 / 3) and got["normal"].f1 == pytest.approx(0.8)
    assert (got["elevated"].precision, got["elevated"].f1) == (0.0, 0.0)
    assert got["macro_avg"].f1 == pytest.approx(0.2) and got["macro_avg"].support == 3
    micro = got["micro_avg"]
    assert micro.precision == micro.recall == micro.f1 == pytest.approx(2 / 3)


def test_topk_overlap_and_ties(spark):
    df = spark.createDataFrame([(i, float(v), float(p)) for i, (v, p) in enumerate([(9, 1), (8, 2), (1, 9), (1, 8), (1, 0)])], "id int, actual double, p double")
    same = df.withColumn("q", F.col("actual") * 3)
    got = {(r.model, r.k): r.pct_overlap for r in topk.overlap(same, [2, 4], "actual", {"p": "p", "q": "q"}, ["id"]).collect()}
    assert got == {("p", 2): 0.0, ("p", 4): 100.0, ("q", 2): 100.0, ("q", 4): 100.0}
    # Three rows tie for rank 3; the lower key is in.
    assert [r.id for r in topk.top_rows(df, 3, "actual", ["id"]).orderBy("_rank").collect()] == [0, 1, 2]
    assert {r.k: r.pct_overlap for r in topk.random_overlap(df, [1, 5]).collect()} == {1: 20.0, 5: 100.0}


def test_topk_never_sorts_everything(spark):
    plan = topk.top_rows(spark.range(10).withColumn("v", F.rand(1)), 3, "v", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_busiest_day_lists(spark):
    data = [("y", 1, "2026-01-01 01:00:00", 1.0, 5.0), ("y", 2, "2026-01-01 02:00:00", 9.0, 1.0), ("y", 1, "2026-01-02 01:00:00", 4.0, 4.0), ("g", 1, "2026-01-03 01:00:00", 99.0, 9.0)]
    df = spark.createDataFrame([(k, z, ts(h), ts(h).hour, a, p) for k, z, h, a, p in data], "taxi_type string, pu_location_id int, pickup_hour timestamp, hour_of_day int, actual double, p double")
    zones = spark.createDataFrame([(1, "one", "A"), (2, "two", "B")], "pu_location_id int, zone_name string, borough string")
    assert str(topk.busiest_day(df, "y").first().pickup_date) == "2026-01-01"
    out = topk.busiest_day_lists(df, zones, "y", "actual", "p", k=1)
    assert rows(out.select("zone_name", "actual_rank", "predicted_rank", "in_both"), "zone_name") == [("one", None, 1, False), ("two", 1, None, False)]


def test_severity_and_compression(spark):
    df = spark.createDataFrame([("normal", 1.0, 1.0), ("normal", 1.4, 1.2), ("severe", 0.6, 0.9), (None, 5.0, 5.0)], "weather_severity string, dtdi double, p double")
    got = {r.weather_severity: (r.mean_dtdi, r.median_dtdi, r.n_obs) for r in dtdi.by_severity(df).collect()}
    assert got == {"normal": (1.2, 1.2, 2), "severe": (0.6, 0.6, 1)}
    row = dtdi.compression(df, "dtdi", {"p": "p"}).first()
    assert row.actual_drop == pytest.approx(0.6) and row.pct_drop_captured == pytest.approx(100 * 0.2 / 0.6)


def test_descriptive_tables(spark):
    data = [(1, "2024-01-01 08:00:00", 2, 10.0, 0), (1, "2024-01-01 09:00:00", 4, 50.0, 4), (2, "2024-01-04 08:00:00", 6, None, 9), (2, "2024-01-06 00:00:00", 0, 59.0, 1)]
    df = spark.createDataFrame(
        [("y", z, ts(h), c, t, e, ts(h).isoweekday() % 7 + 1, ts(h).hour) for z, h, c, t, e in data],
        "taxi_type string, pu_location_id int, pickup_hour timestamp, pickup_count long, tmpf double, event_count long, day_of_week int, hour_of_day int",
    )
    assert tuple(explore.demand_distribution(df).first())[:3] == (3.0, 25.0, 3.0)
    zones = spark.createDataFrame([(1, "core"), (2, "outer")], "pu_location_id int, borough string")
    assert tuple(explore.spatial_concentration(df, zones, "core", []).first()) == (3.0, 3.0, 1.0)
    assert tuple(explore.spatial_concentration(df, zones, "core", [2]).first()) == (3.0, None, None)
    assert rows(explore.demand_by_temperature(df), "temp_bin") == [(-15.0, 2.0, 1), (10.0, 4.0, 1), (15.0, 0.0, 1)]
    assert rows(explore.demand_by_events(df), "event_bin") == [("0", 2.0, 1), ("1", 0.0, 1), ("3-5", 4.0, 1), ("6+", 6.0, 1)]
    rhythm = explore.rhythm_summary(explore.slot_means(df)).first()
    assert (rhythm.monday, rhythm.thursday, rhythm.swing_pct) == (3.0, 6.0, 100.0)
    assert (rhythm.weekday_peak, rhythm.weekday_peak_hour, rhythm.weekend_peak_hour) == (4.0, 8, 0)
