import math

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from tidegrid.operators import cleaning, profile, rules
from tidegrid.operators.rules import Rule
from tidegrid.sources import schemas as S



def audit_both(df, rule_list, keys=None, order=None, by=None):
    """The audit table, after checking that both ways of making it agree."""
    plain = cleaning.audit(df, rule_list, keys, order, by)
    filtered = cleaning.audit(df, rule_list, keys, order, by, prefilter=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, filtered.collect()))
    for table in (plain, cleaning.audit_counts(df, rule_list, keys, by), cleaning.audit_counts(df, rule_list, keys, by, prefilter=True)):
        reports = [cleaning.ledger(table, rule_list), cleaning.duplicate_profile(table)]
        if by:
            reports += [cleaning.ledger(table, rule_list, by[0]), cleaning.row_summary(table, by[0])]
        made = [sorted(map(str, r.collect())) for r in reports]
        expected = made if table is plain else expected
        assert made == expected
    return plain


def test_counts_of_hot_copies_nulls_and_an_empty_table(spark):
    df = spark.range(4_000).select(
        F.when(F.col("id") % 2 == 0, "A").alias("kind"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 11).alias("a"),
        F.when(F.col("id") % 5 == 0, F.lit("x")).otherwise(F.col("id").cast("string")).alias("b"),
    )
    rule_list = [
        Rule("small", "r", F.col("a") < 2), Rule("late", "r", F.col("a") > 8, stage="study_period", after_dedup=True),
    ]
    audit_both(df, rule_list, ["a", "b"], by=["kind"])
    audit_both(df.limit(0), rule_list, ["a", "b"], by=["kind"])


@pytest.mark.parametrize("prefilter", [False, True])
def test_counts_are_hash_aggregates_and_refuse_rules_that_split_copies(spark, prefilter):
    df = spark.createDataFrame([(1, "s", 1), (1, "s", 9), (2, "t", 1)], "k int, s string, t int")
    rule_list = [Rule("late", "r", F.col("t") > 5, stage="study_period", after_dedup=True)]
    by_key = cleaning.audit_counts(df, rule_list, ["k", "s"], prefilter=prefilter)
    with pytest.raises(Exception, match="tells copies of one record apart"):
        by_key.collect()
    whole = cleaning.audit_counts(df, rule_list, ["k", "s", "t"], prefilter=prefilter)
    plan = whole._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert whole.agg(F.sum("_copies"), F.sum("_groups")).first()[:] == (3, 3)


def removed(df, rule_list, **kw):
    return [r.records_removed for r in cleaning.ledger(audit_both(df, rule_list, **kw), rule_list).orderBy("ordinal").collect()]


def test_only_the_row_that_breaks_the_rule_goes(spark):
    df = spark.createDataFrame([(1, -1), (2, 5), (3, None)], "id int, value int")
    rule_list = [Rule("value negative", "r", F.col("value") < 0)]
    audited = audit_both(df, rule_list)
    assert rows(cleaning.clean_rows(audited), "id") == [(2, 5), (3, None)]
    first = cleaning.ledger(audited, rule_list).orderBy("ordinal").first()
    assert (first.records_removed, first.pct_of_original) == (1, 33.3333)


def test_an_unknown_condition_keeps_the_row(spark):
    df = spark.createDataFrame([(1, None)], "id int, flag boolean")
    assert removed(df, [Rule("flag", "r", F.col("flag"))]) == [0, 0]


def test_a_row_is_charged_to_the_first_rule_it_breaks(spark):
    df = spark.createDataFrame([(1, -1, -1), (2, 1, -1), (3, 1, 1)], "id int, a int, b int")
    rule_list = [Rule("a", "r", F.col("a") < 0), Rule("b", "r", F.col("b") < 0)]
    assert removed(df, rule_list) == [1, 1, 0]


def test_exact_duplicates_and_equal_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (3, None)], "id int, value string")
    audited = audit_both(df, [])
    assert rows(cleaning.clean_rows(audited), "id") == [(1, "a"), (2, "b"), (3, None)]
    p = cleaning.duplicate_profile(audited).first()
    assert tuple(p) == (5, 3, 2, 40.0)


def test_broken_copies_are_not_duplicates(spark):
    df = spark.createDataFrame([(1, -5), (1, -5), (2, 3)], "id int, value int")
    assert removed(df, [Rule("value negative", "r", F.col("value") < 0)]) == [2, 0]


def test_the_period_is_tested_after_deduplication(spark):
    df = spark.createDataFrame([(1, 9), (1, 9), (2, 1)], "id int, t int")
    rule_list = [Rule("late", "r", F.col("t") > 5, stage="study_period", after_dedup=True)]
    assert removed(df, rule_list) == [1, 1]


def test_the_survivor_is_the_smallest_provenance(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "id int, file string, n int")
    audited = audit_both(df, [], keys=["id"], order=["file"])
    assert rows(cleaning.clean_rows(audited), "id") == [(1, "a", 9), (2, "c", 1)]


def test_a_hot_group_of_copies_folds_before_the_shuffle(spark):
    df = spark.range(60_000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"), F.lit("x").alias("v"))
    audited = audit_both(df, [], keys=["k", "v"])
    assert cleaning.clean_rows(audited).count() == 40_001
    assert cleaning.duplicate_profile(audited).first().duplicate_extra_rows == 19_999


def test_ledger_per_dataset_and_summed(spark):
    df = spark.createDataFrame([("a", 1, -1), ("a", 2, 1), ("b", 3, -1), ("b", 4, -1)], "taxi_type string, id int, v int")
    rule_list = [Rule("v", "r", F.col("v") < 0)]
    audited = audit_both(df, rule_list, by=["taxi_type"])
    ledger = cleaning.ledger(audited, rule_list, "taxi_type")
    assert rows(ledger.where("ordinal = 1").select("dataset", "records_removed", "pct_of_original"), "dataset") == [("a", 1, 50.0), ("b", 2, 100.0)]
    both = cleaning.ledger_over_datasets(ledger).where("ordinal = 1").first()
    assert (both.records_removed, both.pct_of_combined_raw) == (3, 75.0)
    assert rows(cleaning.row_summary(audited), "taxi_type") == [
        ("a", 2, 1, 1, 50.0), ("b", 2, 0, 2, 100.0), ("combined", 4, 1, 3, 75.0)
    ]


def _trip(**changes):
    base = dict(
        pickup_datetime=ts("2024-03-01 10:00:00"), dropoff_datetime=ts("2024-03-01 10:20:00"),
        trip_duration_minutes=20.0, pu_location_id=100, do_location_id=50, trip_distance=2.0,
        passenger_count=1, fare_amount=10.0,
    )
    return {**base, **changes}


@pytest.mark.parametrize(
    "changes, ordinal",
    [
        ({}, None),
        ({"pickup_datetime": None}, 1),
        ({"pu_location_id": None}, 2),
        ({"pu_location_id": 266}, 3),
        ({"do_location_id": 0}, 4),
        ({"do_location_id": None}, None),
        ({"trip_distance": 0.0}, 5),
        ({"trip_distance": None}, None),
        ({"passenger_count": -1}, 6),
        ({"passenger_count": 0}, None),
        ({"fare_amount": -0.5}, 7),
        ({"trip_duration_minutes": 0.0}, 8),
        ({"trip_duration_minutes": 1440.5}, 8),
        ({"trip_duration_minutes": 1440.0}, None),
        ({"dropoff_datetime": None, "trip_duration_minutes": None}, None),
        ({"pickup_datetime": ts("2023-12-31 23:59:59")}, 10),
        ({"pickup_datetime": ts("2026-06-01 00:00:00")}, 10),
    ],
)
def test_trip_rules(spark, changes, ordinal):
    row = _trip(**changes)
    schema = ("pickup_datetime timestamp, dropoff_datetime timestamp, trip_duration_minutes double, pu_location_id int, "
              "do_location_id int, trip_distance double, passenger_count int, fare_amount double")
    df = spark.createDataFrame([tuple(row.values())], schema)
    assert cleaning.audit(df, rules.trip_rules()).first()["_removed_by"] == ordinal


def test_extreme_flags(spark):
    values = [float(v) for v in range(1, 101)] + [1000.0]
    df = spark.createDataFrame([("y", v) for v in values] + [("y", None), ("g", 5.0)], "taxi_type string, trip_distance double")
    limits = cleaning.extreme_thresholds(df, ["trip_distance"])
    flagged = cleaning.flag_extremes(df, limits, ["trip_distance"])
    assert flagged.count() == 103
    assert [r.trip_distance for r in flagged.where("is_extreme_trip_distance").collect()] == [1000.0]
    assert flagged.where("is_extreme_trip_distance is null").count() == 0


def test_outlier_multiplier(spark):
    from tidegrid.functions.columns import outlier_multiplier
    got = spark.createDataFrame([(1,), (100,), (101,), (1_000_000,)], "n long").select(outlier_multiplier(F.col("n"))).collect()
    assert [round(r[0], 6) for r in got] == [1.5, 1.5, round(math.log(101) ** 0.5 - 0.5, 6), 3.216922]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, None), (265, None), (300, None)], "pu int, empty double")
    assert rows(profile.missingness(df), "column_name") == [("empty", 4, 100.0), ("pu", 0, 0.0)]
    assert rows(profile.missingness(df.limit(0)), "column_name") == [("empty", 0, 0.0), ("pu", 0, 0.0)]
    numeric = {r.column_name: r for r in profile.numeric_profile(df, ["pu", "empty"]).collect()}
    assert numeric["empty"]["count"] == 0 and numeric["empty"]["median"] is None
    assert (numeric["pu"]["min"], numeric["pu"]["median"], numeric["pu"]["max"]) == (1.0, 133.5, 300.0)
    quick = {r.column_name: r for r in profile.numeric_profile(df, ["pu"], exact=False).collect()}
    assert quick["pu"]["p99_9"] == 300.0
    place = profile.place_validity(df, ["pu"]).first()
    assert (place.null_count, place.out_of_range_count, place.placeholder_count, place.pct_out_of_range) == (0, 1, 1, 25.0)


def test_null_is_never_an_unexpected_code(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "code int")
    got = rows(profile.code_distribution(df, {"code": (1, 2)}), "value")
    assert got == [("code", None, 1, False), ("code", "1", 1, False), ("code", "9", 1, True)]


def test_checks_do_not_count_nulls(spark):
    df = spark.createDataFrame([(7,), (None,), (3,)], "VendorID int")
    got = rows(rules.count_findings(df, {"vendor": ~F.col("VendorID").isin(1, 2)}))
    assert got == [("vendor", 2, 66.6667)]


def test_field_rules_cover_every_field():
    for kind in ("yellow", "green"):
        catalogue = rules.field_rules(kind)
        assert list(catalogue) == [S.CLEAN_RENAMES[kind].get(n, n) for n in S.RAW_SCHEMAS[kind].names]
        assert [n for n, r in catalogue.items() if r.essential] == ["pickup_datetime", "pu_location_id"]
    assert rules.field_rules("yellow")["vendor_id"].valid_codes == (1, 2, 6, 7)


def test_schema_diff(spark):
    listing = spark.createDataFrame(
        [("l", "a", "int"), ("l", "b", "int"), ("r", "b", "double"), ("r", "c", "int")],
        "table_name string, column_name string, data_type string",
    )
    got = rows(profile.schema_diff(listing, "l", "r").select("column_name", "difference"), "column_name")
    assert got == [("a", "only_left"), ("b", "type_mismatch"), ("c", "only_right")]
