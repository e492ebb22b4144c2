import pytest
from helpers import rows, ts
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegrid.operators import cleaning
from tidegrid.sources import landing, tables
from tidegrid.sources import schemas as S


@pytest.mark.parametrize(
    "kind, name, period",
    [
        ("yellow", "Yellow Taxi Data Jan 2024.parquet", (2024, 1)),
        ("yellow", "Yellow Taxi Data June 2024.parquet", (2024, 6)),
        ("yellow", "Yellow Taxi Data Sept 2025.parquet", (2025, 9)),
        ("green", "Green Trip Data Dec 2025.parquet", (2025, 12)),
        ("green", "Green Trip Data July 2024.parquet", (2024, 7)),
    ],
)
def test_period_from_file_name(spark, kind, name, period):
    assert landing.parse_file_name(kind, name) == period
    year, month = landing.period_columns(kind, F.col("n"))
    assert rows(spark.createDataFrame([(name,)], "n string").select(year, month)) == [period]


@pytest.mark.parametrize("name", ["trips.parquet", "Yellow Taxi Data Foo 2024.parquet", "Green Trip Data Jan 2024.parquet"])
def test_unexpected_file_name_raises(spark, name):
    with pytest.raises(ValueError):
        landing.parse_file_name("yellow", name)
    year, month = landing.period_columns("yellow", F.col("n"))
    with pytest.raises(PySparkException):
        spark.createDataFrame([(name,)], "n string").select(year, month).collect()


def test_missing_column_becomes_typed_null_and_extra_column_goes(spark):
    df = spark.createDataFrame([(1, "N", 7, "x")], "VendorID long, store_and_fwd_flag string, PULocationID long, other string")
    out = landing.standardise(df, "yellow")
    assert out.schema.names == S.YELLOW_RAW.names
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in S.YELLOW_RAW.fields]
    row = out.first()
    assert (row.vendor_id, row.store_and_fwd_flag, row.pu_location_id, row.cbd_congestion_fee) == (1, "N", 7, None)


def test_null_codes_are_preserved(spark):
    df = spark.createDataFrame([(None, None), (2, 99)], "VendorID int, RatecodeID int")
    out = landing.standardise(df, "green")
    assert rows(out.select("vendor_id", "ratecode_id"), "vendor_id") == [(None, None), (2, 99)]


def test_unify_computes_duration_and_structural_nulls(spark):
    raw = spark.createDataFrame(
        [(1, ts("2024-01-01 10:00:00"), ts("2024-01-01 10:20:00"), 1.5)],
        "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, Airport_fee double",
    )
    raw = landing.with_provenance(
        landing.standardise(raw, "yellow"), "yellow", F.lit("f"), F.lit(2024), F.lit(1), "now"
    )
    out = cleaning.unify(raw, "yellow")
    assert out.columns == [*S.CLEAN.names, *S.PROVENANCE.names]
    row = out.first()
    assert (row.taxi_type, row.trip_duration_minutes, row.airport_fee) == ("yellow", 20.0, 1.5)
    assert row.ehail_fee is None and row.trip_type is None and row.source_dataset == "yellow_taxi"


def test_standardising_does_not_change_the_layout_constants(spark, tmp_path):
    before = list(S.YELLOW_RAW.names)
    landing.read_landing(spark, "yellow", str(_landing(spark, tmp_path)), "now").count()
    assert S.YELLOW_RAW.names == before


def _landing(spark, tmp_path):
    """Two months with different layouts, under published names."""
    early = spark.createDataFrame(
        [(1, 3.0, ts("2024-01-05 10:00:00")), (2, None, ts("2024-01-06 11:00:00"))],
        "VendorID long, passenger_count double, tpep_pickup_datetime timestamp_ntz",
    )
    late = spark.createDataFrame(
        [(6, 1, ts("2025-02-05 10:00:00"), 0.75)],
        "VendorID int, passenger_count long, tpep_pickup_datetime timestamp_ntz, cbd_congestion_fee double",
    )
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    for name, df in {"Jan 2024": early, "Feb 2025": late}.items():
        df.toPandas().to_parquet(folder / f"Yellow Taxi Data {name}.parquet", coerce_timestamps="us")
    return folder


def test_drifting_months_become_one_table(spark, tmp_path):
    raw = landing.read_landing(spark, "yellow", str(_landing(spark, tmp_path)), "now")
    got = rows(
        raw.select("vendor_id", "passenger_count", "cbd_congestion_fee", "source_file", "source_year", "source_month"),
        "vendor_id",
    )
    assert got == [
        (1, 3, None, "Yellow Taxi Data Jan 2024.parquet", 2024, 1),
        (2, None, None, "Yellow Taxi Data Jan 2024.parquet", 2024, 1),
        (6, 1, 0.75, "Yellow Taxi Data Feb 2025.parquet", 2025, 2),
    ]
    assert raw.select("tpep_pickup_datetime").dtypes == [("tpep_pickup_datetime", "timestamp")]


def test_files_of_one_layout_share_a_scan(spark, tmp_path):
    folder = _landing(spark, tmp_path)
    same = spark.read.parquet(str(folder / "Yellow Taxi Data Jan 2024.parquet")).toPandas()
    same.to_parquet(folder / "Yellow Taxi Data Mar 2024.parquet", coerce_timestamps="us")
    bundles = landing.layouts(spark, "yellow", str(folder))
    assert sorted(len(b.paths) for b in bundles) == [1, 2]


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    """Footers of one file or thirty: the same jobs; files that Spark wrote and files of others have layouts of their own."""
    def jobs(folder):
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("layouts"))
        spark.sparkContext.setJobGroup("layouts", "layouts")
        found = landing.layouts(spark, "yellow", str(folder))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup("layouts")) - before

    one, many = tmp_path / "one", tmp_path / "many"
    table = spark.createDataFrame([(1, 2.0)], "VendorID long, passenger_count double").toPandas()
    for folder, years in ((one, range(2020, 2021)), (many, range(1990, 2020))):
        folder.mkdir()
        for year in years:
            table.to_parquet(folder / f"Yellow Taxi Data Jan {year}.parquet")
    (few, a), (lots, b) = jobs(one), jobs(many)
    assert [len(x.paths) for x in few] == [1] and [len(x.paths) for x in lots] == [30] and a == b


def test_wrong_name_in_the_folder_raises(spark, tmp_path):
    folder = _landing(spark, tmp_path)
    spark.createDataFrame([(1,)], "VendorID long").toPandas().to_parquet(folder / "Yellow Taxi Data Foo 2024.parquet")
    with pytest.raises(ValueError, match="Foo"):
        landing.read_landing(spark, "yellow", str(folder))


def test_ingest_log_and_rerun(spark, tmp_path):
    folder, path = str(_landing(spark, tmp_path)), str(tmp_path / "raw")
    for _ in range(2):
        tables.write_raw(landing.read_landing(spark, "yellow", folder, "now"), path)
    written = tables.read_table(spark, path, kind="yellow")
    assert written.count() == 3
    log = landing.ingest_log(landing.landing_profile(spark, "yellow", folder), written, "yellow")
    got = rows(log.select("month", "landing_row_count", "raw_row_count", "landing_column_count", "landing_null_count", "status"), "month")
    assert got == [(1, 2, 2, 3, 1, "ok"), (2, 1, 1, 4, 0, "ok")]
    total = landing.ingest_totals(log).where("taxi_type = 'combined'").first()
    assert (total.landing_rows, total.min_columns, total.max_columns, total.mismatching_files) == (3, 3, 4, 0)


def test_lost_rows_are_reported(spark, tmp_path):
    folder = str(_landing(spark, tmp_path))
    raw = landing.read_landing(spark, "yellow", folder, "now").where("vendor_id <> 1")
    log = landing.ingest_log(landing.landing_profile(spark, "yellow", folder), raw, "yellow")
    assert rows(log.select("month", "status"), "month") == [(1, "ROW_COUNT_MISMATCH"), (2, "ok")]


def test_empty_folder_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "none").mkdir()
    raw = landing.read_landing(spark, "green", str(tmp_path / "none"), "now")
    assert raw.count() == 0 and raw.columns == [*S.GREEN_RAW.names, *S.PROVENANCE.names]


def test_period_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(ts("2024-01-05 10:00:00"), 1)], "at timestamp, v int").write.parquet(path)
    df = tables.between_times(spark.read.parquet(path), "at", "2024-01-01 00:00:00", "2024-02-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "LessThan(at" in plan
    assert df.count() == 1
