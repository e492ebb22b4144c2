import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegrid.operators import percentiles
from tidegrid.operators.percentiles import bounded_percentiles, exact_percentiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0]


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_equals_numpy_on_a_hot_group_and_small_ones(spark, accuracy):
    rng = np.random.default_rng(3)
    data = {
        "hot": np.round(rng.lognormal(0, 3, 30_000), 2),
        "ties": rng.integers(0, 3, 9_000).astype(float),
        "pair": np.array([1.0, 4.0]),
        "one": np.array([-7.5]),
    }
    pairs = [(g, float(v)) for g, values in data.items() for v in values] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(pairs, "g string, v double").repartition(6)
    got = {r.g: r for r in exact_percentiles(df, "v", PROBS, ["g"], accuracy).collect()}
    assert sorted(got) == ["hot", "one", "pair", "ties"]
    for g, values in data.items():
        assert got[g].n_obs == len(values)
        assert np.allclose(got[g].percentiles, np.quantile(values, PROBS), rtol=1e-12, atol=0)


def test_without_groups_and_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    assert exact_percentiles(df, "v", [0.5]).first().percentiles == [3.0]
    got = {r.g: r.percentiles for r in exact_percentiles(df, "v", [0.5], ["g"]).collect()}
    assert got == {None: [2.0], "a": [5.0]}


def test_bounded_form_agrees(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.sqrt("id").alias("v"))
    a = {r.g: r for r in exact_percentiles(df, "v", PROBS, ["g"], 100).collect()}
    b = {r.g: r for r in bounded_percentiles(df, "v", PROBS, ["g"]).collect()}
    assert a.keys() == b.keys()
    for g in a:
        assert np.allclose(a[g].percentiles, b[g].percentiles, rtol=1e-12)


def test_ranks_of_a_hot_group_are_dealt_over_ranges(spark):
    counted = spark.range(40_000).select(
        F.lit("hot").alias("g"), F.lit(40_000).alias("n_obs"), F.hash("id").cast("double").alias("_at"), F.lit(False).alias("_between"), F.lit(1).cast("long").alias("_n"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = percentiles._running(counted, ["g"])
        sizes = [r["count"] for r in ranked.groupBy("_range").count().collect()]
        wrong = ranked.withColumn("_rank", F.row_number().over(Window.orderBy("_at"))).where("_rank <> _to").count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 20_000 and sum(sizes) == 40_000
    assert wrong == 0


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_column_summaries_equal_numpy_per_group_and_column(spark, accuracy):
    rng = np.random.default_rng(5)
    n = 20_000
    frame = {
        "g": ["hot"] * 15_000 + ["small"] * 4_990 + ["tiny"] * 9 + [None],
        "wide": [None if i % 7 == 0 else float(v) for i, v in enumerate(np.round(rng.lognormal(0, 3, n), 3))],
        "few": [int(v) for v in rng.integers(0, 4, n)],
    }
    df = spark.createDataFrame(list(zip(*frame.values())), "g string, wide double, few int").withColumn(
        "empty", F.lit(None).cast("double")
    ).repartition(5)
    got = {(r.g, r.column_name): r for r in percentiles.column_summaries(df, ["wide", "few", "empty"], PROBS, ["g"], accuracy).collect()}
    assert len(got) == 12
    for g in ("hot", "small", "tiny", None):
        rows = [i for i, v in enumerate(frame["g"]) if v == g]
        for c in ("wide", "few"):
            values = np.array([frame[c][i] for i in rows if frame[c][i] is not None], float)
            r = got[g, c]
            assert (r.n_rows, r["count"]) == (len(rows), len(values))
            if len(values):
                assert (r.min, r.max) == (values.min(), values.max()) and np.isclose(r.mean, values.mean())
                assert np.allclose(r.percentiles, np.quantile(values, PROBS), rtol=1e-12, atol=0)
            if len(values) > 1:
                assert np.isclose(r.stddev, values.std(ddof=1))
        assert got[g, "empty"]["count"] == 0 and got[g, "empty"].percentiles is None


def test_column_summaries_without_groups_and_of_an_empty_table(spark):
    df = spark.createDataFrame([(1.0, 2), (3.0, None), (None, 4)], "a double, b int")
    got = {r.column_name: r for r in percentiles.column_summaries(df, ["a", "b"], [0.5]).collect()}
    assert {c: (r.n_rows, r["count"], r.percentiles) for c, r in got.items()} == {"a": (3, 2, [2.0]), "b": (3, 2, [3.0])}
    none = percentiles.column_summaries(df.limit(0), ["a", "b"], [0.5]).collect()
    assert sorted((r.column_name, r["count"], r.min, r.percentiles) for r in none) == [("a", 0, None, None), ("b", 0, None, None)]
    assert percentiles.column_summaries(df.limit(0), ["b"], [0.5], ["a"]).count() == 0


def test_column_summaries_read_their_input_twice_and_never_multiply_rows(spark, tmp_path):
    spark.range(5_000).select(F.sqrt("id").alias("a"), (F.col("id") % 3).alias("b"), F.log1p("id").alias("c")).write.parquet(str(tmp_path / "t"))
    read = spark.sparkContext.accumulator(0)
    seen = spark.read.parquet(str(tmp_path / "t"))

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    out = percentiles.column_summaries(seen.mapInArrow(counted, seen.schema), ["a", "b", "c"], PROBS, accuracy=100)
    assert out.count() == 3
    assert read.value == 10_000
