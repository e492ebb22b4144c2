"""Exact percentiles (linear interpolation) that never hold one group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation buffer. That is fine
for groups with a known ceiling. Without one, two passes over the column do the same job:

1. a mergeable sketch per group gives, for each percentile, a bracket that must contain it;
2. values inside a bracket are counted per distinct value, the values between two brackets are
   counted as one, and the running count finds the wanted ranks.

A value makes one row of the second pass, and the ranked part holds about ``8 / accuracy`` of a group
per percentile (all of it, up to ``accuracy`` rows). Both passes combine on the map side, so a group
with a third of all rows is spread over as many tasks as the scan has. The ranked part is a fixed
share of a group and thus as unbounded as the group: it is dealt by ranges of values, each range is
counted, and a running count within a range starts at the sum of the ranges before it. A rank that
falls between the brackets is an error, never a wrong number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def exact_percentiles(
    df: DataFrame,
    value: str,
    probabilities: list[float],
    by: list[str] | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """``by`` columns, ``n_obs`` and ``percentiles`` (array in the order of ``probabilities``).

    NULL values are ignored; a group with no value at all is absent.
    """
    by = by or []
    keys = by or ["_all"]
    base = df if by else df.withColumn("_all", F.lit(1))
    base = base.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    brackets = stage(_brackets(base, keys, probabilities, accuracy), "percentile-brackets")
    span = range(len(probabilities))

    at, between = _place(F.col("_v"), [F.col(f"_lo{i}") for i in span], [F.col(f"_hi{i}") for i in span])
    counted = (
        base.join(brackets, _same(base, brackets, keys))
        .select(
            *[base[k] for k in keys],
            "n_obs",
            at.alias("_at"),
            between.alias("_between"),
        )
        .groupBy(*keys, "n_obs", "_at", "_between")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return _pick(counted, keys, probabilities).select(*by, "n_obs", "percentiles")


def column_summaries(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    by: list[str] | None = None,
    accuracy: int = 10_000,
    exact: bool = True,
) -> DataFrame:
    """Count, mean, deviation, range and percentiles of several columns in two reads of ``df``.

    One row per group and column: ``by``, ``column_name``, ``n_rows`` (rows of the group), ``count``, ``mean``,
    ``stddev``, ``min``, ``max`` and ``percentiles``. A column without values has count 0 and NULLs; without
    ``by`` an empty table gives such a row per column.

    The first read is one aggregate with a sketch per column. In the second a row becomes its place in every
    column: the value inside a bracket, the end of the bracket before it otherwise. Rows with equal places
    fold before the shuffle, and only what is left is unfolded by column; rows are never multiplied.
    ``exact=False`` stops after the first read and takes the percentiles from the sketch.
    """
    by = by or []
    keys = by or ["_all"]
    values = [f"_v{i}" for i in range(len(columns))]
    base = df.select(*by, *[F.col(c).cast("double").alias(v) for c, v in zip(columns, values)])
    lows, highs = _widened(probabilities, accuracy)
    wide = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.struct(
                F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stddev"),
                F.min(v).alias("min"), F.max(v).alias("max"),
                F.percentile_approx(v, lows + highs if exact else probabilities, accuracy).alias("percentiles"),
            ).alias(f"_of_{v}")
            for v in values
        ],
    )
    if not by:
        wide = wide.withColumn("_all", F.lit(1))
        base = base.withColumn("_all", F.lit(1))
    if not exact:
        return _by_column(wide, keys, columns, values).select(*by, *_SUMMARY, "percentiles")

    wide = stage(wide, "column-summaries")
    ends = []
    for v in values:
        of = F.col(f"_of_{v}")
        low, high = _ends(of["count"], of["min"], of["max"], of["percentiles"], lows, highs, accuracy)
        ends += [F.array(*low).alias(f"_lo{v}"), F.array(*high).alias(f"_hi{v}")]
    placed = _join_by(base, wide.select(*keys, *ends), keys)
    span = range(len(probabilities))
    places = []
    for v in values:
        at, between = _place(
            F.col(v), [F.col(f"_lo{v}")[i] for i in span], [F.col(f"_hi{v}")[i] for i in span]
        )
        places += [at.alias(f"_at{v}"), between.alias(f"_between{v}")]
    folded = (
        placed.select(*keys, *places)
        .groupBy(*keys, *[f"{part}{v}" for v in values for part in ("_at", "_between")])
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    unfolded = folded.select(
        *keys,
        "_n",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"), F.col(f"_at{v}").alias("_at"), F.col(f"_between{v}").alias("_between")
                    )
                    for c, v in zip(columns, values)
                ]
            )
        ),
    ).where(F.col("_between").isNotNull())
    summaries = _by_column(wide, keys, columns, values)
    column = [*keys, "column_name"]
    counted = _join_by(
        unfolded.groupBy(*column, "_at", "_between").agg(F.sum("_n").alias("_n")),
        summaries.select(*column, F.col("count").alias("n_obs")),
        column,
    )
    picked = _pick(counted, column, probabilities).drop("n_obs")
    return _join_by(summaries.drop("percentiles"), picked, column, "left").select(*by, *_SUMMARY, "percentiles")


_SUMMARY = ["column_name", "n_rows", "count", "mean", "stddev", "min", "max"]


def _by_column(wide: DataFrame, keys: list[str], columns: list[str], values: list[str]) -> DataFrame:
    """One row per group to one row per group and column."""
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"_of_{v}.*")) for c, v in zip(columns, values)]
    return wide.select(*keys, "n_rows", F.inline(F.array(*entries)))


def _join_by(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULLs equal; the keys of ``left`` stay."""
    names = [f"_right{i}" for i in range(len(keys))]
    aside = right.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    return left.join(aside, same, how).drop(*names)


def _place(value: Column, lows: list[Column], highs: list[Column]) -> tuple[Column, Column]:
    """Where a value lies: itself inside a bracket, else the last bracket end before it (NULL below all).

    The second column is true between brackets and NULL for NULL.
    """
    inside = reduce(lambda a, b: a | b, [value.between(low, high) for low, high in zip(lows, highs)])
    ends = [F.when(high < value, high) for high in highs]
    before = F.greatest(*ends) if len(ends) > 1 else ends[0]
    return F.when(inside, value).otherwise(before), ~inside


def _pick(counted: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """``keys``, ``n_obs`` and ``percentiles`` from counts of places (``_at``, ``_between``, ``_n``)."""
    ranked = _running(counted, keys)

    def at(rank: Column) -> Column:
        here = (rank >= F.col("_to") - F.col("_n")) & (rank < F.col("_to")) & ~F.col("_between")
        return F.max(F.when(here, F.col("_at")))

    ranks = [F.lit(float(p)) * (F.col("n_obs") - 1) for p in probabilities]
    picked = ranked.groupBy(*keys, "n_obs").agg(
        *[at(F.floor(r)).alias(f"_lower{i}") for i, r in enumerate(ranks)],
        *[at(F.ceil(r)).alias(f"_upper{i}") for i, r in enumerate(ranks)],
    )
    missed = F.raise_error(F.lit("percentile rank outside its bracket")).cast("double")
    values = []
    for i, rank in enumerate(ranks):
        low, high = F.col(f"_lower{i}"), F.col(f"_upper{i}")
        values.append(F.coalesce(low + (high - low) * (rank - F.floor(rank)), missed))
    return picked.select(*keys, "n_obs", F.array(*values).alias("percentiles"))


def _running(counted: DataFrame, keys: list[str]) -> DataFrame:
    """``counted`` with ``_to``: the sum of ``_n`` up to and with each row of its group, by value.

    Rows are dealt by range and stored with the number of their range, so that later reads agree on
    the ranges; only one row per group and range goes through a window by group.
    """
    in_order = [F.col("_at").asc_nulls_first(), F.col("_between")]
    dealt = stage(
        counted.repartitionByRange(*keys, *in_order).withColumn("_range", F.spark_partition_id()), "percentile-ranges"
    )
    sums = dealt.groupBy(*keys, "_range").agg(F.sum("_n").alias("_all_n"))
    by_group = Window.partitionBy(*keys).orderBy("_range")
    before = (F.sum("_all_n").over(by_group) - F.col("_all_n")).alias("_start")
    starts = sums.select(*[F.col(k).alias(f"_of{i}") for i, k in enumerate([*keys, "_range"])], before)
    within = Window.partitionBy(*keys, "_range").orderBy(*in_order)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of{i}")) for i, k in enumerate([*keys, "_range"])])
    return dealt.join(starts, same).select(*dealt.columns, (F.col("_start") + F.sum("_n").over(within)).alias("_to"))


def _widened(probabilities: list[float], accuracy: int) -> tuple[list[float], list[float]]:
    """Probabilities around each percentile that cover the error of the sketch."""
    slack = 4.0 / accuracy
    return [max(0.0, p - slack) for p in probabilities], [min(1.0, p + slack) for p in probabilities]


def _ends(
    n: Column, least: Column, most: Column, quantile: Column, lows: list[float], highs: list[float], accuracy: int
) -> tuple[list[Column], list[Column]]:
    """Both ends of every bracket, from a sketch of the probabilities ``lows`` and then ``highs``.

    A small group is ranked whole: there the slack is less than a rank. In a larger one it covers the
    error of the sketch and the neighbour that interpolation needs.
    """
    whole = n <= accuracy
    return (
        [F.when(whole | F.lit(p == 0.0), least).otherwise(quantile[i]) for i, p in enumerate(lows)],
        [F.when(whole | F.lit(p == 1.0), most).otherwise(quantile[len(lows) + i]) for i, p in enumerate(highs)],
    )


def _brackets(base: DataFrame, keys: list[str], probabilities: list[float], accuracy: int) -> DataFrame:
    """One row per group: its size and the bracket of every percentile."""
    lows, highs = _widened(probabilities, accuracy)
    sketched = base.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", lows + highs, accuracy).alias("_q"),
    )
    low, high = _ends(F.col("n_obs"), F.col("_min"), F.col("_max"), F.col("_q"), lows, highs, accuracy)
    return sketched.select(
        *keys,
        "n_obs",
        *[c.alias(f"_lo{i}") for i, c in enumerate(low)],
        *[c.alias(f"_hi{i}") for i, c in enumerate(high)],
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def bounded_percentiles(
    df: DataFrame, value: str, probabilities: list[float], by: list[str]
) -> DataFrame:
    """Same result in one aggregate, for groups whose size has a ceiling.

    On a dense grid a slot holds one row per period, so place-level groups have such a ceiling.
    """
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.percentile(value, [float(p) for p in probabilities]).alias("percentiles"),
    )
