"""Demand ratio classes: thresholds from training demand, labels, and how well they are predicted.

Two edge rules exist side by side. Bins (:func:`classify`) are closed on the right, so a ratio of
exactly 1.0 is below normal. Group thresholds (:func:`classify_by_group`) are closed on the left, so
it is normal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import demand_ratio
from ..session import stage
from .percentiles import bounded_percentiles, exact_percentiles

# --- fixed values: labels and thresholds ---------------------------------------------------------
LABELS = ["below_normal", "normal", "elevated", "very_elevated"]
FIXED_EDGES = [1.0, 1.5, 2.0]
MIN_BASELINE = 1.0
PERCENTILES = [0.75, 0.95]
MIN_GROUP_OBSERVATIONS = 50
GROUP = ["pu_location_id", "hour_of_day"]


def reliable(df: DataFrame, min_baseline: float = MIN_BASELINE, baseline: str = "baseline_pickup_count") -> DataFrame:
    """Rows whose baseline is large enough for a ratio to mean something."""
    return df.where(F.col(baseline) >= min_baseline)


def with_ratio(
    df: DataFrame,
    demand: str = "pickup_count",
    baseline: str = "baseline_pickup_count",
    output: str = "dtdi",
) -> DataFrame:
    return df.withColumn(output, demand_ratio(demand, baseline))


def city_thresholds(
    train: DataFrame, min_baseline: float = MIN_BASELINE, percentiles: list[float] = PERCENTILES
) -> DataFrame:
    """One row: ``p_low``, ``p_high`` and ``n_obs`` of the reliable training ratios.

    The whole training period is one group, so this uses the distributed percentile. Ratios are
    stored: it reads them twice.
    """
    ratios = stage(with_ratio(reliable(train, min_baseline)).select("dtdi"), "ratios")
    out = exact_percentiles(ratios, "dtdi", percentiles)
    return out.select(
        F.col("percentiles")[0].alias("p_low"), F.col("percentiles")[1].alias("p_high"), "n_obs"
    )


def city_edges(thresholds: DataFrame) -> list[float]:
    """Inner bin edges for :func:`classify`."""
    row = thresholds.first()
    return [1.0, row["p_low"], row["p_high"]]


def group_thresholds(
    train: DataFrame,
    group: list[str] = GROUP,
    min_baseline: float = MIN_BASELINE,
    percentiles: list[float] = PERCENTILES,
) -> dict[str, DataFrame]:
    """Thresholds per (place, hour), per place, and city-wide, from training rows only.

    A place has one row per kind and hour of the period on the grid, which is the ceiling of the
    bounded form; the city-wide level has no ceiling.
    """
    ratios = with_ratio(reliable(train, min_baseline))

    def level(df: DataFrame, by: list[str]) -> DataFrame:
        return df.select(
            *by, F.col("percentiles")[0].alias("p_low"), F.col("percentiles")[1].alias("p_high"), "n_obs"
        )

    return {
        "zone_hour": level(bounded_percentiles(ratios, "dtdi", percentiles, group), group),
        "zone": level(bounded_percentiles(ratios, "dtdi", percentiles, group[:1]), group[:1]),
        "global": city_thresholds(train, min_baseline, percentiles),
    }


def classify(ratio: Column, edges: list[float] = FIXED_EDGES) -> Column:
    """Label of a ratio by right-closed bins; no ratio, no label."""
    low, middle, high = edges
    return (
        F.when(ratio <= low, LABELS[0])
        .when(ratio <= middle, LABELS[1])
        .when(ratio <= high, LABELS[2])
        .when(ratio > high, LABELS[3])
    )


def resolve_thresholds(
    df: DataFrame,
    levels: dict[str, DataFrame],
    group: list[str] = GROUP,
    min_group_obs: int = MIN_GROUP_OBSERVATIONS,
) -> DataFrame:
    """``df`` plus the ``p_low`` / ``p_high`` its rows are judged by, and their level.

    The finest level with enough training observations wins. The level tables are written first, so
    the planner knows their size when it picks a join.
    """
    fine = stage(levels["zone_hour"], "zone-hour-thresholds")
    place = stage(levels["zone"], "zone-thresholds")
    joined = (
        df.join(fine.withColumnsRenamed({"p_low": "_lo1", "p_high": "_hi1", "n_obs": "_n1"}), group, "left")
        .join(place.withColumnsRenamed({"p_low": "_lo2", "p_high": "_hi2", "n_obs": "_n2"}), group[:1], "left")
        # One row.
        .join(
            F.broadcast(levels["global"].select(F.col("p_low").alias("_lo3"), F.col("p_high").alias("_hi3"))),
            F.lit(True),
            "left",
        )
    )
    fine_ok = F.coalesce(F.col("_n1"), F.lit(0)) >= min_group_obs
    place_ok = F.coalesce(F.col("_n2"), F.lit(0)) >= min_group_obs
    return joined.select(
        *df.columns,
        F.when(fine_ok, F.col("_lo1")).when(place_ok, F.col("_lo2")).otherwise(F.col("_lo3")).alias("p_low"),
        F.when(fine_ok, F.col("_hi1")).when(place_ok, F.col("_hi2")).otherwise(F.col("_hi3")).alias("p_high"),
        F.when(fine_ok, "zone_hour").when(place_ok, "zone").otherwise("global").alias("threshold_level"),
    )


def classify_by_group(ratio: Column, p_low: Column, p_high: Column) -> Column:
    """Label of a ratio by left-closed thresholds; below 1.0 is always below normal."""
    return (
        F.when(ratio < 1.0, LABELS[0])
        .when(ratio >= p_high, LABELS[3])
        .when(ratio >= p_low, LABELS[2])
        .when(ratio.isNotNull(), LABELS[1])
    )


def _cells(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row with the count of every (actual, predicted) pair of labels."""
    return df.agg(
        *[
            F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"_{i}_{j}")
            for i, a in enumerate(LABELS)
            for j, p in enumerate(LABELS)
        ]
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Four rows, four columns; rows with either label missing are left out."""
    return _cells(df, actual, predicted).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f"actual_{a}").alias("actual_category"),
                        *[F.col(f"_{i}_{j}").alias(f"pred_{p}") for j, p in enumerate(LABELS)],
                    )
                    for i, a in enumerate(LABELS)
                ]
            )
        )
    )


def classification_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per label, with macro and micro averages."""
    size = range(len(LABELS))

    def total(parts) -> Column:
        return sum(parts, F.lit(0))

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)).cast("double")

    hit = [F.col(f"_{i}_{i}") for i in size]
    support = [total(F.col(f"_{i}_{j}") for j in size) for i in size]
    called = [total(F.col(f"_{i}_{j}") for i in size) for j in size]
    everything = total(support)
    rows = []
    for i, label in enumerate(LABELS):
        # F1 as 2 * hits / (support + called): zero when there is nothing to find or say.
        rows.append(
            (label, ratio(hit[i], called[i]), ratio(hit[i], support[i]),
             ratio(2 * hit[i], support[i] + called[i]), support[i])
        )
    macro = tuple(sum((r[k] for r in rows), F.lit(0.0)) / len(LABELS) for k in (1, 2, 3))
    accuracy = ratio(total(hit), everything)
    rows.append(("macro_avg", *macro, everything))
    rows.append(("micro_avg", accuracy, accuracy, accuracy, everything))
    return _cells(df, actual, predicted).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("category"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("long").alias("support"),
                    )
                    for n, p, r, f, s in rows
                ]
            )
        )
    )


def by_severity(
    df: DataFrame,
    ratio: str = "dtdi",
    severity: str = "weather_severity",
    accuracy: int | None = None,
) -> DataFrame:
    """Mean, median and count of the ratio per weather class; the two columns are stored, for three reads."""
    rows = stage(df.where(F.col(severity).isNotNull()).select(severity, ratio), "severity-ratios")
    means = rows.groupBy(severity).agg(
        F.avg(ratio).alias("mean_dtdi"), F.count(ratio).alias("n_obs")
    )
    if accuracy:
        medians = rows.groupBy(severity).agg(F.percentile_approx(ratio, 0.5, accuracy).alias("median_dtdi"))
    else:
        medians = exact_percentiles(rows, ratio, [0.5], [severity]).select(
            severity, F.col("percentiles")[0].alias("median_dtdi")
        )
    return means.join(medians, severity, "left")


def compression(
    df: DataFrame,
    actual: str,
    predicted: dict[str, str],
    severity: str = "weather_severity",
    calm: str = "normal",
    rough: str = "severe",
) -> DataFrame:
    """Per model: spread of actual over predicted ratios, and how much of the real drop it shows."""

    def drop(c: str) -> Column:
        return F.avg(F.when(F.col(severity) == calm, F.col(c))) - F.avg(
            F.when(F.col(severity) == rough, F.col(c))
        )

    wide = df.agg(
        F.stddev_samp(actual).alias("_std"),
        drop(actual).alias("_drop"),
        *[F.stddev_samp(c).alias(f"_std{i}") for i, c in enumerate(predicted.values())],
        *[drop(c).alias(f"_drop{i}") for i, c in enumerate(predicted.values())],
    )
    zero = F.lit(0.0)
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("model"),
                        (F.col("_std") / F.nullif(F.col(f"_std{i}"), zero)).alias("std_ratio"),
                        F.col("_drop").alias("actual_drop"),
                        F.col(f"_drop{i}").alias("predicted_drop"),
                        (100 * F.col(f"_drop{i}") / F.nullif(F.col("_drop"), zero)).alias("pct_drop_captured"),
                    )
                    for i, m in enumerate(predicted)
                ]
            )
        )
    )
