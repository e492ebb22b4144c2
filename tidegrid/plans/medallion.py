"""The layers end to end: landing -> raw -> clean -> processed, then fit and evaluate.

Every layer is written once and read back, so a lost executor costs tasks and not layers, and every
report is measured on what was written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import baseline, cleaning, dtdi, externals, features, grid, metrics, models, profile, rules, topk
from ..session import stage
from ..sources import dimensions, landing, reports, tables
from ..sources import schemas as S


@dataclass(frozen=True)
class Layout:
    """Where the layers live, and what the study covers."""

    root: str
    kinds: tuple[str, ...] = ("yellow", "green")
    period: tuple[str, str] = (S.PERIOD_START, S.PERIOD_END)
    train_end: str = S.TRAIN_END
    validation_start: str = S.VALIDATION_START
    window_weeks: int = S.WINDOW_WEEKS

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])


def ingest(spark: SparkSession, layout: Layout, stamp: str | None = None) -> DataFrame:
    """Landing to raw. Returns the ingest log, read from what was written."""
    raw_path = layout.path("raw")
    logs = []
    for kind in layout.kinds:
        folder = layout.path("landing", kind)
        found = landing.layouts(spark, kind, folder)
        tables.write_raw(landing.read_landing(spark, kind, folder, stamp, found), raw_path)
        written = load_raw(spark, layout, kind)
        logs.append(landing.ingest_log(landing.landing_profile(spark, kind, folder, found), written, kind))
    log = stage(reports.stack_reports(*logs), "ingest-log")
    reports.write_report(log, layout.path("reports", "ingest_log"), "json")
    reports.write_report(landing.ingest_totals(log), layout.path("reports", "ingest_totals"), "csv")
    return log


def load_raw(spark: SparkSession, layout: Layout, kind: str) -> DataFrame:
    """Raw layer of one kind, scanned with its schema and pruned to its folders."""
    # The raw folder holds two layouts side by side, so a scan asks for the columns of one.
    schema = type(S.YELLOW_RAW)(
        [*S.RAW_SCHEMAS[kind].fields, *S.PROVENANCE.fields, S.CLEAN["taxi_type"]]
    )
    df = tables.read_table(spark, layout.path("raw"), schema, kind)
    return df.drop("taxi_type")


def load_clean(spark: SparkSession, layout: Layout, kind: str | None = None) -> DataFrame:
    return tables.read_table(spark, layout.path("clean"), kind=kind)


def load_processed(
    spark: SparkSession, layout: Layout, columns: list[str] | None = None
) -> DataFrame:
    return tables.read_table(spark, layout.path("processed"), columns=columns)


def clean(spark: SparkSession, layout: Layout) -> DataFrame:
    """Raw to clean for every kind. Returns the ledger of all of them."""
    unified = reduce(
        DataFrame.unionByName,
        [cleaning.unify(load_raw(spark, layout, k), k) for k in layout.kinds],
    )
    rule_list = rules.trip_rules(period=layout.period)
    keys = [c for c in S.CLEAN.names if c != "trip_duration_minutes"]
    audited = stage(
        cleaning.audit(
            unified, rule_list, keys, order_by=S.PROVENANCE.names, by=["taxi_type"], prefilter=True
        ),
        "audit",
    )
    kept = cleaning.clean_rows(audited)
    measured = ["trip_distance", "trip_duration_minutes"]
    flagged = cleaning.flag_extremes(kept, cleaning.extreme_thresholds(kept, measured), measured)
    tables.write_clean(flagged, layout.path("clean"), in_place=True)

    ledger = stage(cleaning.ledger(audited, rule_list, "taxi_type"), "ledger")
    reports.write_report(ledger, layout.path("reports", "cleaning_ledger"), "csv")
    reports.write_report(
        cleaning.ledger_over_datasets(ledger), layout.path("reports", "cleaning_ledger_all"), "csv"
    )
    reports.write_report(
        cleaning.row_summary(audited), layout.path("reports", "cleaning_summary"), "csv"
    )
    return ledger


def profile_raw(spark: SparkSession, layout: Layout, kind: str) -> dict[str, DataFrame]:
    """Quality profiles of one kind before cleaning; nothing is removed."""
    df = cleaning.unify(load_raw(spark, layout, kind), kind)
    coded = {n: r.valid_codes for n, r in rules.field_rules(kind).items() if r.valid_codes}
    numbers = ["passenger_count", "trip_distance", "trip_duration_minutes", "fare_amount", "total_amount"]
    return {
        "missingness": profile.missingness(df, S.CLEAN.names),
        "numeric": profile.numeric_profile(df, numbers),
        "codes": profile.code_distribution(df, coded),
        "places": profile.place_validity(df, ["pu_location_id", "do_location_id"]),
        "period": profile.period_profile(df, "pickup_datetime", *layout.period),
        "temporal": profile.temporal_profile(df),
    }


def process(
    spark: SparkSession,
    layout: Layout,
    zones: DataFrame,
    weather: DataFrame,
    events: DataFrame,
    holidays: DataFrame,
) -> DataFrame:
    """Clean to processed: cells, zeros, rolling baseline, side tables. Returns what was written.

    ``weather`` is hourly (``pickup_hour``), ``events`` placed intervals, ``holidays`` one row a date.
    """
    records = grid.narrow(load_clean(spark, layout))
    cells = stage(grid.to_cells(records), "cells")
    dense = grid.dense_grid(dimensions.real_places(zones), list(layout.kinds), *layout.period)
    based = baseline.add_rolling_baseline(
        grid.zero_fill(dense, cells),
        dimensions.place_groups(zones),
        layout.train_end,
        layout.window_weeks,
    )
    running = stage(externals.interval_cells(externals.clean_events(events)), "event-cells")
    tables.write_processed(
        externals.enrich(based, weather, running, holidays), layout.path("processed")
    )
    written = load_processed(spark, layout)
    for name, report in {
        "processed_summary": grid.grid_summary(written),
        "baseline_sources": baseline.source_mix(written),
        "join_coverage": externals.join_coverage(written),
    }.items():
        reports.write_report(report, layout.path("reports", name))
    return written


def domains_for(zones: DataFrame, kinds: tuple[str, ...]) -> features.Domains:
    return features.Domains(taxi_type=kinds, borough=tuple(dimensions.group_domain(zones)))


def fit_all(
    spark: SparkSession,
    layout: Layout,
    zones: DataFrame,
    registry: dict[str, models.ModelSpec] | None = None,
) -> dict[str, object]:
    """Fit and save every registered model; one stored training table per feature set."""
    registry = registry or models.REGISTRY
    domains = domains_for(zones, layout.kinds)
    train, _ = features.split_train_test(load_processed(spark, layout), layout.train_end)
    periods = models.Periods(layout.validation_start, layout.train_end)
    stored: dict[str, DataFrame] = {}
    fitted = {}
    for name, spec in registry.items():
        if spec.feature_set not in stored:
            table = features.feature_table(train, spec.feature_set, domains, dimensions.place_groups(zones))
            stored[spec.feature_set] = stage(table, f"train-{spec.feature_set}")
        fitted[name] = spec.fit(stored[spec.feature_set], features.feature_columns(spec.feature_set, domains), periods)
        models.save_model(fitted[name], layout.path("models", name))
    return fitted


def evaluate(
    spark: SparkSession, layout: Layout, zones: DataFrame, fitted: dict[str, object]
) -> dict[str, DataFrame]:
    """Score the test period: errors, errors by weather, top-k, ratio classes."""
    processed = load_processed(spark, layout)
    train, test = features.split_train_test(processed, layout.train_end)
    frame = stage(
        models.evaluation_frame(
            test, fitted, domains_for(zones, layout.kinds), dimensions.place_groups(zones)
        ),
        "evaluation",
    )
    predicted = {name: f"pred_{name}" for name in fitted}
    by_weather = metrics.regression_metrics(frame, "actual", predicted, by="weather_severity")
    out = {
        "frame": frame,
        "metrics": metrics.regression_metrics(frame, "actual", predicted),
        "metrics_by_weather": by_weather,
        "mae_ratio": metrics.mae_ratio(by_weather, "weather_severity", "severe", "normal"),
        "topk": topk.overlap(frame, topk.LIST_SIZES, "actual", predicted, features.ROW_KEY).unionByName(
            topk.random_overlap(frame, topk.LIST_SIZES)
        ),
    }
    levels = dtdi.group_thresholds(train)
    rated = dtdi.with_ratio(frame, "actual", output="dtdi_actual")
    for name, column in predicted.items():
        rated = dtdi.with_ratio(rated, column, output=f"dtdi_{name}")
    judged = dtdi.resolve_thresholds(rated, levels)
    limits = (F.col("p_low"), F.col("p_high"))
    judged = judged.withColumn("class_actual", dtdi.classify_by_group(F.col("dtdi_actual"), *limits))
    for name in predicted:
        judged = judged.withColumn(
            f"class_{name}", dtdi.classify_by_group(F.col(f"dtdi_{name}"), *limits)
        )
        out[f"classes_{name}"] = dtdi.classification_report(judged, "class_actual", f"class_{name}")
    sure = dtdi.reliable(rated)
    out["ratio_by_weather"] = dtdi.by_severity(sure, "dtdi_actual")
    out["compression"] = dtdi.compression(sure, "dtdi_actual", {n: f"dtdi_{n}" for n in predicted})
    return out
