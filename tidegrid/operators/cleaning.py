"""Audited cleaning: ordered removal rules, exact ledger, deduplication, extreme-value flags.

The whole audit is one table. Every record carries the first rule it breaks. Records that break a
rule are folded into one row per rule before the shuffle; the others are grouped by the duplicate
keys with a count of copies. Clean rows and ledger are two reads of that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import duration_minutes, outlier_multiplier, percent, unknown_is_false
from ..session import fits_broadcast, stage
from ..sources import schemas as S
from .percentiles import column_summaries
from .rules import Rule

DUPLICATE_RULE = "exact duplicate record"
DUPLICATE_REASON = "same values in every key column as a record that is kept"
_AUDIT = ["_rule", "_copies", "_removed_by"]


def unify(raw: DataFrame, kind: str) -> DataFrame:
    """Raw layout of one kind to the shared clean layout, provenance kept."""
    names = {**{c: c for c in raw.columns}, **S.CLEAN_RENAMES[kind]}
    renamed = raw.withColumnsRenamed(names)
    derived = {
        "taxi_type": F.lit(kind),
        "trip_duration_minutes": duration_minutes("pickup_datetime", "dropoff_datetime"),
    }
    out = []
    for f in [*S.CLEAN.fields, *S.PROVENANCE.fields]:
        column = derived.get(f.name)
        if column is None:
            column = F.col(f.name) if f.name in renamed.columns else F.lit(None)
        out.append(column.cast(f.dataType).alias(f.name))
    return renamed.select(*out)


def _first_broken(rules: list[tuple[int, Rule]]):
    out = F.lit(None).cast("int")
    for ordinal, rule in reversed(rules):
        out = F.when(unknown_is_false(rule.condition), F.lit(ordinal)).otherwise(out)
    return out


def _keep_one(df: DataFrame, group: list[str], rest: list[str]) -> DataFrame:
    """One row per group with the copy count; the smallest ``rest`` (in order) survives."""
    aggregates = [F.count(F.lit(1)).alias("_copies")]
    if rest:
        aggregates.append(F.min(F.struct(*rest)).alias("_keep"))
    out = df.groupBy(*group).agg(*aggregates)
    return out.select(*group, "_copies", *([F.col("_keep.*")] if rest else []))


def repeated_hashes(df: DataFrame, keys: list[str]) -> DataFrame:
    """64-bit hashes of key tuples seen more than once: the only shuffle is 8 bytes per row."""
    return (
        df.groupBy(F.xxhash64(*keys).alias("_h"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_h")
    )


def keep_first(
    df: DataFrame,
    keys: list[str],
    order_by: list[str] | None = None,
    by: list[str] | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """``df`` without duplicates of ``keys`` (NULLs equal), plus ``_copies`` per kept row.

    The survivor is the smallest in ``order_by``, then in the remaining columns, so reruns agree.
    Given ``repeated`` (distinct ``_h`` of :func:`repeated_hashes` over ``by`` and ``keys``, stored so
    that the planner knows its size), only rows with such a hash go through the wide grouping and all
    others stay where they are. A hash collision merely sends a row through the exact grouping. If more hashes repeat
    than a broadcast holds, marking the rows would shuffle them whole as well, so all go through the grouping at once.
    """
    group = _group(keys, by)
    rest = [*(order_by or []), *[c for c in df.columns if c not in group and c not in (order_by or [])]]
    columns = [*df.columns, "_copies"]
    if repeated is None or not fits_broadcast(repeated):
        return _keep_one(df, group, rest).select(*columns)
    marked = df.withColumn("_h", F.xxhash64(*group)).join(
        F.broadcast(repeated.withColumn("_twice", F.lit(True))), "_h", "left"
    )
    single = marked.where(F.col("_twice").isNull()).withColumn("_copies", F.lit(1).cast("long"))
    suspects = marked.where(F.col("_twice").isNotNull()).select(*df.columns)
    return single.select(*columns).unionByName(_keep_one(suspects, group, rest).select(*columns))


def _group(keys: list[str], by: list[str] | None) -> list[str]:
    return [*(by or []), *[k for k in keys if k not in (by or [])]]


def audit(
    df: DataFrame,
    rules: list[Rule],
    keys: list[str] | None = None,
    order_by: list[str] | None = None,
    by: list[str] | None = None,
    prefilter: bool = False,
) -> DataFrame:
    """Audit table: columns of ``df`` plus ``_rule``, ``_copies`` and ``_removed_by``.

    Rules before deduplication get ordinals from 1, deduplication the next, later rules the rest.
    ``_removed_by`` is NULL for clean rows. Rows folded per rule have NULL business columns.

    The plain form is one scan and one shuffle of whole records. With ``prefilter`` the live records are
    stored once, so ``df`` is worked out once; a scan of them counts broken records and key hashes in a shuffle of
    8 bytes a record. While the repeated hashes fit a broadcast, only records with such a hash are shuffled whole;
    beyond that all live records are, once, as in the plain form. Where only numbers are wanted,
    :func:`audit_counts` moves no whole records.
    """
    by = by or []
    before = list(enumerate([r for r in rules if not r.after_dedup], 1))
    after = list(enumerate([r for r in rules if r.after_dedup], len(before) + 2))
    tagged = df.withColumn("_rule", _first_broken(before))
    keys = keys or list(df.columns)
    live = F.col("_rule").isNull()
    if prefilter:
        records = stage(tagged.select("_rule", *[c if c in by else F.when(live, F.col(c)).alias(c) for c in df.columns]), "records")
        counted = stage(
            records.groupBy("_rule", *by, F.when(live, F.xxhash64(*_group(keys, by))).alias("_h"))
            .agg(F.count(F.lit(1)).alias("_copies"))
            .where(~live | (F.col("_copies") > 1)),
            "broken-and-repeated",
        )
        kept = keep_first(
            records.where(live).drop("_rule"), keys, order_by, by, counted.where(live).select("_h").distinct()
        )
        grouped = kept.withColumn("_rule", F.lit(None).cast("int")).unionByName(
            counted.where(~live).drop("_h"), allowMissingColumns=True
        )
    else:
        folded = tagged.select(
            "_rule", *by, *[F.when(live, F.col(c)).alias(c) for c in df.columns if c not in by]
        )
        group = _group(keys, by)
        ordered = order_by or []
        grouped = _keep_one(
            folded,
            ["_rule", *group],
            [*ordered, *[c for c in df.columns if c not in group and c not in ordered]],
        )
    removed_by = F.coalesce(F.col("_rule"), _first_broken(after))
    return grouped.withColumn("_removed_by", removed_by).select(*df.columns, *_AUDIT)


def audit_counts(
    df: DataFrame,
    rules: list[Rule],
    keys: list[str] | None = None,
    by: list[str] | None = None,
    prefilter: bool = False,
) -> DataFrame:
    """The audit in numbers: ``by``, ``_rule``, ``_removed_by``, ``_copies`` (records) and ``_groups`` (without copies).

    Feeds :func:`ledger`, :func:`row_summary` and :func:`duplicate_profile` like an audit table, and is a few
    rows whatever the table. Nothing but counts goes with the keys, so every step is a hash aggregate.
    The plain form shuffles the keys of each distinct record. With ``prefilter`` a first scan shuffles 8 bytes
    a record, and only records whose hash repeats are grouped by their keys; a hash collision costs time, never
    correctness. Rules after deduplication must tell the same of all copies, as they do when they look at keys
    only; otherwise the survivor decides, this raises, and :func:`audit` is the way.
    """
    by = by or []
    before = list(enumerate([r for r in rules if not r.after_dedup], 1))
    after = list(enumerate([r for r in rules if r.after_dedup], len(before) + 2))
    group = _group(keys or list(df.columns), by)
    live = F.col("_rule").isNull()
    tagged = df.withColumn("_rule", _first_broken(before)).withColumn(
        "_after", F.when(live, F.coalesce(_first_broken(after), F.lit(0)))
    )
    if not prefilter:
        return _numbers(_counted(tagged, group, by), by)

    counted = stage(
        tagged.select("_rule", "_after", *by, F.when(live, F.xxhash64(*group)).alias("_h"))
        .groupBy("_rule", *by, "_h")
        .agg(F.count(F.lit(1)).alias("_copies"), F.min("_after").alias("_after"))
        .withColumn("_h", F.when(F.col("_copies") > 1, F.col("_h")))
        .groupBy("_rule", *by, "_h", F.when(F.col("_h").isNull(), F.col("_after")).alias("_after"))
        .agg(F.sum("_copies").alias("_copies"), F.count(F.lit(1)).alias("_groups")),
        "audit-hashes",
    )
    settled = counted.where(F.col("_h").isNull()).withColumn("_least", F.col("_after")).withColumnRenamed("_after", "_most")
    repeated = counted.where(F.col("_h").isNotNull()).select("_h").distinct()
    suspects = tagged.where(live).withColumn("_h", F.xxhash64(*group)).join(repeated, "_h", "left_semi")
    columns = ["_rule", *by, "_copies", "_groups", "_least", "_most"]
    return _numbers(settled.select(*columns).unionByName(_counted(suspects, group, by).select(*columns)), by)


def _counted(tagged: DataFrame, group: list[str], by: list[str]) -> DataFrame:
    """Copies per key of live records and per rule of broken ones."""
    live = F.col("_rule").isNull()
    folded = tagged.select("_rule", "_after", *by, *[F.when(live, F.col(c)).alias(c) for c in group if c not in by])
    return (
        folded.groupBy("_rule", *group)
        .agg(F.count(F.lit(1)).alias("_copies"), F.min("_after").alias("_least"), F.max("_after").alias("_most"))
        .withColumn("_groups", F.lit(1).cast("long"))
    )


def _numbers(counted: DataFrame, by: list[str]) -> DataFrame:
    apart = F.raise_error(F.lit("a rule after deduplication tells copies of one record apart")).cast("int")
    ruled = F.when(F.col("_least") == F.col("_most"), F.nullif(F.col("_least"), F.lit(0))).otherwise(apart)
    return (
        counted.withColumn("_removed_by", F.when(F.col("_rule").isNotNull(), F.col("_rule")).otherwise(ruled))
        .groupBy("_rule", *by, "_removed_by")
        .agg(F.sum("_copies").alias("_copies"), F.sum("_groups").alias("_groups"))
        .select(*by, "_rule", "_removed_by", "_copies", "_groups")
    )


def _records(audited: DataFrame):
    """Records without copies that a row of an audit stands for."""
    return F.col("_groups") if "_groups" in audited.columns else F.lit(1).cast("long")


def clean_rows(audited: DataFrame) -> DataFrame:
    return audited.where(F.col("_removed_by").isNull()).drop(*_AUDIT)


def _named_rules(rules: list[Rule]) -> list[tuple[int, str, str, str]]:
    before = [r for r in rules if not r.after_dedup]
    after = [r for r in rules if r.after_dedup]
    named = [(r.stage, r.name, r.reason) for r in before]
    named.append(("invalid", DUPLICATE_RULE, DUPLICATE_REASON))
    named += [(r.stage, r.name, r.reason) for r in after]
    return [(i, *n) for i, n in enumerate(named, 1)]


def ledger(audited: DataFrame, rules: list[Rule], dataset: str | None = None) -> DataFrame:
    """One row per rule (and dataset) with the exact number of records it removed.

    ``audited`` comes from :func:`audit` or :func:`audit_counts`. ``dataset`` names the column that tells the datasets apart.
    """
    named = _named_rules(rules)
    duplicate = len([r for r in rules if not r.after_dedup]) + 1
    live = F.col("_rule").isNull()

    def removed(ordinal: int):
        if ordinal < duplicate:
            return F.sum(F.when(F.col("_rule") == ordinal, F.col("_copies")).otherwise(0))
        if ordinal == duplicate:
            return F.sum(F.when(live, F.col("_copies") - _records(audited)).otherwise(0))
        return F.sum(F.when(live & (F.col("_removed_by") == ordinal), _records(audited)).otherwise(0))

    key = [F.col(dataset).alias("dataset")] if dataset else [F.lit("all").alias("dataset")]
    counted = audited.groupBy(*key).agg(
        F.sum("_copies").alias("_original"),
        *[F.coalesce(removed(i), F.lit(0)).cast("long").alias(f"_r{i}") for i, *_ in named],
    )
    return counted.select(
        "dataset",
        "_original",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("ordinal"),
                        F.lit(stage_).alias("stage"),
                        F.lit(name).alias("rule"),
                        F.lit(reason).alias("reason"),
                        F.col(f"_r{i}").alias("records_removed"),
                    )
                    for i, stage_, name, reason in named
                ]
            )
        ),
    ).select(
        "ordinal",
        "stage",
        "dataset",
        "rule",
        "reason",
        "records_removed",
        percent(F.col("records_removed"), F.col("_original")).alias("pct_of_original"),
        F.col("_original").alias("original_count"),
    )


def ledger_over_datasets(ledgers: DataFrame) -> DataFrame:
    """Ledgers of several datasets summed rule by rule, as a share of all their records."""
    return (
        ledgers.groupBy("ordinal", "stage", "rule", "reason")
        .agg(
            F.sum("records_removed").alias("records_removed"),
            F.sum("original_count").alias("original_count"),
        )
        .withColumn(
            "pct_of_combined_raw", percent(F.col("records_removed"), F.col("original_count"))
        )
    )


def row_summary(audited: DataFrame, dataset: str = "taxi_type") -> DataFrame:
    """Raw and clean row counts per dataset and for all of them together."""
    return (
        audited.rollup(dataset)
        .agg(
            F.sum("_copies").alias("raw_row_count"),
            F.sum(F.when(F.col("_removed_by").isNull(), _records(audited)).otherwise(0)).alias("clean_row_count"),
        )
        .select(
            F.coalesce(F.col(dataset), F.lit("combined")).alias(dataset),
            "raw_row_count",
            "clean_row_count",
            (F.col("raw_row_count") - F.col("clean_row_count")).alias("rows_removed"),
            percent(
                F.col("raw_row_count") - F.col("clean_row_count"), F.col("raw_row_count")
            ).alias("pct_removed"),
        )
    )


def duplicate_profile(audited: DataFrame) -> DataFrame:
    """Rows that reached deduplication, distinct rows among them, and the extra copies."""
    live = audited.where(F.col("_rule").isNull())
    return live.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(_records(audited)), F.lit(0)).alias("distinct_rows"),
    ).select(
        "total_rows",
        "distinct_rows",
        (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_extra_rows"),
        percent(F.col("total_rows") - F.col("distinct_rows"), F.col("total_rows")).alias("pct_duplicate"),
    )


def extreme_thresholds(
    df: DataFrame, columns: list[str], by: str = "taxi_type", accuracy: int | None = None
) -> DataFrame:
    """Per ``by``: Q3 + k * IQR of each column, k from the row count of the group.

    Exact by default, in two reads; with ``accuracy`` a mergeable sketch gives the quartiles in one.
    """
    if accuracy:
        found = column_summaries(df, columns, [0.25, 0.75], [by], accuracy, exact=False)
    else:
        found = column_summaries(df, columns, [0.25, 0.75], [by])
    q1, q3 = F.col("percentiles")[0], F.col("percentiles")[1]
    limit = q3 + outlier_multiplier(F.col("n_rows")) * (q3 - q1)
    return found.groupBy(by, "n_rows").agg(
        *[F.max(F.when(F.col("column_name") == c, limit)).alias(f"{c}_threshold") for c in columns]
    )


def flag_extremes(df: DataFrame, thresholds: DataFrame, columns: list[str], by: str = "taxi_type") -> DataFrame:
    """Flag, never drop: true above the threshold of the row's group, false when unknown."""
    joined = df.join(stage(thresholds.drop("n_rows"), "extreme-thresholds"), by, "left")
    return joined.select(
        *df.columns,
        *[
            unknown_is_false(F.col(c) > F.col(f"{c}_threshold")).alias(f"is_extreme_{name}")
            for c, name in zip(columns, _flag_names(columns))
        ],
    )


def _flag_names(columns: list[str]) -> list[str]:
    return ["trip_duration" if c == "trip_duration_minutes" else c for c in columns]
