"""Audited cleaning and data-quality profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, profile, rules
from ..session import stage
from ..sources import landing
from ..sources import schemas as S
from . import tables as t
from .registry import query

KEYS = ["order_key", "vendor_id"]
ORDER = ["part_key", "supp_key", "dropoff_datetime", "trip_distance", "total_amount"]
MEASURED = ["trip_distance", "trip_duration_minutes"]


def trip_rules():
    return rules.trip_rules(t.TRIP_PLACES, t.TRIP_PERIOD, t.TRIP_MAX_MINUTES)


def audited(spark, sf_dir, prefilter: bool = False):
    """The audit table. A quarter of these records are copies, so the plain form suits them."""
    return cleaning.audit(
        t.trips(spark, sf_dir), trip_rules(), KEYS, ORDER, by=["taxi_type"], prefilter=prefilter
    )


def audit_numbers(spark, sf_dir):
    """What the reports need of the audit, without its records."""
    return cleaning.audit_counts(t.trips(spark, sf_dir), trip_rules(), KEYS, by=["taxi_type"])


_RULE_ROWS = [
    (1, "essential_missing"), (2, "essential_missing"), *[(i, "invalid") for i in range(3, 10)],
    (10, "study_period"),
]
_RULES_SQL = ",\nrules AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{s}')" for i, s in _RULE_ROWS
) + ") r(ordinal, stage))"


@query(
    f"""WITH {t.AUDIT_SQL}{_RULES_SQL},
totals AS (SELECT taxi_type AS dataset, count(*) AS n FROM trips GROUP BY 1),
removed AS (SELECT taxi_type AS dataset, removed_by AS ordinal, count(*) AS c FROM audited GROUP BY 1, 2)
SELECT ordinal, stage, dataset, coalesce(c, 0) AS records_removed,
  round(100.0 * coalesce(c, 0) / n, 4) AS pct_of_original
FROM rules CROSS JOIN totals LEFT JOIN removed USING (dataset, ordinal)"""
)
def cleaning_ledger(spark, sf_dir):
    return cleaning.ledger(audit_numbers(spark, sf_dir), trip_rules(), "taxi_type").select(
        "ordinal", "stage", "dataset", "records_removed", "pct_of_original"
    )


CLEAN_COLUMNS = [
    "taxi_type", "order_key", "vendor_id", "part_key", "supp_key", "passenger_count", "trip_distance",
    "ratecode_id", "store_and_fwd_flag", "pu_location_id", "do_location_id", "fare_amount", "extra",
    "tip_amount", "total_amount", "trip_duration_minutes",
]


@query(
    f"""WITH {t.AUDIT_SQL}
SELECT {', '.join(CLEAN_COLUMNS)}, {t.text_sql('pickup_datetime')}, {t.text_sql('dropoff_datetime')}
FROM clean"""
)
def clean_rows(spark, sf_dir):
    return cleaning.clean_rows(audited(spark, sf_dir, prefilter=True)).select(
        *CLEAN_COLUMNS, t.text("pickup_datetime"), t.text("dropoff_datetime")
    )


@query(
    f"""WITH {t.AUDIT_SQL}{_RULES_SQL},
removed AS (SELECT removed_by AS ordinal, count(*) AS c FROM audited GROUP BY 1)
SELECT ordinal, stage, coalesce(c, 0) AS records_removed,
  round(100.0 * coalesce(c, 0) / (SELECT count(*) FROM trips), 4) AS pct_of_combined_raw
FROM rules LEFT JOIN removed USING (ordinal)"""
)
def ledger_rollup(spark, sf_dir):
    ledger = cleaning.ledger(audit_numbers(spark, sf_dir), trip_rules(), "taxi_type")
    return cleaning.ledger_over_datasets(ledger).select(
        "ordinal", "stage", "records_removed", "pct_of_combined_raw"
    )


@query(
    f"""WITH {t.AUDIT_SQL}
SELECT coalesce(taxi_type, 'combined') AS taxi_type, count(*) AS raw_row_count,
  count(*) FILTER (WHERE removed_by IS NULL) AS clean_row_count,
  count(*) FILTER (WHERE removed_by IS NOT NULL) AS rows_removed,
  round(100.0 * count(*) FILTER (WHERE removed_by IS NOT NULL) / count(*), 4) AS pct_removed
FROM audited GROUP BY ROLLUP (taxi_type)"""
)
def row_count_rollup(spark, sf_dir):
    return cleaning.row_summary(audit_numbers(spark, sf_dir))


@query(
    f"""WITH {t.AUDIT_SQL}
SELECT count(*) AS total_rows, count(*) FILTER (WHERE rn = 1) AS distinct_rows,
  count(*) FILTER (WHERE rn > 1) AS duplicate_extra_rows,
  round(100.0 * count(*) FILTER (WHERE rn > 1) / count(*), 4) AS pct_duplicate
FROM audited WHERE first_rule IS NULL"""
)
def dedup_profile(spark, sf_dir):
    return cleaning.duplicate_profile(audit_numbers(spark, sf_dir))


@query(
    f"""WITH {t.AUDIT_SQL},
limits AS (
  SELECT taxi_type, count(*) AS n,
    quantile_cont(trip_distance, 0.25) AS d1, quantile_cont(trip_distance, 0.75) AS d3,
    quantile_cont(trip_duration_minutes, 0.25) AS m1, quantile_cont(trip_duration_minutes, 0.75) AS m3
  FROM clean GROUP BY 1
),
scaled AS (SELECT *, CASE WHEN n <= 100 THEN 1.5 ELSE sqrt(ln(n)) - 0.5 END AS k FROM limits)
SELECT order_key, vendor_id, taxi_type,
  coalesce(trip_distance > d3 + k * (d3 - d1), false) AS is_extreme_trip_distance,
  coalesce(trip_duration_minutes > m3 + k * (m3 - m1), false) AS is_extreme_trip_duration
FROM clean JOIN scaled USING (taxi_type)"""
)
def extreme_flags(spark, sf_dir):
    kept = cleaning.clean_rows(stage(audited(spark, sf_dir), "audit"))
    flagged = cleaning.flag_extremes(kept, cleaning.extreme_thresholds(kept, MEASURED), MEASURED)
    return flagged.select(
        "order_key", "vendor_id", "taxi_type", "is_extreme_trip_distance", "is_extreme_trip_duration"
    )


@query(
    f"""WITH {t.TRIPS_SQL},
limits AS (
  SELECT taxi_type, count(*) AS n,
    quantile_cont(fare_amount, 0.25) AS f1, quantile_cont(fare_amount, 0.75) AS f3
  FROM trips GROUP BY 1
)
SELECT taxi_type, n AS n_rows,
  {t.rnd_sql('f3 + (CASE WHEN n <= 100 THEN 1.5 ELSE sqrt(ln(n)) - 0.5 END) * (f3 - f1)', 4)} AS fare_amount_threshold
FROM limits"""
)
def extreme_thresholds(spark, sf_dir):
    out = cleaning.extreme_thresholds(t.trips(spark, sf_dir), ["fare_amount"])
    return out.select(
        "taxi_type", "n_rows", t.rnd("fare_amount_threshold", 4).alias("fare_amount_threshold")
    )


# --- profiles ---------------------------------------------------------------------------------------

NULLABLE = ["ratecode_id", "pu_location_id", "do_location_id", "trip_distance"]


@query(
    f"WITH {t.TRIPS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 4) AS pct_null FROM trips"
        for c in NULLABLE
    )
)
def null_profile(spark, sf_dir):
    return profile.missingness(t.trips(spark, sf_dir), NULLABLE)


@query(
    f"WITH {t.TRIPS_SQL}\nSELECT taxi_type, count(*) AS row_count, 4 AS column_count, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in NULLABLE)
    + " FROM trips GROUP BY 1"
)
def table_profile(spark, sf_dir):
    return landing.profile_table(t.trips(spark, sf_dir), ["taxi_type"], NULLABLE)


NUMBERS = ["passenger_count", "trip_distance", "trip_duration_minutes", "fare_amount", "total_amount"]


@query(
    f"WITH {t.TRIPS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, {t.rnd_sql(f'min({c})')} AS min, "
        + ", ".join(
            f"{t.rnd_sql(f'quantile_cont({c}, {p})')} AS {n}"
            for n, p in profile.PROFILE_PERCENTILES.items()
        )
        + f", {t.rnd_sql(f'max({c})')} AS max FROM trips"
        for c in NUMBERS
    )
)
def numeric_profile(spark, sf_dir):
    out = profile.numeric_profile(t.trips(spark, sf_dir), NUMBERS)
    measures = ["min", *profile.PROFILE_PERCENTILES, "max"]
    return out.select("column_name", "count", *[t.rnd(m).alias(m) for m in measures])


@query(
    f"WITH {t.TRIPS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, {t.rnd_sql(f'avg({c})', 4)} AS mean, "
        f"{t.rnd_sql(f'stddev_samp({c})', 4)} AS stddev, {t.rnd_sql(f'min({c})', 4)} AS min, "
        f"{t.rnd_sql(f'quantile_cont({c}, 0.25)', 4)} AS p25, {t.rnd_sql(f'quantile_cont({c}, 0.5)', 4)} AS p50, "
        f"{t.rnd_sql(f'quantile_cont({c}, 0.75)', 4)} AS p75, {t.rnd_sql(f'max({c})', 4)} AS max FROM trips"
        for c in ("trip_distance", "fare_amount")
    )
)
def summary_statistics(spark, sf_dir):
    out = profile.summary_statistics(t.trips(spark, sf_dir), ["trip_distance", "fare_amount"])
    return out.select(
        "column_name", "count",
        *[t.rnd(m, 4).alias(m) for m in ("mean", "stddev", "min", "p25", "p50", "p75", "max")],
    )


CODES = {"vendor_id": (1, 2, 6), "ratecode_id": S.RATECODE_CODES, "store_and_fwd_flag": ("A", "N")}


@query(
    f"WITH {t.TRIPS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS record_count, "
        f"{c} IS NOT NULL AND {c} NOT IN {codes} AS is_unexpected FROM trips GROUP BY {c}"
        for c, codes in CODES.items()
    )
)
def code_profile(spark, sf_dir):
    return profile.code_distribution(t.trips(spark, sf_dir), CODES)


@query(
    f"WITH {t.TRIPS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"count(*) FILTER (WHERE {c} < 1 OR {c} > 23) AS out_of_range_count, "
        f"count(*) FILTER (WHERE {c} IN (22, 23)) AS placeholder_count, "
        f"round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 4) AS pct_null, "
        f"round(100.0 * count(*) FILTER (WHERE {c} < 1 OR {c} > 23) / count(*), 4) AS pct_out_of_range FROM trips"
        for c in ("pu_location_id", "do_location_id")
    )
)
def range_profile(spark, sf_dir):
    return profile.place_validity(
        t.trips(spark, sf_dir), ["pu_location_id", "do_location_id"], t.TRIP_PLACES, (22, 23)
    )


@query(
    f"""WITH {t.TRIPS_SQL}
SELECT {t.text_sql('min(pickup_datetime)', 'earliest')}, {t.text_sql('max(pickup_datetime)', 'latest')},
  count(*) FILTER (WHERE pickup_datetime < TIMESTAMP '{t.TRIP_PERIOD[0]}'
    OR pickup_datetime >= TIMESTAMP '{t.TRIP_PERIOD[1]}') AS records_outside_study_period,
  round(100.0 * count(*) FILTER (WHERE pickup_datetime < TIMESTAMP '{t.TRIP_PERIOD[0]}'
    OR pickup_datetime >= TIMESTAMP '{t.TRIP_PERIOD[1]}') / count(*), 4) AS pct_outside_study_period
FROM trips"""
)
def period_profile(spark, sf_dir):
    out = profile.period_profile(t.trips(spark, sf_dir), "pickup_datetime", *t.TRIP_PERIOD)
    return out.withColumns({c: t.text(c) for c in ("earliest", "latest")})


@query(
    f"""WITH {t.TRIPS_SQL}
SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL) AS rows_with_both_timestamps,
  count(*) FILTER (WHERE pickup_datetime IS NULL OR dropoff_datetime IS NULL) AS rows_missing_a_timestamp,
  count(*) FILTER (WHERE dropoff_datetime < pickup_datetime) AS negative_duration,
  count(*) FILTER (WHERE trip_duration_minutes = 0) AS zero_duration,
  count(*) FILTER (WHERE trip_duration_minutes > 180) AS duration_over_3h,
  count(*) FILTER (WHERE trip_duration_minutes > 1440) AS duration_over_24h
FROM trips"""
)
def temporal_profile(spark, sf_dir):
    return profile.temporal_profile(t.trips(spark, sf_dir))


CHECK_NAMES = {
    "VendorID": "vendor_id", "RatecodeID": "ratecode_id", "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id", "mta_tax": "tip_amount", "tolls_amount": "extra",
    "improvement_surcharge": "extra", "congestion_surcharge": "fare_amount", "Airport_fee": "fare_amount",
}
_CHECKS_SQL = {
    "vendor code": "vendor_id NOT IN (1, 2, 6, 7)",
    "rate code": "ratecode_id NOT IN (1, 2, 3, 4, 5, 6, 99)",
    "payment code": "payment_type NOT IN (0, 1, 2, 3, 4, 5, 6)",
    "store flag": "store_and_fwd_flag NOT IN ('Y', 'N')",
    "no passengers": "passenger_count <= 0",
    "over 6 passengers": "passenger_count > 6",
    "distance not positive": "trip_distance <= 0",
    "distance over 100": "trip_distance > 100",
    "fare_amount negative": "fare_amount < 0",
    "extra negative": "extra < 0",
    "mta_tax negative": "tip_amount < 0",
    "tip_amount negative": "tip_amount < 0",
    "tolls_amount negative": "extra < 0",
    "improvement_surcharge negative": "extra < 0",
    "total_amount negative": "total_amount < 0",
    "congestion_surcharge negative": "fare_amount < 0",
    "Airport_fee negative": "fare_amount < 0",
    "pickup place": "pu_location_id < 1 OR pu_location_id > 265",
    "dropoff place": "do_location_id < 1 OR do_location_id > 265",
    "dropoff before pickup": "dropoff_datetime < pickup_datetime",
    "no duration": "trip_duration_minutes = 0",
    "over 24 hours": "trip_duration_minutes > 1440",
    "other month": "year(pickup_datetime) != 1998 OR month(pickup_datetime) != 3",
}


@query(
    f"WITH {t.TRIPS_SQL}\n"
    + " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, count(*) FILTER (WHERE {c}) AS record_count, "
        f"round(100.0 * count(*) FILTER (WHERE {c}) / count(*), 4) AS pct_of_rows FROM trips"
        for n, c in _CHECKS_SQL.items()
    )
)
def business_checks(spark, sf_dir):
    checks = rules.landing_checks("pickup_datetime", "dropoff_datetime", 1998, 3, CHECK_NAMES)
    return rules.count_findings(t.trips(spark, sf_dir), checks)


@query(
    f"""WITH {t.TRIPS_SQL}
SELECT 'vendor_id unexpected_code' AS check_name, count(*) FILTER (WHERE vendor_id NOT IN (1, 2, 6, 7)) AS record_count FROM trips
UNION ALL SELECT 'pickup_datetime missing', count(*) FILTER (WHERE pickup_datetime IS NULL) FROM trips
UNION ALL SELECT 'passenger_count negative', count(*) FILTER (WHERE passenger_count < 0) FROM trips
UNION ALL SELECT 'trip_distance negative', count(*) FILTER (WHERE trip_distance < 0) FROM trips
UNION ALL SELECT 'ratecode_id unexpected_code', count(*) FILTER (WHERE ratecode_id NOT IN (1, 2, 3, 4, 5, 6, 99)) FROM trips
UNION ALL SELECT 'store_and_fwd_flag unexpected_code', count(*) FILTER (WHERE store_and_fwd_flag NOT IN ('Y', 'N')) FROM trips
UNION ALL SELECT 'pu_location_id missing', count(*) FILTER (WHERE pu_location_id IS NULL) FROM trips
UNION ALL SELECT 'pu_location_id zero', count(*) FILTER (WHERE pu_location_id = 0) FROM trips
UNION ALL SELECT 'pu_location_id negative', count(*) FILTER (WHERE pu_location_id < 0) FROM trips
UNION ALL SELECT 'do_location_id zero', count(*) FILTER (WHERE do_location_id = 0) FROM trips
UNION ALL SELECT 'do_location_id negative', count(*) FILTER (WHERE do_location_id < 0) FROM trips
UNION ALL SELECT 'payment_type unexpected_code', count(*) FILTER (WHERE payment_type NOT IN (0, 1, 2, 3, 4, 5, 6)) FROM trips"""
)
def field_findings(spark, sf_dir):
    df = t.trips(spark, sf_dir)
    checks = {
        f"{field} {finding}": condition
        for field, rule in rules.field_rules("yellow").items()
        if field in df.columns
        for finding, condition in rule.findings().items()
    }
    return rules.count_findings(df, checks).select("check_name", "record_count")


@query(
    """WITH l AS (SELECT column_name, data_type FROM information_schema.columns WHERE table_name = 'lineitem'),
o AS (SELECT column_name, data_type FROM information_schema.columns WHERE table_name = 'orders'),
ln AS (SELECT replace(column_name, 'l_', '') AS column_name,
         CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
           WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS left_type FROM l),
rn AS (SELECT replace(column_name, 'o_', '') AS column_name,
         CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
           WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS right_type FROM o)
SELECT column_name, left_type, right_type,
  CASE WHEN right_type IS NULL THEN 'only_left' WHEN left_type IS NULL THEN 'only_right' ELSE 'type_mismatch' END AS difference
FROM ln FULL JOIN rn USING (column_name) WHERE left_type IS DISTINCT FROM right_type"""
)
def schema_diff(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    listing = profile.schema_table(
        spark,
        {
            "left": lines.withColumnsRenamed({c: c.replace("l_", "") for c in lines.columns}).schema,
            "right": orders.withColumnsRenamed({c: c.replace("o_", "") for c in orders.columns}).schema,
        },
    )
    return profile.schema_diff(listing, "left", "right")


UNION_COLUMNS = [
    "taxi_type", "vendor_id", "passenger_count", "trip_distance", "trip_type", "fare_amount", "ehail_fee",
    "airport_fee", "cbd_congestion_fee", "trip_duration_minutes", "source_dataset", "source_file",
    "source_year", "source_month",
]


@query(
    f"""SELECT 'yellow' AS taxi_type, l_linenumber AS vendor_id, CAST(NULL AS INT) AS passenger_count,
  l_quantity AS trip_distance, CAST(NULL AS INT) AS trip_type, l_extendedprice AS fare_amount,
  CAST(NULL AS DOUBLE) AS ehail_fee, l_tax AS airport_fee, CAST(NULL AS DOUBLE) AS cbd_congestion_fee,
  0.0::DOUBLE AS trip_duration_minutes, 'yellow_taxi' AS source_dataset, 'lineitem' AS source_file,
  CAST(year(l_shipdate) AS INT) AS source_year, CAST(month(l_shipdate) AS INT) AS source_month
FROM lineitem
UNION ALL
SELECT 'green', CAST(o_orderkey % 3 AS INT), CAST(o_custkey AS INT), o_totalprice / 1000, 1, o_totalprice,
  CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), o_totalprice / 10, 0.0, 'green_taxi', 'orders',
  CAST(year(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT)
FROM orders"""
)
def standardised_union(spark, sf_dir):
    lines = t.load(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("long").alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_tax").alias("Airport_fee"),
        F.col("l_discount").alias("not_in_the_layout"),
    )
    orders = t.load(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") % 3).alias("VendorID"),
        F.col("o_orderdate").alias("lpep_pickup_datetime"),
        F.col("o_orderdate").alias("lpep_dropoff_datetime"),
        F.col("o_custkey").alias("passenger_count"),
        (F.col("o_totalprice") / 1000).alias("trip_distance"),
        F.col("o_totalprice").alias("fare_amount"),
        F.lit(1.0).alias("trip_type"),
        (F.col("o_totalprice") / 10).alias("cbd_congestion_fee"),
    )

    def ready(df, kind, name, time):
        raw = landing.with_provenance(
            landing.standardise(df, kind), kind, F.lit(name), F.year(time), F.month(time), "now"
        )
        return cleaning.unify(raw, kind)

    both = ready(lines, "yellow", "lineitem", "tpep_pickup_datetime").unionByName(
        ready(orders, "green", "orders", "lpep_pickup_datetime")
    )
    return both.select(*UNION_COLUMNS)
