"""Rule catalogue: what makes a record removable, and what a field may look like."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import unknown_is_false
from ..sources import schemas as S


@dataclass(frozen=True)
class Rule:
    """One removal rule. ``after_dedup`` rules look at the rows that survive deduplication."""

    name: str
    reason: str
    condition: Column
    stage: str = "invalid"
    after_dedup: bool = False


@dataclass(frozen=True)
class FieldRule:
    """What one field may hold. ``valid_codes`` is None for a field that is not a code."""

    name: str
    dtype: str
    valid_codes: tuple | None = None
    null_ok: bool = True
    zero_ok: bool = True
    negative_ok: bool = True
    essential: bool = False
    retained: bool = True
    removed_when: str | None = None

    def findings(self) -> dict[str, Column]:
        """Reportable conditions that follow from the flags; NULL is only ever "missing"."""
        c = F.col(self.name)
        out = {} if self.null_ok else {"missing": c.isNull()}
        if self.valid_codes is not None:
            out["unexpected_code"] = unknown_is_false(~c.isin(*self.valid_codes))
        elif self.dtype in ("int", "double"):
            if not self.zero_ok:
                out["zero"] = unknown_is_false(c == 0)
            if not self.negative_ok:
                out["negative"] = unknown_is_false(c < 0)
        return out


def _money(name: str, removed_when: str | None = None) -> FieldRule:
    return FieldRule(name, "double", removed_when=removed_when)


def field_rules(kind: str) -> dict[str, FieldRule]:
    """Catalogue for one kind of record file, in the field order of that kind."""
    code = {"zero_ok": False, "negative_ok": False}
    known = [
        FieldRule("vendor_id", "int", S.VENDOR_CODES[kind], **code),
        FieldRule(
            "pickup_datetime", "timestamp", null_ok=False, essential=True,
            removed_when="missing, or outside the study period", **code,
        ),
        FieldRule(
            "dropoff_datetime", "timestamp",
            removed_when="the trip lasts no time, less than none, or more than a day", **code,
        ),
        FieldRule("passenger_count", "int", negative_ok=False, removed_when="negative"),
        FieldRule("trip_distance", "double", negative_ok=False, removed_when="zero or negative"),
        FieldRule("ratecode_id", "int", S.RATECODE_CODES, **code),
        FieldRule("store_and_fwd_flag", "string", S.FLAG_CODES, **code),
        FieldRule(
            "pu_location_id", "int", null_ok=False, essential=True,
            removed_when="missing, or outside the place range", **code,
        ),
        FieldRule("do_location_id", "int", removed_when="outside the place range", **code),
        FieldRule("payment_type", "int", S.PAYMENT_CODES, negative_ok=False),
        FieldRule("trip_type", "int", S.TRIP_TYPE_CODES, **code),
        _money("fare_amount", "negative"),
        *map(
            _money,
            ["extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
             "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee"],
        ),
    ]
    by_name = {r.name: r for r in known}
    names = [S.CLEAN_RENAMES[kind].get(n, n) for n in S.RAW_SCHEMAS[kind].names]
    return {n: by_name[n] for n in names}


def trip_rules(
    place_range: tuple[int, int] = S.PLACE_RANGE,
    period: tuple[str, str] = (S.PERIOD_START, S.PERIOD_END),
    max_minutes: int = 1440,
) -> list[Rule]:
    """The removal rules in the order they are charged."""
    low, high = place_range
    start, end = period

    def outside(column: str) -> Column:
        return (F.col(column) < low) | (F.col(column) > high)

    minutes = F.col("trip_duration_minutes")
    return [
        Rule("pickup_datetime missing", "no cell without a time", F.col("pickup_datetime").isNull(),
             stage="essential_missing"),
        Rule("pu_location_id missing", "no cell without a place", F.col("pu_location_id").isNull(),
             stage="essential_missing"),
        Rule("pu_location_id out of range", f"places run from {low} to {high}", outside("pu_location_id")),
        Rule("do_location_id out of range", f"places run from {low} to {high}", outside("do_location_id")),
        Rule("trip_distance not positive", "a trip covers some distance", F.col("trip_distance") <= 0),
        Rule("passenger_count negative", "cannot be", F.col("passenger_count") < 0),
        Rule("fare_amount negative", "refund or error", F.col("fare_amount") < 0),
        Rule(
            "trip_duration_minutes not in (0, max]",
            f"a trip takes more than no time and at most {max_minutes} minutes",
            F.col("pickup_datetime").isNotNull()
            & F.col("dropoff_datetime").isNotNull()
            & ((minutes <= 0) | (minutes > max_minutes)),
        ),
        Rule(
            "pickup_datetime outside study period",
            "valid, but not part of the study",
            (F.col("pickup_datetime") < F.lit(start).cast("timestamp"))
            | (F.col("pickup_datetime") >= F.lit(end).cast("timestamp")),
            stage="study_period",
            after_dedup=True,
        ),
    ]


def landing_checks(
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    year: int = 2024,
    month: int = 1,
    names: dict[str, str] | None = None,
) -> dict[str, Column]:
    """The 23 plausibility checks of one landing month; a NULL is never counted.

    ``names`` maps a field of the checks to the column of the table at hand.
    """
    names = names or {}

    def c(field: str) -> Column:
        return F.col(names.get(field, field))

    minutes = (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)) / F.lit(60.0)
    low, high = S.PLACE_RANGE
    money = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
             "improvement_surcharge", "total_amount", "congestion_surcharge", "Airport_fee"]
    # The conditions and their bounds.
    return {
        "vendor code": ~c("VendorID").isin(*S.VENDOR_CODES["yellow"]),
        "rate code": ~c("RatecodeID").isin(*S.RATECODE_CODES),
        "payment code": ~c("payment_type").isin(*S.PAYMENT_CODES),
        "store flag": ~c("store_and_fwd_flag").isin(*S.FLAG_CODES),
        "no passengers": c("passenger_count") <= 0,
        "over 6 passengers": c("passenger_count") > 6,
        "distance not positive": c("trip_distance") <= 0,
        "distance over 100": c("trip_distance") > 100,
        **{f"{m} negative": c(m) < 0 for m in money},
        "pickup place": ~c("PULocationID").between(low, high),
        "dropoff place": ~c("DOLocationID").between(low, high),
        "dropoff before pickup": F.col(dropoff) < F.col(pickup),
        "no duration": minutes == 0,
        "over 24 hours": minutes > 1440,
        "other month": (F.year(pickup) != year) | (F.month(pickup) != month),
    }


def count_findings(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One scan for all checks: a row per check with its count and share of all rows."""
    names = list(checks)
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(unknown_is_false(checks[n])).alias(f"_c{i}") for i, n in enumerate(names)],
    )
    return row.select(
        "_n",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("check_name"), F.col(f"_c{i}").alias("record_count"))
                    for i, n in enumerate(names)
                ]
            )
        ),
    ).select(
        "check_name",
        "record_count",
        F.round(100.0 * F.col("record_count") / F.nullif("_n", F.lit(0)), 4).alias("pct_of_rows"),
    )
