"""Cleaning rules, the clean filter and the counts taken around it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripflow.functions.exact import percent
from tripflow.functions.labels import UNKNOWN_RATE_CODE
from tripflow.functions.naming import named
from tripflow.functions.wallclock import hour_text
from tripflow.schema import is_text

# What a trip must satisfy, with strict and inclusive bounds as
# written. A rule with a null operand is not satisfied.
CLEAN_RULES: dict[str, str] = {
    "vendor_present": "vendor_id IS NOT NULL",
    "pickup_zone_present": "pu_loc_id IS NOT NULL",
    "dropoff_zone_present": "do_loc_id IS NOT NULL",
    "passengers_1_to_6": "passenger_count >= 1.0D AND passenger_count <= 6.0D",
    "distance_0_to_100": "trip_distance > 0.0D AND trip_distance < 100.0D",
    "fare_0_to_500": "fare_amount > 0.0D AND fare_amount < 500.0D",
    "total_positive": "total_amount > 0.0D",
}

PASSES_ALL = " AND ".join(f"({rule})" for rule in CLEAN_RULES.values())

KEPT_PCT = percent("clean_rows", "raw_rows")


def clean_trips(raw: DataFrame) -> DataFrame:
    """Trips that satisfy every rule; the columns stay as they are."""
    return raw.filter(PASSES_ALL)


def clean_trips_counted(raw: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """The clean filter with raw and clean row counts taken in the same pass.

    Both counts ignore rows whose first column is null. Read the observations
    after exactly one action on the returned frame.
    """
    before, after = Observation("raw"), Observation("clean")
    counted = raw.observe(before, F.count("vendor_id").alias("rows"))
    kept = clean_trips(counted).observe(after, F.count("vendor_id").alias("rows"))
    return kept, before, after


def quality_counts(raw: DataFrame) -> DataFrame:
    """One row: raw rows, clean rows and the percentage kept."""
    counts = raw.agg(
        *named(
            raw_rows="count(vendor_id)",
            clean_rows=f"count(CASE WHEN {PASSES_ALL} THEN vendor_id END)",
        )
    )
    return counts.selectExpr("*", f"{KEPT_PCT} AS kept_pct")


def quality_by_rule(raw: DataFrame) -> DataFrame:
    """Rows failing each rule, all rules counted in one pass (extension)."""
    failing = {name: f"count_if(({rule}) IS NOT TRUE)" for name, rule in CLEAN_RULES.items()}
    return raw.agg(*named(**failing)).unpivot([], list(CLEAN_RULES), "rule", "failing_rows")


def flag_unknown_rate(trips: DataFrame) -> DataFrame:
    """Trips with a boolean ``unknown_rate`` column; no trip is dropped (extension)."""
    return trips.selectExpr("*", f"(rate_code = {UNKNOWN_RATE_CODE}) IS TRUE AS unknown_rate")


def countable(trips: DataFrame) -> str:
    """TRUE where a row can be counted by zone and hour, never null."""
    zone, hour = "pu_loc_id IS NOT NULL", "pickup_dt IS NOT NULL"
    if is_text(trips, "pu_loc_id"):
        zone = "try_cast(pu_loc_id AS INT) IS NOT NULL"
    if is_text(trips, "pickup_dt"):
        number = f"try_cast({hour_text('pickup_dt')} AS INT)"
        hour = f"length(pickup_dt) >= 13 AND {number} IS NOT NULL"
    return f"({hour} AND {zone}) IS TRUE"


def row_quality(trips: DataFrame) -> DataFrame:
    """One row: how many rows the zone-hour count takes and how many it skips."""
    good = countable(trips)
    return trips.agg(*named(rows_ok=f"count_if({good})", rows_bad=f"count_if(NOT ({good}))"))
