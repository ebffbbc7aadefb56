"""Extensions: reports that were planned for this data but are not part of the
core job list. Kept apart so that the core stays what it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.exact import percent, rounded_mean, rounded_sum
from tripflow.functions.naming import TRIPS, named
from tripflow.operators.enrich import moment
from tripflow.operators.questions import payment_share

DISTANCE_EDGES = (1, 2, 5, 10, 20)


def _in_file_month(trips: DataFrame) -> str:
    pickup = moment(trips, "pickup_dt")
    return f"(year({pickup}) = year AND month({pickup}) = month) IS TRUE"


def drop_out_of_month(landed: DataFrame) -> DataFrame:
    """Landed trips (with ``year`` and ``month`` of their file) picked up in that month."""
    return landed.filter(_in_file_month(landed))


def out_of_month(landed: DataFrame) -> DataFrame:
    """Per file month: its trips and how many were picked up in another month."""
    strays = f"count_if(NOT ({_in_file_month(landed)}))"
    return landed.groupBy("year", "month").agg(*named(**TRIPS, out_of_month=strays))


def demand_by_dow(fact: DataFrame) -> DataFrame:
    """Trips per day of week (1 = Sunday) and hour."""
    day = "dayofweek(make_date(pickup_year, pickup_month, pickup_day))"
    return fact.groupBy(*named(day_of_week=day), "pickup_hour").agg(*named(**TRIPS))


def distance_bucket(distance: str, edges: tuple[int, ...] = DISTANCE_EDGES) -> str:
    """Label of the half-open distance range, such as ``02-05``; the last is open."""
    lows = (0, *edges[:-1])
    closed = " ".join(
        f"WHEN {distance} < {high} THEN '{low:02d}-{high:02d}'" for low, high in zip(lows, edges)
    )
    return f"CASE {closed} WHEN {distance} >= {edges[-1]} THEN '{edges[-1]:02d}+' END"


def revenue_by_distance(fact: DataFrame) -> DataFrame:
    """Fares and tips by pickup zone and distance range."""
    bucket = named(distance_mi=distance_bucket("trip_distance"))
    return fact.groupBy("pu_borough", "pu_zone", *bucket).agg(
        *named(
            **TRIPS,
            revenue_usd=rounded_sum("total_amount"),
            avg_fare=rounded_mean("fare_amount"),
            avg_tip=rounded_mean("tip_amount"),
            avg_tip_pct=rounded_mean("tip_pct"),
        )
    )


def payment_share_by_zone(fact: DataFrame) -> DataFrame:
    return payment_share(fact, "pu_borough", "pu_zone")


def monthly_trend(fact: DataFrame) -> DataFrame:
    """Trips and revenue by borough and month with the change since the month before.

    ``prev_trips`` is that of the borough's previous month with trips. The
    window runs over one row per borough and month.
    """
    months = fact.groupBy("pu_borough", "pickup_year", "pickup_month").agg(
        *named(**TRIPS, revenue_usd=rounded_sum("total_amount"))
    )
    line = Window.partitionBy("pu_borough").orderBy("pickup_year", "pickup_month")
    compared = months.withColumn("prev_trips", F.lag("trips").over(line))
    change = percent("(trips - prev_trips)", "prev_trips")
    return compared.selectExpr("*", f"{change} AS trips_change_pct")


def duplicate_report(trips: DataFrame) -> DataFrame:
    """One row: how many rows have exact copies. Nothing is removed.

    Rows are counted by a 64-bit hash first, so nearly all of them cross the
    network as eight bytes; only rows whose hash occurs twice are compared in
    full. Both groupings combine map-side, whatever the size of a group.
    """
    hashed = trips.withColumn("_hash", F.xxhash64(*trips.columns))
    counted = hashed.groupBy("_hash").agg(*named(n="count(1)"))
    alone = counted.where("n = 1").agg(*named(trips="count(1)"))
    repeated = hashed.join(counted.where("n > 1").select("_hash"), "_hash", "left_semi")
    groups = repeated.groupBy(*trips.columns).agg(*named(copies="count(1)"))
    compared = groups.agg(
        *named(
            trips="coalesce(sum(copies), 0L)",
            distinct_trips="count(1)",
            duplicated_trips="count_if(copies > 1)",
            surplus_rows="coalesce(sum(copies - 1), 0L)",
        )
    )
    single = alone.selectExpr("trips", "trips AS distinct_trips", "0L AS duplicated_trips", "0L AS surplus_rows")
    columns = compared.columns
    return single.unionByName(compared).agg(
        *named(**{name: f"CAST(sum({name}) AS BIGINT)" for name in columns})
    )
