"""The five business questions over the fact table, and the busiest zone-hours.

``q1`` to ``q5`` are finished results in a total order, so a limit always
returns the same rows. The functions they sort are public too: a report or
serving table built on top of them does not pay for a global sort.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.exact import Rolled, Rows, partial_sums
from tripflow.functions.labels import AIRPORTS, lookup, payment_label
from tripflow.functions.naming import TRIPS, named
from tripflow.operators.joins import broadcast_if_small


#: Trips whose duration and distance count in the congestion table.
TIMED = "trip_distance > 0.1D AND duration_min BETWEEN 1 AND 120"
_ROLLED = ["total_amount", "fare_amount", "tip_pct", "duration_min", "trip_distance"]
_PACE = "try_divide(duration_min, trip_distance)"


def rollup(fact: DataFrame) -> DataFrame:
    """The fact by hour, zone pair and payment code, with trips and partial sums.

    All five questions and the zone-hour metrics can be answered from it with
    ``of=Rolled``, to the same values; its size is bounded by hours, zones and
    codes and not by trips.
    """
    timed = {name: f"CASE WHEN {TIMED} THEN {value} END" for name, value in
             (("timed_duration", "duration_min"), ("timed_distance", "trip_distance"), ("pace", _PACE))}
    sums = [partial_sums(name, name) for name in _ROLLED]
    sums += [partial_sums(value, name) for name, value in timed.items()]
    measures = {name: text for part in sums for name, text in part.items()}
    keys = ["pickup_hour", "pu_loc_id", "do_loc_id", "pu_borough", "pu_zone", "payment_type"]
    return fact.groupBy(*keys).agg(*named(**TRIPS, timed=f"count_if({TIMED})", **measures))


def hotspots(fact: DataFrame, of: type = Rows) -> DataFrame:
    """Trips per hour, borough and zone name; zones sharing a name are merged."""
    return fact.groupBy("pickup_hour", "pu_borough", "pu_zone").agg(*named(trips=of.trips))


def q1_hotspots(fact: DataFrame, of: type = Rows) -> DataFrame:
    """All hotspots by hour, busiest first."""
    return hotspots(fact, of).orderBy("pickup_hour", F.desc("trips"), "pu_borough", "pu_zone")


def revenue_by_borough(fact: DataFrame, of: type = Rows) -> DataFrame:
    """Trips, revenue, mean fare and mean tip percentage by borough and payment."""
    return fact.groupBy("pu_borough", *named(payment_method=payment_label("payment_type"))).agg(
        *named(
            trips=of.trips,
            revenue_usd=of.rounded_sum("total_amount"),
            avg_fare=of.rounded_mean("fare_amount"),
            avg_tip_pct=of.rounded_mean("tip_pct"),
        )
    )


def q2_revenue_by_borough(fact: DataFrame, of: type = Rows) -> DataFrame:
    """Revenue groups, greatest revenue first."""
    return revenue_by_borough(fact, of).orderBy(F.desc("revenue_usd"), "pu_borough", "payment_method")


def q3_congestion(
    fact: DataFrame, min_trips: int = 20, top: int | None = 500, of: type = Rows
) -> DataFrame:
    """Duration, distance and minutes per mile of the heaviest zone pairs by hour.

    ``min_per_mile`` is the mean of the trips' own ratios. ``top=None`` keeps
    every pair with at least ``min_trips`` trips.
    """
    if of is Rolled:
        chosen, trips = fact.filter("timed > 0"), "sum(timed)"
        duration, distance, pace = "timed_duration", "timed_distance", "pace"
    else:
        chosen, trips = fact.filter(TIMED), of.trips
        duration, distance, pace = "duration_min", "trip_distance", _PACE
    pairs = (
        chosen.groupBy("pickup_hour", "pu_loc_id", "do_loc_id")
        .agg(
            *named(
                trips=trips,
                avg_duration_min=of.rounded_mean(duration),
                avg_distance_mi=of.rounded_mean(distance),
                min_per_mile=of.rounded_mean(pace),
            )
        )
        .filter(f"trips >= {int(min_trips)}")
        .orderBy(F.desc("trips"), "pickup_hour", "pu_loc_id", "do_loc_id")
    )
    return pairs if top is None else pairs.limit(top)


def airport_destinations(
    fact: DataFrame,
    zones: DataFrame,
    airports: Mapping[int, str] = AIRPORTS,
    of: type = Rows,
) -> DataFrame:
    """Destinations of airport pickups; trips to a zone without a row are left out."""
    places = zones.selectExpr(
        "location_id AS zone_key", "zone AS destination_zone", "borough AS destination_borough"
    )
    measures = {
        "avg_distance_mi": of.rounded_mean("trip_distance"),
        "avg_fare": of.rounded_mean("fare_amount"),
        "avg_tip_pct": of.rounded_mean("tip_pct"),
        "avg_duration_min": of.rounded_mean("duration_min", 1),
    }
    return (
        fact.filter(F.col("pu_loc_id").isin(list(airports)))
        .join(broadcast_if_small(places), F.expr("do_loc_id = zone_key"), "inner")
        .groupBy("pu_loc_id", "destination_zone", "destination_borough")
        .agg(*named(trips=of.trips, **measures))
        .selectExpr(
            f"{lookup('pu_loc_id', airports)} AS airport",
            "destination_zone",
            "destination_borough",
            "trips",
            *measures,
        )
    )


def q4_airports(
    fact: DataFrame,
    zones: DataFrame,
    airports: Mapping[int, str] = AIRPORTS,
    of: type = Rows,
) -> DataFrame:
    """Airport destinations by airport, busiest first."""
    return airport_destinations(fact, zones, airports, of).orderBy(
        "airport", F.desc("trips"), "destination_zone", "destination_borough"
    )


def payment_share(fact: DataFrame, *keys: str, of: type = Rows) -> DataFrame:
    """Card, cash and other share of trips per group.

    A trip with a null code counts as a trip but belongs to no share.
    """
    return fact.groupBy(*keys).agg(
        *named(
            pct_card=of.percent_of_rows("payment_type = 1"),
            pct_cash=of.percent_of_rows("payment_type = 2"),
            pct_other=of.percent_of_rows("payment_type NOT IN (1, 2)"),
            trips=of.trips,
        )
    )


def q5_payment_share(fact: DataFrame, of: type = Rows) -> DataFrame:
    """Payment shares by pickup borough, most trips first."""
    return payment_share(fact, "pu_borough", of=of).orderBy(F.desc("trips"), "pu_borough")


def busiest_zone_hours(fact: DataFrame, top: int = 10) -> DataFrame:
    """The zone and hour pairs with most trips."""
    return (
        fact.groupBy("pickup_hour", "pu_zone")
        .agg(*named(**TRIPS))
        .orderBy(F.desc("trips"), "pickup_hour", "pu_zone")
        .limit(top)
    )
