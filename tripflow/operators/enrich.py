"""Derived trip columns and the zone join that makes the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.labels import known_place
from tripflow.functions.wallclock import format_wall_clock, minutes_between, parse_wall_clock
from tripflow.operators.joins import broadcast_if_small
from tripflow.schema import FACT_COLUMNS, is_text


def moment(df: DataFrame, name: str) -> str:
    """Time column ``name`` as TIMESTAMP_NTZ, parsed only if it is text."""
    return parse_wall_clock(name) if is_text(df, name) else name


def time_text(df: DataFrame, name: str) -> str:
    """Time column ``name`` as text, formatted only if it is typed."""
    return name if is_text(df, name) else format_wall_clock(name)


def with_text_times(trips: DataFrame) -> DataFrame:
    """The delimited-text layout: both times as text, same columns and order."""
    times = ("pickup_dt", "dropoff_dt")
    return trips.selectExpr(
        *(f"{time_text(trips, c)} AS {c}" if c in times else c for c in trips.columns)
    )


def derive(trips: DataFrame) -> DataFrame:
    """Time parts, duration in minutes and tip percentage: 17 columns."""
    pickup = moment(trips, "pickup_dt")
    dropoff = moment(trips, "dropoff_dt")
    return trips.selectExpr(
        "vendor_id",
        f"{time_text(trips, 'pickup_dt')} AS pickup_dt",
        f"{time_text(trips, 'dropoff_dt')} AS dropoff_dt",
        f"hour({pickup}) AS pickup_hour",
        f"day({pickup}) AS pickup_day",
        f"month({pickup}) AS pickup_month",
        f"year({pickup}) AS pickup_year",
        f"{minutes_between(pickup, dropoff)} AS duration_min",
        "passenger_count",
        "trip_distance",
        "pu_loc_id",
        "do_loc_id",
        "payment_type",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "CASE WHEN fare_amount > 0 THEN tip_amount * 100.0D / fare_amount ELSE 0.0D END AS tip_pct",
    )


def zone_dimension(zone_text: DataFrame) -> DataFrame:
    """Typed zone dimension from text rows; only rows with a digit-only key stay."""
    return zone_text.filter("location_id RLIKE '^[0-9]+$'").selectExpr(
        "try_cast(location_id AS INT) AS location_id", "borough", "zone", "service_zone"
    )


def attach_pickup_zone(derived: DataFrame, zones: DataFrame) -> DataFrame:
    """Left join on the pickup zone; trips without a zone row become 'Unknown'.

    The dimension is broadcast after a check of its size, so the trips are not
    shuffled; see ``joins`` for a dimension that is too large.
    """
    places = zones.selectExpr(
        "location_id AS zone_key", "borough AS zone_borough", "zone AS zone_name"
    )
    named = {
        "pu_borough": f"{known_place('zone_borough')} AS pu_borough",
        "pu_zone": f"{known_place('zone_name')} AS pu_zone",
    }
    joined = derived.join(broadcast_if_small(places), F.expr("pu_loc_id = zone_key"), "left")
    return joined.selectExpr(*(named.get(name, name) for name in FACT_COLUMNS))


def fact_trips(clean: DataFrame, zones: DataFrame) -> DataFrame:
    """Clean trips to the 18-column fact."""
    return attach_pickup_zone(derive(clean), zones)
