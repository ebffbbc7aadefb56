"""Report frames: what a dashboard shows, computed as DataFrames.

The inputs are result tables of the five questions, already aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.exact import (
    exact_mean,
    exact_total,
    round_half_up,
    rounded_mean,
    rounded_sum,
)
from tripflow.functions.labels import OTHER_PAYMENT, PAYMENT_LABELS, SHARE_LABELS, lookup
from tripflow.functions.naming import named


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], top: int
) -> DataFrame:
    """The first ``top`` rows of each group with their ``rank``.

    Spark cuts each group to ``top`` rows before the shuffle
    (WindowGroupLimit), so a hot group does not reach one task whole. It does
    so up to ``spark.sql.optimizer.windowGroupLimitThreshold``, by default a
    thousand rows per group.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= top)


def kpi_summary(revenue: DataFrame) -> DataFrame:
    """Headline figures over the revenue table.

    ``avg_fare`` and ``avg_tip_pct`` are unweighted means over the groups;
    the ``weighted_`` columns weigh each group by its trips.
    """

    def weighted(name: str) -> str:
        total = exact_total(f"{name} * trips")
        return round_half_up(f"try_divide({total}, CAST(sum(trips) AS DOUBLE))")

    return revenue.agg(
        *named(
            total_trips="sum(trips)",
            revenue_usd=rounded_sum("revenue_usd"),
            revenue_musd=round_half_up(f"{exact_total('revenue_usd')} / 1.0E6D"),
            avg_fare=rounded_mean("avg_fare"),
            avg_tip_pct=rounded_mean("avg_tip_pct"),
            weighted_avg_fare=weighted("avg_fare"),
            weighted_avg_tip_pct=weighted("avg_tip_pct"),
        )
    )


def hotspots_top_per_hour(hotspots: DataFrame, top: int = 10) -> DataFrame:
    """The busiest zones of every hour at once."""
    order = [F.desc("trips"), F.asc("pu_borough"), F.asc("pu_zone")]
    return top_per_group(hotspots, ["pickup_hour"], order, top)


def hotspots_at(hotspots: DataFrame, hour: int = 18, top: int = 10) -> DataFrame:
    """The busiest zones of one hour, busiest first."""
    chosen = hotspots.filter(F.col("pickup_hour") == hour)
    return chosen.orderBy(F.desc("trips"), "pu_borough", "pu_zone").limit(top)


def revenue_pivot(revenue: DataFrame) -> DataFrame:
    """Revenue with one column per payment method."""
    methods = [*PAYMENT_LABELS.values(), OTHER_PAYMENT]
    grouped = revenue.groupBy("pu_borough").pivot("payment_method", methods)
    return grouped.agg(F.max("revenue_usd"))


def congestion_by_hour(congestion: DataFrame) -> DataFrame:
    """Unweighted mean of minutes per mile over the heavy pairs of each hour."""
    means = congestion.groupBy("pickup_hour").agg(*named(min_per_mile=exact_mean("min_per_mile")))
    return means.orderBy("pickup_hour")


def slowest_pairs(congestion: DataFrame, top: int = 15) -> DataFrame:
    order = [F.desc("min_per_mile"), "pickup_hour", "pu_loc_id", "do_loc_id"]
    return congestion.orderBy(*order).limit(top)


def airport_top_destinations(
    destinations: DataFrame, top: int = 15, charted: int = 10
) -> DataFrame:
    """The busiest destinations of every airport; ``charted`` marks the first ten."""
    order = [F.desc("trips"), F.asc("destination_zone"), F.asc("destination_borough")]
    ranked = top_per_group(destinations, ["airport"], order, top)
    return ranked.withColumn("charted", F.col("rank") <= charted)


def destinations_from(destinations: DataFrame, airport: str, top: int = 10) -> DataFrame:
    """The busiest destinations of one airport, busiest first."""
    chosen = destinations.filter(F.col("airport") == airport)
    return chosen.orderBy(F.desc("trips"), "destination_zone", "destination_borough").limit(top)


def payment_share_long(shares: DataFrame) -> DataFrame:
    """The share table with one row per borough and method."""
    tall = shares.unpivot(["pu_borough", "trips"], list(SHARE_LABELS), "method", "pct")
    return tall.selectExpr(
        "pu_borough", "trips", f"{lookup('method', SHARE_LABELS)} AS method", "pct"
    )
