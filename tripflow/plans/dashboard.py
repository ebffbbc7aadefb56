"""The dashboard's frames, read from exported results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators import reports
from tripflow.sources.files import read_result


def dashboard(
    spark: SparkSession, root: str, hour: int = 18, airport: str = "JFK"
) -> dict[str, DataFrame]:
    """One frame per panel; ``hour`` and ``airport`` are its two selectors."""

    def result(name: str) -> DataFrame:
        return read_result(spark, name, f"{root}/results/{name}")

    hotspots, revenue = result("q1_hotspots"), result("q2_revenue_by_borough")
    congestion, shares = result("q3_congestion"), result("q5_payment_share")
    return {
        "headline": reports.kpi_summary(revenue),
        "hotspots": reports.hotspots_at(hotspots, hour),
        "revenue": reports.revenue_pivot(revenue),
        "congestion": reports.congestion_by_hour(congestion),
        "slowest_pairs": reports.slowest_pairs(congestion),
        "destinations": reports.destinations_from(result("q4_airports"), airport, top=15),
        "payment_share": reports.payment_share_long(shares),
    }
