"""The monthly job: land, clean, enrich, answer, export, serve."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tripflow.functions.exact import Rolled, Rows
from tripflow.functions.labels import AIRPORTS
from tripflow.operators import counts, questions, serving
from tripflow.operators.clean import KEPT_PCT, clean_trips_counted
from tripflow.operators.enrich import fact_trips
from tripflow.schema import FACT_SCHEMA
from tripflow.session import written_once
from tripflow.sinks import tables
from tripflow.sinks.keyed import upsert_table
from tripflow.sinks.tables import Month
from tripflow.sources import files


def run_clean(
    spark: SparkSession, raw: DataFrame, path: str, mode: str = "errorifexists"
) -> dict[str, int]:
    """Store the clean trips and return their counts.

    One pass over the raw data: the counts are observed while writing.
    """
    kept, before, after = clean_trips_counted(raw)
    tables.store(kept, path, mode)
    return {"raw_rows": before.get["rows"], "clean_rows": after.get["rows"]}


def report_counts(spark: SparkSession, month: Month, counted: dict[str, int], path: str) -> None:
    """Append one load of one month to the quality report."""
    row = spark.createDataFrame(
        [(*month, counted["raw_rows"], counted["clean_rows"])],
        "year string, month string, raw_rows bigint, clean_rows bigint",
    )
    tables.store(row.selectExpr("*", f"{KEPT_PCT} AS kept_pct"), path, "append")


def run_enrich(
    spark: SparkSession, clean: DataFrame, zones: DataFrame, path: str, mode: str = "errorifexists"
) -> None:
    """Store the fact of some clean trips."""
    tables.store(fact_trips(clean, zones), path, mode)


def answers(
    fact: DataFrame,
    zones: DataFrame,
    airports: Mapping[int, str] = AIRPORTS,
    min_trips: int = 20,
    of: type = Rows,
) -> dict[str, DataFrame]:
    """The five result tables by name, from the fact or (``of=Rolled``) its rollup."""
    return {
        "q1_hotspots": questions.q1_hotspots(fact, of),
        "q2_revenue_by_borough": questions.q2_revenue_by_borough(fact, of),
        "q3_congestion": questions.q3_congestion(fact, min_trips, of=of),
        "q4_airports": questions.q4_airports(fact, zones, airports, of),
        "q5_payment_share": questions.q5_payment_share(fact, of),
    }


def run_month(
    spark: SparkSession,
    source_paths: Iterable[str],
    zone_path: str,
    root: str,
    schema: str = "trip_analytics",
    airports: Mapping[int, str] = AIRPORTS,
    min_trips: int = 20,
    text: bool = False,
) -> dict[str, int]:
    """Everything from source files to exports under ``root``; returns the counts.

    Only the months given are landed, cleaned and enriched, each in its own
    folder; months loaded earlier stay as they are. The answers are taken
    over all months. ``text`` is for sources that are headerless delimited text.
    """
    read = files.read_trips_text if text else files.read_source
    zones = files.read_zones(spark, zone_path)
    total = {"raw_rows": 0, "clean_rows": 0}
    for month in tables.land_months(spark, source_paths, f"{root}/raw/trips", read):
        raw_path, clean_path, fact_path = (
            tables.month_folder(f"{root}/{stage}", month)
            for stage in ("raw/trips", "clean/trips", "clean/trips_enriched")
        )
        counted = run_clean(spark, files.read_trips(spark, raw_path), clean_path, "overwrite")
        report_counts(spark, month, counted, f"{root}/clean/quality_report")
        clean = files.read_trips(spark, clean_path)
        run_enrich(spark, clean, zones, fact_path, "overwrite")
        total = {name: total[name] + counted[name] for name in total}

    tables.create_schema(spark, schema)
    tables.save_table(zones, f"{schema}.dim_zone")
    facts = f"{root}/clean/trips_enriched"
    tables.register_external(spark, f"{schema}.fact_trips", facts, FACT_SCHEMA, by_month=True)
    # The fact is scanned once; answers and serving tables come from its rollup.
    fact = written_once(questions.rollup(spark.table(f"{schema}.fact_trips")), "rollup")

    results = answers(fact, spark.table(f"{schema}.dim_zone"), airports, min_trips, Rolled)
    for name, result in results.items():
        tables.save_table(result, f"{schema}.{name}")
        stored = spark.table(f"{schema}.{name}")
        tables.export_text(stored, f"{root}/results/{name}", one_file=True)

    clean = files.read_trips(spark, f"{root}/clean/trips")
    zone_hours = counts.trips_per_zone_hour(clean)
    tables.export_text(zone_hours, f"{root}/results/trips_per_zone_hour", sep="\t")
    complete = files.read_zones(spark, zone_path, complete_only=True)
    upsert_table(spark, f"{schema}.zone_lookup", serving.zone_lookup(complete))
    hotspots = spark.table(f"{schema}.q1_hotspots")
    upsert_table(spark, f"{schema}.trip_by_zone", serving.trip_by_zone(hotspots))
    upsert_table(spark, f"{schema}.zone_hour_profile", serving.zone_hour_profile(fact, of=Rolled))
    return total
