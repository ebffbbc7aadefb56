"""Zone-hour counts, table counts, previews and word count."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.labels import literal, payment_label
from tripflow.functions.naming import TRIPS, named
from tripflow.functions.wallclock import hour_text
from tripflow.operators.clean import countable
from tripflow.operators.joins import broadcast_if_small
from tripflow.operators.questions import TIMED
from tripflow.schema import is_text


def trips_per_zone_hour(trips: DataFrame) -> DataFrame:
    """Trips per pickup zone id and two-digit hour, both as text.

    The hour is cut out of a text time as it stands, or taken from a typed one.
    Rows that cannot be counted are skipped; ``row_quality`` reports them.
    """
    text = is_text(trips, "pickup_dt")
    hour = hour_text("pickup_dt") if text else "lpad(CAST(hour(pickup_dt) AS STRING), 2, '0')"
    return (
        trips.filter(countable(trips))
        .groupBy("pu_loc_id", *named(hour=hour))
        .agg(*named(**TRIPS))
        .selectExpr("CAST(pu_loc_id AS STRING) AS pu_loc_id", "hour", "trips")
    )


def top_zone_hours(zone_hours: DataFrame, top: int = 20) -> DataFrame:
    return zone_hours.orderBy(F.desc("trips"), "pu_loc_id", "hour").limit(top)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named frame: its name and number of rows."""
    counted = [
        frame.agg(*named(n_rows="count(1)")).selectExpr(f"{literal(name)} AS table_name", "n_rows")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows of stored Parquet tables by name, from their footers: no row is read.

    The count is pushed into the version 2 source, in a session of its own, so that
    the caller's settings stay as they are.
    """
    session = spark.newSession()
    first = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in first if x != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counted = table_counts({name: session.read.parquet(path) for name, path in paths.items()})
    # A pushed count of no row groups at all is null, though it is declared never to be, so
    # coalesce() would be optimized away. Such a table has no row here and counts as 0 below.
    names = session.range(1).selectExpr(f"explode(array({', '.join(map(literal, paths))})) AS table_name", "0L AS n_rows")
    return counted.where("n_rows > 0").unionByName(names).groupBy("table_name").agg(*named(n_rows="sum(n_rows)"))


def answer_counts(
    fact: DataFrame, zones: DataFrame, airports: Mapping[int, str], min_trips: int, top: int = 500
) -> DataFrame:
    """Rows of the fact, the dimension, the five answers and the zone lookup.

    One scan of the fact makes a rollup by hour, zone pair and payment code,
    whose size is bounded by zones and hours. Each of its rows stands for a key
    of every answer, and the answers' rows are the distinct keys.
    """
    keys = ["pickup_hour", "pu_loc_id", "do_loc_id", "pu_borough", "pu_zone", "payment_type"]
    rollup = fact.groupBy(*keys).agg(*named(**TRIPS, timed=f"count_if({TIMED})"))
    places = zones.selectExpr(
        "location_id AS zone_key", "zone AS do_zone", "borough AS do_borough", "1 AS known"
    )
    rollup = rollup.join(broadcast_if_small(places), F.expr("do_loc_id = zone_key"), "left")
    of_airport = f"pu_loc_id IN ({', '.join(str(int(k)) for k in airports)}) AND known = 1"
    answers = {
        "fact_trips": ([], "trips", "true"),
        "q1_hotspots": (["pickup_hour", "pu_borough", "pu_zone"], "trips", "true"),
        "q2_revenue_by_borough": (["pu_borough", payment_label("payment_type")], "trips", "true"),
        "q3_congestion": (["pickup_hour", "pu_loc_id", "do_loc_id"], "timed", "timed > 0"),
        "q4_airports": (["pu_loc_id", "do_zone", "do_borough"], "trips", of_airport),
        "q5_payment_share": (["pu_borough"], "trips", "true"),
    }
    entries = ", ".join(
        f"CASE WHEN {test} THEN struct({literal(name)} AS table_name, "
        f"to_json(array({', '.join(f'CAST({k} AS STRING)' for k in key)})) AS key, {n} AS n) END"
        for name, (key, n, test) in answers.items()
    )
    keyed = rollup.selectExpr(f"inline(filter(array({entries}), entry -> entry IS NOT NULL))")
    rows = keyed.groupBy("table_name", "key").agg(*named(n="sum(n)"))
    counted = rows.groupBy("table_name").agg(
        *named(n_rows="count(1)", trips="sum(n)", often=f"count_if(n >= {int(min_trips)})")
    )
    of_fact = counted.selectExpr(
        "table_name",
        "CASE table_name WHEN 'fact_trips' THEN trips "
        f"WHEN 'q3_congestion' THEN least(often, {int(top)}L) ELSE n_rows END AS n_rows",
    )
    of_zones = zones.agg(*named(n_rows="count(1)", keys="count(DISTINCT location_id)")).selectExpr(
        "inline(array(struct('dim_zone' AS table_name, n_rows), struct('zone_lookup' AS table_name, keys AS n_rows)))"
    )
    named_all = fact.sparkSession.range(1).selectExpr(
        f"explode(array({', '.join(map(literal, answers))})) AS table_name", "0L AS n_rows"
    )
    return of_fact.unionByName(of_zones).unionByName(named_all).groupBy("table_name").agg(
        *named(n_rows="sum(n_rows)")
    )


def zone_preview(zones: DataFrame, rows: int = 5) -> DataFrame:
    return zones.orderBy("location_id").limit(rows)


def fact_preview(fact: DataFrame, rows: int = 5) -> DataFrame:
    shown = ["vendor_id", "pickup_dt", "pu_zone", "fare_amount", "tip_amount", "total_amount"]
    order = sorted(shown, key=lambda name: name != "pickup_dt")
    return fact.select(*shown).orderBy(*order).limit(rows)


def word_count(documents: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of every whitespace-separated token, over the whole texts."""
    words = documents.select(F.explode(F.split(F.col(column), r"[ \t\n\r\f]+")).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(*named(occurrences="count(1)"))
