"""Trips read from an order book.

Maps the tables ``lineitem orders customer supplier`` to a monthly trip
source, one trip per order line, and ``nation region`` to the zone dimension.
The arithmetic scatters values over every edge the cleaning rules test: null
vendors, zones and payments, zero and excess passengers and distances,
refunds, and drop-offs before the pickup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.wallclock import from_wall_seconds, wall_seconds
from tripflow.operators.enrich import zone_dimension
from tripflow.operators.joins import broadcast_if_small
from tripflow.schema import conform

# Zones that play the airports in this data.
AIRPORT_ZONES: dict[int, str] = {1: "EWR", 13: "JFK", 21: "LGA"}
# Zone id without a row in the dimension.
MISSING_ZONE = 99


# The columns this engine reads and the types it computes with.
TABLE_COLUMNS: dict[str, dict[str, str]] = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_nationkey": "int", "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_nationkey": "int"},
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
    },
    "events": {"ts": "timestamp_ntz", "event_type": "string"},
    "documents": {"text": "string"},
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


_FOOTERS: dict[tuple[str, str], T.StructType] = {}


def table_schema(spark: SparkSession, sf_dir: str, name: str) -> T.StructType:
    """The needed columns as the files store them. A table's footer is read
    once per application, not in every query."""
    path = table_path(sf_dir, name)
    key = (spark.sparkContext.applicationId, path)
    if key not in _FOOTERS:
        _FOOTERS[key] = spark.read.parquet(path).schema
    return T.StructType([_FOOTERS[key][column] for column in TABLE_COLUMNS[name]])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table_schema(spark, sf_dir, name)
    rows = spark.read.schema(schema).parquet(table_path(sf_dir, name))
    wanted = TABLE_COLUMNS[name]
    if all(field.dataType.simpleString() == wanted[field.name] for field in schema):
        return rows
    return rows.selectExpr(*(f"CAST({column} AS {kind}) AS {column}" for column, kind in wanted.items()))


def source_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order book in the layout of a source file, one column too many
    included, plus ``file_date``: the day the row's file is about."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    suppliers = table(spark, sf_dir, "supplier")

    # Orders meet customers before they meet the far larger lines, so the line
    # rows are shuffled at most twice: by order and by supplier. Lines and
    # orders both grow with the data, so their join is always sort-merge: it
    # spills, adaptive execution splits a hot order, and neither side is ever
    # broadcast on the strength of a small compressed file. Customers and
    # suppliers are left to Spark's broadcast threshold and runtime sizes.
    placed = orders.join(customers.drop("c_mktsegment"), F.expr("o_custkey = c_custkey"))
    rows = lines.join(placed.hint("merge"), F.expr("l_orderkey = o_orderkey")).join(
        suppliers, F.expr("l_suppkey = s_suppkey")
    )

    day = wall_seconds("o_orderdate")
    pickup = f"{day} + (l_orderkey * 37 + l_linenumber * 101) % 1440 * 60"
    dropoff = f"{pickup} + (l_partkey * 13 + l_suppkey * 7) % 9000 - 300"
    values = {
        "VendorID": "CASE WHEN l_partkey % 193 <> 0 THEN l_linenumber END",
        "tpep_pickup_datetime": from_wall_seconds(pickup),
        "tpep_dropoff_datetime": from_wall_seconds(dropoff),
        "passenger_count": "CASE WHEN (l_partkey + l_linenumber) % 11 <> 0"
        " THEN (l_orderkey + l_linenumber) % 8 END",
        "trip_distance": "(l_quantity - 1) * 2.1D",
        "RatecodeID": "CAST(CASE WHEN l_partkey % 71 = 0 THEN 99 ELSE l_linenumber % 6 + 1 END AS BIGINT)",
        "store_and_fwd_flag": "'N'",
        "PULocationID": f"CASE WHEN l_partkey % 97 = 0 THEN NULL"
        f" WHEN l_partkey % 89 = 0 THEN {MISSING_ZONE} ELSE c_nationkey END",
        "DOLocationID": f"CASE WHEN l_partkey % 83 = 0 THEN {MISSING_ZONE} ELSE s_nationkey END",
        "payment_type": "CASE WHEN l_partkey % 101 <> 0"
        " THEN try_cast(substring(o_orderpriority, 1, 1) AS BIGINT) END",
        "fare_amount": "CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09D THEN -1 ELSE 1 END"
        " * l_extendedprice / 200",
        "extra": "0.0D",
        "mta_tax": "0.5D",
        "tip_amount": "CASE WHEN o_orderpriority = '1-URGENT'"
        " THEN l_extendedprice / 200 * l_tax ELSE 0.0D END",
        "tolls_amount": "0.0D",
        "improvement_surcharge": "1.0D",
        "total_amount": "l_extendedprice / 200 * (1 + l_tax)"
        " - CASE WHEN l_returnflag = 'A' AND l_discount = 0 THEN 1000 ELSE 0 END",
        "congestion_surcharge": "2.5D",
        "Airport_fee": "0.0D",
        # Past the contract: a fee newer files carry, and the day of the file.
        "cbd_congestion_fee": "0.75D",
        "file_date": from_wall_seconds(f"{day} + CASE WHEN l_partkey % 53 = 0 THEN 2678400 ELSE 0 END"),
    }
    return rows.selectExpr(*(f"{text} AS {name}" for name, text in values.items()))


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order book as raw trips, held to the column contract."""
    return conform(source_trips(spark, sf_dir), "order book")


def landed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with ``year`` and ``month`` of the file they came in."""
    source = source_trips(spark, sf_dir)
    months = ("year(file_date) AS year", "month(file_date) AS month")
    return conform(source, "order book", keep=months)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: nations as zones, regions as boroughs."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    text = nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "CAST(n_nationkey AS STRING) AS location_id",
        "r_name AS borough",
        "n_name AS zone",
        "r_name AS service_zone",
    )
    return zone_dimension(text)


def zone_puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of the zone lookup in ``sequence``: every customer puts the row
    of their zone with their market segment as its service zone."""
    customers = table(spark, sf_dir, "customer")
    places = broadcast_if_small(zones(spark, sf_dir))
    return customers.join(places, F.expr("c_nationkey = location_id")).selectExpr(
        "CAST(location_id AS STRING) AS row_key",
        "c_custkey AS sequence",
        "struct(borough, zone AS zone_name, c_mktsegment AS service_zone) AS info",
    )
