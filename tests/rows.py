"""Hand-made trips, zones and helpers shared by the tests."""

from __future__ import annotations

from tripflow.schema import FACT_SCHEMA, RAW_TEXT_SCHEMA, ZONE_SCHEMA

# A known trip that passes every rule.
GOOD = {
    "vendor_id": 2,
    "pickup_dt": "2026-01-01 00:54:04.000000",
    "dropoff_dt": "2026-01-01 00:59:37.000000",
    "passenger_count": 1.0,
    "trip_distance": 0.97,
    "rate_code": 1.0,
    "store_fwd": "N",
    "pu_loc_id": 239,
    "do_loc_id": 238,
    "payment_type": 1,
    "fare_amount": 7.2,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 3.66,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 15.86,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
}

FACT = {
    "vendor_id": 1,
    "pickup_dt": "2026-01-05 18:00:00.000000",
    "pickup_hour": 18,
    "pickup_day": 5,
    "pickup_month": 1,
    "pickup_year": 2026,
    "duration_min": 10.0,
    "passenger_count": 1.0,
    "trip_distance": 2.0,
    "pu_loc_id": 132,
    "pu_borough": "Queens",
    "pu_zone": "JFK Airport",
    "do_loc_id": 7,
    "payment_type": 1,
    "fare_amount": 20.0,
    "tip_amount": 2.0,
    "total_amount": 25.0,
    "tip_pct": 10.0,
}

ZONES = [
    (1, "EWR", "Newark Airport", "EWR"),
    (7, "Queens", "Astoria", "Boro Zone"),
    (56, "Queens", "Corona", "Boro Zone"),
    (57, "Queens", "Corona", "Boro Zone"),
    (132, "Queens", "JFK Airport", "Airports"),
    (264, "Unknown", "N/A", "N/A"),
    (265, "N/A", "Outside of NYC", "N/A"),
]


def raw(spark, *changes):
    rows = [tuple({**GOOD, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, RAW_TEXT_SCHEMA)


def fact(spark, *changes):
    rows = [tuple({**FACT, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, FACT_SCHEMA)


def zones(spark):
    return spark.createDataFrame(ZONES, ZONE_SCHEMA)


def tuples(df):
    return [tuple(row) for row in df.collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
