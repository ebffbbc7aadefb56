"""Declared schemas. Nothing in this engine infers a schema from data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The columns of a monthly source file in contract order, the
# name each one carries inside the engine, and its type there.
SOURCE_CONTRACT: tuple[tuple[str, str, str], ...] = (
    ("VendorID", "vendor_id", "int"),
    ("tpep_pickup_datetime", "pickup_dt", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "dropoff_dt", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "double"),
    ("trip_distance", "trip_distance", "double"),
    ("RatecodeID", "rate_code", "double"),
    ("store_and_fwd_flag", "store_fwd", "string"),
    ("PULocationID", "pu_loc_id", "int"),
    ("DOLocationID", "do_loc_id", "int"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("Airport_fee", "airport_fee", "double"),
)

SOURCE_COLUMNS = [source for source, _, _ in SOURCE_CONTRACT]
RAW_COLUMNS = [name for _, name, _ in SOURCE_CONTRACT]


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Trips as Parquet: wall-clock times stay typed.
RAW_SCHEMA = _struct([(name, kind) for _, name, kind in SOURCE_CONTRACT])

# Trips as headerless delimited text: times are text with six fraction digits.
RAW_TEXT_SCHEMA = _struct(
    [
        (name, "string" if kind == "timestamp_ntz" else kind)
        for _, name, kind in SOURCE_CONTRACT
    ]
)

ZONE_SCHEMA = _struct(
    [
        ("location_id", "int"),
        ("borough", "string"),
        ("zone", "string"),
        ("service_zone", "string"),
    ]
)

FACT_SCHEMA = _struct(
    [
        ("vendor_id", "int"),
        ("pickup_dt", "string"),
        ("pickup_hour", "int"),
        ("pickup_day", "int"),
        ("pickup_month", "int"),
        ("pickup_year", "int"),
        ("duration_min", "double"),
        ("passenger_count", "double"),
        ("trip_distance", "double"),
        ("pu_loc_id", "int"),
        ("pu_borough", "string"),
        ("pu_zone", "string"),
        ("do_loc_id", "int"),
        ("payment_type", "int"),
        ("fare_amount", "double"),
        ("tip_amount", "double"),
        ("total_amount", "double"),
        ("tip_pct", "double"),
    ]
)
FACT_COLUMNS = FACT_SCHEMA.fieldNames()

RESULT_SCHEMAS: dict[str, T.StructType] = {
    "q1_hotspots": _struct(
        [
            ("pickup_hour", "int"),
            ("pu_borough", "string"),
            ("pu_zone", "string"),
            ("trips", "bigint"),
        ]
    ),
    "q2_revenue_by_borough": _struct(
        [
            ("pu_borough", "string"),
            ("payment_method", "string"),
            ("trips", "bigint"),
            ("revenue_usd", "double"),
            ("avg_fare", "double"),
            ("avg_tip_pct", "double"),
        ]
    ),
    "q3_congestion": _struct(
        [
            ("pickup_hour", "int"),
            ("pu_loc_id", "int"),
            ("do_loc_id", "int"),
            ("trips", "bigint"),
            ("avg_duration_min", "double"),
            ("avg_distance_mi", "double"),
            ("min_per_mile", "double"),
        ]
    ),
    "q4_airports": _struct(
        [
            ("airport", "string"),
            ("destination_zone", "string"),
            ("destination_borough", "string"),
            ("trips", "bigint"),
            ("avg_distance_mi", "double"),
            ("avg_fare", "double"),
            ("avg_tip_pct", "double"),
            ("avg_duration_min", "double"),
        ]
    ),
    "q5_payment_share": _struct(
        [
            ("pu_borough", "string"),
            ("pct_card", "double"),
            ("pct_cash", "double"),
            ("pct_other", "double"),
            ("trips", "bigint"),
        ]
    ),
    "trips_per_zone_hour": _struct(
        [("pu_loc_id", "string"), ("hour", "string"), ("trips", "bigint")]
    ),
}


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


class ContractError(ValueError):
    """A source file lacks columns the engine needs."""


def conform(df: DataFrame, origin: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """Hold a source frame to the column contract.

    Missing columns stop the job and are all named; further columns are
    dropped unless named in ``keep``; the contract columns come out renamed,
    typed and in order. A value that does not fit its type becomes null.
    """
    present = set(df.columns)
    missing = [name for name in SOURCE_COLUMNS if name not in present]
    if missing:
        raise ContractError(f"{origin}: missing expected column(s): {', '.join(missing)}")
    return df.selectExpr(
        *(f"try_cast(`{source}` AS {kind}) AS {name}" for source, name, kind in SOURCE_CONTRACT),
        *keep,
    )
