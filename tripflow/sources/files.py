"""Readers for trip files, the zone table and exported results."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators.enrich import zone_dimension
from tripflow.schema import (
    FACT_COLUMNS,
    RAW_COLUMNS,
    RAW_TEXT_SCHEMA,
    RESULT_SCHEMAS,
    conform,
)
from tripflow.sources.footers import files_by_schema

_ZONE_TEXT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("location_id", "borough", "zone", "service_zone", "malformed")
    ]
)


def read_source(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One source path, every file of it held to the column contract by itself.

    Of a folder or glob Spark takes one footer for the schema of all files; a
    file without a column would turn into nulls. Here tasks read every footer in
    one job, and files of equal layout are scanned together. ``keep`` are further
    expressions over the scan, such as ``_metadata.file_path AS file_path``.
    """
    layouts = files_by_schema(spark, path)
    if not layouts:
        return conform(spark.read.parquet(path), path, keep)
    # Checked before anything is read: the error names the first deficient file.
    parts = [
        conform(spark.read.schema(schema).parquet(*alike), alike[0], keep) for schema, alike in layouts
    ]
    return reduce(DataFrame.unionByName, parts)


def read_source_months(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Monthly source files or folders as one frame.

    Every file is held to the column contract by itself, so one file without
    a column stops the job instead of turning into nulls, and files whose
    types differ (whole or fractional passenger counts) still line up.
    """
    months = [read_source(spark, path) for path in paths]
    if not months:
        raise ValueError("no source files given")
    return reduce(DataFrame.unionByName, months)


def read_trips_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headerless delimited trips; globs such as ``raw/trips/*/*`` are allowed.

    A field that does not fit its type becomes null, a short line is padded
    with nulls and fields past the nineteenth are cut; no line fails the job.
    """
    return (
        spark.read.schema(RAW_TEXT_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("header", False)
        .csv(path)
    )


#: Causes of a line that does not fit the layout, tested in this order.
_CAUSES = {
    "too few fields": f"fields < {len(RAW_COLUMNS)}",
    "too many fields": f"fields > {len(RAW_COLUMNS)}",
    "value does not fit": "trip._unread IS NOT NULL",
}


def read_trips_text_checked(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``read_trips_text`` with ``fault``: why a line does not fit the layout, null for
    a sound line. Trips and faults come from the same scan.

    The CSV reader itself pads short lines and cuts long ones without a word, so the
    lines are read as text, their fields counted (a separator within quotes is none)
    and the values parsed by the same rules.
    """
    lines = spark.read.text(path).where("value <> ''")
    bare = """regexp_replace(value, '"[^"]*"', '')"""
    schema = T.StructType([*RAW_TEXT_SCHEMA, T.StructField("_unread", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unread"}
    parsed = lines.select(
        F.from_csv("value", schema.toDDL(), options).alias("trip"),
        F.expr(f"size(split({bare}, ','))").alias("fields"),
    )
    fault = " ".join(f"WHEN {test} THEN '{cause}'" for cause, test in _CAUSES.items())
    return parsed.selectExpr(*(f"trip.{name}" for name in RAW_COLUMNS), f"CASE {fault} END AS fault")


def lines_by_fault(trips: DataFrame) -> DataFrame:
    """Per cause (``sound`` for none) the lines, and how many still tell a fare and a pickup."""
    return trips.groupBy(F.coalesce("fault", F.lit("sound")).alias("fault")).agg(
        F.count("*").alias("n_lines"),
        F.count("fare_amount").alias("with_fare"),
        F.count("pickup_dt").alias("with_pickup"),
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same files as whole lines, with the number of fields in each."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    return lines.filter(F.col("line") != "").withColumn("fields", F.split("line", ","))


def lines_to_zone_hours(lines: DataFrame) -> DataFrame:
    """Text-line view for the zone-hour count: lines of at least 19 fields keep
    their pickup time and zone, shorter ones come out null and count as bad."""
    complete = F.size("fields") >= len(RAW_COLUMNS)

    def field(name: str):
        return F.when(complete, F.get("fields", RAW_COLUMNS.index(name)))

    return lines.select(field("pickup_dt").alias("pickup_dt"), field("pu_loc_id").alias("pu_loc_id"))


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trips written by this engine; ``year`` and ``month`` stay when landed so."""
    return spark.read.parquet(path)


def read_zones(spark: SparkSession, path: str, complete_only: bool = False) -> DataFrame:
    """Zone dimension from its CSV file with header and quoted fields.

    Rows without a numeric key are left out and the text ``N/A`` stays, because
    it is data. A row with fewer than four fields is padded with nulls, or left
    out with ``complete_only``, as the serving load wants it.
    """
    text = (
        spark.read.schema(_ZONE_TEXT)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "malformed")
        .csv(path)
    )
    if complete_only:
        text = text.filter("malformed IS NULL OR service_zone IS NOT NULL")
    return zone_dimension(text)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*FACT_COLUMNS)


def read_result(spark: SparkSession, name: str, path: str, sep: str = ",") -> DataFrame:
    """An exported result directory with its declared columns.

    A missing path raises Spark's AnalysisException.
    """
    reader = spark.read.schema(RESULT_SCHEMAS[name]).option("sep", sep).option("nullValue", "\\N")
    return reader.csv(path)
