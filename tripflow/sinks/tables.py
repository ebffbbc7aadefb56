"""Landing, tables, partitions and exports."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.labels import literal
from tripflow.sources.files import read_source

Month = tuple[str, str]

#: Most rows of one exported file.
ROWS_PER_FILE = 10_000_000

_MONTH_IN_NAME = re.compile(r"(\d{4})-(0[1-9]|1[0-2])(?=\.|$)")
#: The same in the last folder or the file name of a whole path, as Spark's text.
_MONTH_IN_PATH = r"(\\d{4})-(0[1-9]|1[0-2])(?=[.][^/]*$|/[^/]*$|[.][^/]*/[^/]*$|$)"


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def file_month(path: str) -> Month:
    """Year and month in a name such as ``trips_2026-01.parquet``."""
    found = _MONTH_IN_NAME.search(path.rstrip("/").rsplit("/", 1)[-1])
    if not found:
        raise ValueError(f"{path}: no YYYY-MM in the file name")
    return found.group(1), found.group(2)


def month_folder(root: str, month: Month) -> str:
    return f"{root}/year={month[0]}/month={month[1]}"


def land_months(
    spark: SparkSession,
    paths: Iterable[str],
    root: str,
    read: Callable[[SparkSession, str], DataFrame] = read_source,
) -> list[Month]:
    """Land source files under ``root/year=YYYY/month=MM``; returns the months.

    The month is the one in the name of the given file or folder, whatever the
    rows say. All files are held to the contract before anything is written, and
    all months are written by one job. Only the months being landed are replaced,
    even by a file without rows, so a month can be landed again. Nothing is
    shuffled. ``read`` is the reader of one path; ``read_trips_text`` takes
    headerless text.
    """
    months = [(file_month(path), path) for path in paths]
    parts = []
    for (year, month), path in months:
        parts.append(read(spark, path).withColumns({"year": F.lit(year), "month": F.lit(month)}))
    if not parts:
        return []
    seen = Observation("months")
    landed = sorted({month for month, _ in months})
    counts = [
        F.count_if((F.col("year") == year) & (F.col("month") == month)).alias(f"{year}-{month}")
        for year, month in landed
    ]
    together = reduce(DataFrame.unionByName, parts)
    _land(together.observe(seen, *counts), root)
    for month in landed:
        if not seen.get["-".join(month)]:  # a month without rows has no partition to replace
            nothing = together.drop("year", "month").limit(0)
            nothing.write.mode("overwrite").parquet(month_folder(root, month))
    return landed


def land_files(spark: SparkSession, path: str, root: str) -> None:
    """Land all files of a folder or glob in one job, each under the month in its own
    name or that of its folder, told by the scan. A file without one fails the job."""
    rows = read_source(spark, path, keep=("_metadata.file_path AS _file",))
    found = "regexp_extract(_file, '{}', {})"
    year, month = (found.format(_MONTH_IN_PATH, group) for group in (1, 2))
    refused = "raise_error(concat(_file, ': no YYYY-MM in the file name'))"
    dated = rows.selectExpr("*", f"if({year} = '', {refused}, {year}) AS year", f"{month} AS month")
    _land(dated.drop("_file"), root)


def _land(dated: DataFrame, root: str) -> None:
    """Write the months of ``dated`` (year, month), leaving others as they are."""
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year", "month").parquet(root)


def store(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a stage as Parquet; an existing target is refused by default."""
    df.write.mode(mode).parquet(path)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def rename_table(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(name)} RENAME TO {quoted(to)}")


def save_table(df: DataFrame, name: str, fmt: str = "orc", by: tuple[str, ...] = ()) -> None:
    """Managed columnar table from a frame, replacing one of that name."""
    df.write.format(fmt).mode("overwrite").partitionBy(*by).saveAsTable(name)


def register_external(
    spark: SparkSession, name: str, path: str, schema: T.StructType, by_month: bool = False
) -> None:
    """Table over files already in place; dropping it leaves them there.

    ``by_month`` is for files in month folders: ``year`` and ``month`` become
    partition columns after those of ``schema``.
    """
    drop_table(spark, name)
    columns = schema.toDDL()
    layout = ""
    if by_month:
        columns, layout = f"{columns}, year INT, month INT", "PARTITIONED BY (year, month)"
    spark.sql(
        f"CREATE TABLE {quoted(name)} ({columns}) USING parquet {layout} LOCATION {literal(path)}"
    )
    if by_month:
        spark.sql(f"MSCK REPAIR TABLE {quoted(name)}")


def drop_partitions(spark: SparkSession, name: str, **values: str) -> int:
    """Remove the partitions with these values; returns how many there were.

    ``drop_partitions(spark, "raw.trips", year="2024")`` removes the whole
    year, with its files when the table is managed.
    """
    given = ", ".join(f"`{column}` = {literal(value)}" for column, value in values.items())
    found = spark.sql(f"SHOW PARTITIONS {quoted(name)} PARTITION ({given})").collect()
    for row in found:
        parts = (part.split("=", 1) for part in row.partition.split("/"))
        spec = ", ".join(f"`{column}` = {literal(value)}" for column, value in parts)
        spark.sql(f"ALTER TABLE {quoted(name)} DROP IF EXISTS PARTITION ({spec})")
    return len(found)


def months_of(spark: SparkSession, name: str) -> DataFrame:
    """(year, month) of the partitions a table has, from the catalog."""
    parts = spark.sql(f"SHOW PARTITIONS {quoted(name)}")
    number = "CAST(regexp_extract(partition, '(^|/){}=([0-9]+)', 2) AS INT) AS {}"
    return parts.selectExpr(number.format("year", "year"), number.format("month", "month"))


def export_text(
    df: DataFrame, path: str, one_file: bool = False, sep: str = ",", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Delimited export without header, replacing the directory.

    No file has more than ``rows_per_file`` rows. ``one_file`` merges the parts of a
    result that fits into one file, for a reader that wants a single one; a larger
    frame is written by as many tasks as it needs files, so no task holds it all.
    """
    if one_file:
        df = df.coalesce(1) if df.count() <= rows_per_file else df
    (
        df.write.mode("overwrite")
        .option("sep", sep)
        .option("nullValue", "\\N")
        .option("emptyValue", "")
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
