"""Frames written once to the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import new_folder, path_exists, written_once


#: Rows and bytes that go to a Python worker at a time. Texts are long: Spark's
#: 10,000 rows would hold the same text several times over in JVM and worker.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def bounded_batches(spark: SparkSession, most: int = BATCH_ROWS, most_bytes: int = BATCH_BYTES) -> None:
    """Lowers the session's Arrow batches to the bounds above, or others; never raises them."""
    rows, size = (f"spark.sql.execution.arrow.max{kind}PerBatch" for kind in ("Records", "Bytes"))
    if not 0 < int(spark.conf.get(rows)) <= most:
        spark.conf.set(rows, str(most))
    if not 0 < int(spark.conf.get(size).rstrip("b")) <= most_bytes:
        spark.conf.set(size, f"{most_bytes}b")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet under ``spark.checkpoint.dir``, read back.

    Ends the lineage at files all executors can read, so a lost executor costs
    a re-read, and gives the planner true sizes for the joins that follow.
    """
    bounded_batches(df.sparkSession)
    return written_once(df, label)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_mod(column: str, divisor: int):
    """Remainder of the CRC-32 of a column's text; null where the column is null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


_STORED: dict[tuple, str] = {}


def listing_stamp(spark: SparkSession, path: str) -> tuple:
    """Number, bytes, and a hash of names, lengths and times of the files at a path, by
    one aggregate over their listing; no file is opened."""
    listed = spark.read.format("binaryFile").load(path)
    own = F.xxhash64("path", "length", "modificationTime")
    return tuple(listed.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(own)).first())


def stored_once(df: DataFrame, label: str, path: str) -> DataFrame:
    """``staged``, but the same frame over the unchanged files at ``path`` is written once
    per application."""
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, df.semanticHash(), path, listing_stamp(spark, path))
    if key not in _STORED or not path_exists(spark, _STORED[key]):
        bounded_batches(spark)
        folder = new_folder(spark, label)
        df.write.mode("overwrite").parquet(folder)
        _STORED[key] = folder
    return spark.read.schema(df.schema).parquet(_STORED[key])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
