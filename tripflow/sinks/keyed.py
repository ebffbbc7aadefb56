"""Keyed tables in files: put and get by ``row_key`` without rewriting the table.

Rows are spread over buckets by a hash of their key, one folder a bucket. A put reads
and rewrites the buckets of its keys only; a get opens the buckets of its keys, in
which the filter on the sorted key skips row groups by their statistics and Bloom
filters. The number of buckets is part of the partition column's name
(``bucket_64``), so a table tells it itself.

Replacing a bucket is Spark's dynamic partition overwrite: the table and all other
buckets stay in place throughout, a bucket's files are swapped when its job commits.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.labels import literal
from tripflow.operators import serving
from tripflow.session import path_exists, written_once
from tripflow.sinks import tables

BUCKETS = 64
#: Bytes of a row group: a point read decodes one of them.
ROW_GROUP = 8 << 20

_BUCKET = re.compile(r"bucket_(\d+)")


def bucket_column(table: DataFrame) -> str:
    return next(name for name in table.columns if _BUCKET.fullmatch(name))


def _bucket_of(key: str, column: str) -> str:
    return f"CAST(pmod(xxhash64({key}), {_BUCKET.fullmatch(column)[1]}) AS INT)"


def _arranged(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with their bucket, a task's rows by bucket and key."""
    placed = rows.withColumn(column, F.expr(_bucket_of("row_key", column)))
    return placed.repartition(column).sortWithinPartitions(column, "row_key")


def _writer(rows: DataFrame, column: str, row_group: int):
    return (
        _arranged(rows, column)
        .write.mode("overwrite")
        .partitionBy(column)
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.bloom.filter.enabled#row_key", "true")
        .option("parquet.block.size", row_group)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its bucket column. Families may have come with later
    puts, so the schemas of all files are merged."""
    return spark.read.option("mergeSchema", True).parquet(path)


def put(spark: SparkSession, path: str, puts: DataFrame, buckets: int = BUCKETS, row_group: int = ROW_GROUP) -> DataFrame:
    """Put keyed rows into the table at ``path``, cell by cell; returns the table. Only
    the buckets of the keys put are read and written."""
    if not path_exists(spark, path):
        column = f"bucket_{buckets}"
        _writer(serving.merge_cells(puts, []), column, row_group).parquet(path)
        return read(spark, path)
    stored = read(spark, path)
    column = bucket_column(stored)
    puts = written_once(puts, "puts")
    touched = puts.where("row_key IS NOT NULL").selectExpr(f"{_bucket_of('row_key', column)} AS b").distinct()
    touched = [row.b for row in touched.collect()]  # as many as there are buckets at most
    if touched:
        before = stored.where(F.col(column).isin(touched)).drop(column)
        # Written beside the table first: a folder is not replaced while it is read.
        merged = written_once(serving.upsert(before, puts), "merged")
        _writer(merged, column, row_group).parquet(path)
    return read(spark, path)


def get(table: DataFrame, *keys: str) -> DataFrame:
    """Point read of some keys: their buckets only, the key pushed to the files."""
    column = bucket_column(table)
    wanted = ", ".join(_bucket_of(literal(key), column) for key in keys)
    buckets = f"{column} IN ({wanted})" if keys else "false"
    return serving.get(table.where(buckets), *keys).drop(column)


# Tables of the catalog ---------------------------------------------------------


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {tables.quoted(name)}").where("col_name = 'Location'")
    return rows.first().data_type


def upsert_table(spark: SparkSession, name: str, puts: DataFrame, buckets: int = BUCKETS) -> None:
    """Put keyed rows into a stored table, cell by cell: new keys and families are added.

    The first load creates the table, later ones replace the buckets of their keys
    in place, so a reader finds the table at any time.
    """
    if not spark.catalog.tableExists(name):
        column = f"bucket_{buckets}"
        _writer(serving.merge_cells(puts, []), column, ROW_GROUP).format("parquet").saveAsTable(name)
        return
    stored = spark.table(name).schema
    known = {field.name: field.dataType for field in stored}
    changed = [f.name for f in puts.schema if f.name in known and not _covers(known[f.name], f.dataType)]
    if changed:
        raise ValueError(f"{name}: the table lacks cells that are put into {', '.join(changed)}")
    path = _location(spark, name)
    added = T.StructType([field for field in puts.schema if field.name not in known])
    put(spark, path, puts)
    if len(added):
        spark.sql(f"ALTER TABLE {tables.quoted(name)} ADD COLUMNS ({added.toDDL()})")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def _covers(stored: T.DataType, new: T.DataType) -> bool:
    if isinstance(stored, T.StructType) and isinstance(new, T.StructType):
        return set(new.fieldNames()) <= set(stored.fieldNames())
    return isinstance(stored, T.StructType) == isinstance(new, T.StructType)
