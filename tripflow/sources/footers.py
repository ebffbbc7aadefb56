"""Layouts of Parquet files, read from their footers by tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LAYOUTS = "path string, layout string, n_rows long"


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of every file under a path or glob. The content is not asked for, so no
    file is opened."""
    return spark.read.format("binaryFile").load(path).select("path")


def footers(files: DataFrame) -> DataFrame:
    """(path, layout, n_rows) per file: a digest of its column names and stored types, and
    its rows. Null where the tasks cannot open the store."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        def opened(path: str):
            if path.startswith("file:"):
                return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
            return fs.FileSystem.from_uri(quote(path, safe=":/@"))

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    store, inner = opened(path)
                    with store.open_input_file(inner) as file:
                        found = parquet.ParquetFile(file)
                        columns = [found.schema.column(k) for k in range(len(found.schema.names))]
                        text = "\n".join(f"{c.path} {c.physical_type} {c.logical_type}" for c in columns)
                        rows.append((path, hashlib.sha256(text.encode()).hexdigest(), found.metadata.num_rows))
                except (OSError, pa.ArrowException, NotImplementedError):
                    rows.append((path, None, None))
            kinds = [pa.string(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) or [(), (), ()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["path", "layout", "n_rows"])

    return files.mapInArrow(read, LAYOUTS)


def files_by_schema(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """The files under a path, those of one layout together with their schema, in order
    of their first file.

    One job reads all footers; Spark then infers one schema per layout, so its own rules
    decide the types. Files in a store that only Spark can open are each a layout.
    """
    rows = footers(listed_files(spark, path)).select("path", "layout").collect()
    alike: dict[str, list[str]] = {}
    for row in sorted(rows):
        alike.setdefault(row.layout or row.path, []).append(row.path)
    return [(spark.read.parquet(names[0]).schema, names) for names in alike.values()]
