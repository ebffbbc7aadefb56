"""Joins with a dimension whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only up to this many rows and characters.
MAX_ROWS = 100_000
MAX_CHARACTERS = 32_000_000

_CHECKED: dict[tuple, bool] = {}


def _stamps(dimension: DataFrame) -> frozenset | None:
    """Length and modification time of every file read; None if there is none."""
    spark = dimension.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = set()
    for name in dimension.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        found.add((name, status.getLen(), status.getModificationTime()))
    return frozenset(found) or None


def is_small(dimension: DataFrame) -> bool:
    """Whether a dimension is within both bounds.

    Counts it in one distributed aggregate, of which every task sends one row.
    The answer is kept only for a frame read from files, and for as long as
    none of them changes in length or time. Spark's own estimate is no
    substitute: it takes a join of two small tables for the product of their
    file sizes.
    """
    stamps = _stamps(dimension)
    application = dimension.sparkSession.sparkContext.applicationId
    key = (application, dimension.semanticHash(), stamps, MAX_ROWS, MAX_CHARACTERS)
    if stamps is None or key not in _CHECKED:
        found = size_of(dimension).first()
        small = found.n <= MAX_ROWS and found.characters <= MAX_CHARACTERS
        if stamps is None:
            return small
        _CHECKED[key] = small
    return _CHECKED[key]


def size_of(dimension: DataFrame) -> DataFrame:
    """Rows and characters of a frame."""
    return dimension.selectExpr("length(to_json(struct(*))) AS size").selectExpr(
        "count(1) AS n", "coalesce(sum(size), 0) AS characters"
    )


def broadcast_if_small(dimension: DataFrame) -> DataFrame:
    """The dimension marked for broadcast, or as it is when it is too large.

    In the second case Spark shuffles both sides and adaptive execution splits
    the partitions of hot keys.
    """
    return F.broadcast(dimension) if is_small(dimension) else dimension
