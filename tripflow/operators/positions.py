"""Positions of rows in a global order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.operators.joins import broadcast_if_small
from tripflow.session import written_once

#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
_WITHIN = 33


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """``ordered``, a frame sorted by ``orderBy``, with the place of every row from 1.

    A range sort leaves every partition sorted and the partitions in order. The
    rows are written once with the number they have within their partition; the
    partitions' counts, one row each, give the offsets that are added. Only the
    counts meet in one task.
    """
    mark = F.monotonically_increasing_id()
    # Partition and number are evaluated in the task that writes the sorted rows.
    numbered = ordered.withColumn("_mark", mark)
    rows = written_once(numbered, "ordered")
    part = F.shiftright("_mark", _WITHIN)
    within = F.col("_mark").bitwiseAND(F.lit((1 << _WITHIN) - 1))
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    placed = rows.withColumn("_part", part).join(broadcast_if_small(offsets), "_part")
    return placed.select(*ordered.columns, (F.col("_offset") + within + 1).alias(name))
