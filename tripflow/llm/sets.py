"""Shingle sets of texts, and a filter of fixed size for the ids that are wanted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import WordHasher, shingles

#: Bits of the filter that keeps texts out of the shuffle to their pairs.
FILTER_BITS = 1 << 23

SETS = "id long, n long, members array<long>"


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """The full shingle set of every (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            # A set can be larger than its text: return few rows at a time.
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sets = [np.unique(shingles(w, words)) for w in hasher.each(part.column(1))]
                sizes = np.array([len(s) for s in sets], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                members = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), members], ["id", "n", "members"]
                )

    return docs.mapInArrow(run, SETS)


def _filter_words(ids: DataFrame) -> DataFrame:
    """(word, bits) of a filter of ``FILTER_BITS`` bits: one for the hash of every id."""
    bit = f"pmod(xxhash64(id), {FILTER_BITS})"
    return ids.groupBy(F.expr(f"shiftright({bit}, 6) AS word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod({bit}, 64) AS INT))")).alias("bits")
    )


def held(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids``. The filter keeps other rows where they
    are; the semi-join behind it is exact.

    The filter is a broadcast of at most ``FILTER_BITS`` / 64 rows: a Python function here
    would cost another worker per task beside those that work on the texts.
    """
    bit = f"pmod(xxhash64(id), {FILTER_BITS})"
    meets = f"shiftright({bit}, 6) = word AND shiftright(bits, CAST(pmod({bit}, 64) AS INT)) & 1L = 1L"
    return docs.join(F.broadcast(_filter_words(ids)), F.expr(meets), "left_semi").join(ids, "id", "left_semi")


def may_hold(ids: DataFrame):
    """A test of ids that passes all of ``ids`` and few others: one bit per hash.

    Its size is fixed by ``FILTER_BITS``; with very many ids it passes more, never less.
    """
    words = _filter_words(ids)
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.collect():
        table[row.word] = row.bits
    table = table.view(np.uint64)

    @F.arrow_udf("boolean")
    def held(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            at = column.to_numpy(zero_copy_only=False).astype(np.int64)
            found = (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield pa.array(found.astype(bool))

    return lambda id: held(F.pmod(F.xxhash64(id), F.lit(FILTER_BITS)))
