"""Line dedup by distinct-site spread.

Lines are compared by a 128-bit hash of their trimmed text. Lines, however
short, that occur at least ``MIN_SITES`` times get a HyperLogLog sketch of their
sites, merged by aggregation; where an estimate is within
``BAND`` of the threshold, the sites are counted exactly. A line on at least
``MIN_SITES`` sites is boilerplate: it stays in the document with the smallest
id that has it and is deleted from all others.

Defined results: a null text stays null and has no lines, an empty one has one
blank line; blank lines always stay; a null site counts as no site;
rows that share an id are one document; rows without an id count for the spread
but keep their lines; an empty table gives no rows. Columns named like the
results are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.work import fresh, staged, table

MIN_SITES = 5
#: log2 of the registers of a sketch; its standard error is about 3 %.
REGISTERS = 10
BAND = 0.2
#: Spread lines (24 bytes each) that are sent to the executors at most; more are joined.
TABLE = 500_000
_NO_ID = -(1 << 63)
SPACES = " \t\r\x0b\x0c"

_HASHES = ["h1", "h2"]


def _trimmed(line):
    return F.btrim(line, F.lit(SPACES))


def line_rows(docs: DataFrame, id: str, text: str, site: str, min_words: int = 1) -> DataFrame:
    """(id, site, h1, h2) of every line that is not blank and has ``min_words`` words."""
    lines = docs.select(
        F.col(id).alias("id"), F.col(site).alias("site"), F.explode(F.split(text, "\n")).alias("line")
    ).withColumn("line", _trimmed("line"))
    lines = lines.where("line <> ''")
    if min_words > 1:
        lines = lines.where(F.size(F.split("line", f"[{SPACES}]+", min_words)) >= min_words)
    return lines.select(
        "id", "site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(h1, h2, first) of the lines on at least ``min_sites`` sites; ``first`` is
    the smallest id that has the line."""
    often = lines.groupBy(*_HASHES).agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
    often = staged(often.select(*_HASHES), "often")
    sketched = (
        lines.join(often, _HASHES)
        .groupBy(*_HASHES)
        .agg(
            F.hll_sketch_agg(F.col("site").cast("string"), REGISTERS).alias("sketch"),
            F.min("id").alias("first"),
        )
        .select(*_HASHES, "first", F.hll_sketch_estimate("sketch").alias("sites"))
    )
    sketched = staged(sketched, "sketched")
    low, high = min_sites * (1 - BAND), min_sites * (1 + BAND) + 1
    near = sketched.where(F.col("sites").between(low, high))
    counted = (
        lines.where("site IS NOT NULL")
        .join(near.select(*_HASHES), _HASHES, "left_semi")
        .groupBy(*_HASHES, "site")
        .agg(F.lit(1).alias("one"))
        .groupBy(*_HASHES)
        .agg(F.count("*").alias("exact"))
    )
    settled = near.join(counted, _HASHES).where(F.col("exact") >= min_sites)
    above = sketched.where(F.col("sites") > high)
    return staged(above.select(*_HASHES, "first").union(settled.select(*_HASHES, "first")), "spread")


def _hashes_of(text):
    """Both hashes of every line of a text, as ``line_rows`` takes them."""
    every = F.split(text, "\n")
    return [
        F.transform(every, lambda line: F.xxhash64(_trimmed(line))),
        F.transform(every, lambda line: F.xxhash64(F.lit(1), _trimmed(line))),
    ]


def _marked_by_table(docs: DataFrame, spread: DataFrame, id: str, text: str, into: str) -> DataFrame:
    """Lines looked up in a table sent to every executor; texts are not shuffled, and
    only hashes and ids go to the lookup. For at most ``TABLE`` spread lines."""
    found = spread.select(*_HASHES, F.coalesce("first", F.lit(_NO_ID)).alias("first")).toPandas()
    found = found.sort_values(_HASHES)
    h1, h2, first = (found[c].to_numpy(np.int64) for c in (*_HASHES, "first"))
    # Lines of one first hash stand side by side.
    alike = int(np.unique(h1, return_counts=True)[1].max(initial=0))

    @F.arrow_udf("array<boolean>")
    def goes(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for one, two, ids in columns:
            ones, twos = one.flatten().to_numpy(), two.flatten().to_numpy()
            sizes = one.value_lengths().fill_null(0).to_numpy()
            gone = np.zeros(len(ones), bool)
            # A row without an id keeps its lines: it passes for every first.
            owner = np.repeat(ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False), sizes)
            start = np.searchsorted(h1, ones)
            for step in range(alike):
                at = np.minimum(start + step, len(h1) - 1)
                same = (h1[at] == ones) & (h2[at] == twos)
                gone |= same & (first[at] != owner) & (owner != _NO_ID)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(gone))

    # Not called anew in a filter on its result, which would take two more workers a task.
    goes = goes.asNondeterministic()
    return docs.withColumn(into, goes(*_hashes_of(F.col(text)), F.col(id).cast("long")))


def _marked_by_join(docs: DataFrame, spread: DataFrame, lines: DataFrame, id: str, text: str, into: str) -> DataFrame:
    """The same by a join on the id, for spread lines of any number."""
    own = fresh(docs, "_id")
    gone = (
        lines.where("id IS NOT NULL")
        .join(spread, _HASHES)
        .where("id <> first OR first IS NULL")
        .groupBy(F.col("id").alias(own))
        .agg(F.collect_set(F.struct(*_HASHES)).alias(into))
    )
    joined = docs.join(staged(gone, "gone"), docs[id] == F.col(own), "left")
    pairs = F.arrays_zip(*(hashes.alias(name) for hashes, name in zip(_hashes_of(F.col(text)), _HASHES)))
    goes = F.transform(pairs, lambda pair: F.coalesce(F.array_contains(F.col(into), pair), F.lit(False)))
    return joined.withColumn(into, goes).drop(own)


def with_marks(
    docs: DataFrame, into: str, id: str = "doc_id", text: str = "text", site: str = "source",
    min_sites: int = MIN_SITES, min_words: int = 1,
) -> DataFrame:
    """``docs`` with a column that tells of every line of ``text`` whether it goes."""
    lines = line_rows(docs, id, text, site, min_words)
    spread = spread_lines(lines, min_sites)
    if spread.count() <= TABLE:
        return _marked_by_table(docs, spread, id, text, into)
    return _marked_by_join(docs, spread, lines, id, text, into)


def text_left(text: str, marks: str):
    """What is left of a text without its marked lines."""
    every = F.split(F.col(text), "\n")
    left = F.filter(every, lambda line, k: ~F.get(F.col(marks), k))
    return F.when(F.col(text).isNotNull(), F.array_join(left, "\n"))


def removed(marks: str):
    """The number of marked lines."""
    return F.coalesce(F.size(F.filter(F.col(marks), lambda goes: goes)), F.lit(0))


def dedup_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", site: str = "source",
    min_sites: int = MIN_SITES, min_words: int = 1,
) -> DataFrame:
    """``docs`` with boilerplate deleted from ``text``, and n_lines, n_removed."""
    docs = docs.drop("n_lines", "n_removed")
    marks = fresh(docs, "_marks")
    marked = with_marks(docs, marks, id, text, site, min_sites, min_words)
    lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(F.col(text), "\n")))
    return marked.withColumns(
        {
            "n_lines": lines.cast("long"),
            "n_removed": F.when(F.col(text).isNull(), 0).otherwise(removed(marks)).cast("long"),
            text: text_left(text, marks),
        }
    ).drop(marks)


def op8_linededup(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = dedup_lines(documents)
    return found.select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_left"),
        F.md5("text").alias("text_md5"),
    )


ORACLE_SQL = f"""
    WITH body AS (SELECT row_number() OVER () AS r, * FROM documents),
    parts AS (SELECT r, doc_id, source, string_split(text, chr(10)) AS ls FROM body),
    lines AS (
      SELECT r, doc_id, source, k, ls[k] AS line,
             trim(ls[k], ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare
      FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS k FROM parts)),
    spread AS (
      SELECT bare, min(doc_id) AS first FROM lines WHERE bare <> ''
      GROUP BY bare HAVING count(DISTINCT source) >= {MIN_SITES}),
    kept AS (
      SELECT j.r, count(*) AS n_lines,
             count(*) FILTER (s.bare IS NOT NULL AND j.doc_id <> s.first) AS n_removed,
             string_agg(line, chr(10) ORDER BY k) FILTER (s.bare IS NULL OR j.doc_id = s.first) AS t
      FROM lines j LEFT JOIN spread s ON j.bare <> '' AND j.bare = s.bare GROUP BY j.r)
    SELECT b.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
           CAST(length(CASE WHEN b.text IS NOT NULL THEN coalesce(t, '') END) AS BIGINT) AS n_chars_left,
           md5(CASE WHEN b.text IS NOT NULL THEN coalesce(t, '') END) AS text_md5
    FROM body b LEFT JOIN kept USING (r)"""
