"""The corpus pipeline: from documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
their own columns; the last returns the places of all token pieces. Whatever
columns the documents have pass through unchanged, except that line dedup
rewrites ``text`` and, where it is there, ``n_chars``.

Defined results: language ID drops null texts and texts without letters; line
dedup drops a document only if it deleted lines and left no word; near-dedup
judges rows, not ids, and keeps of each group of near copies one row, that of the
smallest id, one without an id only where no other is; an empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import decontam, language, lines, near, packing
from tripflow.llm.sets import may_hold
from tripflow.llm.work import bounded_batches, fresh, staged, table

_KEY = "_key"
#: Rows and bytes of a batch for Python: its buffers stay with the executors' JVMs and
#: workers, through all stages, so they are smaller here than for a single operator.
_BATCH = 256, 4 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language that could be learned from the labels."""
    bounded_batches(spark, *_BATCH)
    return language.accepted(docs, language.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes lines that stand on many sites from all documents but the first."""
    bounded_batches(spark, *_BATCH)
    marks = fresh(docs, "_marks")
    marked = lines.with_marks(docs, marks)
    left, gone = lines.text_left("text", marks), lines.removed(marks) > 0
    bare = F.translate(F.coalesce(left, F.lit("")), " \t\n\x0b\x0c\r", "")
    new = {"text": left, "n_chars": F.length(left).cast("long")}
    columns = [
        F.when(gone, new[c].cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
        for c in docs.columns
    ]
    return marked.where(~gone | (bare != "")).select(*columns)


def _with_row_keys(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with a key of each row, and whether it is the id. Only where ids
    are missing or stand on several rows, the rows are written with keys of their own."""
    ids = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if ids.isEmpty():
        return docs.withColumn(_KEY, F.col("doc_id").cast("long")), True
    return staged(docs.withColumn(_KEY, F.monotonically_increasing_id()), "keyed"), False


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five words, 0.8."""
    bounded_batches(spark, *_BATCH)
    keyed, by_id = _with_row_keys(docs)
    judged = staged(near.near_duplicates(keyed, words=5, percent=80, id=_KEY), "near")
    if by_id:
        gone = judged.where(~F.col("kept")).select(_KEY)
    else:
        order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*docs.columns).alias("row"), _KEY)
        placed = judged.join(keyed.select(_KEY, order.alias("order")), _KEY)
        first = placed.groupBy("component_id").agg(F.min("order")[_KEY].alias(_KEY))
        gone = judged.select(_KEY).join(first, _KEY, "left_anti")
    gone = staged(gone, "gone")
    # Documents that the filter clears stay where they are; only the others meet the join.
    doubtful = may_hold(gone.toDF("id"))(F.col(_KEY))
    checked = keyed.where(doubtful).join(gone, _KEY, "left_anti")
    return keyed.where(~doubtful).select(*docs.columns).union(checked.select(*docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    bounded_batches(spark, *_BATCH)
    return decontam.without_contained(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the token pieces of all documents."""
    bounded_batches(spark, *_BATCH)
    return packing.digest(packing.pack(docs, keep_ids=False))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Language ID and tokens have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, name)
    return docs
