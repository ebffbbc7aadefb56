"""Benchmark decontamination by greedy string tiling.

The items of the benchmark are taken in blocks of bounded size. The hashes of
their runs of ``MIN_MATCH`` words are the seeds; every document is read once
per block, and where it holds seeds of an item, the two are tiled: the longest
runs of equal words that are not marked yet are marked first, found by running
Karp-Rabin hashes of decreasing length, down to ``MIN_MATCH`` words. An item
counts as contained when its tiles cover at least ``PERCENT`` of its words, in
whatever order they stand in the document.

Documents are never shuffled; what is sent to the executors is one block,
bounded by ``BLOCK_WORDS`` words (a longer item is a block of its own). A
benchmark of any size is read block by block, by its Spark partitions.

Defined results: null and blank texts contain nothing; an item without words is
never contained, one of fewer than ``MIN_MATCH`` words if it stands whole in the
document; items of equal text are all reported; rows without an id are reported
with a null id; repeated document rows are reported each; empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import WordHasher, shingles
from tripflow.llm.work import table

MIN_MATCH = 5
PERCENT = 80
BLOCK_WORDS = 1_000_000

MATCHES = (
    "doc_id long, item_id long, item_words int, covered_words int, coverage double, "
    "tiles array<struct<item_start:int,doc_start:int,length:int>>"
)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    return shingles(words, size) if len(words) >= size else words[:0]


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Non-overlapping runs of equal words (item start, doc start, length), longest
    first, ties by place in the item, then in the document."""
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    found: list[tuple[int, int, int]] = []
    if len(item) < least or len(doc) < least:
        return found
    size = _longest(item, doc, least, free_item, free_doc)
    while size >= least:
        in_item, in_doc = _runs(item, size), _runs(doc, size)
        whole_item = _all_free(free_item, size)
        whole_doc = _all_free(free_doc, size)
        places: dict[int, list[int]] = {}
        for at in np.flatnonzero(whole_doc & np.isin(in_doc, in_item[whole_item])):
            places.setdefault(int(in_doc[at]), []).append(int(at))
        for start in np.flatnonzero(whole_item & np.isin(in_item, in_doc[whole_doc])):
            if not free_item[start : start + size].all():
                continue
            for at in places.get(int(in_item[start]), ()):
                if free_doc[at : at + size].all():
                    free_item[start : start + size] = False
                    free_doc[at : at + size] = False
                    found.append((int(start), at, size))
                    break
        # The longest run left is shorter: nothing of this size is unmarked on both sides.
        size = _longest(item, doc, least, free_item, free_doc, size - 1)
    return found


def _all_free(free: np.ndarray, size: int) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(free)])
    return sums[size:] - sums[:-size] == size


def _longest(item, doc, least, free_item, free_doc, most: int | None = None) -> int:
    """Length of the longest unmarked run in common, by bisection: every run
    contains the shorter ones. ``least`` - 1 if there is none."""
    low, high = least - 1, min(len(item), len(doc)) if most is None else most
    while low < high:
        middle = (low + high + 1) // 2
        ours = _runs(item, middle)[_all_free(free_item, middle)]
        theirs = _runs(doc, middle)[_all_free(free_doc, middle)]
        if len(ours) and np.isin(ours, theirs).any():
            low = middle
        else:
            high = middle - 1
    return low


class Block:
    """Items of a benchmark and the index of their seeds."""

    def __init__(self, items: list[tuple[int, np.ndarray]]) -> None:
        self.ids = [number for number, _ in items]
        self.words = [words for _, words in items]
        self.least = [min(MIN_MATCH, len(words)) for words in self.words]
        seeds: dict[int, tuple[list, list]] = {}
        for place, words in enumerate(self.words):
            own = np.unique(_runs(words, self.least[place]))
            hashes, places = seeds.setdefault(self.least[place], ([], []))
            hashes.append(own)
            places.append(np.full(len(own), place))
        self.seeds = {}
        for size, (hashes, places) in seeds.items():
            flat, owners = np.concatenate(hashes), np.concatenate(places)
            order = np.argsort(flat, kind="stable")
            self.seeds[size] = flat[order], owners[order]

    def contained(self, doc: np.ndarray) -> Iterator[tuple]:
        """(item id, words, covered, coverage, tiles) of the items in a document."""
        for size, (hashes, owners) in self.seeds.items():
            runs = _runs(doc, size)
            place = np.searchsorted(hashes, runs)
            place[place == len(hashes)] = 0
            hits = np.flatnonzero(hashes[place] == runs)
            if not len(hits):
                continue
            near = np.unique(runs[hits])
            first, last = np.searchsorted(hashes, near), np.searchsorted(hashes, near, "right")
            found = np.unique(np.concatenate([owners[a:b] for a, b in zip(first, last)]))
            for item in found:
                words = self.words[item]
                # Words around the seeds of this item: all that its tiles can touch.
                own = hits[np.isin(runs[hits], _runs(words, size))]
                kept = np.zeros(len(doc) + 1, np.int64)
                np.add.at(kept, own, 1)
                np.add.at(kept, own + size, -1)
                spots = np.flatnonzero(np.cumsum(kept)[:-1] > 0)
                if 100 * min(len(spots), len(words)) < PERCENT * len(words):
                    continue
                parts, where = _with_gaps(doc, spots)
                marked = tiles(words, parts, size)
                covered = sum(length for _, _, length in marked)
                if 100 * covered >= PERCENT * len(words):
                    placed = sorted((i, int(where[d]), n) for i, d, n in marked)
                    yield self.ids[item], len(words), covered, covered / len(words), placed


def _with_gaps(doc: np.ndarray, spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words at ``spots`` with a word that equals no other wherever some are
    left out, and the place of each in the document."""
    breaks = np.flatnonzero(np.diff(spots) > 1) + 1
    gaps = np.random.default_rng(len(spots)).integers(0, 1 << 63, len(breaks), dtype=np.uint64)
    return np.insert(doc[spots], breaks, gaps), np.insert(spots, breaks, -1)


def benchmark_blocks(benchmark: DataFrame, text: str = "text") -> Iterator[list[tuple[int, np.ndarray]]]:
    """Items as (id, word hashes), ``BLOCK_WORDS`` words at a time; the driver
    holds one block and one partition of the benchmark."""
    hasher = WordHasher()
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col(text).alias("text"))
    for row in rows.toLocalIterator():
        words = hasher.of(np.frombuffer((row[1] or "").encode(), np.uint8))
        if not len(words):
            continue
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    if block:
        yield block


def _in_block(rows: DataFrame, items: list[tuple[int, np.ndarray]]) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, hasher = Block(sent.value), WordHasher()
        for batch in batches:
            ids, found = batch.column(0).to_pylist(), []
            for doc_id, words in zip(ids, hasher.each(batch.column(1))):
                found += [(doc_id, *match) for match in block.contained(words)]
            columns = list(zip(*found)) or [()] * 6
            tile = pa.struct([(n, pa.int32()) for n in ("item_start", "doc_start", "length")])
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.list_(tile)]
            spans = [[dict(zip(("item_start", "doc_start", "length"), t)) for t in s] for s in columns[5]]
            arrays = [pa.array(c, k) for c, k in zip([*columns[:5], spans], kinds)]
            names = ["doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, MATCHES)


def contained_items(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document and benchmark item it contains, with the tiles."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for items in benchmark_blocks(benchmark):
        part = _in_block(rows, items)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], MATCHES)


def without_contained(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, all columns kept."""
    for items in benchmark_blocks(benchmark):
        docs = docs.where(~_contains(docs.sparkSession, items)(F.col(text)))
    return docs


def _contains(spark, items: list[tuple[int, np.ndarray]]):
    sent = spark.sparkContext.broadcast(items)

    @F.arrow_udf("boolean")
    def contains(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block, hasher = Block(sent.value), WordHasher()
        for column in columns:
            found = [any(True for _ in block.contained(words)) for words in hasher.each(column)]
            yield pa.array(found, pa.bool_())

    return contains


def op2_decontam(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contained_items(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_id", "item_words", "covered_words", "coverage", F.size("tiles").alias("n_tiles")
    )
