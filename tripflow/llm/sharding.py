"""Sharding by a k-d tree over document metadata, in DataFrame functions only.

A node splits at the weighted median of its widest metadata dimension: the
rows are ordered by the dimension's coordinate, and half of the node's bytes
(or the share of the leaves on that side) lie before the cut. All nodes of a
level split together. The median is found by refining histograms: each round
groups the rows of every node into at most ``BINS`` bins of the interval that
still holds the cut, with one combined row per task, node and bin, and keeps
the one bin in which the cut lies, until that bin holds one coordinate or next
to nothing. The driver sees ``BINS`` times the number of nodes, no more.

A coordinate is the metadata value in its upper bits (size, hash of source,
hash of language), then a hash of id and text, and last a hash of the row's
number, which is written once together with the coordinates. So rows of equal
metadata, of one huge source, without ids or repeated can be cut anywhere, and
distinct rows are cut alike whatever their order. Shard sizes differ by about one
row. Equal texts are not kept together: a group of copies may be larger than a
shard, and the law ``bytes`` holds for any input.

Defined results: a null text has size 1 (no bytes plus one) and a null checksum;
null metadata is a value like any other; rows without an id and repeated rows are
rows of their own; an empty table has no rows in any shard; further columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.work import partitions, staged, table

SHARDS = 16
BINS = 256
#: A bin with less than this share of a node's bytes ends the search.
FINE = 1e-5
#: Coordinates are below 2 to this power; the lower bits part equal values.
_BITS, _TIE_BITS = 62, 40
#: Of the lower bits those that part rows of equal id and text.
_ROW_BITS = 16

DIMENSIONS = ("by_size", "by_source", "by_lang")


@dataclass
class Node:
    """A part of the documents: its number, its leaves, and where it is cut."""

    number: int
    first_shard: int
    shards: int
    dimension: str | None = None
    cut: int | None = None


def coordinates(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, tie, node, one coordinate per dimension)."""
    own = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << (_TIE_BITS - _ROW_BITS)))
    row = F.pmod(F.xxhash64("_row"), F.lit(1 << _ROW_BITS))
    tie = own * F.lit(1 << _ROW_BITS) + row
    docs = docs.withColumn("_row", F.monotonically_increasing_id())
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    top = 1 << (_BITS - _TIE_BITS)

    def coordinate(value):
        return value * F.lit(1 << _TIE_BITS) + tie

    hashed = {c: F.pmod(F.xxhash64(F.lit(7), c), F.lit(top)) for c in ("source", "lang")}
    # Sizes span many magnitudes: 16 steps from each power of two to the next.
    step = F.least(F.floor(F.log2(size.cast("double")) * F.lit(16)).cast("long"), F.lit(top - 1))
    return docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        tie.alias("tie"),
        F.lit(1).alias("node"),
        coordinate(step).alias("by_size"),
        coordinate(hashed["source"]).alias("by_source"),
        coordinate(hashed["lang"]).alias("by_lang"),
    )


def _widest(rows: DataFrame, nodes: list[Node]) -> tuple[dict[int, int], dict[int, tuple[int, int]]]:
    """Chooses every node's dimension; returns bytes and coordinate range by node.

    A dimension's width is its range as a share of the range over all documents.
    """
    ends = [end for d in DIMENSIONS for end in (F.min(d).alias(f"low_{d}"), F.max(d).alias(f"high_{d}"))]
    found = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()}
    whole = {
        d: max((r[f"high_{d}"] for r in found.values()), default=0)
        - min((r[f"low_{d}"] for r in found.values()), default=0)
        for d in DIMENSIONS
    }
    sizes, ranges = {}, {}
    for node in nodes:
        if node.number in found:
            row = found[node.number]
            span = {d: row[f"high_{d}"] - row[f"low_{d}"] for d in DIMENSIONS}
            node.dimension = max(DIMENSIONS, key=lambda d: span[d] / max(1, whole[d]))
            sizes[node.number] = row["bytes"]
            ranges[node.number] = (row[f"low_{node.dimension}"], row[f"high_{node.dimension}"])
    return sizes, ranges


def _by_node(values: dict[int, object], kind: str):
    """A column with a value for each row's node; at most one entry per shard."""
    entries = [part for k, v in values.items() for part in (F.lit(k), F.lit(v).cast(kind))]
    return F.create_map(*entries)[F.col("node")]


def _cut(rows: DataFrame, nodes: list[Node]) -> None:
    """Finds every node's cut: the greatest coordinate of its left side."""
    sizes, ranges = _widest(rows, nodes)
    active = {node.number: node for node in nodes if node.number in sizes}
    # Bytes still to be found inside the interval, for the left side.
    wanted = {n: sizes[n] * (node.shards // 2) / node.shards for n, node in active.items()}
    rows = rows.withColumn("at", _on_dimension(active)) if active else rows
    while active:
        inside = {n: ranges[n] for n in active}
        width = {n: max(1, -(-(high - low + 1) // BINS)) for n, (low, high) in inside.items()}
        low = _by_node({n: r[0] for n, r in inside.items()}, "long")
        high = _by_node({n: r[1] for n, r in inside.items()}, "long")
        bin_of = F.floor((F.col("at") - low) / _by_node(width, "long")).cast("long")
        counted = (
            rows.where(F.col("node").isin(list(active)))
            .where(F.col("at").between(low, high))
            .groupBy("node", bin_of.alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.max("at").alias("last"))
            .collect()
        )
        for number in list(active):
            node, (start, _) = active[number], inside[number]
            bins = sorted((r.bin, r.bytes, r["last"]) for r in counted if r.node == number)
            before = 0
            for position, (place, held, last) in enumerate(bins):
                if before + held >= wanted[number] or position == len(bins) - 1:
                    break
                before += held
                node.cut = last
            small = held <= max(FINE * sizes[number], 1) or width[number] == 1
            if small:
                # The bin goes to the side that ends nearer to the wanted bytes.
                if before + held - wanted[number] <= wanted[number] - before:
                    node.cut = last
                del active[number]
            else:
                wanted[number] -= before
                first = start + place * width[number]
                ranges[number] = (first, first + width[number] - 1)


def _on_dimension(nodes: dict[int, Node]):
    """The coordinate of each row on its node's dimension."""
    place = _by_node({n: DIMENSIONS.index(node.dimension) for n, node in nodes.items()}, "int")
    return F.coalesce(*(F.when(place == k, F.col(d)) for k, d in enumerate(DIMENSIONS)))


def kd_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, tie): the leaves of the tree as shards."""
    rows = staged(coordinates(docs), "coordinates")
    leaves, nodes = [], [Node(1, 0, shards)]
    while nodes:
        leaves += [node for node in nodes if node.shards == 1]
        splitting = [node for node in nodes if node.shards > 1]
        nodes = []
        if splitting:
            _cut(rows, splitting)
            filled = {node.number: node for node in splitting if node.dimension is not None}
            for node in splitting:
                left = node.shards // 2
                nodes.append(Node(2 * node.number, node.first_shard, left))
                nodes.append(Node(2 * node.number + 1, node.first_shard + left, node.shards - left))
            if filled:
                cuts = {n: -1 if node.cut is None else node.cut for n, node in filled.items()}
                right = (_on_dimension(filled) > _by_node(cuts, "long")).cast("int")
                child = F.when(F.col("node").isin(list(filled)), 2 * F.col("node") + right)
                # Written once per level: few bytes a row, and the next level's
                # expressions stay as short as this one's.
                rows = staged(rows.withColumn("node", F.coalesce(child, "node")), "level")
    # A leaf that is reached early (one shard beside two) keeps its number.
    shard = _by_node({leaf.number: leaf.first_shard for leaf in leaves}, "int")
    return rows.select("doc_id", "size", "text_crc32", shard.alias("shard"), "tie")


def with_slots(rows: DataFrame, salts: int | None = None) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in every shard, instead of ``tie``.

    Rows are numbered inside salted parts of a shard, and each part starts where
    the parts before it end, so no task ever holds a whole shard, nor all rows
    without an id or of one text.
    """
    salts = salts or max(8, partitions(rows.sparkSession))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("tie"), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("shard", "salt").orderBy("doc_id", "text_crc32", "tie")
    numbered = salted.withColumn("number", F.row_number().over(order) - 1)
    placed = numbered.join(bases, ["shard", "salt"])
    return placed.withColumn("slot", F.col("base") + F.col("number")).drop("salt", "base", "number", "tie")


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    placed = with_slots(staged(kd_shards(documents), "shards"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
