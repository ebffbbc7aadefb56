"""N-gram Jaccard join by signature trees: the set links of all texts, exactly.

Texts become sets of word shingles (64-bit hashes); equal sets are one class. Two
classes are linked if 100 * common >= percent * (shingles of either).

1. Roots. The shingles of a set, sorted by hash, make pairs of neighbours. A
   shingle that only one of two linked sets has breaks two pairs of that set and
   one of the other, so of the first ``2 * floor((100 - percent) * n / 100) + 2``
   pairs one at least is unbroken in both, and with ``EXTRA`` more pairs that many
   more. Sets are hung under these pairs, their roots; roots that only one class
   has are dropped, then sets with too few roots left. Chance meetings of words,
   and passages that make up little of a text, seldom are neighbours in hash
   order of both sets, so hardly any unlike sets remain.
2. Nodes. Classes with the same most frequent root are one tree, cut into nodes of
   about ``NODE`` shingles, by size where one node does not hold them. A node has the OR of
   its members' token bitmaps, its range of set sizes and the largest surplus
   (shingles over bits) of a member.
3. Dual traversal. Two nodes are compared if they share a root and their sizes and
   the largest possible overlap, the common bits and the smaller surplus, allow
   a link. Within a task each node is a tree of its own (branches of leaves of
   sets, each with bitmap, size range and surplus), and the two are descended
   together under the same bound. What is left at the sets is confirmed on the
   full sets.
4. Sets that already are in one component are not compared again, and only links
   between components are returned, so a group of alike sets costs about its
   size. In the first round each node meets itself and the leading node of each
   of its roots; then the nodes of a root that are not all in one component meet.

Nothing here is a matter of chance but the 64-bit hashes. No task holds more than
two nodes at a time. Many unlike sets under one root, all as large and sharing
most bits, would be compared each with each, block by block; nothing is dropped.

Defined results: a null or blank text has the empty set and is linked with nothing;
a text of fewer words than a shingle is one shingle; rows that share an id are one
document, so the classes of their texts are linked; a row without an id takes the
smallest id of its component, null if there is none; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.components import components
from tripflow.llm.links_sql import components_sql
from tripflow.llm.sets import may_hold, shingle_sets
from tripflow.llm.words import WordHasher, mixed, shingles
from tripflow.llm.work import staged, table

#: Roots beyond those that must be shared, as a share of the set; as many more are shared.
EXTRA = 20
#: Shingles of a node, about; a larger set is a node of its own.
NODE = 1 << 17
#: Bits of a node's bitmap between tasks.
BITS = 4096
#: Sets in a leaf and in a branch of the tree within a task.
LEAF, BRANCH = 16, 128
#: Pairs of a branch that are confirmed one by one; more are counted together.
SINGLY = 48
#: Tokens of a block whose common sets are counted at a time.
COLUMNS = 4096

SIGNED = "key long, n long, h1 long, h2 long, roots array<long>"
PACKED = (
    "node long, names array<long>, sizes array<long>, tokens array<long>, low long, high long, "
    "surplus long, bitmap array<long>"
)
MEMBERS = "array<struct<name:long,n:long,members:array<long>>>"
LINKS = "a long, b long"


def broken_at_most(n, percent: int):
    """Neighbour pairs of a set of n that a linked set can break."""
    return 2 * ((100 - percent) * n // 100) + 1


def roots_of(members: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the first neighbour pairs of a sorted set. A set that cannot be
    linked with a different one has none."""
    n = len(members)
    # The nearest different sets: one shingle less or one more.
    if 100 * (n - 1) < percent * n and 100 * n < percent * (n + 1):
        return members[:0]
    first = members[: broken_at_most(n, percent) + n // EXTRA + 2]
    return mixed(first[:-1] * np.uint64(0x9E3779B97F4A7C15) + first[1:])


def signed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Set size, set digest and roots of every (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            sizes, digests, roots = [], [], []
            for hashes in hasher.each(batch.column(1)):
                members = np.unique(shingles(hashes, words))
                sizes.append(len(members))
                digests.append(xxhash.xxh3_128_digest(members.tobytes()))
                roots.append(np.unique(roots_of(members, percent)))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in roots])]).astype(np.int32)
            flat = np.concatenate(roots).view(np.int64) if roots else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(halves[:, 0].copy()),
                    pa.array(halves[:, 1].copy()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                ["key", "n", "h1", "h2", "roots"],
            )

    return docs.mapInArrow(run, SIGNED)


# Trees within a task -----------------------------------------------------------


def _bitmaps(sizes: np.ndarray, tokens: np.ndarray, bits: int) -> np.ndarray:
    """A row of 64-bit words per set: the bits its tokens fall on."""
    found = np.zeros((len(sizes), bits), bool)
    found[np.repeat(np.arange(len(sizes)), sizes), tokens.view(np.uint64) % np.uint64(bits)] = True
    return np.packbits(found, axis=1, bitorder="little").view(np.uint64)


@dataclass
class _Level:
    """Nodes of one level; ``first`` are the places of their children, ending with their number."""

    bitmaps: np.ndarray
    low: np.ndarray
    high: np.ndarray
    surplus: np.ndarray
    first: np.ndarray


class Tree:
    """The sets of a node, smallest first, in leaves and branches."""

    def __init__(self, names, sizes, tokens, bits: int) -> None:
        self.names, self.sizes = names, sizes
        ends = np.cumsum(sizes)
        self.sets = [tokens[end - n : end].view(np.uint64) for n, end in zip(sizes, ends)]
        bitmaps = _bitmaps(sizes, tokens, bits)
        surplus = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        self.levels = [_Level(bitmaps, sizes, sizes, surplus, np.arange(len(sizes) + 1))]
        for fan in (LEAF, BRANCH // LEAF):
            below = self.levels[-1]
            first = np.arange(0, len(below.low), fan)
            self.levels.append(
                _Level(
                    np.bitwise_or.reduceat(below.bitmaps, first, axis=0),
                    np.minimum.reduceat(below.low, first),
                    np.maximum.reduceat(below.high, first),
                    np.maximum.reduceat(below.surplus, first),
                    np.append(first, len(below.low)),
                )
            )


def possible(one: _Level, i: np.ndarray, other: _Level, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets below node i of one and node j of the other may be linked: by
    the sizes, and by the largest overlap their bitmaps allow."""
    fits = (100 * one.high[i] >= percent * other.low[j]) & (100 * other.high[j] >= percent * one.low[i])
    # The smallest overlap any linked pair below has; partners are no smaller than the sizes allow.
    least_i = np.maximum(one.low[i], -(-percent * other.low[j] // 100))
    least_j = np.maximum(other.low[j], -(-percent * one.low[i] // 100))
    needed = -(-percent * (least_i + least_j) // (100 + percent))
    most = np.zeros(len(i), np.int64)
    at = np.flatnonzero(fits)
    for start in range(0, len(at), 4096):
        part = at[start : start + 4096]
        both = one.bitmaps[i[part]] & other.bitmaps[j[part]]
        most[part] = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return fits & (most + np.minimum(one.surplus[i], other.surplus[j]) >= needed)


def _children(one: _Level, i: np.ndarray, other: _Level, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of i and a child of j."""
    rows, columns = one.first[i + 1] - one.first[i], other.first[j + 1] - other.first[j]
    counts = rows * columns
    at = np.repeat(np.arange(len(i)), counts)
    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return one.first[i][at] + step // columns[at], other.first[j][at] + step % columns[at]


class _Components:
    def __init__(self, labels: np.ndarray) -> None:
        self.labels = labels

    def link(self, a: int, b: int) -> bool:
        one, other = self.labels[a], self.labels[b]
        if one == other:
            return False
        self.labels[self.labels == max(one, other)] = min(one, other)
        return True


def _overlaps(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Common tokens of every set of one list with every set of the other, counted by
    products of incidence matrices over ``COLUMNS`` shared tokens at a time."""
    shared = np.intersect1d(np.concatenate(one), np.concatenate(other))
    common = np.zeros((len(one), len(other)), np.float64)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        known = shared[at] == flat
        order = np.argsort(at[known], kind="stable")
        return rows[known][order], at[known][order]

    def incidence(count: int, rows: np.ndarray, at: np.ndarray, start: int) -> np.ndarray:
        low, high = np.searchsorted(at, [start, start + COLUMNS])
        found = np.zeros((count, COLUMNS), np.float32)
        found[rows[low:high], at[low:high] - start] = 1
        return found

    if len(shared):
        ours, theirs = places(one), places(other)
        for start in range(0, len(shared), COLUMNS):
            common += incidence(len(one), *ours, start) @ incidence(len(other), *theirs, start).T
    return common.astype(np.int64)


def _confirm(one: Tree, i, other: Tree, j, percent: int, groups: _Components, shift: int) -> Iterator[tuple[int, int]]:
    """Links between components among the pairs of sets (i, j), as places."""
    def linked(common, a, b):
        return 100 * common >= percent * (one.sizes[a] + other.sizes[b] - common)

    apart = groups.labels[i] != groups.labels[j + shift]
    i, j = i[apart], j[apart]
    if len(i) > SINGLY:
        rows, at_row = np.unique(i, return_inverse=True)
        columns, at_column = np.unique(j, return_inverse=True)
        common = _overlaps([one.sets[a] for a in rows], [other.sets[b] for b in columns])[at_row, at_column]
        found = linked(common, i, j)
        for a, b in zip(i[found].tolist(), j[found].tolist()):
            if groups.link(a, b + shift):
                yield a, b
        return
    for a, b in zip(i.tolist(), j.tolist()):
        if groups.labels[a] != groups.labels[b + shift]:
            common = len(np.intersect1d(one.sets[a], other.sets[b], assume_unique=True))
            if linked(common, a, b) and groups.link(a, b + shift):
                yield a, b


def traverse(one: Tree, other: Tree, labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (names) between the components of the sets of two trees, or of one
    tree given twice. ``labels`` are the components known, of both trees in turn."""
    itself = one is other
    shift = 0 if itself else len(one.names)
    groups = _Components(labels.copy())
    links = []
    top = len(one.levels[-1].low), len(other.levels[-1].low)
    i, j = (side.ravel() for side in np.indices(top))
    if itself:
        i, j = i[i <= j], j[i <= j]
    kept = possible(one.levels[-1], i, other.levels[-1], j, percent)
    for a, b in zip(i[kept].tolist(), j[kept].tolist()):
        pair = np.array([a]), np.array([b])
        for level in (2, 1):
            pair = _children(one.levels[level], pair[0], other.levels[level], pair[1])
            if itself:
                # A child meets itself only above the sets.
                ordered = pair[0] < pair[1] if level == 1 else pair[0] <= pair[1]
                pair = pair[0][ordered], pair[1][ordered]
            if level == 1:
                apart = groups.labels[pair[0]] != groups.labels[pair[1] + shift]
                pair = pair[0][apart], pair[1][apart]
            passed = possible(one.levels[level - 1], pair[0], other.levels[level - 1], pair[1], percent)
            pair = pair[0][passed], pair[1][passed]
        found = _confirm(one, pair[0], other, pair[1], percent, groups, shift)
        links += [(int(one.names[x]), int(other.names[y])) for x, y in found]
    return links


def _bits_for(sizes: np.ndarray) -> int:
    """Four bits a shingle, so few shingles of a set fall together."""
    return min(1 << 13, max(1 << 9, 1 << (4 * int(sizes.max()) - 1).bit_length()))


def _numbers(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy().astype(np.int64, copy=False)


# Trees between tasks -----------------------------------------------------------


def _nodes(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """A row per node: its sets, smallest first, with size range, surplus and bitmap.

    ``placed`` (name, node) puts about ``NODE`` shingles into a node, so a node is
    gathered in bounded memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sets = batch.column(1)[row].values
                names, sizes = (sets.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                order = np.lexsort((names, sizes))
                tokens = sets.field(2).take(pa.array(order)).flatten().to_numpy()
                names, sizes = names[order], sizes[order]
                bitmaps = _bitmaps(sizes, tokens, BITS)
                surplus = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
                bitmap = np.bitwise_or.reduce(bitmaps, axis=0).view(np.int64)
                low, high, most = int(sizes[0]), int(sizes[-1]), int(surplus.max())
                node = batch.column(0)[row].as_py()
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(_PACKED, (node, names, sizes, tokens, low, high, most, bitmap)))], _PACKED_SCHEMA
                )

    entry = F.struct(F.col("id").alias("name"), "n", "members")
    grouped = sets.join(placed.select(F.col("name").alias("id"), "node"), "id").groupBy("node")
    return grouped.agg(F.collect_list(entry).alias("sets")).mapInArrow(run, PACKED)


_PACKED = [part.split()[0] for part in PACKED.split(", ")]
_PACKED_SCHEMA = pa.schema(
    [(part.split()[0], pa.list_(pa.int64()) if "array" in part else pa.int64()) for part in PACKED.split(", ")]
)


def _links(pairs: DataFrame, percent: int) -> DataFrame:
    """Links found in rows (x, y) of packed nodes with ``labels`` in the order of their
    names, y null where a node meets itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for row in range(batch.num_rows):
                sides = [batch.column(k)[row] for k in (0, 1)]
                parts = [
                    tuple(side[name].values.to_numpy().astype(np.int64, copy=False) for name in ("names", "sizes", "tokens", "labels"))
                    for side in sides if side.is_valid
                ]
                bits = _bits_for(np.concatenate([part[1] for part in parts]))
                trees = [Tree(*part[:3], bits) for part in parts]
                labels = []
                for names, _, _, known in parts:
                    # An id may bear several sets; its label is there once.
                    labels.append(known[np.unique(names, return_inverse=True)[1]])
                links += traverse(trees[0], trees[-1], np.concatenate(labels), percent)
            found = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["a", "b"])

    return pairs.mapInArrow(run, LINKS)


def _side(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select(F.col("node").alias(f"{name}_node"), F.struct("names", "sizes", "tokens", "labels").alias(name))


def _with_labels(nodes: DataFrame, placed: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Nodes with the components of their sets, in the order of the names, and the
    least and greatest of them."""
    named = placed.select("name", "node")
    if labels is not None:
        named = named.join(labels.toDF("name", "component"), "name", "left")
        component = F.coalesce("component", "name")
    else:
        component = F.col("name")
    entries = F.array_sort(F.collect_list(F.struct("name", component.alias("component"))))
    found = named.groupBy("node").agg(
        F.transform(entries, lambda entry: entry.component).alias("labels"),
        F.min(component).alias("least"),
        F.max(component).alias("greatest"),
    )
    return nodes.join(found, "node")


def _met(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of nodes those that may hold a link: by size ranges, largest
    possible overlap and components."""
    def side(name: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(name),
            *[F.col(c).alias(f"{c}_{name}") for c in ("low", "high", "surplus", "bitmap", "least", "greatest")],
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = f"100 * high_a >= {percent} * low_b AND 100 * high_b >= {percent} * low_a"
    apart = "NOT (least_a = greatest_a AND least_b = greatest_b AND least_a = least_b)"
    common = "aggregate(zip_with(bitmap_a, bitmap_b, (x, y) -> bit_count(x & y)), 0, (s, x) -> s + x)"
    least_a = f"greatest(low_a, CAST(ceil({percent} * low_b / 100) AS BIGINT))"
    least_b = f"greatest(low_b, CAST(ceil({percent} * low_a / 100) AS BIGINT))"
    # Rounded down a little, for the division is not exact.
    needed = f"ceil({percent} * ({least_a} + {least_b}) / {100 + percent} - 1e-6)"
    both = both.where(f"{fits} AND {apart}")
    return both.where(f"{common} + least(surplus_a, surplus_b) >= {needed}").select("a", "b")


def _compared(nodes: DataFrame, pairs: DataFrame, percent: int, themselves: bool) -> DataFrame:
    """Links within nodes (``themselves``) and between the nodes of pairs (a, b)."""
    sides = staged(_met(pairs, nodes, percent), "node-pairs")
    crossed = sides.join(_side(nodes, "x"), F.col("a") == F.col("x_node")).join(
        _side(nodes, "y"), F.col("b") == F.col("y_node")
    )
    found = _links(crossed.select("x", "y"), percent)
    if themselves:
        several = _side(nodes.where(F.size("names") > 1), "x")
        alone = several.select("x", F.lit(None).cast(several.schema["x"].dataType).alias("y"))
        found = found.union(_links(alone, percent))
    return staged(found, "links")


def _roots(rows: DataFrame, names: DataFrame, percent: int) -> DataFrame:
    """Per class that may be linked (name, n): its most frequent root (home), and of
    its roots, rarest first, as many as a linked class must share one of (posted)."""
    posted = rows.select("key", "h1", F.explode("roots").alias("root"))
    shared = posted.groupBy("root").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    shared = staged(shared.where("low <> high").select("root"), "roots")
    place = rows.join(names, ["h1", "h2"]).select("key", "name", "n")
    hung = posted.select("key", "root").join(shared, "root").join(place, "key")
    hung = staged(hung.groupBy("root", "name").agg(F.min("n").alias("n")), "hung")
    holders = hung.groupBy("root").agg(F.count("*").alias("holders"))
    by_class = hung.join(holders, "root").groupBy("name").agg(
        F.min("n").alias("n"), F.array_sort(F.collect_list(F.struct("holders", "root"))).alias("found")
    )
    least = f"CAST(ceil({percent} * n / 100) AS BIGINT) DIV {EXTRA}"
    enough = by_class.selectExpr("*", f"CAST({least} AS INT) AS extra").where("size(found) > extra")
    return enough.selectExpr(
        "name", "n", "element_at(found, -1).root AS home",
        "transform(slice(found, 1, size(found) - extra), x -> x.root) AS posted",
    )


def _placed(classes: DataFrame, percent: int) -> DataFrame:
    """``classes`` with their node: that of the home where ``NODE`` shingles hold all its
    sets; otherwise as many as needed for every band of sizes that may be linked."""
    banded = classes.withColumn("band", F.expr(f"CAST(floor(ln(n) / ln(100 / {percent})) AS INT)"))
    bands = banded.groupBy("home", "band").agg(F.sum("n").alias("weight"))
    homes = bands.groupBy("home").agg(F.sum("weight").alias("total"))
    slots = bands.join(homes, "home").selectExpr(
        "home", "band", f"CASE WHEN total > {NODE} THEN weight DIV {NODE} + 1 END AS slots"
    )
    node = "CASE WHEN slots IS NULL THEN xxhash64(home) ELSE xxhash64(home, band, pmod(xxhash64(name, 1), slots)) END"
    return banded.join(slots, ["home", "band"]).selectExpr("name", "n", "posted", f"{node} AS node")


def _leading(hung: DataFrame) -> DataFrame:
    """Pairs of each root's node that hangs under it with the most sets and its others."""
    leaders = hung.groupBy("root").agg(F.max(F.struct("sets", "node"))["node"].alias("leader"), F.count("*").alias("n"))
    pairs = hung.join(leaders.where("n > 1"), "root").where("node <> leader")
    return pairs.selectExpr("least(node, leader) AS a", "greatest(node, leader) AS b").distinct()


def _remaining(hung: DataFrame, nodes: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs of nodes under one root that are not all of the root's main component."""
    labelled = hung.join(nodes.select("node", "least", "greatest"), "node")
    sizes = labelled.where("least = greatest").groupBy("root", "least").agg(F.count("*").alias("n"))
    mains = sizes.groupBy("root").agg(F.max(F.struct("n", "least"))["least"].alias("main"))
    odd = labelled.join(mains, "root", "left").where("main IS NULL OR least <> main OR greatest <> main")
    odd = odd.selectExpr("root", "node AS one")
    pairs = odd.join(hung.selectExpr("root", "node AS other"), "root").where("one <> other")
    pairs = pairs.selectExpr("least(one, other) AS a", "greatest(one, other) AS b").distinct()
    return pairs.join(done, ["a", "b"], "left_anti")


def set_links(
    rows: DataFrame, docs: DataFrame, names: DataFrame, words: int, percent: int, labels: DataFrame | None = None
) -> DataFrame:
    """Links (a, b) that join all linked classes of ``signed`` rows to components;
    ``labels`` (id, component) are components known before."""
    classes = staged(_roots(rows, names, percent), "classes")
    placed = staged(_placed(classes, percent), "placed")
    ids = placed.select(F.col("name").alias("id"))
    # The filter keeps most other texts where they are; the semi-join behind it is exact.
    texts = docs.select(F.col("key").alias("id"), "text").where(may_hold(ids)(F.col("id")))
    sets = shingle_sets(texts.join(ids, "id", "left_semi"), words)
    nodes = staged(_nodes(sets, placed), "nodes")
    hung = placed.select("node", "name", F.explode("posted").alias("root")).groupBy("root", "node")
    hung = staged(hung.agg(F.count("*").alias("sets")), "hung")
    first = staged(_leading(hung), "leading")
    links = _compared(_with_labels(nodes, placed, labels), first, percent, themselves=True)
    joined = links if labels is None else links.union(labels.where("id <> component").toDF("a", "b"))
    known = _with_labels(nodes, placed, components(joined))
    rest = _remaining(hung, known, first)
    return links.union(_compared(known, rest, percent, themselves=False))


def tree_links(docs: DataFrame, words: int, percent: int, labels: DataFrame | None = None) -> DataFrame:
    """Links (a, b) among the sets of (id, text), one text a set, beyond ``labels``."""
    keyed = docs.select(F.col("id").alias("key"), "text")
    rows = staged(signed(keyed, words, percent), "signed")
    names = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("key").alias("name"))
    return set_links(rows, keyed, names, words, percent, labels)


def _with_keys(docs: DataFrame, id: str, text: str) -> tuple[DataFrame, bool]:
    """(key, id, text): the id is the key of a row, unless ids are missing or stand on
    several rows; then the rows are written with keys of their own."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    if rows.groupBy("id").count().where("count > 1 OR id IS NULL").isEmpty():
        return rows.withColumn("key", F.col("id")), True
    return staged(rows.withColumn("key", F.monotonically_increasing_id()), "keyed"), False


def jaccard_groups(
    docs: DataFrame, words: int = 4, percent: int = 85, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, n_shingles, component_id.

    Two documents are linked if 100 * shared shingles >= percent * all shingles of
    both. ``component_id`` is the smallest id reachable by links. ``percent`` is 80
    or more: below, small sets might share no root.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent must be between 80 and 100")
    keyed, by_id = _with_keys(docs, id, text)
    rows = staged(signed(keyed.select("key", "text"), words, percent), "signed")
    names = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("key").alias("name"))
    names = staged(names, "names")
    links = set_links(rows, keyed, names, words, percent)
    named = rows.select("key", "n", "h1", "h2").join(names, ["h1", "h2"], "left")
    named = named.select("key", "n", F.coalesce("name", "key").alias("name"))
    if not by_id:
        named = staged(named.join(keyed.select("key", "id"), "key"), "named")
        own = named.where("id IS NOT NULL").groupBy("id").agg(F.min("name").alias("least"))
        same = named.join(own, "id").where("name <> least").select(F.col("least").alias("a"), F.col("name").alias("b"))
        links = links.union(same.distinct())
    labels = components(links).toDF("name", "component")
    found = named.join(labels, "name", "left").withColumn("component", F.coalesce("component", "name"))
    if by_id:
        return found.select(F.col("key").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    least = found.groupBy("component").agg(F.min("id").alias("component_id"))
    placed = found.join(least, "component")
    return placed.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id")


def op12_jaccard(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_groups(documents, words=4, percent=85)


ORACLE_SQL = components_sql(words=4, percent=85, kept=False)
