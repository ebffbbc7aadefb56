"""Near duplicates by MinHash: a signature-coordinate inverted join.

1. Every text becomes its set of word shingles (64-bit hashes), a digest of that
   set and a MinHash signature of ``COORDINATES`` values. Texts with equal sets
   are one class, so exact copies never meet in pairs.
2. Classes are posted under each (coordinate, value). Values held by one class
   are dropped. Two classes that agree in ``MATCHES`` coordinates must share one
   of the first (shared coordinates - MATCHES + 1) of each when both are sorted
   by the same order, so only that prefix is posted, rarest values first:
   frequent values are mostly skipped.
3. Each posting list is merged by leaders: one member is compared with all
   others and leaves the list; members that already are in one component with
   each other need no further comparison. After ``LEADER_ROUNDS`` rounds the
   pairs left, those across components, are all compared. A list thus costs its
   length per round, not its square, when its members are alike. Members of long
   lists that stay unlike (texts around one common passage, copies that have
   drifted apart) are posted anew under the rarest of their shingles, by bands
   of set sizes, where what all have in common seldom counts. Members of lists
   that are long even then (texts of few words) go to the signature trees of
   ``sigtree``, which compare blocks of them and return no pair but links.
4. A pair is a candidate if its lengths allow the similarity and its signatures
   agree in ``MATCHES`` coordinates and in ``TEST_MATCHES`` of the one-byte test
   coordinates; links are confirmed on the full sets, which are made for the
   texts of candidates only.

A pair at a similarity of exactly 0.8 falls short of 25 of 48 coordinates with
a probability of 3e-6, one of 0.85 with 1e-8; of 172 of the 256 test bytes with
4e-7.

Defined results: a null or blank text has the empty set, is linked with nothing
and is its own component; a text of fewer words than a shingle is one shingle;
rows that share an id count as one document, so the classes of their texts are
linked; a row without an id is represented by an equal text that has one, else
by itself (null component, kept); an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.components import components
from tripflow.llm.links_sql import components_sql
from tripflow.llm.sets import held, shingle_sets
from tripflow.llm.sigtree import tree_links
from tripflow.llm.words import WordHasher, shingles
from tripflow.llm.work import partitions, staged, table

COORDINATES = 48
MATCHES = 25
LEADER_ROUNDS = 1
#: Pairs that may remain in a posting list before its members are posted by shingle, and
#: in a list by shingle before they go to a signature tree.
DIRECT, PAIRED = 512, 4096
#: Sizes of one band of shingle sets differ by this factor at most.
BAND_RATIO = 1.03
#: Bits of a posted key that name the coordinate.
_COORDINATE_BITS = 6
_BLOCK = 2048
#: Further coordinates, of one byte each, that only test pairs, and how many must agree.
TEST_COORDINATES, TEST_MATCHES = 256, 172

SIGNATURES = "id long, n_shingles long, h1 long, h2 long, keys array<long>, test binary"


def _permutations(count: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(7).integers(0, 1 << 63, (2, count), dtype=np.uint64)
    return ((drawn[0] << np.uint64(1)) | np.uint64(1)).astype(kind), drawn[1].astype(kind)


def _least(members: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Per permutation the least permuted member."""
    least = np.full(len(factors), np.iinfo(members.dtype).max, members.dtype)
    for start in range(0, len(members), _BLOCK):
        permuted = np.multiply.outer(factors, members[start : start + _BLOCK])
        permuted += shifts[:, None]
        np.minimum(least, permuted.min(axis=1), out=least)
    return least


def signature(members: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Per coordinate the least permuted member, tagged with the coordinate."""
    least = _least(members, factors, shifts)
    # The minimum of many values has leading zero bits: mix before cutting it.
    least *= np.uint64(0x9E3779B97F4A7C15)
    tags = np.arange(COORDINATES, dtype=np.uint64)
    return (least & ~np.uint64((1 << _COORDINATE_BITS) - 1)) | tags


def test_signature(members: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> bytes:
    """One byte of the least permuted member per test coordinate."""
    least = _least((members >> np.uint64(32)).astype(np.uint32), factors, shifts)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Set size, set digest and signatures of every (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        permutations = _permutations(COORDINATES, np.uint64)
        tests = _permutations(TEST_COORDINATES, np.uint32)
        for batch in batches:
            sizes, digests, keys, offsets, bytes_of = [], [], [], [0], []
            for hashes in hasher.each(batch.column(1)):
                members = np.unique(shingles(hashes, words))
                sizes.append(len(members))
                digests.append(xxhash.xxh3_128_digest(members.tobytes()))
                if len(members):
                    keys.append(signature(members, *permutations))
                bytes_of.append(test_signature(members, *tests) if len(members) else None)
                offsets.append(offsets[-1] + (COORDINATES if len(members) else 0))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(halves[:, 0].copy()),
                    pa.array(halves[:, 1].copy()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    pa.array(bytes_of, pa.binary()),
                ],
                ["id", "n_shingles", "h1", "h2", "keys", "test"],
            )

    return docs.mapInArrow(run, SIGNATURES)


_ENTRY = ["key", "id", "n", "common", "rest", "short"]

#: How many others hold what a class holds: the centre of a group of copies leads.
_COMMON = "aggregate(found, 0L, (total, entry) -> total + entry.n)"


def _postings(classes: DataFrame) -> DataFrame:
    """The prefix of every class that can reach ``MATCHES``, by key: its id, set
    size n, centrality, keys from this one on (``rest``), and whether a pair
    counts in this list whatever the other member (``short``)."""
    posted = classes.select("id", "n_shingles", F.explode("keys").alias("key"))
    counts = staged(
        posted.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1"), "key-counts"
    )
    shared = posted.join(counts, "key").groupBy("id").agg(
        F.min("n_shingles").alias("n"),
        F.array_sort(F.collect_list(F.struct(F.col("holders").alias("n"), "key"))).alias("found"),
    )
    prefix = f"slice(found, 1, size(found) - {MATCHES - 1})"
    rows = shared.where(F.size("found") >= MATCHES).selectExpr(
        "id", "n", "size(found) AS shared", f"{_COMMON} AS common", f"posexplode({prefix})"
    )
    return rows.selectExpr("col.key", "id", "n", "common", "shared - pos AS rest", "true AS short")


def _shingle_postings(sets: DataFrame, percent: int) -> DataFrame:
    """Like ``_postings``, by shingles within bands of set sizes.

    Sets of sizes m <= n with a link share at least ``percent`` / (100 +
    ``percent``) of m + n. A set is posted in the bands of all sizes it may be
    linked with from above, each with the prefix that follows from the smallest
    size of the band, and is ``short`` in its own band for the prefix that
    follows from its own size.
    """
    # Few small files hold the sets: deal them out before they grow to a row per shingle.
    sets = sets.repartition(partitions(sets.sparkSession))
    posted = sets.select("id", "n", F.explode("members").alias("key"))
    counts = staged(
        posted.groupBy("key").agg(F.count("*").alias("holders")).where("holders > 1"), "shingle-counts"
    )
    shared = posted.join(counts, "key").groupBy("id").agg(
        F.min("n").alias("n"),
        F.array_sort(F.collect_list(F.struct(F.col("holders").alias("n"), "key"))).alias("found"),
    )
    share = f"{percent} / {100 + percent}"
    band = "CAST(floor(ln({}) / ln(%s)) AS INT)" % BAND_RATIO
    least = f"CAST(ceil({percent} * n / 100) AS INT)"
    low = f"greatest({least}, CAST(floor(pow({BAND_RATIO}D, band)) AS INT))"
    banded = shared.selectExpr(
        "id", "n", "found", f"{_COMMON} AS common", f"{band.format('n')} AS own",
        f"explode(sequence({band.format(least)}, {band.format('n')})) AS band",
    )
    # Rounded down a little, for the division is not exact.
    needed = f"greatest({least}, CAST(ceil((n + {low}) * {share} - 1e-9) AS INT))"
    prefix = f"slice(found, 1, greatest(0, size(found) - {needed} + 1))"
    in_short = f"size(found) - CAST(ceil(2 * n * {share} - 1e-9) AS INT)"
    rows = banded.selectExpr(
        "id", "n", "common", "band", "own", "size(found) AS shared", f"{in_short} AS last",
        f"posexplode({prefix})",
    )
    return rows.selectExpr(
        "xxhash64(col.key, band) AS key", "id", "n", "common", "shared - pos AS rest",
        "band = own AND pos <= last AS short",
    )


def _candidates(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) whose lengths and signatures allow a link."""
    side = classes.select("id", "n_shingles", "keys", "test")
    both = (
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .join(side.toDF("a", "na", "ka", "ta"), "a")
        .join(side.toDF("b", "nb", "kb", "tb"), "b")
        .where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    )

    @F.arrow_udf("int")
    def equal_bytes(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for one, other in columns:
            if not len(one):
                yield pa.array([], pa.int32())
                continue
            rows = [np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1) for c in (one, other)]
            yield pa.array((rows[0] == rows[1]).sum(axis=1).astype(np.int32))

    alike = both.where(F.size(F.array_intersect("ka", "kb")) >= MATCHES)
    return alike.where(equal_bytes("ta", "tb") >= TEST_MATCHES).select("a", "b")


def _sets_of(pairs: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """Shingle sets of all ids in (a, b)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ids = staged(ids, "wanted")
    return staged(shingle_sets(held(docs, ids), words), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    both = pairs.join(sets.toDF("a", "na", "ma"), "a").join(sets.toDF("b", "nb", "mb"), "b")
    common = both.select(
        "a", "b", (F.col("na") + F.col("nb")).alias("total"),
        F.size(F.array_intersect("ma", "mb")).alias("common"),
    )
    return common.where(f"100 * common >= {percent} * (total - common)").select("a", "b")


def _leader_pairs(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of each list's leader with its members of other components, and the
    lists without their leaders."""
    leaders = lists.groupBy("key").agg(
        F.max(F.struct("common", "id", "component")).alias("top"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
    )
    leaders = leaders.where("low <> high").select(
        "key", F.col("top.id").alias("leader"), F.col("top.component").alias("own")
    )
    leaders = staged(leaders, "leaders")
    joined = lists.join(leaders, "key")
    pairs = joined.where("component <> own").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    return pairs, joined.where("id <> leader").select(*_ENTRY)


def _open_lists(lists: DataFrame) -> DataFrame:
    """Members of the lists that hold several components, with the list's
    largest component and the number of pairs across components at most."""
    sizes = lists.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("top"),
        F.sum("n").alias("size"),
        F.count("*").alias("components"),
    )
    main = main.where("components > 1").selectExpr(
        "key", "top.component AS main", "(size - top.n) * size AS crossing"
    )
    return staged(lists.join(staged(main, "main"), "key"), "open-lists")


def _remaining_pairs(open_lists: DataFrame, percent: int, needed: str) -> DataFrame:
    """All pairs across components: members outside a list's largest component
    with every member of another component, if their sizes allow a link and the
    keys that follow this one in both suffice. In the list of the first key two
    linked members share, they do."""
    few = open_lists.where("component <> main").selectExpr(
        "key", "id AS a", "component AS ca", "n AS na", "rest AS ra", "short AS sa"
    )
    other = open_lists.selectExpr(
        "key", "id AS b", "component AS cb", "n AS nb", "rest AS rb", "short AS sb", "main"
    )
    across = few.join(other, "key").where(
        f"(sa OR sb) AND ca <> cb AND (cb = main OR a < b) AND least(ra, rb) >= {needed} "
        f"AND 100 * least(na, nb) >= {percent} * greatest(na, nb)"
    )
    return across.select("a", "b")


def _labelled(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("component", F.col("id"))
    named = lists.join(labels, "id", "left")
    return named.withColumn("component", F.coalesce("component", "id"))


class _Linker:
    """The links confirmed so far and the components they make."""

    def __init__(self, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> None:
        self.classes, self.docs, self.words, self.percent = classes, docs, words, percent
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def labelled(self, lists: DataFrame) -> DataFrame:
        return _labelled(lists, self.labels)

    def compare(self, pairs: DataFrame) -> None:
        likely = staged(_candidates(pairs, self.classes, self.percent), "candidates")
        if self.labels is not None and likely.isEmpty():
            return
        sets = _sets_of(likely, self.docs, self.words)
        found = staged(_confirmed(likely, sets, self.percent), "links")
        self.links = found if self.links is None else self.links.union(found)
        self.labels = components(self.links)

    def compare_by_tree(self, ids: DataFrame) -> None:
        """Links among some classes, found by signature trees: no pair is emitted that
        is not a link between components."""
        found = tree_links(held(self.docs, ids), self.words, self.percent, self.labels)
        self.links = found if self.links is None else self.links.union(found)
        self.labels = components(self.links)

    def merge(self, lists: DataFrame) -> DataFrame:
        """Leader rounds over the lists; what is left of them, open lists only."""
        for _ in range(LEADER_ROUNDS):
            pairs, rest = _leader_pairs(self.labelled(lists))
            lists = staged(rest, "lists")
            self.compare(pairs)
        return _open_lists(self.labelled(lists))


def _links_of_ids(members: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links (a, b) between an id on several rows and the classes of its texts."""
    again = members.where("id IS NOT NULL").groupBy("id").count().where("count > 1")
    again = staged(again.select("id"), "again")
    if again.isEmpty():
        return None
    own = members.join(again, "id", "left_semi").join(classes.select("h1", "h2", F.col("id").alias("class")), ["h1", "h2"])
    return staged(own.where("id <> class").select(F.col("id").alias("a"), F.col("class").alias("b")).distinct(), "links")


def near_links(
    classes: DataFrame, docs: DataFrame, words: int, percent: int, links: DataFrame | None = None
) -> DataFrame:
    """Component labels (id, component) of all linked classes; ``links`` hold from the start."""
    linker = _Linker(classes, docs, words, percent)
    if links is not None:
        linker.links, linker.labels = links, components(links)
    rest = linker.merge(staged(_postings(classes), "postings"))
    linker.compare(_remaining_pairs(rest.where(f"crossing <= {DIRECT}"), percent, str(MATCHES)))
    # Long lists of unlike members come from a passage that makes up most of the
    # signature of many texts. Their pairs are found through the shingles instead.
    long = staged(rest.where(f"crossing > {DIRECT}").select(F.col("id").alias("a"), F.col("id").alias("b")), "long")
    if not long.isEmpty():
        by_shingle = _shingle_postings(_sets_of(long, docs, words), percent)
        rest = linker.merge(staged(by_shingle, "shingle-postings"))
        needed = f"{percent} * (na + nb) / {100 + percent} - 1e-9"
        linker.compare(_remaining_pairs(rest.where(f"crossing <= {PAIRED}"), percent, needed))
        # What is long even so, texts of few words, is never paired.
        dense = staged(rest.where(f"crossing > {PAIRED}").select("id").distinct(), "dense")
        if not dense.isEmpty():
            linker.compare_by_tree(dense)
    return linker.labels


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Two documents are linked if 100 * shared shingles >= percent * all shingles
    of both. ``component_id`` is the smallest id reachable by links.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = staged(signatures(rows, words), "signatures")
    # Equal sets are one class, named by its smallest id.
    classes = (
        signed.where("n_shingles > 0")
        .groupBy("h1", "h2")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("test").alias("test"))
    )
    classes = staged(classes, "classes")
    members = signed.select("id", "n_shingles", "h1", "h2")
    known = classes.where("id IS NOT NULL")
    labels = near_links(known, rows, words, percent, _links_of_ids(members, known))
    named = members.join(
        classes.select("h1", "h2", F.col("id").alias("class")), ["h1", "h2"], "left"
    )
    own = F.when(F.col("n_shingles") > 0, F.col("class")).otherwise(F.col("id"))
    named = named.select("id", "n_shingles", own.alias("class"))
    placed = named.join(labels.toDF("class", "component"), "class", "left")
    component = F.coalesce("component", "class")
    return placed.select(
        F.col("id").alias(id),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def op1_minhash(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(documents, words=2, percent=80)


ORACLE_SQL = components_sql(words=2, percent=80, kept=True)
