"""Packing token pieces into sequences by a configuration linear program.

1. Every text is tokenized and cut into pieces (only where it is longer than a
   sequence). Each piece gets its number among the pieces of its length, from a
   count inside its task and the counts of the tasks before it.
2. The histogram of lengths, at most one row per length, is all the driver sees.
   A configuration says how many pieces of each length one sequence takes. The
   program "fewest configurations that cover every length's count" is solved by
   multiplicative weights: a length's price falls with the share of it already
   covered, and the best configuration at the current prices comes from the
   knapsack recurrence over all capacities.
3. Rounded configurations are taken as often as the counts allow; what is left
   goes best-fit into the space left, then into new sequences, again by length
   and not by piece. The plan says, per length and range of numbers, which
   sequences and offsets follow; its size depends on ``CAPACITY`` and ``ROUNDS``
   and not on the number of pieces. Each piece looks its place up.

The vocabulary drops white space and never joins across it, so the ids of a
word can be remembered.

Defined results: a null text is empty and still has its end token; repeated
rows are packed each; an empty table packs to nothing; rows without an id keep
a null id; further columns are ignored.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.words import WordHasher, text_bytes
from tripflow.llm.work import staged, table

CAPACITY = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"
#: Multiplicative weights: rounds, how fast prices fall, share of a count taken at once.
ROUNDS, FALL, STEP = 300, 8.0, 0.25
#: Words a worker remembers at most, and the ids of words before it starts afresh.
SLOTS, POOL = 1 << 20, 1 << 23
#: Bytes encoded at a time; arrays of several times that size stay with the worker.
PIECE = 1 << 17
_TOGETHER = 64

PIECES = (
    "doc_id long, piece int, start long, length int, ids_crc32 long, task int, number long, "
    "ids array<int>"
)


# Tokens ----------------------------------------------------------------------


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts, word by word.

    White space separates the vocabulary's words and yields nothing, and a full
    stop or comma after a letter at a word's end is a word of its own; so the
    ids of a text are those of its words, one after the other. Known words are
    found by their 64-bit hash and length in a table with one place per slot,
    all words of a group of texts at once; the others are encoded together,
    parted by a digit that none of them holds.

    Case is folded here except in texts with special tokens or combining marks,
    where the order of the vocabulary's steps matters: those are encoded whole.
    """

    _PART = b" 0 "

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.hasher = WordHasher()
        letters = b"abcdefghijklmnopqrstuvwxyz"
        self.is_letter, self.is_stop = np.zeros(256, bool), np.zeros(256, bool)
        self.is_letter[list(letters)], self.is_stop[list(b".,")] = True, True
        (self.part,) = self._ids([self._PART.decode()])[0]
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(SLOTS, np.uint64)
        self.sizes, self.starts, self.counts = (np.zeros(SLOTS, np.int32) for _ in range(3))
        self.pool, self.used = np.empty(POOL, np.uint32), 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, np.uint32) for encoding in found]

    def _encoded(self, words: list[bytes]) -> list[np.ndarray]:
        found: list[np.ndarray | None] = [None] * len(words)
        simple = [k for k, word in enumerate(words) if b"0" not in word]
        for start in range(0, len(simple), 500):
            group = simple[start : start + 500]
            joined = self._PART.join([words[k] for k in group]) + self._PART
            (ids,) = self._ids([joined.decode()])
            ends = np.flatnonzero(ids == self.part).tolist()
            if len(ends) == len(group):
                first = 0
                for k, end in zip(group, ends):
                    found[k] = ids[first:end]
                    first = end + 1
        rest = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(rest, self._ids([words[k].decode() for k in rest])):
            found[k] = ids
        return found

    def _words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last places of the words in lower-cased bytes."""
        outside = np.ones(len(data) + 2, bool)
        outside[1:-1] = self.hasher.space[data]
        inside = ~outside[1:-1]
        stop = np.zeros(len(data) + 1, bool)
        stop[1:-1] = self.is_stop[data[1:]] & outside[3:] & self.is_letter[data[:-1]]
        starts = np.flatnonzero(inside & (outside[:-2] | stop[:-1]))
        ends = np.flatnonzero(inside & (outside[2:] | stop[1:])) + 1
        return starts, ends

    def _group(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first place of every word, first of its ids, ids) of a lower-cased text."""
        if self.used > POOL:
            self._forget()
        data = np.frombuffer(text, np.uint8)
        starts, ends = self._words(data)
        hashes, sizes = self.hasher.spans(data, starts, ends), ends - starts
        slots = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        first, count = self.starts[slots].astype(np.int64), self.counts[slots].astype(np.int64)
        missing = np.flatnonzero((self.hashes[slots] != hashes) | (self.sizes[slots] != sizes))
        if len(missing):
            _, places, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            new = missing[places]
            ids = self._encoded([text[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            new_counts = np.array([len(i) for i in ids])
            new_starts = self.used + np.cumsum(new_counts) - new_counts
            total = int(new_counts.sum())
            if self.used + total > len(self.pool):
                self.pool = np.concatenate([self.pool[: self.used], np.empty(total + POOL, np.uint32)])
            self.pool[self.used : self.used + total] = np.concatenate(ids)
            self.used += total
            at = slots[new]
            self.hashes[at], self.sizes[at] = hashes[new], sizes[new]
            self.starts[at], self.counts[at] = new_starts, new_counts
            first[missing], count[missing] = new_starts[which], new_counts[which]
        upto = np.cumsum(count)
        places = np.repeat(first - upto + count, count) + np.arange(upto[-1] if len(upto) else 0)
        return starts, upto - count, self.pool[places]

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids (unsigned 32-bit) of every text."""
        done: list[list[np.ndarray]] = [[] for _ in texts]
        together: list[tuple[int, bytes]] = []
        size = 0

        def finish() -> None:
            places = np.cumsum([0, *(len(part) + 1 for _, part in together)])
            starts, firsts, ids = self._group(b"\n".join([part for _, part in together]))
            firsts = np.append(firsts, len(ids))
            cuts = firsts[np.searchsorted(starts, places)]
            for (text, _), a, b in zip(together, cuts[:-1], cuts[1:]):
                done[text].append(ids[a:b])
            together.clear()

        for number, text in enumerate(texts):
            if b"|>" in text or b"\xcc" in text or b"\xcd" in text:
                done[number] = self._ids([text.decode()])
                continue
            for part in _parts(text.lower()):
                together.append((number, part))
                size += len(part)
                if size > PIECE:
                    finish()
                    size = 0
        if together:
            finish()
        for ids in done:
            yield np.concatenate(ids) if len(ids) > 1 else ids[0] if ids else np.empty(0, np.uint32)


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts cut between words."""
    start = 0
    while len(text) - start > PIECE:
        cut = text.rfind(b" ", start + 1, start + PIECE)
        cut = text.find(b" ", start + PIECE) if cut < 0 else cut
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def worker_encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary, kept between its tasks."""
    kept = vars(sys).setdefault("_packing_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def token_pieces(
    docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece, written once. ``number`` counts a task's pieces of a
    length; ``ids`` is null unless ``keep_ids``."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        task = TaskContext.get().partitionId()
        numbers = np.zeros(CAPACITY + 1, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(first, _TOGETHER)
                texts = [data.tobytes() for data in text_bytes(part.column(1))]
                rows, ids = [], []
                for doc_id, tokens in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    tokens = np.append(tokens, np.uint32(END)).astype("<u4")
                    for piece, start in enumerate(range(0, len(tokens), CAPACITY)):
                        cut = tokens[start : start + CAPACITY]
                        length, crc = len(cut), zlib.crc32(cut.tobytes())
                        rows.append((doc_id, piece, start, length, crc, task, numbers[length]))
                        numbers[length] += 1
                        ids.append(cut.view("<i4") if keep_ids else None)
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, [p.split()[0] for p in PIECES.split(", ")])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return staged(rows.mapInArrow(run, PIECES), "pieces")


# The program over the histogram ------------------------------------------------


@dataclass
class Group:
    """``count`` sequences from ``first`` on that hold the same lengths."""

    first: int
    count: int
    used: int = 0
    #: (length, pieces per sequence, offset of the first) in order of offset
    items: list[tuple[int, int, int]] = field(default_factory=list)

    def add(self, length: int, pieces: int = 1) -> None:
        self.items.append((length, pieces, self.used))
        self.used += length * pieces

    def split(self, count: int) -> "Group":
        """The first ``count`` sequences as a group of their own."""
        part = Group(self.first, count, self.used, list(self.items))
        self.first, self.count = self.first + count, self.count - count
        return part


def best_configuration(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """Index of a length -> pieces, of the greatest total price that fits."""
    value = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(int(lengths[0]), capacity + 1):
        n = fitting[room]
        totals = value[room - lengths[:n]] + prices[:n]
        best = int(totals.argmax())
        if totals[best] > value[room - 1]:
            value[room], taken[room] = totals[best], best
        else:
            value[room] = value[room - 1]
    found: dict[int, int] = {}
    room = capacity
    while room > 0:
        best = int(taken[room])
        if best < 0:
            room -= 1
        else:
            found[best] = found.get(best, 0) + 1
            room -= int(lengths[best])
    return found


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often each is used, by multiplicative weights."""
    covered = np.zeros(len(lengths))
    solution = []
    for _ in range(ROUNDS):
        prices = np.exp(-FALL * (covered - covered.min())) / counts
        config = best_configuration(prices, lengths, capacity)
        config = {k: min(n, int(counts[k])) for k, n in config.items()}
        times = STEP * min(counts[k] / n for k, n in config.items())
        for k, n in config.items():
            covered[k] += n * times / counts[k]
        solution.append((config, times))
    scale = max(1.0, float(covered.max()))
    return [(config, times / scale) for config, times in solution]


def plan_groups(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Groups of sequences that hold every piece of the histogram once."""
    left = {length: n for length, n in sorted(histogram.items()) if n}
    groups, used = [], 0

    def take(count: int) -> Group:
        nonlocal used
        group = Group(used, count)
        used += count
        groups.append(group)
        return group

    if capacity in left:
        take(left.pop(capacity)).add(capacity)
    if left:
        lengths = np.array(list(left), np.int64)
        counts = np.array(list(left.values()), float)
        solution = fractional(lengths, counts, capacity)
        fill = [sum(int(lengths[k]) * n for k, n in config.items()) for config, _ in solution]
        # The fullest first, and no more sequences than all tokens could fill:
        # half-empty configurations of a small histogram are left to best fit.
        enough = used + -(-int(lengths @ counts) // capacity)
        for place in sorted(range(len(solution)), key=lambda k: -fill[k]):
            config, times = solution[place]
            often = min(left[int(lengths[k])] // n for k, n in config.items())
            often = min(often, int(np.ceil(times)), enough - used)
            if often > 0:
                group = take(often)
                for k, n in sorted(config.items(), reverse=True):
                    group.add(int(lengths[k]), n)
                    left[int(lengths[k])] -= n * often
    # Best fit, longest first; sequences with equal room are handled together.
    by_room: dict[int, list[Group]] = {}
    for group in groups:
        by_room.setdefault(capacity - group.used, []).append(group)
    for length in sorted(left, reverse=True):
        rest = left[length]
        while rest:
            room = min((r for r, g in by_room.items() if r >= length and g), default=None)
            if room is None:
                group = take(-(-rest // (capacity // length)))
            else:
                group = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
            fits = (capacity - group.used) // length
            if rest >= group.count * fits:
                pieces, filled = fits, group
            elif rest >= group.count:
                pieces, filled = rest // group.count, group
            else:
                pieces, filled = 1, group.split(rest)
                groups.append(filled)
                by_room.setdefault(capacity - group.used, []).append(group)
            filled.add(length, pieces)
            rest -= pieces * filled.count
            by_room.setdefault(capacity - filled.used, []).append(filled)
    return groups


@dataclass(frozen=True)
class Plan:
    """Runs of numbers per length, sorted by (length, first number)."""

    lengths: np.ndarray
    firsts: np.ndarray
    pieces: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray


def plan_of(groups: list[Group]) -> Plan:
    numbers: dict[int, int] = {}
    runs = []
    for group in groups:
        for length, pieces, offset in group.items:
            first = numbers.get(length, 0)
            numbers[length] = first + pieces * group.count
            runs.append((length, first, pieces, group.first, offset))
    runs.sort()
    columns = np.array(runs, np.int64).reshape(-1, 5).T
    return Plan(*columns)


def look_up(plan: Plan, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces with these lengths and numbers."""
    # Runs are sorted by length, then number: place each pair among them.
    at = np.empty(len(lengths), np.int64)
    for length in np.unique(lengths):
        a, b = np.searchsorted(plan.lengths, [length, length + 1])
        own = lengths == length
        at[own] = a + np.searchsorted(plan.firsts[a:b], numbers[own], "right") - 1
    ahead = numbers - plan.firsts[at]
    sequence = plan.sequences[at] + ahead // plan.pieces[at]
    return sequence, plan.offsets[at] + ahead % plan.pieces[at] * lengths


# Placing the pieces ---------------------------------------------------------------


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    counts = staged(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    rows = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = plan_of(plan_groups({row.length: row.n for row in rows}, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lengths, numbers in columns:
            found = look_up(plan, lengths.to_numpy().astype(np.int64), numbers.to_numpy())
            yield pa.StructArray.from_arrays([pa.array(f) for f in found], ["sequence_id", "offset"])

    numbered = pieces.join(bases, ["task", "length"])
    found = numbered.withColumn("_at", place(F.col("length"), F.col("base") + F.col("number")))
    return found.withColumns(
        {"sequence_id": F.col("_at.sequence_id"), "offset": F.col("_at.offset")}
    ).drop("_at", "task", "number", "base")


def pack(
    docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces with their ids and places: doc_id, piece, start, length, ids_crc32,
    ids, sequence_id, offset."""
    return placed(token_pieces(docs, id, text, path, keep_ids))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"),
        "ids_crc32", "sequence_id", "offset",
    )


def op5_packing(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(pack(documents, keep_ids=False))
