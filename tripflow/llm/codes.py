"""Vector code compression: product codes found by equal-average search.

Vectors are cut into ``PARTS`` consecutive parts and every part is replaced by the
index of its nearest entry in the codebook of its position. The codebooks start
as the parts of the vectors of the smallest ids and are improved ``ROUNDS`` times:
all parts are assigned, then every entry becomes the floored mean of its parts.

The nearest entry is found by equal-average search. The entries of a codebook are
sorted by the sum of their components; a part starts at its own sum and looks
outward, always on the side of the smaller gap between the sums. By Cauchy and
Schwarz an entry is at least gap * gap / dimension away (squared), so the search
ends when that strictly exceeds the best distance. Entries at the best distance
itself are still met, and of equal ones the lower index stays.

All arithmetic is in whole numbers, so the result does not depend on the order
of the rows. Each round is one pass: tasks add up their own parts and emit one row
per entry component, Spark adds these, and the new codebooks (``ENTRIES`` times
the dimension numbers, whatever the input) go out with the next pass.

Defined results: null vectors and vectors with a null, NaN or infinite component
are dropped; a component beyond 2^26 after scaling counts as 2^26, so that squares
fit; the dimension is that of the first kept vector by id, and vectors of another
one are dropped; a dimension that the parts do not divide is cut as evenly as can
be; of fewer vectors than entries all start an entry; rows that share an id are
vectors of their own, in the order of their components; null ids come last; an
empty table gives no rows. Columns named like the results are replaced, all others
pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.work import staged, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Greatest magnitude of a scaled component: the error of 500 such fits in 64 bits.
LIMIT = 1 << 26

VALUES = "_values"
SUMS = "part int, entry int, position int, total long, members long"
CODED = "struct<code:string,error:long>"


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of every row's nearest entry, the lower of equal ones, and the squared distance."""
    width = max(1, rows.shape[1])
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, entries = sums[order], entries[order]
    far = np.iinfo(np.int64).max
    # Sums are whole numbers below 2^53; past either end the gap is infinite.
    ends = np.concatenate([[-np.inf], sums, [np.inf]])
    best = np.full(len(rows), far, np.int64)
    index = np.full(len(rows), len(entries), np.int64)
    open_rows = np.arange(len(rows))
    own = rows.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    for _ in range(len(entries)):
        below, above = own - ends[left + 1], ends[right + 1] - own
        low = below <= above
        gap = np.where(low, below, above)
        # The first entry is always looked at; after it the best distance decides. The
        # margin is for squares that a double rounds: it costs a look, never an entry.
        going = (best[open_rows] == far) | (gap * gap <= best[open_rows] * (width * (1 + 1e-12)))
        if not going.all():
            open_rows, own, left, right, low = (x[going] for x in (open_rows, own, left, right, low))
        if not len(open_rows):
            break
        place = np.where(low, left, right)
        difference = rows[open_rows] - entries[place]
        distance = np.einsum("ij,ij->i", difference, difference)
        found, known, known_at = order[place], best[open_rows], index[open_rows]
        better = (distance < known) | ((distance == known) & (found < known_at))
        best[open_rows] = np.where(better, distance, known)
        index[open_rows] = np.where(better, found, known_at)
        left, right = left - low, right + ~low
    return index, best


@dataclass(frozen=True)
class Codebooks:
    """The entries of every part position, a row each."""

    entries: list[np.ndarray]

    @property
    def dimension(self) -> int:
        return sum(book.shape[1] for book in self.entries)

    def cut(self, values: np.ndarray) -> list[np.ndarray]:
        edges = np.cumsum([book.shape[1] for book in self.entries])[:-1]
        return np.split(values, edges, axis=1)

    def assigned(self, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per part position the entry of every row and its squared distance."""
        return [nearest(part, book) for part, book in zip(self.cut(values), self.entries)]

    def sha256(self) -> str:
        listed = ",".join(str(x) for book in self.entries for entry in book.tolist() for x in entry)
        return hashlib.sha256(listed.encode()).hexdigest()


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), dimension)


def scaled(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` with whole components in ``_values``, without vectors that have no such ones."""
    sound = f"`{vector}` IS NOT NULL AND forall(`{vector}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    component = f"CAST(floor(greatest(-{LIMIT}D, least({LIMIT}D, CAST(x AS DOUBLE) * {SCALE}D))) AS INT)"
    return vectors.where(sound).withColumn(VALUES, F.expr(f"transform(`{vector}`, x -> {component})"))


def _starting(rows: DataFrame, id: str, parts: int, entries: int) -> Codebooks:
    order = [F.col(id).asc_nulls_last(), VALUES]
    first = rows.orderBy(*order).select(F.size(VALUES).alias("n")).first()
    if first is None:
        return Codebooks([])
    chosen = rows.where(F.size(VALUES) == first.n).orderBy(*order).limit(entries).select(VALUES).collect()
    values = np.array([row[0] for row in chosen], np.int64).reshape(len(chosen), first.n)
    return Codebooks(np.array_split(values, parts, axis=1))


def _improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry as the floored mean of its parts; entries without parts stay."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros_like(book) for book in books.entries]
        members = [np.zeros(len(book), np.int64) for book in books.entries]
        for batch in batches:
            values = _matrix(batch.column(0), books.dimension)
            for k, (part, (index, _)) in enumerate(zip(books.cut(values), books.assigned(values))):
                np.add.at(totals[k], index, part)
                members[k] += np.bincount(index, minlength=len(members[k]))
        for k, total in enumerate(totals):
            used = np.flatnonzero(members[k])
            width = total.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used) * width, k, np.int32)),
                    pa.array(np.repeat(used, width).astype(np.int32)),
                    pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                    pa.array(total[used].ravel()),
                    pa.array(np.repeat(members[k][used], width)),
                ],
                ["part", "entry", "position", "total", "members"],
            )

    sums = rows.select(VALUES).mapInArrow(partial, SUMS).groupBy("part", "entry", "position")
    found = sums.agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
    improved = [book.copy() for book in books.entries]
    for row in found.collect():  # one row per entry component at most
        improved[row.part][row.entry, row.position] = row.total // row.members
    return Codebooks(improved)


def fit(
    rows: DataFrame, id: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks for ``scaled`` rows; all rows take part in every round."""
    books = _starting(rows, id, parts, entries)
    if books.entries:
        rows = rows.where(F.size(VALUES) == books.dimension)
        for _ in range(rounds):
            books = _improved(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``scaled`` rows of the codebooks' dimension with their ``code``, two hex digits a
    part, and ``error``, the squared distance to what the code stands for."""

    @F.arrow_udf(CODED)
    def coded(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = books.assigned(_matrix(column, books.dimension))
            indexes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            codes = [row.tobytes().hex() for row in indexes]
            error = sum(distance for _, distance in found)
            yield pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(error)], ["code", "error"])

    if not books.entries:
        none = rows.where("false").drop("code", "error", VALUES)
        return none.selectExpr("*", "CAST(NULL AS STRING) AS code", "CAST(NULL AS BIGINT) AS error")
    fitting = rows.where(F.size(VALUES) == books.dimension)
    found = fitting.drop("code", "error").withColumn("_coded", coded(F.col(VALUES)))
    return found.withColumns({"code": F.col("_coded.code"), "error": F.col("_coded.error")}).drop("_coded", VALUES)


def decoded(code: str, books: Codebooks) -> np.ndarray:
    """The scaled vector that a code stands for."""
    return np.concatenate([book[k] for book, k in zip(books.entries, bytes.fromhex(code))])


def compress(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Every vector with its code and error, and the codebooks. At most 256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("two hex digits a part leave room for 1 to 256 entries")
    # Written as whole numbers once, read by every round.
    rows = staged(scaled(vectors.drop(VALUES), vector).drop(vector), "scaled")
    books = fit(rows, id, parts, entries, rounds)
    return encode(rows, books), books


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with the error summed over the rows of its label, null being one."""
    coded = staged(coded, "coded")
    totals = coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.drop("label_error").join(totals, F.col(label).eqNullSafe(F.col("_label")))
    return joined.drop("_label")


def op13_codes(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = compress(vectors)
    found = with_label_error(coded).withColumn("codebooks_sha256", F.lit(books.sha256()))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _oracle_sql() -> str:
    """All distances by inner products, the rounds written out one after the other."""
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""
    a{k} AS MATERIALIZED (
      SELECT r, p, min(CAST(x.vv + c.vv - 2 * list_inner_product(x.v, c.v) AS BIGINT) * {ENTRIES} + e) AS found
      FROM parts x JOIN c{k} c USING (p) GROUP BY r, p)""")
        if k < ROUNDS:
            steps.append(f"""
    s{k} AS (
      SELECT p, e, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT p, found % {ENTRIES} AS e, unnest(v) AS x, unnest(range(len(v))) AS pos
        FROM parts JOIN a{k} USING (r, p)) GROUP BY p, e, pos),
    m{k} AS (
      SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY pos) AS v FROM s{k} GROUP BY p, e),
    c{k + 1} AS MATERIALIZED (
      SELECT p, e, coalesce(m.v, c.v) AS v, list_inner_product(coalesce(m.v, c.v), coalesce(m.v, c.v)) AS vv
      FROM c{k} c LEFT JOIN m{k} m USING (p, e))""")
    return f"""
    WITH kept AS (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS r, * FROM (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS q
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
    parts AS MATERIALIZED (
      SELECT r, p, v, list_inner_product(v, v) AS vv FROM (
        SELECT r, p, q[1 + p * (len(q) // {PARTS}) : (p + 1) * (len(q) // {PARTS})] AS v
        FROM (SELECT *, unnest(range({PARTS})) AS p FROM kept))),
    c0 AS MATERIALIZED (SELECT p, r - 1 AS e, v, vv FROM parts WHERE r <= {ENTRIES}),{",".join(steps)},
    coded AS (
      SELECT r, string_agg(printf('%02x', CAST(found % {ENTRIES} AS INTEGER)), '' ORDER BY p) AS code,
             CAST(sum(found // {ENTRIES}) AS BIGINT) AS error
      FROM a{ROUNDS} GROUP BY r),
    books AS (
      SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, pos)) AS digest
      FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS pos FROM c{ROUNDS}))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           digest AS codebooks_sha256
    FROM kept JOIN coded USING (r), books"""


ORACLE_SQL = _oracle_sql()
