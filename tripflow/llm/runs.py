"""Periodic runs of words, by a dictionary of basic factors.

A run is a maximal stretch of words with smallest period q that is at least
``LEAST_POWER`` times q and ``LEAST_WORDS`` words long.

1. Words become numbers, equal words equal ones. The factors (stretches) of 1, 2,
   4, ... words are named in turn: the name of a factor of 2m words stands for
   the names of its halves. A factor that occurs once is left out, and with it
   all longer ones around it, so ordinary prose is through after a few lengths.
2. Per length m every occurrence looks at its successor, the next occurrence of
   the same factor. Two that lie within a stretch of 2m words, m words apart at
   most, propose their distance as a period; occurrences of one factor that lie
   so close form an arithmetic progression. A period q is taken from the least
   m >= q only: a run of at least 4q words has at least q + 2 places in a row
   whose factor of m words has its successor q words on, never nearer, because
   the first q words of the run are not a repetition themselves.
3. The progressions side by side are joined to one stretch, which is extended to
   both sides word by word as far as the period holds, and equal proposals are
   made one.

Texts are taken whole, one at a time, in Python workers; nothing is shuffled. The
memory for one text is about 100 bytes a word.

Defined results: a null, empty or blank text has no words and no runs; a text
shorter than ``LEAST_WORDS`` has no runs; repeated rows get the same answer; an
empty table gives no rows. Columns named like the results are replaced, all
others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.work import table

LEAST_POWER = 4
LEAST_WORDS = 6

FOUND = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"


def numbered(words: list) -> np.ndarray:
    """A number for every word, equal for equal words."""
    known: dict = {}
    return np.array([known.setdefault(word, len(known)) for word in words], np.int64)


def _named(left: np.ndarray, right: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair of names occurs again, grouped by pair and ascending, and
    the number of each one's pair."""
    order = np.lexsort((places, right, left))
    left, right, places = left[order], right[order], places[order]
    new = np.ones(len(places) + 1, bool)
    new[1:-1] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    again = ~(new[:-1] & new[1:])
    return places[again], (np.cumsum(new[:-1]))[again]


def _proposals(places: np.ndarray, names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, last place, distance) of every stretch of places whose
    successors are equally far, more than half of ``size`` and at most ``size``."""
    distance = places[1:] - places[:-1]
    near = (names[1:] == names[:-1]) & (2 * distance > size) & (distance <= size)
    at, distance = places[:-1][near], distance[near]
    order = np.argsort(at)
    at, distance = at[order], distance[order]
    if not len(at):
        return at, at, distance
    breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(distance) != 0)) + 1
    firsts = np.concatenate([[0], breaks])
    lasts = np.concatenate([breaks, [len(at)]]) - 1
    return at[firsts], at[lasts], distance[firsts]


def _extended(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
    """Moves every start down and every end up while the period holds."""
    growing = np.arange(len(start))
    while len(growing):
        at = start[growing] - 1
        holds = (at >= 0) & (words[at] == words[np.minimum(at + period[growing], len(words) - 1)])
        growing = growing[holds]
        start[growing] -= 1
    growing = np.arange(len(start))
    while len(growing):
        at = end[growing]
        inside = np.minimum(at, len(words) - 1)
        holds = (at < len(words)) & (words[inside] == words[inside - period[growing]])
        growing = growing[holds]
        end[growing] += 1


def word_runs(words: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and then period."""
    found = []
    if len(words) >= LEAST_WORDS:
        places = np.arange(len(words))
        places, names = _named(words, np.zeros(len(words), np.int64), places)
        size = 1
        # A period of more than a power's share of the text cannot make a run.
        while len(places) and size < 2 * (len(words) // LEAST_POWER):
            first, last, period = _proposals(places, names, size)
            likely = last - first > period
            first, last, period = first[likely], last[likely], period[likely]
            start, end = first.copy(), last + size + period
            _extended(words, start, end, period)
            found.append(np.stack([start, end - start, period], axis=1))
            # Factors of twice the length: both halves must occur again.
            name_at = np.zeros(len(words) + size, np.int64)
            name_at[places] = names
            whole = name_at[places + size] > 0
            places, names = places[whole], names[whole]
            places, names = _named(names, name_at[places + size], places)
            size *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.unique(np.concatenate(found), axis=0)
    runs = runs[runs[:, 1] >= np.maximum(LEAST_WORDS, LEAST_POWER * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(count: int, runs: np.ndarray) -> np.ndarray:
    """Which words no run holds after its first period."""
    inside = np.zeros(count + 1, np.int64)
    np.add.at(inside, runs[:, 0] + runs[:, 2], 1)
    np.add.at(inside, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(inside)[:-1] == 0


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, runs (by start, then period) and ``collapsed``, the
    words that no run holds after its first period, joined by one space."""

    @F.arrow_udf(FOUND)
    def found(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            counts, offsets, rows, texts = [], [0], [], []
            for value in column.cast(pa.large_binary()):
                # bytes.split() cuts at the white space of ASCII, as words do here.
                words = (value.as_py() or b"").split()
                runs = word_runs(numbered(words))
                if len(runs):
                    kept = kept_words(len(words), runs)
                    words_left = [word for word, stays in zip(words, kept) if stays]
                else:
                    words_left = words
                counts.append(len(words))
                rows.append(runs)
                offsets.append(offsets[-1] + len(runs))
                texts.append(b" ".join(words_left))
            flat = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
            entry = pa.StructArray.from_arrays(
                [pa.array(flat[:, k].copy()) for k in range(3)], ["start", "length", "period"]
            )
            yield pa.StructArray.from_arrays(
                [
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entry),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["n_words", "runs", "collapsed"],
            )

    added = ["n_words", "runs", "collapsed"]
    marked = docs.drop(*added, "_found").withColumn("_found", found(F.col(text)))
    return marked.withColumns({name: F.col("_found")[name] for name in added}).drop("_found")


#: Comparing products keeps the powers exact; runs come by start, then period, so the first of equals stays.
_BEST = """aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
    (best, run) -> CASE WHEN best IS NULL OR run.length * best.period > best.length * run.period
                        THEN run ELSE best END)"""


def digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Per row the number of runs, the run of the greatest power, and digests of
    all runs and of the collapsed text."""
    return found.withColumn("best", F.expr(_BEST)).selectExpr(
        f"`{id}`",
        "CAST(size(runs) AS BIGINT) AS n_runs",
        "best.start AS start",
        "best.length AS length",
        "best.period AS period",
        "1000 * best.length DIV best.period AS exponent_milli",
        "sha2(array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of the documents whose CRC-32 h of the decimal id ends in 0,
    the words from place a = g % n on repeat the first p = 1 + (n - a) / (3 + g % 8)
    of them, where g = h / 10; other texts stay as they are, as does a text
    without an id."""
    rows = docs.selectExpr("doc_id", "text", "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) AS h")
    space = r"[\\x20\\x09-\\x0D]+"
    words = f"filter(split(text, '{space}'), w -> w <> '')"
    rows = rows.selectExpr("doc_id", "text", "h DIV 10 AS g", f"CASE WHEN h % 10 = 0 THEN {words} END AS words")
    rows = rows.selectExpr("*", "CASE WHEN size(words) > 0 THEN CAST(g % size(words) AS INT) END AS a")
    rows = rows.selectExpr("*", "CAST(1 + (size(words) - a) DIV (3 + g % 8) AS INT) AS p")
    planted = "array_join(transform(words, (w, i) -> CASE WHEN i < a THEN w ELSE words[a + (i - a) % p] END), ' ')"
    return rows.selectExpr("doc_id", f"CASE WHEN a IS NULL THEN text ELSE {planted} END AS text")


def op11_runs(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(periodic_runs(with_planted_period(documents)))


#: Places of one text whose four words are the same are paired if a quarter of the
#: text or less apart; consecutive places at one distance make a stretch, and of
#: equal stretches the smallest distance is the period.
ORACLE_SQL = r"""
    WITH RECURSIVE crc_table AS MATERIALIZED (
      SELECT list(list_reduce(list_prepend(i, range(8)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crcs
      FROM (SELECT unnest(range(256)) AS i)),
    source AS (
      SELECT row_number() OVER () AS r, doc_id,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
             list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)) AS codes
      FROM documents),
    hashed AS (
      SELECT r, doc_id, ws, len(ws) AS n,
             xor(list_reduce(list_prepend(4294967295, codes), lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)])),
                 4294967295) AS h
      FROM source, crc_table),
    placed AS (
      SELECT r, doc_id, ws, n, coalesce(h % 10 = 0 AND n > 0, false) AS planted,
             CASE WHEN n > 0 THEN (h // 10) % n END AS a, h // 10 AS g FROM hashed),
    body AS MATERIALIZED (
      SELECT r, doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i:
               CASE WHEN i < a THEN ws[i + 1] ELSE ws[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] END)
             ELSE ws END AS ws
      FROM placed),
    words AS MATERIALIZED (SELECT r, n, unnest(range(n)) AS i, unnest(ws) AS w FROM body),
    fours AS (
      SELECT r, n, i, md5_number(concat_ws(' ', w, lead(w) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o)) AS four
      FROM words WINDOW o AS (PARTITION BY r ORDER BY i) QUALIFY lead(w, 3) OVER o IS NOT NULL),
    pairs AS (
      SELECT x.r, x.i, y.i - x.i AS q FROM fours x
      JOIN fours y ON x.r = y.r AND x.four = y.four AND y.i > x.i AND y.i - x.i <= x.n // 4),
    stretches AS (
      SELECT r, q, min(i) AS start, max(i) - min(i) + 4 + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs)
      GROUP BY r, q, island HAVING max(i) - min(i) + 4 + q >= greatest(6, 4 * q)),
    runs AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
    best AS (
      SELECT r, count(*) AS n_runs,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
             first(struct_pack(s := start, l := length, q := period)
                   ORDER BY length * 1000000000000 // period DESC, start, period) AS b
      FROM runs GROUP BY r),
    edges AS (
      SELECT r, i, sum(d) AS d FROM (
        SELECT r, start + period AS i, 1 AS d FROM runs UNION ALL SELECT r, start + length, -1 FROM runs)
      GROUP BY r, i),
    kept AS (
      SELECT r, string_agg(w, ' ' ORDER BY i) AS t FROM (
        SELECT r, i, w, sum(coalesce(d, 0)) OVER (PARTITION BY r ORDER BY i) AS inside
        FROM words LEFT JOIN edges USING (r, i)) WHERE inside = 0 GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period,
           1000 * b.l // b.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
           sha256(coalesce(t, '')) AS collapsed_sha256
    FROM body LEFT JOIN best USING (r) LEFT JOIN kept USING (r)"""
