"""Periodic runs against a plain search over every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tripflow.llm import runs

SCHEMA = "doc_id long, text string, runs string, _found int"


def plain_runs(words):
    """(start, length, period): per period the maximal stretches, the smallest period of each."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start < len(words) - period:
            if words[start] != words[start + period]:
                start += 1
                continue
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if length >= max(6, 4 * period):
                found.setdefault((start, length), period)
            start = end
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]


def plain_row(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    found = plain_runs(words)
    best = min(found, key=lambda run: (-(run[1] / run[2]), run[0], run[2]), default=None)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_all_short_words_of_few_letters(letters):
    rng = random.Random(letters)
    for length in range(0, 60):
        for _ in range(25):
            words = [rng.choice("abc"[:letters]) for _ in range(length)]
            found = [tuple(map(int, run)) for run in runs.word_runs(runs.numbered(words))]
            assert found == plain_runs(words)


def test_repeated_stretches_within_prose():
    rng = random.Random(5)
    for _ in range(60):
        words = []
        while len(words) < 300:
            block = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 25))]
            words += block * rng.randrange(1, 7) + block[: rng.randrange(len(block) + 1)]
        found = [tuple(map(int, run)) for run in runs.word_runs(runs.numbered(words))]
        assert found == plain_runs(words)


def given():
    rng = random.Random(9)
    rows = [(None, "a a a a a a a", "x", 1), (1, None, "x", 1), (2, "", "x", 1), (3, " \n\t ", "x", 1)]
    rows += [(4, "a " * 5, "x", 1), (5, "a " * 6, "x", 1), (6, "Ä ß " * 4, "x", 1), (7, "A a A a A a", "x", 1)]
    rows += [(8, "a\x0bb\x0cc\r" * 4 + " " * 9, "x", 1), (8, "a\x0bb\x0cc\r" * 4, "y", 2)]
    for doc in range(20, 260):
        rows.append((doc, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 120))), "x", 1))
    return rows + rows[-3:]


def test_against_plain(spark):
    rows = given()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = runs.digest(runs.periodic_runs(runs.with_planted_period(docs.select("doc_id", "text")))).collect()
    expected = [plain_row(doc, text) for doc, text, _, _ in rows]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_columns_pass_through_and_names_that_clash_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a b " * 5, "x", 1)], SCHEMA).withColumn("extra", docs_literal())
    row = runs.periodic_runs(docs).first()
    assert row.extra == 7 and row.n_words == 10
    assert [tuple(run) for run in row.runs] == [(0, 10, 2)] and row.collapsed == "a b"


def docs_literal():
    from pyspark.sql import functions as F

    return F.lit(7)


def test_a_very_long_text(spark):
    words = [f"w{k}" for k in range(5_000)] * 40 + ["end"] * 50_000
    found = runs.word_runs(runs.numbered(words))
    assert found.tolist() == [[0, 200_000, 5_000], [200_000, 50_000, 1]]
    assert np.flatnonzero(runs.kept_words(len(words), found)).tolist() == [*range(5_000), 200_000]


def test_equal_powers_go_to_the_smaller_start(spark):
    text = "a b " * 4 + "x " + "c " * 6 + "y " + "d e f " * 8 + "z " + "g " * 8
    best = runs.digest(runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (best.n_runs, best.start, best.length, best.period, best.exponent_milli) == (4, 16, 24, 3, 8000)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert runs.digest(runs.periodic_runs(empty)).collect() == []


def test_query_agrees_with_sql(spark, tables):
    duckdb = pytest.importorskip("duckdb")
    expected = duckdb.sql(runs.ORACLE_SQL.replace("FROM documents", f"FROM '{tables}/documents.parquet'"))
    found = runs.op11_runs(spark, tables)
    assert sorted(map(tuple, found.select(*expected.columns).collect()), key=str) == sorted(expected.fetchall(), key=str)
