"""Signature trees against all pairs."""

import random

import brute
import numpy as np
import pytest

from tripflow.llm import sigtree

SCHEMA = "doc_id long, text string, name string, n int"


def found_by(spark, rows, parts=4, **settings):
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(parts)
    found = sigtree.jaccard_groups(docs, **settings)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(tuple(row) for row in found.collect())


def plain(rows, words=4, percent=85):
    return sorted(row[:3] for row in brute.near_duplicates(rows, words, percent))


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        k = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[k] = f"new{rng.randrange(10**6)}"
        elif kind == 1 and len(words) > 1:
            del words[k]
        else:
            words.insert(k, f"more{rng.randrange(10**6)}")
    return " ".join(words)


def prose(rng, count, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def mixed_rows(seed=1):
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two three"), (7, "One Two three")]
    doc = 10
    passage = prose(rng, 60)
    for family in range(25):
        base = prose(rng, rng.choice([8, 12, 30, 80, 200, 600]))
        for _ in range(rng.choice([1, 2, 3, 8, 30])):
            edits = rng.randrange(1 + max(1, len(base.split()) // 60))
            rows.append((doc, edited(rng, base, edits)))
            doc += rng.randrange(1, 4)
    for _ in range(80):  # unlike texts around one passage
        rows.append((doc, prose(rng, rng.randrange(5, 60)) + " " + passage + " " + prose(rng, rng.randrange(5, 60))))
        doc += 1
    base = prose(rng, 250)
    words = base.split()
    for cut in range(0, 60, 3):  # a chain of ever shorter texts
        rows.append((doc, " ".join(words[cut:])))
        doc += 1
    rows += [(doc + k, rows[20][1].upper()) for k in range(4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("node", [sigtree.NODE, 1500])
def test_against_all_pairs(spark, monkeypatch, node):
    monkeypatch.setattr(sigtree, "NODE", node)
    rows = mixed_rows()
    assert found_by(spark, rows) == plain(rows)


@pytest.mark.parametrize("words, percent", [(2, 80), (3, 100)])
def test_other_sizes_and_thresholds(spark, words, percent):
    rows = mixed_rows(seed=words)
    assert found_by(spark, rows, words=words, percent=percent) == plain(rows, words, percent)


def test_a_large_group_of_copies_that_drift_apart(spark, monkeypatch):
    monkeypatch.setattr(sigtree, "NODE", 4000)
    rng = random.Random(11)
    base = prose(rng, 120)
    rows = [(k, edited(rng, base, rng.randrange(6))) for k in range(400)]
    assert found_by(spark, rows) == plain(rows)


def test_texts_of_few_words(spark, monkeypatch):
    monkeypatch.setattr(sigtree, "NODE", 3000)
    rng = random.Random(12)
    rows = [(k, prose(rng, 60, vocabulary=3)) for k in range(300)]
    assert found_by(spark, rows) == plain(rows)
    assert found_by(spark, rows, words=2, percent=80) == plain(rows, 2, 80)


def test_small_sets_at_the_threshold(spark):
    rng = random.Random(13)
    rows = []
    for doc in range(0, 400, 2):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(4, 24))]
        rows += [(doc, " ".join(base)), (doc + 1, " ".join(base[: len(base) - rng.randrange(1, 4)]))]
    for percent in (80, 85):
        assert found_by(spark, rows, words=1, percent=percent) == plain(rows, 1, percent)


def test_roots_are_shared_by_all_linked_sets():
    rng = np.random.default_rng(5)
    for percent in (80, 85, 90, 100):
        for _ in range(3000):
            n = int(rng.integers(1, 60))
            common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            own, other = (rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 2)), dtype=np.uint64) for _ in range(2))
            a, b = np.unique(np.concatenate([common, own])), np.unique(np.concatenate([common, other]))
            shared = len(np.intersect1d(a, b))
            if len(own) + len(other) and 100 * shared >= percent * (len(a) + len(b) - shared):
                met = np.intersect1d(sigtree.roots_of(a, percent), sigtree.roots_of(b, percent))
                assert len(met) > min(len(a), len(b)) // sigtree.EXTRA


def test_bounds_never_prune_a_link():
    rng = random.Random(6)
    sets = []
    for _ in range(12):
        base = [rng.randrange(10**9) for _ in range(rng.choice([20, 100, 300]))]
        for _ in range(20):
            sets.append(np.unique(np.array(base[rng.randrange(5):] + [rng.randrange(10**9) for _ in range(rng.randrange(6))])))
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sets = [sets[k] for k in order]
    tree = sigtree.Tree(np.arange(len(sets)), sizes[order], np.concatenate(sets), 512)
    links = sigtree.traverse(tree, tree, np.arange(len(sets)), 85)
    groups, expected = brute.Groups(), brute.Groups()
    for a, b in links:
        groups.link(a, b)
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                expected.link(a, b)
    assert [groups.find(k) for k in range(len(sets))] == [expected.find(k) for k in range(len(sets))]
    assert len(links) < len(sets)  # no more than join the components


def test_overlaps_are_counted_in_blocks(monkeypatch):
    monkeypatch.setattr(sigtree, "COLUMNS", 7)
    rng = np.random.default_rng(8)
    one, other = ([np.unique(rng.integers(0, 60, k).astype(np.uint64)) for k in range(1, n)] for n in (20, 15))
    found = sigtree._overlaps(one, other)
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in other] for a in one]


def test_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(14)
    one, two, three = (prose(rng, 100) for _ in range(3))
    rows = [(5, one), (5, two), (9, edited(rng, one, 1)), (7, two), (None, one), (None, three), (3, None), (3, "x y")]
    found = found_by(spark, [row for row in rows if row[0] is not None])
    component = {(doc, n): c for doc, n, c in found}
    assert {c for (doc, _), c in component.items() if doc in (5, 7, 9)} == {5}
    assert {c for (doc, _), c in component.items() if doc == 3} == {3}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nulls = [row for row in sigtree.jaccard_groups(docs).collect() if row.doc_id is None]
    assert sorted(str(row.component_id) for row in nulls) == ["5", "None"]


def test_a_very_long_text_and_no_rows(spark):
    rng = random.Random(15)
    long = prose(rng, 150_000, vocabulary=10**6)
    rows = [(1, long), (2, long + " end"), (3, prose(rng, 50)), (4, "A " * 100_000), (5, "a a a a a")]
    assert found_by(spark, rows) == plain(rows)
    assert found_by(spark, []) == []


def test_percent_has_a_least_value(spark):
    with pytest.raises(ValueError, match="80"):
        sigtree.jaccard_groups(spark.createDataFrame([], SCHEMA), percent=79)


def test_query_agrees_with_sql(spark, tables):
    duckdb = pytest.importorskip("duckdb")
    expected = duckdb.sql(sigtree.ORACLE_SQL.replace("FROM documents", f"FROM '{tables}/documents.parquet'"))
    found = sigtree.op12_jaccard(spark, tables)
    assert sorted(map(tuple, found.select(*expected.columns).collect())) == sorted(expected.fetchall())
