"""Near duplicates against all pairs, components, hashing."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from brute import Groups, near_duplicates as brute_near
from brute import words as plain_words

from tripflow.llm import components, near, sigtree
from tripflow.llm import words as hashing

VOCABULARY = [f"w{k}" for k in range(400)]


def text_of(rng, count):
    return " ".join(rng.choice(VOCABULARY) for _ in range(count))


def edited(rng, text, share):
    return " ".join(rng.choice(VOCABULARY) if rng.random() < share else w for w in text.split())


def fixture_rows():
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "two words"), (7, "words two")]
    number = 10
    for count in (3, 8, 40, 150):
        for _ in range(12):
            base = text_of(rng, count)
            rows.append((number, base))
            for k in range(rng.randrange(4)):
                number += 1
                rows.append((number, edited(rng, base, (k + 1) * 0.02)))
            number += 1
    base = text_of(rng, 120)
    for _ in range(150):  # one large group of near copies, drifting apart
        rows.append((number, base))
        base = edited(rng, base, 0.01)
        number += 1
    rows += [(number + k, base) for k in range(60)]  # and of exact copies
    passage = text_of(rng, 60)
    for k in range(80):  # a passage that many texts share
        rows.append((number + 100 + k, passage + " " + text_of(rng, 20 + k)))
    rows.append((number + 500, text_of(rng, 20_000)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, size):
    rows = fixture_rows()
    frame = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, kept int")
    found = near.near_duplicates(frame.repartition(5), words=size)
    assert {tuple(row) for row in found.collect()} == brute_near(rows, size)


@pytest.mark.parametrize("rounds, direct, paired", [(0, 10**9, 0), (0, 0, 10**9), (2, 3, 3), (1, 0, 0)])
def test_every_way_through_a_posting_list(spark, monkeypatch, rounds, direct, paired):
    """Without leaders, by shingles only, with few of all, and by trees."""
    monkeypatch.setattr(near, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(near, "DIRECT", direct)
    monkeypatch.setattr(near, "PAIRED", paired)
    rows = fixture_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(row) for row in near.near_duplicates(frame, 2).collect()} == brute_near(rows, 2)


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, "a b c d e f"), (None, "x y z"), (5, "a b c d e f"), (5, "a b c d e f"), (None, None)]
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    got = sorted((tuple(row) for row in found.collect()), key=str)
    assert got == sorted(
        [(None, 5, 5, False), (None, 2, None, True), (5, 5, 5, True), (5, 5, 5, True), (None, 0, None, True)],
        key=str,
    )


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near.near_duplicates(empty).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 160)]
    links += [(500, k) for k in range(501, 600)] + [(3, 2), (2, 3), (900, 100), (7, 7)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    groups = Groups()
    for a, b in links:
        groups.link(a, b)
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(row) for row in found.collect()} == {(k, groups.find(k)) for k in groups.parent}


def test_word_hashes_depend_on_words_alone(monkeypatch):
    texts = ["The cat  sat\nthe CAT", None, "", " lead", "é ü x", "the\x0bthe\x0c\rcat", "a" * 5000]
    hasher = hashing.WordHasher()
    by_word = {}
    for text, found in zip(texts, hasher.each(pa.array(texts))):
        names = plain_words(text)
        assert len(found) == len(names)
        for name, value in zip(names, found):
            assert by_word.setdefault(name, value) == value
    assert len(set(by_word.values())) == len(by_word)
    whole = "".join(f"word{k} " for k in range(5000)) + "x" * 3000
    data = np.frombuffer(whole.encode(), np.uint8)
    expected = hasher.of(data)
    monkeypatch.setattr(hashing, "PIECE", 1000)
    assert (hasher.of(data) == expected).all()
    assert len(expected) == len(re.findall(r"\S+", whole))


def test_plan_has_no_cross_join(spark):
    classes = spark.createDataFrame([], near.SIGNATURES)
    plan = near._postings(classes)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_an_id_has_one_component(spark):
    """Id 5 bears the text of 3 and that of 9; id 8 a text and a blank one."""
    rows = [(3, "a b c d e f g"), (5, "a b c d e f g"), (5, "p q r s t u v"), (9, "p q r s t u v"),
            (2, "h i j k"), (8, "h i j k"), (8, " "), (6, "x y z x")]
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(3, 3), (5, 3), (9, 3), (2, 2), (8, 2), (6, 6)}
    assert {r.doc_id for r in found if r.kept} == {2, 3, 6}


def test_texts_of_few_words_are_not_paired_with_each_other(spark, monkeypatch):
    """Unlinked texts of 60 words out of 12: what is emitted grows with the texts, not with their pairs."""
    emitted = []
    candidates, compared = near._candidates, sigtree._compared

    def counted(pairs, *more):
        emitted.append(pairs.count())
        return candidates(pairs, *more)

    def counted_nodes(nodes, pairs, *more, **named):
        emitted.append(pairs.count())
        return compared(nodes, pairs, *more, **named)

    monkeypatch.setattr(near, "_candidates", counted)
    monkeypatch.setattr(sigtree, "_compared", counted_nodes)
    rng = random.Random(21)
    rows = [(k, " ".join(f"w{rng.randrange(12)}" for _ in range(60))) for k in range(2000)]
    sums = []
    for count in (500, 1000, 2000):
        emitted.clear()
        found = near.near_duplicates(spark.createDataFrame(rows[:count], "doc_id long, text string"), 2)
        assert {tuple(row) for row in found.collect()} == brute_near(rows[:count], 2)
        sums.append(sum(emitted))
    assert sums[1] <= 3 * sums[0] + 1000 and sums[2] <= 3 * sums[1] + 1000, sums
    assert sums[2] < 2000 * 1999 / 2 / 4, sums


def test_texts_of_candidates_need_one_python_worker_a_task(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"some words of text {k}") for k in range(200)], "id long, text string")
    pairs = spark.createDataFrame([(3, 5), (5, 190), (7, None)], "a long, b long")
    monkeypatch.setattr(near, "staged", lambda df, label: df)
    sets = near._sets_of(pairs, docs, 2)
    assert sorted(row.id for row in sets.collect()) == [3, 5, 7, 190]
    shown = sets._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "MapInArrow" in shown and "ArrowEvalPython" not in shown
