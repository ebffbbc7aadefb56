"""Greedy string tiling against a plain version; planted passages."""

import random

import pyarrow as pa
import pytest
from brute import words as plain_words

from tripflow.llm import decontam
from tripflow.llm.words import WordHasher


def plain_tiles(item, doc, least):
    """Longest common unmarked runs, one size after the other."""
    free_item, free_doc, covered = [True] * len(item), [True] * len(doc), 0
    for size in range(min(len(item), len(doc)), least - 1, -1):
        for i in range(len(item) - size + 1):
            if not all(free_item[i : i + size]):
                continue
            for d in range(len(doc) - size + 1):
                if item[i : i + size] == doc[d : d + size] and all(free_doc[d : d + size]):
                    free_item[i : i + size] = [False] * size
                    free_doc[d : d + size] = [False] * size
                    covered += size
                    break
    return covered


def plain_matches(docs, items):
    found = set()
    for doc_id, text in docs:
        doc = plain_words(text)
        for item_id, passage in items:
            item = plain_words(passage)
            least = min(decontam.MIN_MATCH, len(item))
            covered = plain_tiles(item, doc, least) if item else 0
            if item and 100 * covered >= decontam.PERCENT * len(item):
                found.add((doc_id, item_id, len(item), covered))
    return found


def given():
    rng = random.Random(5)
    vocabulary = [f"t{k}" for k in range(60)]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(pick(rng.randrange(10, 40)))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "only three words"), (23, items[0][1]), (24, "a " * 12)]
    docs = [(0, None), (1, ""), (2, "only three words"), (3, "three words only"), (4, "A a " * 400)]
    number = 10
    for _, passage in items[:12]:
        own = passage.split()
        half = len(own) // 2
        for variant in (own, own[half:] + pick(3) + own[:half], own[: int(len(own) * 0.85)],
                        own[: int(len(own) * 0.7)], own[::2], own[:6] + own, own + pick(5) + own):
            docs.append((number, " ".join(pick(30) + variant + pick(30)).upper()))
            number += 1
    docs.append((number, " ".join(pick(20_000))))
    docs.append((number + 1, "\n".join(p for _, p in items if p)))
    docs.append(docs[10])
    return docs, items


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_matches(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", block_words)
    docs, items = given()
    small = [d for d in docs if len(d[1] or "") < 5000]
    frame = spark.createDataFrame([(i, t, 1) for i, t in small], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.contained_items(frame.repartition(3), bench).collect()
    got = {(r.doc_id, r.item_id, r.item_words, r.covered_words) for r in rows}
    assert got == plain_matches(small, items)
    texts, passages = dict(small), dict(items)
    for row in rows:
        doc, item, covered = plain_words(texts[row.doc_id]), plain_words(passages[row.item_id]), set()
        for t in row.tiles:
            run = item[t.item_start : t.item_start + t.length]
            assert run == doc[t.doc_start : t.doc_start + t.length]
            covered |= set(range(t.item_start, t.item_start + t.length))
        assert len(covered) == row.covered_words


def test_long_text_holds_passage(spark):
    docs, items = given()
    long = docs[-3][1] + " " + items[3][1] + " " + docs[-3][1]
    frame = spark.createDataFrame([(1, long)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert 3 in {r.item_id for r in decontam.contained_items(frame, bench).collect()}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    filled = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.contained_items(docs, bench).count() == 0
    assert decontam.contained_items(docs, filled).count() == 0
    assert decontam.contained_items(filled.withColumnRenamed("item_id", "doc_id"), bench).count() == 0


def test_tiles_do_not_overlap():
    hasher = WordHasher()
    item, doc = hasher.each(pa.array(["a b c d e f g h i j", "f g h i j x a b c d e f"]))
    assert decontam.tiles(item, doc, 5) in ([(0, 6, 6)], [(0, 6, 6), (5, 0, 5)][:1])
