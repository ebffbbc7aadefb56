"""Line dedup against plain Python, both ways of deleting lines."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripflow.llm import lines

SCHEMA = "doc_id long, text string, source string, n_lines string"


def plain(rows):
    bare = lambda line: line.strip(lines.SPACES)
    judged = lambda line: bare(line) != ""
    sites, first = defaultdict(set), {}
    for doc, text, site, _ in rows:
        for line in (text or "").split("\n"):
            if judged(line):
                sites[bare(line)] |= {site} - {None}
                if doc is not None:
                    first[bare(line)] = min(doc, first.get(bare(line), doc))
    spread = {line for line, where in sites.items() if len(where) >= lines.MIN_SITES}
    out = []
    for doc, text, site, _ in rows:
        if text is None:
            out.append((doc, None, 0, 0))
            continue
        every = text.split("\n")
        left = [
            line for line in every
            if not (judged(line) and bare(line) in spread and doc is not None and first[bare(line)] != doc)
        ]
        out.append((doc, "\n".join(left), len(every), len(every) - len(left)))
    return sorted(out, key=str)


def given():
    rng = random.Random(8)
    common = [f"shared line number {k} here" for k in range(30)]
    rows = [(1, None, "s0", "x"), (2, "", "s1", "x"), (3, "\n\n", "s2", "x"), (None, common[0], "s3", "x")]
    rows += [(4, "two words", f"s{k}", "x") for k in range(9)]
    for doc in range(10, 160):
        own = [f"own line of document {doc} {k}" for k in range(4)]
        picked = [line for k, line in enumerate(common) if rng.random() < (k + 1) / 300]
        text = own + picked + [f"  {line}\r" for line in picked[:1]] + ["all rights reserved"]
        rng.shuffle(text)
        site = None if doc % 17 == 0 else "hot" if doc % 3 == 0 else f"s{rng.randrange(12)}"
        rows.append((doc, "\n".join(text), site, "x"))
    rows += [rows[20], rows[21]]
    rows.append((500, "\n".join(f"long text line {k}" for k in range(20_000)) + "\n" + common[29], "s1", "x"))
    return rows


@pytest.mark.parametrize("table", [lines.TABLE, -1])
def test_against_plain(spark, monkeypatch, table):
    monkeypatch.setattr(lines, "TABLE", table)
    rows = given()
    found = lines.dedup_lines(spark.createDataFrame(rows, SCHEMA).repartition(4))
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()]
    assert sorted(got, key=str) == plain(rows)


@pytest.mark.parametrize("table", [lines.TABLE, -1])
def test_lines_of_one_first_hash_are_told_apart(spark, monkeypatch, table):
    """Both ways compare both hashes, also where two spread lines share the first."""
    monkeypatch.setattr(lines, "TABLE", table)
    schema = "h1 long, h2 long, first long"
    own = spark.range(1).select(*[h[0] for h in lines._hashes_of(F.lit("x"))]).first()
    spread = spark.createDataFrame([(own[0], own[1] - 1, 0), (own[0], own[1], 0), (own[0], own[1] + 1, 2)], schema)
    docs = spark.createDataFrame([(0, "x", "s", "n"), (1, "x\ny", "s", "n"), (2, "x", "s", "n")], SCHEMA)
    if table < 0:
        marked = lines._marked_by_join(docs, spread, lines.line_rows(docs, "doc_id", "text", "source"), "doc_id", "text", "m")
    else:
        marked = lines._marked_by_table(docs, spread, "doc_id", "text", "m")
    assert {r.doc_id: r.m for r in marked.collect()} == {0: [False], 1: [True, False], 2: [True]}


def test_empty_table_and_columns(spark):
    found = lines.dedup_lines(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0
    assert found.columns == ["doc_id", "text", "source", "n_lines", "n_removed"]


def short_lines():
    """"Share" and "Read more" on five sites each, "Home page" on four, blank lines on all."""
    rows = []
    for k in range(6):
        said = [f"own line of document {k}", " Share\r", "", "Read more"] + ["Home page"] * (k < 4)
        rows.append((k, "\n".join(said), f"s{k % 5}", "x"))
    return rows


@pytest.mark.parametrize("table", [lines.TABLE, -1])
def test_short_lines_are_judged_by_their_sites(spark, monkeypatch, table):
    monkeypatch.setattr(lines, "TABLE", table)
    found = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(short_lines(), SCHEMA)).collect()}
    assert found[0].text == short_lines()[0][1] and found[0].n_removed == 0
    for k in range(1, 6):
        own = [f"own line of document {k}", ""] + ["Home page"] * (k < 4)
        assert found[k].text == "\n".join(own) and found[k].n_removed == 2


def test_a_word_minimum_can_be_asked_for(spark):
    docs = spark.createDataFrame(short_lines(), SCHEMA)
    removed = lambda least: [r.n_removed for r in lines.dedup_lines(docs, min_words=least).orderBy("doc_id").collect()]
    assert removed(2) == [0] + [1] * 5 and removed(3) == [0] * 6
