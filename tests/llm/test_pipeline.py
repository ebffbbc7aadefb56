"""The stages of the pipeline against plain versions, and the whole run."""

import random
import re

import pytest
from brute import near_duplicates
from test_decontam import plain_matches
from test_lines import plain as plain_lines
from test_packing import check as check_packing

import corpus_pipeline as pipeline
tokenizers = pytest.importorskip("tokenizers")
from test_packing import PATH  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, kept string"
EN = "the and of to that with from this house river morning light window garden letter".split()
DE = "der die und nicht mit für haus fluß morgen licht fenster garten brief schön".split()


def documents():
    rng = random.Random(12)
    say = lambda words, n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    item = say(EN, 30)
    rows = []

    def add(text, lang, source=None):
        number = len(rows) + 1
        rows.append((number, text, lang, source or f"s{number % 9}", len(text or ""), "x", "y"))

    for k in range(60):
        lang, words = ("en", EN) if k % 2 else ("de", DE)
        add("\n".join([say(words, 12) for _ in range(4)] + ["all rights reserved here"] * (k % 3 == 0)), lang, f"s{k // 3 % 9}")
    base = say(EN, 120)
    for k in range(8):
        add(base if k < 4 else base + " " + say(EN, 3), "en", "s1")
    add(None, "en"), add("", "de"), add("12345 !!! 678", None), add("日本語 テキスト", None)
    add(say(EN, 40) + " " + item + " " + say(EN, 10), "en")
    half = item.split()
    add(" ".join(half[15:]) + " " + say(EN, 8) + " " + " ".join(half[:15]), "en")
    add(say(EN, 9000), "en")
    return rows, [(1, item), (2, None), (3, say(DE, 20))]


@pytest.fixture
def folder(spark, tmp_path):
    rows, items = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def collected(df):
    return sorted(tuple(row) for row in df.collect())


def test_stages(spark, folder):
    rows, items = documents()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = pipeline.staged(pipeline.language_id(spark, docs, folder), "t")
    kept = [r for r in rows if r[1] and re.search(r"[a-z]", r[1])]
    assert [r for r in collected(docs) if r[1] != "日本語 テキスト"] == kept

    before = collected(docs)
    docs = pipeline.staged(pipeline.line_dedup(spark, docs, folder), "t")
    plain = plain_lines([(r[0], r[1], r[3], "") for r in before])
    left = {i: t for i, t, _, removed in plain if not removed or t.strip()}
    after = collected(docs)
    assert {r[0]: r[1] for r in after} == left
    assert all(r[4] == len(r[1]) and r[5:] == ("x", "y") for r in after)
    assert any(r[3] for r in plain)

    docs = pipeline.staged(pipeline.near_dedup(spark, docs, folder), "t")
    stay = {i for i, _, _, kept in near_duplicates([r[:2] for r in after], 5) if kept}
    unique = collected(docs)
    assert unique == [r for r in after if r[0] in stay] and len(unique) < len(after)

    docs = pipeline.staged(pipeline.decontaminate(spark, docs, folder), "t")
    small = [r[:2] for r in unique if len(r[1]) < 20_000]
    leaked = {doc for doc, *_ in plain_matches(small, items)}
    clean = collected(docs)
    assert leaked and clean == [r for r in unique if r[0] not in leaked]

    packed = pipeline.pack(spark, docs, folder).collect()
    check_packing(packed, {r[0]: r[1] for r in clean}, tokenizers.Tokenizer.from_file(PATH))


def test_line_dedup_calls_python_once_a_task(spark, folder):
    """Two Python functions in a task start two workers, which stay with the executor."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = pipeline.line_dedup(spark, docs, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython ") == 1


def test_run_is_the_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = pipeline.staged(stage(spark, docs, folder), "t")
    want = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in docs.collect()}
    got = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in pipeline.run(spark, folder).collect()}
    assert got == want and want


def test_repeated_and_missing_ids(spark, tmp_path):
    rows = [(1, "a b c d e f g", "en", "s", 1, "", ""), (1, "a b c d e f g", "en", "s", 1, "", ""),
            (None, "x y z q r s t", "en", "s", 1, "", ""), (2, "A b c d e f g", "en", "s", 1, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(collected_ids(pipeline.near_dedup(spark, docs, "")), key=str) == [1, None]


def test_no_text_is_lost_where_ids_repeat_or_are_missing(spark):
    """Id 5 bears a copy of 3 and a text copied by 9; three rows without an id: two copies, one text of its own."""
    one, two, three = "a b c d e f g", "p q r s t u v", "h i j k l m n"
    said = [(3, one), (5, one), (5, two), (9, two), (None, one), (None, three), (None, three), (7, "x y z"), (7, "w w w")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "", "") for i, t in said], SCHEMA).repartition(3)
    found = pipeline.near_dedup(spark, docs, "")
    assert found.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in found.collect()), key=str)
    assert kept == sorted([(3, one), (5, two), (None, three), (7, "x y z"), (7, "w w w")], key=str)


def collected_ids(df):
    return [row.doc_id for row in df.collect()]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_batches_are_only_lowered(spark, conf):
    from tripflow.llm.work import bounded_batches

    rows, size = (f"spark__sql__execution__arrow__max{k}PerBatch" for k in ("Records", "Bytes"))
    conf(**{rows: "50", size: "1048576b"})
    bounded_batches(spark)
    assert spark.conf.get(rows.replace("__", ".")) == "50"
    conf(**{rows: "10000", size: "67108864b"})
    bounded_batches(spark)
    assert spark.conf.get(rows.replace("__", ".")) == "1000"
    assert int(spark.conf.get(size.replace("__", ".")).rstrip("b")) == 16 << 20


@pytest.mark.parametrize("stage", [stage for _, stage in pipeline.STAGES])
def test_stages_send_small_batches_to_python(spark, conf, tmp_path, stage):
    rows, size = (f"spark__sql__execution__arrow__max{k}PerBatch" for k in ("Records", "Bytes"))
    conf(**{rows: "10000", size: "67108864b"})
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage(spark, spark.createDataFrame([], SCHEMA), str(tmp_path))
    assert int(spark.conf.get(rows.replace("__", "."))) <= 256
    assert int(spark.conf.get(size.replace("__", ".")).rstrip("b")) <= 4 << 20
