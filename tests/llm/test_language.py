"""Language ID: held-out accuracy on the given tables, edge rows."""

import re
import zlib

import numpy as np
import pytest

from tripflow.llm import language

SCHEMA = "doc_id long, text string, lang string, score string"
WORDS = {
    "en": "the and of with from house river morning light window garden letter through which",
    "de": "der die und nicht mit für haus fluß morgen licht fenster garten brief schön durch",
    "fr": "le la et dans avec pour maison rivière matin lumière fenêtre jardin lettre très où",
}


def rows_of(rng, count):
    rows = []
    for number in range(count):
        lang = list(WORDS)[number % 3]
        rows.append((number, " ".join(rng.choice(WORDS[lang].split(), 30)), lang, "x"))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = rows_of(np.random.default_rng(0), 90) + [(900, None, "en", "x"), (901, "no label", None, "x")]
    return language.fit(spark.createDataFrame(rows, SCHEMA))


def predicted(spark, model, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {row.doc_id: row for row in language.predict(frame, model).collect()}


def test_held_out_accuracy(spark, tables):
    """On the given documents, a third of them held out by their id."""
    from pyspark.sql import functions as F

    folder = tables.replace("sf0.001", "sf0.01")
    found = language.op3_langid(spark, folder)
    labels = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.join(labels, "doc_id").where(F.col("held_out")).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert found.count() == labels.count()


FOREIGN = [
    "Tämä on tavallinen suomenkielinen lause, jossa kerrotaan kesäisestä illasta järven rannalla ja saunasta.",
    "To jest zwykłe polskie zdanie o letnim wieczorze nad jeziorem, o starym domu i o ludziach, którzy tam mieszkają.",
    "Bu, göl kıyısında bir yaz akşamını ve eski bir evi anlatan sıradan bir Türkçe cümledir, içinde insanlar da var.",
    "Ini adalah kalimat bahasa Indonesia biasa tentang malam musim panas di tepi danau dan rumah tua yang indah.",
]


def test_foreign_sentences_are_rejected_and_own_texts_are_not(spark, tables):
    for scale in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(tables.replace("sf0.001", scale) + "/documents.parquet").select("doc_id", "text", "lang")
        remainder = language.crc32_mod("doc_id", 3)
        model = language.fit(docs.where(remainder != 1))
        assert all(row.rejected for row in predicted(spark, model, FOREIGN).values())
        held_out = language.predict(docs.where(remainder == 1), model)
        assert held_out.where("rejected").count() <= 0.005 * held_out.count()


def test_limits_rise_with_the_length_and_repetition_adds_no_length():
    counts = language.gram_counts("house " * 1000, language.letter_table())
    assert language.length_classes(counts) == language.length_classes(np.minimum(counts, 1))
    pieces = [{"lang": "en", "class": k, "cosine": c} for k in (3, 9) for c in np.linspace(k / 10, k / 10 + 0.05, 100)]
    limits = language._limits(pieces, {"en": 0.1, "de": 0.2})
    assert (limits["de"] == 0.2).all() and (limits["en"][:3] == 0.1).all()
    low, high = (language.SLACK * (k / 10 + 0.05 * language.QUANTILE) for k in (3, 9))
    assert np.allclose(limits["en"][3:9], low) and np.allclose(limits["en"][9:], high)


def test_predictions_by_a_plain_version(spark, model):
    """Cosines of dictionaries of n-grams, one text after the other."""
    def grams(text):
        kept = "".join(c if c.isalpha() else " " for c in text.lower())
        padded = f" {re.sub(' +', ' ', kept)} "
        return [padded[k : k + n] for n in (1, 2, 3) for k in range(len(padded) - n + 1)]

    def bucket(gram):
        value = ord(gram[0])
        for c in gram[1:]:
            value = (value * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
        return ((value + len(gram)) * 0xD6E8FEB86659FD93 % 2**64) >> 52

    texts = [r[1] for r in rows_of(np.random.default_rng(2), 12)] + ["die house", "la la", *FOREIGN]
    found = predicted(spark, model, texts)
    for k, text in enumerate(texts):
        vector = {}
        for gram in grams(text):
            vector[bucket(gram)] = vector.get(bucket(gram), 0) + 1
        vector = {b: float(np.log1p(n)) * float(model.weights[b]) for b, n in vector.items()}
        length = sum(x * x for x in vector.values()) ** 0.5
        cosines = [sum(x / length * float(c[b]) for b, x in vector.items()) for c in model.centroids]
        best = int(np.argmax(cosines))
        size = min(language.CLASSES - 1, int(2 * np.log2(len(vector))))
        assert found[k].lang_pred == model.languages[best]
        assert abs(found[k].score - cosines[best]) < 1e-5
        assert found[k].rejected == (cosines[best] < model.limits[best, size])


def test_predictions(spark, model):
    rows = rows_of(np.random.default_rng(1), 60)
    found = predicted(spark, model, [r[1] for r in rows])
    assert [found[k].lang_pred for k in range(60)] == [r[2] for r in rows]
    assert all(0.5 < row.score <= 1 and not row.rejected for row in found.values())


def test_edges(spark, model):
    texts = [None, "", "123 !! 4", "漢字漢字漢字", "the", "THE AND OF " * 20_000, "der die und " * 3 + "漢"]
    found = predicted(spark, model, texts)
    assert [found[k].lang_pred for k in range(3)] == ["und"] * 3
    assert all(found[k].rejected and found[k].score == 0 for k in range(3))
    assert found[3].rejected and found[3].lang_pred in WORDS  # far from every centroid
    assert found[5].lang_pred == "en" and found[6].lang_pred == "de" and not found[5].rejected


def test_columns_pass_and_are_replaced(spark, model):
    frame = spark.createDataFrame([(1, "the house", "en", "old")] * 2, SCHEMA)
    rows = language.predict(frame, model).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0].lang == "en" and rows[0].score != "old"


def test_nothing_to_learn_from(spark):
    empty = language.fit(spark.createDataFrame([], SCHEMA))
    assert predicted(spark, empty, ["the house"])[0].lang_pred == "und"
    assert language.predict(spark.createDataFrame([], SCHEMA), empty).count() == 0


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 20)
    monkeypatch.setattr(language, "LANGUAGES", 2)
    frame = spark.createDataFrame(rows_of(np.random.default_rng(2), 900), SCHEMA)
    sample = language._sample_counts(frame, "doc_id", "text", "lang")
    assert len({name for name, _ in sample}) == 2 and len(sample) < 2 * 40


def test_clusters_of_one_language():
    rows = np.zeros((40, 8), np.float32)
    rows[:20, 0] = rows[20:, 5] = 1
    found = language.spherical_kmeans(rows, 2)
    assert len(found) == 2 and (found @ rows.T).max(axis=0).min() > 0.99


def test_all_languages_are_learned(spark, monkeypatch):
    """Three languages in turns of two give the model of one turn."""
    frame = spark.createDataFrame(rows_of(np.random.default_rng(4), 90), SCHEMA)
    whole = language.fit(frame)
    monkeypatch.setattr(language, "LANGUAGES", 2)
    turns = language.fit(frame)
    assert sorted(set(turns.languages)) == sorted(WORDS) and turns.languages == whole.languages
    assert np.allclose(turns.centroids, whole.centroids) and np.allclose(turns.limits, whole.limits)
