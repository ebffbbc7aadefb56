"""Toxicity: held-out results, sparsity, edge rows."""

import numpy as np
import pytest

from tripflow.llm import toxicity

SCHEMA = "doc_id long, text string, score string"
PLAIN = [f"plain{k}" for k in range(300)]
BAD = ["scoundrel", "wretchedness", "wretchedly", "wretched"]


def rows_of(rng, first, count):
    rows, labels = [], []
    for number in range(first, first + count):
        words = list(rng.choice(PLAIN, 40))
        toxic = number % 4 == 0
        if toxic:
            words[5] = rng.choice(BAD)
            words[20] = rng.choice(BAD)
        rows.append((number, " ".join(words), "x"))
        labels.append((number, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = rows_of(np.random.default_rng(0), 0, 400)
    labels += [(0, 0), (None, 1), (5, None), (99_999, 1)]
    return toxicity.fit(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    )


def predicted(spark, model, texts):
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], SCHEMA)
    return [row for row in sorted(toxicity.predict(frame, model).collect())]


def test_held_out(spark, fitted):
    rows, labels = rows_of(np.random.default_rng(1), 1000, 200)
    found = predicted(spark, fitted, [r[1] for r in rows])
    assert [row.predicted for row in found] == [toxic for _, toxic in labels]
    assert all(0 <= row.score <= 1 for row in found)
    assert len(fitted.features) < 300


def test_stems_carry_over(spark, fitted):
    """A form never learned from, of a stem that was."""
    base = " ".join(PLAIN[:30])
    low, high = predicted(spark, fitted, [base, f"{base} wretchedest"])
    assert high.score > low.score + 0.1


def test_edges(spark, fitted):
    texts = [None, "", "123 !!", "SCOUNDREL! Wretched.", "plain1 " * 20_000 + "wretched scoundrel"]
    found = predicted(spark, fitted, texts)
    assert found[0].score == found[1].score == found[2].score
    assert found[0].predicted == 0 and found[3].score > found[0].score
    assert found[4].predicted == 1


def test_without_labels_of_both_kinds(spark):
    rows, _ = rows_of(np.random.default_rng(2), 0, 6)
    docs = spark.createDataFrame(rows, SCHEMA)
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert predicted(spark, none, ["a"])[0].score < 1e-6
    ones = toxicity.fit(docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int"))
    assert predicted(spark, ones, ["a"])[0].score > 1 - 1e-6
    assert toxicity.predict(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "TOXIC", 20)
    monkeypatch.setattr(toxicity, "CLEAN", 30)
    learn = toxicity.ftrl
    monkeypatch.setattr(toxicity, "ftrl", lambda x, y, n, *more: seen.append(len(x)) or learn(x, y, n, *more))
    rows, labels = rows_of(np.random.default_rng(3), 0, 800)
    toxicity.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert 20 < seen[-1] < 90 and all(n < seen[-1] for n in seen[:-1])


def test_rates_are_per_coordinate():
    """A rare coordinate still moves after a frequent one has settled."""
    texts = [np.array([0]), np.array([0, 1])] * 50 + [np.array([0, 2])] * 10
    labels = np.array([0.0, 1.0] * 50 + [1.0] * 10)
    weights, _ = toxicity.ftrl(texts, labels, 4, 7.0)
    assert weights[1] > 0 and weights[2] > 0 and weights[3] == 0


def test_rare_features_do_not_reach_the_driver(spark, monkeypatch):
    """Words of one text each are dropped in Spark; the sample keeps its full size."""
    assert (toxicity.TOXIC, toxicity.CLEAN) == (2000, 4000)
    seen = []
    learn = toxicity.ftrl
    monkeypatch.setattr(toxicity, "ftrl", lambda x, y, n, *more: seen.append((x, n)) or learn(x, y, n, *more))
    docs = [(k, f"same words here own{k} rare{k}" + " wretched" * (k % 2), "x") for k in range(40)]
    labels = [(k, k % 2) for k in range(40)]
    model = toxicity.fit(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    )
    texts, size = seen[-1]  # the folds come first
    assert len(texts) == 40 and size < 30 and max(len(x) for x in texts) <= size
    assert len(model.features) <= size and all(x.dtype == np.int32 for x in texts)


def test_the_l1_term_is_chosen_on_folds(monkeypatch):
    """A word of few texts needs a weak term, and unseen folds tell; equal terms go to the sparsest."""
    rng = np.random.default_rng(4)
    texts = [np.unique(rng.integers(1, 40, 12)).astype(np.int32) for _ in range(400)]
    labels = (np.arange(400) % 10 == 0).astype(float)
    told = [np.append(x, 0).astype(np.int32) if y else x for x, y in zip(texts, labels)]
    assert toxicity.chosen_l1(told, labels, 40) in toxicity.L1_CHOICES
    monkeypatch.setattr(toxicity, "L1_CHOICES", (500.0, 1.0))
    assert toxicity.chosen_l1(told, labels, 40) == 1.0
    monkeypatch.setattr(toxicity, "L1_CHOICES", (600.0, 500.0))
    assert toxicity.chosen_l1(told, labels, 40) == 600.0


def test_scores_by_a_plain_version(spark):
    """FTRL-proximal on dictionaries, one text and one feature after the other."""
    rows, labels = rows_of(np.random.default_rng(6), 0, 60)
    hasher = toxicity.Featurizer()
    sets = [set(hasher.features(np.frombuffer(r[1].encode(), np.uint8)).tolist()) for r in rows]
    known = sorted({f for s in sets for f in s if sum(f in other for other in sets) >= toxicity.LEAST_TEXTS})
    of = {doc: y for doc, y in labels}
    texts = [np.array([known.index(f) for f in sorted(s) if f in set(known)], np.int32) for s in sets]
    y = np.array([of[r[0]] for r in rows], float)
    found, bias = toxicity.ftrl(texts, y, len(known), 1.75)
    z, n, bias_z, bias_n = {}, {}, 0.0, 0.0

    def weight(z, n, l1):
        return 0.0 if abs(z) <= l1 else -(z - np.sign(z) * l1) / ((toxicity.BETA + n**0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for k in np.random.default_rng(11).permutation(len(texts)):
            w = {f: weight(z.get(f, 0.0), n.get(f, 0.0), 1.75) for f in texts[k].tolist()}
            b = weight(bias_z, bias_n, 0.0)
            g = 1 / (1 + np.exp(-(sum(w.values()) + b))) - y[k]
            for f, value in w.items():
                old = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / toxicity.ALPHA * value
                n[f] = old + g * g
            step = ((bias_n + g * g) ** 0.5 - bias_n**0.5) / toxicity.ALPHA
            bias_z, bias_n = bias_z + g - step * b, bias_n + g * g
    expected = np.array([weight(z.get(f, 0.0), n.get(f, 0.0), 1.75) for f in range(len(known))])
    assert np.allclose(found, expected, atol=1e-9) and abs(bias - weight(bias_z, bias_n, 0.0)) < 1e-9
    model = toxicity.ToxicityModel(np.array(known, np.uint32), found, bias)
    for own, row in zip(texts, predicted(spark, model, [r[1] for r in rows])):
        assert abs(row.score - 1 / (1 + np.exp(-(expected[own].sum() + bias)))) < 1e-9
