"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are the 32-bit hashes of its words, their first
``STEMS`` letters (stem unigrams), word pairs and skip-grams (pairs with one
word between), each once per text. FTRL-proximal keeps a learning rate per
coordinate and, by its L1 term, non-zero weights for a few thousand features
only; these are all that is sent to the executors.

The strength of the L1 term is chosen by ``FOLDS`` folds inside the learning sample:
of ``L1_CHOICES`` the one whose models find most in the fold they have not seen (F1 at
``THRESHOLD``). Few labels ask for a weaker term than many.

The model is fitted on a bounded sample: about ``TOXIC`` toxic and ``CLEAN``
other labelled texts, picked by a hash of the id. Features of fewer than
``LEAST_TEXTS`` of them are dropped before they reach the driver. Every text is scored whole,
in the partition where it is read: no shuffle.

Defined results: a null or empty text has no features and scores the model's
base rate; without labels of both kinds every score is the share of toxic
labels (0 without any); rows without an id or label are not learned from; if an
id bears several labels, toxic wins; repeated rows get the same score; an empty
table gives no rows. Columns named like the results are replaced, all others
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.words import WordHasher, mixed, text_bytes
from tripflow.llm.work import crc32_mod, staged, table

TOXIC, CLEAN = 2000, 4000
STEMS = (4, 6)
EPOCHS = 6
#: Features of fewer learning texts tell nothing of others.
LEAST_TEXTS = 4
#: FTRL-proximal: learning rate, its smoothing and L2.
ALPHA, BETA, L2 = 0.5, 1.0, 1.0
#: Strengths of the L1 term to choose from, the sparsest first, and folds and epochs to choose by.
L1_CHOICES, FOLDS, FOLD_EPOCHS = (7.0, 3.5, 1.75, 0.9), 4, 3
THRESHOLD = 0.3
_FILTER_BITS = 20
#: Bytes of a learning text's features that give its place in the order of learning.
_ORDER_BYTES = 256


@dataclass(frozen=True)
class ToxicityModel:
    features: np.ndarray  # sorted uint32
    weights: np.ndarray
    bias: float


class Featurizer(WordHasher):
    """Words are runs of ASCII letters and non-ASCII bytes."""

    def __init__(self) -> None:
        super().__init__(bytes(b for b in range(128) if not chr(b).isalpha()), STEMS)

    def features(self, data: np.ndarray) -> np.ndarray:
        """Hashes of all features of one text, not yet distinct."""
        found = self.of(data)
        words = found[0]
        kinds = [*found, _pair(words[:-1], words[1:], 1), _pair(words[:-2], words[2:], 2)]
        salted = [mixed(kind + np.uint64(k)) for k, kind in enumerate(kinds)]
        return (np.concatenate(salted) >> np.uint64(32)).astype(np.uint32)


def _pair(first: np.ndarray, second: np.ndarray, gap: int) -> np.ndarray:
    size = min(len(first), len(second))
    return first[:size] * np.uint64(0x9E3779B97F4A7C15) + second[:size] + np.uint64(gap)


def ftrl(
    texts: list[np.ndarray], labels: np.ndarray, size: int, l1_term: float, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Weights of ``size`` features and the bias, learned text by text."""
    z, n = np.zeros(size), np.zeros(size)
    bias_z, bias_n = 0.0, 0.0
    order = np.random.default_rng(11).permutation(len(texts))

    def weight(z, n, l1):
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    for _ in range(epochs):
        for k in order:
            own = texts[k]
            w, bias = weight(z[own], n[own], l1_term), weight(bias_z, bias_n, 0.0)
            score = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = score - labels[k]
            rate = (np.sqrt(n[own] + g * g) - np.sqrt(n[own])) / ALPHA
            z[own] += g - rate * w
            n[own] += g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
    return weight(z, n, l1_term), float(weight(bias_z, bias_n, 0.0))


def f1(found: np.ndarray, labels: np.ndarray) -> float:
    both = float((found & (labels > 0)).sum())
    return 2 * both / max(1.0, float(found.sum() + (labels > 0).sum()))


def chosen_l1(texts: list[np.ndarray], labels: np.ndarray, size: int) -> float:
    """The L1 term that does best on folds left out; of equal ones the sparsest."""
    fold = np.empty(len(texts), np.int64)
    for label in (0, 1):  # as many of each label in every fold, give or take one
        own = np.flatnonzero(labels == label)
        fold[own] = np.random.default_rng(5).permutation(len(own)) % FOLDS
    best = []
    for l1_term in L1_CHOICES:
        found = np.zeros(len(texts), bool)
        for left_out in range(FOLDS):
            kept = np.flatnonzero(fold != left_out)
            weights, bias = ftrl([texts[k] for k in kept], labels[kept], size, l1_term, FOLD_EPOCHS)
            line = np.log(THRESHOLD / (1 - THRESHOLD))
            for k in np.flatnonzero(fold == left_out):
                found[k] = weights[texts[k]].sum() + bias >= line
        best.append(f1(found, labels))
    return L1_CHOICES[int(np.argmax(best))]


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> ToxicityModel:
    """``labels`` has the id and ``toxic`` (0 or 1)."""
    known = labels.where(F.col(id).isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(id).agg(F.max("toxic").alias("_toxic"))
    sizes = {row[0]: row[1] for row in known.groupBy(F.col("_toxic") > 0).count().collect()}
    scale = 1 << 30
    limit = F.when(F.col("_toxic") > 0, min(scale, scale * TOXIC // max(1, sizes.get(True, 0))))
    limit = limit.otherwise(min(scale, scale * CLEAN // max(1, sizes.get(False, 0))))
    picked = known.where(F.pmod(F.xxhash64(F.col(id)), F.lit(scale)) < limit)
    # Bounded by TOXIC and CLEAN, whatever the size of the table of labels.
    rows = docs.select(id, text).join(F.broadcast(picked), id).select("_toxic", text)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Featurizer()
        for batch in batches:
            found = [np.unique(hasher.features(d)).view(np.int32) for d in text_bytes(batch.column(1))]
            labels = batch.column(0).cast(pa.int32())
            lists = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([labels, lists], ["y", "x"])

    learned = staged(rows.mapInArrow(features, "y int, x array<int>"), "learned")
    often = learned.select(F.explode("x").alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    often = often.where(F.col("n") >= LEAST_TEXTS).select("f").toPandas()["f"]
    known_features = np.sort(often.to_numpy(np.int32).view(np.uint32))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders, found = [], []
            for k in range(batch.num_rows):
                own = batch.column(1)[k].values.to_numpy().view(np.uint32)
                orders.append(own.tobytes()[:_ORDER_BYTES])
                at = np.searchsorted(known_features, own)
                at = at[at < len(known_features)]
                found.append(at[known_features[at] == own[: len(at)]].astype(np.int32).tobytes())
            columns = [batch.column(0), pa.array(orders, pa.binary()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["y", "o", "x"])

    sample = learned.mapInArrow(places, "y int, o binary, x binary").collect()
    sample = sorted((int(row.y > 0), bytes(row.o), bytes(row.x)) for row in sample)
    labels_of = np.array([y for y, *_ in sample], float)
    if len(set(labels_of)) < 2:
        share = float(labels_of.mean()) if len(sample) else 0.0
        share = min(max(share, 1e-9), 1 - 1e-9)
        return ToxicityModel(np.empty(0, np.uint32), np.empty(0), float(np.log(share / (1 - share))))
    texts = [np.frombuffer(x, np.int32) for *_, x in sample]
    strength = chosen_l1(texts, labels_of, len(known_features))
    weights, bias = ftrl(texts, labels_of, len(known_features), strength)
    used = weights != 0
    return ToxicityModel(known_features[used], weights[used], bias)


def predict(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``THRESHOLD`` on)."""

    @F.arrow_udf("double")
    def toxic(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Featurizer()
        low = np.uint32((1 << _FILTER_BITS) - 1)
        maybe = np.zeros(1 << _FILTER_BITS, bool)
        maybe[model.features & low] = True
        for column in columns:
            scores = np.empty(len(column))
            for place, data in enumerate(text_bytes(column)):
                found = hasher.features(data)
                found = np.unique(found[maybe[found & low]])
                at = np.searchsorted(model.features, found)
                at = at[at < len(model.features)]
                known = model.features[at] == found[: len(at)]
                scores[place] = model.weights[at[known]].sum() + model.bias
            yield pa.array(1 / (1 + np.exp(-np.clip(scores, -35, 35))))

    found = docs.drop("score", "predicted").withColumn("score", toxic(F.col(text)))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = crc32_mod("doc_id", 4)
    labels = table(spark, sf_dir, "labels").where(remainder != 2).select("doc_id", "toxic")
    model = fit(documents, labels)
    held_out = F.coalesce(remainder == 2, F.lit(False))
    found = predict(documents.withColumn("held_out", held_out), model)
    return found.select("doc_id", "held_out", "score", "predicted")
