"""Language identification by nearest centroid.

A text is a vector of hashed 1- to 3-grams of its letters (other characters
count as one space), log term frequency times inverse document frequency,
scaled to length one. Each language is described by ``CLUSTERS`` centroids of
spherical k-means; a text takes the language of the centroid at the highest
cosine. It is rejected when that cosine is below the limit of the language for
texts of its length (in different n-grams): a low quantile (``QUANTILE``) of the
cosines that pieces of that length of the learning texts have, times ``SLACK``, and
never less than ``REJECT`` times their usual cosine. Short texts meet fewer n-grams of
their language, so one limit for all lengths would reject short texts or accept
long foreign ones.

The classifier is fitted on a bounded sample: at most about ``SAMPLE`` texts of
each language, picked by a hash of the id. The samples of at most ``LANGUAGES``
languages are on the driver at a time; with more, they come in turns, twice,
for the frequencies and for the centroids. Every text is predicted whole.

Defined results: a null text and one without letters are ``und``, score 0,
rejected; without anything to learn from every text is; ties go to the first
language in alphabetical order; rows without a language or id are not learned
from; repeated rows get the same answer; an empty table gives no rows. Columns
named like the results are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.work import crc32_mod, fresh, table

UNKNOWN = "und"
SAMPLE = 300
#: Languages whose samples are on the driver at a time; all are learned.
LANGUAGES = 100
CLUSTERS = 4
ROUNDS = 12
BUCKETS = 4096
#: Share of a learning text's usual cosine under which a text of any length is rejected.
REJECT = 0.15
#: Quantile of the cosines of pieces of one length, and the share of it that is the limit.
QUANTILE, SLACK = 0.05, 0.55
#: Characters of the shortest pieces, and the number of length classes.
PIECE, CLASSES = 12, 25
_TOGETHER = 256

RESULT = "struct<lang_pred:string,score:double,rejected:boolean>"


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    weights: np.ndarray  # inverse document frequency by bucket
    limits: np.ndarray  # least accepted cosine, by centroid and length class


def letter_table() -> np.ndarray:
    return np.fromiter((chr(k).isalpha() for k in range(0x110000)), bool, 0x110000)


def gram_counts(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Counts of hashed n-grams; None for a text without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[codes]
    if not is_letter.any():
        return None
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]  # of a run of other characters the first stays, as a space
    codes = np.where(is_letter, codes, 32)[kept].astype(np.uint64)
    codes = np.concatenate([[np.uint64(32)], codes, [np.uint64(32)]])
    found = []
    value = codes
    for size in (1, 2, 3):
        if size > 1:
            value = value[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[size - 1 :]
        spread = (value + np.uint64(size)) * np.uint64(0xD6E8FEB86659FD93)
        found.append((spread >> np.uint64(52)).astype(np.int64))
    return np.bincount(np.concatenate(found), minlength=BUCKETS)


def vectors(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rows of counts as TF-IDF vectors of length one."""
    rows = np.log1p(counts, dtype=np.float32) * weights
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(rows: np.ndarray, clusters: int) -> np.ndarray:
    """Centroids of length one; the first is the mean, each next starts at the
    row farthest from those before. Empty clusters are left out."""
    def unit(vector: np.ndarray) -> np.ndarray:
        return vector / max(float(np.linalg.norm(vector)), 1e-12)

    starts = [unit(rows.mean(axis=0))]
    while len(starts) < min(clusters, len(rows)):
        starts.append(rows[int((rows @ np.stack(starts).T).max(axis=1).argmin())])
    centroids = np.stack(starts)
    for _ in range(ROUNDS):
        nearest = (rows @ centroids.T).argmax(axis=1)
        used = [k for k in range(len(centroids)) if (nearest == k).any()]
        centroids = np.stack([unit(rows[nearest == k].mean(axis=0)) for k in used])
    return centroids.astype(np.float32)


def _known(docs: DataFrame, id: str, text: str, lang: str) -> DataFrame:
    return docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id).isNotNull())


def _language_sizes(docs: DataFrame, id: str, text: str, lang: str) -> list[tuple[str, int]]:
    """(language, texts) of every language, the most frequent first."""
    sizes = _known(docs, id, text, lang).groupBy(lang).agg(F.count("*").alias("n")).orderBy(F.desc("n"), lang)
    return [(row[0], row["n"]) for row in sizes.collect()]


def length_classes(counts: np.ndarray) -> np.ndarray:
    """Length class of every row of counts, by its different n-grams: half powers of
    two. A word said a thousand times tells as little as a word."""
    return (2 * np.log2(np.maximum(1, (counts > 0).sum(axis=-1)))).astype(np.int64).clip(0, CLASSES - 1)


def _picked(docs: DataFrame, id: str, text: str, lang: str, sizes: list[tuple[str, int]]) -> DataFrame:
    """(lang, text) of the learning sample of the languages in ``sizes``."""
    scale = 1 << 30
    limits = [(F.lit(name), F.lit(min(scale, scale * SAMPLE // n))) for name, n in sizes]
    limit = F.create_map(*[part for pair in limits for part in pair])[F.col(lang)]
    picked = _known(docs, id, text, lang).where(F.pmod(F.xxhash64(F.col(id)), F.lit(scale)) < limit)
    return picked.select(F.col(lang).alias("lang"), F.col(text).alias("text"))


def _sample_counts(
    docs: DataFrame, id: str, text: str, lang: str, turn: int = 0, sizes: list[tuple[str, int]] | None = None
) -> list[tuple[str, bytes]]:
    """(language, n-gram counts) of the learning sample of one turn of ``LANGUAGES`` languages."""
    sizes = _language_sizes(docs, id, text, lang) if sizes is None else sizes
    sizes = sizes[turn * LANGUAGES : (turn + 1) * LANGUAGES]
    if not sizes:
        return []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            found = [(name, gram_counts(said, letters)) for name, said in rows]
            found = [(name, c.astype(np.float32).tobytes()) for name, c in found if c is not None]
            names, counts = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(counts, pa.binary())], ["lang", "counts"]
            )

    rows = _picked(docs, id, text, lang, sizes)
    found = rows.mapInArrow(count, "lang string, counts binary").collect()
    return sorted((row.lang, bytes(row.counts)) for row in found)


def _piece_cosines(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(lang, class, cosine): how near pieces of the learning texts, of every length
    from ``PIECE`` characters to the whole, are to their own language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        own = {name: [k for k, x in enumerate(model.languages) if x == name] for name in set(model.languages)}
        for batch in batches:
            names, classes, cosines = [], [], []
            for name, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sizes = [PIECE << k for k in range(CLASSES) if PIECE << k < len(said)] + [len(said)]
                for size in sizes:
                    start = (len(said) - size) // 2
                    counts = gram_counts(said[start : start + size], letters)
                    if counts is not None and name in own:
                        near = vectors(counts[None], model.weights) @ model.centroids[own[name]].T
                        names.append(name)
                        classes.append(int(length_classes(counts)))
                        cosines.append(float(near.max()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(classes, pa.int32()), pa.array(cosines, pa.float64())],
                ["lang", "class", "cosine"],
            )

    return rows.mapInArrow(run, "lang string, class int, cosine double")


def _limits(pieces: list, floors: dict[str, float]) -> dict[str, np.ndarray]:
    """Per language the least accepted cosine by length class. A class without pieces
    has the limit of the next shorter one that has any, the shortest the floor."""
    by_class: dict[str, dict[int, list[float]]] = {name: {} for name in floors}
    for row in pieces:
        by_class[row["lang"]].setdefault(row["class"], []).append(row["cosine"])
    found = {}
    for name, floor in floors.items():
        limits, last = [], floor
        for k in range(CLASSES):
            if k in by_class[name]:
                last = max(floor, SLACK * float(np.quantile(by_class[name][k], QUANTILE)))
            limits.append(last)
        found[name] = np.array(limits)
    return found


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """A model of the languages in ``lang``; only ``text`` and ``lang`` are learned from."""
    sizes = _language_sizes(docs, id, text, lang)
    turns = range(-(-len(sizes) // LANGUAGES))
    texts, present, sample = 0, np.zeros(BUCKETS, np.int64), []
    for turn in turns:
        sample = _sample_counts(docs, id, text, lang, turn, sizes)
        texts += len(sample)
        for _, c in sample:
            present += np.frombuffer(c, np.float32) > 0
    if not texts:
        empty = np.zeros((0, BUCKETS), np.float32)
        return LanguageModel([], empty, np.ones(BUCKETS, np.float32), np.zeros((0, CLASSES)))
    weights = (np.log((1 + texts) / (1 + present)) + 1).astype(np.float32)
    learned: dict[str, tuple[np.ndarray, float]] = {}
    for turn in turns:
        if len(turns) > 1:
            sample = _sample_counts(docs, id, text, lang, turn, sizes)
        if not sample:
            continue
        rows = vectors(np.stack([np.frombuffer(c, np.float32) for _, c in sample]), weights)
        names = np.array([name for name, _ in sample])
        for name in set(names):
            own = rows[names == name]
            found = spherical_kmeans(own, CLUSTERS)
            learned[str(name)] = found, REJECT * float(np.median((own @ found.T).max(axis=1)))
    languages, pieces = [], []
    for name, (found, _) in sorted(learned.items()):
        languages += [name] * len(found)
    centroids = np.concatenate([learned[name][0] for name in sorted(learned)])
    model = LanguageModel(languages, centroids, weights, np.zeros((len(languages), CLASSES)))
    for turn in turns:
        rows = _picked(docs, id, text, lang, sizes[turn * LANGUAGES : (turn + 1) * LANGUAGES])
        pieces += _piece_cosines(rows, model).collect()
    limits = _limits(pieces, {name: floor for name, (_, floor) in learned.items()})
    return replace(model, limits=np.stack([limits[name] for name in languages]))


def _nearest(model: LanguageModel):
    """The Arrow function of a text's language, cosine and rejection."""

    @F.arrow_udf(RESULT)
    def nearest(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = letter_table()
        names = np.array([*model.languages, UNKNOWN], object)
        for column in columns:
            best = np.full(len(column), len(model.languages))
            score, rejected = np.zeros(len(column)), np.ones(len(column), bool)
            for start in range(0, len(column), _TOGETHER):
                counts, places = [], []
                for place, said in enumerate(column.slice(start, _TOGETHER).to_pylist(), start):
                    found = gram_counts(said, letters) if said else None
                    if found is not None:
                        counts.append(found)
                        places.append(place)
                if places and model.languages:
                    together = np.stack(counts)
                    cosines = vectors(together, model.weights) @ model.centroids.T
                    top = cosines.argmax(axis=1)
                    value = np.clip(cosines[np.arange(len(top)), top].astype(float), 0.0, 1.0)
                    best[places], score[places] = top, value
                    rejected[places] = value < model.limits[top, length_classes(together)]
            yield pa.StructArray.from_arrays(
                [pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)],
                ["lang_pred", "score", "rejected"],
            )

    return nearest


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (the cosine, 0 to 1) and rejected."""
    added = ["lang_pred", "score", "rejected"]
    found = docs.drop(*added, "_found").withColumn("_found", _nearest(model)(F.col(text)))
    return found.withColumns({name: F.col("_found")[name] for name in added}).drop("_found")


def accepted(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with their own columns only."""
    found = fresh(docs, "_found")
    judged = docs.withColumn(found, _nearest(model)(F.col(text)))
    return judged.where(~F.col(found)["rejected"]).drop(found)


def op3_langid(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = crc32_mod("doc_id", 3)
    model = fit(documents.where(remainder != 1))
    held_out = F.coalesce(remainder == 1, F.lit(False))
    found = predict(documents.withColumn("held_out", held_out), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")
