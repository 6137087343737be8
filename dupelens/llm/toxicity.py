"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence is toxic with probability ``sigmoid(bias + weights of its features)``; a document with noisy-or,
``1 - prod(1 - p)``. Only document labels are learned from. A feature is a word (``\\w+``, lower case) or one of its
beginnings of 3 to 7 characters, so that inflected forms share evidence. Labels, language, source and id are no inputs.

The model is fitted on at most ``Settings.sample`` labelled documents (least hash of the id first); feature counts are
made by Spark, only the chosen features and the sentences that hold them reach the driver, both bounded by the settings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dupelens.llm.tables import texts, tidy

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
THRESHOLD = 0.7
LONGEST_CACHE = 200_000


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit: labelled documents, features, and the least number of toxic documents with a feature.
    ``shrink`` is the precision of the weights' prior: the fewer the documents, the more it counts."""

    sample: int = 10_000
    features: int = 2_000
    support: int = 4
    steps: int = 600
    rate: float = 0.1
    shrink: float = 0.1


@dataclass
class Model:
    """Weights by feature; ``bias`` is the log-odds of a sentence without any of them."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -12.0


def features(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in range(3, min(8, len(word) + 1)))]


def in_fold(key: str = "doc_id") -> Column:
    """Whether a row is held out: CRC-32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def _document_features(text: str) -> set[str]:
    found: set[str] = set()
    for word in set(WORD.findall(text.lower())):
        found.update(features(word))
    return found


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update(_document_features(text))
    names = list(counts[1].keys() | counts[0].keys())
    yield pa.RecordBatch.from_pydict(
        {
            "feature": pa.array(names, pa.string()),
            "toxic": pa.array([counts[1][n] for n in names], pa.int64()),
            "clean": pa.array([counts[0][n] for n in names], pa.int64()),
        }
    )
    tidy(*counts)


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """``(doc_id, toxic, text)`` of a bounded number of labelled documents that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    # A first cut by the hash leaves somewhat more than the sample, so the ordered limit sees a bounded number of rows.
    share = min(1.0, 1.2 * settings.sample / max(1, labels.count()) + 1e-9)
    order = F.xxhash64("doc_id")
    cut = known.where(F.pmod(order, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    chosen = cut.orderBy(F.pmod(order, F.lit(1 << 30)), "doc_id").limit(settings.sample)
    return texts(docs).join(F.broadcast(chosen), "doc_id")


def chosen_features(sample: DataFrame, settings: Settings) -> list[str]:
    """The features that tell toxic from clean documents best, by their log-odds weighted with their support."""
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return []
    counts = sample.mapInArrow(_counts, "feature string, toxic long, clean long").groupBy("feature")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    best = counts.where(F.col("toxic") >= settings.support).withColumn("odds", odds).where("odds > 1")
    best = best.orderBy(F.desc(F.col("toxic") * F.col("odds")), "feature").limit(settings.features)
    return sorted(r["feature"] for r in best.select("feature").collect())


def _bags(batches: Iterator[pa.RecordBatch], place: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """For each document its label, its sentences without features, and the feature sets of the others."""
    for batch in batches:
        plain, bags = [], []
        for text in batch.column("text").to_pylist():
            rest, found = 0, []
            for sentence in SENTENCE.findall(text.lower()):
                own = {place[f] for w in set(WORD.findall(sentence)) for f in features(w) if f in place}
                found.append(sorted(own)) if own else None
                rest += not own
            plain.append(rest)
            bags.append(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(plain, pa.int64()), pa.array(bags, pa.list_(pa.list_(pa.int32())))],
            names=["toxic", "plain", "bags"],
        )


def noisy_or_fit(rows: list[tuple[int, int, list[list[int]]]], n_features: int, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of the document labels, by Adam on all rows."""
    label = np.array([r[0] for r in rows], float)
    plain = np.array([r[1] for r in rows], float)
    owner = np.array([d for d, r in enumerate(rows) for _ in r[2]], np.int64)
    bags = [bag for r in rows for bag in r[2]]
    at = np.array([s for s, bag in enumerate(bags) for _ in bag], np.int64)
    what = np.array([f for bag in bags for f in bag], np.int64)
    theta = np.zeros(n_features + 1)
    theta[-1] = -6.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, settings.steps + 1):
        w, bias = theta[:-1], theta[-1]
        z = bias + np.bincount(at, w[what], len(bags))
        total = np.bincount(owner, np.logaddexp(0, z), len(rows)) + plain * np.logaddexp(0, bias)
        total = np.maximum(total, 1e-9)
        pull = np.where(label == 1, -1 / np.expm1(np.minimum(total, 50)), 1.0)
        by_sentence = pull[owner] / (1 + np.exp(-z))
        slope = np.empty_like(theta)
        slope[:-1] = np.bincount(what, by_sentence[at], n_features) / len(rows) + settings.shrink / len(rows) * w
        slope[-1] = (by_sentence.sum() + (pull * plain).sum() / (1 + np.exp(-bias))) / len(rows)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        theta -= settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from labelled rows that are not held out; without both labels among them the model finds nothing toxic."""
    sample = training_sample(docs, labels, settings)
    names = chosen_features(sample, settings)
    if not names:
        return Model()
    place = {name: i for i, name in enumerate(names)}
    bags = sample.mapInArrow(lambda b: _bags(b, place), "toxic int, plain long, bags array<array<int>>")
    rows = [(r["toxic"], r["plain"], r["bags"]) for r in bags.collect()]
    weights, bias = noisy_or_fit(rows, len(names), settings)
    return Model({n: float(w) for n, w in zip(names, weights, strict=True) if abs(w) > 1e-3}, bias)


class Scorer:
    """Sentence and document scores under a model; word weights are kept between documents, up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, tuple[str, ...]] = {}

    def word(self, word: str) -> tuple[str, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= LONGEST_CACHE:
                self.known.clear()
            found = self.known[word] = tuple(f for f in features(word) if f in self.model.weights)
        return found

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """Begin, end and probability of each sentence that holds a feature."""
        out = []
        for m in SENTENCE.finditer(text):
            own = {f for w in set(WORD.findall(m[0].lower())) for f in self.word(w)}
            if own:
                z = self.model.bias + sum(self.model.weights[f] for f in sorted(own))
                out.append((m.start(), m.end(), float(1 / (1 + np.exp(-z)))))
        return out

    def document(self, text: str) -> float:
        """Noisy-or over all sentences. Texts without any feature, empty ones too, skip the sentence step."""
        low = text.lower()
        plain = len(SENTENCE.findall(low))
        log_clean, held = 0.0, 0
        word = self.word
        if any(word(w) for w in set(WORD.findall(low))):
            found = self.sentences(text)
            held = len(found)
            log_clean = float(sum(np.log1p(-min(p, 1 - 1e-12)) for _, _, p in found))
        log_clean -= (plain - held) * float(np.logaddexp(0, self.model.bias))
        return min(1.0, max(0.0, float(-np.expm1(log_clean))))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.document(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])
        tidy(scorer.known)

    return texts(docs).mapInArrow(run, "doc_id long, score double")


def offending_sentences(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, begin, end, sentence, score)`` of the sentences at or above ``threshold``; positions in characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            rows = [
                (key, b, e, text[b:e], p)
                for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for b, e, p in scorer.sentences(text)
                if p >= threshold
            ]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "begin", "end", "sentence", "score"]
            )

    return texts(docs).mapInArrow(run, "doc_id long, begin long, end long, sentence string, score double")


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs (doc_id, text)``.

    Null and empty texts have no sentence and score 0. Repeated rows are scored each; an empty table gives an empty
    result. A labelled id that repeats counts as toxic if one of its labels is; labels other than 0 and 1 are ignored.
    """
    found = scored(docs, fit(docs, labels, settings))
    return found.select(
        "doc_id",
        in_fold().alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns, in one pass over the texts."""
    model = fit(docs, labels, settings)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            keep = [scorer.document(t.as_py() or "") < THRESHOLD for t in batch.column("text")]
            yield batch.filter(pa.array(keep, pa.bool_()))
        tidy(scorer.known)

    texts(docs)
    return docs.mapInArrow(run, schema)
