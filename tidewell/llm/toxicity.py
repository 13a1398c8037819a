"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the document has a label. Each sentence gets a logistic score,
a document is toxic if any of its sentences is: noisy-or, ``1 - prod(1 - p)``. The gradient of the document's
likelihood reaches sentences through that formula, so the model learns which of them made the label.

Learning reads a bounded sample: at most ``per_class`` labelled documents of each label, chosen by a hash of
the id (all rows of a chosen id). The model is a short table of features (words, and word beginnings of four to six bytes, so that
inflected forms count), screened on that sample. Scoring reads every document whole and needs no shuffle.

Edge cases: a NULL or empty text has no sentence and scores 0. NULL labels and ids are not learned from; several
labels of one id count as the highest. Without both labels in the sample every score is 0. Repeated rows are
scored alike, row by row. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.batches import Texts, Words, mapped, mixed
from tidewell.session import staged

PER_CLASS = 4000
SAMPLE_BYTES = 1 << 20
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
_SIEVE_BITS = 20
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?\"'()[]")] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of features by hash, in order of the hash; ``bias`` is the logit of a sentence without any."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def sieve(self) -> np.ndarray:
        table = np.zeros(1 << _SIEVE_BITS, bool)
        table[self.keys & np.uint64((1 << _SIEVE_BITS) - 1)] = True
        return table


def _features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: the words that have it, and its hash."""
    texts, starts, ends = words.texts, words.starts, words.ends.copy()
    for _ in range(4):
        shorter = (ends - starts > 1) & _MARK[texts.data[np.maximum(ends - 1, 0)]]
        if not shorter.any():
            break
        ends -= shorter
    skip = (ends - starts > 1) & _MARK[texts.data[starts]] if len(starts) else np.zeros(0, bool)
    starts = starts + skip
    out = [(np.arange(len(starts)), texts.hashes(starts, ends))]
    for n in PREFIXES:
        long = np.flatnonzero(ends - starts > n)
        out.append((long, mixed(texts.hashes(starts[long], starts[long] + n) + np.uint64(n))))
    return out


def _sentence_starts(words: Words) -> np.ndarray:
    """True for words that begin a sentence: after a stop mark, a line end or the end of a text."""
    data, n = words.texts.data, len(words)
    begins = np.zeros(n, bool)
    if n:
        lines = np.cumsum(data == 10)
        begins[1:] = _STOP[data[words.ends[:-1] - 1]] | (lines[words.starts[1:]] != lines[words.ends[:-1] - 1])
        begins[words.first[:-1][words.counts > 0]] = True
    return begins


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit(
    keys: np.ndarray, labels: np.ndarray, owner: np.ndarray, sentence: np.ndarray, feature: np.ndarray,
    rounds: int = 300, l1: float = 0.01,
) -> ToxicityModel:
    """Weights of ``keys`` that make the labels of documents likely under noisy-or over their sentences.

    ``owner``: the document of each sentence; ``sentence`` and ``feature``: which sentence has which key.
    """
    y, w, b = labels.astype(float), np.full(len(keys), 1.0), -5.0
    m, v = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    for t in range(1, rounds + 1):
        z = b + np.bincount(sentence, weights=w[feature], minlength=len(owner))
        total = np.bincount(owner, weights=_softplus(z), minlength=len(y))
        outer = np.where(y > 0, -1.0 / np.expm1(np.clip(total, 1e-9, 500)), 1.0)[owner]
        grad_z = outer / (1.0 + np.exp(-z)) / len(y)
        grad = np.append(np.bincount(feature, weights=grad_z[sentence], minlength=len(keys)), grad_z.sum())
        grad[:-1] += l1 * np.sign(w) / len(y)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], min(b - step[-1], -7.0 + 2.0 * max(0.0, 1 - t / 100))
    kept = np.abs(w) > 1e-3
    return ToxicityModel(keys[kept], w[kept], float(b))


def _hits(keys: np.ndarray, sieve: np.ndarray, words: Words, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which sentence has which of ``keys`` (in order), each pair once."""
    mask = np.uint64((1 << _SIEVE_BITS) - 1)
    found = []
    for index, h in _features(words):
        near = np.flatnonzero(sieve[h & mask])
        h = h[near]
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        same = keys[at] == h
        found.append(sentence[index[near[same]]] * np.int64(len(keys)) + at[same])
    once = np.unique(np.concatenate(found))
    return once // len(keys), once % len(keys)


def _sentence_logits(model: ToxicityModel, sieve: np.ndarray, words: Words, sentence: np.ndarray):
    """Sentences that have features, and their logits."""
    which, feature = _hits(model.keys, sieve, words, sentence)
    weight = model.weights[feature]
    hit, slot = np.unique(which, return_inverse=True)
    return hit, model.bias + np.bincount(slot, weights=weight, minlength=len(hit))


def scores(model: ToxicityModel, sieve: np.ndarray, texts: Texts) -> np.ndarray:
    """The noisy-or score of each text."""
    words = texts.words()
    if not len(model.keys) or not len(words):
        return np.zeros(len(texts))
    begins = _sentence_starts(words)
    owner = words.owners[begins]
    total = np.bincount(owner, minlength=len(texts)) * float(_softplus(np.array(model.bias)))
    hit, z = _sentence_logits(model, sieve, words, np.cumsum(begins) - 1)
    np.add.at(total, owner[hit], _softplus(z) - float(_softplus(np.array(model.bias))))
    return -np.expm1(-total)


def sample(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id``, ``text`` (lower case) and ``label``: at most ``per_class`` rows of each label, by a hash of the id.

    An id may have any number of rows, of which those with the smallest hashes of the text count. Texts of more than
    ``SAMPLE_BYTES`` are scored like others and not learned from.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .where(learnable)
        .withColumn("_order", F.xxhash64("doc_id"))
    )
    parts = [known.where(F.col("label") == c).orderBy("_order", "doc_id").limit(per_class) for c in (0, 1)]
    picked = F.broadcast(parts[0].union(parts[1]).select("doc_id", "label"))  # 2 * per_class rows at most
    fitting = docs.select("doc_id", F.lower("text").alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text"))
    rows = fitting.join(picked, "doc_id").withColumn("_place", place)
    return rows.where(F.col("_place") <= per_class).drop("_place")


def _screened(rows: DataFrame) -> np.ndarray:
    """Features that more toxic than clean documents have, by rate and by more than chance, in order of the hash."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Texts.of(part.column("text")).words()
        found = _features(words)
        doc = np.concatenate([words.owners[index] for index, _ in found])
        keys, slot = np.unique(np.concatenate([h for _, h in found]), return_inverse=True)
        pairs = np.unique(slot * part.num_rows + doc)
        toxic = part.column("label").to_numpy()[pairs % part.num_rows].astype(float)
        rows = np.bincount(pairs // part.num_rows, weights=toxic, minlength=len(keys)).astype(np.int64)
        other = np.bincount(pairs // part.num_rows, minlength=len(keys)) - rows
        some = rows > 0  # what no toxic document here has adds nothing but clean ones
        return pa.record_batch({"key": keys.view(np.int64), "toxic": rows, "clean": other}).filter(pa.array(some | (other > 0)))

    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return np.zeros(0, np.uint64)
    counts = mapped(rows.select("text", "label"), "text", work, "key long, toxic long, clean long")
    counts = counts.groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rate, usual = (F.col("toxic") + 0.25) / sizes[1], (F.col("clean") + 0.25) / sizes[0]
    chosen = counts.where(
        (F.col("toxic") >= 3)
        & (rate > 4 * usual)
        & (F.col("toxic") - F.col("clean") > 2 * F.sqrt(F.col("toxic") + F.col("clean")))
    )
    return np.sort(np.array([r[0] for r in chosen.select("key").collect()], np.int64).view(np.uint64))


def model_of(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, per_class: int = PER_CLASS):
    """The model that the labelled documents give; ``learnable`` (on ``doc_id``) holds rows back.

    Features are counted, screened and looked up in tasks; the driver gets which sentence has which chosen feature.
    """
    rows = staged(sample(docs, labels, F.lit(True) if learnable is None else learnable, per_class), "sample")
    keys = _screened(rows)
    if not len(keys):
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    sieve = ToxicityModel(keys, np.zeros(0), 0.0).sieve()

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Texts.of(part.column("text")).words()
        begins = _sentence_starts(words)
        which, feature = _hits(keys, sieve, words, np.cumsum(begins) - 1)
        owner = words.owners[begins]
        edges = np.searchsorted(which, np.searchsorted(owner, np.arange(part.num_rows + 1)))
        first = np.searchsorted(owner, np.arange(part.num_rows))
        own = which - first[owner[which]] if len(which) else which
        lists = pa.array(edges.astype(np.int32))
        return pa.record_batch(
            {
                "doc_id": part.column("doc_id"),
                "label": part.column("label"),
                "sentences": pa.array(np.bincount(owner, minlength=part.num_rows).astype(np.int64)),
                "which": pa.ListArray.from_arrays(lists, pa.array(own.astype(np.int32))),
                "feature": pa.ListArray.from_arrays(lists, pa.array(feature.astype(np.int32))),
            }
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, label int, sentences long, which array<int>, feature array<int>"
    bags = mapped(rows.select("doc_id", "text", "label"), "text", work, schema).collect()
    bags.sort(key=lambda r: (r[0], r[2], r[3], r[4]))
    sizes = np.array([r[2] for r in bags], np.int64)
    first = np.cumsum(sizes) - sizes
    sentence = np.concatenate([np.array(r[3], np.int64) + f for r, f in zip(bags, first)])
    feature = np.concatenate([np.array(r[4], np.int64) for r in bags])
    owner = np.repeat(np.arange(len(bags)), sizes)
    return fit(keys, np.array([r[1] for r in bags]), owner, sentence, feature)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id`` and ``score`` (double, 0 to 1) of every row."""
    sieve = model.sieve()

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch({"doc_id": part.column(0), "score": scores(model, sieve, Texts.of(part.column(1)))})

    given = docs.select("doc_id", F.lower("text").alias("text"))
    return mapped(given, "text", work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, all columns, whose score is below ``threshold``."""
    sieve, width = model.sieve(), len(docs.columns)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        clean = scores(model, sieve, Texts.of(part.column(width))) < threshold
        return part.select(range(width)).filter(pa.array(clean))

    # Lower case is Spark's here too, so that a text gets the score that ``score_documents`` gives it.
    lowered = docs.withColumn(f"lowered_{uuid.uuid4().hex}", F.lower("text"))
    return mapped(lowered, "text", work, docs.schema)


def offending_sentences(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``sentence_no`` (from 0), ``score`` and ``sentence`` of sentences that reach ``threshold``."""
    sieve = model.sieve()

    def work(part: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = Texts.of(part.column(1))
        words = texts.words()
        if not len(words) or not len(model.keys):
            return None
        begins = _sentence_starts(words)
        opens = np.flatnonzero(begins)
        closes = np.append(opens[1:], len(words)) - 1
        hit, z = _sentence_logits(model, sieve, Texts.of(part.column(2)).words(), np.cumsum(begins) - 1)
        p = 1.0 / (1.0 + np.exp(-z))
        hit, p = hit[p >= threshold], p[p >= threshold]
        owner = words.owners[opens[hit]]
        before = np.searchsorted(opens, words.first[:-1])
        found = [
            texts.data[words.starts[opens[s]] : words.ends[closes[s]]].tobytes().decode("utf-8", "replace") for s in hit
        ]
        return pa.record_batch(
            {
                "doc_id": part.column(0).take(pa.array(owner)),
                "sentence_no": pa.array(hit - before[owner], pa.int64()),
                "score": p,
                "sentence": pa.array(found, pa.string()),
            }
        )

    # Words are told apart by ASCII bytes only, which lower-casing keeps: both columns have the same words.
    given = docs.select("doc_id", "text", F.lower("text").alias("lowered"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(given, "text", work, f"doc_id {kind}, sentence_no long, score double, sentence string")
