"""Language identification by a byte convolutional network.

A whole text is cut into windows of fixed length, padded with zero bytes; the network scores each window, and the
mean of the log-probabilities over all windows, weighted by their bytes, decides. Only lower-cased text enters a
prediction. The network is trained in numpy on a bounded sample, at most about ``PER_LANGUAGE`` documents of each
language, chosen by a hash of the id, of which tasks cut a few windows at hashed places; the driver gets those, six for each of
``PER_LANGUAGE`` at most, however many rows an id has. Scoring is one pass, no shuffle.

Edge cases: a NULL text, or one without any letter, gives ``und`` and 0. NULL languages and ids are not learned
from. Without a learnable row every text gives ``und``. Rows are judged one by one, repeated rows alike; what is
learned from a text counts once, however often it comes. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import byteconv
from tidewell.llm.batches import Texts, mapped

WINDOW = 128
PER_LANGUAGE = 1000
UNKNOWN = "und"
MAX_LANGUAGES = 1000  # outputs of the network


def windows_of(texts: Texts, length: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, the text each is of, and how many bytes of it are not padding."""
    sizes = np.diff(texts.offsets)
    per_text = -(-sizes // length)
    owner = np.repeat(np.arange(len(texts)), per_text)
    first = np.cumsum(per_text) - per_text
    out = np.zeros(int(per_text.sum()) * length, np.uint8)
    out[np.arange(len(texts.data)) + np.repeat(first * length - texts.offsets[:-1], sizes)] = texts.data
    filled = np.full(len(owner), length)
    last = (first + per_text - 1)[per_text > 0]
    filled[last] = (sizes - (per_text - 1) * length)[per_text > 0]
    return out.reshape(-1, length), owner, filled


def _chosen(texts: Texts, windows: np.ndarray, owner: np.ndarray, filled: np.ndarray, count: int) -> np.ndarray:
    """At most ``count`` windows of each text, by a hash of their content; short ends only where there is no more."""
    first = np.arange(len(owner)) - np.searchsorted(owner, owner)
    starts = texts.offsets[:-1][owner] + first * windows.shape[1]
    short = filled < min(32, WINDOW)
    order = np.lexsort((texts.hashes(starts, starts + filled), short, owner))
    rank = np.arange(len(owner)) - np.searchsorted(owner[order], owner[order])
    return order[(rank < count) & (~short[order] | (rank == 0))]


def sample(
    docs: DataFrame, learnable: Column, per_language: int = PER_LANGUAGE, windows_per_text: int = 4
) -> list[tuple[str, bytes]]:
    """(language, window of lower-cased bytes) of about ``per_language`` documents of each language, by a hash of
    the id: at most ``windows_per_text`` windows of each."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = Texts.of(part.column("text"))
        windows, owner, filled = windows_of(texts)
        chosen = _chosen(texts, windows, owner, filled, windows_per_text)
        return pa.record_batch(
            {
                "label": part.column("label").take(pa.array(owner[chosen])),
                "seen": pa.array([windows[k].tobytes() for k in chosen], pa.binary()),
            }
        )

    known = docs.select("doc_id", "text", F.col("lang").alias("label")).where(
        F.col("label").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & learnable
    )
    # Rows that are held back have no say, not even in how many of a language there are.
    sizes = known.groupBy("label").count()
    share = F.col("count") / F.lit(float(per_language))
    if sizes.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    drawn = (
        known.join(F.broadcast(sizes), "label")
        .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) * share < F.lit(1.25 * (1 << 30)))
        .select(F.lower("text").alias("text"), F.col("label").cast("string").alias("label"))
    )
    found = mapped(drawn, "text", work, "label string, seen binary").distinct()
    # An id may have any number of rows; the draw bounds ids, this the windows that come to the driver.
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("seen"), "seen"))
    most = int(1.5 * per_language * windows_per_text)
    bounded = found.withColumn("place", place).where(F.col("place") <= most).select("label", "seen")
    return sorted((r[0], bytes(r[1])) for r in bounded.collect())


def train(rows: list[tuple[str, bytes]]) -> tuple[byteconv.ByteConv | None, list[str]]:
    """The network and the languages its outputs stand for."""
    if not rows:
        return None, []
    languages = sorted({label for label, _ in rows})
    number = {label: i for i, label in enumerate(languages)}
    windows = np.frombuffer(b"".join(seen for _, seen in rows), np.uint8).reshape(len(rows), -1)
    labels = np.array([number[label] for label, _ in rows])
    # Texts may be short: every window also comes cut to a random length.
    cut = windows.copy()
    cut[np.arange(cut.shape[1]) >= np.random.default_rng(13).integers(8, WINDOW, len(cut))[:, None]] = 0
    return byteconv.train(np.concatenate([windows, cut]), np.tile(labels, 2), len(languages)), languages


def predictions(net: byteconv.ByteConv, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """For each text the number of the likeliest language and its probability."""
    windows, owner, filled = windows_of(texts)
    p = np.log(byteconv.softmax(net.logits(windows)) + 1e-6)
    total = np.zeros((len(texts), p.shape[1]))
    for c in range(p.shape[1]):
        total[:, c] = np.bincount(owner, weights=p[:, c] * filled, minlength=len(texts))
    weight = np.maximum(np.bincount(owner, weights=filled, minlength=len(texts)), 1)
    mean = byteconv.softmax(total / weight[:, None])
    best = mean.argmax(axis=1)
    return best, mean[np.arange(len(texts)), best]


def identify(docs: DataFrame, net: byteconv.ByteConv | None, languages: list[str]) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        lettered = part.column(2).to_numpy(False).astype(bool)
        labels, score = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
        if net is not None:
            best, p = predictions(net, Texts.of(part.column(1)))
            labels = np.where(lettered, np.array(languages, object)[best], UNKNOWN)
            score = np.where(lettered, p, 0.0)
        return pa.record_batch(
            {"doc_id": part.column(0), "lang_pred": pa.array(labels, pa.string()), "score": score}
        )

    given = docs.select(
        "doc_id",
        F.lower("text").alias("text"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(given, "text", work, f"doc_id {kind}, lang_pred string, score double")
