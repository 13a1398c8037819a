"""SimHash near-duplicates, found with pivot distance tables.

Fingerprints come from shingles in numpy over Arrow batches. Equal fingerprints are merged first, so a group of
copies is one node whatever its size. Each distinct fingerprint then gets its pivot table: Hamming distances to
reference fingerprints, computed once and packed into two longs. By the triangle inequality two fingerprints
within ``r`` bits differ by at most ``r`` in every coordinate; pairs beyond that are discarded, and what survives
is verified bit by bit.

Distances to random references concentrate around 32, so on their own they can't tell which pairs to compare.
The pairs come from agreement in blocks: of eight blocks of eight bits, a pair within two bits agrees in six at
least. Every fingerprint is keyed once for each of the 28 choices of six blocks. Keys have 48 bits, so what shares
one does not grow with the corpus: it differs in two blocks only.

Edge cases: a NULL or empty text, or one of separators only, has fingerprint zero and is linked like any other.
Texts of fewer than three words have their whole word sequence as the one shingle. NULL ids are kept and never
name a component unless all its ids are NULL. Repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import Texts, mapped
from tidewell.llm.components import components
from tidewell.session import staged

MAX_BITS = 2
SHINGLE_WORDS = 3
BLOCKS, BLOCK_BITS = 8, 8

#: Sixteen reference fingerprints: fixed pseudo-random ones, the multiples of an odd constant modulo 2**64.
PIVOTS = tuple(int(x) for x in (np.arange(1, 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))

# Fixed values of the XXH64 algorithm.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x85EBCA77C2B2AE63,
        0x27D4EB2F165667C5,
    )
)


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotated(acc + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many stretches of one byte array, all at once: each step handles the stretches that reach it."""
    n = ends - starts
    room = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", room, strides=(1,))
    four = np.ndarray(len(data) + 1, "<u4", room, strides=(1,))
    s = np.uint64(seed)
    h = np.full(len(n), s + _P5, np.uint64)
    at = starts.copy()
    big = np.flatnonzero(n >= 32)
    if len(big):
        acc = [np.full(len(big), s, np.uint64) for _ in range(4)]  # arrays wrap around without a warning
        acc = [acc[0] + _P1 + _P2, acc[1] + _P2, acc[2], acc[3] - _P1]
        stripes, live = n[big] // 32, np.arange(len(big))
        for k in range(int(stripes.max())):
            live = live[stripes[live] > k]
            for lane in range(4):
                acc[lane][live] = _round(acc[lane][live], eight[at[big[live]] + 32 * k + 8 * lane])
        whole = sum(_rotated(a, r) for a, r in zip(acc, (1, 7, 12, 18)))
        for a in acc:
            whole = (whole ^ _round(np.uint64(0), a)) * _P1 + _P4
        h[big] = whole
        at[big] += 32 * stripes
    h += n.astype(np.uint64)
    live = np.flatnonzero(ends - at >= 8)
    while len(live):
        h[live] = _rotated(h[live] ^ _round(np.uint64(0), eight[at[live]]), 27) * _P1 + _P4
        at[live] += 8
        live = live[ends[live] - at[live] >= 8]
    live = np.flatnonzero(ends - at >= 4)
    h[live] = _rotated(h[live] ^ (four[at[live]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[live] += 4
    live = np.flatnonzero(ends > at)
    while len(live):
        h[live] = _rotated(h[live] ^ (data[at[live]].astype(np.uint64) * _P5), 11) * _P1
        at[live] += 1
        live = live[ends[live] > at[live]]
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def fingerprints_of(texts: Texts, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint of each text, as signed 64-bit integers."""
    words = texts.lowered().words()
    data, starts, ends = words.joined()
    counts = words.counts
    out = np.zeros(len(texts), np.uint64)
    per_text = np.where(counts > 0, np.maximum(counts - shingle_words + 1, 1), 0)
    first = np.repeat(words.first[:-1] - (np.cumsum(per_text) - per_text), per_text) + np.arange(per_text.sum())
    last = np.minimum(first + shingle_words, np.repeat(words.first[1:], per_text)) - 1
    with np.errstate(over="ignore"):
        h = xxh64(data, starts[first], ends[last])
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    edges = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(per_text, out=edges[1:])
    for i in np.flatnonzero(per_text):
        ones = bits[edges[i] : edges[i + 1]].sum(axis=0, dtype=np.int32)
        out[i] = np.packbits(2 * ones > per_text[i], bitorder="little").view("<u8")[0]
    return out.view(np.int64)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (long) of every row."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch(
            {"doc_id": part.column(0), "fingerprint": fingerprints_of(Texts.of(part.column(1)), shingle_words)}
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), "text", work, f"doc_id {kind}, fingerprint long")


def _pivot_table(fingerprint: Column) -> list[Column]:
    """The distances to all pivots, eight to a long, one byte each."""
    packed = []
    for half in (PIVOTS[:8], PIVOTS[8:]):
        parts = [F.bit_count(fingerprint.bitwiseXOR(F.lit(p))).cast("long") for p in half]
        total = parts[0]
        for k, part in enumerate(parts[1:], 1):
            total = total.bitwiseOR(F.shiftleft(part, 8 * k))
        packed.append(total)
    return packed


def _far(left: Column, right: Column, radius: int) -> list[Column]:
    """For each coordinate of a packed half: whether it tells the two apart."""
    byte = [(F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(255)) for x in (left, right)) for k in range(8)]
    return [F.abs(a - b) > radius for a, b in byte]


def _keys(fingerprint: Column, radius: int) -> Column:
    """One key for every choice of blocks of which a pair within ``radius`` bits has at least one in common."""
    chosen = []
    for number, blocks in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        mask = sum(((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * b) for b in blocks)
        mask -= (mask >> 63) << 64
        chosen.append(F.xxhash64(F.lit(number), fingerprint.bitwiseAND(F.lit(mask))))
    return F.array(*chosen)


def links(distinct: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints (column ``fingerprint``) that differ in 1 to ``radius`` bits.

    A pair that shares several keys comes several times. Keys are always exchanged: Spark's estimate of the rows that are
    keyed leaves out that each comes 28 times, and by it they would be sent to the driver and to every executor.
    """
    if not 1 <= radius < BLOCKS:
        raise ValueError("radius must be from 1 to 7 bits")
    low, high = _pivot_table(F.col("fingerprint"))
    keyed = distinct.select(
        "fingerprint", low.alias("low"), high.alias("high"), F.explode(_keys(F.col("fingerprint"), radius)).alias("key")
    )
    left, right = keyed.alias("l"), keyed.alias("r")
    close = (F.col("l.key") == F.col("r.key")) & (F.col("l.fingerprint") < F.col("r.fingerprint"))
    for far in (*_far(F.col("l.low"), F.col("r.low"), radius), *_far(F.col("l.high"), F.col("r.high"), radius)):
        close &= ~far
    exact = F.bit_count(F.col("l.fingerprint").bitwiseXOR(F.col("r.fingerprint"))) <= radius
    return left.hint("merge").join(right.hint("merge"), close & exact).select(F.col("l.fingerprint").alias("a"), F.col("r.fingerprint").alias("b"))


def _printed(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``doc_id``, ``row_hash`` (of all columns) and ``fingerprint`` of every row."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        prints = fingerprints_of(Texts.of(part.column(2)), shingle_words)
        return pa.record_batch({"doc_id": part.column(0), "row_hash": part.column(1), "fingerprint": prints})

    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", _row_hash(docs).alias("row_hash"), "text")
    return mapped(given, "text", work, f"doc_id {kind}, row_hash long, fingerprint long")


def _telling(docs: DataFrame) -> list[str]:
    """Columns that can tell rows apart: Spark compares none that holds a map or a variant."""
    return [f.name for f in docs.schema.fields if not re.search(r"\b(map<|variant\b)", f.dataType.simpleString())]


def _row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*(docs[f"`{c}`"] for c in _telling(docs)))


def _rooted(printed: DataFrame, radius: int) -> DataFrame:
    """The rows of ``printed`` with ``root``, one fingerprint that stands for the class."""
    distinct = staged(printed.select("fingerprint").distinct(), "distinct")
    roots = staged(components(links(distinct, radius)), "roots")
    return printed.join(roots, printed["fingerprint"] == roots["node"], "left").select(
        *printed.columns, F.coalesce("root", "fingerprint").alias("root")
    )


def classes(docs: DataFrame, radius: int = MAX_BITS, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` (smallest id reachable over links) of every row."""
    rooted = staged(_rooted(staged(fingerprints(docs, shingle_words), "fingerprints"), radius), "rooted")
    # Written first: a join that doesn't share an aggregate's partitioning can split the rows of a large class.
    lowest = staged(rooted.groupBy(F.col("root").alias("named")).agg(F.min("doc_id").alias("component_id")), "lowest")
    return rooted.join(lowest, rooted["root"] == lowest["named"]).select("doc_id", "fingerprint", "component_id")


def representatives(docs: DataFrame, radius: int = MAX_BITS, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each class, all columns: the one of the smallest id; of several with that id, the one with the
    smallest hash of all columns. Rows that are equal throughout count as one; columns with maps or variants don't count."""
    printed = staged(_printed(docs, shingle_words), "fingerprints")
    best = _rooted(printed, radius).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_hash")).alias("best")
    )
    # Names that no column of the documents has.
    own = uuid.uuid4().hex
    kept_id, kept_row = f"id_{own}", f"row_{own}"
    kept = staged(best.select(F.col("best.doc_id").alias(kept_id), F.col("best.row_hash").alias(kept_row)), "kept")
    again = printed.groupBy("doc_id", "row_hash").count().where("count > 1")
    mark = F.col("row_hash").eqNullSafe(F.col(kept_row)) & F.col("doc_id").eqNullSafe(F.col(kept_id))
    again = staged(again.join(kept, mark, "left_semi").select("doc_id", "row_hash"), "repeated")
    match = (_row_hash(docs) == F.col(kept_row)) & docs["doc_id"].eqNullSafe(F.col(kept_id))
    if again.isEmpty():
        return docs.join(kept, match, "left_semi")
    repeated = kept.join(again, mark, "left_semi")
    single = docs.join(kept.join(again, mark, "left_anti"), match, "left_semi")
    return single.union(docs.join(repeated, match, "left_semi").dropDuplicates(_telling(docs)))
