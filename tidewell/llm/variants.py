"""Spelling variants: words one edit apart, found by scanning the sorted vocabulary.

The vocabulary is counted by Spark and lies sorted in two lists, one by its words and one by its reversed words, each cut
into ranges of about ``RANGE_WORDS`` words. Two words one edit apart either have the first half of the one in common, and
then lie under one prefix of the first list, or the second half, and then under one prefix of the reversed list. So each
word is sent, for each list, to the ranges that hold its prefix; a range whose own shared prefix is more than one
edit away is not among them. Borders of ranges (two words for each ``RANGE_WORDS``) are all the driver holds.

In a range the list is scanned in order with the edit matrix of word against list entry, of which only the band of three
cells around the diagonal can hold a value up to one. Neighbouring entries have their first LCP characters in common, so
a row of the matrix is computed once for all entries that begin alike, and where its band exceeds one edit they are all
skipped. Rows advance for all words of a range at once, in numpy.

A pair counts once: the list of words reports those whose common prefix reaches the word's half, the reversed list the rest.
No group of words is gathered by a key: a prefix with a third of the vocabulary is cut into as many ranges as it needs.

Edge cases: a NULL or empty text has no words; a NULL id counts as empty text. Repeated rows count each time. Of near
words with equal counts the smallest in code-point order is the form. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import Texts, limit_batches, slices
from tidewell.session import staged

LEAST_LENGTH = 6
LEAST_COUNT = 5
DOMINANCE = 5
ALTERED = 199
RANGE_WORDS = 20_000
QUERY_SLICE = 8_192
_LONG_RUN = 64
_FAR = np.int8(2)

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def crc_of_stretches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each stretch of bytes, continued from the crc32 ``before`` it."""
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    length = ends - starts
    live = np.flatnonzero((length > 0) & (length <= _LONG_RUN))
    at = 0
    while len(live):
        own = state[live]
        state[live] = _CRC[(own ^ data[starts[live] + at]) & np.uint32(255)] ^ (own >> np.uint32(8))
        at += 1
        live = live[length[live] > at]
    out = state ^ np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(length > _LONG_RUN):
        out[k] = zlib.crc32(data[starts[k] : ends[k]].tobytes(), int(before[k]))
    return out


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Stretches of UTF-8 bytes as texts."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    places = np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[places].tobytes())
    ).cast(pa.string())


def counted_words(texts: Texts, ids: list, least: int = LEAST_LENGTH, altered: int = ALTERED) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of some texts, after the deletions that ids and runs ask for, and their counts."""
    data = texts.lowered().data
    lead = data == _LEAD
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = np.diff(texts.offsets) > 0
    opens[texts.offsets[:-1][filled]] = inside[texts.offsets[:-1][filled]]
    closes[texts.offsets[1:][filled] - 1] = inside[texts.offsets[1:][filled] - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=leads[1:])
    points = ends - starts - (leads[ends] - leads[starts])
    long = points >= least
    starts, ends, points = starts[long], ends[long], points[long]
    owner = np.searchsorted(texts.offsets, starts, "right") - 1
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = crc_of_stretches(data, starts, ends, before[owner])
    cut = crc % np.uint32(altered) == 0
    lost = []
    for a, b, h, n in zip(starts[cut].tolist(), ends[cut].tolist(), crc[cut].tolist(), points[cut].tolist()):
        if n > least:
            word = data[a:b].tobytes().decode()
            lost.append(word[: h % n] + word[h % n + 1 :])
    starts, ends = starts[~cut], ends[~cut]
    hashes = Texts(data, texts.offsets).hashes(starts, ends)
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    words = gathered(data, starts[first], ends[first])
    return pa.concat_arrays([words, pa.array(lost, pa.string())]), np.append(counts, np.ones(len(lost), np.int64))


def vocabulary(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, altered: int = ALTERED
) -> DataFrame:
    """``word`` and ``n`` of the words with enough code points and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words, counts = counted_words(Texts.of(part.column("text")), part.column("id").to_pylist(), least_length, altered)
            if len(words):
                yield pa.record_batch({"word": words, "n": pa.array(counts.astype(np.int64))})

    limit_batches(docs.sparkSession)
    counted = docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Keys:
    """Texts as code points in a row."""

    def __init__(self, keys: list[str]):
        self.flat = np.frombuffer("".join(keys).encode("utf-32-le"), "<u4")
        self.length = np.fromiter(map(len, keys), np.int64, len(keys))
        self.start = np.cumsum(self.length) - self.length

    def __len__(self) -> int:
        return len(self.length)

    def char(self, which: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        """The character at a place; 0 where there is none."""
        inside = (at >= 0) & (at < self.length[which])
        place = np.where(inside, self.start[which] + at, 0)
        return np.where(inside, self.flat[place] if len(self.flat) else 0, 0)


class SortedList:
    """Distinct texts in code-point order, with the LCP of each and the one before."""

    def __init__(self, keys: list[str]):
        self.keys = Keys(keys)
        self.lcp = np.zeros(len(keys), np.int64)
        live, at = np.arange(1, len(keys)), 0
        while len(live):
            same = (
                (self.keys.length[live] > at)
                & (self.keys.length[live - 1] > at)
                & (self.keys.char(live, at) == self.keys.char(live - 1, at))
            )
            live = live[same]
            self.lcp[live] += 1
            at += 1
        if len(keys):
            self.lcp[0] = -1

    def one_edit_from(self, queries: Keys, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, entry) one edit apart whose first ``prefix`` characters are equal.

        A node is a range of entries that share their first ``depth`` characters; its row of the edit matrix has the cells
        for one query character less, as many, and one more. ``below``, ``on`` and ``above`` are these three.
        """
        keys, lengths = self.keys, self.keys.length
        query = np.arange(len(queries))
        low, high = np.zeros(len(query), np.int64), np.full(len(query), len(keys))
        below = np.full(len(query), _FAR)
        on, above = np.zeros(len(query), np.int8), np.ones(len(query), np.int8)
        entries = np.arange(len(keys))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        depth = 0
        while len(query):
            gap = queries.length[query] - depth
            cell = np.select([gap == -1, gap == 0, gap == 1], [below, on, above], _FAR)
            hit = (lengths[low] == depth) & (cell == 1) & (depth >= prefix[query])
            found.append((query[hit], low[hit]))
            entries = entries[lengths[entries] > depth]
            begins = entries[self.lcp[entries] <= depth]
            first, last = np.searchsorted(begins, low), np.searchsorted(begins, high)
            times = last - first
            parent = np.repeat(np.arange(len(query)), times)
            child = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(len(parent))
            upper = high[parent]
            query, low = query[parent], begins[child]
            high = np.minimum(np.append(begins, len(keys))[child + 1], upper)
            char, size = keys.char(low, depth), queries.length[query]
            equal = [(queries.char(query, depth + k) == char) for k in (-1, 0, 1)]
            new_below = np.minimum(below[parent] + ~equal[0], on[parent] + 1)
            new_below[depth > size] = _FAR
            new_on = np.minimum(np.minimum(on[parent] + ~equal[1], above[parent] + 1), new_below + 1)
            new_on[depth + 1 > size] = _FAR
            new_above = np.minimum(above[parent] + ~equal[2], new_on + 1)
            new_above[depth + 2 > size] = _FAR
            keep = np.minimum(np.minimum(new_below, new_on), new_above) <= 1
            keep &= (depth >= prefix[query]) | equal[1]
            query, low, high = query[keep], low[keep], high[keep]
            below, on, above = (np.minimum(c[keep], _FAR).astype(np.int8) for c in (new_below, new_on, new_above))
            depth += 1
        return tuple(np.concatenate(side) for side in zip(*found)) if found else (query, low)


def _may_hold(shared: str, word: str) -> bool:
    """Whether a text that begins with ``shared`` can be one edit from ``word``: the last row of their band."""
    row = {0: 0, 1: 1}
    for i, c in enumerate(shared, 1):
        new = {}
        for j in (i - 1, i, i + 1):
            if 0 <= j <= len(word):
                step = row.get(j - 1, 2) + (j == 0 or word[j - 1] != c) if j else 2
                new[j] = min(step, row.get(j, 2) + 1, new.get(j - 1, 2) + 1)
        if not new or min(new.values()) > 1:
            return False
        row = new
    return True


def _shared(a: str, b: str) -> str:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a[:n]


class Borders:
    """First and last key of every range, in order; ranges do not mix the two lists."""

    def __init__(self, rows: list[tuple[int, bool, str, str]]):
        self.of = {}
        for backward in (False, True):
            own = sorted((low, high, shard) for shard, side, low, high in rows if side == backward)
            self.of[backward] = ([r[0] for r in own], [r[1] for r in own], [r[2] for r in own])

    def ranges(self, backward: bool, key: str, prefix: int) -> list[int]:
        """The ranges that may hold texts one edit from ``key`` with its first ``prefix`` characters."""
        low, high, shard = self.of[backward]
        head = key[:prefix]
        a, b = bisect_left(high, head), bisect_right(low, head + "\U0010ffff")
        if b - a < 2:
            return shard[a:b]
        return [shard[k] for k in range(a, b) if _may_hold(_shared(low[k], high[k]), key)]


def _half(length: np.ndarray | int, backward: bool):
    """Characters of a word that its near words share with it in one of the lists."""
    return length - length // 2 if backward else length // 2


def near_words(words: DataFrame, range_words: int = RANGE_WORDS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``near`` and ``near_n`` (the near word of largest count) of distinct words."""
    spark = words.sparkSession
    both = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward")).select(
        "backward", F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")).alias("key"), "n"
    )
    ranges = max(8, -(-2 * words.count() // range_words))
    lists = staged(
        both.repartitionByRange(ranges, "backward", "key")
        .withColumn("shard", F.spark_partition_id().cast("long") * 2 + F.col("backward").cast("long"))
        .sortWithinPartitions("backward", "key"),
        "lists",
    )
    rows = lists.groupBy("shard", "backward").agg(F.min("key"), F.max("key")).collect()
    borders = Borders([tuple(r) for r in rows])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to, row = [], []
            sides, keys = batch.column("backward").to_pylist(), batch.column("key").to_pylist()
            for k, (backward, key) in enumerate(zip(sides, keys)):
                near = borders.ranges(backward, key, _half(len(key), backward))
                to += near
                row += [k] * len(near)
            picked = batch.take(pa.array(row, pa.int64()))
            yield pa.record_batch(
                {"to": pa.array(to, pa.int64()), "backward": picked.column("backward"), "key": picked.column("key"), "n": picked.column("n")}
            )

    def scan(entries: pa.Table, queries: pa.Table) -> pa.Table:
        backward = queries.column("backward")[0].as_py() if queries.num_rows else False
        text = entries.column("key").to_pylist()
        order = sorted(range(len(text)), key=text.__getitem__)
        listed = SortedList([text[k] for k in order])
        n = entries.column("n").to_numpy()[order]
        names = [text[k][::-1] if backward else text[k] for k in order]
        # Entries by count, and by word among equal counts: the first near one is the best.
        best_first = np.empty(len(order), np.int64)
        best_first[sorted(range(len(order)), key=lambda k: (-n[k], names[k]))] = np.arange(len(order))
        by_rank = np.argsort(best_first)
        asked = queries.column("key").to_pylist()
        times, best = np.zeros(len(asked), np.int64), np.full(len(asked), len(order))
        for at in range(0, len(asked), QUERY_SLICE):
            part = Keys(asked[at : at + QUERY_SLICE])
            query, entry = listed.one_edit_from(part, _half(part.length, backward))
            if backward:
                query, entry = _not_reported_forward(part, listed.keys, query, entry)
            np.add.at(times, query + at, 1)
            np.minimum.at(best, query + at, best_first[entry])
        known = best < len(order)
        near = by_rank[best[known]]
        form = np.full(len(asked), None, object)
        form[known] = [names[k] for k in near]
        form_n = np.zeros(len(asked), np.int64)
        form_n[known] = n[near]
        return pa.table(
            {
                "word": pa.array([key[::-1] if backward else key for key in asked], pa.string()),
                "n": queries.column("n"),
                "n_near": pa.array(times),
                "near": pa.array(form.tolist(), pa.string()),
                "near_n": pa.array(form_n, mask=~known),
            }
        )

    sent = lists.select("backward", "key", "n").mapInArrow(route, "to long, backward boolean, key string, n long")
    found = (
        lists.groupBy("shard")
        .cogroup(sent.groupBy("to"))
        .applyInArrow(scan, "word string, n long, n_near long, near string, near_n long")
    )
    best = F.min(F.when(F.col("n_near") > 0, F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    return (
        found.groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    )


def _not_reported_forward(
    queries: Keys, entries: Keys, query: np.ndarray, entry: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of reversed words whose words differ within the first half of the query."""
    half = queries.length[query] // 2
    same = np.ones(len(query), bool)
    for at in range(int(half.max(initial=0))):
        inside = at < half
        a = queries.char(query, queries.length[query] - 1 - at)
        b = entries.char(entry, entries.length[entry] - 1 - at)
        same &= ~inside | (a == b)
    return query[~same], entry[~same]


def roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root`` for each ``word`` with a ``form``: the last word reached from form to form.

    A form has a larger count than its word, so there is no way round. Each round doubles the length of the steps.
    """
    steps = staged(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        joined = steps.join(further, steps["root"] == further["via"], "left")
        longer = staged(
            joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")),
            "roots",
        )
        steps = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return steps


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    dominance: int = DOMINANCE,
    altered: int = ALTERED,
    range_words: int = RANGE_WORDS,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of the vocabulary of ``docs``.

    A form is the near word of largest count, if that is at least ``dominance`` times the word's own.
    """
    words = staged(vocabulary(docs, least_length, least_count, altered), "vocabulary")
    near = near_words(words, range_words)
    dominated = F.col("near_n") >= dominance * F.col("n")
    judged = staged(
        near.select(
            "word", "n", "n_near", F.when(dominated, F.col("near")).alias("form"), F.when(dominated, F.col("near_n")).alias("form_n")
        ),
        "variants",
    )
    known = roots(judged.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    return judged.join(known, judged["word"] == known["of"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
