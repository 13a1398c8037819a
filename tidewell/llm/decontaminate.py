"""Benchmark decontamination: every training passage is a query against a BM25 index of the test items.

Items are cut into pieces of at most ``PIECE_WORDS`` words; pieces are the entries of the inverted index, dealt to
blocks of ``BLOCK`` entries. A posting holds the BM25 weight of a term divided by the sum over the whole piece, so
a score is the share of a piece that a passage covers, and one threshold fits all. Passages are windows of
``PASSAGE_WORDS`` words that overlap by half and cover every text; a piece that a text holds lies whole in one.

Block-max WAND in numpy: postings of terms that many pieces share are non-essential and are left out at first; what
they can add at most is known for every block. Where that would reach the threshold, postings of a piece's rarest terms
are essential too, until the rest stays under it, so a piece at the threshold always has an essential term in the
passage. Essential postings sum up their block maxima for each passage and block, and a block whose bound stays under
the threshold is skipped as a whole. What is left is scored with all its terms.
Pieces at or above the threshold are then verified in the passage and its surroundings: overlap of the item's
question in runs of up to ``RUN_WORDS`` words, and of its answer in runs of up to ``ANSWER_RUN``. The answer is an
item's last sentence, with as many before it as make ``ANSWER_WORDS`` words. Marks and symbols at the end of a word
don't count.

No single altered word hides a copy: an altered word breaks as many runs as a run has words, so runs are shorter in
short parts, where they would otherwise be more than half; a part of one word is checked together with the other part;
and no term has more than half of a piece's weight.

The index is built from the benchmark alone, in shards of at most ``SHARD_BYTES`` of text, which bounds what is
broadcast at a time; a larger benchmark makes more shards, all of which the texts meet in one scan.

Edge cases: NULL or empty texts match nothing, and items without a word are skipped. Items with fewer than
``MIN_WORDS`` words are found as exact runs of their words, so a text that holds them by chance counts too. An item that
comes twice counts once with its smallest id, if texts are equal; one without an id is found as well, as NULL. Repeated rows are judged alike, row by row. Other columns are passed through or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import Texts, Words, fold, mapped

PIECE_WORDS = 64
PASSAGE_WORDS = 128
BLOCK = 2
SHARE = 0.5
OVERLAP = 0.5
RUN_WORDS = 5
ANSWER_WORDS, ANSWER_RUN = 8, 3
MIN_WORDS = 5
COMMON = 0.02
K1, B = 1.2, 0.75
SHARD_BYTES = 16 << 20
POSTINGS = 1 << 21
_SIEVE_BITS = 20
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?\"'()[]#*$%&|<>")] = True


def word_hashes(words: Words) -> np.ndarray:
    """Hashes of words without their marks at the end."""
    ends = words.ends.copy()
    for _ in range(8):
        shorter = (ends - words.starts > 1) & _MARK[words.texts.data[np.maximum(ends - 1, 0)]]
        if not shorter.any():
            break
        ends -= shorter
    return words.texts.hashes(words.starts, ends)


def _runs(h: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words."""
    if len(h) < n:
        return h[:0]
    out = h[: len(h) - n + 1]
    for k in range(1, n):
        out = fold(out, h[k : len(h) - n + 1 + k])
    return out


@dataclass(frozen=True)
class Item:
    item_id: int | None
    question: np.ndarray  # hashes of its words
    answer: np.ndarray


@dataclass(frozen=True)
class Index:
    items: list[Item]
    item_of: np.ndarray  # of each piece
    terms: np.ndarray  # all terms, by hash
    first: np.ndarray  # postings of term t: first[t] to first[t + 1]
    piece: np.ndarray
    weight: np.ndarray
    essential: np.ndarray  # by term: has essential postings
    block_first: np.ndarray  # blocks of essential postings, as above
    block: np.ndarray
    block_max: np.ndarray
    block_rest: np.ndarray  # most that non-essential postings add in a block, always under SHARE
    longest: int  # words of the longest item
    short: dict[int, tuple[np.ndarray, list[list[int]]]]  # items of so many words: their runs in order, and whose


def build(items: list[tuple[int | None, str]]) -> Index | None:
    """The index of (id, text) pairs; None if nothing is left to search for."""
    import re

    own, piece_terms, item_of, runs = [], [], [], {}
    for item_id, text in items:
        parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if p.strip(" \t\n\v\f\r")]
        hashes = [word_hashes(Texts.of(pa.array([p])).lowered().words()) for p in parts]
        whole = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        if not len(whole):
            continue
        if len(whole) < MIN_WORDS:
            runs.setdefault(len(whole), {}).setdefault(int(_runs(whole, len(whole))[0]), []).append(len(own))
            own.append(Item(item_id, whole, whole[:0]))
            continue
        at = len(hashes)
        while at > 1 and sum(map(len, hashes[at:])) < ANSWER_WORDS:
            at -= 1
        if 1 in (sum(map(len, hashes[:at])), sum(map(len, hashes[at:]))):
            at = len(hashes)
        own.append(Item(item_id, np.concatenate(hashes[:at]), np.concatenate([whole[:0], *hashes[at:]])))
        count = -(-len(whole) // PIECE_WORDS)
        for part in np.array_split(whole, count):
            piece_terms.append(np.unique(part, return_counts=True))
            item_of.append(len(own) - 1)
    if not own:
        return None
    n = len(piece_terms)
    empty = np.zeros(0, np.uint64)
    terms, flat = np.unique(np.concatenate([empty, *(t for t, _ in piece_terms)]), return_inverse=True)
    piece = np.repeat(np.arange(n), np.array([len(t) for t, _ in piece_terms], int))
    tf = np.concatenate([empty, *(c for _, c in piece_terms)]).astype(float)
    length = np.bincount(piece, weights=tf)
    df = np.bincount(flat, minlength=len(terms))
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    weight = idf[flat] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[piece] / max(length.sum() / max(n, 1), 1)))
    others = np.bincount(piece, weights=weight)[piece] - weight
    weight = np.where(others > 0, np.minimum(weight, others * (1 - SHARE) / SHARE * (1 - 1e-6)), weight)
    weight /= np.bincount(piece, weights=weight)[piece]
    order = np.lexsort((piece, flat))
    flat, piece, weight = flat[order], piece[order], weight[order]
    common = df > max(2, COMMON * n)
    # Pieces in turn, common terms first in each: the sum up to a posting is what is left without it and rarer ones.
    by_piece = np.lexsort((flat, -df[flat], piece))
    ends = np.cumsum(weight[by_piece])
    begin = np.searchsorted(piece[by_piece], np.arange(n))
    upto = ends - (ends[begin] - weight[by_piece][begin])[piece[by_piece]]
    keep = np.empty(len(flat), bool)
    keep[by_piece] = upto >= SHARE - 1e-6
    keep |= ~common[flat]
    essential = np.bincount(flat[keep], minlength=len(terms)) > 0
    block = piece // BLOCK
    pairs, slot = np.unique(flat[keep] * (n // BLOCK + 1) + block[keep], return_inverse=True)
    block_max = np.zeros(len(pairs))
    np.maximum.at(block_max, slot, weight[keep])
    rest = np.bincount(piece[~keep], weights=weight[~keep], minlength=n)
    block_rest = np.zeros(n // BLOCK + 1)
    np.maximum.at(block_rest, np.arange(n) // BLOCK, rest)
    return Index(
        own,
        np.array(item_of, int),
        terms,
        np.searchsorted(flat, np.arange(len(terms) + 1)),
        piece,
        weight,
        essential,
        np.searchsorted(pairs // (n // BLOCK + 1), np.arange(len(terms) + 1)),
        pairs % (n // BLOCK + 1),
        block_max,
        block_rest,
        max(len(i.question) + len(i.answer) for i in own),
        {k: (np.array(sorted(r), np.uint64), [r[h] for h in sorted(r)]) for k, r in runs.items()},
    )


def _expanded(first: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All postings of the given terms: which of the given it is for, and its place."""
    sizes = first[term + 1] - first[term]
    of = np.repeat(np.arange(len(term)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first[term], sizes)
    return of, place


class Searcher:
    """An index ready for lookups in a task."""

    def __init__(self, index: Index):
        self.index = index
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        self.sieve[index.terms[index.essential] & np.uint64((1 << _SIEVE_BITS) - 1)] = True

    def _term(self, h: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for words that no item has."""
        at = np.minimum(np.searchsorted(self.index.terms, h), len(self.index.terms) - 1)
        return np.where(self.index.terms[at] == h, at, -1)

    def _candidates(self, h: np.ndarray, first: np.ndarray, owner_of) -> Iterator[tuple[int, int, int, float]]:
        """(text, first word of the passage, item, score) of pieces at or above the threshold."""
        ix, half = self.index, PASSAGE_WORDS // 2
        near = np.flatnonzero(self.sieve[h & np.uint64((1 << _SIEVE_BITS) - 1)])
        term = self._term(h[near])
        ok = (term >= 0) & ix.essential[np.maximum(term, 0)]
        near, term = near[ok], term[ok]
        if not len(near):
            return
        text = owner_of(near)
        step = (near - first[text]) // half
        # A passage is numbered by the text's first word plus its step, which no other text's passage shares.
        number = first[text] + step
        number = np.concatenate([number, (number - 1)[step > 0]])
        term = np.concatenate([term, term[step > 0]])
        once = np.unique(number * len(ix.terms) + term)
        number, term = once // len(ix.terms), once % len(ix.terms)
        # Whole passages at a time, with about POSTINGS blocks of their terms.
        sizes = ix.block_first[term + 1] - ix.block_first[term]
        group = np.cumsum(sizes) // POSTINGS
        opens = np.flatnonzero(np.diff(number, prepend=-1))
        cuts = opens[np.flatnonzero(np.diff(group[opens], prepend=-1))]
        for low, high in zip(cuts, [*cuts[1:], len(term)]):
            yield from self._scored(h, first, owner_of, number[low:high], term[low:high])

    def _scored(self, h, first, owner_of, number, term) -> Iterator[tuple[int, int, int, float]]:
        """``_candidates`` of some passages, given by their numbers and essential terms."""
        ix, half, blocks = self.index, PASSAGE_WORDS // 2, len(self.index.block_rest)
        of, place = _expanded(ix.block_first, term)
        key, slot = np.unique(number[of] * blocks + ix.block[place], return_inverse=True)
        bound = np.bincount(slot, weights=ix.block_max[place], minlength=len(key)) + ix.block_rest[key % blocks]
        key = key[bound >= SHARE - 1e-9]
        passages, at = np.unique(key // blocks, return_index=True)
        for passage, wanted in zip(passages, np.split(key % blocks, at[1:])):
            t = int(owner_of(np.array([passage]))[0])
            start = int(first[t] + (passage - first[t]) * half)
            found = np.unique(self._term(h[start : min(start + PASSAGE_WORDS, first[t + 1])]))
            _, place = _expanded(ix.first, found[found >= 0])
            block = ix.piece[place] // BLOCK
            near = np.minimum(np.searchsorted(wanted, block), len(wanted) - 1)
            place = place[wanted[near] == block]
            pieces, slot = np.unique(ix.piece[place], return_inverse=True)
            score = np.bincount(slot, weights=ix.weight[place], minlength=len(pieces))
            for p in np.flatnonzero(score >= SHARE - 1e-9):
                yield t, start, int(ix.item_of[pieces[p]]), float(score[p])

    def _short(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item number, word) of the first place of each short item in each text."""
        for n, (run, numbers) in self.index.short.items():
            found = _runs(h, n)
            at = np.minimum(np.searchsorted(run, found), len(run) - 1)
            place = np.flatnonzero(run[at] == found)
            text = np.searchsorted(first, place, "right") - 1
            inside = place + n <= first[text + 1]
            place, text = place[inside], text[inside]
            _, once = np.unique(text * len(run) + at[place], return_index=True)
            for k in once:
                for number in numbers[at[place[k]]]:
                    yield int(text[k]), number, int(place[k] - first[text[k]])

    def matches(self, texts: Texts) -> list[tuple[int, int, int, float, float, float]]:
        """(text, item number, word of the passage, score, question overlap, answer overlap), the best of each."""
        words = texts.lowered().words()
        if not len(words):
            return []
        h, first = word_hashes(words), words.first
        best: dict[tuple[int, int], tuple] = {(t, i): (1.0, 1.0, 1.0, word) for t, i, word in self._short(h, first)}
        owner_of = lambda at: np.searchsorted(first, at, "right") - 1
        for t, start, number, score in self._candidates(h, first, owner_of):
            item = self.index.items[number]
            low = max(first[t], start - self.index.longest)
            around = h[low : min(first[t + 1], start + PASSAGE_WORDS + self.index.longest)]
            asked = self._overlap(item.question, around, RUN_WORDS)
            answered = self._overlap(item.answer, around, ANSWER_RUN)
            if asked >= OVERLAP and answered >= OVERLAP:
                row = (score, asked, answered, int(start - first[t]))
                key = (t, number)
                if key not in best or row[:3] > best[key][:3]:
                    best[key] = row
        return [(t, i, r[3], r[0], r[1], r[2]) for (t, i), r in sorted(best.items())]

    def _overlap(self, part: np.ndarray, around: np.ndarray, run: int) -> float:
        if not len(part):
            return 1.0
        n = max(1, min(run, (len(part) + 1) // 3))  # one word breaks n runs, which are at most half of all
        return float(np.isin(_runs(part, n), _runs(around, n)).mean())


def _item_key() -> Column:
    """What an item goes by in the index; items of one text are one."""
    return F.xxhash64("text")


def indexes(benchmark: DataFrame) -> list[Index]:
    """Indexes over all items, in shards of bounded size."""
    given = benchmark.where("text IS NOT NULL").select(_item_key().alias("item_id"), "text").distinct()
    total = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = int(-(-total // (SHARD_BYTES // 2))) or 1
    out = []
    for k in range(shards):
        rows = given.where(F.pmod(F.xxhash64("text"), F.lit(shards)) == k).select("item_id", "text").collect()
        index = build(sorted(map(tuple, rows), key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[1])))
        if index is not None:
            out.append(index)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item it holds: ``doc_id``, ``item_id``, ``first_word`` (of the best passage),
    ``score``, ``question_overlap`` and ``answer_overlap``."""
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_kind}, item_key long, first_word long, score double, question_overlap double, answer_overlap double"
    found = mapped(docs.select("doc_id", "text"), "text", _Finder(_shared(docs, benchmark)), schema)
    named = benchmark.where("text IS NOT NULL").select(_item_key().alias("named"), "item_id").distinct()
    return found.join(named, F.col("item_key") == F.col("named")).select(
        "doc_id", "item_id", "first_word", "score", "question_overlap", "answer_overlap"
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, all columns, that hold no test item."""
    return mapped(docs, "text", _Filter(_shared(docs, benchmark)), docs.schema)


def _shared(docs: DataFrame, benchmark: DataFrame) -> list:
    return [docs.sparkSession.sparkContext.broadcast(index) for index in indexes(benchmark)]


class _OnIndex:
    """Work on the broadcast indexes of all shards, in one pass; searchers are made once in each task."""

    def __init__(self, shared: list):
        self.shared, self._searchers = shared, None

    def __getstate__(self):
        return {"shared": self.shared, "_searchers": None}

    @property
    def searchers(self) -> list[Searcher]:
        if self._searchers is None:
            self._searchers = [Searcher(one.value) for one in self.shared]
        return self._searchers


class _Finder(_OnIndex):
    def __call__(self, part: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = Texts.of(part.column("text"))
        found = [(one.index.items[m[1]].item_id, m) for one in self.searchers for m in one.matches(texts)]
        if not found:
            return None
        keys, matches = zip(*found)
        text, _, word, score, asked, answered = zip(*matches)
        return pa.record_batch(
            {
                "doc_id": part.column("doc_id").take(pa.array(text)),
                "item_key": pa.array(keys, pa.int64()),
                "first_word": pa.array(word, pa.int64()),
                "score": pa.array(score),
                "question_overlap": pa.array(asked),
                "answer_overlap": pa.array(answered),
            }
        )


class _Filter(_OnIndex):
    def __call__(self, part: pa.RecordBatch) -> pa.RecordBatch:
        clean = np.ones(part.num_rows, bool)
        texts = Texts.of(part.column("text"))
        for one in self.searchers:
            clean[[m[0] for m in one.matches(texts)]] = False
        return part.filter(pa.array(clean))
