"""Token counts without tokens: Viterbi over a unigram vocabulary that carries the best score and its piece count.

An Aho-Corasick automaton names every vocabulary piece that ends at each place; a segmentation's score is the sum
of its pieces' scores, and the best one's number of pieces is all that is kept. Ties go as in the public unigram
tokenizers: among equal scores the piece that starts earliest. A character that is no piece costs ten less than
the worst piece and counts as its UTF-8 bytes (byte fallback).

Texts are cut where no piece can reach across: before a run of spaces, and around characters that are in no longer piece.
Equal stretches are counted once in a slice of texts and remembered in a task up to ``REMEMBERED``, so the
automaton runs on a small part of the text. Scores are added in double precision, in which sums of the
vocabulary's whole numbers are exact. One pass, no shuffle.

Edge cases: a NULL or empty text has no tokens and score 0. Texts get a space in front, as the tokenizer's
normalization says. Repeated rows are counted alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import Texts, mapped

UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000
SPACE_MARK = "▁"


@dataclass
class Vocabulary:
    """Pieces with their scores; a space stands for the tokenizer's space mark."""

    pieces: dict[str, float]
    _automaton: object = None
    _known: dict[int, tuple[int, float]] = field(default_factory=dict)

    def __getstate__(self):
        return {"pieces": self.pieces, "_automaton": None, "_known": {}}

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """From a sentencepiece model with scores."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i) or model.is_byte(i)):
                pieces[model.id_to_piece(i).replace(SPACE_MARK, " ")] = model.get_score(i)
        return cls(pieces)

    @cached_property
    def unknown(self) -> float:
        """The score of a character that is no piece."""
        return min(self.pieces.values(), default=0.0) - UNKNOWN_PENALTY

    def breakers(self) -> np.ndarray:
        """ASCII bytes that no piece of several characters has: a cut before and after them loses nothing."""
        used = {c for p in self.pieces if len(p) > 1 for c in p}
        return np.array([i < 128 and i != 32 and chr(i) not in used for i in range(256)])

    def crosses_spaces(self) -> bool:
        """Whether a piece has a space after another character, so that texts can't be cut there."""
        return any(" " in p.lstrip(" ") for p in self.pieces)

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            built = ahocorasick.Automaton()
            for piece, score in self.pieces.items():
                built.add_word(piece, (len(piece), score))
            built.make_automaton()
            self._automaton = built
        return self._automaton

    def best(self, text: str) -> tuple[int, float]:
        """Piece count and score of the best segmentation."""
        n, unknown = len(text), self.unknown
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        reached = 0

        def alone(end: int) -> None:
            """The edge of a character that is no piece."""
            c = text[end - 1]
            score[end] = score[end - 1] + unknown
            count[end] = count[end - 1] + len(c.encode("utf-8", "replace"))

        for last, (length, value) in self.automaton().iter(text) if self.pieces else ():
            end = last + 1
            if end > reached:
                for place in range(reached + 1, end + 1):
                    alone(place)
                reached, width = end, 1
                if text[last] in self.pieces:
                    score[end], width = -np.inf, 0
            candidate = score[end - length] + value
            if candidate > score[end] or candidate == score[end] and length > width:
                score[end], count[end], width = candidate, count[end - length] + 1, length
        for place in range(reached + 1, n + 1):
            alone(place)
        return count[n], score[n]

    def counts(self, texts: Texts, breakers: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and scores of texts."""
        sizes = np.diff(texts.offsets)
        filled = np.flatnonzero(sizes)
        data = np.insert(texts.data, texts.offsets[:-1][filled], 32)
        begins = np.zeros(len(filled), np.int64)
        np.cumsum(sizes[filled][:-1] + 1, out=begins[1:])
        if not len(data):
            return np.zeros(len(texts), np.int64), np.zeros(len(texts))
        cut = np.zeros(len(data), bool)
        if not whole:
            space, breaker = data == 32, breakers[data]
            cut |= space | breaker
            cut[1:] &= ~space[1:] | ~space[:-1] | breaker[1:]
            cut[1:] |= breaker[:-1]
        cut[begins] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        padded = Texts(data, np.append(begins, len(data)))
        keys, first, slot = np.unique(padded.hashes(starts, ends), return_index=True, return_inverse=True)
        n, score = np.zeros(len(keys), np.int64), np.zeros(len(keys))
        known, raw = self._known, data.tobytes()
        if len(known) > REMEMBERED:
            known.clear()
        for i, key in enumerate(keys.tolist()):
            found = known.get(key)
            if found is None:
                at = first[i]
                found = known[key] = self.best(raw[starts[at] : ends[at]].decode("utf-8", "replace"))
            n[i], score[i] = found
        owner = filled[np.searchsorted(begins, starts, "right") - 1]
        totals = np.bincount(owner, weights=n[slot], minlength=len(texts))
        return totals.astype(np.int64), np.bincount(owner, weights=score[slot], minlength=len(texts))


class _Counter:
    """Counts for slices of rows; what is remembered stays with the task's copy."""

    def __init__(self, shared):
        self.shared, self._ready = shared, None

    def __getstate__(self):
        return {"shared": self.shared, "_ready": None}

    def __call__(self, part: pa.RecordBatch) -> pa.RecordBatch:
        if self._ready is None:
            vocabulary = self.shared.value
            self._ready = (vocabulary, vocabulary.breakers(), vocabulary.crosses_spaces())
        vocabulary, breakers, whole = self._ready
        n, score = vocabulary.counts(Texts.of(part.column(1)), breakers, whole)
        return pa.record_batch({"doc_id": part.column(0), "n_tokens": n, "score": score})


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``score`` (of the best segmentation) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as a tokenizer's file
    given = docs.select("doc_id", F.replace("text", F.lit(SPACE_MARK), F.lit(" ")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(given, "text", _Counter(shared), f"doc_id {kind}, n_tokens long, score double")
