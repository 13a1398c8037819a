"""Texts of an Arrow batch as one byte array, and its words as positions in it.

A Python loop over words costs more than the budget of a whole operator, so operators that read every
word work on numpy arrays that span a slice of a batch. A slice holds a bounded number of text bytes
(or one text, if that is longer), so memory does not follow the size of a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20

#: Space and the control characters 9 to 13 part words; every other byte belongs to one.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_KEYS = np.random.default_rng(20240201).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if size <= 4 * SLICE_BYTES:  # those of a very long text are not kept
            _powers[base] = known
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: spreads every bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fold(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash for two in order."""
    return mixed(left * np.uint64(_STEP) + right)


def sequence_hashes(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each stretch of a sequence of hashes, in constant time each."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers_of(_STEP, len(h)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _powers_of(_BACK, len(h) + 1)[starts])


class Texts:
    """Bytes of several texts in a row; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self._sums = data, offsets, None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, array: pa.Array) -> Texts:
        """NULL counts as empty."""
        array = array.cast(pa.large_binary())
        if array.null_count:
            array = array.fill_null(b"")
        offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        buffer = array.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.zeros(0, np.uint8)
        return cls(data, offsets - offsets[0])

    def parts(self, limit: int = SLICE_BYTES) -> Iterator[Texts]:
        """The same texts in turn, at most ``limit`` bytes (or one text) at a time."""
        at = 0
        while at < len(self):
            to = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + limit, "right")) - 1)
            own = self.offsets[at : to + 1]
            yield Texts(self.data[own[0] : own[-1]], own - own[0])
            at = to

    def lowered(self) -> Texts:
        """A-Z as a-z; other characters stay."""
        return Texts(LOWER[self.data], self.offsets)

    def words(self) -> Words:
        return Words(self)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of stretches of bytes, in constant time each."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE_KEYS[self.data] * _powers_of(_STEP, len(self.data)), out=self._sums[1:])
        return mixed((self._sums[ends] - self._sums[starts]) * _powers_of(_BACK, len(self.data) + 1)[starts])


class Words:
    """Words of texts in a row; those of text ``i`` are ``first[i]`` to ``first[i + 1]``."""

    def __init__(self, texts: Texts):
        inside = ~IS_SPACE[texts.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        begin = texts.offsets[:-1][np.diff(texts.offsets) > 0]
        opens[begin] = inside[begin]
        last = texts.offsets[1:][np.diff(texts.offsets) > 0] - 1
        closes[last] = inside[last]
        self.texts = texts
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, texts.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owners(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.texts)), self.counts)

    def hashes(self) -> np.ndarray:
        return self.texts.hashes(self.starts, self.ends)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words with one space after each: bytes, and where each word starts and ends in them."""
        lengths = self.ends - self.starts
        new_starts = np.zeros(len(self) + 1, np.int64)
        np.cumsum(lengths + 1, out=new_starts[1:])
        keep = ~IS_SPACE[self.texts.data]
        out = np.full(new_starts[-1], 32, np.uint8)
        room = np.ones(new_starts[-1], bool)
        room[new_starts[1:] - 1] = False
        out[room] = self.texts.data[keep]
        return out, new_starts[:-1], new_starts[:-1] + lengths


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` text bytes, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False), np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def mapped(
    df: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str
) -> DataFrame:
    """``work`` on slices of batches; for rules that need no other row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column):
            out = work(part)
            if out is not None and out.num_rows:
                yield out

    limit_batches(df.sparkSession)
    # Names with dots can't go to Python as they are; columns keep their places.
    plain = df.toDF(*(f"column_{i}" if "." in name or "`" in name else name for i, name in enumerate(df.columns)))
    return plain.mapInArrow(run, schema)


BATCH_BYTES = 8 << 20


def limit_batches(spark) -> None:
    """Batches to Python by bytes as well as by rows: very long texts must not add up."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, str(2**63 - 1), "-1"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def crc_of(ids: np.ndarray | list) -> np.ndarray:
    import zlib

    return np.array([zlib.crc32(str(i).encode()) for i in ids], np.int64)
