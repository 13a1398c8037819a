"""Phrase collocations from a bidirectional FM-index of each shard, over word ids.

Texts are cut into pieces at marks and line ends, pieces into words. A shard is some ``SHARD_BYTES`` of texts as a task
reads them; its sequence of word ids (0 between pieces, frequent words with small ids) is indexed once, in both reading
directions, as two wavelet matrices whose packed bits are written to the shared folder. From then on no text is read.

1. Every word is an interval of the index. One extension to the left gives all two-word phrases of the shard with their
   counts: the distinct symbols of an interval, found for all intervals at once on the way down the wavelet matrix, with
   the interval of the longer phrase in either direction.
2. Counts are summed across shards: a shard sends its sorted keys and counts in packed arrays, one for each bucket of keys,
   the bucket adds up and answers each shard which of its phrases are frequent, and one shard that it is to name them.
3. A phrase of three or four words is frequent only if all its two-word parts are. Frequent pairs are extended to the right,
   those to the left, as long as the new pair is frequent too; counts are summed as before.
4. The named phrases are rows of text; cuts, scores, containment and ranks are joins and aggregates over them.

Nothing is collected. A phrase in all shards brings one key a shard to its bucket. Phrases are told apart by 64-bit hashes.

Edge cases: a NULL text counts as empty, a NULL language as ``und``; neither ids nor other columns are read. Repeated rows
count each time. An empty table, or one without a frequent phrase, gives no rows. A text larger than a shard is one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import Texts, fold, limit_batches, slices
from tidewell.llm.fmindex import BitVector, suffix_order
from tidewell.llm.variants import gathered
from tidewell.session import staged

LEAST = 30
LONGEST = 4
RATIO = 80
SCALE = 2_000_000
FIRST = 2_000
SHARD_BYTES = 16 << 20
UNKNOWN_LANGUAGE = "und"

_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _MARK.copy()
_GAP[[9, 32]] = True


def _packed(values: np.ndarray) -> bytes:
    """Bytes of the same place next to each other, compressed: small and sorted values take little room."""
    flat = np.ascontiguousarray(values)
    return zstandard.compress(np.ascontiguousarray(flat.view(np.uint8).reshape(len(flat), flat.itemsize).T).tobytes(), 1)


def _unpacked(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1)


class Wavelet:
    """Symbols of a sequence below any interval, and their ranks."""

    def __init__(self, levels: list[BitVector], length: int, symbols: int):
        self.levels, self.length = levels, length
        self.kind = np.int32 if length < 2**31 else np.int64
        self.zeros = [length - int(level.ones(np.array([length]))[0]) for level in levels]
        place = np.zeros(symbols, np.int64)
        number = np.arange(symbols)
        for depth, (level, zeros) in enumerate(zip(levels, self.zeros)):
            ones = level.ones(place)
            place = np.where((number >> (len(levels) - 1 - depth)) & 1, zeros + ones, place - ones)
        self.starts = place.astype(self.kind)

    @staticmethod
    def bits_of(sequence: np.ndarray, symbols: int) -> bytes:
        """Packed bits of all levels."""
        out = []
        room = np.zeros(-(-(len(sequence) + 1) // 64) * 64, bool)
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (sequence & sequence.dtype.type(1 << shift)).astype(bool)
            room[: len(bit)] = bit
            out.append(np.packbits(room, bitorder="little"))
            sequence = np.concatenate([np.compress(~bit, sequence), np.compress(bit, sequence)])
        return zstandard.compress(np.concatenate(out).tobytes(), 1)

    @classmethod
    def of_bits(cls, data: bytes, length: int, symbols: int) -> Wavelet:
        words = np.frombuffer(zstandard.decompress(data), "<u8").reshape(max(1, int(symbols - 1).bit_length()), -1)
        levels = []
        for own in words:
            level = BitVector.__new__(BitVector)
            ones = np.bitwise_count(own).astype(np.int64)
            level.words, level.before = own, (np.cumsum(ones) - ones).astype(np.int32)
            levels.append(level)
        return cls(levels, length, symbols)

    def below(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each interval its distinct symbols in order: interval, symbol, rank before it, occurrences in it."""
        kind = self.kind
        who, symbol = np.arange(len(low), dtype=kind), np.zeros(len(low), kind)
        low, high = low.astype(kind), high.astype(kind)
        for level, zeros in zip(self.levels, self.zeros):
            ones_low, ones_high = level.ones(low), level.ones(high)
            zeros_low, zeros_high = low - ones_low, high - ones_high
            # Zeros and ones of an interval stay next to each other, so the result is in order.
            zero, one = np.flatnonzero(zeros_high > zeros_low), np.flatnonzero(ones_high > ones_low)
            times = (zeros_high > zeros_low).astype(np.int8) + (ones_high > ones_low)
            ends = np.cumsum(times, dtype=kind)
            at_zero, at_one = (ends - times)[zero], ends[one] - 1
            low, high = np.empty(len(zero) + len(one), kind), np.empty(len(zero) + len(one), kind)
            low[at_zero], high[at_zero] = zeros_low[zero], zeros_high[zero]
            low[at_one], high[at_one] = zeros + ones_low[one], zeros + ones_high[one]
            who, symbol = np.repeat(who, times), np.repeat(symbol * 2, times)
            symbol[at_one] += 1
        return who, symbol, low - self.starts[symbol], high - low


def _order(sequence: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Places in order of the ``depth`` symbols from them on."""
    bits = max(1, int(symbols - 1).bit_length())
    if bits * depth > 63:
        return suffix_order(sequence, depth)
    key = np.zeros(len(sequence), np.int64)
    for k in range(depth):
        key <<= bits
        key[: len(key) - k] |= sequence[k:]
    return np.argsort(key)


class Phrases:
    """Phrases of one length in a shard: words, keys, counts, and their intervals in both directions."""

    def __init__(self, words: np.ndarray, keys: np.ndarray, size: np.ndarray, low: np.ndarray, back: np.ndarray):
        self.words, self.keys, self.size, self.low, self.back = words, keys, size, low, back

    def __getitem__(self, which: np.ndarray) -> Phrases:
        return Phrases(self.words[which], self.keys[which], self.size[which], self.low[which], self.back[which])

    def __len__(self) -> int:
        return len(self.keys)


class Index:
    """Bidirectional index of a shard; ``keys`` and ``counts`` are those of the symbols, 0 being the end of a piece."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, forward: bytes, backward: bytes):
        self.keys, length = keys, int(counts.sum())
        self.forward = Wavelet.of_bits(forward, length, len(counts))
        kind = self.forward.kind
        self.first = (np.cumsum(counts) - counts).astype(kind)
        self.counts = counts.astype(kind)
        self.backward = Wavelet.of_bits(backward, length, len(counts))

    @staticmethod
    def bits_of(sequence: np.ndarray, symbols: int, longest: int = LONGEST) -> tuple[bytes, bytes]:
        """Of a sequence that begins and ends with 0. Extension to ``longest`` words looks one word less far."""
        out = []
        for own in (sequence, sequence[::-1]):
            out.append(Wavelet.bits_of(own[_order(own, symbols, longest - 1) - 1].astype(np.int32), symbols))
        return out[0], out[1]

    def single(self) -> Phrases:
        symbol = np.arange(1, len(self.counts), dtype=self.counts.dtype)
        return Phrases(symbol[:, None], self.keys[1:], self.counts[1:], self.first[1:], self.first[1:])

    def extended(self, known: Phrases, left: bool) -> Phrases:
        """All phrases one word longer, on the left or on the right."""
        matrix, own, other = (self.forward, known.low, known.back) if left else (self.backward, known.back, known.low)
        who, symbol, rank, size = matrix.below(own, own + known.size)
        # In the other direction longer phrases follow one another in the order of the new word.
        before = np.cumsum(size, dtype=size.dtype) - size
        begins = np.searchsorted(who, np.arange(len(known)))
        shift = before - (before[np.minimum(begins, max(0, len(before) - 1))][who] if len(before) else 0)
        moved, kept = self.first[symbol] + rank, other[who] + shift
        real = symbol > 0
        who, symbol, size, moved, kept = who[real], symbol[real], size[real], moved[real], kept[real]
        if left:
            words = np.column_stack([symbol, known.words[who]])
            return Phrases(words, fold(self.keys[symbol], known.keys[who]), size, moved, kept)
        words = np.column_stack([known.words[who], symbol])
        return Phrases(words, fold(known.keys[who], self.keys[symbol]), size, kept, moved)

    def short(self) -> list[Phrases]:
        """Single words and pairs."""
        single = self.single()
        return [single, self.extended(single, left=True)]

    def long(self, pairs: Phrases, longest: int = LONGEST) -> list[Phrases]:
        """Phrases of three words and more whose pairs are all among ``pairs``, by extension to the right and left in turn."""
        def coded(pair: np.ndarray) -> np.ndarray:
            return pair[:, 0].astype(np.int64) * len(self.counts) + pair[:, 1]

        codes = np.sort(coded(pairs.words))
        out, known = [], pairs
        for length in range(3, longest + 1):
            left = length % 2 == 0
            longer = self.extended(known, left)
            pair = longer.words[:, :2] if left else longer.words[:, -2:]
            code = coded(pair)
            at = np.minimum(np.searchsorted(codes, code), max(0, len(codes) - 1))
            known = longer[codes[at] == code if len(codes) else np.zeros(0, np.int64)]
            out.append(known)
        return out


class _Shard:
    """Words of texts as they come, until a shard is full."""

    def __init__(self):
        self.keys, self.places, self.breaks, self.words, self.langs, self.held = [], [], [], [], [], 0

    def add(self, langs: list[str], texts: Texts) -> None:
        texts = texts.lowered()
        data = texts.data
        inside = ~_GAP[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        filled = np.diff(texts.offsets) > 0
        opens[texts.offsets[:-1][filled]] = inside[texts.offsets[:-1][filled]]
        closes[texts.offsets[1:][filled] - 1] = inside[texts.offsets[1:][filled] - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.held += len(data)
        if not len(starts):
            return
        marks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_MARK[data], out=marks[1:])
        owner = np.searchsorted(texts.offsets, starts, "right") - 1
        new = np.ones(len(starts), bool)
        new[1:] = (marks[starts[1:]] > marks[ends[:-1]]) | (owner[1:] != owner[:-1])
        names, number = np.unique(np.array(langs, object), return_inverse=True)
        lang_keys = _text_keys(names.tolist())
        keys, first, place = np.unique(
            fold(lang_keys[number][owner], texts.hashes(starts, ends)), return_index=True, return_inverse=True
        )
        self.keys.append(keys)
        self.places.append(place)
        self.breaks.append(new)
        self.words.append(gathered(data, starts[first], ends[first]))
        self.langs.append(names[number[owner[first]]])

    def row(self, number: int) -> pa.RecordBatch | None:
        if not self.keys:
            return None
        keys, first, place = np.unique(np.concatenate(self.keys), return_index=True, return_inverse=True)
        base = np.cumsum([0] + [len(k) for k in self.keys])
        own = np.concatenate([place[b + p] for b, p in zip(base, self.places)])
        counts = np.bincount(own, minlength=len(keys))
        order = np.argsort(-counts, kind="stable")
        symbol = np.empty(len(keys), np.int64)
        symbol[order] = np.arange(1, len(keys) + 1)
        sequence = np.insert(symbol[own], np.flatnonzero(np.concatenate(self.breaks)), 0)
        sequence = np.append(sequence, 0)
        forward, backward = Index.bits_of(sequence, len(keys) + 1)
        langs = np.concatenate(self.langs)[first]
        names, lang = np.unique(langs, return_inverse=True)
        totals = np.bincount(lang, weights=counts, minlength=len(names)).astype(np.int64)
        words = pa.concat_arrays(self.words).take(pa.array(first[order])).to_pylist()
        ends = int((sequence == 0).sum())
        return pa.record_batch(
            {
                "shard": pa.array([number], pa.int64()),
                "keys": pa.array([_packed(np.append(np.uint64(0), keys[order]))], pa.binary()),
                "counts": pa.array([_packed(np.append(ends, counts[order]).astype(np.int64))], pa.binary()),
                "words": pa.array([zstandard.compress(" ".join(words).encode(), 1)], pa.binary()),
                "lang_of": pa.array([_packed(lang[order].astype(np.int32))], pa.binary()),
                "langs": pa.array([names.tolist()], pa.list_(pa.string())),
                "totals": pa.array([totals.tolist()], pa.list_(pa.int64())),
                "forward": pa.array([forward], pa.binary()),
                "backward": pa.array([backward], pa.binary()),
            }
        )


def _text_keys(texts: list[str]) -> np.ndarray:
    own = Texts.of(pa.array(texts, pa.string()))
    return own.hashes(own.offsets[:-1], own.offsets[1:])


def indexed(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each shard with its words and its index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for part in slices(batches, "text"):
            shard.add(part.column("lang").to_pylist(), Texts.of(part.column("text")))
            if shard.held >= shard_bytes:
                row = shard.row(number)
                number, shard = number + 1, _Shard()
                if row is not None:
                    yield row
        row = shard.row(number)
        if row is not None:
            yield row

    limit_batches(docs.sparkSession)
    given = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANGUAGE)).alias("lang"), "text")
    return given.mapInArrow(
        run,
        "shard long, keys binary, counts binary, words binary, lang_of binary, langs array<string>, totals array<long>, "
        "forward binary, backward binary",
    )


def _index(row: dict) -> Index:
    keys, counts = _unpacked(row["keys"], np.uint64), _unpacked(row["counts"], np.int64)
    return Index(keys, counts, row["forward"], row["backward"])


def _sent(shard: int, step: int, levels: list[Phrases], buckets: int) -> pa.Table:
    """Keys and counts of some levels, in order of keys, a row for each bucket of keys."""
    keys, counts = np.concatenate([x.keys for x in levels]), np.concatenate([x.size for x in levels])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(np.uint32)
    edges = np.searchsorted(_bucket(keys, buckets), np.arange(buckets + 1))
    rows = [(b, edges[b], edges[b + 1]) for b in range(buckets) if edges[b + 1] > edges[b]]
    return pa.table(
        {
            "bucket": pa.array([b for b, _, _ in rows], pa.int64()),
            "shard": pa.array([shard] * len(rows), pa.int64()),
            "step": pa.array([step] * len(rows), pa.int32()),
            "keys": pa.array([_packed(np.diff(keys[a:z], prepend=np.uint64(0))) for _, a, z in rows], pa.binary()),
            "counts": pa.array([_packed(counts[a:z]) for _, a, z in rows], pa.binary()),
        }
    )


_SENT = "bucket long, shard long, step int, keys binary, counts binary"
_REPLY = "shard long, step int, bucket long, marks binary, totals binary"


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets follow the order of keys."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _summed(sent: DataFrame, least: int) -> DataFrame:
    """For each row sent: a mark for each key (1 if frequent, 2 if the shard is to name it as well), and named totals."""

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("shard")
        keys = [np.cumsum(_unpacked(k, np.uint64), dtype=np.uint64) for k in rows.column("keys").to_pylist()]
        sizes = [len(k) for k in keys]
        keys = np.concatenate(keys)
        counts = np.concatenate([_unpacked(c, np.uint32) for c in rows.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        at = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        total = np.add.reduceat(counts[order], at)
        frequent = total >= least
        marks, named = np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.int64)
        marks[order] = np.repeat(frequent.astype(np.uint8), np.diff(np.append(at, len(keys))))
        marks[order[at[frequent]]] = 2
        named[order[at[frequent]]] = total[frequent]
        ends = np.cumsum(sizes)
        parts = list(zip(ends - sizes, ends))
        return pa.table(
            {
                "shard": rows.column("shard"),
                "step": rows.column("step"),
                "bucket": rows.column("bucket"),
                "marks": pa.array([_packed(marks[a:z]) for a, z in parts], pa.binary()),
                "totals": pa.array([_packed(named[a:z][marks[a:z] == 2]) for a, z in parts], pa.binary()),
            }
        )

    return sent.groupBy("bucket").applyInArrow(add, _REPLY)


class _Replies:
    """What buckets answered a shard, back in the order of its phrases."""

    def __init__(self, rows: pa.Table):
        self.rows = rows.sort_by([("step", "ascending"), ("bucket", "ascending")])

    def marked(self, step: int, levels: list[Phrases]) -> list[tuple[Phrases, np.ndarray, np.ndarray]]:
        """For each level its phrases with marks and totals."""
        own = self.rows.filter(pa.compute.equal(self.rows.column("step"), step))
        keys = np.concatenate([x.keys for x in levels])
        order = np.argsort(keys)
        marks, totals = np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.int64)
        if own.num_rows:
            got = np.concatenate([_unpacked(m, np.uint8) for m in own.column("marks").to_pylist()])
            marks[order] = got
            totals[order[got == 2]] = np.concatenate([_unpacked(t, np.int64) for t in own.column("totals").to_pylist()])
        edges = np.cumsum([0] + [len(x) for x in levels])
        return [(x, marks[a:z], totals[a:z]) for x, a, z in zip(levels, edges, edges[1:])]


def phrases(docs: DataFrame, least: int = LEAST, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of one to ``LONGEST`` words (``lang``, ``words``, ``phrase``, ``f``), and ``n`` of each ``lang``."""
    index = staged(indexed(docs, shard_bytes), "index")
    buckets = max(8, index.count())

    def send_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _sent(row["shard"], 1, _index(row).short(), buckets).to_batches()

    def send_long(shard: pa.Table, replies: pa.Table) -> pa.Table:
        row = shard.to_pylist()[0]
        own = _index(row)
        (_, (pairs, marks, _)) = _Replies(replies).marked(1, own.short())
        return _sent(row["shard"], 2, own.long(pairs[marks > 0]), buckets)

    def name(shard: pa.Table, replies: pa.Table) -> pa.Table:
        row = shard.to_pylist()[0]
        own, got = _index(row), _Replies(replies)
        short = got.marked(1, own.short())
        long = got.marked(2, own.long(short[1][0][short[1][1] > 0]))
        words = np.array(["", *zstandard.decompress(row["words"]).decode().split(" ")], object)
        lang = np.append(0, _unpacked(row["lang_of"], np.int32))
        langs = np.array(row["langs"], object)
        out = []
        for level, marks, totals in (*short, *long):
            mine = np.flatnonzero(marks == 2)
            symbols = level.words[mine]
            joined = words[symbols[:, 0]]
            for k in range(1, symbols.shape[1]):
                joined = joined + " " + words[symbols[:, k]]
            out.append(
                pa.table(
                    {
                        "lang": pa.array(langs[lang[symbols[:, 0]]].tolist(), pa.string()),
                        "words": pa.array(np.full(len(mine), symbols.shape[1], np.int32)),
                        "phrase": pa.array(joined.tolist(), pa.string()),
                        "f": pa.array(totals[mine]),
                    }
                )
            )
        return pa.concat_tables(out)

    limit_batches(docs.sparkSession)
    columns = ("shard", "keys", "counts", "forward", "backward")
    first = _summed(index.select(*columns).mapInArrow(send_short, _SENT), least)
    whole = index.drop("totals")
    sent = whole.groupBy("shard").cogroup(first.groupBy("shard")).applyInArrow(send_long, _SENT)
    replies = first.unionByName(_summed(sent, least))
    named = whole.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(
        name, "lang string, words int, phrase string, f long"
    )
    totals = (
        index.select(F.explode(F.arrays_zip("langs", "totals")).alias("t"))
        .groupBy(F.col("t.langs").alias("lang"))
        .agg(F.sum("t.totals").alias("n"))
    )
    return staged(named, "phrases"), totals


def _part(words: str, first: Column, count: Column) -> Column:
    """Some consecutive words of a phrase, joined."""
    return F.array_join(F.slice(words, first, count), " ")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(
    docs: DataFrame, least: int = LEAST, ratio: int = RATIO, first: int | None = FIRST, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the best phrases of each language.

    A phrase counts as often as it occurs (``a``), and scores by its weakest cut into two phrases with counts ``l`` and
    ``r``. It goes if a longer phrase that holds it has at least ``ratio`` hundredths of its count. ``first`` None keeps all.
    """
    known, totals = phrases(docs, least, shard_bytes)
    split = known.withColumn("parts", F.split("phrase", " "))
    candidates = split.where("words >= 2")
    parts = known.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "f")
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "words", "parts", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        _part("parts", F.lit(1), F.col("k")).alias("head"),
        _part("parts", F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
    )
    heads, tails = parts.toDF("head_of", "head_part", "l"), parts.toDF("tail_of", "tail_part", "r")
    scored = (
        cuts.join(heads, (F.col("lang") == F.col("head_of")) & (F.col("head") == F.col("head_part")))
        .join(tails, (F.col("lang") == F.col("tail_of")) & (F.col("tail") == F.col("tail_part")))
        .withColumn("score", F.expr(f"({SCALE}BD * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + r)"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("words") - size + 1),
                lambda at: F.array_join(F.slice("parts", at, size), " "),
            ),
        )
    )
    inside = (
        split.where("words >= 3")
        .select(F.col("lang").alias("in_lang"), "f", F.explode(spans).alias("inner"))
        .groupBy("in_lang", "inner")
        .agg(F.max("f").alias("longer"))
    )
    held = (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner"))
    absorbed = F.coalesce(F.lit(100) * _wide("longer") >= F.lit(ratio) * _wide("a"), F.lit(False))
    left = scored.join(inside, held, "left").where(~absorbed).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )
    ranked = left.selectExpr(
        "*", "CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank"
    )
    if first is not None:
        ranked = ranked.where(F.col("rank") <= first)
    sizes = totals.withColumnRenamed("lang", "total_of")
    return ranked.join(sizes, F.col("lang") == F.col("total_of")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
