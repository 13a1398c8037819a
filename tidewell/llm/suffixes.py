"""Suffix-array deduplication of bytes: a distributed merge sort of suffixes that compares no known prefix twice.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id. Sending every
suffix would cost many times the text, so suffixes travel in groups and only where they may repeat:

1. Texts are dealt to chunks, which is the only time they are shuffled. Each string of ``length`` bytes has an anchor: of the
   ``gram`` bytes long strings in it the one with the smallest hash. Chunks send their distinct anchors in four bytes
   each to buckets, and learn which of them another document may have. Equal strings have equal anchors, so nothing is lost.
2. Neighbouring strings with one anchor form a stretch, which is their common suffix order's unit: the longest suffix stands
   for the shorter ones in it. A chunk sorts the stretches of each shard (dealt by anchor) and sends them front-coded, as the
   length of the prefix shared with the one before and the bytes that follow.
3. A shard decodes the runs and merges them with loser trees. A tree keeps the common prefix (LCP) of each loser and its
   winner; two candidates of unequal LCP are told apart without reading a byte, others from the LCP on. Key ranges
   of the shard are merged side by side, one tree each, which lets numpy do a step of all trees at once. More
   than ``FAN_IN`` runs are merged in rounds.
4. Equal stretches are neighbours now and know their smallest id. Where an anchor has several stretches, which may share
   some strings only, their strings are put in suffix order as well. A run is answered with a bit for each string.
5. Chunks cover the bytes of marked strings and join what is left.

Chunks and shards are bounded by bytes and their number follows the input; nothing is collected. A passage that all
documents hold brings its shard one stretch a chunk, some hundred bytes: at 100 TB that is about 0.6 GB in a task.

Edge cases: a NULL or empty text has no bytes, and a text shorter than ``length`` loses none. Ids are integers; a NULL id
counts as larger than all, and rows with equal ids never take bytes from each other. Repeated rows get equal results. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import limit_batches, mixed

LENGTH = 50
CHUNK_BYTES = 16 << 20
BLOCK = 1 << 20
FAN_IN = 64
LANE = 128
_LAST = np.iinfo(np.int64).max
_FACTORS = np.random.default_rng(20240712).integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shape:
    """Sizes that follow from the length of the strings looked for."""

    def __init__(self, length: int):
        if not 16 <= length <= 200:
            raise ValueError("strings of 16 to 200 bytes can be looked for")
        self.length = length
        self.gram = max(length // 2, length - 26)
        self.most = min(32, length - self.gram + 1)  # strings in a stretch
        self.width = length + self.most - 1  # bytes of the longest stretch
        self.row = -(-(self.width + 1) // 8) * 8  # with a byte for its size, in whole words


def _packed(values: np.ndarray) -> bytes:
    """Compressed, bytes of equal weight together."""
    flat = np.ascontiguousarray(values)
    return zstandard.compress(np.ascontiguousarray(flat.view(np.uint8).reshape(len(flat), flat.itemsize).T).tobytes(), 1)


def _unpacked(data: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1)


class Chunk:
    """Bytes of some documents in a row, and the stretches in them."""

    def __init__(self, table: pa.Table, shape: Shape):
        # Where a block ends must not depend on the order in which rows arrive.
        self.shape, self.table = shape, table.sort_by("row")
        table = self.table
        texts = pa.concat_arrays(table.column("text").cast(pa.large_binary()).fill_null(b"").chunks)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        own = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.size = len(own)
        self.data = np.concatenate([own, np.zeros(shape.row + 8, np.uint8)])
        self.ids = np.asarray(table.column("doc_id").cast(pa.int64()).fill_null(_LAST))
        parts = [self._stretches(at) for at in range(0, self.size, BLOCK)]
        if parts:
            self.start, self.count, self.anchor, self.at = (np.concatenate(p) for p in zip(*parts))
        else:
            self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int16)
            self.anchor, self.at = np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        self.owner = np.searchsorted(self.offsets, self.start, "right") - 1

    def _stretches(self, begin: int):
        """Stretches of the strings that start in a block: start, number of strings, anchor, place of the anchor."""
        shape, most = self.shape, self.shape.length - self.shape.gram + 1
        n = min(BLOCK, self.size - begin)
        grams = n + most - 1
        words = np.ndarray(
            (max(0, min(grams + shape.gram, len(self.data) - begin) - 7),), "<u8", self.data[begin:], strides=(1,)
        ).copy()
        grams = min(grams, len(words) - (shape.gram - 8))
        hashes = np.zeros(grams, np.uint64)
        for factor, shift in zip(_FACTORS, [*range(0, shape.gram - 8, 8), shape.gram - 8]):
            hashes += words[shift : shift + grams] * factor
        hashes ^= hashes >> np.uint64(32)
        hashes *= _FACTORS[-1]
        hashes ^= hashes >> np.uint64(29)
        # A string lies in one document if none ends before it does.
        inside = np.ones(n, bool)
        ends = self.offsets[1:]
        for end in ends[np.searchsorted(ends, begin, "right") : np.searchsorted(ends, begin + n + shape.length)]:
            inside[max(0, end - shape.length + 1 - begin) : max(0, end - begin)] = False
        inside[max(0, self.size - shape.length + 1 - begin) :] = False
        place = np.flatnonzero(inside)
        if not len(place):
            return np.zeros(0, np.int64), np.zeros(0, np.int16), np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        low, step = hashes, 1
        while 2 * step <= most:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        low = np.minimum(low[: len(low) - (most - step)], low[most - step :])
        lowest = low[place]
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(place) != 1) | (lowest[1:] != lowest[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(place)))
        pieces = -(-count // shape.most)  # of texts that repeat themselves
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(place[first], pieces) + within * shape.most
        count = np.minimum(np.repeat(count, pieces) - within * shape.most, shape.most)
        at = np.zeros(len(start), np.uint8)
        for a in range(0, len(start), 1 << 16):
            at[a : a + (1 << 16)] = sliding_window_view(hashes, most)[start[a : a + (1 << 16)]].argmin(axis=1)
        # Smallest hashes are small; mixed ones spread over all buckets and shards.
        return start + begin, count.astype(np.int16), mixed(np.repeat(lowest[first], pieces)), at

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors in order, whether several ids have each, and the place of each stretch's anchor among them."""
        anchors, place = np.unique(self.anchor, return_inverse=True)
        low, high = np.full(len(anchors), _LAST), np.full(len(anchors), -_LAST)
        ids = self.ids[self.owner]
        np.minimum.at(low, place, ids)
        np.maximum.at(high, place, ids)
        return anchors, high > low, place

    def runs(self, shared: np.ndarray, shards: int):
        """For each shard its sorted run, and which entry of it each of these stretches is."""
        shape = self.shape
        shard = (((self.anchor[shared] & np.uint64(0xFFFFFFFF)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
        order = shared[np.argsort(shard, kind="stable")]
        shard = np.sort(shard)
        view = sliding_window_view(self.data, shape.width)
        edges = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
        for a, z in zip(edges, np.append(edges[1:], len(shard)).astype(np.int64)):
            own = order[a:z]
            size = self.count[own].astype(np.int64) + shape.length - 1
            rows = np.zeros((len(own), shape.row), np.uint8)
            rows[:, : shape.width] = view[self.start[own]]
            rows[:, : shape.width][np.arange(shape.width)[None, :] >= size[:, None]] = 0
            rows[:, shape.width] = size
            text = rows.reshape(-1).view(f"S{shape.row}")
            by_text = np.argsort(text, kind="stable")
            own, rows = own[by_text], rows[by_text]
            lcp = _lcp(rows)
            new = lcp < shape.row
            entry = np.cumsum(new) - 1
            at = np.flatnonzero(new)
            ids = np.minimum.reduceat(self.ids[self.owner[own]], at)
            yield int(shard[a]), Run(rows[at], lcp[at], ids, self.at[own[at]]), own, entry

    def cleaned(self, stretch: np.ndarray, marks: np.ndarray) -> pa.Table:
        """Documents without the bytes of marked strings; ``marks`` has a bit for each string of a stretch."""
        flag = np.zeros(self.size + 2, bool)  # strings that go, by the place after their start
        for string in range(self.shape.most):
            flag[self.start[stretch[marks >> string & 1 > 0]] + string + 1] = True
        first, last = np.flatnonzero(flag[1:] & ~flag[:-1]), np.flatnonzero(flag[:-1] & ~flag[1:]) - 1
        owner = np.searchsorted(self.offsets, first, "right") - 1
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] - last[:-1] > self.shape.length) | (owner[1:] != owner[:-1])
        begin, owner = first[new], owner[new]
        end = last[np.append(new[1:], True)] + self.shape.length if len(first) else begin
        edge = np.zeros(self.size + 1, np.int8)
        np.add.at(edge, begin, 1)
        np.add.at(edge, end, -1)
        keep = np.cumsum(edge[:-1], dtype=np.int8) == 0
        n = len(self.ids)
        removed = np.bincount(owner, weights=end - begin, minlength=n).astype(np.int64)
        spans = np.bincount(owner, minlength=n)
        sizes = np.diff(self.offsets)
        left = np.concatenate([[0], np.cumsum(sizes - removed)])
        kept = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(left.tobytes()), pa.py_buffer(self.data[: self.size][keep].tobytes())]
        )
        base = self.offsets[owner]
        places = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], ["start", "end"])
        return pa.table(
            {
                "doc_id": self.table.column("doc_id"),
                "n_bytes": pa.array(sizes),
                "n_removed": pa.array(removed),
                "n_spans": pa.array(spans.astype(np.int64)),
                "spans": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(spans)).astype(np.int32)), places),
                "kept": kept.cast(pa.binary()),
            }
        )


def _lcp(rows: np.ndarray) -> np.ndarray:
    """For each row the bytes it shares with the row before; the whole width if they are equal, 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    for a in range(1, len(rows), 1 << 16):
        z = min(len(rows), a + (1 << 16))
        differs = rows[a:z] != rows[a - 1 : z - 1]
        out[a:z] = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return out


class Run:
    """Stretches in order: padded rows, LCP with the row before, smallest ids, places of the anchors."""

    def __init__(self, rows: np.ndarray, lcp: np.ndarray, ids: np.ndarray, at: np.ndarray):
        self.rows, self.lcp, self.ids, self.at = rows, lcp, ids, at

    def front_coded(self, shape: Shape) -> dict[str, bytes]:
        size = self.rows[:, shape.width].astype(np.int64)
        lcp = np.minimum(self.lcp, size)
        lcp[:1] = 0
        column = np.arange(shape.width)[None, :]
        tail = self.rows[:, : shape.width][(column >= lcp[:, None]) & (column < size[:, None])]
        heads = np.concatenate([lcp, size, self.at]).astype(np.uint8)
        return {
            "heads": zstandard.compress(heads.tobytes(), 1),
            "ids": _packed(self.ids),
            "tail": zstandard.compress(tail.tobytes(), 1),
        }

    @classmethod
    def decoded(cls, coded: dict[str, bytes], shape: Shape) -> Run:
        heads = np.frombuffer(zstandard.decompress(coded["heads"]), np.uint8).reshape(3, -1).astype(np.int64)
        lcp, size, at = heads
        tail = np.append(np.frombuffer(zstandard.decompress(coded["tail"]), np.uint8), np.uint8(0))
        n = len(lcp)
        begin = np.cumsum(size - lcp) - (size - lcp)
        rows = np.zeros((shape.row, n), np.uint8)
        number = np.arange(n)
        for column in range(shape.width):
            # The last row at or before that spells this column out.
            source = np.maximum.accumulate(np.where(lcp <= column, number, 0))
            place = np.where(column < size[source], begin[source] + column - lcp[source], len(tail) - 1)
            rows[column] = np.where(column < size, tail[place], 0)
        rows[shape.width] = size
        return cls(np.ascontiguousarray(rows.T), lcp, _unpacked(coded["ids"], np.int64), at)


def merge(words: np.ndarray, lcp: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of sorted runs, and the LCP in bytes of each row and the one before in that order.

    ``words`` are rows as big-endian words, ``ends`` the ends of the runs, ``lcp`` that within runs. Runs are cut by
    sampled rows into lanes, which are key ranges; every lane has a loser tree of its own, and all trees step together.
    """
    n, runs = len(words), len(ends)
    width = words.shape[1] * 8
    begins = np.append(0, ends[:-1])
    if runs == 1:
        return np.arange(n), lcp.copy()
    text = words.astype(">u8").view(np.uint8).reshape(-1).view(f"S{width}")
    lanes = max(1, n // LANE)
    sample = np.sort(text[:: max(1, n // (8 * lanes))])
    cuts = sample[np.linspace(0, len(sample), lanes + 1).astype(np.int64)[1:-1]] if lanes > 1 else sample[:0]
    edges = np.stack([np.concatenate([[a], a + np.searchsorted(text[a:z], cuts), [z]]) for a, z in zip(begins, ends)])
    return _LoserTrees(words, lcp, edges[:, :-1].T.copy(), edges[:, 1:].T.copy()).order()


class _LoserTrees:
    """One tournament for each lane; ``at`` and ``to`` are the next row and the end of each run in each lane."""

    def __init__(self, words: np.ndarray, lcp: np.ndarray, at: np.ndarray, to: np.ndarray):
        self.words, self.lcp = words, lcp
        lanes, runs = at.shape
        self.leaves = 1 << max(1, int(runs - 1).bit_length())
        pad = ((0, 0), (0, self.leaves - runs))
        self.at, self.to = np.pad(at, pad), np.pad(to, pad)
        self.lanes = np.arange(lanes)
        self.sizes = (to - at).sum(axis=1)
        # All first rows share nothing with the empty text; a run that has ended (-1) loses to every other.
        known = np.where(self.at < self.to, 0, -1)
        run = np.broadcast_to(np.arange(self.leaves), known.shape)
        self.loser = np.zeros((lanes, self.leaves), np.int64)
        self.known = np.full((lanes, self.leaves), -1)
        where = np.repeat(self.lanes[:, None], self.leaves, axis=1)
        nodes = self.leaves
        while nodes > 1:
            nodes //= 2
            left, right = (run[:, 0::2], known[:, 0::2]), (run[:, 1::2], known[:, 1::2])
            lane = where[:, :nodes].reshape(-1)
            winner = self._match(lane, left[0].reshape(-1), left[1].reshape(-1), right[0].reshape(-1), right[1].reshape(-1))
            run, known, lost, lost_known = (x.reshape(-1, nodes) for x in winner)
            self.loser[:, nodes : 2 * nodes] = lost
            self.known[:, nodes : 2 * nodes] = lost_known
        self.winner, self.winner_known = run[:, 0].copy(), known[:, 0].copy()

    def _match(self, lane, a, a_known, b, b_known):
        """Winner and loser of matches, each with its LCP: the winner's with the last row put out, the loser's with the winner."""
        b_wins = b_known > a_known
        lost_known = np.minimum(a_known, b_known)
        tied = np.flatnonzero((a_known == b_known) & (a_known >= 0))
        if len(tied):
            x, y = self.at[lane[tied], a[tied]], self.at[lane[tied], b[tied]]
            word = np.minimum(a_known[tied] >> 3, self.words.shape[1] - 1)
            while len(tied):
                p, q = self.words[x, word], self.words[y, word]
                differs = p != q
                last = word == self.words.shape[1] - 1
                done = np.flatnonzero(differs | last)
                if len(done):
                    both, which = (p ^ q)[done], tied[done]
                    b_wins[which] = q[done] < p[done]
                    # The highest byte that differs; equal rows share all.
                    same = np.select([both >> np.uint64(s) > 0 for s in range(56, -1, -8)], range(8), 8)
                    lost_known[which] = word[done] * 8 + same
                go = np.flatnonzero(~(differs | last))
                tied, x, y, word = tied[go], x[go], y[go], word[go] + 1
        return (
            np.where(b_wins, b, a),
            np.where(b_wins, b_known, a_known),
            np.where(b_wins, a, b),
            lost_known,
        )

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        n = int(self.sizes.sum())
        out, shared = np.zeros(n, np.int64), np.zeros(n, np.int64)
        base = np.cumsum(self.sizes) - self.sizes
        live = np.flatnonzero(self.sizes > 0)
        for step in range(int(self.sizes.max(initial=0))):
            live = live[self.sizes[live] > step]
            run = self.winner[live]
            row = self.at[live, run]
            out[base[live] + step] = row
            shared[base[live] + step] = self.winner_known[live]
            self.at[live, run] += 1
            more = row + 1 < self.to[live, run]
            known = np.where(more, self.lcp[np.minimum(row + 1, len(self.lcp) - 1)], -1)
            node = (run + self.leaves) >> 1
            while True:
                run, known, lost, lost_known = self._match(live, run, known, self.loser[live, node], self.known[live, node])
                self.loser[live, node], self.known[live, node] = lost, lost_known
                if self.leaves == 2 or node[0] == 1:
                    break
                node = node >> 1
            self.winner[live], self.winner_known[live] = run, known
        # A lane's first row was compared with nothing; the row before it is another lane's last.
        first = base[(self.sizes > 0) & (base > 0)]
        if len(first):
            x, y = self.words[out[first]], self.words[out[first - 1]]
            flat = (x ^ y).astype(">u8").view(np.uint8).reshape(len(first), -1) != 0
            shared[first] = np.where(flat.any(axis=1), flat.argmax(axis=1), flat.shape[1])
        return out, shared


def merged(runs: list[Run]) -> tuple[Run, list[np.ndarray]]:
    """The distinct stretches of sorted runs with their smallest ids, and for each run where its entries are among them."""
    if len(runs) > FAN_IN:
        groups = [merged(runs[a : a + FAN_IN]) for a in range(0, len(runs), FAN_IN)]
        whole, places = merged([g[0] for g in groups])
        return whole, [place[own] for (_, inner), place in zip(groups, places) for own in inner]
    rows = np.concatenate([r.rows for r in runs])
    ends = np.cumsum([len(r.ids) for r in runs])
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order, lcp = merge(words, np.concatenate([r.lcp for r in runs]), ends)
    new = lcp < rows.shape[1]
    at = np.flatnonzero(new)
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    ids = np.minimum.reduceat(np.concatenate([r.ids for r in runs])[order], at)
    places = np.concatenate([r.at for r in runs])[order[at]]
    return Run(rows[order[at]], lcp[at], ids, places), np.split(entry, ends[:-1])


def answered(runs: list[Run], shape: Shape) -> list[np.ndarray]:
    """For each run and entry a bit for each string: whether a smaller id than the entry's has it."""
    whole, places = merged(runs)
    count = whole.rows[:, shape.width].astype(np.int64) - shape.length + 1
    # Stretches with the same anchor may share strings without being equal.
    gram = sliding_window_view(whole.rows[:, : shape.width], shape.gram, axis=1)[np.arange(len(count)), whole.at]
    _, anchor, times = np.unique(
        np.ascontiguousarray(gram).view(f"S{shape.gram}").reshape(-1), return_inverse=True, return_counts=True
    )
    several = np.flatnonzero(times[anchor] > 1)
    base = np.zeros(len(count), np.int64)
    base[several] = np.cumsum(count[several]) - count[several]
    entry = np.repeat(several, count[several])
    string = np.arange(len(entry)) - base[entry]
    suffix = np.ascontiguousarray(sliding_window_view(whole.rows[:, : shape.width], shape.length, axis=1)[entry, string])
    suffix = suffix.view(f"S{shape.length}").reshape(-1)
    order = np.argsort(suffix)
    smallest = np.empty(len(entry), np.int64)
    if len(order):
        new = np.append(True, suffix[order][1:] != suffix[order][:-1])
        at = np.flatnonzero(new)
        smallest[order] = np.repeat(np.minimum.reduceat(whole.ids[entry][order], at), np.diff(np.append(at, len(order))))
    mixed = np.zeros(len(count), bool)
    mixed[several] = True
    out = []
    for run, place in zip(runs, places):
        mark = np.where(whole.ids[place] < run.ids, (np.int64(1) << count[place]) - 1, 0)
        own = np.flatnonzero(mixed[place])
        if len(own):
            n = count[place[own]]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            less = smallest[np.repeat(base[place[own]], n) + within] < np.repeat(run.ids[own], n)
            mark[own] = np.add.reduceat(less.astype(np.int64) << within, np.cumsum(n) - n)
        out.append(mark.astype(np.uint32))
    return out


def deduplicated(docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (removed ones, in bytes) and ``kept`` of every row."""
    shape = Shape(length)
    limit_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = int(size // chunk_bytes) + 1
    shards = max(8, 4 * chunks)
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks))).repartition(chunks, "chunk")

    def send(table: pa.Table) -> pa.Table:
        anchors, several, _ = Chunk(table, shape).anchors()
        return _by_bucket(table.column("chunk")[0].as_py(), anchors, several, shards)

    def meet(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        keys = [np.frombuffer(k, np.uint32) for k in rows.column("keys").to_pylist()]
        several = [
            np.unpackbits(np.frombuffer(s, np.uint8), count=len(k)) for s, k in zip(rows.column("several").to_pylist(), keys)
        ]
        _, place, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = np.split((times[place] > 1) | (np.concatenate(several) > 0), np.cumsum([len(k) for k in keys])[:-1])
        return pa.table(
            {
                "chunk": rows.column("chunk"),
                "bucket": rows.column("bucket"),
                "marks": pa.array([np.packbits(m).tobytes() for m in shared], pa.binary()),
            }
        )

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        own = Chunk(table, shape)
        out = []
        for shard, run, _, _ in own.runs(_shared(own, replies, shards), shards):
            out.append({"shard": shard, "chunk": table.column("chunk")[0].as_py(), **run.front_coded(shape)})
        return pa.Table.from_pylist(out, _RUN_SCHEMA)

    def combine(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        runs = [Run.decoded(r, shape) for r in rows.select(["heads", "ids", "tail"]).to_pylist()]
        return pa.table(
            {
                "chunk": rows.column("chunk"),
                "shard": rows.column("shard"),
                "marks": pa.array([_packed(m) for m in answered(runs, shape)], pa.binary()),
            }
        )

    def cover(table: pa.Table, replies: pa.Table) -> pa.Table:
        own = Chunk(table, shape)
        known = replies.filter(pa.compute.equal(replies.column("step"), 1))
        answers = replies.filter(pa.compute.equal(replies.column("step"), 2))
        marks = dict(zip(answers.column("place").to_pylist(), answers.column("marks").to_pylist()))
        stretches, marked = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for shard, run, stretch, entry in own.runs(_shared(own, known, shards), shards):
            mark = _unpacked(marks[shard], np.uint32)[entry].astype(np.int64)
            later = own.ids[own.owner[stretch]] > run.ids[entry]
            mark[later] = (np.int64(1) << own.count[stretch[later]].astype(np.int64)) - 1
            hit = np.flatnonzero(mark)
            stretches.append(stretch[hit])
            marked.append(mark[hit])
        return own.cleaned(np.concatenate(stretches), np.concatenate(marked))

    sent = dealt.groupBy("chunk").applyInArrow(send, "bucket long, chunk long, keys binary, several binary")
    known = (
        sent.groupBy("bucket")
        .applyInArrow(meet, "chunk long, bucket long, marks binary")
        .select("chunk", F.lit(1).alias("step"), F.col("bucket").alias("place"), "marks")
    )
    runs = dealt.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        cut, "shard long, chunk long, heads binary, ids binary, tail binary"
    )
    answers = (
        runs.groupBy("shard")
        .applyInArrow(combine, "chunk long, shard long, marks binary")
        .select("chunk", F.lit(2).alias("step"), F.col("shard").alias("place"), "marks")
    )
    return dealt.groupBy("chunk").cogroup(known.unionByName(answers).groupBy("chunk")).applyInArrow(
        cover,
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, end: long>>, kept binary",
    )


_RUN_SCHEMA = pa.schema(
    [("shard", pa.int64()), ("chunk", pa.int64()), ("heads", pa.binary()), ("ids", pa.binary()), ("tail", pa.binary())]
)


def _by_bucket(chunk: int, anchors: np.ndarray, several: np.ndarray, buckets: int) -> pa.Table:
    """Anchors in order, a row for each bucket; buckets follow the upper half of an anchor, the lower half is sent."""
    bucket = (((anchors >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = [(b, edges[b], edges[b + 1]) for b in range(buckets) if edges[b + 1] > edges[b]]
    low = anchors.astype(np.uint32)
    return pa.table(
        {
            "bucket": pa.array([b for b, _, _ in rows], pa.int64()),
            "chunk": pa.array([chunk] * len(rows), pa.int64()),
            "keys": pa.array([low[a:z].tobytes() for _, a, z in rows], pa.binary()),
            "several": pa.array([np.packbits(several[a:z]).tobytes() for _, a, z in rows], pa.binary()),
        }
    )


def _shared(own: Chunk, replies: pa.Table, buckets: int) -> np.ndarray:
    """The stretches whose anchor another document may have, from what the buckets answered."""
    anchors, _, place = own.anchors()
    edges = np.searchsorted(
        (((anchors >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64), np.arange(buckets + 1)
    )
    shared = np.zeros(len(anchors), bool)
    for b, marks in zip(replies.column("place").to_pylist(), replies.column("marks").to_pylist()):
        a, z = edges[b], edges[b + 1]
        shared[a:z] = np.unpackbits(np.frombuffer(marks, np.uint8), count=z - a)
    return np.flatnonzero(shared[place])
