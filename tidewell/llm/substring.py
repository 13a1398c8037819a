"""Substring deduplication: words in passages that a document with a smaller id has as well are removed.

A passage counts from ``WINDOW`` words on, and every window of that many words is looked for exactly, in an FM-index
for each shard. Shards do not hold documents but stretches that may repeat, dealt so that equal windows meet:

1. Each window has an anchor: of the runs of ``RUN`` words in it the one with the smallest hash. Equal windows have
   equal anchors, and neighbouring windows mostly share one. Documents are written once, in chunks of bounded size
   and bucketed by chunk, so no later step shuffles texts. Each chunk sends its distinct anchors with the smallest
   and largest id of their documents, packed in arrays, and learns which of them two documents share.
2. Stretches of windows with a shared anchor go, once for a chunk, to the anchor's shard. An anchor that more than
   ``HEAVY_CHUNKS`` chunks have is heavy: its windows go one by one by their own hash, so that a passage that
   a third of all documents hold does not meet in one shard.
3. A shard builds its index over all stretches it got, streams their windows through backward search, and finds for
   each the smallest id in its interval; those at or above the threshold length (all thirteen steps done with two
   occurrences left, or one that several documents of the chunk have) are reported to the chunks they came from.
4. Each chunk covers the words of the windows that a smaller id has, and joins what is left.

Words, runs and windows are told apart by 64-bit hashes. Chunks and shards are bounded; their number follows the
input, and nothing is collected.

Edge cases: a NULL or empty text has no words. A NULL id counts as larger than all, and rows with equal ids never
take words from each other. Repeated rows get equal results. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import Texts, fold, limit_batches, sequence_hashes, slices
from tidewell.llm.fmindex import FMIndex
from tidewell.session import new_workspace

WINDOW = 13
RUN = 6
CHUNK_BYTES = 8 << 20
HEAVY_CHUNKS = 64
_LAST = np.iinfo(np.int64).max


def _ids(column) -> np.ndarray:
    """Ids as integers; NULL counts as the largest."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.cast(pa.int64()).fill_null(_LAST))


class Chunk:
    """Words, windows and anchors of some documents."""

    def __init__(self, ids: np.ndarray, texts: list[Texts]):
        self.ids = ids
        joined, hashes, counts = [], [], []
        for t in texts:
            words = t.words()
            data, starts, ends = words.joined()
            joined.append((data, starts, ends))
            hashes.append(words.hashes())
            counts.append(words.counts)
        base = np.cumsum([0] + [len(j[0]) for j in joined])
        self.data = np.concatenate([j[0] for j in joined])
        self.starts = np.concatenate([j[1] + b for j, b in zip(joined, base)])
        self.ends = np.concatenate([j[2] + b for j, b in zip(joined, base)])
        self.counts = np.concatenate(counts)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        h = np.concatenate(hashes)
        n, self.h = len(h), h
        self.places = np.flatnonzero(self._room(n))  # where windows start
        if len(self.places):
            two = fold(h[:-1], h[1:])
            four = fold(two[:-2], two[2:])
            run = fold(four[: n - RUN + 1], two[4 : n - RUN + 5])
            eight = fold(four[:-4], four[4:])
            twelve = fold(eight[: n - 11], four[8 : n - 3])
            whole = fold(twelve[: n - 12], h[12:])
            low = run
            for step in (1, 2, 4):  # the smallest of eight neighbours
                low = np.minimum(low[:-step], low[step:])
            self.windows, self.anchors = whole[self.places], low[self.places]
        else:
            self.windows = self.anchors = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, table: pa.Table) -> Chunk:
        parts = [p for p in slices(table.to_batches(), "text")]
        if not parts:
            return cls(np.zeros(0, np.int64), [Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))])
        ids = np.concatenate([_ids(p.column("doc_id")) for p in parts])
        return cls(ids, [Texts.of(p.column("text")) for p in parts])

    def _room(self, n: int) -> np.ndarray:
        """True for words that begin a window."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(n)
        return left >= WINDOW

    @property
    def owners(self) -> np.ndarray:
        """For each window its document's number."""
        return np.searchsorted(self.first, self.places, "right") - 1

    def anchor_rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors in order, and the smallest and largest id that has each."""
        if not len(self.anchors):
            return self.anchors, np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.append(True, (self.anchors[1:] != self.anchors[:-1]) | (np.diff(self.owners) != 0))
        anchors, ids = self.anchors[new], self.ids[self.owners[new]]
        order = np.argsort(anchors, kind="stable")
        anchors, ids = anchors[order], ids[order]
        at = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        return anchors[at], np.minimum.reduceat(ids, at), np.maximum.reduceat(ids, at)

    def stretches(self, shared: np.ndarray, heavy: np.ndarray):
        """Distinct stretches of windows with a shared anchor: where their words start and end, the key that deals
        them, the smallest id that has each, and whether several have."""
        at = np.minimum(np.searchsorted(shared, self.anchors), max(0, len(shared) - 1))
        hit = np.flatnonzero(shared[at] == self.anchors) if len(shared) else np.zeros(0, np.int64)
        if not len(hit):
            empty = np.zeros(0, np.int64)
            return empty, empty, empty.view(np.uint64), empty, empty.astype(bool)
        alone = heavy[at[hit]]
        place, anchor = self.places[hit], self.anchors[hit]
        begins = np.append(True, (np.diff(place) != 1) | (anchor[1:] != anchor[:-1]) | alone[1:])
        begins[1:] |= self.owners[hit][1:] != self.owners[hit][:-1]
        opens = np.flatnonzero(begins)
        closes = np.append(opens[1:], len(hit)) - 1
        start, end = place[opens], place[closes] + WINDOW
        key = np.where(alone[opens], self.windows[hit][opens], anchor[opens])
        ids = self.ids[self.owners[hit][opens]]
        content = sequence_hashes(self.h, start, end)
        order = np.lexsort((ids, content))
        one = np.flatnonzero(np.append(True, content[order][1:] != content[order][:-1]))
        several = np.maximum.reduceat(ids[order], one) > ids[order][one]
        pick = order[one]
        return start[pick], end[pick], key[pick], ids[pick], several

    def removed(self, windows: np.ndarray, smallest: np.ndarray) -> np.ndarray:
        """True for words in windows of which a smaller id is known."""
        cover = np.zeros(len(self.h) + 1, np.int64)
        if len(windows) and len(self.windows):
            at = np.minimum(np.searchsorted(windows, self.windows), len(windows) - 1)
            gone = self.places[(windows[at] == self.windows) & (smallest[at] < self.ids[self.owners])]
            np.add.at(cover, gone, 1)
            np.add.at(cover, gone + WINDOW, -1)
        return np.cumsum(cover[:-1]) > 0

    def kept_texts(self, removed: np.ndarray) -> pa.Array:
        """The words that stay, joined by one space."""
        keep = ~removed
        owner = np.repeat(np.arange(len(self.ids)), self.counts)
        stay = np.flatnonzero(keep)
        final = np.zeros(len(keep), bool)  # the last word that stays in a document, which no space follows
        if len(stay):
            final[stay[np.append(owner[stay][1:] != owner[stay][:-1], True)]] = True
        sizes = self.ends - self.starts + 1
        mask = np.repeat(keep, sizes)
        mask[self.ends[final]] = False
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, weights=keep * sizes - final, minlength=len(self.ids)))])
        data = self.data[mask].tobytes()
        return pa.LargeStringArray.from_buffers(
            len(self.ids), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data)
        ).cast(pa.string())


def _chunked(docs: DataFrame) -> tuple[DataFrame, int]:
    """The documents written once, in a table bucketed by ``chunk_id``, and about how many chunks there are."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        for part in slices(batches, "text"):
            if held > CHUNK_BYTES:
                number, held = number + 1, 0
            held += part.nbytes
            chunk = pa.array(np.full(part.num_rows, number))
            yield pa.record_batch({"chunk_id": chunk, "doc_id": part.column(0), "text": part.column(1)})

    limit_batches(spark)
    given = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = int(size // CHUNK_BYTES) + 1
    name = f"chunks_{uuid.uuid4().hex}"
    (
        given.mapInArrow(run, f"chunk_id long, doc_id {kind}, text string")
        .write.bucketBy(min(chunks, 50_000), "chunk_id")
        .option("path", new_workspace(spark, "chunks"))
        .saveAsTable(name)
    )
    return spark.table(name), chunks


def _packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _unpacked(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _shared_anchors(table: DataFrame, buckets: int) -> DataFrame:
    """For each chunk the anchors that several documents have: ``of_chunk``, ``anchors``, ``heavy`` (packed)."""

    def send(chunk: pa.Table) -> pa.Table:
        anchors, low, high = Chunk.of(chunk).anchor_rows()
        bucket = (((anchors >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
        parts = list(zip(at, np.append(at[1:], len(anchors))))
        of = chunk.column("chunk_id")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array(bucket[at], pa.int64()),
                "of_chunk": pa.array([of] * len(parts), pa.int64()),
                "anchors": pa.array([_packed(anchors[a:b]) for a, b in parts], pa.binary()),
                "low": pa.array([_packed(low[a:b]) for a, b in parts], pa.binary()),
                "above": pa.array([_packed(high[a:b] - low[a:b]) for a, b in parts], pa.binary()),
            }
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        anchors, low = _unpacked(rows.column("anchors"), np.uint64), _unpacked(rows.column("low"), np.int64)
        high = low + _unpacked(rows.column("above"), np.int64)
        sizes = np.array([len(x) // 8 for x in rows.column("anchors").to_pylist()])
        order = np.argsort(anchors, kind="stable")
        at = np.flatnonzero(np.append(True, anchors[order][1:] != anchors[order][:-1]))
        times = np.diff(np.append(at, len(order)))
        several = np.maximum.reduceat(high[order], at) > np.minimum.reduceat(low[order], at)
        back = np.zeros(len(order), np.uint8)  # 1: shared, 2: heavy as well
        back[order] = np.repeat(several.astype(np.uint8) + (several & (times > HEAVY_CHUNKS)), times)
        ends = np.cumsum(sizes)
        out = []
        for of, a, b in zip(rows.column("of_chunk").to_pylist(), ends - sizes, ends):
            found = np.flatnonzero(back[a:b])
            if len(found):
                out.append((of, _packed(anchors[a:b][found]), _packed(back[a:b][found] - 1)))
        if out:
            of, own, heavy = zip(*out)
            yield pa.record_batch(
                {"of_chunk": pa.array(of, pa.int64()), "anchors": pa.array(own), "heavy": pa.array(heavy)}
            )

    sent = table.groupBy("chunk_id").applyInArrow(
        send, "bucket long, of_chunk long, anchors binary, low binary, above binary"
    )
    return sent.repartition(buckets, "bucket").mapInArrow(meet, "of_chunk long, anchors binary, heavy binary")


def _stretches(table: DataFrame, shared: DataFrame, shards: int) -> DataFrame:
    """Stretches that may repeat, one row for a chunk and shard: ``shard``, ``of_chunk``, and packed ``low`` (smallest
    ids), ``several`` and ``text`` (a line each)."""

    def cut(chunk: pa.Table, known: pa.Table) -> pa.Table:
        anchors, heavy = _unpacked(known.column("anchors"), np.uint64), _unpacked(known.column("heavy"), np.uint8)
        order = np.argsort(anchors)
        own = Chunk.of(chunk if len(anchors) else chunk.slice(0, 0))
        start, end, key, low, several = own.stretches(anchors[order], heavy[order] > 0)
        shard = (key % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        start, end, low, several, shard = start[order], end[order], low[order], several[order], shard[order]
        at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, int)
        raw = own.data.tobytes()
        opens, closes = own.starts[start].tolist(), own.ends[end - 1].tolist()
        parts = list(zip(at.tolist(), np.append(at[1:], len(shard)).tolist()))
        of = chunk.column("chunk_id")[0].as_py() if chunk.num_rows else 0
        lines = [b"".join(raw[opens[k] : closes[k]] + b"\n" for k in range(a, b)) for a, b in parts]
        return pa.table(
            {
                "shard": pa.array(shard[at], pa.int64()),
                "of_chunk": pa.array([of] * len(parts), pa.int64()),
                "low": pa.array([_packed(low[a:b]) for a, b in parts], pa.binary()),
                "several": pa.array([_packed(several[a:b]) for a, b in parts], pa.binary()),
                "text": pa.array(lines, pa.binary()),
            }
        )

    return (
        table.groupBy("chunk_id")
        .cogroup(shared.groupBy("of_chunk"))
        .applyInArrow(cut, "shard long, of_chunk long, low binary, several binary, text binary")
    )


def repeated_windows(texts: Texts, low: np.ndarray, several: np.ndarray):
    """Windows of stretches that occur again: the stretch each is of, its hash, and the smallest id that has it.

    ``low`` is the smallest id of each stretch, ``several`` whether more than one document of its chunk has it. All
    stretches are indexed, and every window of each is searched.
    """
    own = Chunk(low, list(texts.parts()))
    words, symbol = np.unique(own.h, return_inverse=True)
    # Symbol 0 ends every stretch, so no window reaches into the next one.
    sequence = np.insert(symbol + 1, own.first[1:], 0)
    # Equal windows have equal intervals and are searched once.
    _, once, slot = np.unique(own.windows, return_index=True, return_inverse=True)
    place = (own.places + own.owners)[once]
    index = FMIndex(sequence, len(words) + 1, WINDOW)
    left, right = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    for at in range(0, len(place), 1 << 16):
        part = place[at : at + (1 << 16)]
        patterns = sequence[part[:, None] + np.arange(WINDOW)[None, :]]
        left[at : at + len(part)], right[at : at + len(part)] = index.intervals(patterns, least=2)
    left, right = left[slot], right[slot]
    smallest = own.ids[own.owners].copy()
    found = right > left
    if found.any():
        # Intervals of equal length patterns are equal or apart.
        stretch = np.repeat(np.arange(len(low)), own.counts + 1)
        by_order = own.ids[stretch[index.order]]
        starts, slot = np.unique(left[found], return_inverse=True)
        edges = np.zeros(2 * len(starts), np.int64)
        edges[0::2] = starts
        edges[1::2][slot] = right[found]
        smallest[found] = np.minimum.reduceat(np.append(by_order, _LAST), edges)[0::2][slot]
    report = (smallest < own.ids[own.owners]) | several[own.owners]
    return own.owners[report], own.windows[report], smallest[report]


def _reports(stretches: DataFrame, shards: int) -> DataFrame:
    """``of_chunk``, ``windows`` and ``smallest`` (packed): what the shards found."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got)
        low, several = _unpacked(rows.column("low"), np.int64), _unpacked(rows.column("several"), bool)
        lines = _unpacked(rows.column("text"), np.uint8)
        sizes = [len(x) // 8 for x in rows.column("low").to_pylist()]
        owner = np.repeat(rows.column("of_chunk").to_numpy(), sizes)
        texts = Texts(lines, np.append(0, np.flatnonzero(lines == 10) + 1))
        stretch, windows, smallest = repeated_windows(texts, low, several)
        chunk = owner[stretch]
        order = np.lexsort((windows, chunk))
        chunk, windows, smallest = chunk[order], windows[order], smallest[order]
        new = np.append(True, (chunk[1:] != chunk[:-1]) | (windows[1:] != windows[:-1])) if len(chunk) else []
        chunk, windows, smallest = chunk[new], windows[new], smallest[new]
        at = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else []
        for a, b in zip(at, np.append(at[1:], len(chunk))):
            yield pa.record_batch(
                {
                    "of_chunk": pa.array([chunk[a]], pa.int64()),
                    "windows": pa.array([_packed(windows[a:b])], pa.binary()),
                    "smallest": pa.array([_packed(smallest[a:b])], pa.binary()),
                }
            )

    return stretches.repartition(shards, "shard").mapInArrow(search, "of_chunk long, windows binary, smallest binary")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``text`` (the words that stay, joined by one space) of every row."""
    table, chunks = _chunked(docs)
    shared = _shared_anchors(table, max(8, chunks))
    shards = max(8, 4 * chunks)
    reports = _reports(_stretches(table, shared, shards), shards)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cover(chunk: pa.Table, known: pa.Table) -> pa.Table:
        own = Chunk.of(chunk)
        windows, smallest = _unpacked(known.column("windows"), np.uint64), _unpacked(known.column("smallest"), np.int64)
        order = np.lexsort((smallest, windows))
        gone = own.removed(windows[order], smallest[order])
        return pa.table(
            {
                "doc_id": chunk.column("doc_id"),
                "n_words": pa.array(own.counts.astype(np.int64)),
                "n_removed": pa.array(np.add.reduceat(np.append(gone, False), own.first[:-1]) * (own.counts > 0)),
                "text": own.kept_texts(gone),
            }
        )

    return (
        table.groupBy("chunk_id")
        .cogroup(reports.groupBy("of_chunk"))
        .applyInArrow(cover, f"doc_id {kind}, n_words long, n_removed long, text string")
    )
