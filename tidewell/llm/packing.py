"""Best-fit packing with conflicts.

Pieces of documents go to bins of a fixed number of words. No bin may hold two documents of one source or of one
duplicate cluster. Documents longer than a bin are cut into full pieces, each a bin of its own, and a rest that is
packed. Pieces are placed longest first. Open bins are ordered by what is left in them; each carries a bitmap of
its sources and one of its clusters, and the search goes from the tightest residual that fits upwards until a bin
without a conflict is found; a new bin is opened if there is none.

Documents are dealt by a hash of their content to groups of bounded size, and groups pack on their own; what is lost
by that is at most the last open bins of each. Only ids and lengths are shuffled, and a task gets them in order, so
that one which is repeated after a lost executor packs the same bins.

Edge cases: NULL and empty texts have no words; they get a row without a bin (NULL). NULL sources and clusters
conflict with nothing. Repeated rows are placed one by one; with a cluster they conflict like any copies. Other
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import Texts, mapped

CAPACITY = 2048
GROUP_ROWS = 20_000
MOST_TASKS = 50_000  # beyond, a task packs several groups
SCHEMA = "bin_id long, doc_id {}, first_word long, n_words long, source string, cluster long"


class Bins:
    """Open bins in order of their residual; bins of one residual are kept apart by their source bitmap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = 0
        self.residuals: list[int] = []  # those that some open bin has, ascending
        self.open: dict[int, dict[int, list[tuple[int, int]]]] = {}  # residual -> sources -> (bin, clusters)

    def place(self, size: int, source: int, cluster: int) -> int:
        """The number of the bin that takes a piece; ``source`` and ``cluster`` are bitmaps with one bit or none."""
        for at in range(bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[at]
            for sources, bins in self.open[residual].items():
                if sources & source:
                    continue
                for k in range(len(bins) - 1, -1, -1):
                    number, clusters = bins[k]
                    if clusters & cluster:
                        continue
                    bins[k] = bins[-1]
                    bins.pop()
                    if not bins:
                        del self.open[residual][sources]
                        if not self.open[residual]:
                            del self.open[residual]
                            self.residuals.pop(at)
                    self._add(number, residual - size, sources | source, clusters | cluster)
                    return number
        number = self.count
        self.count += 1
        self._add(number, self.capacity - size, source, cluster)
        return number

    def _add(self, number: int, residual: int, sources: int, clusters: int) -> None:
        if not residual:
            return
        if residual not in self.open:
            self.open[residual] = {}
            insort(self.residuals, residual)
        self.open[residual].setdefault(sources, []).append((number, clusters))


def pack_group(rows: list[tuple], capacity: int) -> list[tuple]:
    """Bins of one group. ``rows``: (order, doc_id, n_words, source, cluster); pieces: as in ``SCHEMA``."""
    rows = sorted(rows, key=lambda r: r[0])
    sources: dict[str, int] = {}
    for r in rows:
        if r[3] is not None:
            sources.setdefault(r[3], 1 << len(sources))
    # Only clusters with several members here can conflict; the others need no bit.
    sizes = Counter(r[4] for r in rows if r[4] is not None)
    clusters: dict[int, int] = {}
    for cluster, n in sizes.items():
        if n > 1:
            clusters[cluster] = 1 << len(clusters)
    bins, out, rests = Bins(capacity), [], []
    for _, doc_id, words, source, cluster in rows:
        if not words:
            out.append((None, doc_id, 0, 0, source, cluster))
            continue
        full = words // capacity
        for k in range(full):
            out.append((bins.count, doc_id, k * capacity, capacity, source, cluster))
            bins.count += 1
        if words % capacity:
            rests.append((words % capacity, full * capacity, doc_id, source, cluster))
    rests.sort(key=lambda r: -r[0])
    for size, first, doc_id, source, cluster in rests:
        number = bins.place(size, sources.get(source, 0), clusters.get(cluster, 0))
        out.append((number, doc_id, first, size, source, cluster))
    return out


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``n_words`` and ``content`` (hash of the lower-cased words; NULL without any)."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Texts.of(part.column(2)).lowered().words()
        data, starts, _ = words.joined()
        edges = np.append(starts, len(data))[words.first]
        content = Texts(data, edges).hashes(edges[:-1], edges[1:]).view(np.int64)
        return pa.record_batch(
            {
                "doc_id": part.column(0),
                "source": part.column(1),
                "n_words": pa.array(words.counts, pa.int64()),
                "content": pa.array(content, mask=words.counts == 0),
            }
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    return mapped(given, "text", work, f"doc_id {kind}, source string, n_words long, content long")


def pack(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``bin_id``, ``doc_id``, ``first_word``, ``n_words``, ``source``, ``cluster`` of every piece of every row.

    Documents of equal text, up to case and what parts their words, are a cluster.
    """
    narrow = measured(docs).select(
        F.xxhash64("doc_id", "content", "source").alias("row_order"),
        "doc_id",
        "n_words",
        "source",
        F.col("content").alias("cluster"),
    )
    return pack_measured(narrow, max(1, -(-docs.count() // group_rows)), capacity, group_rows)


def pack_measured(narrow: DataFrame, groups: int, capacity: int, group_rows: int) -> DataFrame:
    """As :func:`pack`, from rows of row_order, doc_id, n_words, source and cluster."""
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition in groups of about ``group_rows``; its bins are numbered from a number of its own."""
        base, waiting = TaskContext.get().partitionId() << 40, []

        def packed() -> pa.RecordBatch:
            nonlocal base
            pieces = pack_group(waiting, capacity)
            used = 1 + max((p[0] for p in pieces if p[0] is not None), default=-1)
            number, doc_id, first, n, source, cluster = zip(*pieces)
            out = pa.record_batch(
                {
                    "bin_id": pa.array([None if b is None else b + base for b in number], pa.int64()),
                    "doc_id": pa.array(doc_id, id_type),
                    "first_word": pa.array(first, pa.int64()),
                    "n_words": pa.array(n, pa.int64()),
                    "source": pa.array(source, pa.string()),
                    "cluster": pa.array(cluster, pa.int64()),
                }
            )
            base += used
            return out

        for batch in batches:
            id_type = batch.schema.field(1).type
            waiting.extend(zip(*(c.to_pylist() for c in batch.columns)))
            if len(waiting) >= group_rows:
                yield packed()
                waiting = []
        if waiting:
            yield packed()

    dealt = narrow.repartition(min(groups, MOST_TASKS), F.col("row_order"))
    return dealt.sortWithinPartitions("row_order", "doc_id", "n_words").mapInArrow(run, SCHEMA.format(kind))
