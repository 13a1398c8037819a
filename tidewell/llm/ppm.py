"""Language-model scores by prediction by partial matching, and a unigram base score.

The model predicts each byte, and the end of a text, from the bytes before it. Contexts of one to ``LONGEST`` true bytes
are the nodes of a trie whose counts cover every document that may be learned from, and so grow with the corpus. From
the longest context that was seen the model goes down to shorter ones: a symbol that followed has its share of what
followed, and the others together as much as different symbols followed (method C). Symbols that a longer
context has ruled out are excluded from the counts of the shorter ones. Below the empty context the symbols never seen
share alike. So the probabilities of all symbols sum to one in every context.

Texts are shuffled once, into chunks. A chunk sends its distinct grams (context and symbol) with their counts in learnable
documents, in order, as differences in packed arrays: one row for each bucket of contexts by their nearest two bytes. A
bucket so has every longer context below these two bytes; it adds up the counts, derives the orders above by adding
up sorted neighbours, and answers each gram with its log-probability, which is all that scoring needs. Counts of one byte
and of none are at most 257 * 257 numbers, which are counted first and broadcast.

The base score counts words exactly in the same way: words travel as 64-bit hashes with counts and learn their totals.
What is exchanged follows the distinct grams and words of chunks. A context that all chunks have brings its bucket its
grams once a chunk; chunks and buckets follow the input, and nothing else is collected.

Edge cases: a NULL or empty text consists of its end. NULL ids are scored and not learned from. With nothing to
learn from every token is unknown and all symbols are alike. Repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import LOWER, Texts, limit_batches, mapped, mixed, slices
from tidewell.session import staged

LONGEST = 4
CHUNK_BYTES = 16 << 20
SYMBOLS = 257
END = 256  # also what stands before the first byte of a text
_END_WORD = np.uint64(0x5851F42D4C957F2D)
_GRAMS, _WORDS = 1, 2


def _packed(values: np.ndarray) -> bytes:
    """Compressed, bytes of equal weight together."""
    flat = np.ascontiguousarray(values)
    return zstandard.compress(np.ascontiguousarray(flat.view(np.uint8).reshape(len(flat), flat.itemsize).T).tobytes(), 1)


def _unpacked(data: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1)


def grams_of(texts: Texts, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """For all bytes and ends, in order, a code of the context, its nearest byte highest, and the symbol, nine bits each;
    where texts start."""
    symbols = np.insert(LOWER[texts.data].astype(np.int64), texts.offsets[1:], END)
    starts = texts.offsets + np.arange(len(texts) + 1)
    code = symbols.copy()
    for back in range(1, longest + 1):
        before = np.full(len(symbols), END, np.int64)
        before[back:] = symbols[:-back]
        for k in range(back):  # the first bytes of a text see no other text's
            own = starts[:-1] + k
            before[own[own < starts[1:]]] = END
        code |= before << 9 * (longest + 1 - back)
    return code, starts


def low_counts(docs: DataFrame) -> np.ndarray:
    """How often each symbol followed each byte: a table of fixed size."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        code, _ = grams_of(Texts.of(part.column("text")), 1)
        n = np.bincount((code >> 9) * SYMBOLS + (code & 511), minlength=SYMBOLS**2)
        some = np.flatnonzero(n)
        return pa.record_batch({"code": some, "n": n[some]})

    rows = mapped(docs.select("text"), "text", work, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS**2, np.int64)
    out[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(SYMBOLS, SYMBOLS)


class _Order:
    """Counts of one order: contexts in order, totals, distinct symbols, and the counts by context and symbol."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n = keys, n
        context = keys >> 9
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.first, self.contexts = first, context[first]
        self.total = np.add.reduceat(n, first) if len(first) else n
        self.distinct = np.diff(np.append(first, len(keys)))

    def count(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.n[at], 0)

    def place(self, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where contexts are, and whether they were seen."""
        if not len(self.contexts):
            return np.zeros(len(contexts), np.int64), np.zeros(len(contexts), bool)
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        return at, self.contexts[at] == contexts


def log_probabilities(asked: np.ndarray, grams: np.ndarray, n: np.ndarray, low: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """log10 of the probability of each asked gram, from counts of all grams of the same nearest two bytes (both sorted and
    distinct) and the counts ``low`` of one byte."""
    orders = {}
    for k in range(longest, 1, -1):
        keys = (grams >> 9 * (longest - k + 1)) << 9 | grams & 511
        order = np.argsort(keys, kind="stable")
        new = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])) if len(keys) else np.zeros(0, np.int64)
        orders[k] = _Order(keys[order][new], np.add.reduceat(n[order], new) if len(new) else n)
    zero = low.sum(axis=0)
    symbol, nearest = asked & 511, asked >> 9 * longest
    p, escape, done = np.ones(len(asked)), np.ones(len(asked)), np.zeros(len(asked), bool)
    ruled_out, excluded = np.zeros(len(asked)), np.zeros(len(asked), np.int64)  # counts here and number of excluded symbols

    def step(seen, total, distinct, count):
        nonlocal escape, done
        rest, new = total - ruled_out, distinct - excluded
        whole = rest + np.where(distinct < SYMBOLS, new, 0)
        hit = seen & ~done & (count > 0)
        p[hit] = (escape * count / np.where(whole > 0, whole, 1))[hit]
        down = seen & ~done & ~hit & (new > 0)
        escape = np.where(down, escape * new / np.where(whole > 0, whole, 1), escape)
        done = done | hit

    for k in range(longest, 1, -1):
        own = orders[k]
        at, seen = own.place(asked >> 9 * (longest - k + 1))
        if not len(own.contexts):
            continue
        step(seen, own.total[at], own.distinct[at], own.count((asked >> 9 * (longest - k + 1)) << 9 | symbol))
        # What the next order counts for the symbols that this one has seen.
        if k > 2:
            below = orders[k - 1].count(own.keys >> 18 << 9 | own.keys & 511)
        else:
            below = low[own.keys >> 18, own.keys & 511]
        shared = np.add.reduceat(below, own.first)
        ruled_out, excluded = np.where(seen, shared[at], 0), np.where(seen, own.distinct[at], 0)
    total, distinct = low.sum(axis=1), (low > 0).sum(axis=1)
    step(total[nearest] > 0, total[nearest], distinct[nearest], low[nearest, symbol])
    ruled_out, excluded = ((low > 0) @ zero)[nearest], distinct[nearest]
    step(np.full(len(asked), zero.sum() > 0), zero.sum(), (zero > 0).sum(), zero[symbol])
    never = SYMBOLS - (zero > 0).sum()
    return np.log10(np.where(done, p, escape / max(1, never)))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]], kind) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    keys = np.concatenate([np.zeros(0, kind), *(k for k, _ in parts)])
    n = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(n[order], new) if len(new) else n


class Chunk:
    """Distinct grams and words of some documents, with their counts in learnable ones."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by("row")
        grams, words, self.tokens = [], [], []
        for part in slices(self.table.to_batches(), "text"):
            texts, learn = Texts.of(part.column("text")), part.column("learn").to_numpy(False).astype(np.int64)
            code, starts = grams_of(texts)
            # A learnable gram is marked by a low bit, so that one sort counts both kinds.
            marked = np.sort(code << 1 | np.repeat(learn, np.diff(starts)))
            new = np.flatnonzero(np.append(True, marked[1:] != marked[:-1]))
            times = np.diff(np.append(new, len(marked)))
            grams.append((marked[new] >> 1, times * (marked[new] & 1)))
            found = texts.lowered().words()
            tokens = np.insert(found.hashes(), found.first[1:], _END_WORD)
            own, place = np.unique(tokens, return_inverse=True)
            sizes = found.counts + 1
            words.append((own, np.bincount(place, weights=np.repeat(learn, sizes), minlength=len(own)).astype(np.int64)))
            self.tokens.append((own, place.astype(np.int32), sizes))
        self.grams, self.gram_counts = _summed(grams, np.int64)
        self.words, self.word_counts = _summed(words, np.uint64)

    def gram_order(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams by bucket, in order in each; the edges of buckets."""
        bucket = (mixed((self.grams >> 9 * (LONGEST - 1)).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(buckets + 1))

    def word_edges(self, buckets: int) -> np.ndarray:
        bucket = ((self.words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        return np.searchsorted(bucket.astype(np.int64), np.arange(buckets + 1))

    def sent(self, number: int, buckets: int) -> pa.Table:
        order, edges = self.gram_order(buckets)
        rows = []
        grams, counts = self.grams[order], self.gram_counts[order]
        for kind, keys, n, at in (
            (_GRAMS, grams.astype(np.uint64), counts, edges),
            (_WORDS, self.words, self.word_counts, self.word_edges(buckets)),
        ):
            for b in range(buckets):
                a, z = at[b], at[b + 1]
                if z > a:
                    steps = _packed(np.diff(keys[a:z], prepend=np.uint64(0)))
                    rows.append({"kind": kind, "bucket": b, "chunk": number, "keys": steps, "counts": _packed(n[a:z].astype(np.uint32))})
        return pa.Table.from_pylist(rows, _SENT)

    def scored(self, replies: pa.Table, buckets: int) -> pa.Table:
        order, edges = self.gram_order(buckets)
        p, totals, first = np.zeros(len(self.grams)), np.zeros(len(self.words), np.int64), 0
        word_edges = self.word_edges(buckets)
        for r in replies.to_pylist():
            if r["kind"] == _GRAMS:
                p[order[edges[r["bucket"]] : edges[r["bucket"] + 1]]] = _unpacked(r["answer"], np.float32)
            else:
                totals[word_edges[r["bucket"]] : word_edges[r["bucket"] + 1]] = _unpacked(r["answer"], np.int64)
                first += r["first"]
        out = []
        for part, (own, place, sizes) in zip(slices(self.table.to_batches(), "text"), self.tokens):
            code, starts = grams_of(Texts.of(part.column("text")))
            codes, at = np.unique(code, return_inverse=True)
            score = np.add.reduceat(p[np.searchsorted(self.grams, codes)][at], starts[:-1])
            count = totals[np.searchsorted(self.words, own)][place]
            begin = np.cumsum(sizes) - sizes
            out.append(
                pa.table(
                    {
                        "doc_id": part.column("doc_id"),
                        "learn": part.column("learn"),
                        "n_tokens": pa.array(sizes.astype(np.int64)),
                        "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), begin)),
                        "shares": pa.array(np.add.reduceat(np.log10(count + 1.0), begin)),
                        "score": pa.array(score),
                        "new_words": pa.array(np.zeros(part.num_rows, np.int64)),
                    }
                )
            )
        whole = pa.concat_tables(out)
        # Words that this chunk is the first to have; their sum over chunks is the vocabulary.
        new = np.zeros(whole.num_rows, np.int64)
        new[0] = first
        return whole.set_column(6, "new_words", pa.array(new))


_SENT = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _answers(rows: pa.Table, low: np.ndarray) -> pa.Table:
    """For each row sent to a bucket log-probabilities of its grams, or totals of its words, and how many trained words
    no earlier chunk has."""
    rows = rows.sort_by("chunk")
    kind = rows.column("kind")[0].as_py()
    keys = [np.cumsum(_unpacked(k, np.uint64), dtype=np.uint64) for k in rows.column("keys").to_pylist()]
    sizes = np.cumsum([len(k) for k in keys])[:-1]
    keys = np.concatenate(keys)
    n = np.concatenate([_unpacked(c, np.uint32) for c in rows.column("counts").to_pylist()]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    at = np.flatnonzero(new)
    distinct, total = keys[order[at]], np.add.reduceat(n[order], at)
    entry = np.empty(len(keys), np.int64)
    entry[order] = np.cumsum(new) - 1
    if kind == _GRAMS:
        asked = distinct.astype(np.int64)
        trained = total > 0
        answer = log_probabilities(asked, asked[trained], total[trained], low).astype(np.float32)
        first = [0] * rows.num_rows
    else:
        answer = total
        begins = np.zeros(len(keys), np.int64)
        begins[order[at]] = total > 0
        first = [int(x.sum()) for x in np.split(begins, sizes)]
    return pa.table(
        {
            "of_chunk": rows.column("chunk"),
            "kind": rows.column("kind"),
            "bucket": rows.column("bucket"),
            "answer": pa.array([_packed(answer[e]) for e in np.split(entry, sizes)], pa.binary()),
            "first": pa.array(first, pa.int64()),
        }
    )


def score_documents(docs: DataFrame, learnable: Column, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    ``learnable`` (on the columns of ``docs``) says which rows the counts and the model come from.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    learn = F.coalesce(learnable, F.lit(False))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    chunks = int(size // chunk_bytes) + 1
    buckets = max(8, 2 * chunks)
    shared = spark.sparkContext.broadcast(low_counts(docs.where(learn)))  # half a megabyte, whatever the corpus
    rows = docs.select("doc_id", "text", learn.alias("learn"), F.monotonically_increasing_id().alias("row"))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(chunks))).repartition(chunks, "chunk")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def send(table: pa.Table) -> pa.Table:
        return Chunk(table).sent(table.column("chunk")[0].as_py(), buckets)

    def answer(rows: pa.Table) -> pa.Table:
        return _answers(rows, shared.value)

    def score(table: pa.Table, replies: pa.Table) -> pa.Table:
        return Chunk(table).scored(replies, buckets)

    sent = dealt.groupBy("chunk").applyInArrow(send, "kind int, bucket long, chunk long, keys binary, counts binary")
    answers = sent.groupBy("kind", "bucket").applyInArrow(
        answer, "of_chunk long, kind int, bucket long, answer binary, first long"
    )
    schema = f"doc_id {kind}, learn boolean, n_tokens long, n_known long, shares double, score double, new_words long"
    scored = staged(dealt.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(score, schema), "scored")
    trained = F.sum(F.when(F.col("learn"), F.col("n_tokens")).otherwise(0))
    n, distinct = scored.agg(F.coalesce(trained, F.lit(0)), F.coalesce(F.sum("new_words"), F.lit(0))).first()
    log_all = float(np.log10(n + distinct + 1))
    return scored.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("shares") - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        "score",
    )
