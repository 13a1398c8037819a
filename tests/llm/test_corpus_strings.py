"""Spelling variants, suffix deduplication and collocations against plain Python, and their edge cases."""

import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_corpus_edges import SCHEMA, TEXTS, frame

from tidewell.llm import collocations, suffixes, variants
from tidewell.llm.batches import Texts


def variants_of(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def kept_of(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in df.collect()}


def phrases_of(df):
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return {tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("range_words", [40, 20_000])
def test_variants_against_all_deletions(spark, small, range_words):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = variants_of(variants.variants(docs, range_words=range_words))
    assert got == brute.variants(brute.read(small, "documents", "doc_id, text"))


def test_chains_of_forms_lead_to_the_last(spark):
    times = {"abcdefg": 4000, "abcdefh": 700, "abcdeih": 100, "abcjeih": 15, "kbcjeih": 15}
    docs = frame(spark, [" ".join([w] * n) for w, n in times.items()])
    want = brute.variants([(i, " ".join([w] * n)) for i, (w, n) in enumerate(times.items())])
    assert variants_of(variants.variants(docs)) == want
    assert want["abcjeih"][1] == "abcdefg"


def test_hot_prefix_spreads_over_ranges(spark):
    """A prefix that all words share is cut into many ranges, and no pair across them is lost."""
    words = [f"prefix{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    docs = frame(spark, [" ".join(words)] * 6)
    want = brute.variants([(i, " ".join(words)) for i in range(6)])
    assert variants_of(variants.variants(docs, range_words=9)) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abü", min_size=1, max_size=9), min_size=1, max_size=40, unique=True))
def test_scan_finds_all_and_only_single_edits(words):
    words = sorted(words)
    keys = variants.Keys(words)
    query, entry = variants.SortedList(words).one_edit_from(keys, np.zeros(len(words), np.int64))
    got = sorted(zip(query.tolist(), entry.tolist()))

    def edits(w):
        return {w[:k] + w[k + 1 :] for k in range(len(w))}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return a in edits(b) or b in edits(a)

    assert got == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b)]


def test_crc_of_stretches():
    data = np.frombuffer("straße und Öl 12 ".encode() * 20, np.uint8)
    starts = np.arange(150)
    ends = starts + np.arange(150)
    before = np.array([zlib.crc32(b"7:")] * 150, np.uint32)
    got = variants.crc_of_stretches(data, starts, ends, before)
    assert got.tolist() == [zlib.crc32(b"7:" + data[a:b].tobytes()) for a, b in zip(starts, ends)]


@pytest.mark.parametrize("chunk_bytes", [30_000, 16 << 20])
def test_suffixes_against_a_dictionary(spark, small, chunk_bytes):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = kept_of(suffixes.deduplicated(docs, chunk_bytes=chunk_bytes))
    assert got == brute.without_repeats(brute.read(small, "documents", "doc_id, text"))


def test_suffixes_of_periodic_and_shifted_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "FAN_IN", 3)
    period = "abcdefg " * 40
    texts = ["a" * 500, "b" + "a" * 70, period, period[3:200] + "x" + period[:60], "\0" * 90, "\0" * 60 + "é" * 30, "a" * 49]
    texts += [f"{k} " + period[k : k + 90] for k in range(9)]
    docs = frame(spark, texts)
    want = brute.without_repeats(list(enumerate(texts)))
    assert kept_of(suffixes.deduplicated(docs, chunk_bytes=150)) == want
    spans = {r["doc_id"]: r["spans"] for r in suffixes.deduplicated(docs).collect()}
    assert all(sum(s["end"] - s["start"] for s in spans[i]) == w[1] for i, w in want.items())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.binary(min_size=0, max_size=12), max_size=30, unique=True), min_size=1, max_size=9))
def test_loser_trees_sort_and_keep_common_prefixes(runs):
    runs = [sorted(r) for r in runs if r]
    if not runs:
        return
    rows = np.array([np.frombuffer(x.ljust(15, b"\0") + bytes([len(x) + 1]), np.uint8) for r in runs for x in r])
    ends = np.cumsum([len(r) for r in runs])
    lcp = np.concatenate([suffixes._lcp(part) for part in np.split(rows, ends[:-1])])
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order, shared = suffixes.merge(words, lcp, ends)
    merged = [rows[k].tobytes() for k in order]
    assert merged == sorted(r.tobytes() for r in rows)
    assert shared[1:].tolist() == suffixes._lcp(rows[order])[1:].tolist()


def test_front_coding_round_trip():
    shape = suffixes.Shape(50)
    rng = np.random.default_rng(2)
    texts = sorted({bytes(rng.integers(0, 3, rng.integers(50, 76), dtype=np.uint8)) for _ in range(400)})
    rows = np.array([np.frombuffer(t.ljust(shape.width, b"\0") + bytes([len(t)]) + bytes(shape.row - shape.width - 1), np.uint8) for t in texts])
    rows = rows[np.argsort(rows.reshape(-1).view(f"S{shape.row}"), kind="stable")]
    run = suffixes.Run(rows, suffixes._lcp(rows), np.arange(len(rows)), np.zeros(len(rows), np.uint8))
    back = suffixes.Run.decoded(run.front_coded(shape), shape)
    assert (back.rows == rows).all() and (back.ids == run.ids).all()


@pytest.mark.parametrize("shard_bytes", [20_000, 16 << 20])
def test_collocations_against_counting(spark, small, shard_bytes):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = phrases_of(collocations.collocations(docs, least=4, first=500, shard_bytes=shard_bytes))
    assert got == brute.collocations(brute.read(small, "documents", "lang, text"), 4, 500)


def test_index_counts_every_phrase_and_both_directions_agree():
    rng = np.random.default_rng(4)
    sequence = np.concatenate([[0], rng.integers(0, 6, 400), [0]])
    counts = np.bincount(sequence, minlength=6)
    keys = rng.integers(1, 2**63, 6, dtype=np.uint64)
    index = collocations.Index(keys, counts, *collocations.Index.bits_of(sequence, 6))
    single, pairs = index.short()
    longer = index.long(pairs)
    for level in (single, pairs, *longer):
        size = level.words.shape[1]
        grams = [tuple(sequence[i : i + size]) for i in range(len(sequence) - size + 1)]
        for words, n in zip(level.words.tolist(), level.size.tolist()):
            assert n == grams.count(tuple(words))
        assert len(level) == len({g for g in grams if 0 not in g})
    # Extension to either side finds the same phrases.
    right = {tuple(w): n for w, n in zip(index.extended(single, False).words.tolist(), index.extended(single, False).size.tolist())}
    assert right == {tuple(w): n for w, n in zip(pairs.words.tolist(), pairs.size.tolist())}


def test_exact_scores_beyond_64_bits(spark):
    """The score of the query divides products that pass 64 bits."""
    row = spark.sql("SELECT (2000000BD * CAST(9000000000000000000 AS DECIMAL(19,0))) div (CAST(9000000000000000001 AS DECIMAL(19,0)) + 9L) AS score")
    assert row.first()["score"] == 2_000_000 * 9_000_000_000_000_000_000 // 9_000_000_000_000_000_010


def test_edge_rows(spark):
    ids = [None, *range(1, len(TEXTS))]
    docs = frame(spark, TEXTS * 2, ids * 2)
    got = variants_of(variants.variants(docs))
    assert got == brute.variants(list(zip(ids * 2, TEXTS * 2)))
    rows = suffixes.deduplicated(docs).collect()
    assert len(rows) == 2 * len(TEXTS)
    want = brute.without_repeats([(i, t) for i, t in zip(ids, TEXTS) if i is not None])
    assert all((r["n_bytes"], r["n_removed"]) == want[r["doc_id"]][:2] for r in rows if r["doc_id"] is not None)
    langs = [r["lang"] for r in docs.select("lang").collect()]
    assert phrases_of(collocations.collocations(docs, least=2)) == brute.collocations(list(zip(langs, TEXTS * 2)), 2, 2000)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for df in (variants.variants(empty), suffixes.deduplicated(empty), collocations.collocations(empty)):
        assert df.collect() == []


def test_words_of_a_slice_respect_text_ends():
    texts = Texts.of(pa.array(["Straßen", "bahnen ÀÉÎõü", None, "", "x"]))
    words, counts = variants.counted_words(texts, [1, 2, 3, 4, 5], altered=2**31)
    assert sorted(zip(words.to_pylist(), counts.tolist())) == [("bahnen", 1), ("straßen", 1)]
