"""NULLs, empty and long texts, ties, repeated rows, empty tables and columns whose names clash."""

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidewell.llm import decontaminate, fmindex, language, packing, ppm, quality, secrets, simhash, substring
from tidewell.llm import tokens, toxicity
from tidewell.llm.batches import Texts
from tidewell.llm.components import components
from tidewell.llm.queries import TOKENIZER

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, root string, key int, "
    "kept boolean, label string, row_hash int, named int, fingerprint string, spans string, words int, "
    "`a.b` int"
)
LONG = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
TEXTS = [None, "", " \n\t ", "one", "A b\x0bc", LONG, LONG, "one two three. you idiot moron!\n" * 40, "ünï 🤯 \x00 = token='aaaabbbbcccc1'"]


def frame(spark, texts=TEXTS, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    langs, sources = [None, "en", "de"], [None, "a", "b", "a"]
    rows = [
        (i, t, langs[k % 3], sources[k % 4], None, None, "r", 1, True, "l", 2, 3, "f", "s", 4, 5)
        for k, (i, t) in enumerate(zip(ids, texts))
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def cases(spark):
    """Edge texts, each row twice, one id NULL."""
    ids = [None, *range(1, len(TEXTS))]
    return frame(spark, TEXTS * 2, ids * 2)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def always(docs):
    """Every operator's rows on a table, by name."""
    spark = docs.sparkSession
    benchmark = spark.createDataFrame([(1, LONG[:400]), (2, None), (3, "")], "item_id long, text string")
    model = toxicity.model_of(docs, labels(spark, [(7, 1, 1, "x"), (5, 1, 0, "x"), (None, 1, 1, "x"), (6, 0, None, "x")]))
    detector = secrets.detector_of(docs)
    return {
        "language": language.identify(docs, *language.train(language.sample(docs, docs["doc_id"].isNotNull()))),
        "packing": packing.pack(docs, capacity=100_000),
        "toxicity": toxicity.score_documents(docs, model),
        "without_toxic": toxicity.without_toxic(docs, model),
        "simhash": simhash.classes(docs),
        "quality": quality.judged(docs),
        "tokens": tokens.count_tokens(docs, tokens.Vocabulary.from_file(TOKENIZER)),
        "secrets": secrets.findings(docs, detector),
        "redacted": secrets.redacted(docs, detector),
        "substring": substring.deduplicated(docs),
        "ppm": ppm.score_documents(docs, docs["doc_id"] > 2),
        "without_leaks": decontaminate.without_leaks(docs, benchmark),
    }


def test_empty_table(empty):
    for name, df in always(empty).items():
        assert df.collect() == [], name


def test_edge_rows(spark, cases):
    out = {name: df.collect() for name, df in always(cases).items()}
    for name in ("language", "packing", "toxicity", "simhash", "quality", "tokens", "secrets", "redacted", "substring", "ppm"):
        assert len(out[name]) == 2 * len(TEXTS), name
    by_id = lambda name: {r["doc_id"]: r for r in out[name]}
    assert {r["lang_pred"] for r in out["language"] if r["doc_id"] in (None, 1, 2)} == {"und"}
    assert all(by_id("toxicity")[i]["score"] == 0 for i in (None, 1, 2))
    prints = {i: brute.fingerprint(t) for i, t in enumerate(TEXTS)}
    found = by_id("simhash")
    assert all(found[i]["fingerprint"] & (2**64 - 1) == prints[i] for i in range(1, len(TEXTS)))
    assert {found[i]["component_id"] for i in (None, 1, 2)} == {1}
    assert found[6]["component_id"] == 5
    assert all(tuple(by_id("quality")[i])[1:6] == brute.base_statistics(TEXTS[i]) for i in range(1, len(TEXTS)))
    assert by_id("tokens")[1]["n_tokens"] == 0 and by_id("tokens")[3]["n_tokens"] > 0
    spans = [f"{s['kind']}:{s['start']}:{s['end']}" for s in by_id("secrets")[8]["spans"] if s["kind"] != "model"]
    assert spans == brute.base_secrets(TEXTS[8])
    assert "[SECRET]" in by_id("redacted")[8]["text"] and by_id("redacted")[None]["text"] is None
    assert by_id("redacted")[8]["n_chars"] == len(by_id("redacted")[8]["text"])
    want = brute.kept_words([(i, TEXTS[i]) for i in range(1, len(TEXTS))])
    for r in out["substring"]:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"]) == want[r["doc_id"]][:2]
    assert by_id("ppm")[1]["n_tokens"] == 1 and by_id("ppm")[1]["score"] < 0
    assert {r["doc_id"] for r in out["without_leaks"]} == {None, 1, 2, 3, 4, 7, 8}
    assert all(r["bin_id"] is None for r in out["packing"] if r["n_words"] == 0)


def test_one_representative_of_each_class(spark, cases):
    got = simhash.representatives(cases)
    assert got.columns == cases.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert sorted(ids) == [1, 3, 4, 5, 7, 8]
    nameless = frame(spark, [None, "", "a b"], [None, None, None])
    assert len(simhash.representatives(nameless).collect()) == 2


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(links).collect()} == {
        **{i: 0 for i in range(41)},
        100: 100,
        101: 100,
    }


def test_xxh64_of_all_lengths():
    data = np.random.default_rng(3).integers(0, 256, 400, dtype=np.uint8)
    starts = np.arange(200)
    ends = starts + np.arange(200)
    got = simhash.xxh64(data, starts, ends)
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(data[a:b].tobytes(), 42) for a, b in zip(starts, ends)]


def test_backward_search_against_scanning():
    rng = np.random.default_rng(5)
    sequence = np.append(rng.integers(1, 5, 500), 0)
    index = fmindex.FMIndex(sequence, 5, 6)
    patterns = rng.integers(1, 5, (200, 6))
    low, high = index.intervals(patterns)
    for p, a, b in zip(patterns, low, high):
        want = [i for i in range(495) if (sequence[i : i + 6] == p).all()]
        assert sorted(index.order[a:b]) == want


def test_ppm_probabilities_sum_to_one():
    texts = Texts.of(pa.array([b"abracadabra", b"abra cadabra", b"", b"123", bytes(range(256))]))
    grams, n = np.unique(ppm.grams_of(texts)[0], return_counts=True)
    low_codes = ppm.grams_of(texts, 1)[0]
    low = np.zeros((ppm.SYMBOLS, ppm.SYMBOLS), np.int64)
    np.add.at(low, (low_codes >> 9, low_codes & 511), 1)
    every = np.arange(ppm.SYMBOLS)
    for context in ("abra", "zzzz", "xxbr", "  ca"):
        code = 0
        for c in reversed(context.encode()):
            code = code << 9 | c
        nearest = code >> 9 * (ppm.LONGEST - 2)
        same = grams >> 9 * (ppm.LONGEST - 1) == nearest
        p = 10 ** ppm.log_probabilities(code << 9 | every, grams[same], n[same], low)
        assert abs(p.sum() - 1) < 1e-9, context


def test_heavy_anchors_give_the_same(spark, monkeypatch, small):
    docs = brute.read(small, "documents", "doc_id, text")
    monkeypatch.setattr(substring, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(substring, "HEAVY_CHUNKS", 1)
    ids = np.array([i for i, _ in docs])
    chunk = substring.Chunk(ids, [Texts.of(pa.array([t for _, t in docs]))])
    anchors, low, high = chunk.anchor_rows()
    shared = anchors[high > low]
    for heavy in (False, True):
        start, end, key, lowest, several = chunk.stretches(shared, np.full(len(shared), heavy))
        lines = "".join(bytes(chunk.data[chunk.starts[a] : chunk.ends[b - 1]]).decode() + "\n" for a, b in zip(start, end))
        data = np.frombuffer(lines.encode(), np.uint8)
        texts = Texts(data, np.append(0, np.flatnonzero(data == 10) + 1))
        _, windows, smallest = substring.repeated_windows(texts, lowest, several)
        order = np.lexsort((smallest, windows))
        gone = chunk.removed(windows[order], smallest[order])
        sums = np.add.reduceat(np.append(gone, False), chunk.first[:-1]) * (chunk.counts > 0)
        assert dict(zip(ids.tolist(), sums.tolist())) == {i: w[1] for i, w in brute.kept_words(docs).items()}


def test_offending_sentences(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.1/documents.parquet")
    known = spark.read.parquet(f"{testdata}/sf0.1/labels.parquet")
    model = toxicity.model_of(docs, known)
    given = frame(spark, ["All is well here. You are an idiot and a moron! The rest is fine."])
    rows = toxicity.offending_sentences(given, model).collect()
    assert [(r["sentence_no"], r["sentence"]) for r in rows] == [(1, "You are an idiot and a moron!")]


def test_best_fit_takes_the_tightest_bin_without_a_conflict():
    bins = packing.Bins(10)
    first, second, third = bins.place(7, 1, 0), bins.place(6, 2, 0), bins.place(5, 4, 0)
    assert (first, second, third) == (0, 1, 2)
    assert bins.place(3, 1, 0) == second  # bin 0 is tighter but has the source
    assert bins.place(3, 2, 0) == first
    assert bins.place(5, 8, 0) == third
    assert bins.place(1, 16, 0) == second


def test_packing_is_the_same_for_any_order_of_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bins = lambda df: sorted((r["doc_id"], r["first_word"], r["bin_id"]) for r in packing.pack(df, 512, 60).collect())
    assert bins(docs.repartition(7)) == bins(docs.orderBy("n_chars"))


def test_stage_and_scores_agree_on_toxicity(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.1/documents.parquet")
    model = toxicity.model_of(docs, spark.read.parquet(f"{testdata}/sf0.1/labels.parquet"))
    texts = ["İDİOT and MORON, you fool!", "ΟΔΟΣ", "You are an IDIOT and a moron!", None, ""]
    given = frame(spark, texts)
    low = {r["doc_id"] for r in toxicity.score_documents(given, model).collect() if r["score"] < toxicity.THRESHOLD}
    assert {r["doc_id"] for r in toxicity.without_toxic(given, model).collect()} == low


def test_copies_teach_the_language_once(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away " * 9
    docs = frame(spark, [text] * 500)
    rows = language.sample(docs.where("lang = 'en'"), docs["doc_id"].isNotNull())
    assert 1 <= len(rows) <= 4 and all(label == "en" and len(seen) == language.WINDOW for label, seen in rows)


def test_one_altered_word_hides_no_benchmark_item():
    sentence = "{} river {} stone {} cloud {} lamp {} glass.".format
    item = " ".join(sentence(*(f"{a}{k}" for a in "abcde")) for k in range(5)) + " So it is."
    index = decontaminate.Searcher(decontaminate.build([(3, item)]))
    words = item.split()
    for k, w in enumerate(words):
        for other in ("other", w + "&&&"):
            text = " ".join([*words[:k], other, *words[k + 1 :]])
            assert len(index.matches(Texts.of(pa.array([f"before {text} after"])))) == 1, (k, other)
    assert not index.matches(Texts.of(pa.array([" ".join(words[: len(words) // 2])])))


def hidden(items):
    """(item, place) of altered words that hide a copy."""
    index = decontaminate.Searcher(decontaminate.build(items))
    place = {item.item_id: k for k, item in enumerate(index.index.items)}
    out = []
    for item_id, text in items:
        words = text.split()
        copies = [" ".join(["before", *words[:k], "otherword", *words[k + 1 :], "after"]) for k in range(len(words))]
        found = {(m[0], m[1]) for m in index.matches(Texts.of(pa.array(copies)))} if item_id in place else set()
        out += [(item_id, k) for k in range(len(copies)) if item_id in place and (k, place[item_id]) not in found]
    return out


def test_one_altered_word_hides_no_item_of_the_benchmark(testdata):
    assert not hidden(brute.read(f"{testdata}/sf0.1", "benchmark", "item_id, text"))


def test_one_altered_word_hides_no_short_question_or_answer():
    sizes = [(q, a) for q in range(1, 16) for a in range(0, 12) if q + a >= decontaminate.MIN_WORDS]
    items = [
        (k, " ".join(f"q{k}x{i}" for i in range(q)) + "? " + " ".join(f"a{k}x{i}" for i in range(a)))
        for k, (q, a) in enumerate(sizes)
    ]
    same = ["same same same same same other words same same", "Yes yes yes yes? No no no no no no no no"]
    assert not hidden(items + list(enumerate(same, len(items))))


def test_items_of_common_words_are_found():
    shared = [f"c{i}" for i in range(12)]
    formulaic = [" ".join(shared[(k + i * (1 + k % 5)) % 12] for i in range(11)) for k in range(300)]
    asked = [f"what is the capital of land{k}?" for k in range(300)]
    mixed = [f"{' '.join(shared)} rare{k} odd{k}. {' '.join(shared[::-1])}" for k in range(300)]
    for texts in (formulaic, asked, mixed):
        items = list(enumerate(dict.fromkeys(texts)))
        index = decontaminate.Searcher(decontaminate.build(items))
        found = {(m[0], m[1]) for m in index.matches(Texts.of(pa.array([f"before {t} after" for _, t in items])))}
        assert {(k, k) for k, _ in items} <= found
        assert index.index.block_rest.max() < decontaminate.SHARE
        assert not hidden(items[:60])


def test_groups_of_passages_change_nothing(testdata, monkeypatch):
    items = brute.read(f"{testdata}/sf0.1", "benchmark", "item_id, text")
    index = decontaminate.Searcher(decontaminate.build(items))
    texts = Texts.of(pa.array([f"{LONG[:3000]} {t} {LONG[:2000]}" for _, t in items]))
    whole = index.matches(texts)
    monkeypatch.setattr(decontaminate, "POSTINGS", 3)
    assert len(whole) >= len(items) and index.matches(texts) == whole


def test_ppm_learns_true_bytes_in_long_contexts(spark):
    seen = ["когда весна придёт на реку и лёд уйдёт", "春が来れば川の氷が解けて流れる", "<b>if (x[i] != y{j}) &&</b>"]
    shuffled = ["".join(sorted(t)) for t in seen]
    docs = frame(spark, seen * 20 + seen + shuffled)
    score = {r["doc_id"]: r["score"] for r in ppm.score_documents(docs, docs["doc_id"] < 60).collect()}
    for k, text in enumerate(seen):
        assert score[60 + k] > -0.12 * len(text.encode())  # known text, in log10 a byte
        assert score[63 + k] < 4 * score[60 + k]


def test_short_items_and_items_without_an_id_are_found(spark):
    nameless = "which river runs past the old stone mill near the town?"
    items = [(1, "Prime minister?"), (2, "prime minister"), (3, "Zyx"), (4, "in the long run"), (None, nameless), (5, "")]
    texts = ["The PRIME minister, who", "prime", "minister zyx.", "in the long walk", f"so {nameless} yes", "a in the long run b", None]
    docs = frame(spark, texts)
    whole = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["first_word"]) for r in decontaminate.leaks(docs, whole).collect()}
    assert found == {(0, 1, 1), (0, 2, 1), (2, 3, 1), (4, None, 0), (5, 4, 1)}
    assert {r["doc_id"] for r in decontaminate.without_leaks(docs, whole.where("item_id = 3")).collect()} == {0, 1, 3, 4, 5, 6}
