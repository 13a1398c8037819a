"""The corpus queries over whole test tables against plain versions, held-out labels or invariants."""

import hashlib
from collections import defaultdict

import brute
import pytest

from tidewell.llm.queries import QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def docs(small):
    return brute.read(small, "documents", "doc_id, text")


def test_language(spark, small):
    langs = dict(brute.read(small, "documents", "doc_id, lang"))
    rows = QUERIES["op1_language"](spark, small).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (brute.remainder(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_toxicity(spark, testdata):
    labels = dict(brute.read(f"{testdata}/sf0.1", "labels", "doc_id, toxic"))
    rows = QUERIES["op3_toxicity"](spark, f"{testdata}/sf0.1").collect()
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [r for r in held if labels[r["doc_id"]] == 1]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)
    assert sum(r["predicted"] for r in held) - sum(r["predicted"] for r in toxic) <= 0.01 * len(held)


def test_simhash(spark, small, docs):
    prints = {i: brute.fingerprint(t) for i, t in docs}
    roots = brute.components(prints)
    rows = QUERIES["op4_simhash"](spark, small).collect()
    assert {tuple(r) for r in rows} == {(i, f"{prints[i]:016x}", roots[i]) for i in prints}


def test_quality(spark, small, docs):
    rows = {r[0]: r for r in QUERIES["op5_quality"](spark, small).collect()}
    assert len(rows) == len(docs)
    for i, text in docs:
        r, want = rows[i], brute.base_statistics(text)
        assert tuple(r[1:6]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["kept"] and r["base_failed"])
    good = [i for i, q in brute.read(small, "labels", "doc_id, quality") if q == 1 and not rows[i]["base_failed"]]
    assert all(rows[i]["kept"] for i in good)


def test_tokens_agree_with_a_public_unigram_tokenizer(spark, small, docs):
    import sentencepiece
    from tokenizers import Tokenizer, models

    model = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    public = Tokenizer(models.Unigram(pieces, 0, True))
    rows = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op6_tokens"](spark, small).collect()}
    for i, text in docs:
        assert rows[i] == (len(public.encode("▁" + text.replace(" ", "▁")).ids) if text else 0)


def test_secrets(spark, small, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op7_secrets"](spark, small).collect()}
    for i, text in docs:
        want, r = brute.base_secrets(text), rows[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        counts = [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts
        assert [s for s in r["spans"].split(",") if s and not s.startswith("model")] == want


def test_substring(spark, small, docs):
    rows = QUERIES["op8_substring"](spark, small).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == brute.kept_words(docs)


def test_ppm(spark, small, docs):
    want = brute.unigram(docs)
    rows = QUERIES["op9_ppm"](spark, small).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, known, total, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["held_out"] == (brute.remainder(r["doc_id"], 7) == 2)
        assert r["base_score"] == pytest.approx(score, rel=1e-9) and r["score"] < 0


def test_decontamination(spark, small, docs):
    runs = {}
    for item, text in brute.read(small, "benchmark", "item_id, text"):
        w = brute.words(text)
        runs[item] = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
    want = set()
    for i, text in docs:
        w = brute.words(text)
        own = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
        want |= {(i, item) for item, r in runs.items() if r and len(r & own) >= 0.9 * len(r)}
    rows = QUERIES["op10_decontaminate"](spark, small).collect()
    assert want and {(r["doc_id"], r["item_id"]) for r in rows} == want


def test_packing(spark, small, docs):
    rows = QUERIES["op2_packing"](spark, small).collect()
    words, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        words[r["doc_id"]] += r["n_words"]
        if r["bin_id"] is not None:
            bins[r["bin_id"]].append(r)
    assert words == {i: len(brute.words(t)) for i, t in docs}
    for pieces in bins.values():
        assert sum(r["n_words"] for r in pieces) <= 2048
        for name in ("source", "cluster"):
            values = [r[name] for r in pieces if r[name] is not None]
            assert len(values) == len(set(values))


def test_pipeline_is_its_stages(spark, small):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns
        sizes.append(docs.count())
    packed = {tuple(r) for r in pipeline.STAGES[-1][1](spark, docs, small).select("doc_id", "n_words").collect()}
    whole = {tuple(r) for r in pipeline.run(spark, small).select("doc_id", "n_words").collect()}
    assert packed == whole
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3] == sizes[4]


def test_pipeline_against_brute_force(spark, testdata):
    import corpus_pipeline as pipeline

    from tidewell.llm import toxicity
    from tidewell.llm.queries import remainder, table

    sf_dir = f"{testdata}/sf0.01"
    docs = brute.read(sf_dir, "documents", "doc_id, text")
    model = toxicity.model_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(3) != 1)
    want = {i: brute.toxic_score(model, t) for i, t in docs}
    for r in toxicity.score_documents(table(spark, sf_dir, "documents"), model).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-9)
    left = [(i, t) for i, t in docs if want[i] < 0.7]
    assert len(left) < len(docs)
    roots = brute.components({i: brute.fingerprint(t) for i, t in left})
    left = [(i, t) for i, t in left if roots[i] == i]
    items = {}
    for item, text in brute.read(sf_dir, "benchmark", "item_id, text"):
        w = brute.words(text)
        items[item] = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
    left = {i: brute.redacted(t) for i, t in left if not brute.held_items(t, items)}
    packed = defaultdict(list)
    for r in pipeline.run(spark, sf_dir).collect():
        packed[r["doc_id"]].append((r["first_word"], r["n_words"]))
    assert packed.keys() == left.keys()
    for i, pieces in packed.items():
        ends = [0, *(a + n for a, n in sorted(pieces))]
        assert [a for a, _ in sorted(pieces)] == ends[:-1] and ends[-1] == len(brute.words(left[i]))
    secrets = pipeline.STAGES[3][1](spark, table(spark, sf_dir, "documents"), sf_dir)
    texts = dict(docs)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.collect()} == {
        i: (brute.redacted(t), len(brute.redacted(t))) for i, t in texts.items()
    }
