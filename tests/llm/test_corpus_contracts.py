"""What the contracts of single operators ask for beyond results on the given tables."""

import re

import brute
import pytest
from pyspark.sql import functions as F
from test_corpus_edges import frame, labels

from tidewell.llm import decontaminate, language, ppm, secrets, simhash, toxicity
from tidewell.llm.queries import remainder


def test_held_out_languages_have_no_say(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    learnable = remainder(5) != 0
    blind = docs.withColumn("lang", F.when(learnable, F.col("lang")))
    loud = docs.withColumn("lang", F.when(learnable, F.col("lang")).otherwise("xx"))
    given = language.sample(docs, learnable, per_language=20)
    assert given == language.sample(blind, learnable, per_language=20) == language.sample(loud, learnable, per_language=20)


def test_language_sample_is_bounded_whatever_an_id_has(spark):
    texts = [f"word{i} of a text that no other row has, number {i}" for i in range(900)]
    docs = frame(spark, texts, [7] * 300 + list(range(100, 700))).withColumn("lang", F.lit("en"))
    assert len(language.sample(docs, F.lit(True), per_language=5, windows_per_text=2)) <= 15


def test_toxicity_sample_is_bounded_whatever_an_id_has(spark):
    texts = [f"text {i}" for i in range(90)] + ["x" * (toxicity.SAMPLE_BYTES + 1)]
    docs = frame(spark, texts, [1] * 60 + list(range(2, 33)))
    known = labels(spark, [(i, 1, i % 2, "x") for i in range(1, 33)])
    rows = toxicity.sample(docs, known, F.lit(True), per_class=9).collect()
    assert sum(r["label"] == 1 for r in rows) == 9 and 8 <= sum(r["label"] == 0 for r in rows) <= 9
    assert all(len(r["text"]) < 100 for r in rows)


@pytest.fixture(scope="module")
def detector(spark, testdata):
    return secrets.detector_of(spark.read.parquet(f"{testdata}/sf0.1/documents.parquet"))


def test_threshold_is_what_recall_asks_for(spark, testdata, detector):
    """No floor holds it up: nearly all runs that the patterns find would be found by the network alone."""
    assert 0 < detector.threshold < 1
    docs = spark.read.parquet(f"{testdata}/sf0.1/documents.parquet").where("text IS NOT NULL")
    hit = total = 0
    for row in docs.where(F.col("text").rlike("AKIA[A-Z0-9]{14}|[0-9a-f]{16}")).select("text").limit(200).collect():
        data, _ = secrets._separated(secrets.Texts.of(secrets.pa.array([row.text])))
        starts, ends = secrets.candidates(data)
        if len(starts):
            own = secrets._overlapping(starts, ends, secrets.base_spans(data))
            p = detector.probabilities(data, starts[own], ends[own]) if own.any() else []
            hit, total = hit + sum(x >= detector.threshold for x in p), total + len(p)
    assert total and hit >= 0.97 * total


def test_detectors_learn_from_every_document(spark):
    """More windows of each label than one part takes: all are taught or held back, in parts that are averaged."""
    texts = [f"see the file name-{i}-part here" for i in range(100, 3600)] + [f"the id is {i * 7919 + 2**60:x} here" for i in range(3500)]
    docs = frame(spark, texts).repartition(4)
    rows = secrets.labelled_windows(docs).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in rows} == {0: 3500, 1: 3500}
    detector = secrets.detector_of(docs, part_windows=1000)
    assert 0 < detector.threshold < 1
    for text, secret in (("see the file name-77777-part here", False), (f"the id is {2**60 + 1234567:x} here", True)):
        data, _ = secrets._separated(secrets.Texts.of(secrets.pa.array([text])))
        assert (detector.probabilities(data, *secrets.candidates(data)).max() >= detector.threshold) == secret


def test_formats_that_the_patterns_do_not_know(spark, detector):
    texts = ["use ghp_16C7e42F292c6912E7710c838347Ae178B4a here", "see the plain words of this sentence, nothing else"]
    spans = {r["doc_id"]: r["spans"] for r in secrets.findings(frame(spark, texts), detector).collect()}
    assert [s["kind"] for s in spans[0]] == ["model"] and spans[1] == []


def benchmark(spark, rows, kind="string"):
    return spark.createDataFrame(rows, f"item_id {kind}, text string")


ITEMS = [
    "The river runs past the old mill and under a bridge of stone. It ends in the lake of the north country.",
    "A lamp burns in the upper window of the tall house by night. Nobody has ever seen who lights it there.",
    "Seven sailors left the harbour in a small boat before dawn. Six of them came home again a year later.",
]


def test_every_id_of_an_item_is_reported_whatever_its_type(spark):
    docs = frame(spark, [f"before {ITEMS[0]} after", "nothing at all", ITEMS[1]])
    items = benchmark(spark, [("a", ITEMS[0]), ("b", ITEMS[0]), ("b", ITEMS[0]), (None, ITEMS[1]), ("c", ITEMS[2])])
    found = sorted((r["doc_id"], r["item_id"] or "") for r in decontaminate.leaks(docs, items).collect())
    assert found == [(0, "a"), (0, "b"), (2, "")]


def test_shards_of_a_benchmark_share_one_scan(spark, folder, monkeypatch):
    frame(spark, [f"x {ITEMS[k % 3]} y" for k in range(6)]).write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    items = benchmark(spark, list(enumerate(ITEMS)), "long")
    whole = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect())
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 150)
    assert len(decontaminate.indexes(items)) > 1
    cut = decontaminate.leaks(docs, items)
    assert whole == sorted((r["doc_id"], r["item_id"]) for r in cut.collect()) and len(whole) == 6
    plan = cut._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall("FileScan parquet", plan)) == 1
    assert decontaminate.without_leaks(docs, items).count() == 0


def test_representatives_of_rows_with_any_columns(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, 5, 6, {"a": 1}), (2, text, 5, 6, {"a": 2}), (3, "other words than those", 5, 6, None), (3, "other words than those", 5, 6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id long, kept_row long, more map<string,int>")
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_keys_of_fingerprints_are_not_broadcast(spark, folder):
    """Each comes 28 times, which Spark's estimate of their size leaves out."""
    prints = [0, 1, 3, 1 << 40, -1]
    spark.createDataFrame([(x,) for x in prints], "fingerprint long").write.parquet(folder + "/prints")
    links = simhash.links(spark.read.parquet(folder + "/prints"))
    found = {(r["a"], r["b"]) for r in links.collect()}
    assert found == {(a, b) for a in prints for b in prints if a < b and (a ^ b) in (1, 2, 3, 1 << 40, (1 << 40) + 1)}
    assert "Broadcast" not in links._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunk_bytes", [40_000, 16 << 20])
def test_scores_against_matching_symbol_by_symbol(spark, small, chunk_bytes):
    """Contexts of true bytes, escapes and exclusion as the plain version has them, for held-out documents as well."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = ppm.score_documents(docs, remainder(7) != 2, chunk_bytes=chunk_bytes).collect()
    want, _ = brute.ppm(brute.read(small, "documents", "doc_id, text"))
    assert all(abs(r["score"] - want[r["doc_id"]]) < 1e-6 * abs(want[r["doc_id"]]) + 1e-5 for r in got)
    assert len(got) == len(want)


def test_scores_with_nothing_to_learn_from(spark):
    docs = frame(spark, ["abc", "", None])
    rows = {r["doc_id"]: r for r in ppm.score_documents(docs, F.lit(False)).collect()}
    assert abs(rows[0]["score"] + 4 * 2.4099331) < 1e-5 and abs(rows[2]["score"] + 2.4099331) < 1e-5
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows.values())
