"""Registered queries of the subpackage, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    collocations,
    decontaminate,
    language,
    packing,
    ppm,
    quality,
    secrets,
    simhash,
    substring,
    suffixes,
    tokens,
    toxicity,
    variants,
)
from tidewell.session import use_utc
from tidewell.sources.files import read_parquet

#: A vocabulary with scores.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(use_utc(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def remainder(n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def held_out(n: int, which: int) -> Column:
    return F.coalesce(remainder(n) == which, F.lit(False))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.model_of(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        held_out(3, 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net, languages = language.train(language.sample(docs, remainder(5) != 0))
    return language.identify(docs, net, languages).select(
        "doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score"
    )


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.findings(docs, secrets.detector_of(docs))
    base = F.filter("spans", lambda s: s["kind"] != "model")
    return found.select(
        "doc_id",
        *(_count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


@query("op6_tokens")
def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.Vocabulary.from_file(TOKENIZER))


@query("op9_ppm")
def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ppm.score_documents(table(spark, sf_dir, "documents"), remainder(7) != 2)
    return scored.select("doc_id", held_out(7, 2).alias("held_out"), *scored.columns[1:])


@query("op8_substring")
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op11_variants")
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


SUFFIXES_SQL = """
    WITH texts AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
    ), strings AS (
        SELECT doc_id, p, substring(h, 2 * p + 1, 100) AS s
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM texts)
    ), smallest AS (
        SELECT s, min(doc_id) AS least FROM strings GROUP BY s
    ), marked AS (
        SELECT strings.doc_id, p, lag(p) OVER (PARTITION BY strings.doc_id ORDER BY p) AS before
        FROM strings JOIN smallest ON smallest.s = strings.s WHERE least < strings.doc_id
    ), spans AS (
        SELECT doc_id, min(p) AS b, max(p) + 50 AS e
        FROM (SELECT *, sum(CASE WHEN p - before <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked)
        GROUP BY doc_id, span
    ), gaps AS (
        SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS b, b AS e, spans.e - spans.b AS removed, 1 AS span FROM spans
        UNION ALL
        SELECT texts.doc_id, coalesce(max(e), 0), any_value(length(h) // 2), 0, 0
        FROM texts LEFT JOIN spans ON spans.doc_id = texts.doc_id GROUP BY texts.doc_id
    )
    SELECT gaps.doc_id, any_value(length(h) // 2) AS n_bytes, CAST(sum(removed) AS BIGINT) AS n_removed,
           CAST(sum(span) AS BIGINT) AS n_spans,
           sha256(unhex(string_agg(substring(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b))) AS kept_sha256
    FROM gaps JOIN texts ON texts.doc_id = gaps.doc_id GROUP BY gaps.doc_id
"""


@query("op12_suffixes", SUFFIXES_SQL)
def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


COLLOCATIONS_SQL = """
    WITH texts AS (
        SELECT coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    ), pieces AS (
        SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[ \t]+'), lambda x: x <> '') AS w
        FROM texts
    ), grams AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 5) AS lengths(k))
        GROUP BY ALL
    ), totals AS (
        SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang
    ), candidates AS (
        SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2 AND f >= 30
    ), cuts AS (
        SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS j FROM candidates
    ), scored AS (
        SELECT c.lang, c.phrase, c.a, min(row(CAST(2000000 * CAST(a AS HUGEINT) // (l.f + r.f) AS BIGINT), j, l.f, r.f)) AS best
        FROM cuts c
        JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:j], ' ')
        JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1:], ' ')
        GROUP BY ALL
    ), sizes AS (
        SELECT lang, w, k, a, unnest(range(2, k)) AS s FROM candidates
    ), inside AS (
        SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
        FROM (SELECT lang, w, a, s, unnest(range(1, k - s + 2)) AS i FROM sizes) GROUP BY ALL
    ), kept AS (
        SELECT s.lang, s.phrase, s.a, best[1] AS score, best[3] AS l, best[4] AS r
        FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
        WHERE coalesce(100 * CAST(longer AS HUGEINT) < 80 * CAST(s.a AS HUGEINT), true)
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
    )
    SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""


@query("op13_collocations", COLLOCATIONS_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
