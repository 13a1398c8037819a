"""Verdicts of the quality rules against plain estimates, and outliers of each statistic alone."""

import math
from collections import defaultdict

import brute
import numpy as np
import pytest

from tidewell.llm import quality


def bins(values):
    """Halves away from zero, as SQL rounds."""
    scaled = np.arcsinh(np.asarray(values, dtype=float)) * quality.GRAIN
    return (np.sign(scaled) * np.floor(np.abs(scaled) + 0.5)).astype(int)


def quantile_bin(found, share):
    ordered = np.sort(found)
    return ordered[max(0, math.ceil(share * len(ordered)) - 1)]


def middle(values, share):
    return math.sinh(quantile_bin(bins(values), share) / quality.GRAIN)


def distances(x, mean, factor):
    z = np.linalg.solve(factor, (x - mean).T)
    return (z * z).sum(axis=0)


def estimate(x):
    floor = np.diag(np.square(quality.FLOOR))
    mean = np.array([middle(x[:, i], 0.5) for i in range(4)])
    spread = [(middle(x[:, i], 0.75) - middle(x[:, i], 0.25)) / 1.349 for i in range(4)]
    factor, log_det = np.linalg.cholesky(np.diag(np.square(spread)) + floor), math.inf
    while True:
        nearest = bins(distances(x, mean, factor))
        central = x[nearest <= quantile_bin(nearest, quality.SUPPORT)]
        cov = np.cov(central.T, ddof=0) * quality.CONSISTENCY + floor
        new_log_det = np.linalg.slogdet(cov)[1]
        if new_log_det < log_det:
            mean, factor = central.mean(axis=0), np.linalg.cholesky(cov)
        if not new_log_det < log_det - quality.LEAST_FALL:
            return mean, factor
        log_det = new_log_det


def plain_distances(rows):
    """``doc_id -> distance`` of ``(doc_id, lang, source, text)``, group by group."""
    stats = {i: brute.base_statistics(t) for i, _, _, t in rows}
    usable = {i for i, s in stats.items() if s[0] >= 20 and 100 * s[4] <= 30 * s[0]}
    sizes, rest = defaultdict(int), defaultdict(int)
    for i, lang, source, _ in rows:
        sizes[lang, source] += i in usable
    for (lang, _), n in sizes.items():
        rest[lang] += n if n < quality.MIN_ROWS else 0
    members = defaultdict(list)
    for i, lang, source, _ in rows:
        own = sizes[lang, source] >= quality.MIN_ROWS
        key = (lang, source) if own else (lang,) if rest[lang] >= quality.MIN_ROWS else ()
        members[key].append(i)
    out = {}
    for ids in members.values():
        s = np.array([stats[i] for i in ids], dtype=float)
        good = np.array([i in usable for i in ids])
        if not good.any():
            continue
        words = np.maximum(s[:, 0], 1)
        length = s[:, 1] / words
        x = np.column_stack([
            (length - middle(length[good], 0.5)) * np.sqrt(words / (words + quality.DAMPING)),
            np.log1p(100 * s[:, 2] / (s[:, 1] + quality.DAMPING)),
            np.log1p(100 * s[:, 3] / (words + quality.DAMPING)),
            np.arcsin(np.sqrt(np.minimum(s[:, 4] / words, 1))),
        ])
        out.update(zip(ids, distances(x, *estimate(x[good]))))
    return out


def test_distances_and_verdicts_equal_plain_estimates(spark, small):
    rows = brute.read(small, "documents", "doc_id, lang, source, text")
    want = plain_distances(rows)
    got = quality.judged(spark.read.parquet(f"{small}/documents.parquet")).collect()
    assert len(got) == len(rows)
    for r in got:
        distance = want.get(r["doc_id"])
        assert (r["distance"] is None) == (distance is None)
        if distance is not None:
            assert r["distance"] == pytest.approx(distance, rel=1e-6, abs=1e-6)
        assert r["kept"] == (not r["base_failed"] and (distance or 0) <= quality.CUTOFF)


def word(n, length=5):
    return "".join(chr(97 + n // 26**k % 26) for k in range(length))


def plain_text(i, n=101):
    return " ".join(word(i * 211 + k) for k in range(n))


def test_each_statistic_rejects_by_itself(spark):
    rows = [(i, plain_text(i)) for i in range(400)]
    planted = {
        1001: " ".join(word(k, 9) for k in range(101)),
        1002: " ".join(f"{word(k)}#" if k % 2 else word(k) for k in range(101)),
        1003: "\n".join(f"{' '.join(word(5000 + 4 * k + j) for j in range(4))}\nzzzzz" for k in range(20)),
        # 24 of 101 words lie in repeated windows: within the base rule.
        1004: plain_text(2, 77) + " " + " ".join([*(word(k + 7000) for k in range(12))] * 2),
    }
    rows += planted.items()
    docs = spark.createDataFrame([(i, "en", "web", t) for i, t in rows], "doc_id long, lang string, source string, text string")
    found = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    assert [found[i]["n_dup_lines"] for i in sorted(planted)] == [0, 0, 19, 0]
    assert [found[i]["n_repeat_words"] for i in sorted(planted)] == [0, 0, 0, 24]
    assert not any(found[i]["base_failed"] for i in planted)
    assert [i for i in sorted(found) if not found[i]["kept"]] == sorted(planted)
