"""Secrets: fixed patterns, and a character network that looks for more of the same.

The fixed patterns give the base findings. Every other candidate, a run of twelve or more characters that tokens
are made of with a digit, an inner capital or one of ``+/_=`` in it, goes with its surroundings to a small
convolutional network. The network learns from labelled findings: candidates that the patterns found against
those they did not, in all documents. Distinct windows are dealt out to parts of bounded size, which Spark trains side by
side; after each round the parameters are averaged. What looks like a secret of a format that the patterns
don't know (``MIXED`` or more characters with digits, capitals and small letters) is taught as neither. A fifth
of the windows, which the network doesn't see, calibrates its logits (two parameters, logistic) and sets the threshold: the
highest, to a bin of a logit, at which recall on that fifth is at least ``RECALL``. Both come from counts of bins. Candidates that reach it become spans of kind ``model``. Base
findings always stay.

Positions are code points, ends exclusive. Findings are read by numpy over bytes, one pass, no shuffle.

Edge cases: a NULL or empty text has no findings. Without both kinds of candidates, held back and not, only the patterns
work. Repeated rows are scanned alike; other columns are passed through or ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import byteconv
from tidewell.llm.batches import Texts, mapped
from tidewell.session import staged

KINDS = ("assign", "access", "hex", "model")
PART_WINDOWS = 20_000
ROUNDS, LEAST_STEPS, RATE = 3, 100, 0.02
BINS = 1_000
RECALL = 0.99
MIXED = 20
BEFORE, BODY, AFTER = 24, 48, 8
MIN_RUN, MIN_HEX = 12, 16


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_DIGITS, _LOWER, _UPPER = b"0123456789", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TOKEN = _class(_DIGITS + _LOWER + _UPPER + b"+/_.=-")
_HEX = _class(_DIGITS + b"abcdef")
_ODD = _class(_DIGITS + b"+/_=")
_CAPITAL, _SMALL, _DIGIT = _class(_UPPER), _class(_LOWER), _class(_DIGITS)
_QUOTE = frozenset(b"\"'")
# What an assignment looks like, read around its separator.
_KEYWORD = re.compile(rb"(?i:password|passwd|secret|token|api_?key)\Z")
_VALUE = re.compile(rb"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
_LONGEST_KEYWORD = 8


def _separated(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with a zero byte after each text, and where texts start in them."""
    return np.insert(texts.data, texts.offsets[1:], 0), texts.offsets[:-1] + np.arange(len(texts))


def _stretches(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of True of ``least`` length."""
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= least
    return starts[long], ends[long]


def _assignments(data: np.ndarray, raw: bytes) -> list[tuple[int, int]]:
    """Keyword, separator, value: each separator is read backwards for its keyword and forwards for its value."""
    found, over = [], 0
    for at in np.flatnonzero((data == 58) | (data == 61)).tolist():
        back = at
        while back > over and raw[back - 1] == 32:
            back -= 1
        if back > over and raw[back - 1] in _QUOTE:
            back -= 1
        word = _KEYWORD.search(raw, max(over, back - _LONGEST_KEYWORD), back)
        if word and (value := _VALUE.match(raw, at)):
            over = value.end()
            if over - value.start(1) >= MIN_RUN:
                found.append((word.start(), over))
    return found


def base_spans(data: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the fixed patterns in byte positions of separated texts."""
    raw = data.tobytes()
    spans = [(s, e, 0) for s, e in _assignments(data, raw)]
    spans += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(raw)]
    spans += [(int(s), int(e), 2) for s, e in zip(*_stretches(_HEX[data], MIN_HEX))]
    return sorted(spans, key=lambda x: (x[0], x[2]))


def candidates(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs that may be secrets."""
    starts, ends = _stretches(_TOKEN[data], MIN_RUN)
    if not len(starts):
        return starts, ends
    odd = _ODD[data]
    odd[1:] |= _CAPITAL[data[1:]] & ~_CAPITAL[data[:-1]] & _TOKEN[data[:-1]]
    count = np.concatenate([[0], np.cumsum(odd)])
    some = count[ends] > count[starts]
    return starts[some], ends[some]


def _mixed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether runs look like secrets by themselves: long, with digits, capitals and small letters."""
    out = ends - starts >= MIXED
    for kind in (_DIGIT, _CAPITAL, _SMALL):
        count = np.concatenate([[0], np.cumsum(kind[data])])
        out &= count[ends] > count[starts]
    return out


def _overlapping(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    if not spans:
        return np.zeros(len(starts), bool)
    s = np.array([x[0] for x in spans])
    reach = np.maximum.accumulate(np.array([x[1] for x in spans]))
    before = np.searchsorted(s, ends) - 1
    return (before >= 0) & (reach[np.maximum(before, 0)] > starts)


def windows_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of candidates, long ones in several, and the candidate each is of."""
    per = np.maximum(1, -(-(ends - starts) // BODY))
    owner = np.repeat(np.arange(len(starts)), per)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    begin = starts[owner] + step * BODY
    place = begin[:, None] + np.arange(-BEFORE, BODY + AFTER)[None, :]
    inside = (place >= 0) & (place < len(data))
    out = np.where(inside, data[np.clip(place, 0, max(0, len(data) - 1))], 0)
    # What lies beyond the text's border belongs to a neighbour.
    left = np.flip(np.maximum.accumulate(np.flip(out[:, :BEFORE] == 0, 1), axis=1), 1)
    right = np.maximum.accumulate(out[:, BEFORE:] == 0, axis=1)
    out[np.concatenate([left, right], axis=1)] = 0
    return out.astype(np.uint8), owner


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


@dataclass(frozen=True)
class Detector:
    """The network with its calibration; ``threshold`` above 1 means the patterns only."""

    net: byteconv.ByteConv | None
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 2.0

    def probabilities(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each candidate the largest calibrated probability of its windows."""
        windows, owner = windows_of(data, starts, ends)
        z = self.net.logits(windows)
        p = _logistic(self.slope * (z[:, 1] - z[:, 0]) + self.offset)
        out = np.zeros(len(starts))
        np.maximum.at(out, owner, p)
        return out

    def spans(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """All spans in byte positions of separated texts, by start, then kind."""
        found = base_spans(data)
        if self.net is not None:
            starts, ends = candidates(data)
            free = ~_overlapping(starts, ends, found)
            starts, ends = starts[free], ends[free]
            if len(starts):
                hit = self.probabilities(data, starts, ends) >= self.threshold
                found += [(int(s), int(e), 3) for s, e in zip(starts[hit], ends[hit])]
        return sorted(found, key=lambda x: (x[0], x[2]))


def calibrated(net: byteconv.ByteConv, bins: list[tuple[int, int, int]]) -> Detector:
    """``net`` with calibration and threshold from held-back windows: (label, bin of the logit, windows)."""
    label, number, count = (np.array(x) for x in zip(*bins))
    z, y, count = (number + 0.5) / BINS, label.astype(float), count.astype(float)
    slope, offset = 1.0, 0.0
    positive, total = (count * y).sum(), count.sum()
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (total - positive + 2))
    for _ in range(50):  # Newton's method for the two parameters
        p = _logistic(slope * z + offset)
        r, c = count * (p - target), count * np.maximum(p * (1 - p), 1e-6)
        gradient = np.array([(r * z).sum() + 1e-3 * slope, r.sum()])
        curve = np.array([[(c * z * z).sum() + 1e-3, (c * z).sum()], [(c * z).sum(), c.sum() + 1e-3]])
        slope, offset = np.array([slope, offset]) - np.clip(np.linalg.solve(curve, gradient), -0.5, 0.5)
    # The side of a bin that lets all of its windows reach the threshold.
    sides = np.minimum(slope * number / BINS, slope * (number + 1) / BINS)
    least = _logistic(sides + offset)[y > 0]
    order = np.argsort(least)
    passed = np.cumsum(count[y > 0][order])
    allowed = np.floor((1 - RECALL) * positive)
    return Detector(net, float(slope), float(offset), float(least[order][np.searchsorted(passed, allowed, "right")]))


def labelled_windows(docs: DataFrame) -> DataFrame:
    """``label`` (1: a finding) and ``seen`` (bytes) of the distinct windows of all documents that something is taught by."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch | None:
        data, _ = _separated(Texts.of(part.column("text")))
        starts, ends = candidates(data)
        if not len(starts):
            return None
        label = _overlapping(starts, ends, base_spans(data))
        sure = label | ~_mixed(data, starts, ends)
        starts, ends, label = starts[sure], ends[sure], label[sure]
        if not len(starts):
            return None
        windows, owner = windows_of(data, starts, ends)
        return pa.record_batch(
            {
                "label": pa.array(label[owner].astype(np.int32)),
                "seen": pa.array([w.tobytes() for w in windows], pa.binary()),
            }
        )

    return mapped(docs.select("text").where("text IS NOT NULL"), "text", work, "label int, seen binary").distinct()


def _windows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _pass_over(params: list[np.ndarray], k: int) -> Callable:
    """Round ``k`` over one part, as rows of a parameter's place and value."""

    def work(rows):
        windows, labels = _windows(rows["seen"]), rows["label"].to_numpy()
        order = sorted(range(len(labels)), key=lambda i: (windows[i].tobytes(), labels[i]))
        better = byteconv.improved(params, windows[order], labels[order], LEAST_STEPS, RATE / (k + 1), k)
        value = np.concatenate([p.ravel() for p in better])
        return pa.table({"place": pa.array(np.arange(len(value)), pa.int32()), "value": value})

    return work


def detector_of(docs: DataFrame, part_windows: int = PART_WINDOWS) -> Detector:
    """A detector learned from the candidates of all documents, and calibrated on every fifth that is held back.

    Windows are dealt out to parts by hash; in each round every part goes through all of its own from the same
    parameters, and the results are averaged position by position. A class that one part can hold is in all of them.
    """
    held = F.pmod(F.xxhash64(F.lit("held"), "seen"), F.lit(5)) == 0
    found = staged(labelled_windows(docs).withColumn("held", held), "windows")
    counts = {(r.label, r.held): r["count"] for r in found.groupBy("label", "held").count().collect()}
    if len(counts) < 4:
        return Detector(None)
    parts = max(-(-counts[label, False] // part_windows) for label in (0, 1))
    small = [label for label in (0, 1) if counts[label, False] <= part_windows]
    own = F.array(F.pmod(F.xxhash64("seen"), F.lit(parts)))
    everywhere = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
    dealt = found.where(~F.col("held")).select(
        "label", "seen", F.explode(F.when(F.col("label").isin(small), everywhere).otherwise(own)).alias("part")
    )
    params = byteconv.begun(np.random.default_rng(7), 2, (2, 3, 5), 8)
    edges = np.cumsum([p.size for p in params])[:-1]
    shapes = [p.shape for p in params]
    for k in range(ROUNDS):
        passed = dealt.groupBy("part").applyInArrow(_pass_over(params, k), "place int, value double")
        mean = passed.groupBy("place").agg(F.avg("value").alias("value")).collect()  # as many rows as parameters
        flat = np.array([r.value for r in sorted(mean, key=lambda r: r.place)])
        params = [p.reshape(shape) for p, shape in zip(np.split(flat, edges), shapes)]
    net = byteconv.of(params)

    def logit(part: pa.RecordBatch) -> pa.RecordBatch:
        z = net.logits(_windows(part.column("seen")))
        bins = np.floor(BINS * (z[:, 1] - z[:, 0])).astype(np.int64)
        return pa.record_batch({"label": part.column("label"), "bin": bins})

    logits = mapped(found.where("held").select("label", "seen"), "seen", logit, "label int, bin long")
    return calibrated(net, [(r.label, r.bin, r["count"]) for r in logits.groupBy("label", "bin").count().collect()])


def _code_points(data: np.ndarray) -> np.ndarray:
    """For each byte position the number of code points before it."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def findings(docs: DataFrame, detector: Detector) -> DataFrame:
    """``doc_id`` and ``spans`` (array of kind, start, end in code points, by start, then kind) of every row."""
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        data, begins = _separated(Texts.of(part.column(1)))
        points, rows = _code_points(data), [[] for _ in range(part.num_rows)]
        for s, e, kind in detector.spans(data):
            i = int(np.searchsorted(begins, s, "right")) - 1
            base = points[begins[i]]
            rows[i].append({"kind": KINDS[kind], "start": int(points[s] - base), "end": int(points[e] - base)})
        return pa.record_batch({"doc_id": part.column(0), "spans": pa.array(rows, shape)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, spans array<struct<kind string, start long, end long>>"
    return mapped(docs.select("doc_id", "text"), "text", work, schema)


def redacted(docs: DataFrame, detector: Detector, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns with ``mark`` in place of findings; overlapping ones are replaced together. ``n_chars``,
    where there is one, counts the new text's code points."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column("text")
        data, begins = _separated(Texts.of(texts))
        merged: list[list[int]] = []
        for s, e, _ in detector.spans(data):
            if merged and s < merged[-1][1]:
                merged[-1][1] = max(e, merged[-1][1])
            else:
                merged.append([s, e])
        if not merged:
            return part
        changed: dict[int, list[tuple[int, int]]] = {}
        for s, e in merged:
            changed.setdefault(int(np.searchsorted(begins, s, "right")) - 1, []).append((s, e))
        new = texts.to_pylist()
        for i, spans in changed.items():
            at, pieces = int(begins[i]), []
            for s, e in spans:
                pieces += [data[at:s].tobytes(), mark.encode()]
                at = e
            end = int(begins[i + 1]) - 1 if i + 1 < len(begins) else len(data) - 1
            new[i] = b"".join([*pieces, data[at:end].tobytes()]).decode("utf-8", "replace")
        columns = [pa.array(new, texts.type) if n == "text" else part.column(n) for n in part.schema.names]
        return pa.record_batch(columns, schema=part.schema)

    out = mapped(docs, "text", work, docs.schema)
    if "n_chars" not in docs.columns:
        return out
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
