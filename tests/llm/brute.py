"""Plain Python versions of what the operators compute."""

import functools
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKS = tuple(bytes([c]) for c in b".,;:!?\"'()[]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read(sf_dir, table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{table}.parquet'").fetchall()


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id reachable for each id, all pairs compared."""
    root = {i: i for i in prints}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def base_statistics(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {k for i, x in enumerate(windows) if times[x] > 1 for k in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


ASSIGN = re.compile(
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return [f"{kind}:{s}:{e}" for s, _, kind, e in sorted(found)]


def kept_words(docs):
    """For each (id, text): the number of words, of removed words, and the kept words' hash."""
    smallest = {}
    for i, text in docs:
        w = words(text)
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            smallest[key] = min(i, smallest.get(key, i))
    out = {}
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if smallest[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def toxic_score(model, text):
    """Noisy-or over sentences with a learned model's weights, word by word."""
    from tidewell.llm.batches import Texts, mixed

    @functools.cache
    def feature(data, n=0):
        h = Texts.of(pa.array([data])).hashes(np.array([0]), np.array([len(data)]))
        return int((mixed(h + np.uint64(n)) if n else h)[0])

    weights = dict(zip(model.keys.tolist(), model.weights.tolist()))
    sentences, data = [], (text or "").lower().encode()
    for line in data.split(b"\n"):
        new = True
        for w in re.findall(rb"[^\x20\x09-\x0D]+", line):
            if new:
                sentences.append(set())
            new = w[-1:] in (b".", b"!", b"?")
            for _ in range(4):
                if len(w) > 1 and w[-1:] in MARKS:
                    w = w[:-1]
            if len(w) > 1 and w[:1] in MARKS:
                w = w[1:]
            sentences[-1] |= {feature(w)} | {feature(w[:n], n) for n in (4, 5, 6) if len(w) > n}
    z = [model.bias + sum(weights.get(f, 0.0) for f in own) for own in sentences]
    return 1 - math.exp(-sum(math.log1p(math.exp(x)) for x in z))


def held_items(text, items):
    """Benchmark items nine tenths of whose runs of eight words a text has."""
    w = words(text)
    own = {tuple(w[k : k + 8]) for k in range(len(w) - 7)}
    return {item for item, runs in items.items() if runs and len(runs & own) >= 0.9 * len(runs)}


def redacted(text, mark="[SECRET]"):
    merged = []
    for s, e in sorted(tuple(map(int, span.split(":")[1:])) for span in base_secrets(text)):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    for s, e in reversed(merged):
        text = text[:s] + mark + text[e:]
    return text


def unigram(docs):
    """For each (id, text): tokens, known tokens, training tokens and base score."""
    tokens = {i: [*words((t or "").translate(LOWER)), None] for i, t in docs}
    counts = Counter(t for i, own in tokens.items() if remainder(i, 7) != 2 for t in own)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
        for i, w in tokens.items()
    }


def variants(docs, least_length=6, least_count=5):
    """word -> (form, root, n, near words, the form's n), each pair of words found through what both become by a deletion."""
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += len(w) >= least_length
    n = {w: c for w, c in counts.items() if c >= least_count}
    shorter, replaced, near = {}, {}, {w: set() for w in n}
    for w in n:
        for k in range(len(w)):
            shorter.setdefault(w[:k] + w[k + 1 :], set()).add(w)
            replaced.setdefault((w[:k], w[k + 1 :]), set()).add(w)
    for w in n:
        for v in shorter.get(w, ()):
            near[w].add(v)
            near[v].add(w)
    for group in replaced.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def without_repeats(docs, length=50):
    """id -> bytes, removed bytes, removed runs, kept bytes; ``docs`` has distinct ids."""
    smallest = {}
    data = sorted((i, (t or "").encode()) for i, t in docs)
    for i, b in data:
        for k in range(len(b) - length + 1):
            smallest.setdefault(b[k : k + length], i)
    out = {}
    for i, b in data:
        gone = bytearray(len(b) + 1)
        for k in range(len(b) - length + 1):
            if smallest[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def collocations(docs, least, first):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lang = lang or "und"
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            own.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = set()
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        rows = []
        for p, a in candidates.items():
            if longer[p] and 100 * longer[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:first], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def ppm(docs, longest=4):
    """log10 probability of each (id, text) by prediction by partial matching, symbol by symbol."""
    counts = {}

    def symbols(text):
        return [*(text or "").translate(LOWER).encode(), 256]

    def contexts(own, at):
        padded = [256] * longest + own[:at]
        return [tuple(padded[len(padded) - k :]) for k in range(longest, -1, -1)]

    for i, text in docs:
        if remainder(i, 7) != 2:
            own = symbols(text)
            for at, s in enumerate(own):
                for context in contexts(own, at):
                    counts.setdefault(context, Counter())[s] += 1

    def probability(s, chain):
        p, excluded = 1.0, set()
        for context in chain:
            seen = counts.get(context)
            if not seen:
                continue
            left = {t: n for t, n in seen.items() if t not in excluded}
            if not left:
                continue
            whole = sum(left.values()) + (len(left) if len(excluded | left.keys()) < 257 else 0)
            if s in left:
                return p * left[s] / whole
            p *= len(left) / whole
            excluded |= left.keys()
        return p / (257 - len(excluded))

    out = {}
    for i, text in docs:
        own = symbols(text)
        out[i] = sum(math.log10(probability(s, contexts(own, at))) for at, s in enumerate(own))
    return out, probability
