"""Plain versions of the operators, and a table of awkward documents."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = ("_id", "_row", "_mark", "_fp", "_root", "_least", "_taken", "_copies", "_of", "_digest", "_spans", "fp")
DOCS = "doc_id long, text string, lang string, source string, n_chars int, size int, copy string"

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def tokens(text):
    return TOKEN.findall(text or "")


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def awkward_rows():
    rng = np.random.default_rng(3)
    vocabulary = ["ba", "Cé", "do-", "FU!", "gi", "ho,", "ju", "ki x", "LO", "ñu", "x|", "42"]
    passage = " ".join(rng.choice(vocabulary, 70))
    texts = [
        None,
        "",
        " \t\n",
        "solo",
        "Two words",
        "\x00\x7f odd \x0b bytes \U0001f600 end",
        "x" * 500,
        "la la " * 300,
        "Intro. " + ITEM + " outro",
        "five six seven",
        "All rights reserved",
        "released under the Genral Public Licence and CC-BY, cc by",
        passage,
        passage,
        "Before " + passage + " after",
        passage[:150] + " cut " + passage[150:],
    ]
    for size in (30, 200, 3000):
        texts.append(" ".join(rng.choice(vocabulary, size)))
    near = texts[-1].split(" ")
    near[7] = "changed"
    texts.append(" ".join(near))
    rows = []
    for number, text in enumerate(texts):
        source = [None, "a", "b", "a", "é", ""][number % 6]
        rows.append((number, text, "en", source, None if text is None else len(text), 7, "c"))
    rows.append(rows[8])  # a row that repeats as a whole
    rows.append((3, "other text under a known id", None, "b", None, None, None))
    rows.append((None, "a row without an id", None, None, None, None, None))
    rows.append((None, "all rights reserved", "en", "a", 3, 1, "z"))
    return rows


def awkward(spark):
    """Awkward rows, with more columns whose names the operators use inside."""
    table = spark.createDataFrame(awkward_rows(), DOCS)
    return table.withColumns({name: F.lit(name) for name in CLASHING})


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def counted(rows, *columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


def fingerprint(text):
    found = tokens(lower(text))
    if not found:
        return 0
    size = min(3, len(found))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(found[i : i + size]).encode(), 42)
        for i in range(len(found) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(count, linked):
    """Smallest reachable index of each row; ``linked`` is a symmetric boolean matrix."""
    label = np.arange(count)
    if not count:
        return label
    linked = linked | np.eye(count, dtype=bool)
    while True:
        after = np.where(linked, label[None, :], count).min(1)
        if (after == label).all():
            return label
        label = after


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[i : i + 13])].add(item)
    found = []
    sizes = sorted({len(w) for w in windows})
    for doc_id, text in docs:
        w, hit, held = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    held |= windows[tuple(w[i : i + size])]
        held.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, held))).encode()).hexdigest()
        found.append((doc_id, len(w), len(hit), len(held), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(found)


def targets(sizes):
    """{source: target} of {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    fixed, wanted = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        rate = (wanted - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if rate * weight[s] > 2 * sizes[s]]
        if not over:
            return fixed | {s: rate * weight[s] for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def removed(texts, length=200):
    """For each text the byte flags under strings of ``length`` that start anywhere else too."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    flags = []
    for t in raw:
        own = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                own[i : i + length] = True
        flags.append(own)
    return raw, flags


def removal(docs):
    raw, flags = removed([t for _, t in docs])
    found = []
    for (doc_id, _), text, own in zip(docs, raw, flags):
        kept = bytes(b for b, f in zip(text, own) if not f)
        spans = int((np.diff(own.astype(int), prepend=0) == 1).sum())
        found.append((doc_id, len(text), int(own.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(found)


def repeated_words(rows, size=35):
    """(doc_id, n_words, n_removed, kept_sha256, n_spans) of each text, window by window."""
    found = [tokens(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in found for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, found):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - size + 1):
            gone[i : i + size] |= seen[tuple(w[i : i + size])] > 1
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((doc_id, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest(), spans))
    return Counter(out)


def ranking(docs, items, top=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    bags = [(doc_id, bag, sum(bag.values())) for doc_id, bag in bags if bag]
    total, length = len(bags), sum(n for *_, n in bags)
    df = Counter(term for _, bag, _ in bags for term in bag)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, bag, n in bags:
            m = 25 + 75 * n * total // length
            score = sum(
                times * weight[t] * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t, times in Counter(words(text)).items()
                if t in bag
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


def whitened(rows, components=4):
    """{vec_id: [(deviation, whitened per component)]} of usable vectors of one length, and shares."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(c)) for c in v] for _, v in kept], object)
    fits = np.array(sorted({tuple(r) for r in x.tolist()}), object)
    n, sums = len(fits), fits.sum(0)
    centred = (fits - sums / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = ((n * x - sums) ** 2).sum(1)
    white = (x - sums / n).astype(float) @ axes[:, :components] / np.sqrt(values[:components])
    return [i for i, _ in kept], n, deviation, white, values[:components] / values.sum()


def as_rows(spark, rows, schema):
    return spark.createDataFrame([Row(*r) for r in rows], schema)
