"""Operators with exact results against plain versions, on given and on awkward documents."""

from collections import defaultdict

import brute
import numpy as np
import pytest
from brute import Counter, counted

from orbitlake.llm import decontaminate, licenses, mixing, simhash, suffixes, vectors
from orbitlake.llm.queries import prepare
from orbitlake.llm.tables import components, read, running_total

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["awkward", "given", "empty"])
def docs(spark, request):
    prepare(spark)
    if request.param == "given":
        return read(spark, SF_DIR, "documents")
    table = brute.awkward(spark)
    return table.limit(0) if request.param == "empty" else table


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (200, 201)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_total(spark):
    rows = [("hot" if i % 3 else "cold", i, i * i) for i in range(500)]
    table = spark.createDataFrame(rows, "key string, at long, value long")
    for r in running_total(table, ["key"], ["at"], "value").collect():
        own = [v for k, a, v in rows if k == r["key"]]
        assert r["before"] == sum(v for k, a, v in rows if k == r["key"] and a < r["at"])
        assert r["total"] == sum(own)


def test_simhash(docs):
    rows = brute.pairs(docs)
    prints = np.array([brute.fingerprint(t) for _, t in rows], np.uint64)
    label = brute.groups(len(rows), np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    want = []
    for (doc_id, _), own, number in zip(rows, prints, label):
        ids = [rows[i][0] for i in np.flatnonzero(label == number) if rows[i][0] is not None]
        want.append((doc_id, f"{own:016x}", min(ids, default=None)))
    got = simhash.simhash_groups(docs).collect()
    assert counted(got, "doc_id", "fingerprint", "component_id") == Counter(want)


def test_simhash_links_of_close_prints(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = [base]
    for flips in (1, 2, 3, 4, 5):
        mask = np.zeros(len(base), np.uint64)
        for _ in range(flips):
            mask ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
        prints.append(base ^ mask)
    prints = np.unique(np.concatenate(prints))
    want = brute.groups(len(prints), np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    table = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    found = components(simhash.fingerprint_links(table)).collect()
    roots = {r["node"]: r["root"] for r in found}
    got = [roots.get(int(p), int(p)) for p in prints.view(np.int64)]
    for i in range(len(prints)):
        assert {j for j in range(len(prints)) if got[j] == got[i]} == set(np.flatnonzero(want == want[i]))


def test_simhash_chunks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 5)
    prints = [0] + [1 << i for i in range(40)]
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = components(simhash.fingerprint_links(table)).collect()
    assert {r["root"] for r in found} == {0} and len(found) == len(prints)


def test_keep_one(docs):
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    slim = docs.select("doc_id", "text")
    groups = simhash.near_duplicates(simhash.with_fingerprint(slim).select("doc_id", "fp")).collect()
    assert got.count() == len({r["root"] for r in groups})


@pytest.mark.parametrize("benchmark", ["own", "given", "empty"])
def test_contamination(spark, docs, benchmark):
    items = [(5, brute.ITEM), (50, "seven EIGHT nine"), (6, None), (7, "x"), (None, "solo"), (6, ""), (5, "la")]
    table = {
        "own": lambda: spark.createDataFrame(items, "item_id long, text string"),
        "given": lambda: read(spark, SF_DIR, "benchmark"),
        "empty": lambda: spark.createDataFrame([], "item_id long, text string"),
    }[benchmark]()
    items = [(r["item_id"], r["text"]) for r in table.collect()]
    got = decontaminate.contamination(docs, table)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.contamination(brute.pairs(docs), items)
    assert counted(got.collect(), *names) == want
    kept = decontaminate.drop_contaminated(docs, table)
    assert kept.columns == docs.columns
    assert kept.count() == sum(n for row, n in want.items() if not row[-1])


def test_contamination_without_an_id(spark):
    rows = [(None, "Intro. " + brute.ITEM + " outro"), (None, "a clean row"), (1, brute.ITEM), (1, "clean too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([(5, brute.ITEM)], "item_id long, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = counted(decontaminate.contamination(docs, table).collect(), *names)
    assert got == brute.contamination(rows, [(5, brute.ITEM)])
    kept = decontaminate.drop_contaminated(docs, table).collect()
    assert {r["text"] for r in kept} == {"a clean row", "clean too"}


def test_mixture(docs):
    rows = [(r["doc_id"], r["source"], len(brute.tokens(r["text"]))) for r in docs.collect()]
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + size
    targets = brute.targets(sizes)
    got = mixing.with_copies(docs).collect()
    assert counted(got, "doc_id", "source", "size") == Counter(rows)
    largest = max([r[2] for r in rows], default=0)
    for source in sizes:
        own = [r for r in got if r["source"] == source]
        assert {r["source_size"] for r in own} == {sizes[source]}
        assert all(abs(r["target"] - targets[source]) <= 1e-6 * (1 + targets[source]) for r in own)
        assert all(0 <= r["copies"] <= 2 for r in own)
        assert abs(sum(r["copies"] * r["size"] for r in own) - targets[source]) <= 2 * largest
    again = mixing.mixture(docs).collect()
    names = ("doc_id", "size", "taken")
    assert counted(again, *names) == counted(mixing.mixture(docs.repartition(3)).collect(), *names)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns[: len(docs.columns)] == docs.columns
    assert mixed.count() == sum(r["copies"] for r in got)


def test_removal(docs):
    got = suffixes.removal_report(docs).collect()
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert counted(got, *names) == brute.removal(brute.pairs(docs))


def test_removal_in_chunks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 3)
    monkeypatch.setattr(suffixes, "BATCH", 40)
    rng = np.random.default_rng(4)
    common = bytes(rng.integers(97, 123, 260, dtype=np.uint8)).decode()
    texts = []
    for number in range(60):
        ahead = bytes(rng.integers(97, 123, int(rng.integers(0, 300)), dtype=np.uint8)).decode()
        cut = slice(int(rng.integers(0, 60)), 260 - int(rng.integers(0, 60)))
        texts.append(ahead + common[cut] + ahead[::-1])
    texts += ["ab" * 200, "ab" * 150 + "c", "a" * 199, "a" * 200, "a" * 201]
    rows = list(enumerate(texts))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.removal_report(table).collect()
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert counted(got, *names) == brute.removal(rows)


def test_without_repeats(docs):
    got = suffixes.without_repeats(docs)
    assert got.columns == docs.columns
    raw, flags = brute.removed([t for _, t in brute.pairs(docs)])
    rows = docs.collect()
    want = Counter()
    for row, text, own in zip(rows, raw, flags):
        kept = bytes(b for b, f in zip(text, own) if not f).decode("utf-8", "ignore")
        kept = None if row["text"] is None else kept
        want[(row["doc_id"], kept, None if kept is None else len(kept))] += 1
    assert counted(got.collect(), "doc_id", "text", "n_chars") == want


def test_licenses(docs):
    got = licenses.license_report(docs).collect()
    want = Counter()
    for doc_id, text in brute.pairs(docs):
        w = brute.words(text)
        places = [
            (i, label)
            for phrase, label in licenses.BASE.items()
            for i in range(len(w))
            if w[i : i + len(phrase.split())] == phrase.split()
        ]
        at = [p[0] for p in places]
        base = ",".join(sorted({p[1] for p in places}))
        want[(doc_id, len(w), len(places), min(at, default=None), max(at, default=None), base)] += 1
    assert counted(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    for r in got:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("under the Genral Publik License, v3", "gpl"),
        ("Al rights reservd.", "reserved"),
        ("the Apache Licence", "apache"),
        ("Permission is hereby grantd, free of chrge", "mit"),
        ("some bsd licenses", "bsd"),
    ],
)
def test_license_edits(text, label):
    found = licenses.Finder().spans(licenses.word_text(text.encode()))
    assert label in {label for phrase, label, _ in licenses.NOTICES if phrase in {f[0] for f in found}}
    import regex

    for phrase, _, edits in licenses.NOTICES:
        whole = regex.search(f"(?b)(?<![^ ])(?:{phrase}){{e<={edits}}}(?![^ ])", licenses.word_text(text.encode()))
        assert bool(whole) == any(f[0] == phrase for f in found), phrase


def test_no_license_in_plain_text():
    text = licenses.word_text("The general public was there; nobody reserved any rights by cc.".encode())
    assert licenses.Finder().spans(text) == []


def vector_rows(rng):
    rows, base = [], rng.normal(size=(30, 16))
    for number in range(240):
        noise = rng.normal(size=16) * rng.choice([0, 0.02, 0.1, 0.2])
        vector = (base[rng.integers(0, 30)] + noise).astype(np.float32).tolist()
        rows.append((number, vector, int(rng.integers(0, 3))))
    odd = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] * 16, [1.0], [2.0]]
    rows += [(300 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(400, rows[0][1], None), (401, rows[0][1], rows[0][2]), (None, rows[0][1], rows[0][2])]
    return rows + [rows[5], (402, [3e38] * 16, 1), (403, [1e-38] * 16, 1)]


@pytest.mark.parametrize(("tile", "block"), [(1 << 20, 256), (64, 3)])
@pytest.mark.parametrize("dense", [0, 1])
def test_vectors(spark, monkeypatch, tile, block, dense):
    prepare(spark)
    monkeypatch.setattr(vectors, "DENSE", dense)
    monkeypatch.setattr(vectors, "TILE", tile)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = vector_rows(np.random.default_rng(2))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    linked = np.zeros((len(rows), len(rows)), bool)
    clean = []
    for _, v, label in rows:
        fine = label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
        clean.append(np.array(v, np.float64) if fine else None)
    for i, a in enumerate(clean):
        for j, b in enumerate(clean):
            if i != j and a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2]:
                linked[i, j] = a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.98
    label = brute.groups(len(rows), linked)
    want = Counter()
    for i, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(label == label[i]) if rows[j][0] is not None]
        least = min(ids, default=None)
        want[(vec_id, int(linked[i].sum()), least, vec_id is not None and vec_id == least)] += 1
    got = vectors.vector_groups(table).collect()
    assert counted(got, "vec_id", "n_links", "component_id", "kept") == want
    assert vectors.vector_groups(table.limit(0)).count() == 0


def test_vectors_given(spark):
    """The given table against all cosines of a label."""
    prepare(spark)
    table = read(spark, SF_DIR, "embeddings")
    by_label = defaultdict(list)
    for r in table.collect():
        by_label[r["label"]].append((r["vec_id"], np.array(r["embedding"], np.float64)))
    want = Counter()
    for label, rows in by_label.items():
        unit = np.array([v for _, v in rows])
        unit /= np.sqrt((unit**2).sum(1, keepdims=True))
        linked = unit @ unit.T >= 0.98
        np.fill_diagonal(linked, False)
        root = brute.groups(len(rows), linked)
        ids = np.array([i for i, _ in rows])
        for i, vec_id in enumerate(ids.tolist()):
            least = int(ids[root == root[i]].min())
            want[(vec_id, int(linked[i].sum()), least, vec_id == least)] += 1
    got = vectors.vector_groups(table).collect()
    assert counted(got, "vec_id", "n_links", "component_id", "kept") == want


def test_vectors_apart_are_not_sent(spark, monkeypatch):
    """Tiles of one cell, where bounds tell groups apart: pairs grow with tiles, not with their square."""
    prepare(spark)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 12))
    centres[:, 0] = 40
    rows = [
        (n, (centres[n % 40] * np.r_[1, np.full(11, 9)] + rng.normal(size=12) * 0.02).tolist(), 1)
        for n in range(1600)
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(vectors, "TILE", 12 * 20)
    sent, plain = [], vectors.tile_pairs

    def counting(tiles, threshold):
        sent.append((tiles.count(), plain(tiles, threshold).count()))
        return plain(tiles, threshold)

    monkeypatch.setattr(vectors, "tile_pairs", counting)
    got = vectors.vector_groups(table).collect()
    assert {r["n_links"] for r in got} == {39}
    n_tiles, n_pairs = sent[0]
    assert n_tiles >= 80 and n_pairs <= 8 * n_tiles
