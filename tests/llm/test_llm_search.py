"""Whitening, repeated passages and lexical search against plain versions."""

import brute
import numpy as np
import pytest
from brute import Counter, counted
from pyspark.sql import functions as F

from orbitlake.llm import lexical, passages, whitening
from orbitlake.llm.queries import prepare
from orbitlake.llm.tables import read
from orbitlake.session import setting

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["awkward", "given", "empty"])
def docs(spark, request):
    prepare(spark)
    if request.param == "given":
        return read(spark, SF_DIR, "documents")
    table = brute.awkward(spark)
    return table.limit(0) if request.param == "empty" else table


def check_whitened(got, rows):
    ids, n, deviation, white, share = brute.whitened(rows)
    assert len(got) == len(ids) * white.shape[1]
    sign = {}
    for number in range(white.shape[1]):
        mine = {}
        for r in got:
            if r["component"] == number + 1:
                mine.setdefault(r["vec_id"], []).append(r["whitened"])
        at = [i for i, v in enumerate(ids) if v is not None]
        left = np.array([mine[ids[i]][0] for i in at])
        right = white[at, number]
        sign[number] = 1 if np.abs(left - right).max() < np.abs(left + right).max() else -1
        assert np.abs(left - sign[number] * right).max() < 1e-8
    want = Counter((i, k + 1, n, int(d)) for i, d in zip(ids, deviation) for k in range(white.shape[1]))
    assert counted(got, "vec_id", "component", "n", "deviation") == want
    for r in got:
        assert abs(r["explained"] / share[r["component"] - 1] - 1) < 1e-9
        assert r["identity_error"] < 1e-9


def test_whitening_given(spark):
    table = read(spark, SF_DIR, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check_whitened(whitening.whiten(table).collect(), rows)


def test_whitening_awkward(spark):
    rng = np.random.default_rng(4)
    scale = np.linspace(3, 0.2, 30)
    rows = [(i, (rng.standard_normal(30) * scale).tolist()) for i in range(200)]
    nan, inf = float("nan"), float("inf")
    rows += [(500, None), (501, [None] * 30), (502, [nan] * 30), (503, [inf] + [0.0] * 29)]
    rows += [(504, rows[0][1]), (0, rows[0][1]), (505, [-0.0] * 30), (None, rows[1][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    table = table.withColumns({"x": F.lit("x"), "dim": F.lit(1), "component": F.lit(None)})
    check_whitened(whitening.whiten(table.repartition(7)).collect(), rows)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id = 500")).count() == 0


def test_whitening_without_variance_and_by_length(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [4.0]), (4, [5.0]), (5, [])]
    found = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    pair = [r for r in found if r["vec_id"] in (1, 2)]
    assert len(pair) == 4 and all(r["whitened"] is None and r["n"] == 1 for r in pair)
    assert all(r["explained"] is None and r["deviation"] == 0 for r in pair)
    single = {r["vec_id"]: r["whitened"] for r in found if r["vec_id"] in (3, 4)}
    assert single == {3: -1.0, 4: 1.0} and len(found) == 6


def test_whitening_of_wide_numbers(spark):
    rows = [(i, [float(i) * 1e13, float(i * i), 1.0]) for i in range(9)] + [(20, [1e300, 0.0, 0.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r["deviation"] for r in found.collect()} == {None}
    small = whitening.deviations(np.array([[3, 4], [5, 6]]), 2, [8, 10])
    assert small == [8, 8]


def test_leading_pairs_of_a_close_spectrum():
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(rng.standard_normal((80, 80)))[0]
    values = np.linspace(1.0, 2.0, 80)[::-1]
    matrix = (basis * values) @ basis.T
    found, axes, residual = whitening.leading_pairs(lambda q: matrix @ q, 80, 4)
    assert np.abs(found - values[:4]).max() < 1e-12 and residual <= whitening.CERTIFIED
    assert np.abs(np.abs((axes * basis[:, :4]).sum(0)) - 1).max() < 1e-12


def test_passages(docs):
    got = passages.passage_report(docs).collect()
    want = brute.repeated_words(brute.pairs(docs))
    assert counted(got, "doc_id", "n_words", "n_removed", "kept_sha256", "n_spans") == want
    for r in got:
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_without_passages(docs):
    found = passages.without_passages(docs)
    assert found.columns == docs.columns and found.count() == docs.count()
    lost = {d: (n, r) for d, n, r, *_ in brute.repeated_words(brute.pairs(docs))}
    for r in found.where("doc_id not in (3, 8)").collect():
        words, gone = lost[r["doc_id"]]
        assert len(brute.tokens(r["text"])) == words - gone


def test_passages_of_long_texts(spark):
    """Texts that are worked on in pieces, with repeats across and far from the cuts."""
    rng = np.random.default_rng(6)
    vocabulary = np.array([f"w{i}" for i in range(50_000)])
    long = rng.choice(vocabulary, 700_000).tolist()
    shared = long[199_990:200_100]
    long[400_000:400_110] = shared
    blank = " " * 2_200_000
    rows = [(1, " ".join(long)), (2, "x " + " ".join(shared[3:60]) + " y"), (3, blank + "a b"), (4, "b" * 3_000_000)]
    rows += [(5, " ".join(long[-40:])), (6, "\n".join(long[300_000:300_034]))]
    got = passages.passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute.repeated_words(rows)
    assert counted(got, "doc_id", "n_words", "n_removed", "kept_sha256", "n_spans") == want
    assert {r["doc_id"]: r["n_removed"] for r in got}[1] == 260


def test_passages_with_full_bitmaps(spark, monkeypatch):
    monkeypatch.setattr(passages, "MOST_SLOTS", 64)
    docs = brute.awkward(spark)
    got = passages.passage_report(docs).collect()
    want = brute.repeated_words(brute.pairs(docs))
    assert counted(got, "doc_id", "n_words", "n_removed", "kept_sha256", "n_spans") == want


ITEMS = [
    (1, brute.ITEM),
    (2, None),
    (None, "All rights reserved"),
    (1, "ba BA lo ñu 42"),
    (4, "zzz"),
    (5, ""),
    (6, "la la odd text " * 40),
]


def search(docs, items, **more):
    return counted(lexical.lexical_search(docs, items, **more).collect(), "item_id", "rank", "doc_id", "score")


def test_search(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("row", F.lit("r"))
    assert search(docs, items) == brute.ranking(brute.pairs(docs), ITEMS)
    assert search(docs, items, top=2) == brute.ranking(brute.pairs(docs), ITEMS, 2)
    assert not search(docs, items.limit(0))


def test_search_in_small_shards_and_rounds(spark, monkeypatch):
    """Bounds must hold whatever the sizes of blocks, tasks and rounds are."""
    docs = read(spark, "/root/testdata/sf0.01", "documents").where("length(text) < 4000")
    items = read(spark, "/root/testdata/sf0.01", "benchmark")
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    for name, value in (("BLOCK", 4), ("SHARD", 90), ("CELLS", 2000), ("ITEMS", 15), ("SLOTS", 64)):
        monkeypatch.setattr(lexical, name, value)
    assert search(docs, items) == brute.ranking(brute.pairs(docs), rows)


def test_search_of_copies(spark):
    """More copies than places, all with one score: the smallest ids win."""
    rng = np.random.default_rng(7)
    vocabulary = np.array([f"t{i}" for i in range(400)])
    docs = [(i, " ".join(rng.choice(vocabulary, 30))) for i in range(3000)]
    docs += [(5000 + i, docs[7][1]) for i in range(12)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, docs[7][1])]
    got = search(table, spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute.ranking(docs, items)
    assert {d for _, _, d, _ in got} == {7, *range(5000, 5009)}


def test_shard_opens_heavy_lists_only():
    import pyarrow as pa

    table = pa.table(
        {
            "doc_id": [1, 2, 3],
            "n": [3, 2, 1],
            "terms": pa.array([[10, 20, 30], [20, 30], [30]], pa.list_(pa.int64())),
            "counts": pa.array([[1, 1, 1], [1, 1], [1]], pa.list_(pa.int64())),
        }
    )
    asked = lexical.Asked(
        np.array([0]), np.array([10, 20, 30]), np.zeros(3, int), np.arange(3), np.array([900, 300, 1]), np.array([1])
    )
    shard = lexical.Shard(table, asked, 3, 6)
    assert set(shard.openings(1)) == {0}
    assert set(shard.openings(None)) == {0, 1, 2}
    shard.least[:] = int(shard.most[0]) * 800
    assert 2 not in shard.openings(None)
    shard.search(1, None)
    assert shard.best[0][0][1] == 0


def test_passages_of_batches_without_any_span(spark):
    shared = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"text {i} of its own") for i in range(6)] + [(6, shared), (7, f"{shared} more"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "2"):
        got = {r.doc_id: (r.n_removed, r.n_spans) for r in passages.passage_report(docs).collect()}
    assert got == {**{i: (0, 0) for i in range(6)}, 6: (40, 1), 7: (40, 1), 8: (0, 0)}
