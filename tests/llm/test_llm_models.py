"""Trained and iterative operators: held-out accuracy, plain versions, awkward documents."""

import math
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from brute import counted
from pyspark.sql import functions as F

from orbitlake.llm import kneser_ney, quality, toxicity, urls
from orbitlake.llm.queries import prepare
from orbitlake.llm.tables import read, smallest

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    prepare(spark)
    return read(spark, SF_DIR, "documents"), read(spark, SF_DIR, "labels")


def held_out_accuracy(rows, labels, column):
    marks = {r["doc_id"]: r[column] for r in labels.collect()}
    own = [r for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert len(own) > 30
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (brute.fold(r["doc_id"]) == 0)
    return np.mean([r["predicted"] == marks[r["doc_id"]] for r in own])


def class_rates(rows, labels, column):
    """(area under the curve, share of found ones, share of spared zeros) of the held-out fold."""
    marks = {r["doc_id"]: r[column] for r in labels.collect()}
    own = [(r["score"], r["predicted"], marks[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in marks]
    score, said, mark = map(np.array, zip(*own))
    one, zero = score[mark == 1], score[mark == 0]
    area = (one[:, None] > zero).mean() + 0.5 * (one[:, None] == zero).mean()
    return area, said[mark == 1].mean(), 1 - said[mark == 0].mean()


def test_quality_held_out(given):
    rows = quality.quality_scores(*given).collect()
    assert held_out_accuracy(rows, given[1], "quality") > 0.9
    area, found, spared = class_rates(rows, given[1], "quality")
    assert area > 0.98 and found > 0.9 and spared > 0.85
    kept = quality.keep_good(*given)
    assert kept.count() == sum(r["predicted"] for r in rows) and kept.columns == given[0].columns


def test_toxicity_held_out(spark):
    """On enough texts that neither class can be ignored."""
    prepare(spark)
    docs, labels = (read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert held_out_accuracy(rows, labels, "toxic") > 0.95
    area, found, spared = class_rates(rows, labels, "toxic")
    assert area > 0.95 and found > 0.8 and spared > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_quality_samples_do_not_depend_on_partitions(spark, given, monkeypatch):
    """Bounds that bite, ids that repeat with one text or several: one model and one result."""
    docs, labels = given
    monkeypatch.setattr(quality, "MAX_POSITIVES", 60)
    monkeypatch.setattr(quality, "MAX_UNLABELLED", 100)
    monkeypatch.setattr(quality, "STEPS", 60)
    other = docs.withColumn("text", F.concat("text", F.lit(" more")))
    twice = docs.select("doc_id", "text").union(docs.select("doc_id", "text")).union(other.select("doc_id", "text"))
    found = [
        counted(quality.quality_scores(twice.repartition(parts), labels).collect(), "doc_id", "score")
        for parts in (2, 7)
    ]
    assert found[0] == found[1]


def test_toxicity_samples_do_not_depend_on_partitions(spark, given, monkeypatch):
    docs, labels = given
    monkeypatch.setattr(toxicity, "MAX_PER_LABEL", 20)
    other = docs.withColumn("text", F.concat("text", F.lit(" more")))
    twice = docs.select("doc_id", "text").union(other.select("doc_id", "text"))
    chosen = toxicity.sample_ids(labels, 20).withColumn("apart", F.col("_id") % 2 == 0)
    assert chosen.count() == 20
    one, two = (toxicity._sample(twice.repartition(parts), chosen, 20) for parts in (2, 7))
    assert len(one[0]) == 20 and all((a == b).all() for a, b in zip(one[0], two[0])) and (one[1] == two[1]).all()


def test_smallest(spark):
    rows = spark.range(3000).withColumn("key", F.xxhash64("id"))
    want = smallest(rows, "key", 100).collect()
    assert len({r["key"] for r in want}) == 100
    assert sorted(want) == sorted(smallest(rows.repartition(13), "key", 100).collect())
    assert smallest(rows, "key", 5000).count() == 3000 and smallest(rows.limit(0), "key", 5).count() == 0


@pytest.mark.parametrize("scores", [quality.quality_scores, toxicity.toxicity_scores])
def test_classifiers_on_awkward_rows(spark, given, scores):
    docs, labels = brute.awkward(spark), given[1]
    marked = [(i, i % 2, (i + 1) % 2, None) for i in range(12)] + [(None, 1, 1, 3), (3, None, None, 3), (3, 1, 1, 3)]
    few = spark.createDataFrame(marked, "doc_id long, quality int, toxic int, score int")
    for used in (few, labels.limit(0)):
        got = scores(docs, used).collect()
        assert counted(got, "doc_id") == Counter((d,) for d, _ in brute.pairs(docs))
        assert all(0 <= r["score"] <= 1 for r in got)
        assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    assert scores(docs.limit(0), few).count() == 0


@pytest.mark.parametrize("share", [1, 20])
def test_toxicity_thresholds_at_all_texts(spark, monkeypatch, share):
    """The cut follows the labels' shares over all texts, not those of the bounded sample."""
    prepare(spark)
    monkeypatch.setattr(toxicity, "MAX_PER_LABEL", 60)
    monkeypatch.setattr(toxicity, "_sample", lambda docs, chosen, limit: (chosen.collect(), np.zeros(60, bool)))
    monkeypatch.setattr(toxicity, "train", lambda docs, marks: toxicity.new_model(np.zeros(0, int)))
    # Margins by a bin: clean ones in 0 to 9, toxic ones in 5 to 14, as many in each of them.
    ids = [i for i in range(10**6) if brute.fold(i) != 0][: 200 * (share + 1)]
    toxic = set(ids[:200])
    marks = spark.createDataFrame([(i, int(i in toxic)) for i in ids], "doc_id long, toxic int")
    model, known = toxicity.learn(marks, marks)
    assert known.count() == len(ids) and 60 < known.where("fitted").count() <= 120
    rows = [(i, 0, float(n % 10 + 5 * (n < 200))) for n, i in enumerate(ids)]
    toxicity.calibrate(
        model, toxicity.margin_cells(spark.createDataFrame(rows, "doc_id long, language int, margin double"), known)
    )
    cut = model.thresholds[0]
    errors = [sum((m >= c) != (i in toxic) for i, _, m in rows) for c in [cut, *np.arange(-0.5, 15)]]
    assert errors[0] <= min(errors) + 0.05 * len(toxic)
    assert share == 1 or cut > 9


def test_labels_of_other_texts(spark, monkeypatch):
    """The bounded sample is drawn from labels whose texts are there."""
    prepare(spark)
    monkeypatch.setattr(quality, "MAX_POSITIVES", 3)
    monkeypatch.setattr(toxicity, "MAX_PER_LABEL", 3)
    docs = spark.createDataFrame([(n, f"some words {n}") for n in range(40)], "doc_id long, text string")
    labels = spark.range(20_000).selectExpr("id AS doc_id", "1 AS quality", "cast(id % 2 AS int) AS toxic")
    assert quality.learn(quality.described(docs), labels) is not None
    assert toxicity.learn(docs, labels) is not None


def test_toxicity_gradient():
    """The training step follows the slope of the loss."""
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50, (n, toxicity.PIECES)).astype(np.uint16) for n in (4, 0, 9, 1, 30)] * 40
    marks = np.array([float(len(d) and (d[:, 0] < 5).any()) for d in docs])
    model = toxicity.train(docs, marks)
    slots, first = toxicity._joined(docs[:5])
    assert ((toxicity.margins(model, slots, first) > 0) == marks[:5]).all()


def cells(values):
    return np.bincount(np.searchsorted(quality.EDGES, values, "right") - 1, minlength=len(quality.EDGES))


def test_prior_and_cut():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(2, 1, 4000), rng.normal(-2, 1, 1200)
    seen, rest = cells(good[:1500]), cells(np.concatenate([good[1500:], bad]))
    prior = quality.estimate_prior(seen, rest)
    assert abs(prior - 2500 / 3700) < 0.06
    cut = quality.best_cut(seen, rest, prior)
    errors = [(good < c).mean() * prior + (bad >= c).mean() * (1 - prior) for c in [cut, *np.arange(-3, 3, 0.1)]]
    assert errors[0] <= min(errors) + 0.01


def test_quality_counts_all_texts(spark, given):
    """Cells hold every text outside the fold once, and the positives again."""
    texts = quality.described(given[0]).cache()
    rng = np.random.default_rng(2)
    size = quality.N_FEATURES
    models = [
        quality.Model(np.zeros(size), np.ones(size), [rng.normal(size=(size, 4)), np.zeros(4), rng.normal(size=4), np.zeros(1)], 0.5)
        for _ in range(2)
    ]
    seen = texts.where("not held_out").select(
        "row", F.pmod("key", F.lit(2)).alias("half"), (F.col("doc_id") % 3 == 0).alias("good")
    )
    want = np.zeros((2, 2, len(quality.EDGES)), int)
    for r in seen.collect():
        margin = models[r["half"]].margin(np.array([r["row"]], np.float32).astype(float))[0]
        cell = np.searchsorted(quality.EDGES, margin, "right") - 1
        want[r["half"], 1, cell] += 1
        want[r["half"], 0, cell] += r["good"]
    assert (quality.margin_counts(seen, models) == want).all()


@pytest.mark.parametrize("prior", [0.2, 0.9])
def test_quality_training_lowers_the_risk(prior):
    """The non-negative risk, computed plainly, falls while weights are trained."""
    rng = np.random.default_rng(3)
    p, u = rng.normal(1, 1, (quality.BATCH, 4)), rng.normal(0, 1, (quality.BATCH, 4))

    def risk(weights):
        def margin(x):
            return np.tanh(x @ weights[0] + weights[1]) @ weights[2] + weights[3][0]

        one = prior * np.logaddexp(0, -margin(p)).mean()
        other = np.logaddexp(0, margin(u)).mean() - prior * np.logaddexp(0, margin(p)).mean()
        return one + max(other, 0)

    before, after = (risk(quality._train(p, u, prior, steps)) for steps in (1, 200))
    assert after < before


def plain_model(texts):
    pairs, unigrams = Counter(), Counter()
    for text in texts:
        listed = [t for t in brute.tokens(brute.lower(text))] + [""]
        unigrams.update(listed)
        pairs.update(zip(["<s>", *listed], listed))

    def discounts(counts):
        n = [sum(c == i for c in counts) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        raw = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] and y else 0.5 for i in (1, 2, 3)]
        return [0, *(d if 0 < d < i else 0.5 for i, d in enumerate(raw, 1))]

    behind, after, total = Counter(), defaultdict(list), Counter()
    for (v, w), c in pairs.items():
        behind[w] += 1
        after[v].append(c)
        total[v] += c
    d1, d2 = discounts(behind.values()), discounts(pairs.values())
    left = sum(d1[min(c, 3)] for c in behind.values())
    size = len(unigrams)

    def chance(v, w):
        if not pairs:
            return 1.0
        low = (max(behind[w] - d1[min(behind[w], 3)], 0) + left / (size + 1)) / len(pairs)
        if not total[v]:
            return low
        held = sum(d2[min(c, 3)] for c in after[v])
        c = pairs[v, w]
        return (max(c - d2[min(c, 3)], 0) + held * low) / total[v]

    return unigrams, chance


@pytest.mark.parametrize("table", ["awkward", "given", "empty"])
def test_kneser_ney(spark, given, monkeypatch, table):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 20_000)
    monkeypatch.setattr(kneser_ney, "GATHER", 30_000)
    monkeypatch.setattr(kneser_ney, "BLOCK", 1 << 12)
    docs = {"awkward": brute.awkward(spark), "given": given[0], "empty": given[0].limit(0)}[table]
    rows = brute.pairs(docs)
    unigrams, chance = plain_model([t for d, t in rows if brute.fold(d) != 1])
    total = sum(unigrams.values())
    want = defaultdict(list)
    for doc_id, text in rows:
        listed = brute.tokens(brute.lower(text)) + [""]
        base = sum(math.log10((unigrams[w] + 0.5) / (total + 0.5 * (len(unigrams) + 1))) for w in listed)
        score = sum(math.log10(chance(v, w)) for v, w in zip(["<s>", *listed], listed))
        known = sum(w in unigrams for w in listed)
        want[doc_id].append((len(listed), known, total, brute.fold(doc_id) == 1, base, score))
    got = defaultdict(list)
    for r in kneser_ney.lm_scores(docs).collect():
        got[r["doc_id"]].append(
            (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"], r["base_score"], r["score"])
        )
    assert set(got) == set(want)
    for doc_id in want:
        for mine, plain in zip(sorted(got[doc_id]), sorted(want[doc_id]), strict=True):
            assert mine[:4] == plain[:4]
            assert mine[4:] == pytest.approx(plain[4:], rel=1e-9)


def test_kneser_ney_sums_to_one():
    texts = ["a b a c", "b a", "c c c a", "", "d a b"]
    unigrams, chance = plain_model(texts)
    for v in ("<s>", "a", "c"):
        # One unknown word stands for all of them.
        assert sum(chance(v, w) for w in [*unigrams, "unknown"]) == pytest.approx(1)


def plain_verdicts(pages):
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        return brute.lower(host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]

    def ruled(host, path):
        fits = [
            (len(h + p), h + p, verdict)
            for h, p, verdict in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        return max(fits)[1:] if fits else (None, None)

    judged = [(page, *parts(url), *ruled(*parts(url))) for page, url, _ in pages]
    seeds = {"allow": Counter(), "block": Counter()}
    for _, host, _, _, verdict in judged:
        if verdict:
            seeds[verdict][host] += 1
    links = Counter()
    for _, url, html in pages:
        for target in re.findall(r"(?is)\bhref\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)", html or ""):
            source = parts(url)[0]
            if source and source != brute.lower(target):
                links[source, brute.lower(target)] += 1

    def walk(seed, edges):
        total, out = sum(seed.values()), Counter()
        start = {h: n / total for h, n in seed.items()}
        for (a, _), n in edges.items():
            out[a] += n
        rank = dict(start)
        for _ in range(urls.ROUNDS):
            after = Counter({h: 0.15 * s for h, s in start.items()})
            for (a, b), n in edges.items():
                after[b] += 0.85 * rank.get(a, 0) * n / out[a]
            rank = after
        return rank

    trust = walk(seeds["allow"], links)
    distrust = walk(seeds["block"], Counter({(b, a): n for (a, b), n in links.items()}))
    found = Counter()
    for page, host, path, rule, verdict in judged:
        bad = distrust.get(host, 0) > urls.RATIO * trust.get(host, 0)
        found[page, host, path, rule, verdict or ("block" if bad else "allow")] += 1
    return found


def test_urls(spark):
    prepare(spark)
    link = '<a href="{}">x</a> <A HREF = \'//{}/x\'>'
    pages = [
        (1, "http://Good.example.com/fr/1", link.format("https://Friend.net/a", "other.net")),
        (2, "http://bad.example.com/de/", "<a href=/x>"),
        (3, "http://feeder.net/", link.format("http://bad.example.com", "bad.example.com")),
        (4, "http://feeder.net/?://x", link.format("/relative", "friend.net")),
        (5, "http://friend.net", None),
        (6, None, "x"),
        (7, "no scheme/", "<a href='//friend.net'>"),
        (8, "https://example.org/en/12?x#y", None),
        (9, "https://sub.example.org/es/#z", ""),
        (10, "https://notexample.org/es/", ""),
        (11, "https://example.org", ""),
        (12, "https://a.org/es/\nline", ""),
        (None, "ftp://com/fr/x", ""),
        (3, "http://feeder.net/", None),
        (13, "://", "x" * 5000),
    ]
    table = spark.createDataFrame(
        [(*p, "own", "extra") for p in pages], "page_id long, url string, html string, host string, rule string"
    )
    names = ("page_id", "host", "path", "rule", "verdict")
    got = counted(urls.url_verdicts(table).collect(), *names)
    assert got == plain_verdicts(pages)
    assert {r[4] for r in got if r[1] == "feeder.net"} == {"block"}
    assert urls.url_verdicts(table.limit(0)).count() == 0
    given_pages = read(spark, SF_DIR, "pages")
    rows = [(r["page_id"], r["url"], r["html"]) for r in given_pages.collect()]
    assert counted(urls.url_verdicts(given_pages).collect(), *names) == plain_verdicts(rows)


def test_url_ranks_settle(spark):
    """A chain of more than ten hosts to a cycle, against the solution of the linear system."""
    prepare(spark)
    chain = [f"h{n:02}" for n in range(16)]
    links = [(a, b, 1.0) for a, b in zip(chain, chain[1:-1])] + [("h14", "h15", 0.5), ("h14", "h00", 0.5)]
    links += [("x", "y", 1.0), ("y", "x", 1.0)]
    seeds = {"h00": 0.75, "x": 0.25}
    hosts = [*chain, "x", "y"]
    step = np.eye(len(hosts))
    for a, b, share in links:
        step[hosts.index(b), hosts.index(a)] -= urls.DAMPING * share
    want = np.linalg.solve(step, [(1 - urls.DAMPING) * seeds.get(h, 0) for h in hosts])
    given = spark.createDataFrame([(h, "trust", n) for h, n in seeds.items()], "host string, kind string, seed double")
    table = [("trust", *link) for link in links]
    table = spark.createDataFrame(table, "kind string, source string, target string, share double")
    got = {r["host"]: r["rank"] for r in urls.propagate(given, table, tolerance=1e-4).collect()}
    assert [got.get(h, 0.0) for h in hosts] == pytest.approx(list(want), rel=5e-3)


def test_url_verdicts_along_a_chain(spark):
    prepare(spark)
    hosts = [f"h{n}.net" for n in range(13)] + ["bad.example.com"]
    pages = [(n, f"http://{a}/", f'<a href="http://{b}/de/">') for n, (a, b) in enumerate(zip(hosts, hosts[1:]))]
    pages += [(99, "http://bad.example.com/de/", ""), (100, "http://other.net/", "")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.url_verdicts(table).collect()}
    assert got.pop(100) == "allow" and set(got.values()) == {"block"}
