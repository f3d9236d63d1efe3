"""Text quality learned from trusted positives and unlabelled text (non-negative PU risk)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.tables import held_out, smallest, staged
from orbitlake.llm.text import LOWER, TOKEN_BYTES, Hasher, mix, ngrams, slices, word_spans

FOLD = 0
KEEP_SCORE = 0.3
#: Bounds of the sample that the weights are fitted on: trusted positives and unlabelled texts.
MAX_POSITIVES = 20_000
MAX_UNLABELLED = 40_000
#: Cells of margins in which all texts are counted; the outer ones take what lies beyond.
EDGES = np.arange(-24 * 64, 24 * 64 + 1) / 64
HIDDEN = 16
STEPS = 3000
PASSES = 60
BATCH = 512

_CODES = np.arange(256)
#: Classes of bytes whose shares describe a text.
_CLASSES = {
    "upper": (_CODES >= 0x41) & (_CODES <= 0x5A),
    "lower": (_CODES >= 0x61) & (_CODES <= 0x7A),
    "digit": (_CODES >= 0x30) & (_CODES <= 0x39),
    "space": (_CODES == 0x20) | ((_CODES >= 0x09) & (_CODES <= 0x0D)),
    "stop": np.isin(_CODES, [ord(c) for c in ".,;:?"]),
    "bang": _CODES == ord("!"),
    "bar": np.isin(_CODES, [ord(c) for c in "|\\/<>{}[]=_~^"]),
    "sign": np.isin(_CODES, [ord(c) for c in "#$%&*@+"]),
    "other": _CODES >= 0x80,
}
N_FEATURES = len(_CLASSES) + 11


def _distinct(values: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Number of distinct values in each document; ``doc`` is sorted."""
    keys = values ^ mix(doc.astype(np.uint64) + np.uint64(1))
    _, at = np.unique(keys, return_index=True)
    return np.bincount(doc[at], minlength=n_docs)


def features(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> np.ndarray:
    """One row of numbers for each document of a slice, from the whole text; zeros if empty."""
    n_docs = len(offsets) - 1
    size = np.diff(offsets)
    bytes_ = np.maximum(size, 1)
    columns = []
    for members in _CLASSES.values():
        sums = np.concatenate(([0], np.cumsum(members[data])))
        columns.append(np.diff(sums[offsets]) / bytes_)
    starts, ends, first = word_spans(data, offsets, TOKEN_BYTES)
    count = np.diff(first)
    words = np.maximum(count, 1)
    doc = np.repeat(np.arange(n_docs), count)
    hasher.load(LOWER[data])
    hashes = hasher.ranges(starts, ends)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=flags, minlength=n_docs) / words

    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    letters = ~_CLASSES["digit"] & ~_CLASSES["stop"] & (_CODES >= 0x30)
    pairs, at = ngrams(hashes, first, 2)
    lines = np.bincount(
        np.searchsorted(offsets, np.flatnonzero(data == 0x0A), "right") - 1, minlength=n_docs
    )
    long = ends - starts
    columns += [
        np.log1p(size) / 10,
        np.log1p(count) / 10,
        share(long) / 10,
        np.sqrt(share(long.astype(float) ** 2)) / 10,
        share(again),
        _distinct(hashes, doc, n_docs) / words,
        _distinct(pairs, doc[at], n_docs) / words,
        share(_CLASSES["upper"][data[starts]]),
        share(_CLASSES["sign"][data[ends - 1]] | _CLASSES["bang"][data[ends - 1]]),
        share((long == 1) & ~letters[data[starts]]),
        np.log1p(lines) - np.log1p(count),
    ]
    return np.stack(columns, 1).astype(np.float32)


@dataclass
class Model:
    """A small network over standardised features; ``prior`` is the estimated share of good text."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -6, 6)

    def margin(self, rows: np.ndarray) -> np.ndarray:
        w, b, v, c = self.weights
        return np.tanh(self.inputs(rows) @ w + b) @ v + c[0]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -40, 40)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _train(
    positives: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int
) -> list[np.ndarray]:
    """Adam on the logistic risk; with a prior the non-negative PU risk, else positive against rest."""
    rng = np.random.default_rng(5)
    n = positives.shape[1]
    weights = [
        rng.normal(0, 1 / np.sqrt(n), (n, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        p = positives[rng.integers(0, len(positives), BATCH)]
        u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        x = np.concatenate([p, u])
        hidden = np.tanh(x @ weights[0] + weights[1])
        g = hidden @ weights[2] + weights[3][0]
        up, down = _sigmoid(g) - 1, _sigmoid(g)  # slopes of the loss of label 1 and of label 0
        slope = np.empty(len(x))
        if prior is None:
            slope[:BATCH], slope[BATCH:] = up[:BATCH], down[BATCH:]
        else:
            loss = np.logaddexp(0, g)  # of label 0
            negative = loss[BATCH:].mean() - prior * loss[:BATCH].mean()
            if negative >= 0:
                slope[:BATCH] = prior * up[:BATCH] - prior * down[:BATCH]
                slope[BATCH:] = down[BATCH:]
            else:
                # The risk of the unseen negatives went below zero: climb back before going on.
                slope[:BATCH], slope[BATCH:] = prior * down[:BATCH], -down[BATCH:]
        slope /= BATCH
        back = np.outer(slope, weights[2]) * (1 - hidden**2)
        grads = [x.T @ back, back.sum(0), hidden.T @ slope, np.array([slope.sum()])]
        rate = 0.01 * min(1.0, 2 - 2 * step / (steps + 1))
        for w, grad, m, v in zip(weights, grads, first, second):
            grad = grad + 1e-4 * w
            m += 0.1 * (grad - m)
            v += 0.001 * (grad**2 - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return weights


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among unlabelled texts, from counts of both by rising margin.

    Above any margin, unlabelled text holds at least ``prior`` times the share of the positives; the
    least ratio over the margins that many positives exceed comes close to the prior.
    """
    above = [1 - np.append(0, np.cumsum(n))[:-1] / max(n.sum(), 1) for n in (positive, unlabelled)]
    many = (above[0] <= 0.98) & (above[0] >= 0.5)
    if not many.any():
        many = above[0] > 0
    return float(np.clip((above[1][many] / above[0][many]).min(initial=1.0), 0.02, 0.98))


def best_cut(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The margin with the least non-negative risk of a wrong verdict, from counts by rising margin.

    Of margins that are as good, one on the low side: unseen good texts score less than seen ones.
    """
    below = [np.append(0, np.cumsum(n))[:-1] / max(n.sum(), 1) for n in (positive, unlabelled)]
    risk = prior * below[0] + np.maximum((1 - below[1]) - prior * (1 - below[0]), 0)
    # Not beyond the margin that most texts have.
    risk = np.where(below[1] <= 0.6, risk, np.inf)
    good = EDGES[np.flatnonzero(risk <= risk.min() + 0.002)]
    # Empty cells at the low end say nothing.
    good = np.maximum(good, EDGES[max(int(np.argmax(positive + unlabelled > 0)) - 1, 0)])
    return float(good[0] + 0.3 * (good[-1] - good[0]))


def _floats(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("row").flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)


def margin_counts(seen: DataFrame, models: list[Model]) -> np.ndarray:
    """Texts by (half, positive or unlabelled, cell of the margin), over all of ``seen``.

    A text of half h is scored by model h, the one that has not learned from its half.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, half = _floats(batch), batch.column("half").to_numpy()
            margin = np.choose(half % len(models), [m.margin(rows) for m in models])
            cell = np.clip(np.searchsorted(EDGES, margin, "right") - 1, 0, len(EDGES) - 1)
            good = batch.column("good").to_numpy(zero_copy_only=False)
            # A positive is an unlabelled text as well.
            kinds = ((half * 2 + 1) * len(EDGES) + cell, half[good] * 2 * len(EDGES) + cell[good])
            at, n = np.unique(np.concatenate(kinds), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["at", "n"])

    cells = seen.select("row", "half", "good").mapInArrow(run, "at long, n long")
    cells = cells.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(4 * len(EDGES), np.int64)
    counts[cells.column("at").to_numpy()] = cells.column("n").to_numpy()
    return counts.reshape(2, 2, len(EDGES))


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, key, row) of every whole text: its features, and a hash of id and text."""
    slim = docs.select(
        "doc_id",
        held_out("doc_id", FOLD).alias("held_out"),
        F.xxhash64(F.lit(3), "doc_id", "text").alias("key"),
        "text",
    )
    schema = T.StructType(
        [docs.schema["doc_id"], *T.StructType.fromDDL("held_out boolean, key long, row array<float>")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for rows, data, offsets in slices(batches):
            found = features(data, offsets, hasher)
            cuts = pa.array(np.arange(len(found) + 1, dtype=np.int32) * N_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:3], pa.ListArray.from_arrays(cuts, pa.array(found.ravel()))],
                names=schema.fieldNames(),
            )

    return slim.mapInArrow(run, schema)


def _sample(rows: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and halves of a bounded sample: the same rows in every run, in the same order."""
    # Rows that repeat as a whole have one key, and are one text here.
    rows = rows.groupBy("key").agg(F.first("row").alias("row"), F.first("half").alias("half"))
    found = smallest(rows, "key", limit).toArrow().sort_by("key").combine_chunks()
    if not found.num_rows:
        return np.zeros((0, N_FEATURES)), np.zeros(0, np.int64)
    return _floats(found.to_batches()[0]), found.column("half").to_numpy()


def learn(texts: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on ``described`` texts outside the held-out fold: labelled good ones, and all as unlabelled.

    The weights are fitted on bounded samples. The class prior and the cut come from the margins of
    all texts outside the fold, as counts by cell, so that they behave alike at every size. None
    when there is nothing to learn from.
    """
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("_id")).distinct()
    seen = texts.where("not held_out").join(good, F.col("doc_id") == F.col("_id"), "left")
    half = F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(2)).alias("half")
    seen = staged(seen.select("key", "row", half, F.col("_id").isNotNull().alias("good")), "qualityrows")
    p, of_p = _sample(seen.where("good"), MAX_POSITIVES)
    u, of_u = _sample(seen, MAX_UNLABELLED)
    if not len(p):
        return None
    rows = np.concatenate([p, u])
    model = Model(rows.mean(0), rows.std(0) + 1e-3, [], 0.5)
    p, u = model.inputs(p), model.inputs(u)
    # Few texts are gone through at most so many times.
    steps = int(np.clip(PASSES * len(u) / BATCH, STEPS // 10, STEPS))
    if all((of == h).any() for of in (of_p, of_u) for h in (0, 1)):
        # Each half is scored by what the other half taught: texts never vouch for themselves.
        halves = [
            replace(model, weights=_train(p[of_p != h], u[of_u != h], None, steps // 3)) for h in (0, 1)
        ]
        model.prior = float(np.mean([estimate_prior(*n) for n in margin_counts(seen, halves)]))
    model.weights = _train(p, u, model.prior, steps)
    # The cut becomes the score from which texts are kept.
    cut = best_cut(*margin_counts(seen, [model]).sum(0), model.prior)
    model.weights[3] += np.log(KEEP_SCORE / (1 - KEEP_SCORE)) - cut
    return model


def _scores(model: Model | None, rows: np.ndarray) -> np.ndarray:
    return np.full(len(rows), 0.5) if model is None else model.score(rows.astype(np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    A null text scores as an empty one. Without labels of good texts every score is 0.5. Rows that
    repeat an id are scored on their own texts.
    """
    found = staged(described(docs), "quality")
    model = learn(found, labels)
    schema = T.StructType(
        [docs.schema["doc_id"], *T.StructType.fromDDL("held_out boolean, score double, predicted int")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = _scores(model, _floats(batch))
            kept = pa.array((score >= KEEP_SCORE).astype(np.int32))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(score), kept]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return found.select("doc_id", "held_out", "row").mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the texts the classifier rejects; all columns are kept."""
    model = learn(staged(described(docs), "quality"), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for rows, data, offsets in slices(batches):
            score = _scores(model, features(data, offsets, hasher))
            yield rows.filter(pa.array(score >= KEEP_SCORE))

    return docs.mapInArrow(run, docs.schema)
