"""Toxicity by a convolutional text classifier over hashed words, trained in NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.tables import held_out, smallest, staged
from orbitlake.llm.text import LOWER, WORD_BYTES, Hasher, mix, slices, word_spans

FOLD = 0
#: Bounds of the training sample, of each label.
MAX_PER_LABEL = 4000
SLOTS = 1 << 18
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 12
EPOCHS = 10
DROPPED = 0.6
BATCH = 32
#: Share of the sample that only calibrates, as all labelled texts beyond the sample do.
CALIBRATION = 0.25
#: Margins are counted in bins of this fineness for the thresholds, up to the bins of +-64.
BINS_PER_UNIT = 256
MAX_BIN = 64 * BINS_PER_UNIT
#: Labelled texts of each kind that a language needs for a threshold of its own.
LEAST = 12
#: Texts that a slot must occur in to be learned; all other slots stay at zero.
LEAST_TEXTS = 3
#: A word is its own hash and those of its first and last bytes.
PIECES = 3
PIECE_BYTES = 4

# Frequent function words that tell a text's language.
FUNCTION_WORDS = {
    "en": "the of and to in that is it for was on with as are this be at by from or",
    "de": "der die und das ist nicht den zu mit sich des auf für im dem von ein eine als auch",
    "es": "el la que los las de en un una por con para su al del se lo como más y",
    "fr": "le la les des et un une est dans que pour qui sur au pas ce par plus ne aux",
}
LANGUAGES = (*FUNCTION_WORDS, "")


def pieces(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots of each word's pieces, number of each document's first word, languages)."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, WORD_BYTES)
    hasher.load(data)
    whole = hasher.ranges(starts, ends)
    head = hasher.ranges(starts, np.minimum(starts + PIECE_BYTES, ends)) ^ np.uint64(1)
    tail = hasher.ranges(np.maximum(ends - PIECE_BYTES, starts), ends) ^ np.uint64(2)
    slots = np.stack([mix(x) % np.uint64(SLOTS) for x in (whole, head, tail)], 1).astype(np.int32)
    return slots, first, _languages(whole, first, hasher)


def _languages(words: np.ndarray, first: np.ndarray, hasher: Hasher) -> np.ndarray:
    """The language whose function words a text holds most often, by number; the last for none."""
    n_docs = len(first) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    hits = np.zeros((n_docs, len(LANGUAGES)))
    hits[:, -1] = 0.5
    for number, listed in enumerate(FUNCTION_WORDS.values()):
        known = np.sort(_hash_words(listed.split(), hasher))
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        hits[:, number] = np.bincount(doc, weights=known[at] == words, minlength=n_docs)
    return hits.argmax(1)


def _hash_words(listed: list[str], hasher: Hasher) -> np.ndarray:
    sums, raw = hasher.sums, [w.encode() for w in listed]
    data = np.frombuffer(b"".join(raw), np.uint8)
    hasher.load(data)
    ends = np.cumsum([len(w) for w in raw])
    found = hasher.ranges(ends - [len(w) for w in raw], ends)
    hasher.sums = sums
    return found


@dataclass
class Model:
    embed: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    shift: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))
    sharpness: float = 1.0


def new_model(known: np.ndarray, seed: int = 11) -> Model:
    """A model to train; only ``known`` slots get an embedding, so that rare words say nothing."""
    rng = np.random.default_rng(seed)
    embed = np.zeros((SLOTS, DIM), np.float32)
    embed[known] = rng.normal(0, 0.1, (len(known), DIM))
    return Model(
        embed,
        [rng.normal(0, 0.4 / w, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
    )


def _padded(slots: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the words when each document is followed by empty rows, and the documents' starts."""
    gap = max(WIDTHS)
    n_docs = len(first) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    return np.arange(len(slots)) + gap * doc, first[:-1] + gap * np.arange(n_docs)


def forward(model: Model, slots: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(pooled filters, embedded words, responses by width, rows, starts) of some documents."""
    rows, starts = _padded(slots, first)
    total = len(slots) + max(WIDTHS) * (len(first) - 1)
    embedded = np.zeros((total + max(WIDTHS), DIM), np.float32)
    embedded[rows] = sum(model.embed[slots[:, k]] for k in range(PIECES))
    blank = np.ones(total, bool)
    blank[rows] = False
    pooled, responses = [], []
    for kernel, bias in zip(model.kernels, model.biases):
        response = sum(embedded[k : k + total] @ part for k, part in enumerate(kernel))
        # Filters start at words; a text without words has none, and pools to zero.
        response[blank] = -np.inf
        responses.append(response)
        pooled.append(np.maximum(np.maximum.reduceat(response, starts, axis=0) + bias, 0))
    return np.concatenate(pooled, 1), embedded, responses, rows, starts


def margins(model: Model, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
    if len(first) < 2:
        return np.zeros(0)
    return (forward(model, slots, first)[0] @ model.out + model.shift).astype(np.float64)


def _joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(d) for d in docs])
    return np.concatenate(docs), np.concatenate(([0], np.cumsum(sizes)))


def train(docs: list[np.ndarray], labels: np.ndarray) -> Model:
    """Adagrad on the logistic loss; only the words that win a filter's maximum learn."""
    texts = np.zeros(SLOTS, np.int32)
    for slots in docs:
        texts[np.unique(slots)] += 1
    known = texts >= LEAST_TEXTS
    model, rng = new_model(np.flatnonzero(known)), np.random.default_rng(12)
    # Both labels weigh the same, however many texts have them.
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    seen = {"embed": np.full((SLOTS, 1), 1e-3, np.float32), "out": np.full_like(model.out, 1e-3)}
    seen_kernels = [np.full_like(k, 1e-3) for k in model.kernels]
    seen_biases = [np.full_like(b, 1e-3) for b in model.biases]
    rate = 0.08
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            # Words are left out at random, so that no filter rests on the plainest of them alone.
            slots, first = _joined(
                [docs[i][rng.random(len(docs[i])) >= DROPPED] for i in chosen]
            )
            pooled, embedded, responses, rows, starts = forward(model, slots, first)
            margin = pooled @ model.out + model.shift
            slope = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]
            slope *= weight[chosen] / len(chosen)
            back = np.outer(slope, model.out) * (pooled > 0)
            grad = pooled.T @ slope + 1e-4 * model.out
            seen["out"] += grad**2
            model.out -= rate * grad / np.sqrt(seen["out"])
            model.shift -= rate * float(slope.sum())
            grad_rows = np.zeros_like(embedded)
            stops = np.append(starts[1:], len(responses[0]))
            for number, (kernel, response) in enumerate(zip(model.kernels, responses)):
                part = back[:, number * FILTERS : (number + 1) * FILTERS].astype(np.float32)
                best = np.stack([response[a:b].argmax(0) + a for a, b in zip(starts, stops)])
                grad_kernel = np.zeros_like(kernel)
                for k in range(kernel.shape[0]):
                    taken = embedded[best + k]
                    grad_kernel[k] = np.einsum("df,dfe->ef", part, taken)
                    np.add.at(grad_rows, best + k, part[:, :, None] * kernel[k].T[None])
                seen_kernels[number] += grad_kernel**2
                kernel -= rate * grad_kernel / np.sqrt(seen_kernels[number])
                grad_bias = part.sum(0)
                seen_biases[number] += grad_bias**2
                model.biases[number] -= rate * grad_bias / np.sqrt(seen_biases[number])
            grad_words = grad_rows[rows]
            moved = np.flatnonzero(np.abs(grad_words).sum(1))
            for k in range(PIECES):
                own = moved[known[slots[moved, k]]]
                slot, where = np.unique(slots[own, k], return_inverse=True)
                grad = np.zeros((len(slot), DIM), np.float32)
                np.add.at(grad, where, grad_words[own])
                seen["embed"][slot] += (grad**2).mean(1, keepdims=True)
                model.embed[slot] -= rate * grad / np.sqrt(seen["embed"][slot])
    return model


def _best_cut(at: np.ndarray, bad: np.ndarray, good: np.ndarray) -> float:
    """The cut with the fewest errors; in the middle of the widest gap that has as few.

    ``bad`` and ``good`` weigh the texts of each label whose margin is ``at``.
    """
    at, where = np.unique(at, return_inverse=True)
    bad, good = np.bincount(where, bad), np.bincount(where, good)
    errors = np.concatenate(([0], np.cumsum(bad))) + np.concatenate(([0], np.cumsum(good[::-1])))[::-1]
    edges = np.concatenate(([at[0] - 1], at, [at[-1] + 1]))
    # Weighted sums of the same texts differ in their last digits.
    few = errors <= errors.min() + 1e-9 * (bad.sum() + good.sum())
    gap = int(np.where(few, np.diff(edges), -1).argmax())
    return float((edges[gap] + edges[gap + 1]) / 2)


def calibrate(model: Model, cells: np.ndarray) -> None:
    """Set a threshold for each language, shared where a language has too few labelled texts.

    ``cells`` has rows of (language, label, fitted, bin, number of texts) for all labelled texts.
    Texts the model was fitted on don't vouch for themselves: they count in the numbers of their
    label, whose margins are those of its other texts. So the share of a label is that of all texts.
    """
    model.thresholds[:] = 0.0
    spoken, label, fitted, bins, n = cells.T
    kept = fitted == 0
    if len(np.unique(label[kept])) < 2:
        kept = np.ones(len(n), bool)
    at = (bins + 0.5) / BINS_PER_UNIT

    def cut(own: np.ndarray, least: int) -> float | None:
        counts = [n[own & kept & (label == mark)].sum() for mark in (0, 1)]
        if min(counts) < least:
            return None
        weigh = [n[own & (label == mark)].sum() / counts[mark] for mark in (0, 1)]
        used = own & kept
        good, bad = (np.where(label[used] == mark, n[used] * weigh[mark], 0.0) for mark in (0, 1))
        return _best_cut(at[used], bad, good)

    shared = cut(np.ones(len(n), bool), 1)
    for number in range(len(LANGUAGES)):
        own = cut(spoken == number, LEAST)
        model.thresholds[number] = (shared or 0.0) if own is None else own


def _sample(docs: DataFrame, chosen: DataFrame, limit: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The words of texts with the ids of ``chosen``, and which of them only calibrate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for rows, data, offsets in slices(batches):
            slots, first, _ = pieces(data, offsets, hasher)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key"),
                    pa.array([slots[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary()),
                    rows.column("apart"),
                ],
                names=["key", "slots", "apart"],
            )

    slim = docs.select("doc_id", "text")
    joined = slim.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    joined = joined.select(F.xxhash64(F.lit(3), "doc_id", "text").alias("key"), "text", "apart")
    found = staged(joined.mapInArrow(run, "key long, slots binary, apart boolean"), "labelled")
    # An id may stand for many rows; rows that repeat as a whole are one text here.
    found = found.groupBy("key").agg(F.first("slots").alias("slots"), F.first("apart").alias("apart"))
    found = smallest(found, "key", limit).toArrow()
    rows = sorted(zip(found.column("slots").to_pylist(), found.column("apart").to_pylist()))
    slots = [np.frombuffer(r[0], np.int32).reshape(-1, PIECES) for r in rows]
    return slots, np.array([r[1] for r in rows], bool)


def sample_ids(ids: DataFrame, limit: int) -> DataFrame:
    """``limit`` ids, chosen by their hashes: the same ones in every run."""
    ids = ids.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct()
    return smallest(ids.withColumn("_key", F.xxhash64(F.lit(3), "_id")), "_key", limit)


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame] | None:
    """A model fitted on some of the labelled texts outside the held-out fold, without thresholds.

    And (_id, mark, fitted) of all labelled ids outside the fold. None without labels of both kinds.
    """
    # The bound is on texts there are, so labels of other texts go first.
    labels = labels.join(docs.select("doc_id"), "doc_id", "left_semi")
    seen = labels.where(~held_out("doc_id", FOLD) & F.col("toxic").isin(0, 1))
    marked = seen.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("mark")).distinct()
    chosen = [
        sample_ids(seen.where(F.col("toxic") == mark), MAX_PER_LABEL).select("_id", F.lit(mark).alias("mark"))
        for mark in (0, 1)
    ]
    # By the id alone, so that it can be told for any text.
    apart = F.pmod(F.xxhash64(F.lit(13), "_id"), F.lit(100)) < int(100 * CALIBRATION)
    chosen = staged(chosen[0].union(chosen[1]).withColumn("apart", apart), "sampled")
    texts, aside, marks = [], [], []
    for mark in (0, 1):
        own, side = _sample(docs, chosen.where(F.col("mark") == mark), MAX_PER_LABEL)
        texts += own
        aside.append(side)
        marks.append(np.full(len(own), float(mark)))
    if not len(marks[0]) or not len(marks[1]):
        return None
    labels_, side = np.concatenate(marks), np.concatenate(aside)
    if len(np.unique(labels_[~side])) < 2:
        side[:] = False
        chosen = chosen.withColumn("apart", F.lit(False))
    model = train([text for text, out in zip(texts, side) if not out], labels_[~side])
    known = marked.join(chosen, ["_id", "mark"], "left")
    return model, known.select("_id", "mark", F.coalesce(~F.col("apart"), F.lit(False)).alias("fitted"))


def margin_cells(found: DataFrame, known: DataFrame) -> np.ndarray:
    """Rows of (language, label, fitted, bin, number of texts) of all labelled texts.

    ``found`` has (doc_id, language, margin). There are at most so many rows as bins, whatever the
    number of texts; margins beyond the last bin count there.
    """
    place = F.floor(F.col("margin") * BINS_PER_UNIT)
    joined = found.join(known, F.col("doc_id") == F.col("_id"))
    joined = joined.select(
        F.col("language").cast("long").alias("language"),
        F.col("mark").cast("long").alias("mark"),
        F.col("fitted").cast("long").alias("fitted"),
        F.least(F.greatest(place, F.lit(-MAX_BIN)), F.lit(MAX_BIN)).alias("bin"),
    )
    cells = joined.groupBy("language", "mark", "fitted", "bin").agg(F.count("*").alias("n")).toArrow()
    return np.stack([column.to_numpy() for column in cells.columns], 1)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    The language that picks a threshold is read off the text; thresholds make the fewest errors on
    all labelled texts outside the fold. A null or empty text scores as one without words. Without
    labels of both kinds every score is 0. Rows that repeat an id are scored on their own texts.
    """
    learned = learn(docs, labels)
    slim = docs.select("doc_id", held_out("doc_id", FOLD).alias("held_out"), "text")
    if learned is None:
        return slim.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    model, known = learned
    schema = T.StructType(
        [docs.schema["doc_id"], *T.StructType.fromDDL("held_out boolean, language int, margin double")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for rows, data, offsets in slices(batches):
            slots, first, languages = pieces(data, offsets, hasher)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("held_out"),
                    pa.array(languages.astype(np.int32)),
                    pa.array(margins(model, slots, first)),
                ],
                names=schema.fieldNames(),
            )

    # Every text is gone through once; thresholds need the margins before there are scores.
    found = staged(slim.mapInArrow(run, schema), "margins")
    calibrate(model, margin_cells(found, known))
    cut = F.element_at(F.array(*[F.lit(float(t)) for t in model.thresholds]), F.col("language") + 1)
    # 0.5 at the threshold of a text's language.
    over = F.least(F.greatest((F.col("margin") - cut) * model.sharpness, F.lit(-40.0)), F.lit(40.0))
    found = found.select("doc_id", "held_out", (F.lit(1.0) / (F.exp(-over) + 1)).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
