"""Remove passages of words that repeat: fixed blocks as anchors, extended to maximal exact repeats.

A window is 35 consecutive words. Every text is cut to blocks of 18 words that do not overlap: any
window holds at least one whole block of its own text. The blocks of all texts are the index, and
every rolling run of 18 words of every text probes it. A block that stands at any second place is a
hit. From a hit a repeat is extended to both sides, in steps of a window: each window around it is
kept if it occurs at another place too, and windows that overlap or touch make up a maximal repeat.

Nothing is paired: a block or a window that a third of all texts share is one count, folded in its
tasks before it is shuffled. Only windows that turn out to be alone are traced back to their text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orbitlake.llm.tables import bitmap, fresh, staged
from orbitlake.llm.text import TOKEN_BYTES, Roller, marked, pieces, word_slices

WINDOW = 35
#: Longest block of which every window holds a whole one.
BLOCK = (WINDOW + 1) // 2
#: Slots of a bitmap for each value that it holds, and the most slots of one: 32 MB. A wrong hit
#: costs a look, never a result; a full bitmap lets all pass, and results stay the same.
SLOTS = 16
MOST_SLOTS = 1 << 28
_SALT = 0x5851F42D4C957F2D


class _Windows:
    """Blocks and windows of the words of a slice."""

    def __init__(self) -> None:
        self.block, self.window = Roller(BLOCK), Roller(WINDOW)
        self.check = Roller(WINDOW, _SALT)

    def load(self, words: np.ndarray, first: np.ndarray, base: int, old: int) -> None:
        self.words, self.old = words, old
        self.blocks = self.block(words)
        self.doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.place = np.arange(len(words)) - first[self.doc] + base
        self.room = first[self.doc + 1] - np.arange(len(words))

    def starts(self, size: int) -> np.ndarray:
        """Starts of runs of ``size`` words within a text, without those of the piece before."""
        at = np.flatnonzero(self.room >= size)
        return at[at + size > self.old]

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows whose own block is marked as repeated."""
        at = self.starts(WINDOW)
        own = at + -self.place[at] % BLOCK
        return at[marked(self.blocks[own], repeated)]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _slots(count: int) -> int:
    """The size of a bitmap for so many values: a power of two within its bounds."""
    return min(max(1 << 16, 1 << (SLOTS * max(count, 1) - 1).bit_length()), MOST_SLOTS)


def _bitmap(values: DataFrame, column: str) -> np.ndarray:
    return bitmap(values, column, _slots(values.count()))


def reference_blocks(texts: DataFrame) -> DataFrame:
    """(block): the hashes of the blocks that do not overlap, of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows()
        for _, words, first, base, old in word_slices(batches, WINDOW - 1):
            windows.load(words, first, base, old)
            at = windows.starts(BLOCK)
            found = np.unique(windows.blocks[at[windows.place[at] % BLOCK == 0]])
            yield pa.RecordBatch.from_arrays([_signed(found)], names=["block"])

    return texts.select("text").mapInArrow(run, "block long").distinct()


def repeated_blocks(texts: DataFrame, index: np.ndarray) -> DataFrame:
    """(block): blocks of the index that stand at two or more places, at any word of any text."""
    sent = texts.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows()
        for _, words, first, base, old in word_slices(batches, WINDOW - 1):
            windows.load(words, first, base, old)
            at = windows.starts(BLOCK)
            at = at[marked(windows.blocks[at], sent.value)]
            found, number, n = np.unique(
                windows.blocks[at], return_inverse=True, return_counts=True
            )
            listed = np.zeros(len(found), np.int64)
            listed[number[windows.place[at] % BLOCK == 0]] = 1
            yield pa.RecordBatch.from_arrays(
                [_signed(found), pa.array(n), pa.array(listed)], names=["block", "n", "listed"]
            )

    probes = texts.select("text").mapInArrow(run, "block long, n long, listed long")
    counts = probes.groupBy("block").agg(F.sum("n").alias("n"), F.max("listed").alias("listed"))
    return counts.where("n > 1 and listed = 1").select("block")


def lone_windows(texts: DataFrame, repeated: np.ndarray) -> DataFrame:
    """(d1, d2, places): windows around a repeated block that occur nowhere else, by text.

    ``texts`` holds (d1, d2, text). A window that occurs once has one place, which the extremes of
    its group then are; no window has to be looked up again.
    """
    sent = texts.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows()
        for rows, words, first, base, old in word_slices(batches, WINDOW - 1):
            windows.load(words, first, base, old)
            at = windows.candidates(sent.value)
            doc = pa.array(windows.doc[at])
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(windows.window(words)[at]),
                    _signed(windows.check(words)[at] >> np.uint64(32)),
                    rows.column("d1").take(doc),
                    rows.column("d2").take(doc),
                    pa.array(windows.place[at]),
                ],
                names=["w1", "w2", "d1", "d2", "place"],
            )

    found = texts.select("d1", "d2", "text").mapInArrow(
        run, "w1 long, w2 long, d1 long, d2 long, place long"
    )
    extremes = [F.max(c).alias(c) for c in ("d1", "d2", "place")]
    alone = found.groupBy("w1", "w2").agg(F.count("*").alias("n"), *extremes).where("n = 1")
    return alone.groupBy("d1", "d2").agg(F.collect_list("place").alias("places"))


def covers(
    batches: Iterator[pa.RecordBatch], repeated: np.ndarray, alone: str | None
) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    """(rows, number, cover) of each row: which words of its text lie under repeated windows.

    ``alone`` names the column with the windows that are not repeated.
    """
    windows, held, parts = _Windows(), None, []

    def cover(rows: pa.RecordBatch, number: int, size: int, starts: np.ndarray) -> np.ndarray:
        if alone is not None and rows.column(alone)[number].is_valid:
            starts = np.setdiff1d(starts, rows.column(alone)[number].values.to_numpy())
        steps = np.zeros(size + 1, np.int64)
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + WINDOW, -1)
        return np.cumsum(steps[:-1]) > 0

    def whole() -> tuple[pa.RecordBatch, int, np.ndarray]:
        return held[0], 0, cover(held[0], 0, held[1], np.concatenate(parts))

    for rows, words, first, base, old in word_slices(batches, WINDOW - 1):
        windows.load(words, first, base, old)
        at = windows.candidates(repeated)
        if held is not None and rows is not held[0]:
            yield whole()
            held, parts = None, []
        if rows.num_rows == 1:
            # It may be a piece of a text that goes on: complete when another row begins.
            held = rows, base + len(words)
            parts.append(windows.place[at])
            continue
        cuts = np.searchsorted(windows.doc[at], np.arange(rows.num_rows + 1))
        for number in range(rows.num_rows):
            own = windows.place[at[cuts[number] : cuts[number + 1]]]
            yield rows, number, cover(rows, number, int(first[number + 1] - first[number]), own)
    if held is not None:
        yield whole()


def spans_of(cover: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of covered words."""
    steps = np.diff(cover.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def kept_parts(text: bytes, cover: np.ndarray) -> Iterator[bytes]:
    """The words that are not covered, joined by one space, in parts of bounded size."""
    start, end = spans_of(~cover)
    data, seen, lead = np.frombuffer(text, np.uint8), 0, b""
    for a, b in pieces(data, TOKEN_BYTES):
        words = text[a:b].split()
        low = np.clip(start - seen, 0, len(words))
        high = np.clip(end - seen, 0, len(words))
        for i, j in zip(low[low < high].tolist(), high[low < high].tolist()):
            yield lead + b" ".join(words[i:j])
            lead = b" "
        seen += len(words)


def _digests(text: Column) -> tuple[Column, Column]:
    """Two hashes that stand for a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _finish(
    docs: DataFrame,
    columns: T.StructType,
    make: Callable[[bytes | None, np.ndarray], tuple],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` without the ``drop`` columns and with what ``make`` says of a text and its cover."""
    spark = docs.sparkSession
    texts = docs.select(*[c.alias(n) for n, c in zip(("d1", "d2"), _digests(F.col("text")))], "text")
    index = _bitmap(staged(reference_blocks(texts), "blocks"), "block")
    repeated = _bitmap(staged(repeated_blocks(texts, index), "repeatedblocks"), "block")
    alone = staged(lone_windows(texts, repeated), "lonewindows")
    sent = spark.sparkContext.broadcast((repeated, _bitmap(alone, "d1")))

    names = [fresh(n, docs) for n in ("_d1", "_d2", "_alone")]
    keyed = docs.withColumns(dict(zip(names, _digests(F.col("text")))))
    kept = [f for f in docs.schema if f.name not in drop]
    schema = T.StructType([*kept, *columns])
    types = [field.type for field in to_arrow_schema(columns)]

    def to_do(batches: Iterator[pa.RecordBatch], listed: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(names[0]).to_numpy().view(np.uint64)
            yield batch.filter(pa.array(marked(keys, sent.value[1]) == listed))

    def finish(batches: Iterator[pa.RecordBatch], column: str | None) -> Iterator[pa.RecordBatch]:
        held, made = None, []

        def out() -> pa.RecordBatch:
            arrays = [held.column(f.name) for f in kept]
            # Typed: a batch without any span would else be another type than the others.
            arrays += [pa.array(list(values), kind) for values, kind in zip(zip(*made), types)]
            return pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

        for rows, number, cover in covers(batches, sent.value[0], column):
            if number == 0:
                if held is not None:
                    yield out()
                held, made = rows, []
            text = rows.column("text")[number].as_py()
            made.append(make(None if text is None else text.encode(), cover))
        if held is not None:
            yield out()

    # Texts without a lone window are done where they are read; only the others are shuffled.
    plain = keyed.mapInArrow(lambda batches: finish(to_do(batches, False), None), schema)
    others = keyed.mapInArrow(lambda batches: to_do(batches, True), keyed.schema)
    known = alone.toDF("_k1", "_k2", "_places").select(
        F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), F.col("_places").alias(names[2])
    )
    same = (others[names[0]] == known["k1"]) & (others[names[1]] == known["k2"])
    others = others.join(known, same, "left").select(*[others[f"`{c}`"] for c in docs.columns], names[2])
    return plain.union(others.mapInArrow(lambda batches: finish(batches, names[2]), schema))


def passage_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, n_spans, spans) of every document.

    ``spans`` lists the maximal repeats as ranges of word numbers. Null and empty texts have no
    words; texts under 35 words lose nothing. Rows that repeat a text count as documents of their
    own, so a text of 35 words or more that occurs twice loses all. Runs are compared by 96 bits of
    hashes. Long texts are worked on in pieces; what is held of a whole one is a byte per word.
    """
    columns = T.StructType.fromDDL(
        "n_words long, n_removed long, kept_sha256 string, n_spans long,"
        " spans array<struct<start: long, stop: long>>"
    )

    def make(text: bytes | None, cover: np.ndarray) -> tuple:
        digest = hashlib.sha256()
        for part in kept_parts(text or b"", cover):
            digest.update(part)
        start, stop = spans_of(cover)
        spans = [{"start": a, "stop": b} for a, b in zip(start.tolist(), stop.tolist())]
        return len(cover), int(cover.sum()), digest.hexdigest(), len(spans), spans

    return _finish(docs.select("doc_id", "text"), columns, make, drop=("text",))


def without_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``; all rows and columns stay.

    Kept words are joined by one space. Texts that lose nothing stay as they are, null included.
    """
    name = fresh("_kept", docs)

    def make(text: bytes | None, cover: np.ndarray) -> tuple:
        if text is None or not cover.any():
            return (None if text is None else text.decode(),)
        return (b"".join(kept_parts(text, cover)).decode(),)

    found = _finish(docs, T.StructType.fromDDL(f"{name} string"), make)
    return found.select(*[F.col(name).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
