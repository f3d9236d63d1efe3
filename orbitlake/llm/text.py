"""Words and hashes of whole Arrow batches of text in NumPy, without a Python loop per word.

Nothing here is kept between tasks: a task builds its own ``Hasher``, so that functions travel with
the plan and no worker needs the package installed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in slices of about this many bytes, always whole documents.
SLICE_BYTES = 1 << 20

_BYTES = np.arange(256)
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing: digits, a-z, all of non-ASCII.
WORD_BYTES = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
)
#: Bytes of ``[^\x20\x09-\x0D]``.
TOKEN_BYTES = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_MULTIPLIER = 0x9E3779B97F4A7C15


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Yield (rows, their UTF-8 bytes, row offsets into the bytes); a null text has no bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        start = 0
        while start < len(texts):
            stop = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            stop = min(max(stop, start + 1), len(texts))
            part = offsets[start : stop + 1]
            yield batch.slice(start, stop - start), data[part[0] : part[-1]], part - part[0]
            start = stop


def word_spans(
    data: np.ndarray, offsets: np.ndarray, members: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of every document.

    ``first`` has one entry more than there are documents; a word never crosses documents.
    """
    inside = members[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    begin = edges[edges < len(data)]
    opens[begin] = inside[begin]
    end = edges[edges > 0] - 1
    closes[end] = inside[end]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def pieces(data: np.ndarray, members: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size`` that cover a text and cut no word; a longer word is not cut."""
    start = 0
    while start < len(data):
        stop = start + size
        while stop < len(data):
            gaps = np.flatnonzero(~members[data[stop : stop + 65536]])
            if len(gaps):
                stop += int(gaps[0])
                break
            stop += 65536
        stop = min(stop, len(data))
        yield start, stop
        start = stop


def word_slices(
    batches: Iterator[pa.RecordBatch], carry: int, members: np.ndarray = TOKEN_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int, int]]:
    """Yield (rows, word hashes, first, base, old) without ever working on a whole long text.

    ``first`` holds the number of each row's first word, and one more entry. A text that is longer
    than a slice comes in pieces, each with its one row: its first word is the ``base``-th of the
    text, and its ``old`` leading words, ``carry`` at most, were there in the piece before.
    """
    hasher = Hasher()

    def hashed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hasher.load(data)
        starts, ends, first = word_spans(data, offsets, members)
        return hasher.ranges(starts, ends), first

    for rows, data, offsets in slices(batches):
        if len(data) <= 2 * SLICE_BYTES:
            yield rows, *hashed(data, offsets), 0, 0
            continue
        held, seen = np.zeros(0, np.uint64), 0
        for start, stop in pieces(data, members):
            words = hashed(data[start:stop], np.array([0, stop - start]))[0]
            whole = np.concatenate([held, words])
            yield rows, whole, np.array([0, len(whole)]), seen - len(held), len(held)
            seen += len(words)
            held = whole[len(whole) - min(carry, len(whole)) :]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Hasher:
    """64-bit hashes of any byte ranges of a slice, from one running polynomial sum."""

    def __init__(self) -> None:
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) >= size:
            return
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        for name, base in (("powers", _MULTIPLIER), ("inverses", inverse)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def load(self, data: np.ndarray) -> None:
        """Take the bytes of a slice."""
        self._grow(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of every range; it depends on the bytes alone, not on where they stand."""
        rolled = (self.sums[ends] - self.sums[starts]) * self.inverses[starts]
        return mix(rolled + (ends - starts).astype(np.uint64))


def ngrams(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size`` consecutive words within a document, and their first word's number."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rolled = words[:count].copy()
    for step in range(1, size):
        rolled *= np.uint64(_MULTIPLIER)
        rolled += words[step : step + count]
    room = np.repeat(first[1:], np.diff(first))[:count] - np.arange(count)
    at = np.flatnonzero(room >= size)
    return mix(rolled[at] + np.uint64(size)), at


class Roller:
    """Hashes of all runs of ``size`` consecutive words, from one running sum of word hashes."""

    def __init__(self, size: int, salt: int = 0) -> None:
        self.size, self.salt, self.hasher = size, np.uint64(salt), Hasher()

    def __call__(self, words: np.ndarray) -> np.ndarray:
        """One hash for each word that has enough words behind it, across documents too."""
        count = len(words) - self.size + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        self.hasher._grow(len(words) + 1)
        values = mix(words ^ self.salt) if self.salt else words
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(values * self.hasher.powers[: len(words)], out=sums[1:])
        return mix((sums[self.size :] - sums[:count]) * self.hasher.inverses[:count])


def marked(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """True for hashes whose slot is set in a bitmap of :func:`orbitlake.llm.tables.bitmap`."""
    slot = (hashes & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0
