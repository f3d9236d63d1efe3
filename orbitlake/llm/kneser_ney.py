"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from mapped files.

Words are numbered by their place in the sorted array of all word hashes; a bigram is the number of
its context and of its word in one 64-bit key. Counts are made in tasks, meet in Spark's shuffle,
and are written as sorted arrays to the shared folder, where workers map them into memory: a task
holds only the pages it looks at, however large the model is.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.tables import held_out, staged
from orbitlake.llm.text import LOWER, TOKEN_BYTES, Hasher, mix, slices, word_spans
from orbitlake.session import scratch_path

FOLD = 1
#: The hash of the token that ends every text.
END = np.uint64(0x5EED0E0D)
#: Tokens that a task gathers before it sends their counts on.
GATHER = 4_000_000
#: Tokens for each file of bigrams.
SHARD_TOKENS = 3_000_000
#: Words for each file of word statistics.
BLOCK = 1 << 18
_CODEC = "zstd"


def local_folder(uri: str) -> str:
    """The path under which workers can map files of the shared folder."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise RuntimeError(f"the model needs a shared folder that workers can map, not {uri}")
    return uri


def tokens(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, the end of each text included, and each text's first token."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, TOKEN_BYTES)
    hasher.load(data)
    n_docs = len(offsets) - 1
    found = np.full(len(starts) + n_docs, END, np.uint64)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    found[np.arange(len(starts)) + doc] = hasher.ranges(starts, ends)
    return found.view(np.int64), first + np.arange(n_docs + 1)


def _write(folder: str, name: str, array: np.ndarray) -> None:
    """Write a file whole or not at all; a task that runs again replaces it with the same."""
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    array.tofile(part)
    os.replace(part, f"{folder}/{name}")


@dataclass
class Vocabulary:
    """All word hashes in ascending order over several files, with their counts."""

    folder: str
    names: list[str]
    firsts: np.ndarray
    offsets: np.ndarray
    total: int
    texts: int
    maps: dict = field(default_factory=dict)

    @property
    def size(self) -> int:
        return int(self.offsets[-1])

    def _map(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if number not in self.maps:
            self.maps[number] = tuple(
                np.memmap(f"{self.folder}/{self.names[number]}.{kind}", np.int64, "r")
                for kind in ("hash", "count")
            )
        return self.maps[number]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, count) of hashes in ascending order."""
        number, count = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        cuts = np.append(np.searchsorted(hashes, self.firsts[1:]), len(hashes))
        begin = 0
        for shard, end in enumerate(cuts):
            if end > begin and len(self.names):
                keys, counts = self._map(shard)
                at = np.minimum(np.searchsorted(keys, hashes[begin:end]), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == hashes[begin:end])
                number[begin + hit] = at[hit] + self.offsets[shard]
                count[begin + hit] = counts[at[hit]]
            begin = end
        return number, count


def count_words(docs: DataFrame, folder: str) -> Vocabulary:
    """Count all tokens of ``docs`` and write them as sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, size = Hasher(), [], 0

        def counted() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], names=["h", "n"])

        for _, data, offsets in slices(batches):
            found, _ = tokens(data, offsets, hasher)
            held.append(found)
            size += len(found)
            if size >= GATHER:
                yield counted()
                held.clear()
                size = 0
        if held:
            yield counted()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, first, total, texts = f"words-{uuid.uuid4().hex}", 0, None, 0, 0
        paths = [f"{folder}/{name}.{kind}" for kind in ("hash", "count")]
        with open(paths[0], "wb") as hashes, open(paths[1], "wb") as counts:
            for batch in batches:
                h, n = (batch.column(c).to_numpy() for c in ("h", "n"))
                if not len(h):
                    continue
                first = int(h[0]) if first is None else first
                h.tofile(hashes)
                n.tofile(counts)
                size += len(h)
                total += int(n.sum())
                texts += int(n[h == np.int64(END)].sum())
        if size:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (name, first, size, total, texts)],
                names=["name", "first", "size", "total", "texts"],
            )
        else:
            for path in paths:
                os.unlink(path)

    counts = docs.select("text").mapInArrow(run, "h long, n long")
    counts = counts.groupBy("h").agg(F.sum("n").alias("n"))
    # Each attempt writes a file of its own name; only the names that the job returns are used.
    ranged = counts.repartitionByRange("h").sortWithinPartitions("h")
    files = ranged.mapInArrow(write, "name string, first long, size long, total long, texts long")
    listed = sorted(files.collect(), key=lambda r: r["first"])
    return Vocabulary(
        folder,
        [r["name"] for r in listed],
        np.array([r["first"] for r in listed], np.int64),
        np.cumsum([0, *(r["size"] for r in listed)]),
        sum(r["total"] for r in listed),
        sum(r["texts"] for r in listed),
    )


def shard_of(context: np.ndarray, word: np.ndarray, times: np.ndarray, shards: int, total: int) -> np.ndarray:
    """The file of a bigram. A context's bigrams lie in one file, a frequent context's in several."""
    spread = np.uint64(1) + (times.astype(np.uint64) * np.uint64(2 * shards)) // np.uint64(max(total, 1))
    part = mix(word.astype(np.uint64) + np.uint64(7)) % spread
    return ((mix(context.astype(np.uint64)) + part) % np.uint64(shards)).astype(np.int64)


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), codec=_CODEC, asbytes=True)


def _unpack(blob: bytes, size: int, dtype: type) -> np.ndarray:
    raw = pa.decompress(blob, size * np.dtype(dtype).itemsize, codec=_CODEC, asbytes=True)
    return np.frombuffer(raw, dtype)


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.add.reduceat(counts, at)


_BLOBS = "shard int, size int, contexts binary, words binary, counts binary"
_SUMS = "kind string, block long, size int, numbers binary, values binary"


def _bigrams(docs: DataFrame, words: Vocabulary, shards: int) -> DataFrame:
    """Blobs of counted bigrams by shard; within a blob sorted by context and word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, hasher, held, size = words, Hasher(), [], 0
        start = np.uint64(vocabulary.size)

        def counted() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            context, word = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
            own, back = np.unique(context, return_inverse=True)
            times = np.zeros(len(own), np.int64)
            for shard in range(len(vocabulary.names)):
                low, high = vocabulary.offsets[shard], vocabulary.offsets[shard + 1]
                a, b = np.searchsorted(own, [np.uint64(low), np.uint64(high)])
                if b > a:
                    times[a:b] = vocabulary._map(shard)[1][(own[a:b] - np.uint64(low)).astype(np.int64)]
            times[own == start] = vocabulary.texts
            shard = shard_of(context, word, times[back], shards, vocabulary.total)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            rows = []
            for number in np.flatnonzero(np.diff(cuts)):
                own = order[cuts[number] : cuts[number + 1]]
                own_context = context[own].astype(np.uint32)
                steps = np.diff(own_context, prepend=np.uint32(0))
                rows.append(
                    (
                        int(number),
                        len(own),
                        _pack(steps),
                        _pack(word[own].astype(np.uint32)),
                        _pack(counts[own].astype(np.uint32)),
                    )
                )
            columns = list(zip(*rows))
            types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)],
                names=["shard", "size", "contexts", "words", "counts"],
            )

        for _, data, offsets in slices(batches):
            hashes, first = tokens(data, offsets, hasher)
            unique, back = np.unique(hashes, return_inverse=True)
            number = vocabulary.find(unique)[0][back].astype(np.uint64)
            context = np.empty(len(number), np.uint64)
            context[1:] = number[:-1]
            context[first[:-1]] = start
            held.append((context << np.uint64(32)) | number)
            size += len(number)
            if size >= GATHER:
                yield counted()
                held.clear()
                size = 0
        if held:
            yield counted()

    return docs.select("text").mapInArrow(run, _BLOBS)


def _by_block(kind: str, numbers: np.ndarray, values: np.ndarray) -> list[tuple]:
    """Rows of numbers (ascending) and values, cut where a block of numbers ends."""
    if not len(numbers):
        return []
    block = numbers // BLOCK
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    rows = []
    for a, b in zip(cuts, np.append(cuts[1:], len(numbers))):
        inner = (numbers[a:b] - block[a] * BLOCK).astype(np.uint32)
        rows.append((kind, int(block[a]), b - a, _pack(inner), _pack(values[a:b].astype(np.uint64))))
    return rows


def _sum_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types)],
        names=["kind", "block", "size", "numbers", "values"],
    )


def _write_shards(folder: str):
    """Merge the blobs of each shard, write its arrays, and pass on sums by context and by word."""

    def finished(shard: int, parts: list) -> pa.RecordBatch:
        keys = np.concatenate([p[0] for p in parts])
        counts = np.concatenate([p[1] for p in parts])
        keys, counts = _merge(keys, counts)
        _write(folder, f"bigrams-{shard}.key", keys)
        _write(folder, f"bigrams-{shard}.count", counts.astype(np.uint32))
        context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        at = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
        own = context[at]
        rows = _by_block("total", own, np.add.reduceat(counts, at))
        for times in (1, 2, 3):
            flags = (counts == times) if times < 3 else (counts >= 3)
            rows += _by_block(f"n{times}", own, np.add.reduceat(flags.astype(np.int64), at))
        values, behind = np.unique(word, return_counts=True)
        rows += _by_block("behind", values, behind)
        often = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5]
        rows.append(("often", -1, 4, _pack(np.arange(4, dtype=np.uint32)), _pack(often.astype(np.uint64))))
        return _sum_rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard and parts:
                    yield finished(shard, parts)
                    parts = []
                shard, size = row["shard"], row["size"]
                context = np.cumsum(_unpack(row["contexts"], size, np.uint32), dtype=np.uint32)
                word = _unpack(row["words"], size, np.uint32)
                keys = (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)
                parts.append((keys, _unpack(row["counts"], size, np.uint32).astype(np.int64)))
        if parts:
            yield finished(shard, parts)

    return run


def _write_blocks(folder: str):
    """Add up the sums of each block and write them as plain arrays by word number."""

    def finished(kind: str, block: int, sums: np.ndarray) -> pa.RecordBatch:
        if block >= 0:
            _write(folder, f"{kind}-{block}", sums)
        # How many words stand behind one, two, three or four others.
        often = np.bincount(np.minimum(sums, 5), minlength=6)[1:5] if block >= 0 else sums[:4]
        listed = [kind, block, int(sums.sum()), int((sums > 2).sum()), *(int(x) for x in often)]
        names = ["kind", "block", "total", "more", "n1", "n2", "n3", "n4"]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in listed], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                key = row["kind"], row["block"]
                if key != now:
                    if now:
                        yield finished(*now, sums)
                    now, sums = key, np.zeros(BLOCK, np.int64)
                numbers = _unpack(row["numbers"], row["size"], np.uint32)
                sums[numbers] += _unpack(row["values"], row["size"], np.uint64).astype(np.int64)
        if now:
            yield finished(*now, sums)

    return run


def discounts(n: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many n-grams occur 1 to 4 times.

    Where a corpus is too small for the estimate, half an occurrence is taken off.
    """
    found = [0.0]
    share = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    for times in (1, 2, 3):
        here, more = n[times - 1], n[times]
        value = times - (times + 1) * share * more / here if here and share else 0.5
        found.append(value if 0 < value < times else 0.5)
    return np.array(found)


@dataclass
class Model:
    words: Vocabulary
    shards: int
    bigram: np.ndarray
    unigram: np.ndarray
    pairs: int
    left: float
    maps: dict = field(default_factory=dict)

    def _map(self, name: str, dtype: type) -> np.ndarray:
        if name not in self.maps:
            self.maps[name] = np.memmap(f"{self.words.folder}/{name}", dtype, "r")
        return self.maps[name]

    def sums(self, kind: str, numbers: np.ndarray) -> np.ndarray:
        """Statistics of words, by ascending number."""
        found = np.zeros(len(numbers))
        block = numbers // BLOCK
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(numbers))):
            name = f"{kind}-{block[a]}"
            if name in self.maps or os.path.exists(f"{self.words.folder}/{name}"):
                found[a:b] = self._map(name, np.int64)[numbers[a:b] % BLOCK]
        return found

    def counts(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Counts of bigrams in ascending order of their keys."""
        found = np.zeros(len(keys))
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for number in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[number] : cuts[number + 1]]
            name = f"bigrams-{number}"
            if f"{name}.key" not in self.maps and not os.path.exists(f"{self.words.folder}/{name}.key"):
                continue
            known = self._map(f"{name}.key", np.uint64)
            at = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
            hit = np.flatnonzero(known[at] == keys[own])
            found[own[hit]] = self._map(f"{name}.count", np.uint32)[at[hit]]
        return found

    def score(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(log10 probability, known tokens, base score) of each text."""
        words, n_docs = self.words, len(first) - 1
        unique, back = np.unique(hashes, return_inverse=True)
        number, count = words.find(unique)
        known = number >= 0
        base = np.log10(count + 0.5) - np.log10(words.total + 0.5 * (words.size + 1))

        # Numbers ascend with the hashes, so the known ones are in order.
        own = number[known]
        chance = np.full(len(unique), 0.0)
        behind = self.sums("behind", own)
        chance[known] = behind - self.unigram[np.minimum(behind, 3).astype(np.int64)]
        uniform = 1 / (words.size + 1)
        chance = np.maximum(chance, 0) / self.pairs + self.left * uniform if self.pairs else np.full(len(unique), uniform)

        # Contexts: every word, and the start of a text as one more.
        total = np.zeros(len(unique) + 1)
        held = np.zeros(len(unique) + 1)
        places = np.append(np.flatnonzero(known), len(unique))
        numbers = np.append(own, words.size)
        total[places] = self.sums("total", numbers)
        for times in (1, 2, 3):
            held[places] += self.bigram[times] * self.sums(f"n{times}", numbers)
        times = np.append(count, words.texts)
        number = np.append(number, words.size)

        context = np.empty(len(back), np.int64)
        context[1:] = back[:-1]
        context[first[:-1]] = len(unique)
        seen = np.flatnonzero((number[context] >= 0) & (number[back] >= 0))
        keys = (number[context[seen]].astype(np.uint64) << np.uint64(32)) | number[back[seen]].astype(np.uint64)
        keys, at, again = np.unique(keys, return_index=True, return_inverse=True)
        source = context[seen[at]]
        shard = shard_of(
            number[source], number[back[seen[at]]], times[source], self.shards, words.total
        )
        pair = np.zeros(len(back))
        pair[seen] = self.counts(keys, shard)[again]

        all_ = total[context]
        backed = np.where(all_ > 0, held[context] / np.maximum(all_, 1), 1.0)
        direct = np.maximum(pair - self.bigram[np.minimum(pair, 3).astype(np.int64)], 0) / np.maximum(all_, 1)
        logs = np.log10(direct + backed * chance[back])
        doc = np.repeat(np.arange(n_docs), np.diff(first))
        return (
            np.bincount(doc, weights=logs, minlength=n_docs),
            np.bincount(doc, weights=known[back], minlength=n_docs).astype(np.int64),
            np.bincount(doc, weights=base[back], minlength=n_docs),
        )


def train(docs: DataFrame) -> Model:
    """Count all of ``docs`` (``text``) and write the model to the shared folder."""
    spark = docs.sparkSession
    uri = scratch_path(spark, "model")
    folder = local_folder(uri)
    os.makedirs(folder, exist_ok=True)
    words = count_words(docs, folder)
    if words.size >= 1 << 32:
        raise ValueError("more than 2**32 distinct words do not fit the keys of bigrams")
    shards = max(4, -(-words.total // SHARD_TOKENS))
    blobs = _bigrams(docs, words, shards).repartitionById(shards, F.col("shard").cast("int"))
    blobs = blobs.sortWithinPartitions("shard")
    sums = staged(blobs.mapInArrow(_write_shards(folder), _SUMS), "sums")
    blocks = sums.repartition("kind", "block").sortWithinPartitions("kind", "block")
    schema = "kind string, block long, total long, more long, n1 long, n2 long, n3 long, n4 long"
    listed = staged(blocks.mapInArrow(_write_blocks(folder), schema), "blocks")
    kinds = {
        r["kind"]: r
        for r in listed.groupBy("kind")
        .agg(*[F.sum(c).alias(c) for c in ("total", "more", "n1", "n2", "n3", "n4")])
        .collect()
    }
    often = [kinds["often"][f"n{i}"] for i in range(1, 5)] if "often" in kinds else [0] * 4
    bigram = discounts(often)
    pairs, left, unigram = 0, 1.0, discounts([0] * 4)
    if "behind" in kinds:
        behind = kinds["behind"]
        unigram = discounts([behind[f"n{i}"] for i in range(1, 5)])
        pairs = behind["total"]
        left = (
            unigram[1] * behind["n1"] + unigram[2] * behind["n2"] + unigram[3] * behind["more"]
        ) / pairs
    return Model(words, shards, bigram, unigram, pairs, left)


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``score`` is the log10 probability of the text; its perplexity is ``10 ** (-score / n_tokens)``.
    Null and empty texts are one token, the end. Without training texts every token is unknown
    and equally likely, so all scores are 0. Repeated rows count and are scored each on their own.
    """
    marked = docs.select("doc_id", held_out("doc_id", FOLD).alias("held_out"), "text")
    model = train(marked.where(~F.col("held_out")))
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            *T.StructType.fromDDL(
                "held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double"
            ),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, fitted = Hasher(), model
        for rows, data, offsets in slices(batches):
            hashes, first = tokens(data, offsets, hasher)
            score, known, base = fitted.score(hashes, first)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("held_out"),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(known),
                    pa.array(np.full(rows.num_rows, fitted.words.total, np.int64)),
                    pa.array(base),
                    pa.array(score),
                ],
                names=schema.fieldNames(),
            )

    return marked.mapInArrow(run, schema)
