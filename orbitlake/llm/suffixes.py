"""Remove passages that repeat across or within documents: every byte under a repeated 200-byte string.

A string of 200 bytes holds 151 strings of 50 bytes; the one with the smallest hash (the last of
equals) is its anchor, and equal strings have equal anchors at equal places. So documents are cut to
segments around their anchors, 150 bytes before to 200 after, and only segments of one anchor can
share a string, at one and the same column of the segment.

The segments of an anchor are a collection of short documents whose Burrows-Wheeler transform is
built column by column from the right: each round inserts one symbol per segment, which sorts the
segments stably by that symbol, and updates the common prefixes of neighbours. As equal strings
stand in equal columns, a round needs the transform of the column before and no other: the columns
lie in one file that is read once, backwards, and a round's order and prefixes replace the last.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.tables import bitmap, fresh, staged
from orbitlake.llm.text import Hasher, marked, mix, slices

LENGTH = 200
ANCHOR = 50
REACH = LENGTH - ANCHOR
WIDTH = REACH + LENGTH
#: Bits of the two bitmaps sent to the tasks, 8 MB each; a wrong hit costs a look, never a result.
BITMAP_BITS = 1 << 26
#: Distinct segments of one anchor that one task compares; more are compared in chunks whose
#: remaining strings meet in a join.
CHUNK = 1 << 14
#: Segments that are sorted together; bounds a task's memory.
BATCH = 1 << 14
#: Slots in which a task remembers segments whose bytes it has passed on.
PASSED = 1 << 18

_POSITION = np.uint64((1 << 30) - 1)


def anchors(hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, document, bytes before, bytes after, hash, segment hash) of a slice's anchors."""
    hasher.load(data)
    count = len(data) - LENGTH + 1
    if count <= 0:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    begin = np.arange(len(data) - ANCHOR + 1)
    rolled = (hasher.sums[ANCHOR:] - hasher.sums[:-ANCHOR]) * hasher.inverses[: len(begin)]
    hashes = mix(rolled)
    # The smallest hash of every window: low bits hold the place, so that the last of equals wins.
    low = (hashes & ~_POSITION) | (_POSITION - begin.astype(np.uint64))
    span, least = 1, low
    while span * 2 <= REACH + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = REACH + 1 - span
    least = np.minimum(least[: len(least) - rest], least[rest:])[:count]
    room = np.repeat(offsets[1:], np.diff(offsets))[:count] - np.arange(count)
    chosen = (_POSITION - (least[room >= LENGTH] & _POSITION)).astype(np.int64)
    place = np.unique(chosen)
    doc = np.searchsorted(offsets, place, "right") - 1
    before = np.minimum(place - offsets[doc], REACH)
    after = np.minimum(offsets[doc + 1] - place, LENGTH)
    whole = hasher.ranges(place - before, place + after)
    return place, doc, before, after, hashes[place], mix(whole + before.astype(np.uint64))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def anchor_counts(docs: DataFrame) -> DataFrame:
    """(anchor, segments, places): distinct segments and places of all anchors with two or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for _, data, offsets in slices(batches):
            *_, anchor, segment = anchors(hasher, data, offsets)
            order = np.lexsort((segment, anchor))
            anchor, segment = anchor[order], segment[order]
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(anchor)))
            yield pa.RecordBatch.from_arrays(
                [_signed(anchor[at]), _signed(segment[at]), pa.array(counts.astype(np.int64))],
                names=["anchor", "segment", "n"],
            )

    pairs = docs.select("text").mapInArrow(run, "anchor long, segment long, n long")
    pairs = pairs.groupBy("anchor", "segment").agg(F.sum("n").alias("n"))
    return (
        pairs.groupBy("anchor")
        .agg(F.count("*").alias("segments"), F.sum("n").alias("places"))
        .where("places > 1")
    )


def repeated_places(docs: DataFrame, repeated: np.ndarray, mixed: np.ndarray) -> DataFrame:
    """(digest, place, before, after, anchor, segment, bytes) of the places of repeated anchors.

    ``bytes`` is there for anchors whose segments differ, and left out where the task remembers that
    it has passed the segment on: a segment that many documents share travels about once per task.
    """
    sent = docs.sparkSession.sparkContext.broadcast((repeated, mixed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        # No slot holds a key of its own at first.
        passed = np.arange(1, PASSED + 1, dtype=np.uint64)
        for rows, data, offsets in slices(batches):
            place, doc, before, after, anchor, segment = anchors(hasher, data, offsets)
            seen = np.flatnonzero(marked(anchor, sent.value[0]))
            place, doc, before, after, anchor, segment = (
                x[seen] for x in (place, doc, before, after, anchor, segment)
            )
            carried = np.zeros(len(place), bool)
            carried[np.unique(segment ^ mix(anchor), return_index=True)[1]] = True
            carried &= marked(anchor, sent.value[1])
            first = np.flatnonzero(carried)
            key = segment[first] ^ mix(anchor[first])
            slot = (key & np.uint64(PASSED - 1)).astype(np.int64)
            carried[first[passed[slot] == key]] = False
            passed[slot] = key
            raw = data.tobytes()
            segments = [
                raw[a:b] if take else None
                for a, b, take in zip(
                    (place - before).tolist(), (place + after).tolist(), carried.tolist()
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("digest").take(pa.array(doc)),
                    pa.array(place - offsets[doc]),
                    pa.array(before.astype(np.int16)),
                    pa.array(after.astype(np.int16)),
                    _signed(anchor),
                    _signed(segment),
                    pa.array(segments, pa.binary()),
                ],
                names=["digest", "place", "before", "after", "anchor", "segment", "bytes"],
            )

    schema = (
        "digest binary, place long, before short, after short, anchor long, segment long, bytes binary"
    )
    return docs.select("digest", "text").mapInArrow(run, schema)


def shared_columns(group: np.ndarray, texts: list[bytes], before: np.ndarray) -> np.ndarray:
    """For segments sorted by group: at which of the 151 columns a segment's 200 bytes are shared.

    Returns a matrix of segments x columns; True where another segment of the group has the same
    200 bytes at the same column.
    """
    count = len(texts)
    shared = np.zeros((count, REACH + 1), bool)
    sizes = np.fromiter(map(len, texts), np.int64, count)
    with tempfile.TemporaryFile() as file:
        # One file per batch, column after column; symbol 0 stands beyond a document's ends.
        table = np.zeros((WIDTH, count), np.uint16)
        flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
        starts = np.cumsum(sizes) - sizes
        for row, (at, size, column) in enumerate(
            zip(starts.tolist(), sizes.tolist(), (REACH - before).tolist())
        ):
            table[column : column + size, row] = flat[at : at + size]
        table.tofile(file)
        del table, flat

        order = np.arange(count)
        prefix = np.zeros(count, np.int16)  # common with the segment ahead in the order
        base = group.astype(np.int64) * 257
        for at in range(WIDTH - 1, -1, -1):
            file.seek(at * count * 2)
            symbol = np.fromfile(file, np.uint16, count)[order]
            key = base[order] + symbol
            move = np.argsort(key, kind="stable")
            key = key[move]
            same = np.zeros(count, bool)
            same[1:] = (key[1:] == key[:-1]) & (symbol[move[1:]] != 0)
            fresh_prefix = np.zeros(count, np.int16)
            now = np.flatnonzero(same)
            if len(now):
                # The smallest prefix between two neighbours of the new order in the old one.
                low, high = move[now - 1] + 1, move[now] + 1
                near = high - low == 1
                found = np.empty(len(now), np.int16)
                found[near] = prefix[low[near]]
                if not near.all():
                    pairs = np.stack([low[~near], high[~near]], 1).ravel()
                    padded = np.append(prefix, np.int16(0))
                    found[~near] = np.minimum.reduceat(padded, pairs)[::2]
                fresh_prefix[now] = np.minimum(found + 1, LENGTH)
            order, prefix = order[move], fresh_prefix
            if at <= REACH:
                full = prefix >= LENGTH
                full[:-1] |= full[1:]
                shared[order[full], at] = True
    return shared


def _spans(shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) of the byte ranges under shared columns, relative to the anchor."""
    padded = np.zeros((shared.shape[0], shared.shape[1] + 2), np.int8)
    padded[:, 1:-1] = shared
    steps = np.diff(padded, axis=1)
    row, begin = np.nonzero(steps == 1)
    _, end = np.nonzero(steps == -1)
    return row, begin - REACH, end - 1 + LENGTH - REACH


def _match(table: pa.Table) -> pa.Table:
    """Shared byte ranges of complete units sorted by unit; for chunked anchors also what is left.

    ``table`` holds each segment of a unit once. A row with ``window`` is one 200-byte string of a chunk: with its segment where the chunk holds
    it once, without where it holds it more often.
    """
    unit, anchor, segment, chunks = (
        table.column(c).to_numpy() for c in ("unit", "anchor", "segment", "chunks")
    )
    group = np.cumsum(np.append(0, unit[1:] != unit[:-1]))
    sizes = np.bincount(group)
    keep = np.flatnonzero((sizes[group] > 1) | (chunks > 1))
    if not len(keep):
        return None
    group, anchor, segment, chunks = group[keep], anchor[keep], segment[keep], chunks[keep]
    group = np.cumsum(np.append(0, group[1:] != group[:-1]))
    table = table.take(keep)
    texts = table.column("bytes").to_pylist()
    before = table.column("before").to_numpy().astype(np.int64)
    shared = shared_columns(group, texts, before)
    row, begin, end = _spans(shared)
    parts = [
        pa.table(
            {
                "anchor": anchor[row],
                "segment": pa.array(segment[row]),
                "begin": begin.astype(np.int16),
                "end": end.astype(np.int16),
                "window": pa.nulls(len(row), pa.int64()),
                "n": np.ones(len(row), np.int64),
            }
        )
    ]
    many = np.flatnonzero(chunks > 1)
    if len(many):
        data = np.frombuffer(b"".join(texts[i] for i in many), np.uint8)
        sizes = np.array([len(texts[i]) for i in many])
        starts = np.cumsum(sizes) - sizes
        hasher = Hasher()
        hasher.load(data)
        for column in range(REACH + 1):
            begin = column - REACH + before[many]
            fits = np.flatnonzero((begin >= 0) & (begin + LENGTH <= sizes))
            if not len(fits):
                continue
            rows, at = many[fits], starts[fits] + begin[fits]
            window = mix(hasher.ranges(at, at + LENGTH) + np.uint64(column))
            alone = ~shared[rows, column]
            first = np.unique(np.stack([anchor[rows].view(np.uint64), window], 1)[~alone], axis=0)
            for a, w, s, n in (
                (anchor[rows[alone]], window[alone], pa.array(segment[rows[alone]]), 1),
                (first[:, 0].view(np.int64), first[:, 1], pa.nulls(len(first), pa.int64()), 2),
            ):
                parts.append(
                    pa.table(
                        {
                            "anchor": np.ascontiguousarray(a),
                            "segment": s,
                            "begin": np.full(len(a), column - REACH, np.int16),
                            "end": np.full(len(a), column - REACH + LENGTH, np.int16),
                            "window": np.ascontiguousarray(w).view(np.int64),
                            "n": np.full(len(a), n, np.int64),
                        }
                    )
                )
    return pa.concat_tables(parts)


def _once(*keys: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by two keys without those that repeat the row ahead of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (batch.column(c).to_numpy() for c in keys)
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            new[0] = (one[0], two[0]) != last
            last = one[-1], two[-1]
            if new.any():
                yield batch.filter(pa.array(new))

    return run


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < BATCH:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        unit = table.column("unit").to_numpy()
        cut = int(np.searchsorted(unit, unit[-1]))
        if cut:
            found = _match(table.slice(0, cut))
            if found is not None:
                yield from found.to_batches(max_chunksize=100_000)
        rest = table.slice(cut)
        held, rows = rest.to_batches(), rest.num_rows
    if held:
        found = _match(pa.Table.from_batches(held).combine_chunks())
        if found is not None:
            yield from found.to_batches(max_chunksize=100_000)


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(digest, spans): the byte ranges to remove from each text, by the text's digest.

    ``docs`` holds ``digest`` and ``text``, one row per document. Ranges may overlap; texts without
    any are not listed.
    """
    heads = staged(anchor_counts(docs), "anchors")
    repeated = bitmap(heads, "anchor", BITMAP_BITS)
    mixed = bitmap(heads.where("segments > 1"), "anchor", BITMAP_BITS)
    places = staged(repeated_places(docs, repeated, mixed), "places")

    # Segments that occur twice as a whole are covered whole.
    whole = places.groupBy("anchor", "segment").agg(F.count("*").alias("n")).where("n > 1")
    whole = whole.select(
        "anchor",
        "segment",
        F.lit(-REACH).cast("short").alias("begin"),
        F.lit(LENGTH).cast("short").alias("end"),
    )

    many = heads.where(F.col("segments") > CHUNK)
    many = many.select("anchor", F.ceil(F.col("segments") / CHUNK).cast("int").alias("chunks"))
    # Tasks that hold a shared segment have each passed it on: one copy of it goes to its unit.
    once = places.where("bytes is not null").select("anchor", "segment", "before", "bytes")
    once = once.repartition("anchor", "segment").sortWithinPartitions("anchor", "segment")
    once = once.mapInArrow(_once("anchor", "segment"), once.schema)
    listed = once.join(many, "anchor", "left")
    chunks = F.coalesce("chunks", F.lit(1))
    listed = listed.select(
        F.xxhash64("anchor", F.pmod("segment", chunks)).alias("unit"),
        "anchor",
        "segment",
        "before",
        chunks.alias("chunks"),
        "bytes",
    )
    listed = listed.repartition("unit").sortWithinPartitions("unit", "segment")
    found = listed.mapInArrow(
        _matches, "anchor long, segment long, begin short, end short, window long, n long"
    )
    found = staged(found, "matches")
    alone = found.where("window is not null")
    windows = alone.groupBy("anchor", "begin", "window").agg(F.sum("n").alias("total"))
    across = alone.where("segment is not null").join(
        windows.where("total > 1"), ["anchor", "begin", "window"]
    )
    cover = ["anchor", "segment", "begin", "end"]
    marks = whole.union(found.where("window is null").select(cover)).union(across.select(cover))

    spans = places.drop("bytes").join(marks, ["anchor", "segment"])
    spans = spans.select(
        "digest",
        (F.col("place") + F.greatest("begin", -F.col("before"))).cast("long").alias("start"),
        (F.col("place") + F.least("end", "after")).cast("long").alias("stop"),
    )
    # Rows of one text repeat its places; the longest range from each start says all.
    spans = spans.groupBy("digest", "start").agg(F.max("stop").alias("stop"))
    return spans.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs under sorted, possibly overlapping ranges; ranges that touch are one run."""
    runs: list[tuple[int, int]] = []
    for span in spans or ():
        if runs and span["start"] <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], span["stop"])
        else:
            runs.append((span["start"], span["stop"]))
    return runs


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    edges = [0, *(edge for run in runs for edge in run), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _with_spans(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one more column, the ranges to remove; its name is returned too."""
    digest, spans, of = (fresh(name, docs) for name in ("_digest", "_spans", "_of"))
    marked = docs.withColumn(digest, text_digest(F.col("text")))
    ranges = repeated_ranges(marked.select(F.col(digest).alias("digest"), "text"))
    ranges = staged(ranges, "ranges").select(
        F.col("digest").alias(of), F.col("spans").alias(spans)
    )
    joined = marked.join(ranges, F.col(digest) == F.col(of), "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], spans), spans


def removal_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    Null and empty texts, and texts under 200 bytes, lose nothing. Rows that repeat a text count as
    documents of their own, so a text of 200 bytes or more that occurs twice is removed whole.
    """
    joined, spans = _with_spans(docs.select("doc_id", "text"))
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            *T.StructType.fromDDL(
                "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
            ),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.large_binary())
            for text, listed in zip(texts, batch.column(spans)):
                text = text.as_py() or b""
                runs = merged(listed.as_py())
                kept = kept_bytes(text, runs)
                rows.append(
                    (len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
                )
            columns = [pa.array(list(c)) for c in zip(*rows)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *columns], names=schema.fieldNames()
                )

    return joined.mapInArrow(run, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; all rows and columns stay.

    A character that loses one of its bytes goes as a whole. ``n_chars``, if there, is the new
    length. Texts that lose nothing are unchanged, null included.
    """
    joined, spans = _with_spans(docs)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes = [], []
            source = batch.column("text").cast(pa.large_binary())
            for text, listed in zip(source, batch.column(spans)):
                kept = text.as_py()
                if listed.is_valid and kept is not None:
                    kept = kept_bytes(kept, merged(listed.as_py()))
                text = None if kept is None else kept.decode("utf-8", "ignore")
                texts.append(text)
                sizes.append(None if text is None else len(text))
            columns = []
            for field in batch.schema:
                if field.name == "text":
                    columns.append(pa.array(texts, pa.string()))
                elif field.name == "n_chars" and pa.types.is_integer(field.type):
                    columns.append(pa.array(sizes, field.type))
                elif field.name != spans:
                    columns.append(batch.column(field.name))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return joined.mapInArrow(run, schema)
