"""Benchmark passages in documents, found by a prefix-filtered set join and verified word by word.

A window is 13 consecutive words of a benchmark item, or all words of a shorter item. A document can
hold a window only if it holds each of the window's shingles, so it is enough to look for one of
them: shingles are ordered by how often they occur in the corpus, and the prefix of that order that
exact containment needs is its first, the rarest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.tables import bitmap, fresh, staged
from orbitlake.llm.text import LOWER, WORD_BYTES, Hasher, marked, ngrams, slices, word_spans

WINDOW = 13
SHINGLE = 5
#: Bits of the bitmap that tells tasks which shingles to look for; 2 MB, whatever the tables' size.
BITMAP_BITS = 1 << 24
#: A document is contaminated from one hit word in so many.
HIT_SHARE = 20

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text as an array; A-Z are lower-cased first."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(f"({_WORD})"), F.lit(1))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(item_id, window, len) of all distinct windows; items without words have none."""
    listed = items.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)))
    one = listed.select("item_id", "w", F.explode(starts).alias("s"))
    one = one.select("item_id", F.slice("w", F.col("s") + 1, WINDOW).alias("w"))
    return one.select(
        "item_id", F.array_join("w", " ").alias("window"), F.size("w").alias("len")
    ).distinct()


def _shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, len, offset, shingle) of every shingle of every window."""
    hasher = Hasher()
    for rows, data, offsets in slices(batches, "window"):
        starts, ends, first = word_spans(data, offsets, WORD_BYTES)
        hasher.load(data)
        hashes = hasher.ranges(starts, ends)
        lens = np.diff(first)
        for size in range(1, SHINGLE + 1):
            grams, at = ngrams(hashes, first, size)
            row = np.searchsorted(first, at, "right") - 1
            # An item of fewer words than a shingle is one shingle of its own size.
            fits = np.minimum(lens[row], SHINGLE) == size
            grams, at, row = grams[fits], at[fits], row[fits]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("window").take(pa.array(row)).cast(pa.string()),
                    pa.array(lens[row].astype(np.int32)),
                    pa.array((at - first[row]).astype(np.int32)),
                    pa.array(grams.view(np.int64)),
                ],
                names=["window", "len", "offset", "shingle"],
            )


def shingle_counts(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """(shingle, n): how often the corpus holds each shingle marked in the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, marks = Hasher(), shared.value
        for _, data, offsets in slices(batches):
            data = LOWER[data]
            starts, ends, first = word_spans(data, offsets, WORD_BYTES)
            hasher.load(data)
            hashes = hasher.ranges(starts, ends)
            found = [ngrams(hashes, first, size)[0] for size in sizes]
            grams = np.concatenate([g[marked(g, marks)] for g in found])
            values, counts = np.unique(grams, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))],
                names=["shingle", "n"],
            )

    counted = docs.select("text").mapInArrow(run, "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n"))


def prefix_places(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """(doc_id, row, n_words, at, shingle, ahead, words): where documents hold marked shingles.

    ``words`` are the words around the place that any window through it could cover, ``ahead`` how
    many of them precede it. Every document has one row without a shingle that carries its size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    around = WINDOW - 1
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            *T.StructType.fromDDL(
                "row string, n_words long, at long, shingle long, ahead int, words string"
            ),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, marks = Hasher(), shared.value
        for rows, data, offsets in slices(batches):
            data = LOWER[data]
            starts, ends, first = word_spans(data, offsets, WORD_BYTES)
            hasher.load(data)
            hashes = hasher.ranges(starts, ends)
            places, grams = [], []
            for size in sizes:
                found, at = ngrams(hashes, first, size)
                near = marked(found, marks)
                places.append(at[near])
                grams.append(found[near])
            place, gram = np.concatenate(places), np.concatenate(grams)
            doc = np.searchsorted(first, place, "right") - 1
            left = np.maximum(place - around, first[doc])
            right = np.minimum(place + around + SHINGLE, first[doc + 1])
            raw = data.tobytes()
            # Separators of a document are never word bytes, so splitting them again is exact.
            context = [
                b" ".join(raw[a:b] for a, b in zip(starts[i:j].tolist(), ends[i:j].tolist()))
                for i, j in zip(left.tolist(), right.tolist())
            ]
            counts = np.diff(first)
            every = np.arange(len(counts))
            index = np.concatenate([every, doc])
            blank = pa.nulls(len(every), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(index)),
                    rows.column("row").take(pa.array(index)),
                    pa.array(counts[index].astype(np.int64)),
                    pa.chunked_array([blank, pa.array(place - first[doc])]).combine_chunks(),
                    pa.chunked_array([blank, pa.array(gram.view(np.int64))]).combine_chunks(),
                    pa.chunked_array(
                        [blank.cast(pa.int32()), pa.array((place - left).astype(np.int32))]
                    ).combine_chunks(),
                    pa.chunked_array(
                        [pa.nulls(len(every), pa.string()), pa.array(context, pa.binary()).cast(pa.string())]
                    ).combine_chunks(),
                ],
                names=schema.fieldNames(),
            )

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, items: DataFrame, digest: bool = True) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document.

    A null or empty text has no words and is clean; so is everything when the benchmark is empty.
    Words under an item without an id are hit, but it is neither counted nor listed.
    Rows that repeat a doc_id and text are judged once each, with equal results; rows with one
    doc_id and different texts are judged on their own texts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", "text", F.sha2(text, 256).alias("row"))
    windows = staged(benchmark_windows(items), "windows")
    shingles = windows.select("window").distinct().mapInArrow(
        _shingles_of, "window string, len int, offset int, shingle long"
    )
    shingles = staged(shingles, "shingles")
    sizes = sorted(r[0] for r in shingles.select(F.least("len", F.lit(SHINGLE))).distinct().collect())
    if not sizes:
        sizes = [SHINGLE]
    counts = shingle_counts(slim, bitmap(shingles, "shingle", BITMAP_BITS), sizes)
    ranked = shingles.join(counts, "shingle", "left")
    # The order by rarity; a shingle that no document holds comes first and ends the search.
    rarest = ranked.groupBy("window", "len").agg(
        F.min(
            F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("shingle"), F.col("offset"))
        ).alias("least")
    )
    prefix = rarest.where("least.n > 0").select(
        "window", "len", F.col("least.shingle").alias("shingle"), F.col("least.offset").alias("offset")
    )
    prefix = staged(prefix, "prefix")
    places = staged(prefix_places(slim, bitmap(prefix, "shingle", BITMAP_BITS), sizes), "places")

    near = places.where("shingle is not null").join(prefix, "shingle")
    start = F.col("at") - F.col("offset")
    near = near.withColumn("start", start).where(
        (F.col("start") >= 0)
        & (F.col("start") + F.col("len") <= F.col("n_words"))
        & (F.col("offset") <= F.col("ahead"))
    )
    skip = F.greatest(F.col("ahead") - F.col("offset") + 1, F.lit(1))
    held = F.slice(F.split("words", " "), skip, F.col("len"))
    hits = near.where(F.array_join(held, " ") == F.col("window"))
    hits = staged(
        hits.select("doc_id", "row", "start", "len", "window").distinct(), "hits"
    )

    key = ["doc_id", "row"]
    # Words covered: every hit counts what lies beyond all hits that start before it. A document
    # has at most as many hits as words.
    stop = F.col("start") + F.col("len")
    spans = hits.groupBy(*key, "start").agg(F.max(stop).alias("stop"))
    spans = spans.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("until")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["stop"] - F.greatest(s["start"], acc["until"]), F.lit(0))).alias("n"),
            F.greatest(acc["until"], s["stop"]).alias("until"),
        ),
    )["n"]
    spans = spans.select(*key, covered.alias("n_hit"))
    named = hits.select(*key, "window").distinct().join(windows.select("window", "item_id"), "window")
    named = named.select(*key, F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(
        # An item without an id hits like any other, but has no name to list or count.
        F.count("item").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))
    found = spans.join(named, same).select("_id", "_row", "n_hit", "n_items", "items_sha256")
    found = staged(found, "contaminated")
    sized = places.where("shingle is null").select("doc_id", "row", "n_words")
    judged = sized.join(found, same, "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return judged.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * HIT_SHARE >= F.col("n_words"))).alias("contaminated"),
        *([] if digest else ["row"]),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones; all columns are kept."""
    bad = contamination(docs, items, digest=False).where("contaminated")
    own, row = fresh("_id", docs), fresh("_row", docs)
    bad = staged(bad.select(F.col("doc_id").alias(own), F.col("row").alias(row)).distinct(), "bad")
    text = F.coalesce(F.col("text"), F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.sha2(text, 256) == F.col(row))
    return docs.join(bad, same, "left_anti")
