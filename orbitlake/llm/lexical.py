"""Ranked lexical search: posting lists cut to blocks of similar documents, with maximum summaries.

The index holds, for each document, its terms that any item asks for, and their counts; documents
with like terms stand next to each other. A task takes a few thousand of them at a time. The
posting list of a term is clustered there: some of its documents stand for blocks, each document
joins the one it is most similar to, and a block's summary holds the largest impact of each term.
An item's weights times a summary bound the score of every document of the block from above, in the
same integers as the scores, so a block is passed over only if none of its documents can be among
the best. Documents of the other blocks are scored in full.

A list is not opened at all for an item whose remaining terms cannot reach the score needed. That
score comes from a first round, which scores the lists of each item's heaviest terms only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.tables import bitmap, staged
from orbitlake.llm.text import LOWER, WORD_BYTES, marked, word_slices

TOP = 10
#: Items that are searched together; further items are searched in further rounds over the index.
ITEMS = 1024
#: Documents that a task indexes at a time, and terms of them in all.
SHARD = 8192
ENTRIES = 1 << 22
#: Documents of a block on average, and cells of the matrix that blocks are made in.
BLOCK = 64
CELLS = 1 << 22
#: Heaviest terms of an item whose lists the first round scores.
SEEDS = 3
#: Slots of the bitmap of asked terms; a wrong hit costs space, never a result.
SLOTS = 1 << 22


def term_counts(rows: DataFrame, key: str, asked: np.ndarray | None = None) -> DataFrame:
    """(key, row, n, terms, counts): each text's number of words, distinct terms and their counts.

    ``asked`` is a bitmap of the terms to list. A text that is longer than a slice has a row for
    each piece, whose ``n`` and counts add up; ``row`` is the same in all of them.
    """
    schema = T.StructType(
        [rows.schema[key], *T.StructType.fromDDL("row long, n long, terms array<long>, counts array<long>")]
    )
    sent = rows.sparkSession.sparkContext.broadcast(asked)

    def lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            if texts.offset or not batch.num_rows:
                texts = pa.concat_arrays([texts])
            kind, offsets, data = texts.buffers()
            if data is not None:
                data = pa.py_buffer(LOWER[np.frombuffer(data, np.uint8)])
            texts = pa.Array.from_buffers(pa.large_binary(), len(texts), [kind, offsets, data])
            yield pa.RecordBatch.from_arrays([batch.column(key), texts], names=[key, "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = TaskContext.get().partitionId() << 33, None
        for batch, words, first, _, _ in word_slices(lowered(batches), 0, WORD_BYTES):
            if last is not None and batch is not last:
                number += last.num_rows
            last = batch
            size = np.diff(first)
            doc = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((words, doc))
            words, doc = words[order], doc[order]
            new = np.ones(len(words), bool)
            new[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(words)))
            if sent.value is not None:
                listed = marked(words[at], sent.value)
                at, counts = at[listed], counts[listed]
            cuts = pa.array(np.searchsorted(doc[at], np.arange(len(size) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array(number + np.arange(len(size))),
                    pa.array(size),
                    pa.ListArray.from_arrays(cuts, pa.array(words[at].view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(counts)),
                ],
                names=schema.fieldNames(),
            )

    return rows.select(key, "text").mapInArrow(run, schema)


@dataclass
class Corpus:
    """The index: document vectors, numbers of documents by term, and the corpus totals."""

    vectors: DataFrame
    frequencies: DataFrame
    n_docs: int
    n_words: int


def build(docs: DataFrame, asked: np.ndarray) -> Corpus:
    """Index all documents by the asked terms.

    Pieces of a long text are put together first. The vectors are then dealt by the least hashes of
    their terms, so that like documents meet; equal ones are told apart by their row, which keeps a
    large group of copies from one task.
    """
    parts = staged(term_counts(docs, "doc_id", asked), "lexicalparts")
    long_rows = parts.groupBy("row").count().where("count > 1").select("row")
    split = parts.join(long_rows, "row")
    whole = split.select("doc_id", "row", F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    whole = whole.groupBy("row", F.col("e.terms").alias("term")).agg(F.sum("e.counts").alias("count"))
    whole = whole.groupBy("row").agg(F.collect_list(F.struct("term", "count")).alias("found"))
    sizes = split.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n"))
    whole = sizes.join(whole, "row", "left").select(
        "doc_id",
        "row",
        "n",
        F.coalesce("found.term", F.array().cast("array<long>")).alias("terms"),
        F.coalesce("found.count", F.array().cast("array<long>")).alias("counts"),
    )
    rest = parts.join(long_rows, "row", "left_anti").select(*whole.columns)
    totals = parts.where("n > 0").agg(F.count_distinct("row"), F.sum("n")).first()

    vectors = staged(rest.union(whole), "lexicalrows")
    hashes = F.transform("terms", lambda t: F.xxhash64(t))
    near = vectors.withColumns({"m1": F.array_min(hashes), "m2": F.array_max(hashes)})
    near = near.where(F.size("terms") > 0).repartitionByRange("m1", "m2", "row")
    near = staged(near.sortWithinPartitions("m1", "m2", "row").drop("m1", "m2", "row"), "lexical")
    frequencies = near.select(F.explode("terms").alias("term")).groupBy("term").count()
    return Corpus(near, staged(frequencies, "frequencies"), totals[0], totals[1] or 0)


@dataclass
class Asked:
    """The items of a round: their numbers, and their terms with weights, sorted by item."""

    numbers: np.ndarray
    vocabulary: np.ndarray
    item: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    least: np.ndarray


def prepare_items(corpus: Corpus, terms: DataFrame, rounds: int, turn: int) -> Asked:
    """The items of one round; the driver gets their terms, a bounded number of items at a time."""
    own = terms.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == turn)
    pairs = own.select("row", F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    pairs = pairs.groupBy("row", F.col("e.terms").alias("term")).agg(F.sum("e.counts").alias("times"))
    table = pairs.join(corpus.frequencies, "term").orderBy("row", "term").toArrow()
    row, term, times, df = (table.column(c).to_numpy() for c in ("row", "term", "times", "count"))
    weight = [math.floor(1000 * math.log((2 * corpus.n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
    numbers, item = np.unique(row, return_inverse=True)
    vocabulary, place = np.unique(term, return_inverse=True)
    weight = np.array(weight, np.int64) * times
    return Asked(numbers, vocabulary, item, place, weight, np.ones(len(numbers), np.int64))


def impacts(count: np.ndarray, n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """What a term's occurrences in a document of ``n`` words add for each unit of weight."""
    if len(n) and 75 * int(n.max()) * n_docs >= 1 << 63:
        long = np.array([25 + 75 * int(v) * n_docs // n_words for v in n.tolist()], np.int64)
    else:
        long = 25 + 75 * n * n_docs // n_words
    return 1_000_000_000 * count // (1000 * count + 8 * long)


class Shard:
    """Some thousand documents: their vectors over a round's terms, and its posting lists."""

    def __init__(self, table: pa.Table, asked: Asked, n_docs: int, n_words: int) -> None:
        terms = table.column("terms").combine_chunks()
        flat = terms.flatten().to_numpy()
        count = table.column("counts").combine_chunks().flatten().to_numpy()
        size = np.diff(terms.offsets.to_numpy())
        doc = np.repeat(np.arange(len(size)), size)
        place = np.minimum(np.searchsorted(asked.vocabulary, flat), len(asked.vocabulary) - 1)
        kept = np.flatnonzero(asked.vocabulary[place] == flat)
        self.doc, self.term = doc[kept], place[kept]
        n = table.column("n").to_numpy()[self.doc]
        self.impact = impacts(count[kept], n, n_docs, n_words)
        self.first = np.searchsorted(self.doc, np.arange(len(size) + 1))
        order = np.argsort(self.term, kind="stable")
        self.posting = self.doc[order]
        cuts = np.arange(len(asked.vocabulary) + 1)
        self.list = np.searchsorted(self.term[order], cuts)
        self.most = np.zeros(len(asked.vocabulary), np.int64)
        np.maximum.at(self.most, self.term, self.impact)
        self.asked, self.least = asked, asked.least.copy()
        self.best: dict[int, np.ndarray] = {}

    def matrix(self, docs: np.ndarray, coordinate: np.ndarray, width: int, kind: type) -> np.ndarray:
        """Impacts of documents (rows) on coordinates; terms of coordinate -1 are left out."""
        size = self.first[docs + 1] - self.first[docs]
        row = np.repeat(np.arange(len(docs)), size)
        at = np.repeat(self.first[docs] - (np.cumsum(size) - size), size) + np.arange(len(row))
        column = coordinate[self.term[at]]
        inside = np.flatnonzero(column >= 0)
        cells = np.zeros((len(docs), width), kind)
        cells[row[inside], column[inside]] = self.impact[at[inside]]
        return cells

    def openings(self, seeds: int | None) -> np.ndarray:
        """Which of the items' terms have a list to open, by number of the pair.

        With ``seeds``, those of each item that can add most. Otherwise all but the light ones that
        together stay below the score needed: a document that holds no other term cannot reach it.
        """
        asked = self.asked
        reach = asked.weight * self.most[asked.term]
        order = np.lexsort((reach if seeds is None else -reach, asked.item))
        item = asked.item[order]
        first = np.searchsorted(item, np.arange(len(asked.numbers) + 1))
        if seeds is not None:
            rank = np.arange(len(item)) - first[item]
            return order[(rank < seeds) & (reach[order] > 0)]
        total = np.append(0, np.cumsum(reach[order]))
        upto = total[1:] - total[first[item]]
        return order[(upto >= self.least[item]) & (reach[order] > 0)]

    def search(self, top: int, seeds: int | None) -> None:
        opened = self.openings(seeds)
        if not len(opened):
            return
        asked = self.asked
        # Products of whole numbers below 2^53 are exact in doubles, which are faster.
        reach = np.bincount(asked.item, asked.weight * self.most[asked.term].astype(float))
        kind = np.float64 if reach.max() < 1 << 52 else np.int64
        heavy = np.lexsort((asked.item[opened], asked.term[opened]))
        opened = opened[heavy]
        lists, cuts = np.unique(asked.term[opened], return_index=True)
        cuts = np.append(cuts, len(opened))
        power = np.maximum.reduceat(asked.weight[opened] * self.most[asked.term[opened]], cuts[:-1])
        first = np.searchsorted(asked.item, np.arange(len(asked.numbers) + 1))
        coordinate = np.full(len(asked.vocabulary), -1)
        for number in np.argsort(-power, kind="stable").tolist():
            items = asked.item[opened[cuts[number] : cuts[number + 1]]]
            pairs = np.concatenate([np.arange(first[i], first[i + 1]) for i in items.tolist()])
            terms = np.unique(asked.term[pairs])
            coordinate[terms] = np.arange(len(terms))
            weights = np.zeros((len(terms), len(items)), kind)
            column = np.repeat(np.arange(len(items)), first[items + 1] - first[items])
            weights[coordinate[asked.term[pairs]], column] = asked.weight[pairs]
            docs = self.posting[self.list[lists[number]] : self.list[lists[number] + 1]]
            step = max(BLOCK, CELLS // len(terms))
            for start in range(0, len(docs), step):
                part = docs[start : start + step]
                self.blocks(part, self.matrix(part, coordinate, len(terms), kind), items, weights, top)
            coordinate[terms] = -1

    def blocks(
        self, docs: np.ndarray, cells: np.ndarray, items: np.ndarray, weights: np.ndarray, top: int
    ) -> None:
        """Cluster documents of a list, bound their blocks, and score those that may hold a best one."""
        count = -(-len(docs) // BLOCK)
        block = np.zeros(len(docs), np.int64)
        if count > 1:
            lead = cells[np.arange(count) * len(docs) // count].astype(float)
            lead /= np.maximum(np.linalg.norm(lead, axis=1, keepdims=True), 1)
            block = (cells @ lead.T).argmax(1)
        order = np.argsort(block, kind="stable")
        docs, cells, block = docs[order], cells[order], block[order]
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        summary = np.maximum.reduceat(cells, starts, axis=0)
        bound = summary @ weights
        ends = np.append(starts[1:], len(docs))
        for b in np.argsort(-bound.max(1), kind="stable").tolist():
            alive = np.flatnonzero(bound[b] >= self.least[items])
            if not len(alive):
                continue
            inside = slice(starts[b], ends[b])
            scores = cells[inside] @ weights[:, alive]
            row, column = np.nonzero(scores >= self.least[items[alive]])
            for i in np.unique(column).tolist():
                at = row[column == i]
                found = np.stack([scores[at, i].astype(np.int64), docs[inside][at]], 1)
                self.add(int(items[alive[i]]), found, top)

    def add(self, item: int, found: np.ndarray, top: int) -> None:
        """Keep the best documents of an item, and raise the score that others need."""
        if item in self.best:
            found = np.concatenate([self.best[item], found])
        found = np.unique(found, axis=0)
        # Documents are numbered in the order in which ties are broken.
        found = found[np.lexsort((found[:, 1], -found[:, 0]))][:top]
        self.best[item] = found
        if len(found) == top:
            self.least[item] = max(self.least[item], found[-1, 0])


def best_documents(
    corpus: Corpus, asked: Asked, top: int, seeds: int | None = None
) -> DataFrame:
    """(item, doc_id, score): the best documents of every part of the index for each item."""
    schema = T.StructType(
        [T.StructField("item", T.LongType()), corpus.vectors.schema["doc_id"], T.StructField("score", T.LongType())]
    )
    # Broadcast values are plain arrays: workers need not know this package's classes.
    sent = corpus.vectors.sparkSession.sparkContext.broadcast(tuple(vars(asked).values()))
    n_docs, n_words = corpus.n_docs, corpus.n_words

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows, entries = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.cumsum(np.diff(batch.column("terms").offsets.to_numpy()))
            start = 0
            while start < batch.num_rows:
                ahead = sizes[start - 1] if start else 0
                stop = int(np.searchsorted(sizes, ahead + ENTRIES - entries, "right"))
                stop = min(max(stop, start + (not rows)), start + SHARD - rows, batch.num_rows)
                if stop > start:
                    held.append(batch.slice(start, stop - start))
                    rows += stop - start
                    entries += int(sizes[stop - 1] - ahead)
                    start = stop
                if start < batch.num_rows:
                    yield pa.Table.from_batches(held)
                    held, rows, entries = [], 0, 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in shards(batches):
            table = table.sort_by([("doc_id", "ascending")])
            shard = Shard(table, Asked(*sent.value), n_docs, n_words)
            shard.search(top, seeds)
            if not shard.best:
                continue
            item = np.repeat(list(shard.best), [len(f) for f in shard.best.values()])
            found = np.concatenate(list(shard.best.values()))
            ids = table.column("doc_id").combine_chunks().take(pa.array(found[:, 1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int64)), ids, pa.array(found[:, 0])], names=schema.fieldNames()
            )

    return corpus.vectors.mapInArrow(run, schema)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents for each item, or all above 0.

    Null and empty texts have no terms: such documents are never found, such items find none. Rows
    that repeat an id are documents or items of their own. Equal scores go by ascending id, null
    last; of rows that tie there too, either may come first. Terms are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    terms = staged(term_counts(items, "item_id"), "items")
    wanted = terms.select(F.explode("terms").alias("term"))
    corpus = build(docs, bitmap(wanted, "term", SLOTS))
    rounds = -(-terms.agg(F.count_distinct("row")).first()[0] // ITEMS)
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("rank", T.IntegerType()),
            docs.schema["doc_id"],
            T.StructField("score", T.LongType()),
        ]
    )
    found = []
    for turn in range(rounds if corpus.n_docs else 0):
        asked = prepare_items(corpus, terms, rounds, turn)
        if not len(asked.numbers):
            continue
        first = _ranked(best_documents(corpus, asked, top, SEEDS), top).where(F.col("rank") == top)
        for r in first.select("item", "score").collect():
            asked.least[r["item"]] = r["score"]
        ranked = _ranked(best_documents(corpus, asked, top), top)
        numbers = spark.sparkContext.broadcast(asked.numbers)

        def named(batches: Iterator[pa.RecordBatch], numbers=numbers) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row = pa.array(numbers.value[batch.column("item").to_numpy()])
                rest = [batch.column(c) for c in ("rank", "doc_id", "score")]
                yield pa.RecordBatch.from_arrays([row, *rest], names=schema.fieldNames())

        found.append(ranked.select("item", "rank", "doc_id", "score").mapInArrow(named, schema))
    ranked = reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)
    ids = terms.select("row", "item_id").distinct()
    return ids.join(ranked, "row").select("item_id", "rank", "doc_id", "score")
