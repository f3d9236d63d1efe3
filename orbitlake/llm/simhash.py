"""SimHash near-duplicates found through tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake.llm.tables import components, fresh, staged

BITS = 64
SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 3
#: Disjoint blocks of bits; pairs of blocks make the search keys.
BLOCKS = 5
#: Reference fingerprints for each block, and for all bits at once.
BLOCK_PIVOTS = 10
PIVOTS = 24
#: Fingerprints of one key that one task compares; a larger key is split into pairs of chunks.
CHUNK = 4096


def text_fingerprint(text: bytes) -> int:
    """SimHash of a text's bytes over 3-word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(SHINGLE_WORDS, len(words))
    starts = np.concatenate(([0], ends[: len(words) - size] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], ">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """Add the fingerprint of every whole text as a signed long; a null text has no words."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.large_binary())
            prints = np.fromiter(
                (text_fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts),
                np.uint64,
                len(texts),
            )
            fields = [*batch.schema, pa.field(name, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(prints.view(np.int64))], schema=pa.schema(fields)
            )

    return docs.mapInArrow(run, schema)


def references(count: int, seed: int) -> list[int]:
    """Fixed pseudo-random 64-bit reference fingerprints."""
    return [xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed) for i in range(count)]


def block_masks() -> list[int]:
    edges = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_search_keys(prints: DataFrame) -> DataFrame:
    """Add ``key``: one row for each key under which a fingerprint is looked up.

    The distance to a reference within a block of bits cannot change when no bit of the block
    does. Three differing bits touch at most three of the five blocks, so two linked fingerprints
    have equal distance tables in at least two blocks: they share one key of the ten.
    """

    def distance(pivot: int, mask: int) -> Column:
        other = F.col("fp").bitwiseXOR(F.lit(_signed(pivot)))
        return F.bit_count(other.bitwiseAND(F.lit(_signed(mask))))

    # Distances within a block of at most 13 bits fit four bits each: a table is one long.
    tables = {
        f"_table{number}": reduce(
            lambda packed, pivot: F.shiftleft(packed, 4).bitwiseOR(distance(pivot, mask)),
            references(BLOCK_PIVOTS, 100 + number),
            F.lit(0).cast("long"),
        )
        for number, mask in enumerate(block_masks())
    }
    keys = [
        F.xxhash64(F.lit(i * BLOCKS + j), f"_table{i}", f"_table{j}")
        for i, j in combinations(range(BLOCKS), 2)
    ]
    return prints.withColumns(tables).withColumn("key", F.explode(F.array(*keys)))


def _popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values).astype(np.int8)


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a[i]`` and ``b[i]``; ``label`` holds the smallest row of each set."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter


def linked_sets(unit: np.ndarray, chunk: np.ndarray, fps: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """For rows sorted by unit: the first row each is connected to within its unit.

    Pairs are dropped by the largest difference of their distances to the references, then
    verified. Pairs already connected are not looked at again, so no list of pairs grows with the
    square of a unit. ``apart`` marks units that compare only rows of different chunks.
    """
    label = np.arange(len(fps))
    table = np.stack([_popcount(fps ^ np.uint64(p)) for p in references(PIVOTS, 7)])
    ends = np.searchsorted(unit, unit, "right")
    step, rows = 1, np.arange(len(fps))
    while True:
        rows = rows[rows + step < ends[rows]]
        if not len(rows):
            return label
        a, b = rows, rows + step
        fine = ~(apart[a] & (chunk[a] == chunk[b])) & (label[a] != label[b])
        a, b = a[fine], b[fine]
        for distances in table:
            near = np.abs(distances[a] - distances[b]) <= MAX_DISTANCE
            a, b = a[near], b[near]
            if not len(a):
                break
        near = _popcount(fps[a] ^ fps[b]) <= MAX_DISTANCE
        merge_labels(label, a[near], b[near])
        step += 1


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of complete units; rows arrive sorted by unit."""

    def links(table: pa.Table) -> pa.RecordBatch:
        unit, chunk, fps, apart = (
            table.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "chunk", "fp", "apart")
        )
        label = linked_sets(unit, chunk, fps.view(np.uint64), apart.astype(bool))
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[moved]), pa.array(fps[label[moved]])], names=["a", "b"]
        )

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        if not table.num_rows:
            continue
        unit = table.column("unit").to_numpy()
        cut = int(np.searchsorted(unit, unit[-1]))
        held = table.slice(cut)
        if cut:
            yield links(table.slice(0, cut))
    if held is not None and held.num_rows:
        yield links(held)


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at 3 or fewer differing bits.

    The links are a spanning set, not all pairs: whatever is reachable over links stays reachable.
    """
    keyed = with_search_keys(prints).select("fp", "key")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    rows = keyed.join(shared, "key").select(
        "key",
        "fp",
        chunks.alias("chunks"),
        F.pmod(F.xxhash64(F.lit("chunk"), "fp"), chunks).cast("int").alias("chunk"),
    )
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    rows = rows.select(
        F.xxhash64("key", low, high).alias("unit"), "chunk", "fp", (low != high).alias("apart")
    )
    rows = rows.repartition("unit").sortWithinPartitions("unit", "fp")
    return rows.mapInArrow(_edges, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``docs`` (``id_col``, ``fp``).

    ``root`` is one fingerprint of the group, ``component_id`` the smallest id of its documents
    (null if all are null). Documents without words share fingerprint zero and are linked like
    any other; repeated rows and ids change nothing.
    """
    prints = staged(docs.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    roots = components(fingerprint_links(prints))
    found = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    found = staged(found, "roots")
    groups = found.groupBy("root").agg(F.min("least").alias("component_id"))
    return found.join(groups, "root").select("fp", "root", "component_id")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of all documents."""
    prints = staged(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "simhash")
    found = near_duplicates(prints)
    return prints.join(found, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one with the smallest id.

    Of rows that repeat an id one stays. Extra columns are kept.
    """
    names = docs.columns
    keys = [fresh(name, docs) for name in ("_k1", "_k2")]
    # Two hashes of id and text stand for a row, so that texts are looked at once and moved once.
    of = [F.xxhash64(F.lit(salt), "doc_id", "text") for salt in (1, 2)]
    slim = docs.select("doc_id", "text", *[h.alias(k) for h, k in zip(of, keys)])
    prints = staged(with_fingerprint(slim).select("doc_id", *keys, "fp"), "simhash")
    found = prints.join(near_duplicates(prints), "fp")
    found = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # One row of each group, also where several have its smallest id.
    first = found.groupBy("root").agg(F.min(keys[0]).alias(keys[0]))
    chosen = found.join(first, ["root", keys[0]]).groupBy("root", keys[0]).agg(F.min(keys[1]).alias(keys[1]))
    marked = docs.withColumns(dict(zip(keys, of)))
    kept = marked.join(chosen.select(*keys), keys, "left_semi").dropDuplicates(keys)
    return kept.select(*[F.col(f"`{c}`") for c in names])
