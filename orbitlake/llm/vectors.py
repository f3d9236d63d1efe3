"""Near-duplicate vectors: tiles in PCA order, compared until the cosine cannot reach the threshold."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlake.llm.simhash import merge_labels
from orbitlake.llm.tables import components, running_total, smallest, staged

THRESHOLD = 0.98
#: Bound of the sample that the principal axes are fitted on; they only order the work.
PCA_SAMPLE = 20_000
#: Numbers in a tile: longer vectors make tiles of fewer. Bounds what a task holds of two tiles.
TILE = 1 << 20
#: Rows of a tile that are compared, or skipped, at once.
BLOCK = 256
#: Share of a block's pairs beyond which their products are completed together.
DENSE = 0.1
#: Leading dimensions after which a bound is taken.
STEPS = (8, 16, 32)
#: Leading axes that tiles are ordered by and have bounds on, and bits of an axis in the order.
LEAD, BITS = 8, 7
#: Rounding that projected products may hold.
SLACK = 1e-7


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; scaled first, so that no square overflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def axes_of(nodes: DataFrame) -> dict[int, np.ndarray]:
    """The principal axes for each vector length, strongest first, from a bounded sample."""
    spread = nodes.select("embedding", F.xxhash64("node").alias("spread"))
    sample = smallest(spread, "spread", PCA_SAMPLE).select("embedding").toArrow()
    by_size: dict[int, list] = {}
    for vector in sample.column("embedding").to_pylist():
        by_size.setdefault(len(vector), []).append(vector)
    axes = {}
    for size, vectors in by_size.items():
        rows = unit_rows(np.array(vectors))
        axes[size] = np.linalg.eigh(rows.T @ rows)[1][:, ::-1]
    return axes


def _axes(axes: dict[int, np.ndarray], size: int) -> np.ndarray:
    return axes[size] if size in axes else np.eye(size)


BOUNDED = [*(f"p{k}" for k in range(LEAD)), "rest"]


def _rest(projected: np.ndarray, k: int) -> np.ndarray:
    """Suffix norms: the length of each row without its first ``k`` dimensions."""
    return np.sqrt((projected[:, k:] ** 2).sum(1))


def _leading(projected: np.ndarray) -> np.ndarray:
    """The columns ``BOUNDED``: the leading coordinates, zero where there are fewer, and the suffix norm."""
    lead = np.zeros((len(projected), LEAD + 1))
    lead[:, : min(LEAD, projected.shape[1])] = projected[:, :LEAD]
    lead[:, LEAD] = _rest(projected, LEAD)
    return lead


def _order(lead: np.ndarray) -> np.ndarray:
    """A number per row whose bits are those of the leading coordinates in turn, the strongest axis first.

    Rows next to each other in this order are near each other on all these axes.
    """
    steps = np.clip((lead[:, :LEAD] + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    order = np.zeros(len(lead), np.int64)
    for bit in range(BITS - 1, -1, -1):
        for axis in range(LEAD):
            order = order << 1 | (steps[:, axis] >> bit & 1)
    return order


def with_places(nodes: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """Add ``cx`` and ``cy``, ``place`` and the columns ``BOUNDED``.

    The first two are cells of the two leading axes, as wide as linked vectors can be apart;
    ``place`` orders vectors along the leading axes.
    """
    width = math.sqrt(max(2 - 2 * threshold, 0)) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("embedding")
            lead = np.zeros((len(vectors), LEAD + 1))
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows = unit_rows(_matrix(vectors.take(pa.array(at))))
                lead[at] = _leading(rows @ _axes(axes, int(size)))
            cells = np.floor(lead[:, :2] / width).astype(np.int32)
            added = [cells[:, 0], cells[:, 1], _order(lead), *lead.T]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(np.ascontiguousarray(c)) for c in added)],
                names=[*batch.schema.names, "cx", "cy", "place", *BOUNDED],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    bounded = ", ".join(f"{c} double" for c in BOUNDED)
    return nodes.mapInArrow(run, f"{schema}, cx int, cy int, place long, {bounded}")


def _boxes(projected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest leading coordinates and suffix norms of each block of rows."""
    lead, starts = _leading(projected), np.arange(0, len(projected), BLOCK)
    return np.minimum.reduceat(lead, starts), np.maximum.reduceat(lead, starts)


def linked_pairs(
    left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows whose cosine is at least the threshold, block by block.

    ``same``: both sides are one tile; each pair comes once.
    """
    if not len(left) or not len(right):
        return
    a, b = unit_rows(left), unit_rows(right)
    whole_a, whole_b = a @ axes, b @ axes
    (low_a, high_a), (low_b, high_b) = _boxes(whole_a), _boxes(whole_b)
    for x in range(len(low_a)):
        gap = np.maximum(np.maximum(low_b - high_a[x], low_a[x] - high_b), 0)
        for y in np.flatnonzero((gap**2).sum(1) <= 2 - 2 * threshold + 2 * SLACK):
            if same and y < x:
                continue
            at, to = x * BLOCK, y * BLOCK
            one, two = slice(at, at + BLOCK), slice(to, to + BLOCK)
            i, j, product = _linked(whole_a[one], whole_b[two], threshold, same and x == y)
            # Close to the threshold the cosine of the given numbers themselves decides.
            near = product >= threshold + SLACK
            close = np.flatnonzero(~near)
            near[close] = np.einsum("ij,ij->i", a[one][i[close]], b[two][j[close]]) >= threshold
            if near.any():
                yield i[near] + at, j[near] + to


def _linked(
    left: np.ndarray, right: np.ndarray, threshold: float, same: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of projected rows that the bounds leave after all dimensions, and their products."""
    size = left.shape[1]
    k = min(STEPS[0], size)
    so_far = left[:, :k] @ right[:, :k].T
    alive = so_far + np.outer(_rest(left, k), _rest(right, k)) >= threshold - SLACK
    if same:
        alive = np.triu(alive, 1)
    if alive.sum() > DENSE * alive.size:
        # Most pairs go on: the other dimensions of all at once cost less than those of each pair.
        so_far += left[:, k:] @ right[:, k:].T
        alive &= so_far >= threshold - SLACK
        k = size
    i, j = np.nonzero(alive)
    product = so_far[i, j]
    for upto in (*STEPS[1:], size):
        upto = min(upto, size)
        if upto > k and len(i):
            product = product + np.einsum("ij,ij->i", left[i, k:upto], right[j, k:upto])
            k = upto
            near = product + _rest(left, k)[i] * _rest(right, k)[j] >= threshold - SLACK
            i, j, product = i[near], j[near], product[near]
    return i, j, product


def _compare(axes: dict[int, np.ndarray], threshold: float):
    def unit(table: pa.Table) -> pa.RecordBatch:
        side = table.column("side").to_numpy()
        node, times = table.column("node").to_numpy(), table.column("n").to_numpy()
        vectors = _matrix(table.column("embedding"))
        # Side 2: a tile with itself. A tile may be empty, then there is nothing to compare.
        same = side[0] == 2
        first, second = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        basis = _axes(axes, vectors.shape[1])
        links, label = np.zeros(len(node), np.int64), np.arange(len(node))
        for i, j in linked_pairs(vectors[first], vectors[second], basis, threshold, same):
            i, j = first[i], second[j]
            np.add.at(links, i, times[j])
            np.add.at(links, j, times[i])
            merge_labels(label, i, j)
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(node[at]), pa.array(links[at]), pa.array(node[label[at]])],
            names=["node", "links", "root"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            if not table.num_rows:
                continue
            units = table.column("unit").to_numpy()
            cuts = np.append(np.flatnonzero(np.diff(units, prepend=units[0] - 1)), len(units))
            for a, b in zip(cuts[:-2], cuts[1:-1]):
                yield unit(table.slice(a, b - a))
            held = table.slice(cuts[-2])
        if held is not None and held.num_rows:
            yield unit(held)

    return run


def tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """(one, other): tiles whose vectors can be linked, each pair once, a tile with itself too.

    Cells next to each other on the two leading axes hold all pairs that can be linked. Of their
    tiles those pairs go whose boxes are too far apart: the gaps between leading coordinates and
    between suffix norms are a lower bound of the distance of any two vectors.
    """
    cell = ["label", "dim", "cx", "cy"]
    steps = F.array(
        *[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (1, 0), (1, 1), (0, 1), (-1, 1))]
    )
    bounds = [f"{edge}_{c}" for c in BOUNDED for edge in ("low", "high")]
    near = tiles.withColumn("step", F.explode(steps)).select(
        "label",
        "dim",
        (F.col("cx") + F.col("step.x")).alias("cx"),
        (F.col("cy") + F.col("step.y")).alias("cy"),
        ((F.col("step.x") == 0) & (F.col("step.y") == 0)).alias("home"),
        F.col("tile").alias("one"),
        *(F.col(c).alias(f"one_{c}") for c in bounds),
    )
    both = near.join(tiles.withColumnRenamed("tile", "other"), cell)

    def gap(c: str) -> Column:
        apart = F.greatest(
            F.col(f"low_{c}") - F.col(f"one_high_{c}"), F.col(f"one_low_{c}") - F.col(f"high_{c}"), F.lit(0.0)
        )
        return apart * apart

    reach = sum((gap(c) for c in BOUNDED[1:]), gap(BOUNDED[0])) <= 2 - 2 * threshold + 2 * SLACK
    return both.where((~F.col("home") | (F.col("one") <= F.col("other"))) & reach).select("one", "other")


def vector_links(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, links, root): what each tile pair found; ``root`` is a node reachable over links.

    ``nodes`` holds distinct (node, label, embedding, n). The vectors of a cell are put in order along
    the principal axes and cut to tiles. Bounds on whole tiles come before any vector is sent; each
    task gets two tiles at a time and returns counts and spanning links, never pairs.
    """
    axes = axes_of(nodes)
    sized = nodes.withColumn("dim", F.size("embedding"))
    placed = staged(with_places(sized, axes, threshold), "places")
    cell = ["label", "dim", "cx", "cy"]
    slim = placed.select(*cell, "place", "node", *BOUNDED, F.lit(1).alias("one"))
    ordered = running_total(slim, cell, ["place", "node"], "one")
    number = F.floor(F.col("before") / F.greatest(F.floor(F.lit(TILE) / F.col("dim")), F.lit(1)))
    ordered = staged(ordered.select(*cell, number.alias("number"), "node", *BOUNDED), "ordered")
    edges = [e for c in BOUNDED for e in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"))]
    tiles = ordered.groupBy(*cell, "number").agg(*edges)
    tiles = staged(tiles.withColumn("tile", F.monotonically_increasing_id()), "tiles")
    pairs = tile_pairs(tiles.drop("number"), threshold)
    pairs = staged(pairs.withColumn("unit", F.monotonically_increasing_id()), "tilepairs")

    # Side 2: a tile with itself, which is sent once.
    lone = F.col("one") == F.col("other")
    sides = pairs.select(F.col("one").alias("tile"), "unit", F.when(lone, 2).otherwise(0).alias("side")).union(
        pairs.where(~lone).select(F.col("other").alias("tile"), "unit", F.lit(1).alias("side"))
    )
    named = ordered.join(tiles.select(*cell, "number", "tile"), [*cell, "number"]).select("node", "tile")
    tiled = placed.select("node", "n", "place", "embedding").join(named, "node")
    rows = tiled.join(sides, "tile").select("unit", "side", "place", "node", "n", "embedding")
    rows = rows.repartition("unit").sortWithinPartitions("unit", "place")
    found = rows.mapInArrow(_compare(axes, threshold), "node long, links long, root long")
    return staged(found, "vectorlinks")


def vector_groups(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of all vectors.

    Vectors are compared when their labels are equal and not null and they have as many components.
    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing
    and are components of their own. Equal vectors are one node: each copy links with all others.
    A null id is no component's name; a component without any other id has none.
    """
    slim = vectors.select("vec_id", "label", "embedding")
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    fit = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd & ~zero
    slim = slim.withColumn("fit", F.coalesce(fit, F.lit(False)))
    nodes = (
        slim.where("fit")
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = staged(nodes, "nodes")
    links = vector_links(nodes.select("node", "label", "embedding", "n"), threshold)
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    known = nodes.join(counts, "node", "left").join(roots, F.col("node") == F.col("_node"), "left")
    known = known.select(
        F.col("label").alias("_label"),
        F.col("embedding").alias("_embedding"),
        "least",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("_links"),
        F.coalesce("_root", "node").alias("_group"),
    )
    known = staged(known, "known")
    groups = known.groupBy("_group").agg(F.min("least").alias("_component"))
    known = known.join(groups, "_group").select("_label", "_embedding", "_links", "_component")
    same = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    found = slim.where("fit").join(known, same).select(
        "vec_id", F.col("_links").alias("n_links"), F.col("_component").alias("component_id")
    )
    alone = slim.where("not fit").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.union(alone).withColumn("kept", kept)
