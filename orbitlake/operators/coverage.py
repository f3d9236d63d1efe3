"""Which full-disk rows the parts of a scene cover.

A part table has group keys (a scene and a resolution), ``row_start``/``row_stop`` (0-based,
half-open) and the grid of its resolution: ``y_start``, ``y_stop`` and ``tile_rows`` (see
``attach_grid``). Parts are first reduced to one row per distinct start row, in partial aggregates
before any shuffle, so a window group never holds more rows than the grid has lines, however many
copies of a part arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbitlake.constants import BODY_CHUNKS, DIMSIZE, TILE_ROWS
from orbitlake.functions.geolocation import lookup
from orbitlake.plans import catalog
from orbitlake.plans.config import CubeConfig

KEYS = ("scene_id", "resolution")


def attach_grid(parts: DataFrame, config: CubeConfig | None = None) -> DataFrame:
    """Add the window and tile height of each part's resolution; the full disk by default."""
    resolution = F.col("resolution")
    if config is None:
        starts, stops, heights = {res: 0 for res in DIMSIZE}, DIMSIZE, TILE_ROWS
    else:
        grids = catalog.config_resolutions(config)
        windows = {res: catalog.row_window(config, res) for res in grids}
        starts = {res: window[0] for res, window in windows.items()}
        stops = {res: window[1] for res, window in windows.items()}
        heights = {res: config.tile_height(res) for res in grids}
    return (
        parts.withColumn("y_start", lookup(resolution, starts))
        .withColumn("y_stop", lookup(resolution, stops))
        .withColumn("tile_rows", lookup(resolution, heights))
    )


def _tile(row: Column) -> Column:
    return F.floor(row / F.col("tile_rows")).cast("int")


def clipped(parts: DataFrame) -> DataFrame:
    """Parts that meet their window, with the rows inside it as ``lo``/``hi``."""
    return (
        parts.withColumn("lo", F.greatest("row_start", "y_start"))
        .withColumn("hi", F.least("row_stop", "y_stop"))
        .filter(F.col("lo") < F.col("hi"))
    )


def parts_in_tile(parts: DataFrame) -> DataFrame:
    """Pair every part with the tiles it meets and clip it to each.

    The tile number is computed from the rows, so the overlap needs no range join.
    """
    inside = clipped(parts)
    exploded = inside.withColumn(
        "tile", F.explode(F.sequence(_tile(F.col("lo")), _tile(F.col("hi") - 1)))
    )
    return (
        exploded.withColumn("tile_start", F.col("tile") * F.col("tile_rows"))
        .withColumn(
            "tile_stop", F.least(F.col("tile_start") + F.col("tile_rows"), F.col("y_stop"))
        )
        .withColumn("start", F.greatest("lo", "tile_start"))
        .withColumn("stop", F.least("hi", "tile_stop"))
        .drop("lo", "hi")
    )


def join_tiles(tiles: DataFrame, parts: DataFrame, keys: Sequence[str] = ("resolution",)) -> DataFrame:
    """Parts that meet each given tile, as an equi-join on the computed tile number."""
    return tiles.select(*keys, "tile").join(parts_in_tile(parts), [*keys, "tile"])


def tile_runs(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Contiguous covered rows per tile as ``start``/``stop``."""
    tile_keys = [*keys, "tile", "tile_start", "tile_stop"]
    spans = parts_in_tile(parts).groupBy(*tile_keys, "start").agg(F.max("stop").alias("stop"))
    by_start = Window.partitionBy(*keys, "tile").orderBy("start")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("start") > F.max("stop").over(before), F.lit(True))
    numbered = spans.withColumn("opens", opens.cast("int")).withColumn(
        "run", F.sum("opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(*tile_keys, "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")
    )


def tile_coverage(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Covered runs and gaps of every tile that meets a part, one row each (``kind``)."""
    runs = tile_runs(parts, keys)
    by_start = Window.partitionBy(*keys, "tile").orderBy("start")

    def span(kind: str, start: Column, stop: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"))

    start, stop = F.col("start"), F.col("stop")
    spans = (
        runs.withColumn("cursor", F.coalesce(F.lag("stop").over(by_start), F.col("tile_start")))
        .withColumn("is_last", F.lead("start").over(by_start).isNull())
        .withColumn(
            "span",
            F.explode(
                F.array_compact(
                    F.array(
                        span("run", start, stop),
                        F.when(start > F.col("cursor"), span("gap", F.col("cursor"), start)),
                        F.when(
                            F.col("is_last") & (stop < F.col("tile_stop")),
                            span("gap", stop, F.col("tile_stop")),
                        ),
                    )
                )
            ),
        )
    )
    return spans.select(*keys, "tile", "tile_start", "tile_stop", "span.*")


def _distinct_starts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        clipped(parts)
        .groupBy(*keys, "y_start", "y_stop", F.col("lo").alias("start"))
        .agg(F.max("hi").alias("stop"), F.count("*").alias("n_parts"))
    )


def uncovered_rows(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Ranges of window rows that no part covers, for groups with at least one part in the window."""
    by_start = Window.partitionBy(*keys).orderBy("start")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)

    def gap(start: Column, stop: Column) -> Column:
        return F.struct(start.alias("gap_start"), stop.alias("gap_stop"))

    swept = (
        _distinct_starts(parts, keys)
        .withColumn("cursor", F.coalesce(F.max("stop").over(before), F.col("y_start")))
        .withColumn("reach", F.greatest("cursor", "stop"))
        .withColumn("is_last", F.lead("start").over(by_start).isNull())
    )
    gaps = F.array_compact(
        F.array(
            F.when(F.col("start") > F.col("cursor"), gap(F.col("cursor"), F.col("start"))),
            F.when(
                F.col("is_last") & (F.col("reach") < F.col("y_stop")),
                gap(F.col("reach"), F.col("y_stop")),
            ),
        )
    )
    return swept.select(*keys, F.explode(gaps).alias("gap")).select(*keys, "gap.*")


def overlap_guard(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Groups whose parts cannot be assembled, with the first bad row and the reason.

    Bad are a part that starts before an earlier part ends, and a part whose rows are empty or
    reversed inside one tile.
    """
    by_start = Window.partitionBy(*keys).orderBy("start")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    overlapping = (
        _distinct_starts(parts, keys)
        .withColumn("cursor", F.max("stop").over(before))
        .filter((F.col("n_parts") > 1) | (F.col("start") < F.col("cursor")))
        .select(*keys, F.col("start").alias("row"), F.lit("overlap").alias("problem"))
    )
    empty = parts.filter(
        (F.col("row_stop") <= F.col("row_start"))
        & (F.col("row_stop") > F.col("y_start"))
        & (F.col("row_start") < F.col("y_stop"))
        & (_tile(F.col("row_start")) == _tile(F.col("row_stop") - 1))
    ).select(*keys, F.col("row_start").alias("row"), F.lit("empty").alias("problem"))
    first = F.min(F.struct("row", "problem")).alias("first")
    return overlapping.unionByName(empty).groupBy(*keys).agg(first).select(*keys, "first.*")


def exact_tiling(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Whether the parts of each group cover their window once, without gap or overlap.

    Row spans tile a range exactly when every span is non-empty and, over all spans, each position
    ends as many spans as it starts, apart from the two ends of the range. That is a sum per
    position, so no group is ever sorted or gathered.
    """
    span = parts.withColumn("lo", F.greatest("row_start", "y_start")).withColumn(
        "hi", F.least("row_stop", "y_stop")
    )

    def edge(position: Column, step: int) -> Column:
        return F.struct(position.alias("position"), F.lit(step).alias("step"))

    edges = span.select(
        *keys,
        "y_start",
        "y_stop",
        (F.col("lo") >= F.col("hi")).alias("empty"),
        F.explode(F.array(edge(F.col("lo"), 1), edge(F.col("hi"), -1))).alias("edge"),
    )
    balance = edges.groupBy(*keys, "y_start", "y_stop", "edge.position").agg(
        F.sum("edge.step").alias("steps"), F.max("empty").alias("empty")
    )
    is_end = (F.col("position") == F.col("y_start")).cast("int") - (
        F.col("position") == F.col("y_stop")
    ).cast("int")
    return balance.groupBy(*keys).agg(
        (
            ~F.max("empty")
            & (F.max(F.abs(F.col("steps") - is_end)) == 0)
            & (F.sum(F.abs(is_end)) == 2)
        ).alias("exact")
    )


def check_body_rows(parts: DataFrame) -> DataFrame:
    """Compare each part's rows with the row table by its chunk number; ``error`` is NULL if equal."""
    expected = catalog.body_rows(parts.sparkSession).select(
        "product_type",
        "resolution",
        "chunk_no",
        F.col("row_start").alias("expected_start"),
        F.col("row_stop").alias("expected_stop"),
    )
    joined = parts.join(F.broadcast(expected), ["product_type", "resolution", "chunk_no"], "left")
    same = (F.col("row_start") == F.col("expected_start")) & (
        F.col("row_stop") == F.col("expected_stop")
    )
    error = (
        F.when(F.col("chunk_no").isNull(), "unreadable chunk number")
        .when(~F.col("chunk_no").between(1, BODY_CHUNKS), "chunk number outside 1..40")
        .when(
            ~F.coalesce(same, F.lit(False)),
            F.format_string(
                "chunk %d holds rows [%d, %d), expected [%d, %d)",
                "chunk_no",
                "row_start",
                "row_stop",
                "expected_start",
                "expected_stop",
            ),
        )
    )
    return joined.withColumn("error", error)


def missing_chunks(gaps: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Chunk numbers whose rows meet the gaps of a group, ascending (at most 40 per group)."""
    rows = catalog.body_rows(gaps.sparkSession)
    met = gaps.join(F.broadcast(rows), ["product_type", "resolution"]).filter(
        (F.col("row_start") < F.col("gap_stop")) & (F.col("row_stop") > F.col("gap_start"))
    )
    return met.groupBy(*keys).agg(F.sort_array(F.collect_set("chunk_no")).alias("missing"))


def coverage_summary(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per group: rows written, gaps inside touched tiles and missing chunk numbers."""
    spans = tile_coverage(parts, [*keys, "product_type"]).withColumn(
        "rows", F.col("stop") - F.col("start")
    )
    is_gap = F.col("kind") == "gap"
    # Gaps of one group are disjoint row ranges, so their list is bounded by the grid.
    totals = spans.groupBy(*keys).agg(
        F.sum(F.when(~is_gap, F.col("rows")).otherwise(0)).alias("rows_written"),
        F.sum(F.when(is_gap, F.col("rows")).otherwise(0)).alias("gap_rows"),
        F.count_if(is_gap).alias("n_gaps"),
        F.sort_array(F.collect_list(F.when(is_gap, F.struct("start", "stop")))).alias("gaps"),
    )
    gaps = spans.filter(is_gap).select(
        *keys, "product_type", F.col("start").alias("gap_start"), F.col("stop").alias("gap_stop")
    )
    return totals.join(missing_chunks(gaps, keys), list(keys), "left")


def describe(kind: str, spans: Column, missing: Column) -> Column:
    """Text naming the rows and chunks a scene lacks."""
    rows = F.array_join(
        F.transform(spans, lambda s: F.format_string("[%d, %d)", s["start"], s["stop"])), ", "
    )
    chunks = F.coalesce(
        F.concat(
            F.lit("; missing BODY chunk(s) "),
            F.array_join(F.transform(missing, lambda n: n.cast("string")), ", "),
        ),
        F.lit(""),
    )
    return F.concat(
        F.lit(f"scene does not cover {kind} of group data_"),
        F.col("resolution"),
        F.lit(" rows "),
        rows,
        chunks,
    )


def partial_problems(parts: DataFrame, staged: bool, partial_chunk: str) -> DataFrame:
    """Scenes refused for missing rows, as ``(scene_id, resolution, error)``.

    A staged write replaces what it touches, so it needs the whole window; ``partial_chunk="error"``
    needs every touched tile whole. Tiles and groups without any part do not matter.
    """
    if staged:
        gaps = uncovered_rows(parts, [*KEYS, "product_type"])
        kind = "the window"
    elif partial_chunk == "error":
        gaps = (
            tile_coverage(parts, [*KEYS, "product_type"])
            .filter(F.col("kind") == "gap")
            .withColumnsRenamed({"start": "gap_start", "stop": "gap_stop"})
        )
        kind = "the tiles it would write"
    else:
        return parts.select(*KEYS, F.lit(None).cast("string").alias("error")).limit(0)
    span = F.struct(F.col("gap_start").alias("start"), F.col("gap_stop").alias("stop"))
    listed = gaps.groupBy(*KEYS).agg(F.sort_array(F.collect_list(span)).alias("gaps"))
    named = listed.join(missing_chunks(gaps), list(KEYS), "left")
    return named.select(*KEYS, describe(kind, F.col("gaps"), F.col("missing")).alias("error"))
