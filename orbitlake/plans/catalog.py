"""Channel and row catalogs as tables, and the selections made from them.

Both catalogs have a fixed size (20 channels, 160 row spans), so they are broadcast by hint. A
selection is a table too: one row per request, so many requests are resolved by one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.functions.geolocation import lookup
from orbitlake.plans.config import ConfigurationError, CubeConfig
from orbitlake.session import literal_table

CHANNEL_SCHEMA = (
    "product_type string, resolution string, resolution_order int, channel string, "
    "nc_channel string, catalog_index int, dimsize int, wavelength_um float, dual_gain boolean"
)
ROW_SCHEMA = "product_type string, resolution string, chunk_no int, row_start int, row_stop int"


def channels(spark: SparkSession) -> DataFrame:
    """One row per product, resolution and channel."""
    rows = []
    for (product, resolution), entries in K.CHANNELS.items():
        order = K.RESOLUTIONS[product].index(resolution)
        for index, (channel, nc_channel) in enumerate(entries):
            rows.append(
                (
                    product, resolution, order, channel, nc_channel, index,
                    K.DIMSIZE[resolution], K.WAVELENGTH_UM[channel],
                    channel in K.DUAL_GAIN_CHANNELS,
                )
            )
    return literal_table(spark, rows, CHANNEL_SCHEMA)


def body_rows(spark: SparkSession) -> DataFrame:
    """Rows of each BODY chunk, 0-based and half-open."""
    rows = [
        (product, resolution, number + 1, ends[number - 1] if number else 0, end)
        for (product, resolution), ends in K.CHUNK_ROW_ENDS.items()
        for number, end in enumerate(ends)
    ]
    return literal_table(spark, rows, ROW_SCHEMA)


def fail_where(df: DataFrame, message: Column) -> DataFrame:
    """Pass the rows on, but fail the query at a row whose ``message`` is not NULL."""
    ok = F.when(message.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
    return df.filter(ok)


def _requested(df: DataFrame, csv: str) -> DataFrame:
    """Explode a comma-separated column to ``requested`` with its position; blanks are dropped."""
    items = F.transform(F.split(csv, ","), lambda item: F.trim(item))
    return df.select("*", F.posexplode(items).alias("position", "requested")).filter(
        F.col("requested") != ""
    )


def with_selection(requests: DataFrame) -> DataFrame:
    """Add the option columns a request may leave out; a missing product type means FDHSI."""
    missing = [c for c in ("resolutions", "channels") if c not in requests.columns]
    return requests.select("*", *(F.lit(None).cast("string").alias(c) for c in missing)).withColumn(
        "product_type", F.coalesce("product_type", F.lit(K.FDHSI))
    )


def select_resolutions(requests: DataFrame) -> DataFrame:
    """Resolutions of each request in request order; unknown names are dropped silently.

    A request is ``(request_id, product_type, resolutions)``; a NULL list asks for all.
    """
    requests = with_selection(requests)
    known = channels(requests.sparkSession).select(
        "product_type", F.col("resolution"), "resolution_order"
    ).distinct()
    listed = _requested(
        requests.filter(F.col("resolutions").isNotNull()).select(
            "request_id", "product_type", "resolutions"
        ),
        "resolutions",
    )
    chosen = listed.join(
        F.broadcast(known.withColumnRenamed("resolution", "requested")),
        ["product_type", "requested"],
    ).select("request_id", "product_type", F.col("requested").alias("resolution"), "position")
    every = (
        requests.filter(F.col("resolutions").isNull())
        .select("request_id", "product_type")
        .join(F.broadcast(known), "product_type")
        .select("request_id", "product_type", "resolution", F.col("resolution_order").alias("position"))
    )
    return chosen.unionByName(every)


def select_channels(requests: DataFrame, strict: bool = True) -> DataFrame:
    """Channels of each request, trimmed and without repeats, in request order.

    ``channel_index`` is the position within the request's resolution. Names the product does not
    have fail the query; ``strict=False`` keeps them with a NULL resolution. A NULL list asks for
    every channel in catalog order.
    """
    requests = with_selection(requests)
    catalog = channels(requests.sparkSession)
    # A list of blanks only counts as no list.
    has_list = F.length(F.regexp_replace(F.coalesce("channels", F.lit("")), r"[,\s]", "")) > 0
    first_seen = (
        _requested(requests.filter(has_list).select("request_id", "product_type", "channels"), "channels")
        .groupBy("request_id", "product_type", F.col("requested").alias("channel"))
        .agg(F.min("position").alias("position"))
    )
    found = first_seen.join(F.broadcast(catalog), ["product_type", "channel"], "left")
    if strict:
        found = fail_where(
            found,
            F.when(
                F.col("resolution").isNull(),
                F.concat(F.lit("unknown channel "), "channel", F.lit(" for "), "product_type"),
            ),
        )
    every = (
        requests.filter(~has_list)
        .select("request_id", "product_type")
        .join(F.broadcast(catalog), "product_type")
        .withColumn("position", F.col("catalog_index"))
    )
    # The list of one request has at most as many distinct names as it has commas; the number of
    # earlier names of the same resolution is counted in its own small window.
    window = Window.partitionBy("request_id", "resolution").orderBy("position")
    return found.unionByName(every).withColumn("channel_index", F.row_number().over(window) - 1)


def effective_resolutions(requests: DataFrame, strict: bool = True) -> DataFrame:
    """Resolutions that keep at least one channel, in catalog order.

    ``resolution_index`` counts them per request; a request left with none fails the query, or is
    absent with ``strict=False``.
    """
    requests = with_selection(requests)
    kept = (
        select_channels(requests, strict)
        .filter(F.col("resolution").isNotNull())
        .join(
            select_resolutions(requests).select("request_id", "resolution").distinct(),
            ["request_id", "resolution"],
            "left_semi",
        )
        .groupBy("request_id", "product_type", "resolution", "resolution_order", "dimsize")
        .agg(F.count("*").alias("n_channels"))
    )
    order = Window.partitionBy("request_id").orderBy("resolution_order")
    kept = kept.withColumn("resolution_index", F.row_number().over(order) - 1)
    if not strict:
        return kept
    empty = F.when(
        F.col("resolution").isNull(),
        F.concat(F.lit("no resolution is left for request "), F.col("request_id").cast("string")),
    )
    checked = requests.select("request_id").join(kept, "request_id", "left")
    return fail_where(checked, empty)


def resolve_plans(requests: DataFrame, strict: bool = True) -> DataFrame:
    """One row per request and effective resolution with its channel lists in channel order."""
    chosen = select_channels(requests, strict).filter(F.col("resolution").isNotNull())
    resolutions = effective_resolutions(requests, strict).select(
        "request_id", "resolution", "resolution_index"
    )
    members = F.sort_array(F.collect_list(F.struct("channel_index", "channel", "nc_channel")))
    # At most the 16 channels of one product are collected per group.
    return (
        chosen.join(resolutions, ["request_id", "resolution"])
        .groupBy("request_id", "product_type", "resolution", "resolution_index", "dimsize")
        .agg(members.alias("members"))
        .select(
            "request_id",
            "product_type",
            "resolution",
            "resolution_index",
            "dimsize",
            F.col("members.channel").alias("channels"),
            F.col("members.nc_channel").alias("nc_channels"),
        )
    )


def config_channels(config: CubeConfig) -> dict[str, list[tuple[str, str]]]:
    """Channels (logical, in file) of one configuration per effective resolution, in channel order.

    The options of a run are known to the driver before any input is; this is the selection above for
    a single request, without a job.
    """
    known = {res: dict(K.CHANNELS[(p, res)]) for p, res in K.CHANNELS if p == config.product_type}
    requested = [c.strip() for c in (config.channels or "").split(",") if c.strip()]
    unknown = [c for c in requested if not any(c in names for names in known.values())]
    if unknown:
        raise ConfigurationError(f"unknown channel {unknown[0]!r} for {config.product_type}")
    allowed = None
    if config.resolutions is not None:
        allowed = {r.strip() for r in config.resolutions.split(",")}
    chosen = {}
    for resolution, names in known.items():
        order = [c for c in dict.fromkeys(requested) if c in names] if requested else list(names)
        if order and (allowed is None or resolution in allowed):
            chosen[resolution] = [(c, names[c]) for c in order]
    if not chosen:
        raise ConfigurationError(f"no {config.product_type} resolution is left to write")
    if config.flat and len(chosen) != 1:
        raise ConfigurationError(
            f"a flat cube needs exactly one effective resolution, got {list(chosen)}"
        )
    return chosen


def config_resolutions(config: CubeConfig) -> list[str]:
    return list(config_channels(config))


PLAN_SCHEMA = (
    "product_type string, resolution string, channel string, nc_channel string, channel_index int, "
    "dimsize int, wavelength_um float, dual_gain boolean, y_start int, y_stop int, tile_rows int"
)


def config_plan(spark: SparkSession, config: CubeConfig) -> DataFrame:
    """Channels to write under ``config``: at most 16 rows with index, window and tile height."""
    rows = [
        (
            config.product_type, resolution, channel, nc_channel, index, K.DIMSIZE[resolution],
            K.WAVELENGTH_UM[channel], channel in K.DUAL_GAIN_CHANNELS,
            *row_window(config, resolution), config.tile_height(resolution),
        )
        for resolution, members in config_channels(config).items()
        for index, (channel, nc_channel) in enumerate(members)
    ]
    return literal_table(spark, rows, PLAN_SCHEMA)


def row_window(config: CubeConfig, resolution: str) -> tuple[int, int]:
    """Full-disk rows a cube stores: all tiles, or those that hold a row of the chosen chunks."""
    size, height = K.DIMSIZE[resolution], config.tile_height(resolution)
    top, bottom = 0, size - 1
    if config.body_chunks is not None:
        ends = K.CHUNK_ROW_ENDS[(config.product_type, resolution)]
        before, final = config.body_chunks[0] - 2, config.body_chunks[1] - 1
        top, bottom = ends[before] if before >= 0 else 0, ends[final] - 1
    tile_top, tile_bottom = top // height, bottom // height
    return tile_top * height, min((tile_bottom + 1) * height, size)


def stripe_rows(stripes: DataFrame, strict: bool = True) -> DataFrame:
    """Row span of 1-based inclusive chunk ranges ``(product_type, resolution, first, last)``.

    An unknown grid or a range outside ``1 <= first <= last <= 40`` fails the query, or gives NULL
    rows with ``strict=False``.
    """
    rows = body_rows(stripes.sparkSession)
    start = rows.select("product_type", "resolution", F.col("chunk_no").alias("first"), "row_start")
    stop = rows.select("product_type", "resolution", F.col("chunk_no").alias("last"), "row_stop")
    valid = (F.col("first") <= F.col("last")) & F.col("row_start").isNotNull()
    spans = (
        stripes.join(F.broadcast(start), ["product_type", "resolution", "first"], "left")
        .join(F.broadcast(stop), ["product_type", "resolution", "last"], "left")
        .withColumn("row_start", F.when(valid & F.col("row_stop").isNotNull(), F.col("row_start")))
        .withColumn("row_stop", F.when(F.col("row_start").isNotNull(), F.col("row_stop")))
    )
    if not strict:
        return spans
    return fail_where(
        spans,
        F.when(
            F.col("row_start").isNull(),
            F.format_string("bad chunk range [%d, %d] for %s", "first", "last", "resolution"),
        ),
    )


def stripe_window(spans: DataFrame) -> DataFrame:
    """From the first row of the first tile to the last row of the last, within the grid."""
    grid = F.col("resolution")
    height, size = lookup(grid, K.TILE_ROWS), lookup(grid, K.DIMSIZE)
    top, bottom = tile_of(F.col("row_start"), grid), tile_of(F.col("row_stop") - 1, grid)
    return spans.withColumns(
        {
            "window_start": (top * height).cast("int"),
            "window_stop": F.least((bottom + 1) * height, size).cast("int"),
        }
    )


def tile_of(y: Column, resolution: Column | str, tile_rows: int | None = None) -> Column:
    """Output tile of a full-disk row."""
    height = F.lit(tile_rows) if tile_rows else lookup(resolution, K.TILE_ROWS)
    return F.floor(y / height).cast("int")


def tiles(windows: DataFrame, tile_rows: int | None = None) -> DataFrame:
    """Enumerate the tiles of ``(resolution, window_start, window_stop)``, the last one clipped.

    The window must start on the tile grid.
    """
    height = F.lit(tile_rows) if tile_rows else lookup(F.col("resolution"), K.TILE_ROWS)
    windows = fail_where(
        windows,
        F.when(
            F.col("window_start") % height != 0,
            F.format_string("window start %d is off the tile grid", "window_start"),
        ),
    )
    first = F.floor(F.col("window_start") / height).cast("int")
    last = F.floor((F.col("window_stop") - 1) / height).cast("int")
    return (
        windows.select("*", height.alias("_rows"), F.explode(F.sequence(first, last)).alias("tile"))
        .withColumn("tile_start", F.col("tile") * F.col("_rows"))
        .withColumn(
            "tile_stop", F.least(F.col("tile_start") + F.col("_rows"), F.col("window_stop"))
        )
        .drop("_rows")
    )


def rename_channels(df: DataFrame, column: str = "nc_channel") -> DataFrame:
    """Names inside the files to logical channels; channels outside the catalog drop out."""
    names = channels(df.sparkSession).select(
        "product_type", F.col("nc_channel").alias(column), "channel", "resolution"
    )
    return df.join(F.broadcast(names), ["product_type", column])


def attach_wavelength(df: DataFrame) -> DataFrame:
    """Central wavelength by logical channel; NULL for a name the catalog does not have."""
    known = channels(df.sparkSession).select("channel", "wavelength_um").distinct()
    return df.join(F.broadcast(known), "channel", "left")


def has_dual_gain(group_channels: Column) -> Column:
    """True for a group's channel list that holds a dual-gain channel."""
    return F.arrays_overlap(group_channels, F.array(*(F.lit(c) for c in K.DUAL_GAIN_CHANNELS)))
