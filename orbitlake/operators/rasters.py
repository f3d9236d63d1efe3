"""Decoded part tables to scanlines and per-slot values.

Row tables carry ``part_order`` (position of the part in its scene) and ``row_no`` (position in the
part): which row wins never depends on arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.constants import (
    CONVERSION_CONSTANTS,
    INDEX_FILL,
    PLATFORM_COLUMNS,
    QUALITY_FLAGS,
)
from orbitlake.functions import fills
from orbitlake.functions.radiometry import quality_bit
from orbitlake.functions.slots import pixel_time_as
from orbitlake.plans import catalog


def arrival() -> Column:
    """Position of a row in its scene as one number, so that max_by stays a hash aggregate.

    Part orders use the whole 64 bits, hence a decimal.
    """
    part = F.col("part_order").cast("decimal(20,0)")
    return part * F.lit(10_000_000_000).cast("decimal(11,0)") + F.col("row_no").cast("decimal(10,0)")


def time_map(time_rows: DataFrame) -> DataFrame:
    """Index to time per scene: the last part that names an index wins."""
    return time_rows.groupBy("scene_id", "idx").agg(
        F.max_by("time_s", arrival()).alias("time_s")
    )


def usable_index(index: Column) -> Column:
    """Indices a pixel can refer to; the type maximum marks a missing pixel even if it is mapped."""
    return (index >= 0) & (index < INDEX_FILL)


def time_lut(times: DataFrame, dtype: str = "float64") -> DataFrame:
    """A time map as one array per scene, position = index, NULL where an index is unmapped.

    Indices are 16-bit, so an array has at most 65,535 elements. Times take their storage type here,
    once per index, so that a pixel only looks its value up.
    """
    known = times.filter(usable_index(F.col("idx"))).withColumn(
        "time_s", pixel_time_as(F.col("time_s"), dtype)
    )
    dense = (
        known.groupBy("scene_id")
        .agg(F.max("idx").alias("last"))
        .select("scene_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("idx"))
    )
    entries = dense.join(known, ["scene_id", "idx"], "left")
    ordered = F.sort_array(F.collect_list(F.struct("idx", "time_s")))
    return entries.groupBy("scene_id").agg(ordered["time_s"].alias("lut"))


def expand_pixel_time(pixels: DataFrame, times: DataFrame) -> DataFrame:
    """Pixel form: one row per pixel with its ``idx``; adds ``time_s``, NULL for a miss."""
    known = times.filter(usable_index(F.col("idx")))
    return pixels.join(known, ["scene_id", "idx"], "left")


def attach_time_lut(scan: DataFrame, luts: DataFrame) -> DataFrame:
    """Give every scanline the time array of its scene.

    Adaptive execution broadcasts arrays that turn out small, and splits a scene that fills a task.
    """
    return scan.join(luts, "scene_id", "left")


def expand_scanline_time(index_map: Column, lut: Column) -> Column:
    """Scanline form: the time of every pixel of a row, by position in the scene's array."""
    return F.transform(index_map, lambda i: F.get(lut, i))


def platform_means(platform_rows: DataFrame) -> DataFrame:
    """Mean of each platform column over the cycle.

    The last part wins an index as a whole row; then finite values are averaged per column, and a
    column without any is NULL.
    """
    rows = platform_rows.groupBy("scene_id", "idx").agg(
        *(F.max_by(c, arrival()).alias(c) for c in PLATFORM_COLUMNS)
    )

    def finite(column: str) -> Column:
        value = F.nanvl(F.col(column), F.lit(None))
        return F.when(F.abs(value) < float("inf"), value)

    return rows.groupBy("scene_id").agg(*(F.avg(finite(c)).alias(c) for c in PLATFORM_COLUMNS))


CALIBRATION_COLUMNS = ("slope", "offset", "warm_slope", "warm_offset", *CONVERSION_CONSTANTS)


def calibration_table(calib_rows: DataFrame) -> DataFrame:
    """Calibration per scene and channel: the first part that carries scale and offset."""
    complete = calib_rows.filter(F.col("slope").isNotNull() & F.col("offset").isNotNull())
    # A number to order by and numbers to keep: this stays a hash aggregate.
    first = (F.min_by(c, "part_order").alias(c) for c in CALIBRATION_COLUMNS)
    return complete.groupBy("scene_id", "nc_channel").agg(*first)


def slot_calibration(calibration: DataFrame, plan: DataFrame, strict: bool = False) -> DataFrame:
    """Calibration rows of every planned channel, for groups where any channel has one.

    A channel without calibration gets slope and offset 0.0 (NULL with ``strict``) and NULL for the
    rest. Warm values are kept for dual-gain channels only, whatever the file holds.
    """
    values = F.struct(*CALIBRATION_COLUMNS)
    # One group holds at most the channels of one resolution.
    groups = (
        calibration.join(F.broadcast(plan.select("nc_channel", "resolution")), "nc_channel")
        .groupBy("scene_id", "resolution")
        .agg(F.map_from_entries(F.collect_list(F.struct("nc_channel", values))).alias("known"))
    )
    members = plan.select(
        "product_type", "resolution", "channel", "nc_channel", "channel_index", "dual_gain"
    )
    joined = groups.join(F.broadcast(members), "resolution").withColumn(
        "c", F.try_element_at("known", F.col("nc_channel"))
    )

    def value(column: str) -> Column:
        found = F.col(f"c.{column}")
        if column.startswith("warm_"):
            return F.when(F.col("dual_gain"), found).alias(column)
        if column in ("slope", "offset") and not strict:
            return F.coalesce(found, F.lit(0.0)).alias(column)
        return found.alias(column)

    return joined.select(
        "scene_id",
        "product_type",
        "resolution",
        "channel",
        "channel_index",
        *(value(c) for c in CALIBRATION_COLUMNS),
    )


def parts_of_group(chunk_rows: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """Row span of each part per resolution it holds; parts without any channel drop out.

    All channels of a resolution share their rows; the first channel by name speaks for the part.
    ``plan`` narrows the resolutions.
    """
    known = catalog.channels(chunk_rows.sparkSession).select(
        "product_type", "nc_channel", "resolution"
    )
    if plan is not None:
        wanted = plan.select("product_type", "resolution").distinct()
        known = known.join(F.broadcast(wanted), ["product_type", "resolution"], "left_semi")
    # A number per name, and one per span: minima of numbers are folded without a sort.
    names = sorted({nc for members in K.CHANNELS.values() for _channel, nc in members})
    rank = F.array_position(F.array(*(F.lit(n) for n in names)), F.col("nc_channel"))
    place = rank * (1 << 48) + F.col("row_start").cast("bigint") * (1 << 24) + F.col("row_stop")
    spans = chunk_rows.join(F.broadcast(known), "nc_channel").withColumn("_place", place)
    keys = ("scene_id", "product_type", "resolution", "part_order", "chunk_no")
    return spans.groupBy(*keys).agg(
        F.min_by("row_start", "_place").alias("row_start"),
        F.min_by("row_stop", "_place").alias("row_stop"),
    )


def crop_rows(df: DataFrame, y_start: int, y_stop: int) -> DataFrame:
    """Rows of a window, with their position in it as ``y_offset``; ``y`` stays the full-disk row."""
    return df.filter((F.col("y") >= y_start) & (F.col("y") < y_stop)).withColumn(
        "y_offset", F.col("y") - y_start
    )


def in_window(df: DataFrame) -> DataFrame:
    """Rows inside the per-resolution window columns ``y_start``/``y_stop``."""
    return df.filter((F.col("y") >= F.col("y_start")) & (F.col("y") < F.col("y_stop")))


def has_time_map(scenes: DataFrame, time_rows: DataFrame) -> DataFrame:
    """Mark scenes whose files carry any time table; the others get no pixel_time at all."""
    present = time_rows.select("scene_id").distinct().withColumn("has_time", F.lit(True))
    return scenes.join(present, "scene_id", "left").withColumn(
        "has_time", F.coalesce("has_time", F.lit(False))
    )


def assemble(scan: DataFrame, plan: DataFrame) -> DataFrame:
    """Scanlines of the planned channels inside their windows, keyed by full-disk row.

    Rows need no concatenation: a row belongs to the part that holds it. ``tile`` is the output tile.
    """
    return in_window(scan.join(F.broadcast(plan), "nc_channel")).withColumn(
        "tile", F.floor(F.col("y") / F.col("tile_rows")).cast("int")
    )


def pixels(scanlines: DataFrame, *arrays: str) -> DataFrame:
    """Explode scanline arrays to one row per pixel with its column ``x``."""
    keep = [c for c in scanlines.columns if c not in arrays]
    zipped = F.posexplode(F.arrays_zip(*arrays)).alias("x", "pixel")
    return scanlines.select(*keep, zipped).select(
        *keep, "x", *(F.col(f"pixel.{a}").alias(a) for a in arrays)
    )


def quality_summary(scanlines: DataFrame, *keys: str) -> DataFrame:
    """Number of pixels with each warning flag set, per group."""
    exploded = scanlines.select(*keys, F.explode("quality").alias("q"))
    return exploded.groupBy(*keys).agg(
        *(F.count_if(quality_bit(F.col("q"), flag)).alias(flag) for flag in QUALITY_FLAGS),
        F.count("q").alias("n_pixels"),
    )


CALIBRATION_KEYS = ("product_type", "resolution", "slot", "channel")
GEO_KEYS = ("product_type", "resolution", "y")


def attach_calibration(
    scan: DataFrame,
    slot_channel: DataFrame,
    keys: Sequence[str] = CALIBRATION_KEYS,
) -> DataFrame:
    """Join per-slot calibration to scanlines or pixels."""
    return scan.join(slot_channel, list(keys), "left")


def attach_geo(
    scan: DataFrame,
    geo: DataFrame,
    keys: Sequence[str] = GEO_KEYS,
) -> DataFrame:
    """Join the latitude/longitude rows to scanlines; each row of the grid occurs equally often."""
    return scan.join(geo, list(keys), "left")


def mask_counts(scanlines: DataFrame) -> DataFrame:
    """Stored fill in ``counts`` to NULL."""
    return scanlines.withColumn("counts", fills.mask_fill_row(F.col("counts")))
