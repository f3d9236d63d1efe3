"""Static tables of a cube: latitude/longitude, projection axes, channels."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake import constants as K
from orbitlake.constants import DIMSIZE, SCAN_STEP_RAD
from orbitlake.plans import catalog
from orbitlake.plans.config import ConfigurationError, CubeConfig
from orbitlake.plans.variables import select_variables


def grid_rows(spark: SparkSession, resolution: str, rows: tuple[int, int] | None = None) -> DataFrame:
    """Full-disk row numbers of a resolution, or of a half-open row window."""
    size = DIMSIZE[resolution]
    start, stop = rows or (0, size)
    if not 0 <= start < stop <= size:
        raise ConfigurationError(f"rows {(start, stop)} must satisfy 0 <= start < stop <= {size}")
    return spark.range(start, stop).select(F.col("id").cast("int").alias("y"))


def geo_rows(
    spark: SparkSession,
    resolution: str,
    rows: tuple[int, int] | None = None,
    lon0: float = 0.0,
) -> DataFrame:
    """One row per grid line with latitude and longitude arrays; NULL off the Earth.

    The window is applied to the row numbers, before anything is computed.
    """
    return with_latlon(grid_rows(spark, resolution, rows), resolution, lon0)


LINES_PER_BATCH = 32


def with_latlon(lines: DataFrame, resolution: str, lon0: float = 0.0) -> DataFrame:
    """Add the latitude and longitude arrays of the full-disk row ``y``.

    The same formula as ``geolocation.latlon``, which stays the choice for single pixels. For whole
    lines the array functions of Spark interpret the formula per element, so the lines are computed
    in NumPy, a few at a time; Spark spreads the lines over the tasks.
    """
    size, step = DIMSIZE[resolution], SCAN_STEP_RAD[resolution]
    names = lines.columns
    schema = T.StructType(
        [
            *lines.schema.fields,
            T.StructField("resolution", T.StringType()),
            T.StructField("latitude", T.ArrayType(T.FloatType())),
            T.StructField("longitude", T.ArrayType(T.FloatType())),
        ]
    )

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x_angle = (np.arange(size) - (size / 2 - 0.5)) * step
        for batch in batches:
            for start in range(0, batch.num_rows, LINES_PER_BATCH):
                part = batch.slice(start, LINES_PER_BATCH)
                y = part.column("y").to_numpy(zero_copy_only=False)
                y_angle = (y - (size / 2 - 0.5)) * step
                latitude, longitude = visible_line(x_angle[None, :], y_angle[:, None], lon0)
                arrays = [part.column(name) for name in names]
                arrays.append(pa.array([resolution] * len(y)))
                arrays += [line_array(latitude), line_array(longitude)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return lines.mapInArrow(locate, schema)


def visible_line(
    x_angle: np.ndarray, y_angle: np.ndarray, lon0: float = 0.0
) -> tuple[np.ndarray, np.ndarray]:
    """Float32 latitude and longitude for broadcastable scan angles; NaN off the Earth."""
    flattening = (K.EQUATOR_RADIUS_KM / K.POLAR_RADIUS_KM) ** 2
    reach = K.ORBIT_RADIUS_KM**2 - K.EQUATOR_RADIUS_KM**2
    cos_y, sin_y = np.cos(y_angle), np.sin(y_angle)
    along = np.cos(x_angle) * cos_y
    curvature = cos_y * cos_y + flattening * sin_y * sin_y
    with np.errstate(invalid="ignore"):
        root = np.sqrt(K.ORBIT_RADIUS_KM**2 * along * along - curvature * reach)
    distance = (K.ORBIT_RADIUS_KM * along - root) / curvature
    towards = K.ORBIT_RADIUS_KM - distance * along
    east = distance * np.sin(x_angle) * cos_y
    level = np.sqrt(towards * towards + east * east)
    latitude = np.degrees(np.arctan(flattening * distance * sin_y / level)).astype(np.float32)
    longitude = np.degrees(np.arctan2(east, towards)).astype(np.float32)
    if lon0 != 0.0:
        turn, half = np.float32(360.0), np.float32(180.0)
        longitude = np.mod(longitude + np.float32(lon0) + half, turn) - half
    return latitude, longitude


def line_array(values: np.ndarray) -> pa.Array:
    """Lines of equal length as an Arrow list array with NaN as NULL."""
    offsets = np.arange(values.shape[0] + 1, dtype=np.int32) * values.shape[1]
    flat = values.ravel()
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, mask=np.isnan(flat)))


def geo_table(
    spark: SparkSession, config: CubeConfig, grid: str | None = None, resolutions: Sequence[str] | None = None
) -> DataFrame:
    """The latitude/longitude table of a cube, restricted to its row windows.

    ``grid`` is the path of exported grids: lines found there are read, all others computed.
    """
    tables = []
    for resolution in resolutions or catalog.config_resolutions(config):
        rows = catalog.row_window(config, resolution)
        if grid is None:
            tables.append(geo_rows(spark, resolution, rows, config.lon0))
        else:
            tables.append(known_or_computed(spark, grid, resolution, rows, config.lon0))
    table = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
    return table.withColumn("product_type", F.lit(config.product_type))


def axes(spark: SparkSession, config: CubeConfig, axis: str) -> DataFrame:
    """Projection coordinates of an axis; ``y`` holds the rows of the cube's window only."""
    pieces = []
    for resolution in catalog.config_resolutions(config):
        window = catalog.row_window(config, resolution)
        start, stop = window if axis == "y" else (0, DIMSIZE[resolution])
        index = spark.range(start, stop).select(F.col("id").cast("int").alias("index"))
        pieces.append(index.withColumn("resolution", F.lit(resolution)))
    both = pieces[0] if len(pieces) == 1 else pieces[0].unionByName(pieces[1])
    both = both.withColumn("product_type", F.lit(config.product_type))
    return select_variables(both, f"axis_{axis}", config, ())


GRID_SCHEMA = "y int, latitude array<float>, longitude array<float>, lon0 double, resolution string"


def exported_lines(spark: SparkSession, path: str, resolution: str, lon0: float = 0.0) -> DataFrame | None:
    """Lines of exported grids for a resolution and longitude; None where there are no grids.

    Both are partition columns, so lines of other grids are not read. Lines whose length is not
    that of the resolution, as grids of another layout have them, are left out.
    """
    try:
        stored = spark.read.schema(GRID_SCHEMA).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    size = DIMSIZE[resolution]
    own = stored.where((F.col("resolution") == resolution) & (F.col("lon0") == float(lon0)))
    return own.where((F.size("latitude") == size) & (F.size("longitude") == size)).drop("lon0")


def known_or_computed(
    spark: SparkSession, path: str, resolution: str, rows: tuple[int, int], lon0: float = 0.0
) -> DataFrame:
    """Lines of a half-open row window: those exported grids hold, the others computed.

    Only row numbers are compared; exported lines go from the scan to the result without a shuffle.
    """
    wanted = grid_rows(spark, resolution, rows)
    stored = exported_lines(spark, path, resolution, lon0)
    if stored is None:
        return with_latlon(wanted, resolution, lon0)
    known = stored.where((F.col("y") >= rows[0]) & (F.col("y") < rows[1]))
    missing = wanted.join(known.select("y"), "y", "left_anti")
    return with_latlon(missing, resolution, lon0).unionByName(known)


def export_geo(
    spark: SparkSession, resolutions: Sequence[str], path: str, lon0: float = 0.0, overwrite: bool = False
) -> None:
    """Write latitude/longitude tables for later cubes, one for each longitude and resolution.

    Grids of other longitudes and resolutions at the same path stay. A grid that is there already is
    refused, or replaced with ``overwrite``.
    """
    unknown = [r for r in resolutions if r not in DIMSIZE]
    if unknown:
        raise ConfigurationError(f"unknown resolutions {unknown}, expected {sorted(DIMSIZE)}")
    if not overwrite:
        grids = [(r, exported_lines(spark, path, r, lon0)) for r in resolutions]
        there = [r for r, lines in grids if lines is not None and not lines.isEmpty()]
        if there:
            raise ConfigurationError(f"grids of {there} at longitude {lon0} are there already")
    for resolution in dict.fromkeys(resolutions):
        table = geo_rows(spark, resolution, lon0=lon0).withColumn("lon0", F.lit(float(lon0)))
        # One partition is replaced as a whole, so a line is never there twice.
        (
            table.write.partitionBy("lon0", "resolution")
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(path)
        )


def geo_info(geo: DataFrame) -> DataFrame:
    """Lines, visible pixels, all pixels and their percentage per resolution."""
    # Counted inside each line first; one small row per task and resolution is shuffled.
    visible = F.size(F.filter("latitude", lambda v: v.isNotNull()))
    totals = geo.groupBy("resolution").agg(
        F.count("*").alias("lines"),
        F.sum(visible).alias("valid"),
        F.sum(F.size("latitude")).alias("total"),
    )
    return totals.withColumn("percent", F.round(100 * F.col("valid") / F.col("total"), 1))


def grid_stats(pixels: DataFrame) -> DataFrame:
    """The same from one row per pixel."""
    totals = pixels.groupBy("resolution").agg(
        F.count("latitude").alias("valid"), F.count("*").alias("total")
    )
    return totals.withColumn("percent", F.round(100 * F.col("valid") / F.col("total"), 1))


def channel_table(spark: SparkSession, config: CubeConfig) -> DataFrame:
    """Channel coordinate of a cube: name, index and wavelength."""
    plan = catalog.config_plan(spark, config)
    return select_variables(plan, "channels", config, ())


def static_tables(
    spark: SparkSession, config: CubeConfig, grid: str | None = None, located: Collection[str] = ()
) -> dict[str, DataFrame]:
    """All static tables of a cube by name; latitude and longitude from exported grids where given.

    Resolutions in ``located`` have their latitudes and longitudes already.
    """
    tables = {
        "channels": channel_table(spark, config),
        "axis_x": axes(spark, config, "x"),
        "axis_y": axes(spark, config, "y"),
    }
    left = [r for r in catalog.config_resolutions(config) if r not in located]
    if config.include_geolocation and left:
        tables["geo"] = select_variables(geo_table(spark, config, grid, left), "geo", config, ())
    return tables
