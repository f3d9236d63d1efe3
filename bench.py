"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import workload  # noqa: E402 - needs the path above
from orbitlake.constants import DUAL_GAIN_CHANNELS, TILE_ROWS  # noqa: E402
from orbitlake.functions.radiometry import calibrated_row  # noqa: E402
from orbitlake.operators import rasters  # noqa: E402
from orbitlake.plans.config import CubeConfig  # noqa: E402
from orbitlake.plans.variables import select_variables  # noqa: E402
from orbitlake.session import configure, scratch_path  # noqa: E402
from orbitlake.sources import cube, grids  # noqa: E402
from workload import tables as t  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "mean_radiance",
    "brightness_temperature",
    "expand_scanline_time",
    "quality_summary",
    "time_map",
    "platform_means",
    "bundle_scenes",
    "tile_coverage",
    "uncovered_rows",
    "latlon",
    "attach_calibration",
    "merge_rows",
    "cube_diff",
    "read_cube",
    "ingest",
    "stream_ingest",
)
#: Pixels of a row at 1 km, and for how many line items there is one such row.
ROW_PIXELS = 11_136
ITEMS_PER_ROW = 174
CONFIG = CubeConfig("FDHSI")


def run(df: DataFrame) -> None:
    """Compute every row without collecting any."""
    df.write.format("noop").mode("overwrite").save()


def wide_scanlines(spark: SparkSession) -> DataFrame:
    """Full-width scanlines of one tile of ten slots, 64 pixels for each line item, derived from its keys."""
    pixels = F.sequence(F.lit(0), F.lit(ROW_PIXELS - 1))
    pick = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(ITEMS_PER_ROW)) == 0

    def row(factor: int, modulus: int, dtype: str):
        seed = F.col("l_partkey") * factor + F.col("l_suppkey")
        return F.transform(pixels, lambda x: F.pmod(seed + x, F.lit(modulus)).cast(dtype))

    items = t.read(spark, SF_DIR, "lineitem").where(pick).repartition(int(CPUS))
    return items.select(
        F.lit("FDHSI").alias("product_type"),
        F.lit("1km").alias("resolution"),
        F.pmod("l_suppkey", F.lit(10)).alias("scene_id"),
        F.pmod("l_suppkey", F.lit(10)).cast("long").alias("slot"),
        F.pmod("l_orderkey", F.lit(TILE_ROWS["1km"])).cast("int").alias("y"),
        F.when(F.col("l_suppkey") % 16 == 0, "ir_38").otherwise("wv_63").alias("channel"),
        F.when(F.col("l_suppkey") % 16 == 0, 0).otherwise(1).alias("channel_index"),
        row(7, 8192, "int").alias("counts"),
        row(3, 256, "smallint").alias("quality"),
        row(1, 500, "int").alias("index_map"),
    )


def scanline_stage(spark: SparkSession, path: str) -> tuple[float, int]:
    """Decoded rows to a written cube with pixel times, all that follows the decode; seconds, pixels."""
    scan = spark.read.parquet(path)
    pixels = scan.count() * ROW_PIXELS
    cube_path = scratch_path(spark, "bench-cube")
    start = time.time()
    luts = rasters.time_lut(rasters.time_map(t.time_rows(spark, SF_DIR)))
    timed = rasters.attach_time_lut(scan, luts)
    rows = select_variables(timed, "scanlines", CONFIG, ["ir_38", "wv_63"])
    cube.write_cube(cube.with_tiles(rows, CONFIG), cube_path)
    return time.time() - start, pixels


def radiance_stage(spark: SparkSession, path: str) -> float:
    """Calibrated radiance of the same rows; seconds."""
    scan = spark.read.parquet(path)
    start = time.time()
    dual_gain = F.col("channel").isin(*DUAL_GAIN_CHANNELS)
    radiance = calibrated_row(
        F.col("counts"), dual_gain, F.lit(0.0012), F.lit(-0.25), F.lit(0.0242), F.lit(-94.4)
    )
    run(scan.select("y", radiance.alias("radiance")))
    return time.time() - start


def _decoded_path(spark: SparkSession) -> str:
    path = scratch_path(spark, "bench")
    wide_scanlines(spark).write.parquet(path)
    return path


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    configure(spark)
    run(t.read(spark, SF_DIR, "region"))
    timings: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        run(workload.QUERIES[name](spark, SF_DIR))
        timings[name] = round(time.time() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)

    path = _decoded_path(spark)
    # The first run compiles; the second is the steady state of a long job.
    scanline_stage(spark, path)
    seconds, pixels = scanline_stage(spark, path)
    timings["scanline_stage"] = round(seconds, 3)
    radiance_stage(spark, path)
    timings["radiance_stage"] = round(radiance_stage(spark, path), 3)
    start = time.time()
    run(grids.geo_rows(spark, "2km"))
    timings["geo_grid_2km"] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(SF_DIR).name,
                "scanline_stage_mpixels": round(pixels / 1e6, 1),
                "sec_per_mpixel": round(seconds / (pixels / 1e6), 5),
                "core_sec_per_mpixel": round(seconds * int(CPUS) / (pixels / 1e6), 5),
            }
        )
    )


if __name__ == "__main__":
    main()
