"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.operators import rasters
from orbitlake.plans import catalog
from orbitlake.plans.config import CubeConfig
from orbitlake.sources import grids
from workload import tables as t
from workload.calibration import located
from workload.registry import query


@query("time_map", f"WITH {t.TIME_SQL} SELECT scene_id, idx, time_s FROM last_rows")
def time_map(spark, sf):
    return rasters.time_map(t.time_rows(spark, sf))


@query(
    "time_lut",
    f"""WITH {t.TIME_SQL} SELECT scene_id, max(idx) + 1 AS n_entries, count(*) AS n_known,
      round(max(time_s), 4) AS last FROM last_rows GROUP BY scene_id""",
)
def time_lut(spark, sf):
    luts = rasters.time_lut(rasters.time_map(t.time_rows(spark, sf)))
    return luts.select(
        "scene_id",
        F.size("lut").cast("bigint").alias("n_entries"),
        F.size(F.filter("lut", lambda v: v.isNotNull())).cast("bigint").alias("n_known"),
        F.round(F.array_max("lut"), 4).alias("last"),
    )


@query(
    "platform_means",
    f"""WITH {t.TIME_SQL} SELECT scene_id, round(avg(lat), 6) AS subsatellite_latitude,
      round(avg(lon), 6) AS subsatellite_longitude, round(avg(alt), 3) AS platform_altitude
      FROM last_rows GROUP BY scene_id""",
)
def platform_means(spark, sf):
    means = rasters.platform_means(t.time_rows(spark, sf))
    return means.select(
        "scene_id",
        F.round("subsatellite_latitude", 6).alias("subsatellite_latitude"),
        F.round("subsatellite_longitude", 6).alias("subsatellite_longitude"),
        F.round("platform_altitude", 3).alias("platform_altitude"),
    )


def calib_rows(spark, sf):
    """Calibration of one file channel per event; some rows lack a scale."""
    event, value = F.col("event_id"), F.col("value")
    listed = F.array(*(F.lit(c) for c in ("vis_04", "ir_38", "vis_06", "ir_105", "wv_63")))
    return t.read(spark, sf, "events").select(
        F.concat(F.col("user_id"), F.lit("/"), F.pmod(event, F.lit(7))).alias("scene_id"),
        event.alias("part_order"),
        F.element_at(listed, (F.pmod(event, F.lit(5)) + 1).cast("int")).alias("nc_channel"),
        F.when(event % 4 != 0, value).alias("slope"),
        (value * 2).alias("offset"),
        (value * 3).alias("warm_slope"),
        (value * 4).alias("warm_offset"),
        *(F.when(event % 3 == 0, value).alias(name) for name in K.CONVERSION_CONSTANTS),
    )


CALIB_SQL = """calib AS (
  SELECT user_id || '/' || event_id % 7 AS scene_id, event_id AS part_order,
    ['vis_04', 'ir_38', 'vis_06', 'ir_105', 'wv_63'][event_id % 5 + 1] AS nc_channel,
    CASE WHEN event_id % 4 <> 0 THEN value END AS slope, value * 2 AS "offset",
    value * 3 AS warm_slope, value * 4 AS warm_offset,
    CASE WHEN event_id % 3 = 0 THEN value END AS constant FROM events),
first_cal AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY scene_id, nc_channel ORDER BY part_order) AS rn FROM calib WHERE slope IS NOT NULL)
  WHERE rn = 1)"""


@query(
    "calibration_table",
    f"""WITH {CALIB_SQL} SELECT scene_id, nc_channel, slope, "offset", warm_slope, constant AS c1
      FROM first_cal""",
)
def calibration_table(spark, sf):
    table = rasters.calibration_table(calib_rows(spark, sf))
    c1 = F.col("radiance_to_bt_conversion_constant_c1").alias("c1")
    return table.select("scene_id", "nc_channel", "slope", "offset", "warm_slope", c1)


SLOT_CAL_SQL = f"""WITH {t.CHANNELS_SQL}, {CALIB_SQL},
  g AS (SELECT DISTINCT f.scene_id, c.resolution FROM first_cal f
    JOIN cat c ON c.product_type = 'FDHSI' AND c.nc_channel = f.nc_channel),
  filled AS (SELECT g.scene_id, g.resolution, c.channel, c.dual, f.*
    EXCLUDE (scene_id, nc_channel, part_order, rn)
    FROM g JOIN cat c ON c.product_type = 'FDHSI' AND c.resolution = g.resolution
    LEFT JOIN first_cal f ON f.scene_id = g.scene_id AND f.nc_channel = c.nc_channel)"""


def _slot_calibration(spark, sf):
    plan = catalog.channels(spark).filter(F.col("product_type") == K.FDHSI)
    plan = plan.withColumn("channel_index", F.col("catalog_index"))
    return rasters.slot_calibration(rasters.calibration_table(calib_rows(spark, sf)), plan)


@query(
    "slope_offset_default",
    f"""{SLOT_CAL_SQL} SELECT scene_id, resolution, channel, coalesce(slope, 0) AS slope,
      coalesce("offset", 0) AS "offset", constant AS c1 FROM filled""",
)
def slope_offset_default(spark, sf):
    c1 = F.col("radiance_to_bt_conversion_constant_c1").alias("c1")
    return _slot_calibration(spark, sf).select(
        "scene_id", "resolution", "channel", "slope", "offset", c1
    )


@query(
    "warm_only_dual_gain",
    f"""{SLOT_CAL_SQL} SELECT scene_id, channel, CASE WHEN dual THEN warm_slope END AS warm_slope,
      CASE WHEN dual THEN warm_offset END AS warm_offset FROM filled""",
)
def warm_only_dual_gain(spark, sf):
    return _slot_calibration(spark, sf).select("scene_id", "channel", "warm_slope", "warm_offset")


@query(
    "grid_stats",
    f"""WITH {t.LATLON_SQL} SELECT resolution, count(latitude) AS valid, count(*) AS total,
      round(100.0::DOUBLE * count(latitude) / count(*), 1) AS percent FROM ll GROUP BY resolution""",
)
def grid_stats(spark, sf):
    return grids.grid_stats(located(spark, sf))


QUALITY_SQL = ", ".join(
    f"CAST(count(*) FILTER (quality & {1 << bit} <> 0) AS BIGINT) AS {flag}"
    for bit, flag in enumerate(K.QUALITY_FLAGS)
)


@query(
    "quality_summary",
    f"""WITH {t.SCAN_SQL} SELECT scene_id, {QUALITY_SQL}, count(*) AS n_pixels
      FROM pixel GROUP BY scene_id""",
)
def quality_summary(spark, sf):
    return rasters.quality_summary(t.scan_in(spark, sf), "scene_id")


@query(
    "assemble_scanlines",
    f"""WITH {t.CHANNELS_SQL}, {t.SCAN_SQL} SELECT p.y, c.channel, c.resolution,
      CAST(p.y // (CASE c.resolution WHEN '1km' THEN 278 ELSE 139 END) AS INTEGER) AS tile,
      string_agg(p.counts, ',' ORDER BY p.x) AS counts
      FROM pixel p JOIN cat c ON c.product_type = 'FDHSI' AND c.nc_channel = p.nc_channel
      GROUP BY p.y, c.channel, c.resolution""",
)
def assemble_scanlines(spark, sf):
    plan = catalog.config_plan(spark, CubeConfig(K.FDHSI))
    rows = rasters.assemble(t.scan_in(spark, sf), plan)
    counts = F.array_join("counts", ",").alias("counts")
    return rows.select(F.col("y").cast("bigint").alias("y"), "channel", "resolution", "tile", counts)
