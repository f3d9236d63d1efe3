"""Calibration and geolocation."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.functions import ephemeris, geolocation, radiometry
from orbitlake.functions.slots import slot_label
from orbitlake.operators import rasters
from orbitlake.plans import catalog
from orbitlake.plans.config import CubeConfig
from orbitlake.sources import grids
from workload import tables as t
from workload.registry import query

CALIBRATED_SQL = f"""{t.SLOT_CHANNEL_SQL},
rad AS (
  SELECT event_id, slot, channel, value, counts, counts * slope + "offset" AS cold,
    CASE WHEN dual AND counts > 4095 THEN counts * warm_slope + warm_offset
      ELSE counts * slope + "offset" END AS radiance
  FROM acq JOIN cal USING (slot, channel))"""


def calibrated(spark, sf):
    """Every acquisition with the radiance of its counts."""
    joined = rasters.attach_calibration(
        t.acquisitions(spark, sf), t.slot_channel(spark, sf), ["slot", "channel"]
    )
    radiance = radiometry.calibrated(
        F.col("counts"), F.col("dual_gain"), F.col("slope"), F.col("offset"),
        F.col("warm_slope"), F.col("warm_offset"),
    )
    return joined.withColumn("radiance", radiance)


@query(
    "mean_radiance",
    f"""WITH {CALIBRATED_SQL} SELECT slot, channel, round(avg(radiance), 6) AS mean_radiance,
      count(*) AS n_pixels FROM rad GROUP BY slot, channel""",
)
def mean_radiance(spark, sf):
    """Mean radiance per slot and channel."""
    return calibrated(spark, sf).groupBy("slot", "channel").agg(
        F.round(F.avg("radiance"), 6).alias("mean_radiance"), F.count("*").alias("n_pixels")
    )


@query("radiance", f"WITH {CALIBRATED_SQL} SELECT event_id, round(cold, 8) AS radiance FROM rad")
def radiance(spark, sf):
    value = radiometry.radiance(F.col("counts"), F.col("slope"), F.col("offset"))
    return calibrated(spark, sf).select("event_id", F.round(value, 8).alias("radiance"))


@query(
    "radiance_dual_gain",
    f"""WITH {CALIBRATED_SQL} SELECT event_id, counts > 4095 AS warm, round(radiance, 8) AS radiance
      FROM rad WHERE channel = 'ir_38'""",
)
def radiance_dual_gain(spark, sf):
    value = radiometry.radiance_dual_gain(
        F.col("counts"), F.col("slope"), F.col("offset"), F.col("warm_slope"), F.col("warm_offset")
    )
    pixels = calibrated(spark, sf).filter(F.col("channel") == "ir_38")
    warm = F.col("counts") > K.COLD_COUNT_MAX
    return pixels.select("event_id", warm.alias("warm"), F.round(value, 8).alias("radiance"))


@query(
    "radiance_per_um",
    f"WITH {CALIBRATED_SQL} SELECT event_id, round(radiance * (value * pi()), 6) + 0.0::DOUBLE AS radiance FROM rad",
)
def radiance_per_um(spark, sf):
    per_um = radiometry.radiance_per_um(F.col("radiance"), F.col("value") * math.pi)
    return calibrated(spark, sf).select("event_id", (F.round(per_um, 6) + 0.0).alias("radiance"))


# Constants of an infrared channel near 10.5 um (centre 952 cm-1, CODATA c1 and c2).
BT = {"nu": 952.0, "a": 0.9992, "b": 0.33, "c1": 1.19104273e-05, "c2": 1.4387752}


@query(
    "brightness_temperature",
    f"""WITH {CALIBRATED_SQL} SELECT event_id, CASE WHEN radiance > 0 THEN
      round((({BT['c2']}::DOUBLE * {BT['nu']}::DOUBLE) / ln(1 + {BT['c1']}::DOUBLE * {BT['nu']}::DOUBLE
        * {BT['nu']}::DOUBLE * {BT['nu']}::DOUBLE / radiance) - {BT['b']}::DOUBLE) / {BT['a']}::DOUBLE, 6)
      END AS bt FROM rad""",
)
def brightness_temperature(spark, sf):
    c = {name: F.lit(value) for name, value in BT.items()}
    bt = radiometry.brightness_temperature(
        F.col("radiance"), c["nu"], c["a"], c["b"], c["c1"], c["c2"]
    )
    return calibrated(spark, sf).select("event_id", F.round(bt, 6).alias("bt"))


@query(
    "reflectance",
    f"""WITH {CALIBRATED_SQL} SELECT event_id, round(pi() * radiance * 1.0157::DOUBLE * 1.0157::DOUBLE
      / (65.2::DOUBLE * cos(radians(event_id % 80))), 6) AS reflectance FROM rad""",
)
def reflectance(spark, sf):
    value = radiometry.reflectance(
        F.col("radiance"), F.lit(1.0157), F.lit(65.2), F.pmod("event_id", F.lit(80))
    )
    return calibrated(spark, sf).select("event_id", F.round(value, 6).alias("reflectance"))


def _radius_sql() -> str:
    powers = []
    for power, series in enumerate(ephemeris.RADIUS_SERIES):
        terms = " + ".join(
            f"{float(a)!r}::DOUBLE * cos({float(b)!r}::DOUBLE + {float(c)!r}::DOUBLE * tau)"
            for a, b, c in series
        )
        powers.append(f"power(tau, {power}) * ({terms})")
    return f"({' + '.join(powers)}) / 1e8"


@query(
    "sun_earth_distance",
    f"""WITH j AS (SELECT DISTINCT date_trunc('minute', ts) AS t,
        (epoch(date_trunc('minute', ts)) - {ephemeris.J2000_UNIX}::DOUBLE + {ephemeris.TT_MINUS_UTC_S}::DOUBLE)
        / {ephemeris.MILLENNIUM_S}::DOUBLE AS tau FROM events)
      SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS time, round({_radius_sql()}, 9) AS distance FROM j""",
)
def sun_earth_distance(spark, sf):
    labels = t.read(spark, sf, "events").select(slot_label(F.col("ts")).alias("t")).distinct()
    distance = ephemeris.sun_earth_distance(F.col("t"))
    return labels.select(t.text("t").alias("time"), F.round(distance, 9).alias("distance"))


@query(
    "quality_bits",
    f"""WITH {t.SCAN_SQL} SELECT y, x, quality & 4 <> 0 AS noise, quality & 128 <> 0 AS saturated
      FROM pixel""",
)
def quality_bits(spark, sf):
    pixels = rasters.pixels(t.scan_in(spark, sf).select("y", "quality"), "quality")
    q = F.col("quality")
    return pixels.select(
        "y",
        F.col("x").cast("bigint").alias("x"),
        radiometry.quality_bit(q, "noise_warning").alias("noise"),
        radiometry.quality_bit(q, "encoding_saturation_warning").alias("saturated"),
    )


@query(
    "radiance_rows",
    f"""WITH {t.SCAN_SQL} SELECT y, round(CASE WHEN counts > 4095 AND nc_channel = 'ir_38'
      THEN counts * 0.0242::DOUBLE - 94.4::DOUBLE ELSE counts * 0.0012::DOUBLE - 0.25::DOUBLE END, 8)
      AS radiance, x FROM pixel""",
)
def radiance_rows(spark, sf):
    """Whole scanlines calibrated in place, then exploded."""
    radiance = radiometry.calibrated_row(
        F.col("counts"), F.col("nc_channel").isin(*K.DUAL_GAIN_CHANNELS),
        F.lit(0.0012), F.lit(-0.25), F.lit(0.0242), F.lit(-94.4),
    )
    rows = rasters.pixels(t.scan_in(spark, sf).select("y", radiance.alias("radiance")), "radiance")
    return rows.select(
        "y", F.col("x").cast("bigint").alias("x"), F.round("radiance", 8).alias("radiance")
    )


@query(
    "projection_axes",
    f"""WITH {t.PIXELS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, round(xa * 35786400, 3) AS x_m,
      round(ya * 35786400, 3) AS y_m, round(xa, 10) AS x_rad FROM pt""",
)
def projection_axes(spark, sf):
    res = F.col("resolution")
    return t.grid_pixels(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(geolocation.proj_xy(F.col("col"), res), 3).alias("x_m"),
        F.round(geolocation.proj_xy(F.col("row"), res), 3).alias("y_m"),
        F.round(geolocation.proj_xy(F.col("col"), res, "radian"), 10).alias("x_rad"),
    )


@query(
    "axis_slice",
    f"""WITH {t.PIXELS_SQL}, {t.WINDOWS_SQL} SELECT DISTINCT resolution, "row" AS y, "row" - y_start AS y_offset,
      round(ya * 35786400, 3) AS y_m FROM pt JOIN win USING (resolution) WHERE "row" >= y_start AND "row" < y_stop""",
)
def axis_slice(spark, sf):
    """The y axis of a stripe is a slice of the full-disk axis, on every grid."""
    lines = t.grid_pixels(spark, sf).select("resolution", F.col("row").alias("index")).distinct()
    found = []
    for product, resolutions in ((K.FDHSI, None), (K.HRFI, "500m")):
        config = CubeConfig(product, resolutions, body_chunks=(32, 40))
        axis = grids.axes(spark, config, "y").join(lines, ["resolution", "index"])
        starts = {r: catalog.row_window(config, r)[0] for r in catalog.config_resolutions(config)}
        found.append(axis.withColumn("y_offset", F.col("index") - geolocation.lookup(F.col("resolution"), starts)))
    rows = found[0].unionByName(found[1])
    return rows.select("resolution", F.col("index").alias("y"), "y_offset", F.round("y", 3).alias("y_m"))


def located(spark, sf, lon0: float = 0.0):
    at = geolocation.latlon(F.col("row"), F.col("col"), F.col("resolution"), lon0)
    return t.grid_pixels(spark, sf).withColumn("at", at).select("*", "at.*").drop("at")


def _degrees(df):
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(F.col("latitude").cast("double"), 3).alias("latitude"),
        F.round(F.col("longitude").cast("double"), 3).alias("longitude"),
    )


@query(
    "latlon",
    f"""WITH {t.LATLON_SQL} SELECT l_orderkey, l_linenumber, l_partkey,
      round(CAST(latitude AS DOUBLE), 3) AS latitude, round(CAST(longitude AS DOUBLE), 3) AS longitude
      FROM ll""",
)
def latlon(spark, sf):
    return _degrees(located(spark, sf))


@query(
    "shift_lon",
    f"""WITH {t.LATLON_SQL} SELECT l_orderkey, l_linenumber, l_partkey,
      round(CAST(latitude AS DOUBLE), 3) AS latitude,
      round(CAST(CASE WHEN longitude + 140::FLOAT + 180::FLOAT >= 360
        THEN longitude + 140::FLOAT + 180::FLOAT - 360::FLOAT
        ELSE longitude + 140::FLOAT + 180::FLOAT END - 180::FLOAT AS DOUBLE), 3) AS longitude FROM ll""",
)
def shift_lon(spark, sf):
    return _degrees(located(spark, sf, 140.0))


@query(
    "geo_lines",
    """WITH line AS (SELECT DISTINCT CAST(s_suppkey * 53 % 5568 AS INTEGER) AS y FROM supplier),
      p AS (SELECT y, (x - 2783.5::DOUBLE) * 5.58871526468e-05::DOUBLE AS xa,
        (y - 2783.5::DOUBLE) * 5.58871526468e-05::DOUBLE AS ya
        FROM line, (SELECT unnest(range(0, 5568)) AS x)),
      d AS (SELECT y, power(42164.537::DOUBLE * cos(xa) * cos(ya), 2)
        - (cos(ya) * cos(ya) + power(6378.137::DOUBLE / 6356.752314, 2) * sin(ya) * sin(ya))
        * (power(42164.537::DOUBLE, 2) - power(6378.137::DOUBLE, 2)) AS disc FROM p)
      SELECT '2km' AS resolution, y, count(*) FILTER (disc >= 0) AS valid, count(*) AS total
      FROM d GROUP BY y""",
)
def geo_lines(spark, sf):
    """Whole grid lines, one per distinct row named by a supplier."""
    lines = t.read(spark, sf, "supplier").select(
        F.pmod(F.col("s_suppkey") * 53, F.lit(5568)).cast("int").alias("y")
    )
    geo = grids.with_latlon(lines.distinct(), "2km")
    return geo.select(
        "resolution",
        "y",
        F.size(F.filter("latitude", lambda v: v.isNotNull())).cast("bigint").alias("valid"),
        F.size("latitude").cast("bigint").alias("total"),
    )


@query(
    "geo_info",
    """WITH line AS (SELECT DISTINCT CAST(s_suppkey * 53 % 5568 AS INTEGER) AS y FROM supplier),
      p AS (SELECT y, (x - 2783.5::DOUBLE) * 5.58871526468e-05::DOUBLE AS xa,
        (y - 2783.5::DOUBLE) * 5.58871526468e-05::DOUBLE AS ya
        FROM line, (SELECT unnest(range(0, 5568)) AS x)),
      d AS (SELECT y, power(42164.537::DOUBLE * cos(xa) * cos(ya), 2)
        - (cos(ya) * cos(ya) + power(6378.137::DOUBLE / 6356.752314, 2) * sin(ya) * sin(ya))
        * (power(42164.537::DOUBLE, 2) - power(6378.137::DOUBLE, 2)) AS disc FROM p)
      SELECT '2km' AS resolution, count(DISTINCT y) AS lines, count(*) FILTER (disc >= 0) AS valid,
        count(*) AS total, round(100.0::DOUBLE * count(*) FILTER (disc >= 0) / count(*), 1) AS percent
      FROM d""",
)
def geo_info(spark, sf):
    lines = t.read(spark, sf, "supplier").select(
        F.pmod(F.col("s_suppkey") * 53, F.lit(5568)).cast("int").alias("y")
    )
    return grids.geo_info(grids.with_latlon(lines.distinct(), "2km"))
