"""Winner rules, pixel time, calibration, geolocation."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orbitlake import ConfigurationError, CubeConfig
from orbitlake import constants as K
from orbitlake.functions import fills, geolocation, radiometry
from orbitlake.operators import rasters
from orbitlake.plans import catalog
from orbitlake.sources import grids


def times(spark, *rows):
    schema = "scene_id string, part_order bigint, row_no int, idx bigint, time_s double"
    return spark.createDataFrame([("s", *r) for r in rows], schema)


def test_last_part_wins_an_index(spark):
    rows = times(
        spark, (1, 0, 0, 10.0), (1, 1, 1, 20.0), (2, 0, 1, 30.0), (2, 1, 2, 40.0), (1 << 62, 0, 2, 50.0)
    )
    found = {r.idx: r.time_s for r in rasters.time_map(rows).collect()}
    assert found == {0: 10.0, 1: 30.0, 2: 50.0}


def test_later_row_of_one_part_wins(spark):
    found = rasters.time_map(times(spark, (1, 5, 7, 2.0), (1, 4, 7, 1.0))).first()
    assert found.time_s == 2.0


def test_index_misses_are_null(spark):
    rows = times(spark, (1, 0, 0, 0.0), (1, 1, 1, 10.5), (1, 2, 2, 20.25), (1, 3, 65535, 999.0))
    mapped = rasters.time_map(rows)
    lut = rasters.time_lut(mapped)
    scan = spark.createDataFrame(
        [("s", "vis_04", 0, [0, 1, 3, 2, -1, 99, 65535, None])],
        "scene_id string, nc_channel string, y int, index_map array<int>",
    )
    for parts in (1, 3):
        joined = rasters.attach_time_lut(scan.repartition(parts), lut)
        got = joined.select(rasters.expand_scanline_time(F.col("index_map"), F.col("lut"))).first()[0]
        assert got == [0.0, 10.5, None, 20.25, None, None, None, None]
    pixels = scan.select("scene_id", "y", F.explode(F.col("index_map").cast("array<bigint>")).alias("idx"))
    got = rasters.expand_pixel_time(pixels, mapped).filter("time_s is not null")
    assert sorted(r.time_s for r in got.collect()) == [0.0, 10.5, 20.25]


@pytest.mark.parametrize(
    ("dtype", "expected"),
    [("float64", [1.75, None]), ("float32", [1.75, None]), ("int32", [1, None]), ("int64", [1, None])],
)
def test_time_arrays_take_the_storage_type(spark, dtype, expected):
    mapped = rasters.time_map(times(spark, (1, 0, 0, 1.75), (1, 1, 1, float("nan"))))
    assert rasters.time_lut(mapped, dtype).first().lut == expected


def test_lookups_keep_every_row(spark):
    """A key that most rows share, keys without a match, and an empty side."""
    scan = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("string").alias("scene_id"), "id"
    )
    luts = spark.range(0, 1000, 7).select(
        F.col("id").cast("string").alias("scene_id"), F.array(F.col("id") * 2.0).alias("lut")
    )
    got = {r.id: r.lut for r in rasters.attach_time_lut(scan, luts).collect()}
    for number in range(1000):
        key = 7 if number % 3 == 0 else number
        assert got[number] == ([key * 2.0] if key % 7 == 0 else None)
    assert rasters.attach_time_lut(scan, luts.limit(0)).where("lut is null").count() == 1000


def test_platform_means(spark):
    nan = float("nan")
    rows = [
        ("s", 1, 0, 6, 0.10, -0.39, 35781000.0),
        ("s", 1, 1, 7, 0.20, -0.39, 35781100.0),
        ("s", 2, 0, 7, 0.40, -0.40, 35781200.0),
        ("s", 2, 1, 8, nan, -0.40, 35781300.0),
        ("t", 1, 0, 1, None, float("inf"), nan),
    ]
    schema = "scene_id string, part_order bigint, row_no int, idx bigint, " + ", ".join(
        f"{c} double" for c in K.PLATFORM_COLUMNS
    )
    found = {r.scene_id: r for r in rasters.platform_means(spark.createDataFrame(rows, schema)).collect()}
    assert found["s"].subsatellite_latitude == pytest.approx(0.25)
    assert found["s"].subsatellite_longitude == pytest.approx(-1.19 / 3)
    assert found["s"].platform_altitude == pytest.approx(35781166.6667)
    assert found["t"][1:] == (None, None, None)


def calibration(spark, rows):
    schema = "scene_id string, part_order bigint, nc_channel string, " + ", ".join(
        f"{c} double" for c in rasters.CALIBRATION_COLUMNS
    )
    rows = [(*r, *([None] * (len(rasters.CALIBRATION_COLUMNS) - len(r) + 3))) for r in rows]
    return rasters.calibration_table(spark.createDataFrame(rows, schema))


def test_first_complete_part_gives_the_calibration(spark):
    table = calibration(
        spark, [("s", 3, "vis_04", 3.0, 0.3), ("s", 1, "vis_04", None, 0.1), ("s", 2, "vis_04", 2.0, 0.2)]
    )
    assert [(r.slope, r.offset) for r in table.collect()] == [(2.0, 0.2)]


def test_channels_without_calibration(spark):
    table = calibration(spark, [("s", 1, "ir_38", 2.0, 0.2, 5.0, 6.0), ("s", 1, "wv_63", 3.0, 0.3, 7.0, 8.0)])
    plan = catalog.config_plan(spark, CubeConfig("FDHSI", channels="ir_38,wv_63,ir_87,vis_04"))
    found = {r.channel: r for r in rasters.slot_calibration(table, plan).collect()}
    assert set(found) == {"ir_38", "wv_63", "ir_87"}  # the 1 km group has none and is not written
    assert (found["ir_87"].slope, found["ir_87"].offset) == (0.0, 0.0)
    assert found["ir_87"].radiance_to_bt_conversion_constant_c1 is None
    assert (found["ir_38"].warm_slope, found["ir_38"].warm_offset) == (5.0, 6.0)
    assert (found["wv_63"].warm_slope, found["wv_63"].warm_offset) == (None, None)
    strict = {r.channel: r for r in rasters.slot_calibration(table, plan, strict=True).collect()}
    assert strict["ir_87"].slope is None


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_radiometry(spark):
    lit = F.lit
    cold = (lit(0.001224690000526607), lit(-0.24983632564544678))
    warm = (lit(0.02422214113175869), lit(-94.42408752441406))
    got = one(
        spark,
        radiometry.radiance_dual_gain(lit(4095), *cold, *warm),
        radiometry.radiance_dual_gain(lit(4096), *cold, *warm),
        radiometry.brightness_temperature(lit(-1.0), *(lit(1.0) for _ in range(5))),
        radiometry.brightness_temperature(lit(0.0), *(lit(1.0) for _ in range(5))),
        radiometry.reflectance(lit(10.0), lit(1.0), lit(65.2), lit(60.0)),
        radiometry.reflectance(lit(10.0), lit(1.0), lit(0.0), lit(60.0)),
        radiometry.quality_bit(lit(130).cast("smallint"), "radiometric_warning"),
        radiometry.quality_bit(lit(130).cast("smallint"), "noise_warning"),
    )
    assert got[0] == pytest.approx(4095 * 0.001224690000526607 - 0.24983632564544678)
    assert got[1] == pytest.approx(4096 * 0.02422214113175869 - 94.42408752441406)
    assert got[2] is None and got[3] is None
    assert got[4] == pytest.approx(math.pi * 10 / (65.2 * math.cos(math.radians(60))))
    assert got[5] is None and got[6] is True and got[7] is False


def test_fills(spark):
    lit = F.lit
    got = one(
        spark,
        fills.source_fill_to_null(lit(9.96921e36).cast("float")),
        fills.source_fill_to_null(lit(float("nan"))),
        fills.source_fill_to_null(lit(1.5), lit(1.5)),
        fills.source_fill_to_null(lit(9.96921e36), lit(1.5)),
        fills.mask_fill(lit(65535)),
        fills.mask_fill_row(F.array(lit(1), lit(65535))),
        fills.row_bounds(lit(3), lit(4), lit(9), lit(10)),
        fills.row_bounds(lit(None).cast("int"), lit(4), lit(9), lit(10)),
    )
    assert got[:3] == (None, None, None) and got[3] == 9.96921e36
    assert got[4] is None and got[5] == [1, None]
    assert tuple(got[6]) == (2, 4) and tuple(got[7]) == (8, 10)
    empty = lit(None).cast("int")
    with pytest.raises(PySparkException, match="no start/end row metadata"):
        one(spark, fills.row_bounds(empty, empty, empty, lit(1)))


def test_axes_are_symmetric(spark):
    for resolution, size in K.DIMSIZE.items():
        half, step = size // 2, K.SCAN_STEP_RAD[resolution]
        got = one(
            spark,
            *(
                geolocation.proj_xy(F.lit(i), resolution, "radian")
                for i in (half - 1, half, 0, size - 1)
            ),
            geolocation.proj_xy(F.lit(half), resolution, "metre"),
        )
        assert got[0] == pytest.approx(-step / 2) and got[1] == pytest.approx(step / 2)
        assert got[2] == -got[3]
        assert got[4] == pytest.approx(step / 2 * 35786400)


def test_lines_equal_pixels(spark):
    """The NumPy lines and the pixel expression agree, on and off the Earth."""
    rows = spark.createDataFrame([(0,), (300,), (2783,), (2784,), (5300,), (5567,)], "y int")
    for lon0 in (0.0, 140.0):
        lines = grids.with_latlon(rows, "2km", lon0).select(
            "y", F.posexplode(F.arrays_zip("latitude", "longitude"))
        )
        at = geolocation.latlon(F.col("y"), F.col("pos"), "2km", lon0)
        both = lines.select("col.*", at["latitude"].alias("la"), at["longitude"].alias("lo")).toPandas()
        assert both["latitude"].isna().equals(both["la"].isna())
        assert np.nanmax(np.abs(both["latitude"] - both["la"])) < 2e-5
        assert np.nanmax(np.abs(both["longitude"] - both["lo"])) < 2e-5
        assert both["longitude"].min() >= -180 and both["longitude"].max() < 180


def test_orientation_of_the_grid(spark):
    def at(row, col):
        return one(spark, geolocation.latlon(F.lit(row), F.lit(col), "2km"))[0]

    assert at(0, 0).latitude is None
    assert at(300, 2784).latitude < -50 and at(5267, 2784).latitude > 50
    assert at(2784, 300).longitude < -50 and at(2784, 5267).longitude > 50
    assert abs(at(2784, 2784).latitude) < 0.02


def test_row_windows(spark):
    assert grids.geo_rows(spark, "2km", (4309, 4311)).select("y").count() == 2
    for bad in ((-1, 2), (3, 3), (0, 5569)):
        with pytest.raises(ConfigurationError):
            grids.geo_rows(spark, "2km", bad)
    y = grids.axes(spark, CubeConfig("FDHSI", resolutions="1km", body_chunks=(32, 40)), "y")
    first, full = y.orderBy("index").first(), grids.axes(spark, CubeConfig("FDHSI", resolutions="1km"), "y")
    assert y.count() == 2518 and first["index"] == 8618
    assert full.filter("index = 8618").first().y == first.y
