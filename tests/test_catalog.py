"""Catalogs, selections and the variable registry."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orbitlake import ConfigurationError, CubeConfig
from orbitlake import constants as K
from orbitlake.plans import catalog, variables
from orbitlake.sources.cube import identity


def test_body_rows_tile_each_grid(spark):
    for grid, ends in K.CHUNK_ROW_ENDS.items():
        assert len(ends) == K.BODY_CHUNKS
        assert sorted(set(ends)) == ends and ends[-1] == K.DIMSIZE[grid[1]]
    assert catalog.body_rows(spark).count() == 160
    middle = catalog.body_rows(spark).filter("chunk_no = 28 and resolution <> '1km'")
    rows = {(r.product_type, r.resolution): (r.row_start, r.row_stop) for r in middle.collect()}
    assert rows == {("FDHSI", "2km"): (3778, 3928), ("HRFI", "500m"): (15113, 15714)}


@pytest.mark.parametrize(
    "config",
    [
        CubeConfig("FDHSI"),
        CubeConfig("HRFI", resolutions="1km"),
        CubeConfig("FDHSI", channels="ir_105, vis_06,vis_06 ,vis_04"),
        CubeConfig("FDHSI", channels=" , ", resolutions="2km,9km"),
    ],
)
def test_one_configuration_is_one_request(spark, config):
    """The driver's selection equals the table's."""
    request = spark.createDataFrame(
        [(1, config.product_type, config.resolutions, config.channels)],
        "request_id int, product_type string, resolutions string, channels string",
    )
    plans = catalog.resolve_plans(request).orderBy("resolution_index").collect()
    expected = {p.resolution: list(zip(p.channels, p.nc_channels)) for p in plans}
    assert catalog.config_channels(config) == expected
    assert list(catalog.config_channels(config)) == list(expected)


def test_channels_keep_request_order(spark):
    chosen = catalog.config_channels(CubeConfig("FDHSI", channels="vis_06,ir_105,vis_04"))
    assert chosen == {"1km": [("vis_06", "vis_06"), ("vis_04", "vis_04")], "2km": [("ir_105", "ir_105")]}


def test_unknown_channels_fail(spark):
    with pytest.raises(ConfigurationError, match="ir_38_hr"):
        catalog.config_channels(CubeConfig("HRFI", channels="ir_38_hr"))
    request = spark.createDataFrame([(1, "HRFI", "ir_38_hr")], "request_id int, product_type string, channels string")
    with pytest.raises(PySparkException, match="unknown channel"):
        catalog.select_channels(request).collect()


def test_nothing_left_fails():
    with pytest.raises(ConfigurationError, match="no FDHSI resolution"):
        catalog.config_channels(CubeConfig("FDHSI", resolutions="2km", channels="vis_04"))
    with pytest.raises(ConfigurationError, match="flat cube"):
        catalog.config_channels(CubeConfig("FDHSI", flat=True))


@pytest.mark.parametrize(
    "bad",
    [
        {"product_type": "OTHER"},
        {"pixel_time_dtype": "int8"},
        {"projection_units": "km"},
        {"partial_chunk": "skip"},
        {"body_chunks": (0, 3)},
        {"body_chunks": (5, 4)},
        {"body_chunks": (1, 41)},
        {"tile_rows": 0},
    ],
)
def test_bad_options(bad):
    with pytest.raises(ConfigurationError):
        CubeConfig(**{"product_type": "FDHSI", **bad})


def test_stripe_windows():
    config = CubeConfig("FDHSI", body_chunks=(32, 40))
    assert catalog.row_window(config, "1km") == (8618, 11136)
    assert catalog.row_window(config, "2km") == (4309, 5568)
    assert catalog.row_window(CubeConfig("HRFI"), "500m") == (0, 22272)
    assert identity(config)["stripe"] == "chunks 32 to 40" and identity(CubeConfig("HRFI"))["stripe"] is None


def test_tile_heights():
    config = CubeConfig("FDHSI", tile_rows=100, tile_overrides=(("2km", 50),))
    assert [config.tile_height(r) for r in ("1km", "2km")] == [100, 50]
    assert CubeConfig("HRFI").tile_height("500m") == 556


def test_every_variable_is_stored_once():
    names = [name for columns in variables.COLUMNS.values() for name in columns]
    assert len(names) == len(set(names)) == 26
    assert set(variables.KEYS) == set(variables.COLUMNS)
    for table in (variables.SWITCHED, variables.UNITS, variables.LONG_NAMES, variables.MORE, variables.COMPUTED):
        assert set(table) <= set(names)


def test_flags_drop_variables():
    config = CubeConfig(
        "FDHSI", include_pixel_quality=False, include_pixel_time=False, include_calibration=False,
        include_geolocation=False,
    )
    kept = set(variables.chosen_columns(config, ["vis_04"]))
    assert kept.isdisjoint({"pixel_quality", "pixel_time", "slope", "latitude", "warm_slope"})
    assert {"counts", "x", "y", "time", "channel", "spatial_ref"} <= kept


def test_warm_values_need_a_dual_gain_channel():
    config = CubeConfig("FDHSI")
    assert "warm_slope" not in variables.chosen_columns(config, ["vis_04"])
    assert "warm_slope" in variables.chosen_columns(config, ["ir_38"], "slot_channel")


def test_attributes_follow_the_options(spark):
    metre, radian = CubeConfig("FDHSI"), CubeConfig("FDHSI", projection_units="radian")
    assert variables.attributes_of("x", "double", metre) == {
        "axis": "X", "standard_name": "projection_x_coordinate", "units": "m",
    }
    assert variables.attributes_of("x", "double", radian)["standard_name"] == "projection_x_angular_coordinate"
    plain = CubeConfig("FDHSI", include_geolocation=False, pixel_time_dtype="int32")
    kind = variables.chosen_columns(plain, ())["pixel_time"]
    assert variables.attributes_of("pixel_time", kind, plain)["_FillValue"] == 2**31 - 1
    fills = {n: variables.attributes_of(n, k, metre).get("_FillValue") for n, k in variables.chosen_columns(metre, ["ir_38"]).items()}
    assert (fills["counts"], fills["pixel_quality"], fills["pixel_time"], fills["slope"]) == (65535, 0, "NaN", "NaN")
    assert (fills["spatial_ref"], fills["time"], fills["channel"], fills["y"]) == (0, None, None, None)
    stripe = variables.group_attributes(CubeConfig("FDHSI", body_chunks=(32, 40)), "2km", {"license": "x"})
    assert (stripe["disk_row_start"], stripe["disk_row_stop"], stripe["license"]) == (4309, 5568, "x")


def test_tiles_off_the_grid_fail(spark):
    windows = spark.createDataFrame([("1km", 5, 600)], "resolution string, window_start int, window_stop int")
    with pytest.raises(PySparkException, match="off the tile grid"):
        catalog.tiles(windows).collect()
    good = windows.withColumn("window_start", F.lit(278))
    assert [tuple(r) for r in catalog.tiles(good).select("tile", "tile_start", "tile_stop").orderBy("tile").collect()] == [
        (1, 278, 556),
        (2, 556, 600),
    ]
