"""What a cube stores, as data: tables of columns, options, fills and attributes.

Adding a variable is adding rows here: the projection of a table, its attributes and the fill audit
are all read off these rows by the functions below.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.functions import geolocation
from orbitlake.functions.slots import PIXEL_TIME_TYPES
from orbitlake.operators.rasters import expand_scanline_time
from orbitlake.plans import catalog
from orbitlake.plans.config import CubeConfig
from orbitlake.session import literal_table

GROUP = ("product_type", "resolution")
#: Keys of each table.
KEYS = {
    "scanlines": (*GROUP, "slot", "channel", "channel_index", "y"),
    "slot_channel": (*GROUP, "slot", "channel", "channel_index"),
    "slot_meta": (*GROUP, "slot"),
    "geo": (*GROUP, "y"),
    "axis_x": (*GROUP, "index"),
    "axis_y": (*GROUP, "index"),
    "channels": (*GROUP, "channel_index"),
    "attributes": (),
}
#: Variables of each table and their types. A pixel time has the type its option names.
COLUMNS: dict[str, dict[str, str]] = {
    "scanlines": {
        "counts": "array<int>", "pixel_quality": "array<smallint>", "pixel_time": "array<double>",
    },
    "slot_channel": {
        **dict.fromkeys(("slope", "offset", "warm_slope", "warm_offset"), "double"),
        **dict.fromkeys(K.CONVERSION_CONSTANTS, "float"),
    },
    "slot_meta": {
        **dict.fromkeys(K.PLATFORM_COLUMNS, "double"),
        "sun_earth_distance": "double", "time": "timestamp_ntz",
    },
    "geo": dict.fromkeys(("latitude", "longitude"), "array<float>"),
    "axis_x": {"x": "double"},
    "axis_y": {"y": "double"},
    "channels": {"channel": "string", "central_wavelength": "float"},
    "attributes": {"spatial_ref": "tinyint"},
}
#: Variables that are there only while an option is on, and those of dual-gain channels only.
SWITCHED = {
    "pixel_quality": "include_pixel_quality",
    "pixel_time": "include_pixel_time",
    **dict.fromkeys(COLUMNS["slot_channel"], "include_calibration"),
    **dict.fromkeys(COLUMNS["geo"], "include_geolocation"),
}
DUAL_GAIN = ("warm_slope", "warm_offset")
#: Where a column of the input has another name, and where it has to be computed.
RENAMED = {"pixel_quality": "quality", "central_wavelength": "wavelength_um"}
COMPUTED: dict[str, Callable[[CubeConfig], Column]] = {
    "pixel_time": lambda config: expand_scanline_time(F.col("index_map"), F.col("lut")),
    **dict.fromkeys(
        ("x", "y"),
        lambda config: geolocation.proj_xy(F.col("index"), F.col("resolution"), config.projection_units),
    ),
}
#: What stands for a missing value, by variable or else by type; others have no such value.
NAN = "NaN"
FILLS = {
    "counts": K.COUNTS_FILL, "pixel_quality": K.QUALITY_FILL, "spatial_ref": 0, "x": None, "y": None,
    **dict.fromkeys(("float", "double", "array<float>", "array<double>"), NAN),
    "array<int>": 2**31 - 1, "array<bigint>": 2**63 - 1,
}

RADIANCE_UNIT = "mW m-2 sr-1 (cm-1)-1"
#: Units, and the other attributes, of the variables.
UNITS = {
    "counts": "1",
    "pixel_quality": "1",
    "pixel_time": "seconds since 2000-01-01",
    "slope": RADIANCE_UNIT,
    "offset": RADIANCE_UNIT,
    "warm_slope": RADIANCE_UNIT,
    "warm_offset": RADIANCE_UNIT,
    "latitude": "degrees_north",
    "longitude": "degrees_east",
    "subsatellite_latitude": "degrees_north",
    "subsatellite_longitude": "degrees_east",
    "platform_altitude": "m",
    "sun_earth_distance": "AU",
    "central_wavelength": "um",
    "radiance_unit_conversion_coefficient": "W mW-1 cm-1 um-1",
    "radiance_to_bt_conversion_coefficient_wavenumber": "cm-1",
    "radiance_to_bt_conversion_coefficient_a": "1",
    "radiance_to_bt_conversion_coefficient_b": "K",
    "radiance_to_bt_conversion_constant_c1": "mW m-2 sr-1 (cm-1)-4",
    "radiance_to_bt_conversion_constant_c2": "cm K",
    "channel_effective_solar_irradiance": "mW m-2 (cm-1)-1",
}
LONG_NAMES = {
    "counts": "values as stored in the product, before calibration",
    "pixel_quality": "bits that say what may be wrong with a pixel",
    "pixel_time": "when the instrument scanned a pixel",
    "slope": "calibration slope",
    "offset": "calibration offset",
    "warm_slope": "calibration slope of counts above 4095",
    "warm_offset": "calibration offset of counts above 4095",
    "subsatellite_latitude": "subsatellite latitude, averaged over the scene's platform rows",
    "subsatellite_longitude": "subsatellite longitude, averaged over the scene's platform rows",
    "platform_altitude": "platform altitude, averaged over the scene's platform rows",
    "sun_earth_distance": "how far the Sun is at the start of the slot",
    "time": "start of the scene in the slot",
    "channel": "name under which a cube stores a channel",
    "radiance_unit_conversion_coefficient": "radiance per wavenumber to radiance per wavelength",
    "radiance_to_bt_conversion_coefficient_wavenumber": "central wavenumber for brightness temperature",
    "radiance_to_bt_conversion_coefficient_a": "brightness temperature factor A",
    "radiance_to_bt_conversion_coefficient_b": "brightness temperature offset B",
    "radiance_to_bt_conversion_constant_c1": "radiation constant C1",
    "radiance_to_bt_conversion_constant_c2": "radiation constant C2",
    "channel_effective_solar_irradiance": "solar irradiance at 1 AU",
}
STANDARD_NAMES = {
    "pixel_time": "time",
    "latitude": "latitude",
    "longitude": "longitude",
    "time": "time",
    "central_wavelength": "radiation_wavelength",
}
MORE: dict[str, dict[str, Any]] = {
    "counts": {
        "grid_mapping": "spatial_ref",
        "ancillary_variables": "pixel_quality pixel_time slope offset",
    },
    "pixel_quality": {
        "grid_mapping": "spatial_ref",
        "flag_masks": [1 << bit for bit in range(len(K.QUALITY_FLAGS))],
        "flag_meanings": " ".join(K.QUALITY_FLAGS),
    },
    "pixel_time": {"calendar": "standard", "grid_mapping": "spatial_ref"},
    "x": {"axis": "X"},
    "y": {"axis": "Y"},
    "time": {"axis": "T"},
    "spatial_ref": {
        "grid_mapping_name": "geostationary",
        "latitude_of_projection_origin": 0.0,
        "longitude_of_projection_origin": 0.0,
        "perspective_point_height": K.PERSPECTIVE_HEIGHT_M,
        "sweep_angle_axis": "y",
        "semi_major_axis": K.EQUATOR_RADIUS_KM * 1000,
        "semi_minor_axis": K.POLAR_AXIS_M,
        "inverse_flattening": K.INVERSE_FLATTENING,
        "crs_wkt": K.GEOS_WKT,
        "spatial_ref": K.GEOS_WKT,
    },
}
#: What stands before the sub-satellite longitude in the text of the projection.
WKT_ORIGIN = '"Longitude of natural origin",'
#: Attributes that follow an option: (variable, option, value of the option) to attributes.
BY_OPTION = {
    (axis, "projection_units", units): {
        "standard_name": f"projection_{axis}{kind}_coordinate", "units": short,
    }
    for axis in ("x", "y")
    for units, kind, short in (("meter", "", "m"), ("radian", "_angular", "radian"))
}


def chosen_columns(
    config: CubeConfig, channels: Sequence[str], table: str | None = None
) -> dict[str, str]:
    """Names and types of the variables that the options ask for, of one table or of all."""
    dual_gain = set(channels) & set(K.DUAL_GAIN_CHANNELS)
    off = {name for name, option in SWITCHED.items() if not getattr(config, option)}
    off |= set() if dual_gain else set(DUAL_GAIN)
    tables = COLUMNS if table is None else [table]
    found = {name: kind for t in tables for name, kind in COLUMNS[t].items() if name not in off}
    if "pixel_time" in found:
        found["pixel_time"] = f"array<{PIXEL_TIME_TYPES[config.pixel_time_dtype]}>"
    return found


def attributes_of(name: str, kind: str, config: CubeConfig) -> dict[str, Any]:
    """All attributes of a variable of the given type, the fill last."""
    named = {"units": UNITS, "long_name": LONG_NAMES, "standard_name": STANDARD_NAMES}
    found = {attribute: names[name] for attribute, names in named.items() if name in names}
    found |= MORE.get(name, {})
    if name == "spatial_ref" and config.lon0:
        wkt = K.GEOS_WKT.replace(f"{WKT_ORIGIN}0", f"{WKT_ORIGIN}{config.lon0}")
        found |= {"longitude_of_projection_origin": float(config.lon0), "crs_wkt": wkt, "spatial_ref": wkt}
    for (variable, option, value), attributes in BY_OPTION.items():
        if variable == name and getattr(config, option) == value:
            found |= attributes
    fill = FILLS.get(name, FILLS.get(kind))
    return found if fill is None else found | {"_FillValue": fill}


def select_variables(
    df: DataFrame,
    table: str,
    config: CubeConfig,
    channels: Sequence[str],
    keep: Sequence[str] | None = None,
    more: Mapping[str, str] | None = None,
) -> DataFrame:
    """Project a table to its keys and chosen variables, with their attributes as column metadata.

    ``more`` adds variables of the caller (name to type). A variable that is switched off is never
    named, so its source columns are pruned at the scan.
    """
    def column(name: str, kind: str) -> Column:
        source = COMPUTED[name](config) if name in COMPUTED else F.col(RENAMED.get(name, name))
        return source.cast(kind).alias(name, metadata=attributes_of(name, kind, config))

    keys = KEYS[table] if keep is None else keep
    columns = chosen_columns(config, channels, table) | dict(more or {})
    return df.select(*keys, *(column(name, kind) for name, kind in columns.items()))


def group_name(resolution: str, flat: bool = False) -> str:
    return "" if flat else f"data_{resolution}"


def group_attributes(
    config: CubeConfig, resolution: str, extra: Mapping[str, Any] | None = None
) -> dict[str, Any]:
    """Attributes of one group; institution, source and licence are the caller's (``extra``)."""
    attrs: dict[str, Any] = {
        "Conventions": "CF-1.8",
        "title": f"Level 1C effective radiances ({resolution})",
        **(extra or {}),
    }
    if config.body_chunks is not None:
        start, stop = catalog.row_window(config, resolution)
        attrs |= {
            "fci_chunks": list(config.body_chunks),
            "disk_row_start": start,
            "disk_row_stop": stop,
        }
    return attrs


ATTRIBUTE_SCHEMA = "group string, variable string, attribute string, value string"


def declared_attributes(
    spark: SparkSession, config: CubeConfig, extra: Mapping[str, Any] | None = None
) -> DataFrame:
    """Every attribute the configuration declares, values as JSON text.

    Rows with an empty ``variable`` belong to the group itself. The size is fixed by the registry.
    """
    rows = []
    for resolution, members in sorted(catalog.config_channels(config).items()):
        channels = [channel for channel, _nc_channel in members]
        group = group_name(resolution, config.flat)
        described = [("", group_attributes(config, resolution, extra))] + [
            (name, attributes_of(name, kind, config))
            for name, kind in chosen_columns(config, channels).items()
        ]
        rows += [
            (group, variable, key, json.dumps(value))
            for variable, attrs in described
            for key, value in attrs.items()
        ]
    return literal_table(spark, rows, ATTRIBUTE_SCHEMA)


def all_groups() -> list[str]:
    return sorted({group_name(resolution) for _product, resolution in K.CHANNELS})
