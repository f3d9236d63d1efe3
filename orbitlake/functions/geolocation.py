"""Projection axes and the inverse geostationary projection as Column expressions.

Row 0 is the southern edge and column 0 the western edge; indices are 0-based full-disk indices.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbitlake.constants import (
    DIMSIZE,
    EQUATOR_RADIUS_KM,
    ORBIT_RADIUS_KM,
    PERSPECTIVE_HEIGHT_M,
    POLAR_RADIUS_KM,
    SCAN_STEP_RAD,
)

UNITS = ("meter", "metre", "radian")


def lookup(resolution: Column | str, table: dict) -> Column:
    """Value of a per-resolution table, as a literal or by a resolution column."""
    if isinstance(resolution, str):
        if resolution not in table:
            raise ValueError(f"unknown resolution {resolution!r}, expected one of {sorted(table)}")
        return F.lit(table[resolution])
    value = F.lit(None)
    for name, entry in table.items():
        value = F.when(resolution == name, entry).otherwise(value)
    return value


def scan_angle(index: Column, resolution: Column | str) -> Column:
    """Angle of a row (north positive) or column (east positive) in radians."""
    centre = lookup(resolution, {res: size / 2 - 0.5 for res, size in DIMSIZE.items()})
    return (index - centre) * lookup(resolution, SCAN_STEP_RAD)


def proj_xy(index: Column, resolution: Column | str, units: str = "meter") -> Column:
    """Projection coordinate of an axis index, in metres or radians."""
    if units not in UNITS:
        raise ValueError(f"projection_units must be one of {UNITS}, got {units!r}")
    angle = scan_angle(index, resolution)
    return angle if units == "radian" else angle * PERSPECTIVE_HEIGHT_M


def latlon_from_angles(x_angle: Column, y_angle: Column) -> Column:
    """Latitude and longitude (float degrees) seen at a pair of scan angles; NULL off the Earth.

    A line of sight meets the ellipsoid where a quadratic in the distance has a real root; the
    nearer root is the visible point. Off the Earth the root is NaN and so is all that follows from
    it: nothing is behind a condition, so both results share their common terms.
    """
    flattening = (EQUATOR_RADIUS_KM / POLAR_RADIUS_KM) ** 2
    reach = ORBIT_RADIUS_KM**2 - EQUATOR_RADIUS_KM**2
    cos_y, sin_y = F.cos(y_angle), F.sin(y_angle)
    along = F.cos(x_angle) * cos_y
    curvature = cos_y * cos_y + flattening * sin_y * sin_y
    root = F.sqrt(ORBIT_RADIUS_KM**2 * along * along - curvature * reach)
    distance = (ORBIT_RADIUS_KM * along - root) / curvature
    towards = ORBIT_RADIUS_KM - distance * along
    east = distance * F.sin(x_angle) * cos_y
    north = distance * sin_y
    level = F.sqrt(towards * towards + east * east)

    def visible(degrees: Column) -> Column:
        return F.nanvl(degrees, F.lit(None)).cast("float")

    return F.struct(
        visible(F.degrees(F.atan(flattening * north / level))).alias("latitude"),
        visible(F.degrees(F.atan2(east, towards))).alias("longitude"),
    )


def shift_lon(longitude: Column, lon0: float) -> Column:
    """Move to another sub-satellite longitude and wrap to [-180, 180); untouched for 0."""
    if lon0 == 0.0:
        return longitude
    moved = longitude + F.lit(lon0).cast("float") + F.lit(180.0).cast("float")
    full = F.lit(360.0).cast("float")
    return F.pmod(moved, full) - F.lit(180.0).cast("float")


def latlon(row: Column, column: Column, resolution: Column | str, lon0: float = 0.0) -> Column:
    """Struct of latitude and longitude of a pixel, both NULL off the Earth."""
    seen = latlon_from_angles(scan_angle(column, resolution), scan_angle(row, resolution))
    return F.struct(
        seen["latitude"].alias("latitude"), shift_lon(seen["longitude"], lon0).alias("longitude")
    )
