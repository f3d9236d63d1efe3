"""Calibration formulas and quality flags.

The scalar functions work on one pixel; the ``*_row`` functions on the arrays of one scanline, so a
row is calibrated without being exploded.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbitlake.constants import COLD_COUNT_MAX, QUALITY_FLAGS


def radiance(counts: Column, slope: Column, offset: Column) -> Column:
    """mW m-2 sr-1 (cm-1)-1 from raw counts."""
    return counts * slope + offset


def radiance_dual_gain(
    counts: Column, slope: Column, offset: Column, warm_slope: Column, warm_offset: Column
) -> Column:
    """Counts above the cold range use the warm pair."""
    return F.when(counts > COLD_COUNT_MAX, radiance(counts, warm_slope, warm_offset)).otherwise(
        radiance(counts, slope, offset)
    )


def calibrated(
    counts: Column,
    dual_gain: Column,
    slope: Column,
    offset: Column,
    warm_slope: Column,
    warm_offset: Column,
) -> Column:
    """Radiance of any channel: dual gain where the channel has it."""
    warm = dual_gain & (counts > COLD_COUNT_MAX)
    return counts * F.when(warm, warm_slope).otherwise(slope) + F.when(warm, warm_offset).otherwise(
        offset
    )


def radiance_per_um(rad: Column, unit_coefficient: Column) -> Column:
    return rad * unit_coefficient


def brightness_temperature(
    rad: Column, wavenumber: Column, a: Column, b: Column, c1: Column, c2: Column
) -> Column:
    """Kelvin; NULL where the radiance is not positive or a constant is missing."""
    ratio = c1 * wavenumber * wavenumber * wavenumber / rad
    # The guard also keeps zero and negative radiances out of the division and the logarithm.
    return F.when(rad > 0, (c2 * wavenumber / F.ln(1.0 + ratio) - b) / a)


def reflectance(
    rad: Column, distance_au: Column, irradiance: Column, solar_zenith_deg: Column
) -> Column:
    """Bidirectional reflectance; NULL where the irradiance or the cosine is zero."""
    return F.try_divide(
        math.pi * rad * distance_au * distance_au,
        irradiance * F.cos(F.radians(solar_zenith_deg)),
    )


def quality_bit(quality: Column, flag: str) -> Column:
    """True when the named flag is set."""
    return F.getbit(quality.cast("int"), F.lit(QUALITY_FLAGS.index(flag))) == 1


def row_of(formula: Callable[..., Column], counts: Column, *per_row: Column) -> Column:
    """Apply a scalar formula to every pixel of a scanline array."""
    return F.transform(counts, lambda c: formula(c, *per_row))


def radiance_row(counts: Column, slope: Column, offset: Column) -> Column:
    return row_of(radiance, counts, slope, offset)


def calibrated_row(
    counts: Column,
    dual_gain: Column,
    slope: Column,
    offset: Column,
    warm_slope: Column,
    warm_offset: Column,
) -> Column:
    """Radiance of a scanline of any channel; the gain is chosen per pixel only where there are two."""
    both = row_of(radiance_dual_gain, counts, slope, offset, warm_slope, warm_offset)
    return F.when(dual_gain, both).otherwise(radiance_row(counts, slope, offset))
