"""Sun-Earth distance as one Column expression (truncated VSOP87 series, Meeus 1998, appendix III)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (amplitude, phase, frequency) of the Earth radius vector, in 1e-8 AU, per power of
# the time in Julian millennia from J2000.
RADIUS_SERIES = (
    (
        (100013989, 0, 0),
        (1670700, 3.0984635, 6283.07585),
        (13956, 3.05525, 12566.1517),
        (3084, 5.1985, 77713.7715),
        (1628, 1.1739, 5753.3849),
        (1576, 2.8469, 7860.4194),
        (925, 5.453, 11506.77),
        (542, 4.564, 3930.21),
        (472, 3.661, 5884.927),
        (346, 0.964, 5507.553),
        (329, 5.9, 5223.694),
        (307, 0.299, 5573.143),
        (243, 4.273, 11790.629),
        (212, 5.847, 1577.344),
        (186, 5.022, 10977.079),
        (175, 3.012, 18849.228),
        (110, 5.055, 5486.778),
        (98, 0.89, 6069.78),
        (86, 5.69, 15720.84),
        (86, 1.27, 161000.69),
        (65, 0.27, 17260.15),
        (63, 0.92, 529.69),
        (57, 2.01, 83996.85),
        (56, 5.24, 71430.7),
        (49, 3.25, 2544.31),
        (47, 2.58, 775.52),
        (45, 5.54, 9437.76),
        (43, 6.01, 6275.96),
        (39, 5.36, 4694),
        (38, 2.39, 8827.39),
        (37, 0.83, 19651.05),
        (37, 4.9, 12139.55),
        (36, 1.67, 12036.46),
        (35, 1.84, 2942.46),
        (33, 0.24, 7084.9),
        (32, 0.18, 5088.63),
        (32, 1.78, 398.15),
        (28, 1.21, 6286.6),
        (28, 1.9, 6279.55),
        (26, 4.59, 10447.39),
    ),
    (
        (103019, 1.10749, 6283.07585),
        (1721, 1.0644, 12566.1517),
        (702, 3.142, 0),
        (32, 1.02, 18849.23),
        (31, 2.84, 5507.55),
        (25, 1.32, 5223.69),
        (18, 1.42, 1577.34),
        (10, 5.91, 10977.08),
        (9, 1.42, 6275.96),
        (9, 0.27, 5486.78),
    ),
    (
        (4359, 5.7846, 6283.0758),
        (124, 5.579, 12566.152),
        (12, 3.14, 0),
        (9, 3.63, 77713.77),
        (6, 1.87, 5573.14),
        (3, 5.47, 18849.23),
    ),
    ((145, 4.273, 6283.076), (7, 3.92, 12566.15)),
    ((4, 2.56, 6283.08),),
)
# J2000 in Unix seconds (2000-01-01 12:00), seconds per Julian millennium, TT - UTC.
J2000_UNIX = 946728000.0
MILLENNIUM_S = 365250 * 86400.0
TT_MINUS_UTC_S = 69.184


def sun_earth_distance(ts: Column) -> Column:
    """Distance between Sun and Earth centre in AU at a UTC time, to about 1e-7 AU."""
    seconds = F.unix_micros(ts.cast("timestamp")) / 1e6
    tau = (seconds - J2000_UNIX + TT_MINUS_UTC_S) / MILLENNIUM_S
    radius = F.lit(0.0)
    for series in reversed(RADIUS_SERIES):
        terms = F.lit(0.0)
        for amplitude, phase, frequency in series:
            terms = terms + F.lit(float(amplitude)) * F.cos(phase + frequency * tau)
        radius = radius * tau + terms
    return radius / 1e8
