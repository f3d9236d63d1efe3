"""Fixed values of the instrument, its products and its file names.

Every value in this module is a fixed value: it must equal the published product format for results
to be right, so it is stated here once, in natural order, and used by name everywhere else.
"""

from __future__ import annotations

FDHSI = "FDHSI"
HRFI = "HRFI"
PRODUCT_TYPES = (FDHSI, HRFI)

# Resolutions of each product in the order of its file.
RESOLUTIONS = {FDHSI: ("1km", "2km"), HRFI: ("500m", "1km")}

# Channels per product and resolution as (logical name, name inside the file).
CHANNELS = {
    (FDHSI, "1km"): [
        ("vis_04", "vis_04"),
        ("vis_05", "vis_05"),
        ("vis_06", "vis_06"),
        ("vis_08", "vis_08"),
        ("vis_09", "vis_09"),
        ("nir_13", "nir_13"),
        ("nir_16", "nir_16"),
        ("nir_22", "nir_22"),
    ],
    (FDHSI, "2km"): [
        ("ir_38", "ir_38"),
        ("wv_63", "wv_63"),
        ("wv_73", "wv_73"),
        ("ir_87", "ir_87"),
        ("ir_97", "ir_97"),
        ("ir_105", "ir_105"),
        ("ir_123", "ir_123"),
        ("ir_133", "ir_133"),
    ],
    (HRFI, "500m"): [("vis_06", "vis_06_hr"), ("nir_22", "nir_22_hr")],
    (HRFI, "1km"): [("ir_38", "ir_38_hr"), ("ir_105", "ir_105_hr")],
}

# Central wavelength in micrometres.
WAVELENGTH_UM = {
    "vis_04": 0.444,
    "vis_05": 0.51,
    "vis_06": 0.64,
    "vis_08": 0.865,
    "vis_09": 0.914,
    "nir_13": 1.38,
    "nir_16": 1.61,
    "nir_22": 2.25,
    "ir_38": 3.8,
    "wv_63": 6.3,
    "wv_73": 7.35,
    "ir_87": 8.7,
    "ir_97": 9.66,
    "ir_105": 10.5,
    "ir_123": 12.3,
    "ir_133": 13.3,
}

# Channels whose counts above the cold range use a second calibration pair.
DUAL_GAIN_CHANNELS = ("ir_38",)
COLD_COUNT_MAX = 4095

# Grid size, scan step and output rows per tile of each resolution.
DIMSIZE = {"500m": 22272, "1km": 11136, "2km": 5568}
SCAN_STEP_RAD = {
    "500m": 1.39717881617e-05,
    "1km": 2.79435763233999e-05,
    "2km": 5.58871526468e-05,
}
TILE_ROWS = {"500m": 556, "1km": 278, "2km": 139}

# End row (exclusive) of BODY chunks 1..40; each chunk starts where the one before ends.
CHUNK_ROW_ENDS_1KM = [
    278, 556, 835, 1113, 1392, 1670, 1948, 2227, 2505, 2784,
    3062, 3340, 3619, 3897, 4176, 4454, 4732, 5011, 5289, 5568,
    5846, 6124, 6403, 6681, 6960, 7258, 7556, 7856, 8133, 8391,
    8649, 8908, 9187, 9465, 9744, 10022, 10300, 10579, 10857, 11136,
]
CHUNK_ROW_ENDS_500M = [
    557, 1113, 1671, 2227, 2785, 3341, 3897, 4455, 5011, 5569,
    6125, 6681, 7239, 7795, 8353, 8909, 9465, 10023, 10579, 11137,
    11693, 12249, 12807, 13363, 13921, 14517, 15113, 15714, 16267, 16783,
    17299, 17817, 18375, 18931, 19489, 20045, 20601, 21159, 21715, 22272,
]
# The 2 km rows are the 1 km rows halved and rounded down.
CHUNK_ROW_ENDS_2KM = [end // 2 for end in CHUNK_ROW_ENDS_1KM]
CHUNK_ROW_ENDS = {
    (FDHSI, "1km"): CHUNK_ROW_ENDS_1KM,
    (FDHSI, "2km"): CHUNK_ROW_ENDS_2KM,
    (HRFI, "500m"): CHUNK_ROW_ENDS_500M,
    (HRFI, "1km"): CHUNK_ROW_ENDS_1KM,
}
BODY_CHUNKS = 40

# Repeat-cycle schedule and the default first day of the time axis.
CYCLE_MINUTES = 10
CYCLE_SECONDS = 600
CYCLES_PER_DAY = 144
DEFAULT_EPOCH = "2024-09-24"
PIXEL_TIME_ORIGIN = "2000-01-01"

# Missing-value markers of the files and of the stored integer arrays.
COUNTS_FILL = 65535
QUALITY_FILL = 0
INDEX_FILL = 65535
FLOAT32_DEFAULT_FILL = 9.96921e36

# Quality flags, bit k has mask 2**k.
QUALITY_FLAGS = (
    "missing_warning",
    "radiometric_warning",
    "noise_warning",
    "geolocation_warning",
    "saturation_warning",
    "straylight_correction_warning",
    "extended_dynamic_range_warning",
    "encoding_saturation_warning",
)

# Per-slot, per-channel constants and per-slot platform columns.
CONVERSION_CONSTANTS = (
    "radiance_unit_conversion_coefficient",
    "radiance_to_bt_conversion_coefficient_wavenumber",
    "radiance_to_bt_conversion_coefficient_a",
    "radiance_to_bt_conversion_coefficient_b",
    "radiance_to_bt_conversion_constant_c1",
    "radiance_to_bt_conversion_constant_c2",
    "channel_effective_solar_irradiance",
)
PLATFORM_COLUMNS = ("subsatellite_latitude", "subsatellite_longitude", "platform_altitude")

# Geometry of the projection (metres for the axes, kilometres for the inverse).
PERSPECTIVE_HEIGHT_M = 35786400.0
ORBIT_RADIUS_KM = 42164.537
EQUATOR_RADIUS_KM = 6378.137
POLAR_RADIUS_KM = 6356.752314

# The ellipsoid, and the projection as well-known text.
POLAR_AXIS_M = 6356752.31424518
INVERSE_FLATTENING = 298.25722356301
GEOS_WKT = (
    'PROJCRS["Geostationary",BASEGEOGCRS["WGS 84",DATUM["World Geodetic System 1984",'
    'ELLIPSOID["WGS 84",6378137,298.257223563,LENGTHUNIT["metre",1]]],'
    'PRIMEM["Greenwich",0,ANGLEUNIT["degree",0.0174532925199433]]],'
    'CONVERSION["Geostationary",METHOD["Geostationary Satellite (Sweep Y)"],'
    'PARAMETER["Longitude of natural origin",0,ANGLEUNIT["degree",0.0174532925199433]],'
    f'PARAMETER["Satellite Height",{PERSPECTIVE_HEIGHT_M:.0f},LENGTHUNIT["metre",1]]],'
    'CS[Cartesian,2],AXIS["easting (X)",east,ORDER[1],LENGTHUNIT["metre",1]],'
    'AXIS["northing (Y)",north,ORDER[2],LENGTHUNIT["metre",1]]]'
)
