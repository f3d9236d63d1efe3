"""Geostationary image cube on Spark: names and slots, coverage, rasters, calibration, geolocation."""

from orbitlake.plans.config import ConfigurationError, CubeConfig

__all__ = ["ConfigurationError", "CubeConfig"]
