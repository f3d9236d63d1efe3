"""User options of a cube."""

from __future__ import annotations

import datetime
from dataclasses import asdict, dataclass

from orbitlake.constants import (
    BODY_CHUNKS,
    DEFAULT_EPOCH,
    DIMSIZE,
    PRODUCT_TYPES,
    TILE_ROWS,
)
from orbitlake.functions.geolocation import UNITS
from orbitlake.functions.slots import PIXEL_TIME_TYPES, total_slots


class ConfigurationError(ValueError):
    """Options or inputs that make the whole run wrong, not just one scene."""


@dataclass(frozen=True)
class CubeConfig:
    """What to store and how; the schema follows from this alone, before any input is listed."""

    product_type: str
    resolutions: str | None = None
    channels: str | None = None
    include_pixel_quality: bool = True
    include_pixel_time: bool = True
    include_calibration: bool = True
    include_geolocation: bool = True
    flat: bool = False
    pixel_time_dtype: str = "float64"
    projection_units: str = "meter"
    tile_rows: int | None = None
    tile_overrides: tuple[tuple[str, int], ...] = ()
    time_epoch: str = DEFAULT_EPOCH
    time_end: str | None = None
    time_slots: int | None = None
    partial_chunk: str = "fill"
    body_chunks: tuple[int, int] | None = None
    lon0: float = 0.0

    def __post_init__(self) -> None:
        def require(ok: bool, message: str) -> None:
            if not ok:
                raise ConfigurationError(message)

        require(
            self.product_type in PRODUCT_TYPES,
            f"product_type must be one of {PRODUCT_TYPES}, got {self.product_type!r}",
        )
        require(
            self.pixel_time_dtype in PIXEL_TIME_TYPES,
            f"pixel_time_dtype must be one of {sorted(PIXEL_TIME_TYPES)}",
        )
        require(self.projection_units in UNITS, f"projection_units must be one of {UNITS}")
        require(self.partial_chunk in ("fill", "error"), "partial_chunk must be fill or error")
        require(self.tile_rows is None or self.tile_rows > 0, "tile_rows must be positive")
        for resolution, rows in self.tile_overrides:
            require(resolution in TILE_ROWS, f"unknown resolution {resolution!r} in tile_overrides")
            require(
                0 < rows <= DIMSIZE[resolution], f"tile_overrides of {resolution}: {rows} rows"
            )
        if self.body_chunks is not None:
            first, last = self.body_chunks
            require(
                1 <= first <= last <= BODY_CHUNKS,
                f"body_chunks {self.body_chunks} must satisfy 1 <= first <= last <= {BODY_CHUNKS}",
            )
        require(-180 <= self.lon0 <= 180, f"lon0 must lie between -180 and 180, got {self.lon0}")
        datetime.date.fromisoformat(self.time_epoch)

    @property
    def slot_count(self) -> int | None:
        return total_slots(self.time_slots, self.time_end, self.time_epoch)

    def tile_height(self, resolution: str) -> int:
        """Rows per output tile: the override of the resolution, else ``tile_rows``, else default."""
        return dict(self.tile_overrides).get(resolution) or self.tile_rows or TILE_ROWS[resolution]

    def signature(self) -> dict:
        """Options that decide whether two runs write the same slice of a cube.

        ``resolutions`` are those asked for; a log entry holds the ones they resolve to.
        """
        options = asdict(self)
        for name in ("projection_units", "partial_chunk", "time_end", "time_slots", "flat", "lon0"):
            options.pop(name)
        requested = (self.resolutions or "").split(",")
        options["resolutions"] = sorted({r.strip() for r in requested if r.strip()})
        options["tile_overrides"] = {res: rows for res, rows in self.tile_overrides}
        options["body_chunks"] = None if self.body_chunks is None else list(self.body_chunks)
        return options
