"""Missing-value rules: fills and NaN become NULL, absent attributes stay NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbitlake.constants import COUNTS_FILL, FLOAT32_DEFAULT_FILL


def mask_fill(values: Column, fill: int | float = COUNTS_FILL) -> Column:
    """Stored scalar with the fill turned into NULL."""
    return F.nullif(values, F.lit(fill))


def mask_fill_row(values: Column, fill: int | float = COUNTS_FILL) -> Column:
    """The same for every element of a scanline array."""
    return F.transform(values, lambda v: F.nullif(v, F.lit(fill)))


def source_fill_to_null(value: Column, fill: Column | None = None) -> Column:
    """A float32 source scalar: its declared fill, else the format's default fill, and NaN are NULL."""
    default = F.lit(FLOAT32_DEFAULT_FILL).cast("float")
    declared = default if fill is None else F.coalesce(fill.cast("float"), default)
    return F.when((value.cast("float") == declared) | F.isnan(value), None).otherwise(value)


def attr_or_null(attrs: Column, name: str) -> Column:
    """Numeric attribute out of a map of attribute texts; NULL when it is absent."""
    return F.try_element_at(attrs, F.lit(name)).try_cast("double")


def row_bounds(
    attr_start: Column, attr_end: Column, var_start: Column, var_end: Column, strict: bool = True
) -> Column:
    """0-based half-open rows from 1-based inclusive bounds.

    The attribute pair wins when both are there, else the variable pair; a part with neither fails
    the query, or gives a NULL struct with ``strict=False``.
    """

    def span(start: Column, end: Column) -> Column:
        return F.struct((start - 1).alias("row_start"), end.alias("row_stop"))

    missing = F.raise_error(F.lit("no start/end row metadata"))
    missing = missing.cast("struct<row_start:int,row_stop:int>") if strict else F.lit(None)
    return (
        F.when(attr_start.isNotNull() & attr_end.isNotNull(), span(attr_start, attr_end))
        .when(var_start.isNotNull() & var_end.isNotNull(), span(var_start, var_end))
        .otherwise(missing)
    )
