"""File-name semantics as Column expressions.

All functions take a path or URI column and look at its last component only, so remote URIs stay as
they are. Unparseable input gives NULL; the callers decide whether that is an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbitlake.constants import FDHSI, HRFI

# Parts of a file name.
PRODUCT_TOKEN = "FCI-1C-RRAD"
BODY_TOKEN = "CHK-BODY"
TRAIL_TOKEN = "CHK-TRAIL"
CHUNK_TAIL = r"_\d{14}_[A-Z]+_[A-Z]+_\d{14}_\d{14}_N__[A-Z]_\d{4}_\d{4}\.nc$"


def item_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stamp_to_timestamp(stamp: Column) -> Column:
    """Parse ``yyyyMMddHHmmss`` digits to TIMESTAMP_NTZ; impossible dates and times give NULL.

    The parser knows TIMESTAMP only; the session runs in UTC, so the wall clock stays as it is.
    """
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")


def sensing_start(path: Column) -> Column:
    """Start time named in a file: the second-last 14-digit group, or the only one."""
    stamps = F.regexp_extract_all(item_name(path), F.lit(r"(\d{14})"), 1)
    # A single group is its own "second-last".
    return stamp_to_timestamp(F.coalesce(F.try_element_at(stamps, F.lit(-2)), F.get(stamps, F.lit(0))))


def detect_product(path: Column) -> Column:
    name = item_name(path)
    return F.when(name.contains(FDHSI), FDHSI).when(name.contains(HRFI), HRFI)


def is_zip(path: Column) -> Column:
    name = item_name(path)
    return name.endswith(".zip") & name.contains(PRODUCT_TOKEN) & sensing_start(path).isNotNull()


def is_chunk(path: Column) -> Column:
    name = item_name(path)
    return (
        name.endswith(".nc")
        & name.contains(PRODUCT_TOKEN)
        & (name.contains(BODY_TOKEN) | name.contains(TRAIL_TOKEN))
    )


def item_kind(path: Column) -> Column:
    return F.when(is_zip(path), "zip").when(is_chunk(path), "chunk").otherwise("ignored")


def is_trail(path: Column) -> Column:
    return item_name(path).contains(TRAIL_TOKEN)


def part_number(path: Column) -> Column:
    """Digits right before ``.nc``, 0 when there are none."""
    digits = F.regexp_extract(item_name(path), r"(?i)(\d+)\.nc$", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def parse_chunk_name(path: Column) -> Column:
    """Fields of a chunk file name as a struct; ``error`` is NULL exactly when all are readable.

    The tail has a fixed layout, so after one match its fields sit at fixed distances from the end.
    """
    name = item_name(path)
    matches = name.rlike(CHUNK_TAIL)
    start = F.when(matches, stamp_to_timestamp(F.substring(name, -47, 14)))
    product = detect_product(path)
    error = (
        F.when(~is_chunk(path), F.concat(F.lit("not a chunk file name: "), name))
        .when(~matches, F.concat(F.lit("cannot parse chunk file name: "), name))
        .when(start.isNull(), F.concat(F.lit("invalid sensing start: "), name))
        .when(product.isNull(), F.concat(F.lit("no product type in name: "), name))
    )
    return F.struct(
        product.alias("product_type"),
        start.alias("sensing_start"),
        F.when(matches, F.substring(name, -12, 4).try_cast("int")).alias("repeat_cycle"),
        F.when(matches, F.substring(name, -7, 4).try_cast("int")).alias("chunk_no"),
        is_trail(path).alias("is_trail"),
        error.alias("error"),
    )


def scene_uri(product_type: Column, coordinate: Column) -> Column:
    return F.concat(
        F.lit("fci-scene://"), product_type, F.lit("/"), F.date_format(coordinate, "yyyyMMddHHmmss")
    )
