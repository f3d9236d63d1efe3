"""Time-axis arithmetic as Column expressions (naive UTC timestamps)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbitlake.constants import (
    CYCLE_MINUTES,
    CYCLE_SECONDS,
    CYCLES_PER_DAY,
    DEFAULT_EPOCH,
    PIXEL_TIME_ORIGIN,
)
from orbitlake.functions import names

START_TOLERANCE_S = 300


def _fail(message: Column, to: str) -> Column:
    return F.raise_error(message).cast(to)


def epoch_lit(epoch: str) -> Column:
    return F.lit(datetime.datetime.fromisoformat(epoch)).cast("timestamp_ntz")


def slot_label(ts: Column) -> Column:
    """Floor to the full minute; never carries into the next one."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def cycle_of_day(ts: Column) -> Column:
    """0-based cycle of the day, 0..143."""
    return F.hour(ts) * 6 + F.floor(F.minute(ts) / CYCLE_MINUTES)


def repeat_cycle_id(ts: Column) -> Column:
    """1-based cycle number of the day, 1..144."""
    return (cycle_of_day(ts) + 1).cast("int")


def slot_index(
    ts: Column, epoch: str = DEFAULT_EPOCH, slot_count: int | None = None, strict: bool = True
) -> Column:
    """Slot on the axis that starts at midnight of ``epoch``; seconds never move a slot.

    Times before the epoch, or at and beyond ``slot_count``, fail the query; ``strict=False`` gives
    NULL for them.
    """
    seconds = F.timestamp_diff("SECOND", epoch_lit(epoch), ts)
    # Integer division rounds towards zero, so negative distances are cut off first.
    slot = F.floor(seconds / CYCLE_SECONDS).cast("bigint")
    outside = ts < epoch_lit(epoch)
    if slot_count is not None:
        outside = outside | (slot >= slot_count)
    message = F.concat(F.lit("time outside the slot axis: "), ts.cast("string"))
    return F.when(outside, _fail(message, "bigint") if strict else F.lit(None)).otherwise(slot)


def slot_start(slot: Column, epoch: str = DEFAULT_EPOCH) -> Column:
    return F.timestamp_add("SECOND", slot * CYCLE_SECONDS, epoch_lit(epoch)).cast("timestamp_ntz")


def total_slots(
    time_slots: int | None = None, time_end: str | None = None, epoch: str = DEFAULT_EPOCH
) -> int | None:
    """Length of the axis: ``time_slots`` wins, else whole days up to ``time_end``, else unbounded."""
    if time_slots is not None:
        if int(time_slots) <= 0:
            raise ValueError("time_slots must be a positive integer")
        return int(time_slots)
    if time_end is None:
        return None
    days = (datetime.date.fromisoformat(time_end) - datetime.date.fromisoformat(epoch)).days
    if days <= 0:
        raise ValueError(f"time_end {time_end} is not after epoch {epoch}")
    return days * CYCLES_PER_DAY


def axis_length(first_day: Column, end_day: Column) -> Column:
    """Column form of the day-based axis length; NULL when the end is not after the start."""
    days = F.datediff(end_day, first_day)
    return F.when(days > 0, (days * CYCLES_PER_DAY).cast("bigint"))


def nominal_cycle_start(start: Column, cycle: Column, strict: bool = True) -> Column:
    """Nominal start of a cycle counted from midnight of the sensing day.

    A chunk of the last cycle may be sensed just after midnight: a nominal start more than five
    minutes ahead of the sensing start belongs to the day before. A cycle outside 1..144 fails the
    query, or gives NULL with ``strict=False``.
    """
    minutes = (cycle - 1) * CYCLE_MINUTES
    second_of_day = F.hour(start) * 3600 + F.minute(start) * 60 + F.floor(F.second(start))
    ahead = minutes * 60 > second_of_day + START_TOLERANCE_S
    midnight = F.date_trunc("day", start).cast("timestamp_ntz")
    nominal = F.timestamp_add("MINUTE", minutes - F.when(ahead, 24 * 60).otherwise(0), midnight)
    message = F.concat(F.lit("repeat cycle outside 1..144: "), cycle.cast("string"))
    bad = _fail(message, "timestamp_ntz") if strict else F.lit(None)
    return F.when(~cycle.between(1, CYCLES_PER_DAY), bad).otherwise(nominal.cast("timestamp_ntz"))


def scene_time(path: Column) -> Column:
    """Time label of an input item: floored start of a ZIP, nominal cycle start of a chunk."""
    chunk = names.parse_chunk_name(path)
    return F.when(names.is_zip(path), slot_label(names.sensing_start(path))).when(
        chunk["error"].isNull(),
        nominal_cycle_start(chunk["sensing_start"], chunk["repeat_cycle"], strict=False),
    )


def pixel_time_to_timestamp(seconds: Column) -> Column:
    """Seconds since 2000-01-01 to a timestamp, to the microsecond."""
    micros = F.round(seconds * 1_000_000).try_cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, epoch_lit(PIXEL_TIME_ORIGIN)).cast("timestamp_ntz")


PIXEL_TIME_TYPES = {"float64": "double", "float32": "float", "int32": "int", "int64": "bigint"}


def pixel_time_as(seconds: Column, dtype: str) -> Column:
    """Pixel time in a storage type; missing, NaN and out-of-range values are NULL.

    Integer types truncate towards zero.
    """
    if dtype not in PIXEL_TIME_TYPES:
        raise ValueError(f"pixel_time_dtype must be one of {sorted(PIXEL_TIME_TYPES)}, got {dtype!r}")
    return F.nanvl(seconds, F.lit(None)).try_cast(PIXEL_TIME_TYPES[dtype])


def slot_windows(df, start: Column, end: Column, step: int):
    """Split each half-open slot range of ``df`` into disjoint ranges of ``step`` slots."""
    first = F.explode(F.sequence(start, end - 1, F.lit(step).cast("bigint"))).alias("slot_start")
    split = df.filter(start < end).select("*", end.alias("_end"), first)
    return split.withColumn(
        "slot_end", F.least(F.col("slot_start") + step, F.col("_end"))
    ).drop("_end")
