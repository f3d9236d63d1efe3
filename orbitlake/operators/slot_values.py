"""Per-slot tables and the slot axis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlake.constants import DEFAULT_EPOCH
from orbitlake.functions import slots
from orbitlake.functions.ephemeris import sun_earth_distance


def with_slots(scenes: DataFrame, epoch: str = DEFAULT_EPOCH, slot_count: int | None = None) -> DataFrame:
    """Add the slot of each scene's time label; a label off the axis fails the query."""
    return scenes.withColumn("slot", slots.slot_index(F.col("coordinate"), epoch, slot_count))


def slot_window(df: DataFrame, start: int, end: int) -> DataFrame:
    """Rows of the half-open slot range; a partition filter on a cube."""
    return df.filter((F.col("slot") >= start) & (F.col("slot") < end))


def slot_times(scenes: DataFrame) -> DataFrame:
    """Time label of each slot; the latest label when several scenes share a slot."""
    return scenes.groupBy("slot").agg(F.max("coordinate").alias("time"))


def slot_axis(spark: SparkSession, present: DataFrame, n_slots: int | None = None) -> DataFrame:
    """Every slot of the axis with its label; NULL where no product was ingested.

    Without a length the axis ends at the last slot present (one number reaches the driver).
    """
    if n_slots is None:
        last = present.agg(F.max("slot").alias("last")).first().last
        n_slots = 0 if last is None else last + 1
    axis = spark.range(n_slots).withColumnRenamed("id", "slot")
    return axis.join(present.select("slot", "time"), "slot", "left")


def slot_meta(scenes: DataFrame, platform: DataFrame) -> DataFrame:
    """Per-scene platform means, time label and Sun distance, keyed by slot."""
    return scenes.join(platform, "scene_id", "left").withColumns(
        {"time": F.col("coordinate"), "sun_earth_distance": sun_earth_distance(F.col("coordinate"))}
    )


def cycles(events: DataFrame, ts: str) -> DataFrame:
    """Tumbling 10-minute window of every row, aligned to midnight like the slots."""
    return events.withColumn("cycle", F.window(F.col(ts).cast("timestamp"), "10 minutes"))
