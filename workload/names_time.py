"""Name and time scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlake.functions import names, slots
from workload import tables as t
from workload.registry import query


@query(
    "detect_product",
    f"WITH {t.FILES_SQL} SELECT event_id, product AS product_type FROM mixed",
)
def detect_product(spark, sf):
    return t.mixed_files(spark, sf).select(
        "event_id", names.detect_product(F.col("path")).alias("product_type")
    )


@query(
    "sensing_start",
    f"""WITH {t.FILES_SQL} SELECT event_id, CASE WHEN form <> 'garbage'
      THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS sensing_start FROM mixed""",
)
def sensing_start(spark, sf):
    start = names.sensing_start(F.col("path"))
    return t.mixed_files(spark, sf).select("event_id", t.text(start).alias("sensing_start"))


@query(
    "slot_label",
    """SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS label FROM events""",
)
def slot_label(spark, sf):
    label = slots.slot_label(F.col("ts"))
    return t.read(spark, sf, "events").select("event_id", t.text(label).alias("label"))


@query(
    "parse_chunk_name",
    f"""WITH {t.FILES_SQL} SELECT event_id, form = 'chunk' AS ok,
      product AS product_type,
      CASE WHEN form = 'chunk' THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS start,
      CASE WHEN form = 'chunk' THEN cycle ELSE -1 END AS repeat_cycle,
      CASE WHEN form = 'chunk' THEN num ELSE -1 END AS chunk_no,
      form = 'chunk' AND num = 41 AS is_trail FROM mixed""",
)
def parse_chunk_name(spark, sf):
    parsed = t.mixed_files(spark, sf).select(
        "event_id", names.parse_chunk_name(F.col("path")).alias("p")
    )
    return parsed.select(
        "event_id",
        F.col("p.error").isNull().alias("ok"),
        "p.product_type",
        t.text("p.sensing_start").alias("start"),
        F.coalesce("p.repeat_cycle", F.lit(-1)).alias("repeat_cycle"),
        F.coalesce("p.chunk_no", F.lit(-1)).alias("chunk_no"),
        "p.is_trail",
    )


@query(
    "nominal_cycle_start",
    f"""WITH {t.FILES_SQL} SELECT event_id, strftime(coordinate, '%Y-%m-%d %H:%M:%S') AS nominal
      FROM chunk""",
)
def nominal_cycle_start(spark, sf):
    parsed = names.parse_chunk_name(F.col("path"))
    nominal = slots.nominal_cycle_start(parsed["sensing_start"], parsed["repeat_cycle"])
    return t.chunk_files(spark, sf).select("event_id", t.text(nominal).alias("nominal"))


@query("slot_index", f"WITH {t.ACQ_SQL} SELECT event_id, slot FROM acq")
def slot_index(spark, sf):
    slot = slots.slot_index(F.col("ts"), t.EPOCH)
    return t.read(spark, sf, "events").select("event_id", slot.alias("slot"))


@query(
    "total_slots",
    """SELECT o_custkey, CAST((datediff('day', min(CAST(o_orderdate AS DATE)),
      max(CAST(o_orderdate AS DATE))) + 1) * 144 AS BIGINT) AS n_slots FROM orders GROUP BY o_custkey""",
)
def total_slots(spark, sf):
    day = F.col("o_orderdate").cast("date")
    spans = t.read(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min(day).alias("first"), F.max(day).alias("last")
    )
    length = slots.axis_length(F.col("first"), F.date_add("last", 1))
    return spans.select("o_custkey", length.alias("n_slots"))


@query(
    "scene_time",
    f"""WITH {t.FILES_SQL} SELECT event_id, CASE form
      WHEN 'zip' THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
      WHEN 'chunk' THEN strftime(coordinate, '%Y-%m-%d %H:%M:%S') END AS label FROM mixed""",
)
def scene_time(spark, sf):
    label = slots.scene_time(F.col("path"))
    return t.mixed_files(spark, sf).select("event_id", t.text(label).alias("label"))


@query(
    "scene_uri",
    f"""WITH {t.FILES_SQL} SELECT event_id,
      'fci-scene://' || product || '/' || strftime(coordinate, '%Y%m%d%H%M%S') AS uri FROM chunk""",
)
def scene_uri(spark, sf):
    path = F.col("path")
    parsed = names.parse_chunk_name(path)
    nominal = slots.nominal_cycle_start(parsed["sensing_start"], parsed["repeat_cycle"])
    uri = names.scene_uri(parsed["product_type"], nominal)
    return t.chunk_files(spark, sf).select("event_id", uri.alias("uri"))


@query(
    "repeat_cycle_id",
    "SELECT event_id, CAST(hour(ts) * 6 + minute(ts) // 10 + 1 AS INTEGER) AS cycle FROM events",
)
def repeat_cycle_id(spark, sf):
    cycle = slots.repeat_cycle_id(F.col("ts"))
    return t.read(spark, sf, "events").select("event_id", cycle.alias("cycle"))


@query(
    "pixel_time_to_timestamp",
    """SELECT event_id, strftime(TIMESTAMP '2000-01-01' + to_microseconds(
      CAST(round((event_id * 1000 + value) * 1000000) AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS observed
      FROM events""",
)
def pixel_time_to_timestamp(spark, sf):
    observed = slots.pixel_time_to_timestamp(F.col("event_id") * 1000 + F.col("value"))
    return t.read(spark, sf, "events").select(
        "event_id", F.date_format(observed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("observed")
    )


@query(
    "pixel_time_types",
    """SELECT event_id, value * 10000000 AS f64,
      CASE WHEN value * 10000000 < 2147483648 THEN CAST(trunc(value * 10000000) AS BIGINT) ELSE -1 END AS i32,
      CAST(trunc(value * 10000000) AS BIGINT) AS i64,
      CAST(CAST(value * 10000000 AS FLOAT) AS DOUBLE) AS f32 FROM events""",
)
def pixel_time_types(spark, sf):
    seconds = F.col("value") * 10_000_000
    return t.read(spark, sf, "events").select(
        "event_id",
        slots.pixel_time_as(seconds, "float64").alias("f64"),
        F.coalesce(slots.pixel_time_as(seconds, "int32").cast("bigint"), F.lit(-1)).alias("i32"),
        slots.pixel_time_as(seconds, "int64").alias("i64"),
        slots.pixel_time_as(seconds, "float32").cast("double").alias("f32"),
    )


@query(
    "split_slot_ranges",
    f"""WITH {t.ACQ_SQL}, span AS (
      SELECT channel, min(slot) AS s, max(slot) + 1 AS e FROM acq GROUP BY channel)
      SELECT channel, a AS slot_start, least(a + 6, e) AS slot_end
      FROM (SELECT channel, e, unnest(range(s, e, 6)) AS a FROM span)""",
)
def split_slot_ranges(spark, sf):
    spans = t.acquisitions(spark, sf).groupBy("channel").agg(
        F.min("slot").alias("s"), (F.max("slot") + 1).alias("e")
    )
    return slots.slot_windows(spans, F.col("s"), F.col("e"), 6).drop("s", "e")
