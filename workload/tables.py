"""The given tables seen as inputs of the cube, once as DataFrames and once as SQL.

Events stand for acquisitions: a name, a product, a chunk number and a slot follow from each event.
Embeddings stand for scanlines, line items for pixels, customers for requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.functions import slots
from orbitlake.plans import catalog

EPOCH = "2024-01-01"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text(ts: Column | str) -> Column:
    """Timestamps leave a query as text."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


# --- file names -------------------------------------------------------------


def chunk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chunk file per event."""
    return chunk_files_of(read(spark, sf_dir, "events"))


def chunk_files_of(events: DataFrame) -> DataFrame:
    """Events as chunk files.

    The cycle is that of three minutes before the sensing start, so chunks sensed just after
    midnight belong to the last cycle of the day before. Every fifth size is unknown.
    """
    number = F.pmod("event_id", F.lit(41)) + 1
    cycle = slots.repeat_cycle_id(F.col("ts") - F.expr("INTERVAL 3 MINUTES"))
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    part = F.when(number == 41, "TRAIL").otherwise("BODY")
    path = F.concat(
        name_head(), F.lit("CHK-"), part, F.lit("---NC4E_C_XXXX_"), stamp, F.lit("_IDPFI_OPE_"),
        stamp, F.lit("_"), stamp, F.lit("_N__O_"), F.lpad(cycle.cast("string"), 4, "0"),
        F.lit("_"), F.lpad(number.cast("string"), 4, "0"), F.lit(".nc"),
    )
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        path.alias("path"),
        F.when(F.col("event_id") % 5 != 0, (F.col("value") * 100).cast("bigint")).alias("length"),
    )


def name_head() -> Column:
    product = F.when(F.col("user_id") % 2 == 0, K.FDHSI).otherwise(K.HRFI)
    return F.concat(F.lit("s3://in/W_XX-FCI-1C-RRAD-"), product, F.lit("-FD--"))


def mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One input item per event: mostly chunks, some ZIPs, some files that are neither."""
    event, stamp = F.col("event_id"), F.date_format("ts", "yyyyMMddHHmmss")
    path = (
        F.when(event % 7 == 0, F.concat(name_head(), stamp, F.lit("_"), stamp, F.lit("_END.zip")))
        .when(event % 11 == 0, F.concat(name_head(), F.lit("CHK-BODY---NC4E_garbage.nc")))
        .when(event % 13 == 0, F.concat(name_head(), stamp, F.lit("_preview.jpg")))
        .otherwise(F.col("path"))
    )
    return chunk_files(spark, sf_dir).withColumn("path", path)


FILES_SQL = """files AS (
  SELECT event_id, ts, user_id, value,
    CASE WHEN user_id % 2 = 0 THEN 'FDHSI' ELSE 'HRFI' END AS product,
    CAST(event_id % 41 + 1 AS INTEGER) AS num,
    CAST(hour(ts - INTERVAL 3 MINUTE) * 6 + minute(ts - INTERVAL 3 MINUTE) // 10 + 1 AS INTEGER) AS cycle,
    strftime(ts, '%Y%m%d%H%M%S') AS stamp,
    CASE WHEN event_id % 7 = 0 THEN 'zip' WHEN event_id % 11 = 0 THEN 'garbage'
         WHEN event_id % 13 = 0 THEN 'other' ELSE 'chunk' END AS form,
    CASE WHEN event_id % 5 <> 0 THEN CAST(trunc(value * 100) AS BIGINT) END AS length
  FROM events),
chunk AS (
  SELECT *, CASE WHEN date_trunc('day', ts) + (cycle - 1) * INTERVAL 10 MINUTE > ts + INTERVAL 5 MINUTE
      THEN date_trunc('day', ts) + (cycle - 1) * INTERVAL 10 MINUTE - INTERVAL 1 DAY
      ELSE date_trunc('day', ts) + (cycle - 1) * INTERVAL 10 MINUTE END AS coordinate,
    'W_XX-FCI-1C-RRAD-' || product || '-FD--CHK-' || CASE WHEN num = 41 THEN 'TRAIL' ELSE 'BODY' END
      || '---NC4E_C_XXXX_' || stamp || '_IDPFI_OPE_' || stamp || '_' || stamp || '_N__O_'
      || lpad(CAST(cycle AS VARCHAR), 4, '0') || '_' || lpad(CAST(num AS VARCHAR), 4, '0') || '.nc'
      AS name
  FROM files),
mixed AS (
  SELECT * REPLACE (CASE form
    WHEN 'zip' THEN 'W_XX-FCI-1C-RRAD-' || product || '-FD--' || stamp || '_' || stamp || '_END.zip'
    WHEN 'garbage' THEN 'W_XX-FCI-1C-RRAD-' || product || '-FD--CHK-BODY---NC4E_garbage.nc'
    WHEN 'other' THEN 'W_XX-FCI-1C-RRAD-' || product || '-FD--' || stamp || '_preview.jpg'
    ELSE name END AS name)
  FROM chunk)"""

# --- catalogs as SQL --------------------------------------------------------

BODY_SQL = "body(product_type, resolution, chunk_no, row_start, row_stop) AS (VALUES " + ", ".join(
    f"('{product}', '{res}', {n + 1}, {ends[n - 1] if n else 0}, {ends[n]})"
    for (product, res), ends in K.CHUNK_ROW_ENDS.items()
    for n in range(len(ends))
) + ")"

CHANNELS_SQL = (
    "cat(product_type, resolution, res_order, channel, nc_channel, idx, dimsize, wavelength, dual) "
    "AS (VALUES "
    + ", ".join(
        f"('{product}', '{res}', {order}, '{channel}', '{nc}', {index}, {K.DIMSIZE[res]}, "
        f"CAST({K.WAVELENGTH_UM[channel]} AS FLOAT), {channel in K.DUAL_GAIN_CHANNELS})"
        for product in K.PRODUCT_TYPES
        for order, res in enumerate(r for p, r in K.CHANNELS if p == product)
        for index, (channel, nc) in enumerate(K.CHANNELS[(product, res)])
    )
    + ")"
)

# --- parts ------------------------------------------------------------------


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of one scene per user, with the rows of their chunk number; each chunk once."""
    rows = catalog.body_rows(spark)
    events = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("scene_id"),
        F.lit(K.FDHSI).alias("product_type"),
        F.when(F.col("user_id") % 3 == 0, "2km").otherwise("1km").alias("resolution"),
        (F.pmod("event_id", F.lit(40)) + 1).cast("int").alias("chunk_no"),
    )
    return events.distinct().join(
        F.broadcast(rows), ["product_type", "resolution", "chunk_no"]
    )


PARTS_SQL = f"""{BODY_SQL},
part AS (
  SELECT DISTINCT user_id AS scene_id, 'FDHSI' AS product_type,
    CASE WHEN user_id % 3 = 0 THEN '2km' ELSE '1km' END AS resolution,
    CAST(event_id % 40 + 1 AS INTEGER) AS chunk_no
  FROM events),
parts AS (SELECT * FROM part JOIN body USING (product_type, resolution, chunk_no)),
grid(resolution, dimsize, tile_rows) AS (VALUES ('1km', 11136, 278), ('2km', 5568, 139)),
covered AS (
  SELECT DISTINCT scene_id, resolution, y, y // tile_rows AS tile, dimsize, tile_rows
  FROM (SELECT scene_id, resolution, unnest(range(row_start, row_stop)) AS y FROM parts)
  JOIN grid USING (resolution))"""


def shifted_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as delivered: some start a few rows early, some are empty, and copies are kept."""
    rows = catalog.body_rows(spark)
    event = F.col("event_id")
    events = read(spark, sf_dir, "events").select(
        F.concat(F.col("user_id"), F.lit("/"), F.date_format("ts", "yyyyMMdd")).alias("scene_id"),
        F.lit(K.FDHSI).alias("product_type"),
        F.lit("1km").alias("resolution"),
        event,
        F.when(event % 19 != 0, F.pmod(event, F.lit(42)).cast("int")).alias("chunk_no"),
        (F.pmod(event, F.lit(40)) + 1).cast("int").alias("body"),
        F.when(event % 3 == 0, 5).otherwise(0).alias("early"),
        (event % 17 == 0).alias("empty"),
    )
    placed = events.join(
        F.broadcast(rows.withColumnRenamed("chunk_no", "body")),
        ["product_type", "resolution", "body"],
    )
    start = F.greatest(F.col("row_start") - F.col("early"), F.lit(0))
    return (
        placed.withColumn("row_start", start)
        .withColumn("row_stop", F.when(F.col("empty"), F.col("row_start")).otherwise(F.col("row_stop")))
        .drop("body", "early", "empty")
    )


SHIFTED_SQL = f"""{BODY_SQL},
shifted AS (
  SELECT e.event_id, e.user_id || '/' || strftime(e.ts, '%Y%m%d') AS scene_id, '1km' AS resolution,
    CASE WHEN e.event_id % 19 <> 0 THEN CAST(e.event_id % 42 AS INTEGER) END AS chunk_no,
    greatest(b.row_start - CASE WHEN e.event_id % 3 = 0 THEN 5 ELSE 0 END, 0) AS row_start,
    CASE WHEN e.event_id % 17 = 0
      THEN greatest(b.row_start - CASE WHEN e.event_id % 3 = 0 THEN 5 ELSE 0 END, 0)
      ELSE b.row_stop END AS row_stop
  FROM events e JOIN body b
    ON b.product_type = 'FDHSI' AND b.resolution = '1km' AND b.chunk_no = e.event_id % 40 + 1)"""

# --- decoded tables ---------------------------------------------------------


def time_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root table rows: ten scenes, 41 parts, indices that repeat across parts."""
    event = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        F.pmod("user_id", F.lit(10)).alias("scene_id"),
        F.pmod(event, F.lit(41)).alias("part_order"),
        event.alias("row_no"),
        F.floor("value").alias("idx"),
        (F.col("value") + event).alias("time_s"),
        F.when(event % 13 == 0, float("nan")).otherwise(F.col("value")).alias("subsatellite_latitude"),
        F.when(F.col("user_id") % 10 != 3, F.col("value") * 2).alias("subsatellite_longitude"),
        (35_786_000 + F.col("value")).alias("platform_altitude"),
    )


TIME_SQL = """time_rows AS (
  SELECT user_id % 10 AS scene_id, event_id % 41 AS part_order, event_id AS row_no,
    CAST(floor(value) AS BIGINT) AS idx, value + event_id AS time_s,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS lat,
    CASE WHEN user_id % 10 <> 3 THEN value * 2 END AS lon,
    35786000 + value AS alt
  FROM events),
last_rows AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY scene_id, idx ORDER BY part_order DESC, row_no DESC) AS rn FROM time_rows)
  WHERE rn = 1)"""


def scan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanlines of ten scenes: counts, quality and index of 64 pixels from each vector."""
    channel = F.when(F.col("label") % 2 == 0, "ir_38").otherwise("vis_06")

    def pixels(factor: int, modulus: int, dtype: str) -> Column:
        return F.transform(
            "embedding",
            lambda e: F.pmod(F.floor(F.abs(e.cast("double")) * factor), F.lit(modulus)).cast(dtype),
        )

    return read(spark, sf_dir, "embeddings").select(
        F.col("label").cast("bigint").alias("scene_id"),
        channel.alias("nc_channel"),
        F.col("vec_id").cast("int").alias("y"),
        pixels(16000, 8192, "int").alias("counts"),
        pixels(1000, 256, "smallint").alias("quality"),
        pixels(1000, 600, "int").alias("index_map"),
    )


SCAN_SQL = """scan AS (
  SELECT CAST(label AS BIGINT) AS scene_id, vec_id AS y,
    CASE WHEN label % 2 = 0 THEN 'ir_38' ELSE 'vis_06' END AS nc_channel,
    CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS x,
    abs(CAST(unnest(embedding) AS DOUBLE)) AS e
  FROM embeddings),
pixel AS (
  SELECT scene_id, y, nc_channel, x,
    CAST(floor(e * 16000) AS BIGINT) % 8192 AS counts,
    CAST(floor(e * 1000) AS BIGINT) % 256 AS quality,
    CAST(floor(e * 1000) AS BIGINT) % 600 AS idx
  FROM scan)"""

# --- acquisitions and pixels ------------------------------------------------

# Channel of each event type (fixed values of this workload).
EVENT_CHANNELS = {
    "view": "ir_38",
    "signup": "vis_04",
    "click": "vis_06",
    "purchase": "wv_63",
    "error": "ir_105",
}
CHANNEL_CASE = (
    "CASE event_type "
    + " ".join(f"WHEN '{event}' THEN '{channel}'" for event, channel in EVENT_CHANNELS.items())
    + " END"
)


def acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pixel per event: slot and channel from the event, counts from its value."""
    return read(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        slots.slot_index(F.col("ts"), EPOCH).alias("slot"),
        F.expr(CHANNEL_CASE).alias("channel"),
        F.floor(F.col("value") * 20).cast("int").alias("counts"),
        "value",
    )


ACQ_SQL = f"""acq AS (
  SELECT event_id, ts, value,
    CAST(datediff('day', DATE '{EPOCH}', CAST(ts AS DATE)) * 144 + hour(ts) * 6 + minute(ts) // 10
      AS BIGINT) AS slot,
    {CHANNEL_CASE} AS channel, CAST(floor(value * 20) AS BIGINT) AS counts
  FROM events)"""


def slot_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration of every slot and channel that was acquired."""
    dual = F.col("channel").isin(*K.DUAL_GAIN_CHANNELS)
    top = F.col("top")
    return (
        acquisitions(spark, sf_dir)
        .groupBy("slot", "channel")
        .agg(F.max("value").alias("top"))
        .select(
            "slot",
            "channel",
            dual.alias("dual_gain"),
            (F.sqrt(top) / 1000).alias("slope"),
            (top / -1000).alias("offset"),
            F.when(dual, 0.02 + F.sqrt(top) / 1000).alias("warm_slope"),
            F.when(dual, top / -10).alias("warm_offset"),
        )
    )


SLOT_CHANNEL_SQL = f"""{ACQ_SQL},
cal AS (
  SELECT slot, channel, channel = 'ir_38' AS dual, sqrt(max(value)) / 1000 AS slope,
    max(value) / -1000 AS "offset",
    CASE WHEN channel = 'ir_38' THEN 0.02::DOUBLE + sqrt(max(value)) / 1000 END AS warm_slope,
    CASE WHEN channel = 'ir_38' THEN max(value) / -10 END AS warm_offset
  FROM acq GROUP BY slot, channel)"""


def grid_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One grid position per line item, over all resolutions."""
    resolution = (
        F.when(F.col("l_returnflag") == "A", "500m")
        .when(F.col("l_returnflag") == "N", "1km")
        .otherwise("2km")
    )
    size = F.expr("CASE l_returnflag WHEN 'A' THEN 22272 WHEN 'N' THEN 11136 ELSE 5568 END")
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        resolution.alias("resolution"),
        F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), size).alias("row"),
        F.pmod(F.col("l_partkey") * 13 + F.col("l_suppkey"), size).alias("col"),
    )


PIXELS_SQL = """px AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE l_returnflag WHEN 'A' THEN '500m' WHEN 'N' THEN '1km' ELSE '2km' END AS resolution,
    (l_orderkey * 7 + l_linenumber)
      % (CASE l_returnflag WHEN 'A' THEN 22272 WHEN 'N' THEN 11136 ELSE 5568 END) AS "row",
    (l_partkey * 13 + l_suppkey)
      % (CASE l_returnflag WHEN 'A' THEN 22272 WHEN 'N' THEN 11136 ELSE 5568 END) AS col
  FROM lineitem),
pt AS (
  SELECT px.*, (col - (n / 2.0 - 0.5)) * s AS xa, ("row" - (n / 2.0 - 0.5)) * s AS ya
  FROM px JOIN (VALUES ('500m', 22272::DOUBLE, 1.39717881617e-05::DOUBLE),
    ('1km', 11136::DOUBLE, 2.79435763233999e-05::DOUBLE),
    ('2km', 5568::DOUBLE, 5.58871526468e-05::DOUBLE)) g(resolution, n, s)
  USING (resolution))"""

#: Rows of the tiles that hold chunks 32 to 40, for each grid.
WINDOWS_SQL = BODY_SQL + """,
win AS (
  SELECT resolution, CAST(min(row_start) // height * height AS INTEGER) AS y_start,
    CAST(least(((max(row_stop) - 1) // height + 1) * height, size) AS INTEGER) AS y_stop
  FROM body JOIN (VALUES ('FDHSI', '1km', 11136, 278), ('FDHSI', '2km', 5568, 139),
    ('HRFI', '500m', 22272, 556)) g(product_type, resolution, size, height) USING (product_type, resolution)
  WHERE chunk_no BETWEEN 32 AND 40 GROUP BY resolution, height, size)"""

LATLON_SQL = PIXELS_SQL + """,
seen AS (
  SELECT pt.*, 42164.537::DOUBLE AS h, power(6378.137::DOUBLE / 6356.752314, 2) AS f,
    cos(ya) * cos(ya) + power(6378.137::DOUBLE / 6356.752314, 2) * sin(ya) * sin(ya) AS dn
  FROM pt),
rooted AS (
  SELECT *, h * h * cos(xa) * cos(xa) * cos(ya) * cos(ya)
    - dn * (h * h - 6378.137::DOUBLE * 6378.137) AS disc FROM seen),
ranged AS (
  SELECT *, (h * cos(xa) * cos(ya) - sqrt(greatest(disc, 0))) / dn AS sn FROM rooted),
ll AS (
  SELECT *, CASE WHEN disc >= 0 THEN CAST(degrees(atan(f * sn * sin(ya) / sqrt(
      power(h - sn * cos(xa) * cos(ya), 2) + power(sn * sin(xa) * cos(ya), 2)))) AS FLOAT) END AS latitude,
    CASE WHEN disc >= 0 THEN CAST(degrees(atan2(
      sn * sin(xa) * cos(ya), h - sn * cos(xa) * cos(ya))) AS FLOAT) END AS longitude
  FROM ranged)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One selection per customer: product, resolutions and channels as option texts."""
    key = F.col("c_custkey")
    names = F.array(
        *(F.lit(c) for c in [*K.WAVELENGTH_UM, "ir_38_hr", "nope"])
    )

    def pick(offset: int, factor: int) -> Column:
        return F.element_at(names, (F.pmod(key * factor + offset, F.lit(18)) + 1).cast("int"))

    listed = F.concat(
        pick(0, 1), F.lit(", "), pick(3, 5), F.lit(" ,"), pick(7, 11), F.lit(",,"), pick(0, 1)
    )
    return read(spark, sf_dir, "customer").select(
        key.alias("request_id"),
        F.when(key % 2 == 0, K.FDHSI).otherwise(K.HRFI).alias("product_type"),
        F.when(key % 4 == 1, "2km, 9km,1km").when(key % 4 == 2, "1km").alias("resolutions"),
        F.when(key % 3 != 0, listed).alias("channels"),
    )


REQUEST_SQL = f"""{CHANNELS_SQL},
pool AS (SELECT {[*K.WAVELENGTH_UM, "ir_38_hr", "nope"]!r} AS names),
request AS (
  SELECT c_custkey AS request_id, CASE WHEN c_custkey % 2 = 0 THEN 'FDHSI' ELSE 'HRFI' END AS product_type,
    CASE c_custkey % 4 WHEN 1 THEN ['2km', '9km', '1km'] WHEN 2 THEN ['1km'] END AS resolutions,
    CASE WHEN c_custkey % 3 <> 0 THEN [names[c_custkey % 18 + 1], names[(c_custkey * 5 + 3) % 18 + 1],
      names[(c_custkey * 11 + 7) % 18 + 1]] END AS channels
  FROM customer, pool),
wanted AS (
  SELECT request_id, product_type, channel, min(pos) AS pos
  FROM (SELECT request_id, product_type, unnest(channels) AS channel,
      generate_subscripts(channels, 1) AS pos FROM request WHERE channels IS NOT NULL)
  GROUP BY ALL
  UNION ALL
  SELECT request_id, product_type, channel, idx FROM request JOIN cat USING (product_type)
  WHERE channels IS NULL),
chosen AS (
  SELECT w.request_id, w.product_type, w.channel, c.resolution, c.res_order, c.nc_channel, c.dimsize, c.dual,
    CAST(row_number() OVER (PARTITION BY w.request_id, c.resolution ORDER BY pos) - 1 AS INTEGER)
      AS channel_index
  FROM wanted w LEFT JOIN cat c USING (product_type, channel)),
res AS (
  SELECT DISTINCT request_id, c.resolution FROM request r JOIN cat c USING (product_type)
  WHERE r.resolutions IS NULL OR list_contains(r.resolutions, c.resolution)),
effective AS (
  SELECT request_id, product_type, resolution, res_order, dimsize, count(*) AS n_channels,
    CAST(row_number() OVER (PARTITION BY request_id ORDER BY res_order) - 1 AS INTEGER)
      AS resolution_index
  FROM chosen JOIN res USING (request_id, resolution)
  GROUP BY request_id, product_type, resolution, res_order, dimsize)"""
