"""Cube tables: writing, merging, reading, identity and a whole ingest."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.functions import slots
from orbitlake.functions.radiometry import calibrated
from orbitlake.ingest import ingest_decoded
from orbitlake.operators.rasters import GEO_KEYS, attach_geo, pixels
from orbitlake.plans.catalog import attach_wavelength
from orbitlake.plans.config import CubeConfig
from orbitlake.session import scratch_path
from orbitlake.sources import cube, grids, ledger
from orbitlake.sources.chunks import TABLES, Decoded, schema_of
from orbitlake.streaming import ingest as streaming
from workload import tables as t
from workload.registry import query

CHANNEL_OF_FLAG = "CASE l_returnflag WHEN 'A' THEN 'vis_04' WHEN 'N' THEN 'vis_05' ELSE 'vis_06' END"


def lines(spark, sf, value: str, condition: str = "true"):
    """Line items as rows of a cube: slot, channel and full-disk row from their keys."""
    return (
        t.read(spark, sf, "lineitem")
        .filter(condition)
        .groupBy(
            F.lit(K.FDHSI).alias("product_type"),
            F.lit("1km").alias("resolution"),
            F.col("l_linenumber").alias("slot"),
            F.expr(CHANNEL_OF_FLAG).alias("channel"),
            F.col("l_orderkey").alias("y"),
        )
        .agg(F.max(value).alias("counts"))
    )


def lines_sql(value: str, condition: str = "true") -> str:
    return f"""SELECT l_linenumber AS slot, {CHANNEL_OF_FLAG} AS channel, l_orderkey AS y,
      max({value}) AS counts FROM lineitem WHERE {condition} GROUP BY ALL"""


COLUMNS = ("slot", "channel", "y", "counts")


@query(
    "read_cube",
    f"""SELECT * FROM ({lines_sql("l_partkey")})
      WHERE slot >= 2 AND slot < 5 AND channel IN ('vis_04', 'vis_06') AND y >= 1000 AND y < 9000""",
)
def read_cube(spark, sf):
    path = scratch_path(spark, "cube")
    cube.write_cube(lines(spark, sf, "l_partkey"), path)
    found = cube.read_cube(
        spark, path, K.FDHSI, ["1km"], ["vis_04", "vis_06"], slots=(2, 5), rows=(1000, 9000)
    )
    return found.select(*COLUMNS)


def _merged(new_wins: bool) -> str:
    old, new = ("a", "b") if new_wins else ("b", "a")
    return f"""WITH a AS ({lines_sql("l_partkey", "l_linestatus = 'F'")}),
      b AS ({lines_sql("l_suppkey", "l_linenumber <= 3")})
      SELECT * FROM {new} UNION ALL SELECT * FROM {old} WHERE NOT EXISTS (SELECT 1 FROM {new}
        WHERE {new}.slot = {old}.slot AND {new}.channel = {old}.channel AND {new}.y = {old}.y)"""


@query("write_cube_regions", _merged(new_wins=True))
def write_cube_regions(spark, sf):
    """A later piece replaces the rows it covers; rows and slots it does not cover survive."""
    path = scratch_path(spark, "cube")
    cube.write_cube(lines(spark, sf, "l_partkey", "l_linestatus = 'F'"), path)
    cube.merge_into(spark, lines(spark, sf, "l_suppkey", "l_linenumber <= 3"), path)
    return cube.read_cube(spark, path).select(*COLUMNS)


@query("resume_merge", _merged(new_wins=False))
def resume_merge(spark, sf):
    """Resuming adds missing rows and leaves stored ones alone."""
    path = scratch_path(spark, "cube")
    cube.write_cube(lines(spark, sf, "l_partkey", "l_linestatus = 'F'"), path)
    late = lines(spark, sf, "l_suppkey", "l_linenumber <= 3")
    cube.merge_into(spark, late, path, keep_existing=True)
    return cube.read_cube(spark, path).select(*COLUMNS)


@query("flat_layout", _merged(new_wins=True))
def flat_layout(spark, sf):
    """The same merge in a cube without product and resolution folders."""
    path = scratch_path(spark, "flat")
    cube.write_cube(lines(spark, sf, "l_partkey", "l_linestatus = 'F'"), path, flat=True)
    late = lines(spark, sf, "l_suppkey", "l_linenumber <= 3")
    cube.merge_into(spark, late, path, flat=True)
    return cube.read_cube(spark, path).select(*COLUMNS)


@query(
    "static_tables",
    f"""WITH {t.CHANNELS_SQL}, {t.ACQ_SQL} SELECT DISTINCT a.channel,
      round(CAST(c.wavelength AS DOUBLE), 4) AS wavelength FROM acq a JOIN cat c USING (channel)""",
)
def static_tables(spark, sf):
    """A static table is written by the first run that brings it and kept by the later ones."""
    path = scratch_path(spark, "static")
    found = attach_wavelength(t.acquisitions(spark, sf).select("channel").distinct())
    wavelength = F.round(F.col("wavelength_um").cast("double"), 4).alias("wavelength")
    cube.write_once(found.select("channel", wavelength), path, "channels")
    cube.write_once(found.select("channel", F.lit(0.0).alias("wavelength")), path, "channels")
    return spark.read.parquet(f"{path}/channels")


@query(
    "static_groups",
    f"""WITH {t.CHANNELS_SQL}, {t.ACQ_SQL} SELECT c.resolution, a.channel, count(*) AS n_rows,
      round(CAST(c.wavelength AS DOUBLE), 4) AS wavelength
      FROM acq a JOIN cat c USING (channel) WHERE c.product_type = 'FDHSI' GROUP BY ALL""",
)
def static_groups(spark, sf):
    """Runs of single resolutions bring the static rows of theirs, once each."""
    path = scratch_path(spark, "static")
    for resolution in ("1km", "2km", "1km"):
        config = CubeConfig(K.FDHSI, resolutions=resolution, include_geolocation=False)
        for name, table in grids.static_tables(spark, config).items():
            cube.write_groups(table, path, name, ["product_type", "resolution"])
    known = spark.read.parquet(f"{path}/channels")
    found = t.acquisitions(spark, sf).select("channel").join(known, "channel")
    wavelength = F.round(F.first("central_wavelength").cast("double"), 4).alias("wavelength")
    return found.groupBy("resolution", "channel").agg(F.count("*").alias("n_rows"), wavelength)


@query(
    "cube_identity",
    """SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_size % 4 = 0 THEN 'layout,stripe'
        WHEN p_size % 3 = 0 THEN 'layout' ELSE 'stripe' END AS differing
      FROM part WHERE p_size % 3 = 0 OR p_size % 4 = 0""",
)
def cube_identity(spark, sf):
    size = F.col("p_size")
    stored = t.read(spark, sf, "part").select(
        "p_partkey",
        F.lit(t.EPOCH).alias("epoch"),
        F.lit(K.CYCLE_SECONDS).alias("cadence_s"),
        F.lit("grouped").alias("layout"),
        F.lit(None).cast("string").alias("grid"),
        F.when(size % 2 == 0, cube.stripe_text(size, size + 1)).alias("stripe"),
    )
    late = F.when(size % 4 == 0, size + 2).otherwise(size + 1)
    wanted = stored.join(t.read(spark, sf, "part").select("p_partkey", "p_size"), "p_partkey")
    wanted = wanted.withColumns(
        {
            "layout": F.when(size % 3 == 0, "flat").otherwise("grouped"),
            "stripe": F.when(size % 2 == 0, cube.stripe_text(size, late)),
        }
    )
    found = cube.identity_conflicts(wanted, stored, "p_partkey")
    return found.select("p_partkey", F.array_join("differing", ",").alias("differing"))


@query(
    "run_signature",
    """SELECT c_custkey AS run, c_mktsegment AS channels,
      CASE WHEN c_custkey % 2 = 0 THEN 'FDHSI' ELSE 'HRFI' END AS product_type FROM customer""",
)
def run_signature(spark, sf):
    key = F.col("c_custkey")
    signature = F.struct(
        F.when(key % 2 == 0, K.FDHSI).otherwise(K.HRFI).alias("product_type"),
        F.col("c_mktsegment").alias("channels"),
    )
    log = t.read(spark, sf, "customer").select(
        F.to_json(signature).alias("signature"), key.cast("string").alias("metrics")
    )
    runs = cube.run_signature(log)
    return runs.select(F.col("metrics").cast("bigint").alias("run"), "channels", "product_type")


def decoded_tables(spark, sf) -> Decoded:
    """Decoded tables of ten scenes: scanlines from vectors, root tables from events."""
    scan = t.scan_in(spark, sf).withColumn("scene_id", F.col("scene_id").cast("string"))
    scan = scan.withColumn("part_order", F.col("y").cast("bigint"))
    rows = scan.select(
        "scene_id",
        "part_order",
        F.lit(1).alias("chunk_no"),
        "nc_channel",
        F.col("y").alias("row_start"),
        (F.col("y") + 1).alias("row_stop"),
    )
    times = t.time_rows(spark, sf).withColumn("scene_id", F.col("scene_id").cast("string"))
    calibration = rows.select(
        "scene_id",
        "part_order",
        "nc_channel",
        (F.col("row_start") + 1).cast("double").alias("slope"),
        F.lit(0.5).alias("offset"),
        F.lit(2.0).alias("warm_slope"),
        F.lit(-1.0).alias("warm_offset"),
        *(F.lit(None).cast("double").alias(c) for c in K.CONVERSION_CONSTANTS),
    )
    found = {
        "chunk_rows": rows,
        "scan_in": scan,
        "time_rows": times,
        "platform_rows": times,
        "calib_rows": calibration,
        "members": scan.select(
            "scene_id",
            "part_order",
            F.concat(F.lit("FCI-1C-RRAD-FDHSI-CHK-BODY-"), "part_order", F.lit(".nc")).alias("name"),
        ),
        "errors": scan.select("scene_id", "part_order", F.lit("").alias("error")).limit(0),
    }
    return Decoded(**{n: found[n].select(*schema_of(n).fieldNames()) for n in TABLES})


CONFIG = CubeConfig(K.FDHSI, include_geolocation=False, time_epoch=t.EPOCH)


def run_ingest(spark, decoded: Decoded, path: str, config: CubeConfig = CONFIG, **options) -> None:
    label = F.col("scene_id").cast("bigint")
    scenes = decoded.scan_in.select("scene_id").distinct().select(
        "scene_id",
        F.lit(K.FDHSI).alias("product_type"),
        slots.slot_start(label, t.EPOCH).alias("coordinate"),
    )
    ingest_decoded(spark, scenes, decoded, config, path, **options)


@query(
    "ingest",
    f"""WITH {t.SCAN_SQL}, {t.TIME_SQL}, cal AS (
        SELECT scene_id, min(y) + 1 AS slope FROM pixel GROUP BY scene_id)
      SELECT p.scene_id AS slot, CASE p.nc_channel WHEN 'ir_38' THEN '2km' ELSE '1km' END AS resolution,
        p.y, p.x, p.counts, p.quality AS pixel_quality, l.time_s AS pixel_time,
        CASE WHEN p.nc_channel = 'ir_38' AND p.counts > 4095 THEN p.counts * 2.0::DOUBLE - 1
          ELSE p.counts * c.slope + 0.5::DOUBLE END AS radiance
      FROM pixel p JOIN cal c USING (scene_id)
      LEFT JOIN last_rows l ON l.scene_id = p.scene_id AND l.idx = p.idx""",
)
def ingest(spark, sf):
    """Ten scenes through a whole ingest, read back pixel by pixel with their radiance."""
    path = scratch_path(spark, "ingest")
    run_ingest(spark, decoded_tables(spark, sf), path)
    scan = cube.attach_slot_calibration(cube.read_cube(spark, path), path)
    wide = pixels(
        scan.select(
            "slot", "resolution", "channel", "y", "counts", "pixel_quality", "pixel_time",
            "slope", "offset", "warm_slope", "warm_offset",
        ),
        "counts", "pixel_quality", "pixel_time",
    )
    radiance = calibrated(
        F.col("counts"), F.col("channel").isin(*K.DUAL_GAIN_CHANNELS), F.col("slope"),
        F.col("offset"), F.col("warm_slope"), F.col("warm_offset"),
    )
    return wide.select(
        F.col("slot").cast("bigint").alias("slot"),
        "resolution",
        F.col("y").cast("bigint").alias("y"),
        F.col("x").cast("bigint").alias("x"),
        F.col("counts").cast("bigint").alias("counts"),
        F.col("pixel_quality").cast("bigint").alias("pixel_quality"),
        "pixel_time",
        radiance.alias("radiance"),
    )


@query(
    "ingest_fill",
    f"""WITH {t.SCAN_SQL}, cal AS (SELECT scene_id, min(y) + 1 AS slope FROM pixel GROUP BY scene_id)
      SELECT p.scene_id AS slot, p.y, p.x, CASE WHEN p.counts % 50 <> 7 THEN p.counts ELSE -1 END AS counts,
        CASE WHEN p.counts % 50 = 7 THEN NULL
          WHEN p.nc_channel = 'ir_38' AND p.counts > 4095 THEN p.counts * 2.0::DOUBLE - 1
          ELSE p.counts * c.slope + 0.5::DOUBLE END AS radiance
      FROM pixel p JOIN cal c USING (scene_id)""",
)
def ingest_fill(spark, sf):
    """Fill in the counts of the input is missing in the cube, and has no radiance."""
    decoded = decoded_tables(spark, sf)
    filled = F.transform("counts", lambda c: F.when(c % 50 == 7, K.COUNTS_FILL).otherwise(c))
    scan = decoded.scan_in.withColumn("counts", filled.cast("array<int>"))
    path = scratch_path(spark, "ingest")
    run_ingest(spark, replace(decoded, scan_in=scan), path)
    stored = cube.attach_slot_calibration(cube.read_cube(spark, path), path)
    wide = pixels(
        stored.select("slot", "channel", "y", "counts", "slope", "offset", "warm_slope", "warm_offset"),
        "counts",
    )
    radiance = calibrated(
        F.col("counts"), F.col("channel").isin(*K.DUAL_GAIN_CHANNELS), F.col("slope"),
        F.col("offset"), F.col("warm_slope"), F.col("warm_offset"),
    )
    whole = (F.col(c).cast("bigint").alias(c) for c in ("slot", "y", "x"))
    counts = F.coalesce("counts", F.lit(-1)).cast("bigint").alias("counts")
    return wide.select(*whole, counts, radiance.alias("radiance"))


@query(
    "stream_then_ingest",
    f"""WITH {t.SCAN_SQL} SELECT scene_id AS slot, y,
      CAST(sum(CASE WHEN y % 2 = 0 THEN -counts ELSE counts END) AS BIGINT) AS total
      FROM pixel GROUP BY scene_id, y""",
)
def stream_then_ingest(spark, sf):
    """A stream brought every other row, and no slot tables; the ingest keeps those and adds the rest."""
    decoded = decoded_tables(spark, sf)
    path = scratch_path(spark, "ingest")
    streamed = decoded.scan_in.filter("y % 2 = 0").select(
        F.lit(K.FDHSI).alias("product_type"),
        F.when(F.col("nc_channel") == "ir_38", "2km").otherwise("1km").alias("resolution"),
        F.col("scene_id").cast("int").alias("slot"),
        F.col("nc_channel").alias("channel"),
        "y",
        F.transform("counts", lambda c: -c).alias("counts"),
    )
    folder = scratch_path(spark, "streamed")
    streamed.write.parquet(folder)
    rows = streaming.file_stream(spark, folder, streamed.schema)
    checkpoint = scratch_path(spark, "checkpoint")
    streaming.merge_stream(rows, path, checkpoint, config=CONFIG).awaitTermination()
    run_ingest(spark, decoded, path, existing="resume")
    stored = cube.read_cube(spark, path)
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c)
    return stored.select(
        F.col("slot").cast("bigint").alias("slot"), F.col("y").cast("bigint").alias("y"), total.alias("total")
    )


@query(
    "files_left",
    """WITH f AS (
        SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'FDHSI' ELSE 'HRFI' END AS product_type,
          user_id // 2 AS slot, event_id % 41 + 1 AS num, event_id % 3 AS state FROM events),
      chunk AS (
        SELECT product_type, slot, num, bool_or(state = 0) AS whole, bool_or(state < 2) AS begun
        FROM f WHERE num <= 40 GROUP BY ALL),
      scene AS (
        SELECT product_type, slot, bool_or(begun) AS begun, bool_or(NOT whole) AS open FROM chunk GROUP BY ALL)
      SELECT event_id, product_type, slot, CAST(num AS INTEGER) AS chunk_no
      FROM f LEFT JOIN chunk USING (product_type, slot, num) LEFT JOIN scene USING (product_type, slot)
      WHERE NOT coalesce(scene.begun, false) OR (num <= 40 AND NOT whole) OR (num = 41 AND open)""",
)
def files_left(spark, sf):
    """Chunks stored whole need not be opened; a half stored one does, and a TRAIL with any of them."""
    files = t.read(spark, sf, "events").select(
        "event_id",
        F.when(F.col("user_id") % 2 == 0, K.FDHSI).otherwise(K.HRFI).alias("product_type"),
        F.floor(F.col("user_id") / 2).alias("slot"),
        (F.pmod("event_id", F.lit(41)) + 1).cast("int").alias("chunk_no"),
        (F.col("event_id") % 3).alias("state"),
    )
    files = files.withColumn("scene_id", F.concat_ws("/", "product_type", "slot"))
    rows = ledger.wanted_rows(spark, CubeConfig(K.FDHSI)).unionByName(
        ledger.wanted_rows(spark, CubeConfig(K.HRFI))
    )
    half = F.col("row_start") + F.floor((F.col("row_stop") - F.col("row_start")) / 2)
    stored = files.where("state < 2").join(rows, ["product_type", "chunk_no"])
    stored = stored.withColumn("row_stop", F.when(F.col("state") == 0, F.col("row_stop")).otherwise(half.cast("int")))
    left = ledger.files_left(files.drop("state"), stored, rows)
    return left.select("event_id", "product_type", "slot", "chunk_no")


@query(
    "signature_conflicts",
    """WITH last AS (
        SELECT o_custkey % 500 AS slot, arg_max(o_orderpriority, o_orderkey) AS stored FROM orders GROUP BY ALL),
      wanted AS (SELECT DISTINCT c_custkey % 500 AS slot, CASE c_nationkey % 2 WHEN 0 THEN '1-URGENT' ELSE '5-LOW' END AS wanted
        FROM customer)
      SELECT slot, wanted, stored FROM wanted JOIN last USING (slot) WHERE wanted <> stored""",
)
def signature_conflicts(spark, sf):
    """Slots whose latest run had other options than the one that would go on with them."""
    grid = [F.lit(K.FDHSI).alias("product_type"), F.lit("1km").alias("resolution")]
    runs = t.read(spark, sf, "orders").select(
        *grid,
        (F.col("o_custkey") % 500).alias("slot"),
        F.col("o_orderpriority").alias("signature"),
        F.timestamp_seconds("o_orderkey").alias("logged_at"),
    )
    wanted = t.read(spark, sf, "customer").select(
        *grid,
        (F.col("c_custkey") % 500).alias("slot"),
        F.when(F.col("c_nationkey") % 2 == 0, "1-URGENT").otherwise("5-LOW").alias("asked"),
    )
    found = [
        ledger.signature_conflicts(wanted.where(F.col("asked") == a), runs, F.lit(a)) for a in ("1-URGENT", "5-LOW")
    ]
    return found[0].unionByName(found[1]).select("slot", "wanted", "stored")


@query(
    "scenes_to_retry",
    """WITH last AS (
        SELECT user_id, max(ts) FILTER (event_id % 4 = 0) AS failed, max(ts) FILTER (event_id % 4 <> 0) AS good,
          count(*) FILTER (event_id % 4 = 0) AS n_failures FROM events GROUP BY user_id)
      SELECT user_id AS scene_id, 'file ' || e.event_id AS error, n_failures
      FROM last JOIN events e USING (user_id) WHERE e.ts = failed AND e.event_id % 4 = 0
        AND (good IS NULL OR good < failed)""",
)
def scenes_to_retry(spark, sf):
    """Scenes whose last run failed, with its error; a later success takes a scene off the list."""
    log = t.read(spark, sf, "events").select(
        F.col("user_id").alias("scene_id"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("file "), F.col("event_id").cast("string"))).alias("error"),
        F.col("ts").alias("logged_at"),
    )
    return ledger.scenes_to_retry(log).select("scene_id", "error", "n_failures")


LON0 = 9.5
PIECE = 64


@query(
    "grid_reuse",
    f"""WITH pt AS (SELECT l_orderkey, l_linenumber, l_partkey,
        ((l_partkey * 31 + l_suppkey) % 5568 - 2783.5::DOUBLE) * 5.58871526468e-05::DOUBLE AS xa,
        (l_orderkey * 53 % 5568 - 2783.5::DOUBLE) * 5.58871526468e-05::DOUBLE AS ya
        FROM lineitem){t.LATLON_SQL.removeprefix(t.PIXELS_SQL)}
      SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(latitude AS DOUBLE), 3) AS latitude,
        round(CAST(longitude + {LON0}::FLOAT + 180::FLOAT - 180::FLOAT AS DOUBLE), 3) AS longitude FROM ll""",
)
def grid_reuse(spark, sf):
    """Exported grids of another longitude, taken over by an ingest and looked up in its cube."""
    grid, path = scratch_path(spark, "grid"), scratch_path(spark, "located")
    grids.export_geo(spark, ["2km"], grid, lon0=LON0)
    config = replace(CONFIG, resolutions="2km", include_geolocation=True, lon0=LON0)
    run_ingest(spark, decoded_tables(spark, sf), path, config, grid=grid)
    seen = t.read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.lit(K.FDHSI).alias("product_type"),
        F.lit("2km").alias("resolution"),
        F.pmod(F.col("l_orderkey") * 53, F.lit(5568)).cast("int").alias("y"),
        F.pmod(F.col("l_partkey") * 31 + F.col("l_suppkey"), F.lit(5568)).cast("int").alias("x"),
    )
    # Pixels meet pieces of a line, not whole lines of 44 KB each.
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(K.DIMSIZE["2km"] // PIECE - 1)),
        lambda n: F.struct(
            F.slice("latitude", n * PIECE + 1, PIECE).alias("latitude"),
            F.slice("longitude", n * PIECE + 1, PIECE).alias("longitude"),
        ),
    )
    geo = cube.read_cube(spark, path, table="geo").select(*GEO_KEYS, F.posexplode(pieces).alias("piece", "at"))
    seen = seen.withColumn("piece", F.floor(F.col("x") / PIECE).cast("int"))
    located = attach_geo(seen, geo.select(*GEO_KEYS, "piece", "at.*"), [*GEO_KEYS, "piece"])

    def degrees(name: str):
        return F.round(F.get(name, F.col("x") % PIECE).cast("double"), 3).alias(name)

    return located.select(
        "l_orderkey", "l_linenumber", "l_partkey", degrees("latitude"), degrees("longitude")
    )
