"""Structured Streaming operators, run to the end of the given files."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.functions import slots
from orbitlake.operators.slot_values import cycles
from orbitlake.plans.config import CubeConfig
from orbitlake.session import scratch_path
from orbitlake.sources.cube import attach_slot_calibration, merge_into, read_cube, with_tiles, write_cube
from orbitlake.streaming import ingest as streaming
from workload import tables as t
from workload.registry import query


def event_stream(spark, sf):
    schema = t.read(spark, sf, "events").schema
    return streaming.file_stream(spark, sf, schema, glob="events.parquet")


def finish(spark, rows, label: str):
    """Run a windowed stream over all files and open what it wrote."""
    path = scratch_path(spark, label)
    streaming.write_stream(rows, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "cycle_windows",
    f"""WITH {t.ACQ_SQL} SELECT slot, strftime(TIMESTAMP '{t.EPOCH}' + slot * INTERVAL 10 MINUTE,
      '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n_rows FROM acq GROUP BY slot""",
)
def cycle_windows(spark, sf):
    """Tumbling windows of a batch and the slots they coincide with."""
    windows = cycles(t.acquisitions(spark, sf), "ts")
    counts = windows.groupBy("cycle").agg(F.count("*").alias("n_rows"))
    start = F.col("cycle.start").cast("timestamp_ntz")
    return counts.select(
        slots.slot_index(start, t.EPOCH).alias("slot"), t.text(start).alias("start"), "n_rows"
    )


@query(
    "stream_windows",
    f"""WITH {t.ACQ_SQL} SELECT slot, channel, count(*) AS n_rows FROM acq
      WHERE TIMESTAMP '{t.EPOCH}' + (slot + 1) * INTERVAL 10 MINUTE
        <= (SELECT max(ts) FROM acq) - INTERVAL 30 MINUTE GROUP BY slot, channel""",
)
def stream_windows(spark, sf):
    """Windows closed by the watermark; the last half hour is still open at the end."""
    stream = event_stream(spark, sf).withColumn("channel", F.expr(t.CHANNEL_CASE))
    found = finish(spark, streaming.window_counts(stream, "ts", "channel"), "windows")
    slot = slots.slot_index(F.col("cycle.start").cast("timestamp_ntz"), t.EPOCH)
    return found.select(slot.alias("slot"), "channel", "n_rows")


@query(
    "scene_completeness",
    f"""WITH {t.ACQ_SQL}, body AS (SELECT slot, ts, event_id % 41 + 1 AS chunk_no FROM acq
        WHERE event_id % 41 + 1 <= 40)
      SELECT slot, CAST(count(DISTINCT chunk_no) AS INTEGER) AS n_chunks,
        count(DISTINCT chunk_no) = 40 AS complete FROM body
      WHERE TIMESTAMP '{t.EPOCH}' + (slot + 1) * INTERVAL 10 MINUTE
        <= (SELECT max(ts) FROM body) - INTERVAL 30 MINUTE GROUP BY slot""",
)
def scene_completeness(spark, sf):
    chunks = event_stream(spark, sf).select(
        F.col("ts").alias("sensing_start"),
        (F.pmod("event_id", F.lit(41)) + 1).alias("chunk_no"),
    )
    found = finish(spark, streaming.scene_completeness(chunks), "completeness")
    slot = slots.slot_index(F.col("cycle.start").cast("timestamp_ntz"), t.EPOCH)
    return found.select(slot.alias("slot"), "n_chunks", "complete")


@query(
    "scene_arrivals",
    f"""WITH {t.ACQ_SQL}, scene AS (
        SELECT slot, CAST(count(DISTINCT event_id % 4) AS INTEGER) AS n_chunks FROM acq GROUP BY slot)
      SELECT slot, n_chunks, n_chunks = 4 AS complete FROM scene
      WHERE n_chunks = 4 OR TIMESTAMP '{t.EPOCH}' + (slot + 1) * INTERVAL 10 MINUTE
        <= (SELECT max(ts) FROM acq) - INTERVAL 30 MINUTE""",
)
def scene_arrivals(spark, sf):
    """Scenes of four chunks, emitted when complete, or when the watermark has passed them."""
    chunks = event_stream(spark, sf).select(
        F.col("ts").alias("sensing_start"), (F.pmod("event_id", F.lit(4)) + 1).alias("chunk_no")
    )
    found = finish(spark, streaming.scene_arrivals(chunks, needed=4), "arrivals")
    slot = slots.slot_index(F.col("cycle").cast("timestamp_ntz"), t.EPOCH)
    return found.select(slot.alias("slot"), "n_chunks", "complete")


ROWS_SQL = f"line AS (SELECT *, {t.CHANNEL_CASE} AS channel FROM events)"


def cube_rows(stream, slot="user_id"):
    """Events as scanlines: a user stands for a slot of the axis, unless another column is given."""
    return stream.select(
        F.lit(K.FDHSI).alias("product_type"),
        F.lit("1km").alias("resolution"),
        F.col(slot).alias("slot"),
        F.expr(t.CHANNEL_CASE).alias("channel"),
        F.col("event_id").alias("y"),
        F.col("value").alias("counts"),
    )


@query(
    "stream_ingest",
    f"""WITH {t.ACQ_SQL} SELECT slot, channel, event_id AS y, value AS counts FROM acq""",
)
def stream_ingest(spark, sf):
    """Files merged into a cube by a stream, each row into the slot of its time."""
    path = scratch_path(spark, "stream")
    rows = cube_rows(streaming.with_slot(event_stream(spark, sf), "ts", t.EPOCH), "slot")
    streaming.merge_stream(rows, path, scratch_path(spark, "checkpoint")).awaitTermination()
    found = read_cube(spark, path)
    return found.select(F.col("slot").cast("bigint").alias("slot"), "channel", "y", "counts")


@query(
    "stream_replay",
    f"""WITH {ROWS_SQL} SELECT user_id AS slot, channel, count(*) AS n_rows,
      round(sum(value), 4) AS total FROM line GROUP BY ALL""",
)
def stream_replay(spark, sf):
    """The same files ingested twice leave the cube as it was."""
    path = scratch_path(spark, "stream")
    for _run in range(2):
        rows = cube_rows(event_stream(spark, sf))
        streaming.merge_stream(rows, path, scratch_path(spark, "checkpoint")).awaitTermination()
    found = read_cube(spark, path).groupBy(F.col("slot").cast("bigint").alias("slot"), "channel")
    return found.agg(F.count("*").alias("n_rows"), F.round(F.sum("counts"), 4).alias("total"))


@query(
    "late_chunk",
    f"""WITH {ROWS_SQL} SELECT user_id AS slot, channel, event_id AS y,
      CASE WHEN channel = 'ir_38' THEN -value ELSE value END AS counts FROM line""",
)
def late_chunk(spark, sf):
    """Rows that come later fill their lines and keep the rest."""
    path = scratch_path(spark, "late")
    events = event_stream(spark, sf)
    rows = cube_rows(events)
    is_late = F.col("channel") == "ir_38"
    streaming.merge_stream(rows, path, scratch_path(spark, "checkpoint")).awaitTermination()
    late = rows.filter(is_late).withColumn("counts", -F.col("counts"))
    streaming.merge_stream(late, path, scratch_path(spark, "checkpoint")).awaitTermination()
    found = read_cube(spark, path)
    return found.select(F.col("slot").cast("bigint").alias("slot"), "channel", "y", "counts")


@query(
    "rejected_names",
    f"""WITH {t.FILES_SQL} SELECT replace(name, '.nc', 'x.nc') AS name,
      'cannot parse chunk file name: ' || replace(name, '.nc', 'x.nc') AS error
      FROM chunk WHERE event_id % 4 = 0""",
)
def rejected_names(spark, sf):
    """Files of a stream whose names cannot be read are listed, not lost."""
    listed = t.chunk_files_of(event_stream(spark, sf))
    broken = F.when(F.col("event_id") % 4 == 0, F.regexp_replace("path", r"\.nc$", "x.nc"))
    files = listed.select(F.coalesce(broken, "path").alias("path"), "length")
    return finish(spark, streaming.rejected_stream(files), "rejected").select("name", "error")


@query(
    "dedup_paths",
    f"""WITH {t.FILES_SQL} SELECT product AS product_type, num AS chunk_no, count(DISTINCT name) AS n_paths
      FROM chunk GROUP BY product, num""",
)
def dedup_paths(spark, sf):
    """Chunk files listed twice in a stream count once."""
    stream = event_stream(spark, sf)
    listed = t.chunk_files_of(stream).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    chunks = streaming.chunk_stream(listed.drop("copy").select("path", "length")).select(
        "product_type", "chunk_no", "path"
    )
    found = finish(spark, chunks, "paths")
    return found.groupBy("product_type", "chunk_no").agg(F.count("*").alias("n_paths"))


#: Tiles of a quarter of the 1 km grid keep the number of partitions of the given tables small.
TALL = 2784


def tiled_lines(spark, sf, condition: str, value: str):
    """Events as tiled scanlines of one grid."""
    rows = t.read(spark, sf, "events").where(condition).groupBy(
        F.lit(K.FDHSI).alias("product_type"),
        F.lit("1km").alias("resolution"),
        F.col("user_id").alias("slot"),
        F.expr(t.CHANNEL_CASE).alias("channel"),
        F.pmod("event_id", F.lit(K.DIMSIZE["1km"])).cast("int").alias("y"),
    ).agg(F.expr(f"max({value})").alias("counts"))
    return with_tiles(rows, CubeConfig(K.FDHSI, tile_rows=TALL))


def tiled_sql(condition: str, value: str) -> str:
    return f"""SELECT user_id AS slot, {t.CHANNEL_CASE} AS channel, CAST(event_id % 11136 AS INTEGER) AS y,
      max({value}) AS counts FROM events WHERE {condition} GROUP BY ALL"""


LATE = f"event_id % 2 = 1 AND event_id % 11136 < {TALL}"


@query(
    "late_tile",
    f"""WITH old AS ({tiled_sql("event_id % 2 = 0 OR user_id % 3 = 0", "value")}), new AS ({tiled_sql(LATE, "-value")})
      SELECT *, y // {TALL} AS tile FROM new UNION ALL
      SELECT *, y // {TALL} FROM old WHERE NOT EXISTS (SELECT 1 FROM new
        WHERE new.slot = old.slot AND new.channel = old.channel AND new.y = old.y)""",
)
def late_tile(spark, sf):
    """Late rows of one tile: it is rebuilt in every slot they belong to, the others stay."""
    path = scratch_path(spark, "tiles")
    write_cube(tiled_lines(spark, sf, "event_id % 2 = 0 OR user_id % 3 = 0", "value"), path)
    merge_into(spark, tiled_lines(spark, sf, LATE, "-value"), path)
    found = read_cube(spark, path)
    return found.select(F.col("slot").cast("bigint").alias("slot"), "channel", "y", "counts", "tile")


def scene_files(spark, sf):
    """Chunk files of a scene per user: a number's events make the content of its file."""
    number = (F.pmod("event_id", F.lit(41)) + 1).cast("int")
    grouped = t.read(spark, sf, "events").groupBy("user_id", number.alias("number")).agg(
        F.count("*").cast("int").alias("n"), F.pmod(F.max("event_id"), F.lit(60000)).cast("int").alias("top")
    )
    stamp = F.date_format(slots.slot_start(F.col("user_id"), t.EPOCH) + F.expr("INTERVAL 1 SECOND"), "yyyyMMddHHmmss")
    cycle = F.pmod("user_id", F.lit(K.CYCLES_PER_DAY)) + 1
    part = F.when(F.col("number") == 41, "TRAIL").otherwise("BODY")
    path = F.concat(
        F.lit(f"s3://in/W_XX-FCI-1C-RRAD-{K.FDHSI}-FD--CHK-"), part, F.lit("---NC4E_C_XXXX_"), stamp,
        F.lit("_IDPFI_OPE_"), stamp, F.lit("_"), stamp, F.lit("_N__O_"), F.lpad(cycle.cast("string"), 4, "0"),
        F.lit("_"), F.lpad(F.col("number").cast("string"), 4, "0"), F.lit(".nc"),
    )
    content = F.to_json(F.struct("number", "n", "top"))
    return grouped.select(path.alias("path"), F.encode(content, "UTF-8").alias("content"), "number")


def decode_scene_file(name, content, wanted):
    """A codec for the files above: one line per chunk and channel, and its root tables."""
    import json

    found = json.loads(content)
    number = found["number"]
    yield "time_rows", {"row_no": [0], "idx": [number], "time_s": [10.0 * number]}
    yield "platform_rows", {"row_no": [0], "idx": [number], "subsatellite_latitude": [float(number)]}
    if number > K.BODY_CHUNKS:
        return
    for grid, channel in (("1km", "vis_04"), ("2km", "ir_38")):
        ends = K.CHUNK_ROW_ENDS[(K.FDHSI, grid)]
        start, stop = (ends[number - 2] if number > 1 else 0), ends[number - 1]
        span = {"chunk_no": [number], "nc_channel": [channel], "row_start": [start], "row_stop": [stop]}
        yield "chunk_rows", span
        yield "calib_rows", {"nc_channel": [channel], "slope": [2.0], "offset": [0.5]}
        low, high = wanted.get(channel, (0, 0))
        if low <= stop - 1 < high:
            line = {"counts": [[found["n"], found["top"]]], "quality": [[0, 0]], "index_map": [[number, number]]}
            yield "scan_in", {"nc_channel": [channel], "y": [stop - 1], **line}


def streamed(spark, sf, config: CubeConfig) -> str:
    """The files above through a stream of several batches into a cube; returns its path."""
    folder, path = scratch_path(spark, "files"), scratch_path(spark, "cube")
    files = scene_files(spark, sf)
    files.repartitionByRange(2, "number").drop("number").write.parquet(folder)
    stream = streaming.file_stream(spark, folder, "path string, content binary", maxFilesPerTrigger="1")
    checkpoint = scratch_path(spark, "checkpoint")
    streaming.ingest_stream(stream, config, path, decode_scene_file, checkpoint).awaitTermination()
    return path


def streamed_sql(grids: str) -> str:
    return f"""WITH {t.BODY_SQL}, file AS (
        SELECT user_id, CAST(event_id % 41 + 1 AS INTEGER) AS number, count(*) AS n, max(event_id) % 60000 AS top
        FROM events GROUP BY ALL),
      meta AS (SELECT user_id, avg(number) AS latitude FROM file GROUP BY user_id)
      SELECT user_id AS slot, channel, row_stop - 1 AS y, n, top, number * 10.0::DOUBLE AS pixel_time,
        2.0::DOUBLE * top + 0.5 AS radiance, round(latitude, 6) AS latitude
      FROM file JOIN body ON chunk_no = number AND product_type = 'FDHSI'
      JOIN (VALUES {grids}) g(resolution, channel, low) USING (resolution)
      JOIN meta USING (user_id) WHERE row_stop - 1 >= low"""


def streamed_lines(spark, path: str, flat_grid: str | None = None):
    """What the stream stored: lines with their time, radiance and the platform of their slot."""
    lines = read_cube(spark, path)
    if flat_grid:
        lines = lines.withColumns({"product_type": F.lit(K.FDHSI), "resolution": F.lit(flat_grid)})
    keys = ["product_type", "resolution", "slot"]
    meta = spark.read.parquet(f"{path}/slot_meta").select(*keys, "subsatellite_latitude")
    found = attach_slot_calibration(lines, path).join(meta, keys)
    return found.select(
        F.col("slot").cast("bigint").alias("slot"),
        "channel",
        "y",
        F.col("counts")[0].cast("bigint").alias("n"),
        F.col("counts")[1].cast("bigint").alias("top"),
        F.col("pixel_time")[0].alias("pixel_time"),
        (F.col("slope") * F.col("counts")[1] + F.col("offset")).alias("radiance"),
        F.round("subsatellite_latitude", 6).alias("latitude"),
    )


@query("stream_files", streamed_sql("('1km', 'vis_04', 8352), ('2km', 'ir_38', 2784)"))
def stream_files(spark, sf):
    """Files of a stripe in several batches: scanlines, times, calibration and slot tables of a cube."""
    config = CubeConfig(
        K.FDHSI, channels="vis_04,ir_38", include_geolocation=False, time_epoch=t.EPOCH, tile_rows=TALL,
        body_chunks=(32, 40),
    )
    return streamed_lines(spark, streamed(spark, sf, config))


@query("stream_files_flat", streamed_sql("('2km', 'ir_38', 0)"))
def stream_files_flat(spark, sf):
    """The same files into a flat cube of one grid."""
    config = CubeConfig(
        K.FDHSI, resolutions="2km", channels="ir_38", include_geolocation=False, time_epoch=t.EPOCH,
        tile_rows=TALL, flat=True,
    )
    return streamed_lines(spark, streamed(spark, sf, config), "2km")
