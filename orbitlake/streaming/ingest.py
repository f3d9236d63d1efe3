"""Continuous ingest: one new scene every ten minutes, in any order, possibly late or twice."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from orbitlake.constants import BODY_CHUNKS, CYCLE_SECONDS, DEFAULT_EPOCH
from orbitlake.functions import names, slots
from orbitlake.ingest import chunk_contents, decode_files, ingest_decoded
from orbitlake.operators.scenes import (
    bundle_scenes,
    classify_items,
    foreign_items,
    parse_chunks,
    rejected_chunks,
    zip_scenes,
)
from orbitlake.plans import catalog
from orbitlake.plans.config import CubeConfig
from orbitlake.session import drop_path, scratch_path, staged
from orbitlake.sources.archives import unpack_archives
from orbitlake.sources.chunks import TABLES, TAGGED_SCHEMA, Decoded, Decoder, table_rows, write_decoded
from orbitlake.sources.cube import TASKS_PER_CORE, check_identity, merge_into, open_table, with_tiles

#: Mean bytes of a file below which the files of a batch are small.
SMALL_FILE = 1 << 20
SHOWN_FILES = 4


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None, **options
) -> DataFrame:
    """New Parquet files below a path as a stream."""
    reader = spark.readStream.format("parquet").schema(schema).options(**options)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def input_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """New chunk files and ZIPs below a path as a stream of (path, content)."""
    fields = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(fields)
    return reader.options(recursiveFileLookup="true", **options).load(path).select("path", "content")


def slot_windows(stream: DataFrame, ts: str, delay: str = "30 minutes") -> DataFrame:
    """Tumbling 10-minute windows under a watermark, aligned to midnight like the slots.

    Event time must be a TIMESTAMP, so naive timestamps are cast (the session runs in UTC).
    """
    timed = stream.withColumn("event_time", F.col(ts).cast("timestamp"))
    return timed.withWatermark("event_time", delay).withColumn(
        "cycle", F.window("event_time", "10 minutes")
    )


def window_counts(stream: DataFrame, ts: str, *keys: str, delay: str = "30 minutes") -> DataFrame:
    """Rows per 10-minute window and key, emitted when the watermark passes the window."""
    return slot_windows(stream, ts, delay).groupBy("cycle", *keys).agg(F.count("*").alias("n_rows"))


def scene_completeness(chunks: DataFrame, delay: str = "30 minutes", *keys: str) -> DataFrame:
    """Chunk numbers present per scene window against the 40 of a full disk.

    ``chunks`` has ``sensing_start`` and ``chunk_no``. The set has at most 40 members, because only
    BODY numbers count.
    """
    body = chunks.filter(F.col("chunk_no").between(1, BODY_CHUNKS))
    windows = slot_windows(body, "sensing_start", delay)
    present = windows.groupBy("cycle", *keys).agg(F.collect_set("chunk_no").alias("present"))
    return present.select(
        "cycle",
        *keys,
        F.size("present").alias("n_chunks"),
        (F.size("present") == BODY_CHUNKS).alias("complete"),
    )


ARRIVAL = "cycle timestamp, n_chunks int, complete boolean"


def scene_arrivals(chunks: DataFrame, delay: str = "30 minutes", needed: int = BODY_CHUNKS) -> DataFrame:
    """(cycle, n_chunks, complete) of each scene as soon as its last chunk is there.

    ``chunks`` has ``sensing_start`` and ``chunk_no``; a scene's state is one number with a bit for
    each of its ``needed`` chunks, at most 63. A scene that is not complete when the watermark
    passes its end is emitted then, with the chunks it has. What comes for a complete scene again
    is taken up by its state, which goes when the watermark passes too.
    """
    full = (1 << needed) - 1
    length = CYCLE_SECONDS * 1000

    def arrive(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bits = int(state.get[0]) if state.exists else 0
        was, begin = bits, int(key[0])

        def emit() -> pd.DataFrame:
            row = (pd.Timestamp(begin, unit="ms"), bits.bit_count(), bits == full)
            return pd.DataFrame([row], columns=["cycle", "n_chunks", "complete"])

        if state.hasTimedOut:
            state.remove()
            if bits != full:
                yield emit()
            return
        for batch in batches:
            for number in batch["chunk_no"]:
                bits |= 1 << (int(number) - 1)
        if bits == full and was != full:
            yield emit()
        end = begin + length
        if end > state.getCurrentWatermarkMs():
            state.update((bits,))
            state.setTimeoutTimestamp(end)
            return
        if state.exists:
            state.remove()
        if bits != full:
            yield emit()

    body = chunks.filter(F.col("chunk_no").between(1, needed))
    timed = body.withColumn("event_time", F.col("sensing_start").cast("timestamp"))
    timed = timed.withWatermark("event_time", delay)
    start = F.unix_millis("event_time")
    keyed = timed.select((start - F.pmod(start, F.lit(length))).alias("cycle"), "event_time", "chunk_no")
    return keyed.groupBy("cycle").applyInPandasWithState(
        arrive, ARRIVAL, "bits bigint", "append", GroupStateTimeout.EventTimeTimeout
    )


def chunk_stream(files: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Parsed chunk names of a file stream; a path listed again within the delay counts once.

    A stream goes on past names it cannot read: ``rejected_stream`` lists them with their errors.
    """
    chunks = parse_chunks(classify_items(files), strict=False).withColumn(
        "event_time", F.col("sensing_start").cast("timestamp")
    )
    return chunks.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["path"])


def rejected_stream(files: DataFrame) -> DataFrame:
    """Files of the stream that ``chunk_stream`` leaves out, with the error of each."""
    return rejected_chunks(classify_items(files))


def with_slot(stream: DataFrame, ts: str, epoch: str = DEFAULT_EPOCH) -> DataFrame:
    return stream.withColumn("slot", slots.slot_index(F.col(ts), epoch))


def merge_stream(
    scanlines: DataFrame,
    path: str,
    checkpoint: str,
    table: str = "scanlines",
    available_now: bool = True,
    config: CubeConfig | None = None,
) -> StreamingQuery:
    """Merge every micro-batch into the cube, keyed by slot, channel and row.

    A batch that is replayed after a failure rewrites the same rows, so the result does not change;
    late rows fill their lines and leave the others alone. With ``config`` the cube's identity is
    recorded, or checked, before the stream starts, rows get their tiles, and rows of a grid that
    the cube does not store fail the stream.
    """
    if config is None:

        def merge(batch: DataFrame, _batch_id: int) -> None:
            merge_into(batch.sparkSession, batch, path, table)

    else:
        check_identity(scanlines.sparkSession, path, config)
        grids = catalog.config_resolutions(config)
        own = (F.col("product_type") == config.product_type) & F.col("resolution").isin(grids)
        text = F.concat(F.lit("rows of a grid the cube does not store: "), "product_type", F.lit(" "), "resolution")

        def merge(batch: DataFrame, _batch_id: int) -> None:
            rows = catalog.fail_where(batch, F.when(~own, text))
            merge_into(batch.sparkSession, with_tiles(rows, config), path, table, flat=config.flat)

    return _start(scanlines, merge, checkpoint, available_now)


def _start(stream: DataFrame, batch: Callable, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def seen_batches(log: DataFrame, stream: str) -> DataFrame:
    """Numbers of the batches of a stream that the ingest log lists."""
    own = log.where(F.get_json_object("metrics", "$.stream") == stream)
    return own.select(F.get_json_object("metrics", "$.batch").cast("bigint").alias("batch"))


def latest_parts(decoded: DataFrame) -> DataFrame:
    """The latest batch that brought each part; every file of a batch is listed in its ``members``."""
    listed = decoded.where(F.col("table") == "members")
    return listed.groupBy("scene_id", "part_order").agg(F.max("batch").alias("batch"))


def latest_copies(decoded: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of the latest batch that brought a part; a file that comes again replaces its rows."""
    return decoded.join(parts, ["scene_id", "part_order", "batch"], "left_semi")


def many_small_files(files: DataFrame) -> bool:
    """Whether files (path, content) are more than the tasks that could read them, and small.

    A split of a table holds many small files, all of which a single task would parse and decode. The
    first few are looked at: this only says how files are dealt, and large ones are not read for it.
    """
    if files.count() <= _tasks(files):
        return False
    sizes = [r[0] or 0 for r in files.select(F.length("content")).limit(SHOWN_FILES).collect()]
    return sum(sizes) < len(sizes) * SMALL_FILE


def _tasks(files: DataFrame) -> int:
    return TASKS_PER_CORE * files.sparkSession.sparkContext.defaultParallelism


def ingest_stream(
    files: DataFrame,
    config: CubeConfig,
    path: str,
    decoder: Decoder,
    checkpoint: str,
    available_now: bool = True,
    keep: int | None = None,
    grid: str | None = None,
) -> StreamingQuery:
    """Ingest a stream of chunk files and ZIPs (path, content) into a whole cube.

    Each batch is parsed and decoded once; its decoded tables are kept beside the checkpoint, so
    that a scene is always built from all the files it has had: scanlines, per-slot values,
    calibration, static tables, identity and log are those of a single ingest of these files. Only
    scenes with new files are built again, and only their tiles are written. ``keep`` is the number
    of batches whose decoded tables stay: files that come later complete a scene by their own rows;
    ``grid`` is that of ``ingest_decoded``.

    A batch is logged with its number when it is done, and passed over when it comes again; one that
    stopped halfway is decoded and written anew, over what it had left. Names that cannot be read,
    and products of another type, are listed in ``rejected`` and do not stop the stream.
    """
    check_identity(files.sparkSession, path, config)
    state = f"{checkpoint}-decoded"

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        log = open_table(spark, path, "ingest_log")
        if log is not None and not seen_batches(log, checkpoint).where(F.col("batch") == number).isEmpty():
            return
        # Small files are dealt to all cores; large ones stay where their splits are.
        dealt, copied = many_small_files(rows), scratch_path(spark, "files")
        if dealt:
            rows.repartition(_tasks(rows), "path").write.parquet(copied)
            rows = spark.read.schema(rows.schema).parquet(copied)
        items = classify_items(rows.withColumn("length", F.length("content")))
        rejected = rejected_chunks(items.drop("content")).unionByName(
            foreign_items(items.drop("content"), config.product_type).select(
                "path", "name", F.lit("not a product of the cube").alias("error")
            )
        )
        rejected.write.mode("overwrite").parquet(f"{path}/rejected/batch={number}")
        own = items.where(names.detect_product(F.col("path")) == config.product_type)
        # One path for each name: a file that is listed twice in a batch is read once.
        listed = own.drop("content").groupBy(names.item_name(F.col("path"))).agg(F.min("path").alias("path"))
        own = own.join(listed.select("path"), "path", "left_semi")
        packed = unpack_archives(own.where(F.col("kind") == "zip").select("path", "content"))
        contents = chunk_contents(own, strict=False).unionByName(
            packed.select(F.col("archive").alias("scene_id"), "name", "content", "error")
        )
        part = f"{state}/batch={number}"
        drop_path(spark, part)
        if dealt:
            contents = contents.repartition(_tasks(contents), "name")
        decode_files(contents, config, decoder, part)
        found = zip_scenes(own.drop("content")).unionByName(
            bundle_scenes(parse_chunks(own.drop("content"), strict=False), strict=False)
        )
        found = staged(found.select("scene_id", "product_type", "coordinate"), "scenes")
        drop_path(spark, copied)
        if found.isEmpty():
            return
        decoded = spark.read.schema(f"{TAGGED_SCHEMA}, batch bigint").parquet(state)
        own = decoded.join(found.select("scene_id"), "scene_id", "left_semi")
        decoded = latest_copies(decoded, staged(latest_parts(own), "latest"))
        # Small tables are read many times, so their copies are chosen once; scanlines stay where they are.
        plain = write_decoded(decoded.where(F.col("table") != "scan_in").drop("batch"))
        stored = spark.read.schema(TAGGED_SCHEMA).parquet(plain)
        tables = Decoded(**{t: table_rows(decoded if t == "scan_in" else stored, t) for t in TABLES})
        origin = {"stream": checkpoint, "batch": number}
        ingest_decoded(spark, found, tables, config, path, existing="force", origin=origin, grid=grid)
        drop_path(spark, plain)
        if keep is not None:
            drop_path(spark, f"{state}/batch={number - keep}")

    return _start(files, batch, checkpoint, available_now)


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished windows to a Parquet table."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
