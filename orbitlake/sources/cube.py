"""The cube: Parquet tables below one path, merged row by row and tile by tile.

``scanlines`` is partitioned by product, resolution and slot (a flat cube: by slot only), and below
that by output tile where rows carry one. A write replaces whole partitions, and only those it
touches: a late chunk swaps the tiles that it meets.

In a cube of many small slots a folder and a file for each would cost more than their rows. If the
first write finds such slots, those of a week share a folder (``slots=``) and ``slot`` is a column of
the files; readers and writers of this module treat both layouts alike.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Sequence
from contextlib import AbstractContextManager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlake import constants as K
from orbitlake.constants import CYCLE_SECONDS, CYCLES_PER_DAY
from orbitlake.functions.geolocation import lookup
from orbitlake.plans import catalog
from orbitlake.plans.config import ConfigurationError, CubeConfig
from orbitlake.session import drop_path, literal_table, scratch_path, setting

PARTITIONS = ("product_type", "resolution", "slot")
ROW_KEYS = ("product_type", "resolution", "slot", "channel", "y")
SLOT_KEYS = ("product_type", "resolution", "slot")
DAY_PARTITIONS = ("product_type", "resolution", "day")
#: Bytes of rows that are worth a task of their own when a cube is written.
SMALLEST_TASK = "4k"
TASKS_PER_CORE = 4
#: Slots that share a folder in a cube of many small slots: a week of them.
BLOCK_SLOTS = 7 * CYCLES_PER_DAY
#: Partitions of a first write that are many, and bytes of a mean one that are few.
MANY_PARTITIONS = 1000
SMALL_PARTITION = 256 << 10


def small_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """Let the tasks of a write be small, which costs by its files and not by its bytes."""
    return setting(spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", SMALLEST_TASK)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table; a task lists many of its folders, which are as many as there are slots."""
    tasks = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    with setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks):
        return spark.read.parquet(path)


def open_table(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """A table of the cube, or None when it has not been written yet."""
    stored = _open_stored(spark, path, table)
    return None if stored is None else _without_blocks(stored)


def _open_stored(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """A table with the columns of its folders."""
    try:
        return _listed(spark, f"{path}/{table}")
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


# --- slots that share folders -----------------------------------------------


def slot_block(slot: Column) -> Column:
    """Number of the folder of a slot where slots share folders."""
    return F.floor(slot / BLOCK_SLOTS).cast("int")


def in_blocks(spark: SparkSession, path: str, table: str = "scanlines") -> bool | None:
    """Whether the slots of a table share folders; None for a table without any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{table}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    while folder is not None and files.exists(folder):
        # The first folder of each level tells; those of slots may be many.
        inside, folder = files.listStatusIterator(folder), None
        while folder is None and inside.hasNext():
            found = inside.next()
            key, is_key, _value = found.getPath().getName().partition("=")
            if found.isDirectory() and is_key:
                if key in ("slot", "slots"):
                    return key == "slots"
                folder = found.getPath()
    return None


def _without_blocks(stored: DataFrame) -> DataFrame:
    """A table with the same columns, in the same order, whether or not its slots share folders."""
    if "slots" not in stored.columns:
        return stored
    levels = [c for c in (*PARTITIONS, "tile") if c in stored.columns]
    return stored.select(*[c for c in stored.columns if c not in (*levels, "slots")], *levels)


def _in_slots(stored: DataFrame, slots: tuple[int, int]) -> DataFrame:
    """Stored rows of a half-open range of slots; others are not read, or not those of other folders."""
    if "slots" in stored.columns:
        first, last = (slot // BLOCK_SLOTS for slot in (slots[0], slots[1] - 1))
        stored = stored.filter((F.col("slots") >= first) & (F.col("slots") <= last))
    return stored.filter((F.col("slot") >= slots[0]) & (F.col("slot") < slots[1]))


def _row_bytes(rows: DataFrame) -> tuple[int, Column | None]:
    """Bytes of a row's plain values, and those of its arrays and texts, if it has any."""
    plain, wide = 0, []
    for field in rows.schema:
        if isinstance(field.dataType, T.ArrayType):
            each = {"smallint": 2, "int": 4, "float": 4}.get(field.dataType.elementType.simpleString(), 8)
            wide.append(F.when(F.col(field.name).isNull(), 0).otherwise(F.size(field.name) * each))
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)) and field.name not in PARTITIONS:
            wide.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
        else:
            plain += 8
    return plain, (reduce(Column.__add__, [w.cast("bigint") for w in wide]) if wide else None)


def _many_small(rows: DataFrame, partitions: Sequence[str]) -> bool:
    """Whether rows go to many partitions of few bytes; arrays are read only if these are many."""
    sizes = rows.groupBy(*partitions).agg(F.count("*").alias("n"))
    n_partitions, n_rows = sizes.agg(F.count("*"), F.sum("n")).first()
    if n_partitions <= MANY_PARTITIONS:
        return False
    plain, wide = _row_bytes(rows)
    size = plain * n_rows
    if wide is not None and size < n_partitions * SMALL_PARTITION:
        size += rows.agg(F.sum(wide)).first()[0]
    return size < n_partitions * SMALL_PARTITION


def _null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _sharing_folders(stored: DataFrame, incoming: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Stored rows of the shared folders that ``incoming`` goes to; those of others are not read.

    Folders are few, as many slots share one, so the driver holds their numbers.
    """
    levels = ["slots" if c == "slot" else c for c in partitions]
    folders = incoming.withColumn("slots", slot_block(F.col("slot"))).select(*levels).distinct().collect()
    numbers = {f.slots for f in folders}
    own = F.col("slots").isin(sorted(n for n in numbers if n is not None))
    own = own | F.col("slots").isNull() if None in numbers else own
    schema = T.StructType([f for c in levels for f in stored.schema if f.name == c]).simpleString()
    known = literal_table(stored.sparkSession, [tuple(f) for f in folders], schema[7:-1].replace(":", " "))
    same = _null_safe("s", "f", levels)
    return stored.where(own).alias("s").join(F.broadcast(known).alias("f"), same, "left_semi")


# --- identity ---------------------------------------------------------------


def identity(config: CubeConfig) -> dict:
    """What every write into one cube must agree on: the axis, the layout, the grid, the window, the longitude."""
    grids = catalog.config_resolutions(config)
    return {
        "epoch": config.time_epoch,
        "cadence_s": CYCLE_SECONDS,
        "layout": "flat" if config.flat else "grouped",
        "grid": "_".join([config.product_type, *grids]) if config.flat else None,
        "stripe": None if config.body_chunks is None else "chunks {} to {}".format(*config.body_chunks),
        "tiles": {grid: config.tile_height(grid) for grid in K.TILE_ROWS},
        "lon0": float(config.lon0),
    }


def check_identity(spark: SparkSession, path: str, config: CubeConfig) -> None:
    """Refuse a cube written with another identity; the first write records it."""
    wanted = identity(config)
    stored = open_table(spark, path, "identity")
    if stored is None:
        row = [(json.dumps(wanted),)]
        literal_table(spark, row, "identity string").coalesce(1).write.parquet(f"{path}/identity")
        return
    found = json.loads(stored.first().identity)
    differing = sorted(k for k in wanted if wanted[k] != found.get(k))
    if differing:
        raise ConfigurationError(
            "the cube has another identity: "
            + ", ".join(f"{k} is {found.get(k)!r}, not {wanted[k]!r}" for k in differing)
        )


IDENTITY_FIELDS = ("epoch", "cadence_s", "layout", "grid", "stripe")


def stripe_text(first: Column, last: Column) -> Column:
    """How the identity names the chunks of a row window."""
    return F.format_string("chunks %d to %d", first, last)


def identity_conflicts(
    wanted: DataFrame, stored: DataFrame, key: str, fields: Sequence[str] = IDENTITY_FIELDS
) -> DataFrame:
    """Cubes whose stored identity differs from the wanted one, with the differing fields."""
    names = F.array_compact(
        F.array(*(F.when(~F.col(f"w.{f}").eqNullSafe(F.col(f"s.{f}")), f) for f in fields))
    )
    joined = wanted.alias("w").join(stored.alias("s"), F.col(f"w.{key}") == F.col(f"s.{key}"))
    differing = joined.select(F.col(f"w.{key}").alias(key), names.alias("differing"))
    return differing.filter(F.size("differing") > 0)


# --- writing ----------------------------------------------------------------


def with_tiles(rows: DataFrame, config: CubeConfig) -> DataFrame:
    """Add the output tile of each row, the last partition level of ``scanlines``."""
    heights = {grid: config.tile_height(grid) for grid in K.TILE_ROWS}
    return rows.withColumn("tile", F.floor(F.col("y") / lookup(F.col("resolution"), heights)).cast("int"))


def partitions_of(rows: DataFrame, flat: bool = False) -> list[str]:
    """Partition columns of a table of scanlines."""
    base = ["slot"] if flat else list(PARTITIONS)
    return [*base, "tile"] if "tile" in rows.columns else base


def write_cube(df: DataFrame, path: str, flat: bool = False, table: str = "scanlines") -> None:
    """Replace the partitions present in ``df``; all others stay as they are.

    Rows are rebalanced by partition, so a large slot is split over several tasks and files of a
    useful size come out, and sorted by channel and row, so that row windows are pruned by the
    statistics of the file. A write of many small slots costs by its files, not by its bytes, so its
    tasks may be small: all cores write. Where slots share folders, the others of a folder stay.
    """
    spark, partitions = df.sparkSession, partitions_of(df, flat)
    blocks = in_blocks(spark, path, table)
    if blocks is None:
        blocks = _many_small(df, partitions)
    elif blocks:
        scratch = scratch_path(spark, "incoming")
        df.write.parquet(scratch)
        incoming = spark.read.schema(df.schema).parquet(scratch)
        replaced = incoming.select(*partitions).distinct()
        current = _sharing_folders(_open_stored(spark, path, table), incoming, partitions)
        stay = current.alias("c").join(replaced.alias("r"), _null_safe("c", "r", partitions), "left_anti")
        rows = incoming.drop("product_type", "resolution") if flat else incoming
        rows = _without_blocks(stay).unionByName(rows, allowMissingColumns=True)
        _write_partitions(rows, path, flat, table, True)
        drop_path(spark, scratch)
        return
    _write_partitions(df, path, flat, table, blocks)


def _write_partitions(df: DataFrame, path: str, flat: bool, table: str, blocks: bool) -> None:
    partitions = partitions_of(df, flat)
    order = [c for c in ("channel", "y") if c in df.columns]
    rows = df.drop("product_type", "resolution") if flat else df
    if blocks:
        partitions = ["slots" if c == "slot" else c for c in partitions]
        order = ["slot", *order]
        rows = rows.withColumns({"slots": slot_block(F.col("slot")), "slot": F.col("slot").cast("bigint")})
    with small_tasks(df.sparkSession):
        (
            rows.hint("rebalance", *partitions)
            .sortWithinPartitions(*partitions, *order)
            .write.partitionBy(*partitions)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(f"{path}/{table}")
        )


def slot_day(slot: Column) -> Column:
    """Day of the axis a slot lies in; the partition of the per-slot tables."""
    return F.floor(slot / CYCLES_PER_DAY).cast("int")


def write_days(df: DataFrame, path: str, table: str) -> None:
    """Replace the day partitions present in ``df``; all cores write many small days."""
    with small_tasks(df.sparkSession):
        (
            df.hint("rebalance", *DAY_PARTITIONS)
            .write.partitionBy(*DAY_PARTITIONS)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(f"{path}/{table}")
        )


def merge_rows(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = ROW_KEYS, null_safe: bool = False
) -> DataFrame:
    """Existing rows that ``incoming`` does not cover, and all of ``incoming``.

    Rows without a key cover each other only where ``null_safe`` says so.
    """
    covered = incoming.select(*keys).distinct()
    if null_safe:
        left = existing.alias("e").join(covered.alias("c"), _null_safe("e", "c", keys), "left_anti")
    else:
        left = existing.join(covered, list(keys), "left_anti")
    return left.unionByName(incoming, allowMissingColumns=True)


def touched(existing: DataFrame, partitions: DataFrame) -> DataFrame:
    """Existing rows of the given partitions; their keys prune, so no others are read."""
    return existing.join(partitions, partitions.columns, "left_semi")


def merge_into(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    table: str = "scanlines",
    keys: Sequence[str] = ROW_KEYS,
    keep_existing: bool = False,
    flat: bool = False,
) -> None:
    """Merge rows into a table: each touched partition is rebuilt beside it, then swapped in.

    ``keep_existing`` lets rows already stored win over incoming ones. The incoming rows are written
    once to the shared folder, because their keys and their values are both needed, and deleted at
    the end. Old files are read until the new ones are committed, so what is merged is written once.
    Where slots share folders, a folder is rebuilt with all of its slots, and rows without a key are
    compared like any others.
    """
    scratch = scratch_path(spark, "incoming")
    incoming.write.parquet(scratch)
    incoming = spark.read.schema(incoming.schema).parquet(scratch)
    existing = _open_with_keys(spark, path, table, incoming if flat else None)
    if existing is not None:
        partitions = [*SLOT_KEYS, "tile"] if "tile" in incoming.columns else list(SLOT_KEYS)
        if ("tile" in incoming.columns) != ("tile" in existing.columns):
            raise ConfigurationError("rows and cube must both have tiles, or neither")
        blocks = "slots" in existing.columns
        if blocks:
            current = _without_blocks(_sharing_folders(existing, incoming, partitions))
        else:
            current = touched(existing, incoming.select(*partitions).distinct())
        old, new = (incoming, current) if keep_existing else (current, incoming)
        merged = merge_rows(old, new, keys, null_safe=blocks)
        # The other slots of a folder keep columns that the incoming rows do not have.
        incoming = merged if blocks else merged.select(*incoming.columns)
        _write_partitions(incoming, path, flat, table, blocks)
    else:
        write_cube(incoming, path, flat, table)
    drop_path(spark, scratch)


def _open_with_keys(
    spark: SparkSession, path: str, table: str, flat_like: DataFrame | None
) -> DataFrame | None:
    existing = _open_stored(spark, path, table)
    if existing is None or flat_like is None:
        return existing
    # A flat cube holds one product and resolution, which its rows do not repeat.
    grid = flat_like.select("product_type", "resolution").first()
    if grid is None:
        return existing.withColumns({c: F.lit("") for c in ("product_type", "resolution")}).limit(0)
    return existing.withColumns(
        {"product_type": F.lit(grid.product_type), "resolution": F.lit(grid.resolution)}
    )


def present_groups(
    spark: SparkSession, path: str, config: CubeConfig, slots: tuple[int, int] | None = None
) -> DataFrame | None:
    """Groups of which the cube holds any row: product, resolution and slot; None for a new cube.

    ``slots`` is the half-open range the caller asks about: others are not looked at. Rows count, not the per-slot tables: streams and stopped runs leave rows without those. The
    keys are partition columns, so no row is read; of small slots that share folders, one column is.
    """
    stored = _open_stored(spark, path, "scanlines")
    if stored is None:
        return None
    if slots is not None:
        stored = _in_slots(stored, slots)
    if config.flat:
        grid = catalog.config_resolutions(config)[0]
        stored = stored.withColumns(
            {"product_type": F.lit(config.product_type), "resolution": F.lit(grid)}
        )
    return stored.select(*SLOT_KEYS).distinct()


def write_groups(df: DataFrame, path: str, table: str, keys: Sequence[str]) -> None:
    """Add the groups of a static table that it does not hold yet; stored groups stay."""
    stored = open_table(df.sparkSession, path, table)
    if stored is not None:
        df = df.join(stored.select(*keys).distinct(), list(keys), "left_anti")
    df.write.mode("append").parquet(f"{path}/{table}")


def stored_resolutions(spark: SparkSession, path: str, table: str, product_type: str) -> set[str]:
    """Resolutions of a product that a static table holds; at most as many as there are grids."""
    stored = open_table(spark, path, table)
    if stored is None:
        return set()
    own = stored.where(F.col("product_type") == product_type)
    return {r.resolution for r in own.select("resolution").distinct().collect()}


def write_once(df: DataFrame, path: str, table: str) -> None:
    """Write a static table unless it is there already."""
    df.write.mode("ignore").parquet(f"{path}/{table}")


# --- reading ----------------------------------------------------------------


def read_cube(
    spark: SparkSession,
    path: str,
    product_type: str | None = None,
    resolutions: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    slots: tuple[int, int] | None = None,
    rows: tuple[int, int] | None = None,
    table: str = "scanlines",
) -> DataFrame:
    """Open a table of the cube by name and range.

    Product, resolution, slot and, through the tiles a row range meets, rows prune partitions;
    channel and row prune row groups; unused arrays are pruned by the projection.
    """
    df = _listed(spark, f"{path}/{table}")
    if product_type is not None:
        df = df.filter(F.col("product_type") == product_type)
    if resolutions is not None:
        df = df.filter(F.col("resolution").isin(list(resolutions)))
    if channels is not None:
        df = df.filter(F.col("channel").isin(list(channels)))
    if slots is not None:
        df = _in_slots(df, slots)
    df = _without_blocks(df)
    if rows is not None:
        df = df.filter((F.col("y") >= rows[0]) & (F.col("y") < rows[1]))
    stored = open_table(spark, path, "identity") if rows is not None and "tile" in df.columns else None
    if stored is not None:
        known = json.loads(stored.first().identity)
        grid = F.col("resolution") if known["grid"] is None else F.lit(known["grid"].split("_")[1])
        first, last = ({g: row // h for g, h in known["tiles"].items()} for row in (rows[0], rows[1] - 1))
        df = df.filter((F.col("tile") >= lookup(grid, first)) & (F.col("tile") <= lookup(grid, last)))
    return df


def select_time(spark: SparkSession, path: str, df: DataFrame, when: str) -> DataFrame:
    """Rows of the slot with the given time label."""
    label = F.lit(datetime.datetime.fromisoformat(when)).cast("timestamp_ntz")
    slot = spark.read.parquet(f"{path}/slot_meta").filter(F.col("time") == label)
    return df.join(slot.select(*SLOT_KEYS), list(SLOT_KEYS), "left_semi")


# --- resume -----------------------------------------------------------------


def _shared_keys(scenes: DataFrame, present: DataFrame) -> list[str]:
    return [k for k in SLOT_KEYS if k in scenes.columns and k in present.columns]


def already_ingested(scenes: DataFrame, present: DataFrame) -> DataFrame:
    """Scenes or groups that the cube already holds, by the slot keys both sides have."""
    keys = _shared_keys(scenes, present)
    return scenes.join(present.select(*keys).distinct(), keys, "left_semi")


def not_ingested(scenes: DataFrame, present: DataFrame) -> DataFrame:
    """Scenes or groups that the cube does not hold yet, by the slot keys both sides have."""
    keys = _shared_keys(scenes, present)
    return scenes.join(present.select(*keys).distinct(), keys, "left_anti")


def refuse_existing(scenes: DataFrame, present: DataFrame) -> None:
    """Fail unless every scene goes to a new slot; names the first three (a bounded sample)."""
    clash = already_ingested(scenes, present).select("scene_id", "slot").distinct()
    clash = clash.orderBy("slot", "scene_id").limit(3).collect()
    if clash:
        shown = ", ".join(f"{row.scene_id} (slot {row.slot})" for row in clash)
        raise ConfigurationError(f"slots already ingested, use force or resume: {shown}")


def log_run(spark: SparkSession, path: str, config: CubeConfig, metrics: dict) -> None:
    """Append a run's signature, with its resolutions resolved, and its counters to the ingest log."""
    signature = {**config.signature(), "resolutions": sorted(catalog.config_resolutions(config))}
    row = [(json.dumps(signature, sort_keys=True), json.dumps(metrics, sort_keys=True))]
    schema = "signature string, metrics string"
    literal_table(spark, row, schema).withColumn("logged_at", F.current_timestamp()).coalesce(
        1
    ).write.mode("append").parquet(f"{path}/ingest_log")


def run_signature(log: DataFrame) -> DataFrame:
    """Options of each logged run, one column per option text."""
    return log.select(
        F.get_json_object("signature", "$.product_type").alias("product_type"),
        F.get_json_object("signature", "$.resolutions").alias("resolutions"),
        F.get_json_object("signature", "$.channels").alias("channels"),
        F.get_json_object("signature", "$.pixel_time_dtype").alias("pixel_time_dtype"),
        F.get_json_object("signature", "$.time_epoch").alias("time_epoch"),
        F.get_json_object("signature", "$.body_chunks").alias("body_chunks"),
        "metrics",
    )


def attach_slot_calibration(scan: DataFrame, path: str) -> DataFrame:
    """Join a cube's scanlines with its per-slot calibration."""
    table = scan.sparkSession.read.parquet(f"{path}/slot_channel").drop("channel_index", "day")
    return scan.join(table, ["product_type", "resolution", "slot", "channel"], "left")
