"""Ingest of whole or partial scenes into a cube."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlake.functions import names
from orbitlake.operators import coverage, rasters, scenes, slot_values
from orbitlake.plans import catalog
from orbitlake.plans.config import ConfigurationError, CubeConfig
from orbitlake.plans.variables import declared_attributes, select_variables
from orbitlake.session import configure, setting, staged
from orbitlake.sources import cube as store
from orbitlake.sources import grids, ledger
from orbitlake.sources.archives import Opener, list_members, open_ranged, read_members, unpack_archives
from orbitlake.sources.chunks import Decoded, Decoder, decode_chunks, read_decoded, write_decoded
from orbitlake.sources.files import list_inputs

EXISTING = ("error", "resume", "force")
WRITE_MODES = ("direct", "staged")
SHOWN = 3
# Whole files travel to the decoder, so a batch holds few of them.
FILES_PER_BATCH = "4"


def read_scenes(
    spark: SparkSession,
    source: str,
    config: CubeConfig,
    decoder: Decoder,
    filters: tuple[str, ...] = (),
    slots: tuple[int, int] | None = None,
    covered: DataFrame | None = None,
    only: DataFrame | None = None,
    opener: Opener | None = None,
) -> tuple[DataFrame, Decoded]:
    """List, check, group and decode an input folder, or a part of its items.

    Files outside the half-open range of slots are not decoded, those of other days not even opened.
    With ``covered``, the runs a cube lists, files all of whose rows are stored are not opened
    either, nor are such members of archives; ``only`` names the scenes to read. ``opener`` opens
    remote archives in tasks (``archives.open_ranged`` where Arrow knows the file system); without
    it they come through Spark as one row each, which ends at 2 GiB. Returns the scene table and the
    decoded tables, written once to the shared folder. Files of one scene that fail are reported in
    ``errors``.
    """
    configure(spark)
    days = "" if slots is None else scenes.day_glob(slots, config.time_epoch)

    def listed(**options: Any) -> DataFrame:
        items = scenes.classify_items(list_inputs(spark, source, filters, **options))
        return items if slots is None else scenes.items_in_slots(items, slots, config.time_epoch)

    items = listed()
    scenes.check_inputs(items, config.product_type)
    found = staged(scenes.discover(items), "scenes")
    if covered is not None or only is not None:
        left = staged(_left_to_read(found, config, covered, only), "left")
        found = found.join(left.select("scene_id").distinct(), "scene_id", "left_semi")
        # As many names as the listing has, which the driver holds for any scan of files.
        paths = [r["path"] for r in left.select("path").collect()]

        def named(kind: str) -> DataFrame:
            own = [p for p in paths if p.endswith(f".{kind}")]
            listing = list_inputs(spark, own, content=True) if own else listed(content=True).limit(0)
            return scenes.classify_items(listing)
    else:

        def named(kind: str) -> DataFrame:
            return listed(content=True, pattern=f"*{days}*.{kind}")

    # Archives that tasks can open are read member by member; others come through Spark as rows.
    archives = found.filter(F.col("kind") == "zip").select(F.col("scene_id").alias("path"))
    in_place = F.lit(True) if opener else F.col("path").startswith("file:")
    unpacked = []
    if not archives.filter(in_place).isEmpty():
        entries = list_members(archives.filter(in_place), opener or open_ranged)
        unpacked.append(read_members(_members_left(entries, found, config, covered), opener or open_ranged))
    # A scan reads every content before a filter on the path sees it, so none is made in vain.
    if not archives.filter(~in_place).isEmpty():
        unpacked.append(unpack_archives(named("zip").filter((F.col("kind") == "zip") & ~in_place)))
    # The scene of a chunk follows from its name, so its bytes are neither joined nor shuffled.
    files = chunk_contents(named("nc"))
    for members in unpacked:
        files = files.unionByName(
            members.select(F.col("archive").alias("scene_id"), "name", "content", "error")
        )
    return found, read_decoded(spark, decode_files(files, config, decoder))


def _members_left(
    entries: DataFrame, found: DataFrame, config: CubeConfig, covered: DataFrame | None
) -> DataFrame:
    """Members of archives that have to be read: chunks, without those whose rows are all stored."""
    chunks = entries.filter(names.is_chunk(F.col("name")) | F.col("error").isNotNull())
    if covered is None:
        return chunks
    placed = slot_values.with_slots(found, config.time_epoch, config.slot_count)
    scene = placed.select(F.col("scene_id").alias("archive"), "scene_id", "product_type", "slot")
    number = names.part_number(F.col("name"))
    files = chunks.join(scene, "archive").select(
        "scene_id",
        "product_type",
        "slot",
        F.when(number > 0, number).cast("int").alias("chunk_no"),
        F.col("entry").alias("path"),
    )
    # A member that is no numbered chunk, or an error, is read like an archive of unknown parts.
    left = ledger.files_left(files, covered, ledger.wanted_rows(found.sparkSession, config))
    keep = left.select(F.col("scene_id").alias("archive"), F.col("path").alias("entry")).distinct()
    same = (F.col("c.archive") == F.col("k.archive")) & F.col("c.entry").eqNullSafe(F.col("k.entry"))
    return chunks.alias("c").join(keep.alias("k"), same, "left_semi")


def _left_to_read(
    found: DataFrame, config: CubeConfig, covered: DataFrame | None, only: DataFrame | None
) -> DataFrame:
    """(scene_id, path) of the scenes' files that have to be opened."""
    if only is not None:
        found = found.join(only.select("scene_id").distinct(), "scene_id", "left_semi")
    placed = slot_values.with_slots(found, config.time_epoch, config.slot_count)
    files = placed.select("scene_id", "product_type", "slot", F.explode("members").alias("m")).select(
        "scene_id", "product_type", "slot", "m.chunk_no", "m.path"
    )
    if covered is not None:
        files = ledger.files_left(files, covered, ledger.wanted_rows(found.sparkSession, config))
    return files.select("scene_id", "path")


def chunk_contents(items: DataFrame, strict: bool = True) -> DataFrame:
    """Loose chunk files (path, kind, content) as files of scenes.

    The scene of a chunk follows from its name, so its bytes are neither joined nor shuffled.
    """
    return scenes.parse_chunks(items, strict).select(
        names.scene_uri(F.col("product_type"), F.col("coordinate")).alias("scene_id"),
        "name",
        "content",
        F.lit(None).cast("string").alias("error"),
    )


def decode_files(
    files: DataFrame, config: CubeConfig, decoder: Decoder, path: str | None = None
) -> str:
    """Decode files of scenes (scene_id, name, content, error) and write the decoded tables once."""
    wanted = {
        nc_channel: catalog.row_window(config, resolution)
        for resolution, members in catalog.config_channels(config).items()
        for _channel, nc_channel in members
    }
    chunks = files.filter(names.is_chunk(F.col("name")) | F.col("error").isNotNull())
    ordered = chunks.withColumn("part_order", scenes.part_order(F.col("name")))
    with setting(files.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", FILES_PER_BATCH):
        return write_decoded(decode_chunks(ordered, _failing_archives(decoder), wanted), path)


def _failing_archives(decoder: Decoder) -> Decoder:
    """Let the error row of an unreadable archive (no bytes) fail like an undecodable file."""

    def decode(name: str, content: bytes, wanted: Mapping[str, tuple[int, int]]):
        if content is None:
            raise ValueError("archive cannot be read")
        yield from decoder(name, content, wanted)

    return decode


def scene_problems(found: DataFrame, decoded: Decoded, parts: DataFrame, config: CubeConfig) -> DataFrame:
    """The foremost error of each scene that cannot be written.

    Coverage comes first: rows that overlap or are not those of their chunk, then parts that claim
    one number, then files that cannot be read, then scenes without any chunk.
    """
    overlap = F.concat("problem", F.lit(" part rows at "), F.col("row").cast("string"))
    causes = [coverage.overlap_guard(parts).select("scene_id", overlap.alias("error"))]
    if config.body_chunks is not None:
        checked = coverage.check_body_rows(parts).filter(F.col("error").isNotNull())
        causes.append(checked.select("scene_id", "error"))
    causes.append(scenes.equal_parts(decoded.members).select("scene_id", "error"))
    causes.append(decoded.errors.select("scene_id", "error"))
    unread = found.select("scene_id").join(
        decoded.chunk_rows.select("scene_id").distinct(), "scene_id", "left_anti"
    )
    causes.append(unread.withColumn("error", F.lit("no chunk could be read")))
    return first_cause(causes)


def first_cause(causes: list[DataFrame]) -> DataFrame:
    """One error per scene out of tables (scene_id, error) in order of precedence."""
    ranked = [
        cause.groupBy("scene_id").agg(F.min("error").alias("error")).withColumn("rank", F.lit(rank))
        for rank, cause in enumerate(causes)
    ]
    return reduce(DataFrame.unionByName, ranked).groupBy("scene_id").agg(
        F.min_by("error", "rank").alias("error")
    )


def check_coverage(parts: DataFrame, config: CubeConfig, write_mode: str) -> None:
    """Fail the run for partial scenes where they are refused; shows the first three."""
    refused = coverage.partial_problems(parts, write_mode == "staged", config.partial_chunk)
    shown = refused.orderBy("scene_id", "resolution").limit(SHOWN).collect()
    if shown:
        raise ConfigurationError("; ".join(f"{row.scene_id}: {row.error}" for row in shown))


def superseding_runs(found: DataFrame, parts: DataFrame) -> DataFrame:
    """Row runs of scenes that share a slot with another scene."""
    shared = found.groupBy("slot").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    runs = coverage.tile_runs(parts).join(
        found.join(shared, "slot", "left_semi").select("scene_id", "slot"), "scene_id"
    )
    return runs.select(
        "slot", "resolution", "tile", "start", "stop", F.col("scene_id").alias("later_scene")
    )


def drop_superseded(scan: DataFrame, runs: DataFrame) -> DataFrame:
    """Keep a row only if no later scene of its slot covers it too."""
    a, b = scan.alias("a"), runs.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("slot", "resolution", "tile")]
    covered = (
        (F.col("b.later_scene") > F.col("a.scene_id"))
        & (F.col("a.y") >= F.col("b.start"))
        & (F.col("a.y") < F.col("b.stop"))
    )
    return a.join(b, [*same, covered], "left_anti")


def build_scanlines(
    groups: DataFrame,
    decoded: Decoded,
    parts: DataFrame,
    plan: DataFrame,
    config: CubeConfig,
    channels: list[str],
) -> DataFrame:
    """Scanlines of the given groups with the variables the configuration asks for.

    Where several scenes of a run share a slot, the later one by name wins a row. Stored fill
    becomes NULL.
    """
    scan = rasters.mask_counts(rasters.assemble(decoded.scan_in, plan))
    scan = scan.join(groups.select("scene_id", "resolution", "slot"), ["scene_id", "resolution"])
    runs = superseding_runs(groups.select("scene_id", "slot").distinct(), parts)
    scan = drop_superseded(scan, runs)
    if config.include_pixel_time:
        times = rasters.time_map(decoded.time_rows)
        luts = rasters.time_lut(times, config.pixel_time_dtype)
        scan = rasters.attach_time_lut(scan, luts)
    return store.with_tiles(select_variables(scan, "scanlines", config, channels), config)


def with_stored(parts: DataFrame, found: DataFrame, covered: DataFrame, config: CubeConfig) -> DataFrame:
    """Parts of the input together with the rows that the cube lists for the slots of its scenes."""
    known = covered.join(found.select("scene_id", "product_type", "slot"), ["product_type", "slot"])
    known = coverage.attach_grid(known.where(F.col("resolution").isin(catalog.config_resolutions(config))), config)
    return parts.unionByName(known.select(*[c for c in parts.columns if c in known.columns]), allowMissingColumns=True)


def ingest_decoded(
    spark: SparkSession,
    found: DataFrame,
    decoded: Decoded,
    config: CubeConfig,
    path: str,
    write_mode: str = "direct",
    existing: str = "error",
    attributes: Mapping[str, Any] | None = None,
    origin: Mapping[str, Any] | None = None,
    grid: str | None = None,
) -> dict[str, Any]:
    """Write decoded scenes into the cube at ``path`` and return the run's counters.

    ``existing`` says what happens to slots the cube already has: ``error`` refuses them, ``force``
    replaces the rows the input covers, ``resume`` keeps stored rows and adds missing ones. Values
    per slot come from the latest ingest in either case. A ``staged`` write replaces whole slots, so
    it takes complete scenes only. Configuration and coverage errors are raised before any write; a
    scene that cannot be read is counted and left out. A resumed run must have the options its slots
    were written with. ``origin`` is logged with the run's counters; ``grid`` is a path of exported
    latitude/longitude grids, whose lines are not computed again.
    """
    if existing not in EXISTING or write_mode not in WRITE_MODES:
        raise ConfigurationError(f"existing is one of {EXISTING}, write_mode one of {WRITE_MODES}")
    configure(spark)
    store.check_identity(spark, path, config)
    plan = catalog.config_plan(spark, config)
    channels = [c for members in catalog.config_channels(config).values() for c, _nc in members]
    found = slot_values.with_slots(found, config.time_epoch, config.slot_count)
    # One row per file and resolution, which almost every step below reads.
    parts = staged(coverage.attach_grid(rasters.parts_of_group(decoded.chunk_rows, plan), config), "parts")

    # A scene with a file that cannot be read fails by itself; its gaps are no fault of the input.
    failed = decoded.errors.select("scene_id").distinct()
    sound = parts.join(failed, "scene_id", "left_anti")
    covered = ledger.covered_runs(spark, path) if existing == "resume" else None
    if covered is not None and write_mode == "direct":
        sound = with_stored(sound, found.join(failed, "scene_id", "left_anti"), covered, config)
    check_coverage(sound, config, write_mode)
    problems = scene_problems(found, decoded, parts, config)
    results = staged(found.join(problems, "scene_id", "left"), "results")
    good = results.filter(F.col("error").isNull()).drop("error")

    # A group none of whose parts meets its window gets no rows and no per-slot values.
    groups = coverage.clipped(parts).select("scene_id", "product_type", "resolution").distinct()
    good_groups = staged(groups.join(good.drop("product_type"), "scene_id"), "groups")

    span = good_groups.agg(F.min("slot"), F.max("slot")).first()
    present = None
    if span[0] is not None:
        present = store.present_groups(spark, path, config, (span[0], span[1] + 1))
    if covered is not None:
        ledger.refuse_other_options(good_groups, covered, config)
    if present is not None:
        present = staged(present, "present")
        if existing == "error":
            store.refuse_existing(good_groups, present)
    fresh = good_groups if present is None else store.not_ingested(good_groups, present)
    known = None if present is None else store.already_ingested(good_groups, present)
    if write_mode == "staged":
        fresh, known = good_groups, None
    store.write_cube(build_scanlines(fresh, decoded, parts, plan, config, channels), path, config.flat)
    if known is not None:
        late = build_scanlines(known, decoded, parts, plan, config, channels)
        store.merge_into(
            spark, late, path, keep_existing=existing == "resume", flat=config.flat
        )

    meta = slot_values.slot_meta(good_groups, rasters.platform_means(decoded.platform_rows))
    write_slot_table(spark, meta, path, "slot_meta", config, channels)
    if config.include_calibration:
        calibration = rasters.slot_calibration(rasters.calibration_table(decoded.calib_rows), plan)
        slot_channel = calibration.join(
            good_groups.select("scene_id", "resolution", "slot", "coordinate"),
            ["scene_id", "resolution"],
        )
        write_slot_table(spark, slot_channel, path, "slot_channel", config, channels)

    located = store.stored_resolutions(spark, path, "geo", config.product_type)
    for name, table in grids.static_tables(spark, config, grid, located).items():
        store.write_groups(table, path, name, ["product_type", "resolution"])
    declared = declared_attributes(spark, config, attributes).coalesce(1)
    store.write_groups(declared, path, "attributes", ["group"])
    written = coverage.clipped(parts).join(
        good_groups.select("scene_id", "resolution", "slot"), ["scene_id", "resolution"]
    )
    runs = written.select(*store.SLOT_KEYS, F.col("lo").alias("row_start"), F.col("hi").alias("row_stop"))
    ledger.record_runs(runs, path, config)
    ledger.log_scenes(results, path)
    metrics = scenes.run_metrics(results).first().asDict()
    store.log_run(spark, path, config, {**metrics, **(origin or {})})
    return metrics


def write_slot_table(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    table: str,
    config: CubeConfig,
    channels: list[str],
) -> None:
    """Replace the per-slot rows of the touched slots; the later scene by name wins inside one run.

    The table is partitioned by day, so a run rewrites the days it touches and no others.
    """
    keys = [*store.SLOT_KEYS, *(["channel", "channel_index"] if "channel" in rows.columns else [])]
    values = [c for c in rows.columns if c not in (*keys, "scene_id")]
    latest = rows.groupBy(*keys).agg(F.max(F.struct("scene_id", *values)).alias("latest"))
    one = latest.select(*keys, *(f"latest.{c}" for c in values))
    fresh = select_variables(one, table, config, channels).withColumn("day", store.slot_day(F.col("slot")))
    existing = store.open_table(spark, path, table)
    if existing is not None:
        fresh = staged(fresh, table)
        days = fresh.select(*store.DAY_PARTITIONS).distinct()
        current = existing.join(days, list(store.DAY_PARTITIONS), "left_semi")
        fresh = staged(store.merge_rows(current, fresh, keys), table)
    store.write_days(fresh, path, table)


def ingest(
    spark: SparkSession,
    source: str,
    config: CubeConfig,
    path: str,
    decoder: Decoder,
    filters: tuple[str, ...] = (),
    slots: tuple[int, int] | None = None,
    retry: bool = False,
    opener: Opener | None = None,
    **options: Any,
) -> dict[str, Any]:
    """Ingest a folder of ZIPs or loose chunk files; see ``ingest_decoded`` for the options.

    ``slots`` restricts the run to a half-open range of slots before anything is decoded. A run with
    ``existing="resume"`` opens only files that hold rows the cube does not list; ``retry`` reads
    the scenes that failed in earlier runs and have not succeeded since; ``opener`` is that of
    ``read_scenes``.
    """
    covered, only = None, None
    if options.get("existing") == "resume":
        covered = ledger.covered_runs(spark, path, slots)
    if retry:
        log = store.open_table(spark, path, "scenes")
        if log is None:
            raise ConfigurationError("no earlier run to retry scenes of")
        only = ledger.scenes_to_retry(log)
    found, decoded = read_scenes(spark, source, config, decoder, filters, slots, covered, only, opener)
    return ingest_decoded(spark, found, decoded, config, path, **options)
