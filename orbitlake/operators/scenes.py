"""From listed files to scenes: one ZIP, or all chunks of one repeat cycle."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbitlake.constants import CYCLES_PER_DAY
from orbitlake.functions import names, slots
from orbitlake.plans.catalog import fail_where
from orbitlake.plans.config import ConfigurationError

SAMPLE = 3
TRAIL_ORDER = 1 << 62


def classify_items(files: DataFrame) -> DataFrame:
    """Add ``kind`` (zip, chunk or ignored) to a file listing."""
    return files.withColumn("kind", names.item_kind(F.col("path")))


def mixed_input(items: DataFrame) -> DataFrame:
    """One row with the number of ZIPs and chunks; ``error`` is set when both are there."""
    totals = items.agg(
        F.count_if(F.col("kind") == "zip").alias("n_zips"),
        F.count_if(F.col("kind") == "chunk").alias("n_chunks"),
    )
    mixed = (F.col("n_zips") > 0) & (F.col("n_chunks") > 0)
    return totals.withColumn(
        "error",
        F.when(
            mixed,
            F.format_string("mixed input: %d ZIP and %d chunk file(s)", "n_zips", "n_chunks"),
        ),
    )


def foreign_items(items: DataFrame, product_type: str) -> DataFrame:
    """ZIPs and chunks of another or of no product type."""
    product = names.detect_product(F.col("path"))
    return items.filter(
        (F.col("kind") != "ignored") & ~F.coalesce(product == product_type, F.lit(False))
    ).withColumn("name", names.item_name(F.col("path")))


def foreign_summary(items: DataFrame, product_type: str) -> DataFrame:
    """Number of foreign items and the first three names; the sample is a top-k, never a full list."""
    foreign = foreign_items(items, product_type).select("name")
    sample = foreign.orderBy("name").limit(SAMPLE)
    shown = sample.agg(F.array_join(F.sort_array(F.collect_list("name")), ", "))
    total = foreign.agg(F.count("*").alias("n_foreign"))
    return total.select(
        "n_foreign",
        shown.scalar().alias("shown"),
        F.greatest(F.col("n_foreign") - SAMPLE, F.lit(0)).alias("more"),
    )


def check_inputs(items: DataFrame, product_type: str) -> None:
    """Fail the run for mixed input kinds or foreign products (one row each reaches the driver)."""
    mixed = mixed_input(items).first()
    if mixed.error:
        raise ConfigurationError(f"{mixed.error}; give one kind at a time")
    foreign = foreign_summary(items, product_type).first()
    if foreign.n_foreign:
        more = f" and {foreign.more} more" if foreign.more else ""
        raise ConfigurationError(
            f"{foreign.n_foreign} input file(s) are not {product_type} products: "
            f"{foreign.shown}{more}"
        )


def items_in_slots(items: DataFrame, wanted: tuple[int, int], epoch: str) -> DataFrame:
    """Items of a listing whose time label lies in a half-open range of slots.

    Items without a readable label stay, so that they are reported as in a run without a range.
    """
    label = slots.scene_time(F.col("path"))
    slot = slots.slot_index(label, epoch, strict=False)
    inside = F.coalesce((slot >= wanted[0]) & (slot < wanted[1]), F.lit(False))
    return items.filter(label.isNull() | inside)


def day_glob(wanted: tuple[int, int], epoch: str) -> str:
    """A glob alternative over the days that names of a half-open range of slots can carry.

    The last cycle of a day may be sensed just after midnight, so the range ends a day later.
    """
    first, last = wanted[0] // CYCLES_PER_DAY, (max(wanted) - 1) // CYCLES_PER_DAY + 1
    start = datetime.date.fromisoformat(epoch)
    days = (start + datetime.timedelta(days=n) for n in range(first, last + 1))
    return "{" + ",".join(f"{day:%Y%m%d}" for day in days) + "}"


def parse_chunks(items: DataFrame, strict: bool = True) -> DataFrame:
    """Chunk rows of a listing with their name fields and the nominal start of their cycle.

    An unreadable name or cycle fails the query; ``strict=False`` drops it.
    """
    items = items.drop("name")
    parsed = items.filter(F.col("kind") == "chunk").select(
        "*", names.parse_chunk_name(F.col("path")).alias("parsed")
    )
    product = F.col("parsed.product_type")
    if strict:
        # Raised by the projection that parses, so that no filter repeats the parsing.
        error = F.col("parsed.error")
        product = F.when(error.isNotNull(), F.raise_error(error).cast("string")).otherwise(product)
    else:
        parsed = parsed.filter(
            F.col("parsed.error").isNull() & F.col("parsed.repeat_cycle").between(1, 144)
        )
    return parsed.select(
        *items.columns,
        names.item_name(F.col("path")).alias("name"),
        product.alias("product_type"),
        "parsed.sensing_start",
        "parsed.repeat_cycle",
        "parsed.chunk_no",
        "parsed.is_trail",
        slots.nominal_cycle_start(
            F.col("parsed.sensing_start"), F.col("parsed.repeat_cycle")
        ).alias("coordinate"),
    )


def rejected_chunks(items: DataFrame) -> DataFrame:
    """Chunk files (path, name, error) that ``parse_chunks`` drops when it is not strict."""
    name = names.item_name(F.col("path"))
    parsed = items.filter(F.col("kind") == "chunk").select(
        "path", name.alias("name"), names.parse_chunk_name(F.col("path")).alias("parsed")
    )
    cycle = F.when(
        ~F.coalesce(F.col("parsed.repeat_cycle").between(1, 144), F.lit(False)),
        F.concat(F.lit("invalid repeat cycle: "), F.col("name")),
    )
    rejected = parsed.select("path", "name", F.coalesce("parsed.error", cycle).alias("error"))
    return rejected.filter(F.col("error").isNotNull())


def _scene_members(chunks: DataFrame) -> DataFrame:
    """One row per scene and chunk number: the first path, and how many files claim the number.

    A number has four digits, so a scene keeps at most ten thousand rows however many copies of a
    file are listed; copies are merged in partial aggregates before the shuffle.
    """
    member = F.struct("is_trail", "chunk_no", "name", "path", "length")
    return chunks.groupBy("product_type", "coordinate", "chunk_no").agg(
        F.min(member).alias("member"),
        F.count("*").alias("n_files"),
        F.max("name").alias("other_name"),
    )


def duplicate_chunks(chunks: DataFrame) -> DataFrame:
    """Chunk numbers that more than one file of a scene claims, naming two of them."""
    return _scene_members(chunks).filter(F.col("n_files") > 1).select(
        "product_type",
        "coordinate",
        "chunk_no",
        "n_files",
        F.col("member.name").alias("first_name"),
        "other_name",
    )


def bundle_scenes(chunks: DataFrame, strict: bool = True) -> DataFrame:
    """Group chunks into scenes; members are BODY first, then by number, then by name.

    Two files with one chunk number in a scene fail the query; ``strict=False`` keeps the first by
    order and counts the others in ``n_duplicates``.
    """
    members = _scene_members(chunks)
    if strict:
        members = fail_where(
            members,
            F.when(
                F.col("n_files") > 1,
                F.format_string(
                    "duplicate chunk number %04d: %s and %s",
                    "chunk_no",
                    "member.name",
                    "other_name",
                ),
            ),
        )
    scenes = members.groupBy("product_type", "coordinate").agg(
        F.sort_array(F.collect_list("member")).alias("members"),
        F.sum(F.col("n_files") - 1).alias("n_duplicates"),
        item_size("member.length").alias("size_bytes"),
    )
    return scenes.select(
        names.scene_uri(F.col("product_type"), F.col("coordinate")).alias("scene_id"),
        F.lit("bundle").alias("kind"),
        "product_type",
        "coordinate",
        "members",
        "n_duplicates",
        "size_bytes",
    )


def item_size(length: str) -> Column:
    """Sum of member sizes; NULL when any size is unknown."""
    return F.when(F.count(length) == F.count("*"), F.sum(length))


def zip_scenes(items: DataFrame) -> DataFrame:
    """Each ZIP of a listing is one scene, labelled with its floored start."""
    path = F.col("path")
    member = F.struct(
        F.lit(False).alias("is_trail"),
        F.lit(None).cast("int").alias("chunk_no"),
        names.item_name(path).alias("name"),
        path.alias("path"),
        F.col("length"),
    )
    return items.filter(F.col("kind") == "zip").select(
        path.alias("scene_id"),
        F.lit("zip").alias("kind"),
        names.detect_product(path).alias("product_type"),
        slots.slot_label(names.sensing_start(path)).alias("coordinate"),
        F.array(member).alias("members"),
        F.lit(0).cast("bigint").alias("n_duplicates"),
        F.col("length").alias("size_bytes"),
    )


def discover(items: DataFrame, strict: bool = True) -> DataFrame:
    """All scenes of a listing: ZIPs and bundles."""
    return zip_scenes(items).unionByName(bundle_scenes(parse_chunks(items, strict), strict))


def scene_order(scenes: DataFrame) -> DataFrame:
    """Listing order of a run: ZIPs by path, then bundles by product and time."""
    rank = (F.col("kind") == "bundle").cast("int")
    zip_path = F.when(F.col("kind") == "zip", F.col("scene_id"))
    return scenes.orderBy(rank, zip_path, "product_type", "coordinate")


def order_parts(members: DataFrame) -> DataFrame:
    """1-based position of each valid chunk of a scene: BODY before TRAIL, then number, then name.

    Takes ``(scene_id, name)`` rows; copies of a name in one scene count once. The position is the
    number of chunks with a smaller number plus the position among equal numbers, so the window that
    sums up a scene holds one row per distinct number, not one per file.
    """
    name = F.col("name")
    parts = (
        members.filter(names.is_chunk(name))
        .select(
            "scene_id",
            names.is_trail(name).alias("is_trail"),
            names.part_number(name).alias("part_number"),
            names.item_name(name).alias("name"),
        )
        .distinct()
    )
    number = ["scene_id", "is_trail", "part_number"]
    before = (
        Window.partitionBy("scene_id")
        .orderBy("is_trail", "part_number")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    smaller = (
        parts.groupBy(*number)
        .agg(F.count("*").alias("n"))
        .withColumn("smaller", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    among_equal = F.row_number().over(Window.partitionBy(*number).orderBy("name"))
    return (
        parts.withColumn("among_equal", among_equal)
        .join(smaller, number)
        .select(*number, "name", (F.col("smaller") + F.col("among_equal")).alias("position"))
    )


def part_order(name: Column) -> Column:
    """Sort key of a part within its scene, computed from its name alone.

    It orders like ``order_parts`` as long as a scene has no two files of one kind and number;
    ``equal_parts`` finds scenes that do.
    """
    return names.is_trail(name).cast("bigint") * TRAIL_ORDER + names.part_number(name)


def equal_parts(members: DataFrame) -> DataFrame:
    """Scenes with two different files of the same kind and number, with an error text."""
    name = F.col("name")
    counted = members.filter(names.is_chunk(name)).groupBy("scene_id", part_order(name).alias("part_order")).agg(
        F.min(names.item_name(name)).alias("first_name"),
        F.max(names.item_name(name)).alias("last_name"),
    )
    text = F.concat(F.lit("equal part numbers: "), "first_name", F.lit(" and "), "last_name")
    return (
        counted.filter(F.col("first_name") != F.col("last_name"))
        .groupBy("scene_id")
        .agg(F.min(text).alias("error"))
    )


def run_metrics(results: DataFrame) -> DataFrame:
    """Scenes processed, failed and in total, from ``(scene_id, error)``.

    The error list of a run is the filtered table itself (``failed_scenes``), not one value.
    """
    return results.agg(
        F.count_if(F.col("error").isNull()).alias("files_processed"),
        F.count_if(F.col("error").isNotNull()).alias("files_failed"),
        F.count("*").alias("count"),
    )


def failed_scenes(results: DataFrame) -> DataFrame:
    return results.filter(F.col("error").isNotNull())
