"""What a cube holds and how it came about: covered rows, run options and failed scenes.

``covered`` lists the row runs each run wrote, by group and slot, with a digest of the run's options.
``scenes`` lists the outcome of every scene of every run. Both are only ever appended to, after the
rows they speak of: a run that stops early leaves rows that are not listed, which are ingested again.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlake.constants import BODY_CHUNKS
from orbitlake.operators.intervals import left_of, merge_runs
from orbitlake.plans import catalog
from orbitlake.plans.config import ConfigurationError, CubeConfig
from orbitlake.session import literal_table
from orbitlake.sources.cube import SLOT_KEYS, open_table, slot_day, small_tasks

GROUP_RUNS = [*SLOT_KEYS, "row_start", "row_stop"]
SHOWN = 3


def signature_digest(config: CubeConfig) -> str:
    """Digest of the options that a stored group and a run must share.

    Resolutions are left out: they name the groups, and each group has its own entry.
    """
    options = {k: v for k, v in config.signature().items() if k != "resolutions"}
    return hashlib.md5(json.dumps(options, sort_keys=True).encode()).hexdigest()


def record_runs(runs: DataFrame, path: str, config: CubeConfig) -> None:
    """List the rows a run wrote (product_type, resolution, slot, row_start, row_stop)."""
    listed = merge_runs(runs, SLOT_KEYS).select(
        *SLOT_KEYS,
        F.col("row_start").cast("int").alias("row_start"),
        F.col("row_stop").cast("int").alias("row_stop"),
        F.lit(signature_digest(config)).alias("signature"),
        F.current_timestamp().alias("logged_at"),
        slot_day(F.col("slot")).alias("day"),
    )
    with small_tasks(runs.sparkSession):
        listed.hint("rebalance", "day").write.partitionBy("day").mode("append").parquet(f"{path}/covered")


def covered_runs(
    spark: SparkSession, path: str, slots: tuple[int, int] | None = None
) -> DataFrame | None:
    """Listed runs, of a half-open range of slots; None for a cube without any."""
    stored = open_table(spark, path, "covered")
    if stored is None or slots is None:
        return stored
    slot = F.col("slot")
    days = (F.col("day") >= slot_day(F.lit(slots[0]))) & (F.col("day") <= slot_day(F.lit(slots[1])))
    return stored.where(days & (slot >= slots[0]) & (slot < slots[1]))


def latest_signatures(covered: DataFrame) -> DataFrame:
    """The signature of the latest run that wrote each group and slot."""
    return covered.groupBy(*SLOT_KEYS).agg(F.max_by("signature", "logged_at").alias("stored"))


def signature_conflicts(groups: DataFrame, covered: DataFrame, signature: Column) -> DataFrame:
    """Groups and slots that were last written with other options."""
    wanted = groups.select(*SLOT_KEYS, signature.alias("wanted")).distinct()
    joined = wanted.join(latest_signatures(covered), list(SLOT_KEYS))
    return joined.where(F.col("wanted") != F.col("stored"))


def refuse_other_options(groups: DataFrame, covered: DataFrame, config: CubeConfig) -> None:
    """Fail a resumed run whose options are not those its slots were written with."""
    digest = F.lit(signature_digest(config))
    clash = signature_conflicts(groups, covered, digest).orderBy(*SLOT_KEYS).limit(SHOWN).collect()
    if clash:
        shown = ", ".join(f"slot {r.slot} of {r.resolution}" for r in clash)
        raise ConfigurationError(f"stored with other options, use force or the same ones: {shown}")


def wanted_rows(spark: SparkSession, config: CubeConfig) -> DataFrame:
    """The rows of each BODY chunk that a cube stores, by product and resolution."""
    windows = [(config.product_type, r, *catalog.row_window(config, r)) for r in catalog.config_resolutions(config)]
    stored = literal_table(spark, windows, "product_type string, resolution string, y_start int, y_stop int")
    rows = catalog.body_rows(spark).join(F.broadcast(stored), ["product_type", "resolution"])
    return rows.select(
        "product_type",
        "resolution",
        "chunk_no",
        F.greatest("row_start", "y_start").alias("row_start"),
        F.least("row_stop", "y_stop").alias("row_stop"),
    ).where("row_start < row_stop")


def files_left(files: DataFrame, covered: DataFrame, rows: DataFrame) -> DataFrame:
    """Files that still have to be decoded, of (scene_id, product_type, slot, chunk_no, path).

    A scene of which nothing is stored needs all of its files. Of others a chunk is left when a row
    it holds is not covered, an archive (no chunk number) when any row of the window is not, and a
    file without rows (TRAIL) when another one of its scene is left.
    """
    begun = covered.select("product_type", "slot").distinct()
    untouched = files.join(begun, ["product_type", "slot"], "left_anti")
    known = files.join(begun, ["product_type", "slot"], "left_semi")
    whole = rows.groupBy("product_type", "resolution").agg(
        F.min("row_start").alias("row_start"), F.max("row_stop").alias("row_stop")
    )
    number = F.col("chunk_no")
    archives = known.where(number.isNull()).join(F.broadcast(whole), "product_type")
    chunks = known.where(number.isNotNull()).join(F.broadcast(rows), ["product_type", "chunk_no"])
    wanted = archives.unionByName(chunks.select(*archives.columns))
    left = left_of(wanted, covered.select(*GROUP_RUNS), SLOT_KEYS).select(*files.columns).distinct()
    trails = known.where(number > BODY_CHUNKS).join(
        left.select("scene_id").distinct(), "scene_id", "left_semi"
    )
    return untouched.unionByName(left).unionByName(trails)


def log_scenes(results: DataFrame, path: str) -> None:
    """Append the outcome of a run's scenes (scene_id, product_type, slot, error)."""
    logged = results.select(
        "scene_id",
        "product_type",
        F.col("slot").cast("bigint").alias("slot"),
        "error",
        F.lit(uuid.uuid4().hex).alias("run"),
        F.current_timestamp().alias("logged_at"),
    )
    logged.write.mode("append").parquet(f"{path}/scenes")


def scenes_to_retry(log: DataFrame) -> DataFrame:
    """Scenes that failed and have not succeeded since, with the latest error.

    ``log`` holds (scene_id, error, logged_at) of every run: failures, without those that a later
    success of the same scene follows.
    """
    last = F.max("logged_at").alias("last")
    failed = log.where("error is not null").groupBy("scene_id").agg(
        last, F.max_by("error", "logged_at").alias("error"), F.count("*").alias("n_failures")
    )
    good = log.where("error is null").groupBy("scene_id").agg(last)
    later = (F.col("f.scene_id") == F.col("g.scene_id")) & (F.col("g.last") >= F.col("f.last"))
    return failed.alias("f").join(good.alias("g"), later, "left_anti").drop("last")
