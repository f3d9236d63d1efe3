"""Audit of stored fill attributes against the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlake.plans.config import ConfigurationError, CubeConfig
from orbitlake.plans.variables import all_groups, declared_attributes
from orbitlake.sources.cube import open_table

FILL = "_FillValue"


def layout_of(stored: DataFrame) -> DataFrame:
    """Layout of a cube from the groups of its attribute rows: flat, grouped, mixed or unknown."""
    groups = all_groups()
    flags = stored.agg(
        F.max((F.col("group") == "").cast("int")).alias("flat"),
        F.max(F.col("group").isin(groups).cast("int")).alias("grouped"),
    )
    flat, grouped = F.coalesce("flat", F.lit(0)) == 1, F.coalesce("grouped", F.lit(0)) == 1
    return flags.select(
        F.when(flat & grouped, "mixed")
        .when(flat, "flat")
        .when(grouped, "grouped")
        .otherwise("unknown")
        .alias("layout")
    )


def common_names(declared: DataFrame, group: str = "group") -> DataFrame:
    """Names declared in every group: the intersection, as a count of groups per name."""
    pairs = declared.select(group, "variable").distinct()
    n_groups = pairs.select(group).distinct().agg(F.count("*"))
    per_name = pairs.groupBy("variable").agg(F.count("*").alias("n"))
    return per_name.filter(F.col("n") == n_groups.scalar()).select("variable")


def missing_names(declared: DataFrame, present: DataFrame) -> DataFrame:
    """Declared pairs of group and variable that are not present."""
    return declared.join(present, ["group", "variable"], "left_anti")


def fill_audit(declared: DataFrame, present: DataFrame, stored: DataFrame) -> DataFrame:
    """State of each declared fill: absent array, missing, ok or conflict.

    ``declared`` and ``stored`` hold ``(group, variable, value)`` of the fill attribute, ``present``
    the arrays the cube has.
    """
    keys = ["group", "variable"]
    have = present.select(*keys).distinct().withColumn("present", F.lit(True))
    found = stored.select(*keys, F.col("value").alias("found"))
    joined = declared.join(have, keys, "left").join(found, keys, "left")
    state = (
        F.when(F.col("present").isNull(), "absent")
        .when(F.col("found").isNull(), "missing")
        .when(F.col("found") == F.col("value"), "ok")
        .otherwise("conflict")
    )
    return joined.select(*keys, "value", "found", state.alias("state"))


def audit_cube(spark: SparkSession, path: str, config: CubeConfig) -> DataFrame:
    """Fill audit of a cube; a layout that cannot be told is refused."""
    stored = open_table(spark, path, "attributes")
    layout = "unknown" if stored is None else layout_of(stored).first().layout
    if layout in ("mixed", "unknown"):
        raise ConfigurationError(f"cannot audit a cube of {layout} layout")
    declared = declared_attributes(spark, config)
    fills = declared.filter(F.col("attribute") == FILL).drop("attribute")
    return fill_audit(fills, stored, stored.filter(F.col("attribute") == FILL))


def fix_fills(spark: SparkSession, path: str, config: CubeConfig, apply: bool = False) -> DataFrame:
    """Add missing fill attributes; one conflict stops everything, and without ``apply`` it is a dry run.

    Returns the rows that were, or would be, added.
    """
    audit = audit_cube(spark, path, config)
    conflicts = audit.filter(F.col("state") == "conflict").orderBy("group", "variable").limit(3)
    shown = [f"{c.group}/{c.variable}: {c.found}, expected {c.value}" for c in conflicts.collect()]
    if shown:
        raise ConfigurationError("conflicting fill attributes, nothing written: " + "; ".join(shown))
    missing = audit.filter(F.col("state") == "missing").select(
        "group", "variable", F.lit(FILL).alias("attribute"), "value"
    )
    # The registry bounds these rows, so they are kept as literals before the table changes.
    missing = spark.createDataFrame(missing.collect(), missing.schema)
    if apply:
        missing.coalesce(1).write.mode("append").parquet(f"{path}/attributes")
    return missing
