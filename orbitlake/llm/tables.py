"""Tables in the shared folder, running totals and connected components as Spark jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbitlake.session import scratch_path, staged

__all__ = ["bitmap", "components", "drop_path", "fresh", "held_out", "read", "running_total", "smallest", "staged"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(id_column: str, remainder: int) -> Column:
    """True for the rows of the fold that models never learn from; a null id is in no fold."""
    crc = F.crc32(F.encode(F.col(id_column).cast("string"), "UTF-8"))
    return F.coalesce(F.pmod(crc, F.lit(5)) == remainder, F.lit(False))


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one of our own scratch tables from the shared folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def smallest(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the smallest keys; ``key`` is a hash that no two rows share.

    Keys are spread evenly, so all but some more than ``limit`` can be left out before any are sorted:
    whatever the number of partitions, few rows meet in one task.
    """
    share = min((1.2 * limit + 200) / max(rows.count(), 1), 1.0)
    even = F.shiftrightunsigned(F.xxhash64(F.lit(29), key), 32)
    return rows.where(even < int(share * (1 << 32))).orderBy(even, key).limit(limit)


def bitmap(hashes: DataFrame, column: str, size: int) -> np.ndarray:
    """Which of ``size`` slots the hashes of a column fall into, eight to a byte.

    Its size is fixed however many rows there are; the driver gets one row per 64 slots at most.
    ``size`` is a power of two.
    """
    slot = F.pmod(column, F.lit(size))
    cells = hashes.select(slot.alias("slot")).select(
        F.shiftright("slot", 6).cast("int").alias("cell"),
        F.expr("shiftleft(1L, cast(pmod(slot, 64) as int))").alias("bit"),
    )
    cells = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    found = np.zeros(size // 64, np.int64)
    found[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return found.view(np.uint8)


def running_total(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Add ``before`` and ``total``: the sum of ``value`` ahead of a row, and over all its key.

    Rows are range-partitioned on key and order, so a key that holds most rows is spread over many
    tasks; each task then needs only the sums of the key's earlier partitions, one row per
    partition and key. ``value`` must be an integer, so that sums don't depend on the partitions.
    Rows that tie in ``order`` must be alike in what the caller does with them.
    """
    spark = df.sparkSession
    ranked = df.repartitionByRange(*by, *order).withColumn("_pid", F.spark_partition_id())
    ranked = staged(ranked, "running")
    here = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
    sums = ranked.groupBy(*by, "_pid").agg(F.sum(value).alias("_sum"))
    # Each window holds at most one row per partition of the table.
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    ahead = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = staged(
        sums.select(
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
            F.col("_pid").alias("_p"),
            F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"),
            F.sum("_sum").over(whole).alias("total"),
        ),
        "offsets",
    )
    inner = Window.partitionBy(*by, "_pid").orderBy(*order)
    inner = inner.rowsBetween(Window.unboundedPreceding, -1)
    within = ranked.withColumn("_within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    joined = within.join(sums, [*here, F.col("_pid") == F.col("_p")])
    return joined.select(
        *df.columns, (F.col("_ahead") + F.col("_within")).alias("before"), "total"
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node reachable.

    Alternating large-star and small-star rounds: every round is joins and minima of bounded size
    per key, and the number of rounds grows with the logarithm of the longest chain. Each round is
    written to the shared folder, which cuts the lineage, and the round before is deleted.
    """
    spark = edges.sparkSession
    now = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    path, mark = None, None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u"))
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("u"))
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        step = small.select("e.a", "e.b").where("a <> b").distinct()
        written = scratch_path(spark, "components")
        step.write.parquet(written)
        now = spark.read.schema(step.schema).parquet(written)
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if path:
            drop_path(spark, path)
        path = written
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
