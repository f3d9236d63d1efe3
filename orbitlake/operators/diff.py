"""Comparison of two cubes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlake.session import literal_table
from orbitlake.sources.cube import ROW_KEYS

#: Rows of a block that is compared by its digest.
BLOCK_ROWS = 256


def shift_rows(stripe: DataFrame, y0: int) -> DataFrame:
    """Turn window-relative rows into full-disk rows."""
    return stripe.withColumn("y", F.col("y") + y0)


def block_digests(
    cube: DataFrame, variables: Sequence[str], keys: Sequence[str] = ROW_KEYS, rows: int = BLOCK_ROWS
) -> DataFrame:
    """(block, n, and per variable two digests): what a block of rows holds, in any order.

    A block is a run of rows with the same other keys. Rows are hashed with their keys where they
    are read, so a block is a handful of numbers before anything is shuffled.
    """
    last = keys[-1]
    block = F.xxhash64(*keys[:-1], F.floor(F.col(last) / rows)).alias("block")

    def hashed(name: str) -> Column:
        column, parts = F.col(name), [F.col(name), F.col(name).isNull()]
        if cube.schema[name].dataType.typeName() == "array":
            # A hash passes over missing elements, so where they stand is hashed too.
            parts += [F.size(column), F.transform(column, lambda x: x.isNull())]
        return F.xxhash64(*keys, *parts)

    found = cube.select(block, *(hashed(v).alias(f"h{i}") for i, v in enumerate(variables)))
    digests = [
        d.alias(f"{kind}{i}")
        for i in range(len(variables))
        for kind, d in (
            ("xor", F.bit_xor(f"h{i}")),
            # Of 40 bits, so that no sum of a block can overflow.
            ("sum", F.sum(F.shiftright(f"h{i}", 24))),
        )
    ]
    return found.groupBy("block").agg(F.count("*").alias("n"), *digests)


def differing_blocks(
    a: DataFrame, b: DataFrame, variables: Sequence[str], keys: Sequence[str] = ROW_KEYS
) -> DataFrame:
    """(block): the blocks that the cubes do not hold alike."""
    left, right = (block_digests(c, variables, keys) for c in (a, b))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in left.columns]
    joined = left.alias("a").join(right.alias("b"), F.col("a.block") == F.col("b.block"), "full")
    alike = reduce(Column.__and__, same)
    return joined.where(~alike).select(F.coalesce("a.block", "b.block").alias("block"))


def cube_diff(
    a: DataFrame, b: DataFrame, variables: Sequence[str], keys: Sequence[str] = ROW_KEYS
) -> DataFrame:
    """Per variable: rows only in one side, rows that differ, and the first differing key.

    NULL equals NULL, and NaN equals NaN. Blocks of rows are compared by their digests first, and
    only rows of blocks that differ are joined: equal cubes shuffle digests and no pixel.
    """
    blocks = differing_blocks(a, b, variables, keys)
    block = F.xxhash64(*keys[:-1], F.floor(F.col(keys[-1]) / BLOCK_ROWS))
    sides = [c.withColumn("_block", block).join(blocks, F.col("_block") == F.col("block"), "left_semi") for c in (a, b)]
    found = row_diff(*sides, variables, keys)
    names = literal_table(a.sparkSession, [(v,) for v in variables], "variable string")
    counts = ("only_a", "only_b", "differing")
    return names.join(found, "variable", "left").select(
        "variable", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts), "first_key"
    )


def row_diff(
    a: DataFrame, b: DataFrame, variables: Sequence[str], keys: Sequence[str] = ROW_KEYS
) -> DataFrame:
    """The same by joining all rows; variables without any row are left out.

    The key of a row is its hash key in the shuffle, so rows
    spread evenly; only per-task counters reach the final aggregate.
    """
    left = a.select(*keys, *(F.col(v).alias(f"a_{v}") for v in variables), F.lit(1).alias("in_a"))
    right = b.select(*keys, *(F.col(v).alias(f"b_{v}") for v in variables), F.lit(1).alias("in_b"))
    joined = left.join(right, list(keys), "full")
    both = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    per_variable = joined.select(
        *keys,
        "in_a",
        "in_b",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(v).alias("variable"),
                        (both & ~F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}"))).alias("differs"),
                    )
                    for v in variables
                )
            )
        ).alias("v"),
    )
    mismatch = F.col("v.differs") | ~both
    return per_variable.groupBy("v.variable").agg(
        F.count_if(F.col("in_b").isNull()).alias("only_a"),
        F.count_if(F.col("in_a").isNull()).alias("only_b"),
        F.count_if("v.differs").alias("differing"),
        F.min(F.when(mismatch, F.struct(*keys))).alias("first_key"),
    )


def equal_cubes(a: DataFrame, b: DataFrame, variables: Sequence[str], keys=ROW_KEYS) -> bool:
    bad = (F.col("only_a") > 0) | (F.col("only_b") > 0) | (F.col("differing") > 0)
    return cube_diff(a, b, variables, keys).filter(bad).isEmpty()
