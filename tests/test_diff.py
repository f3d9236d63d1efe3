"""Comparison by digests of blocks against the comparison of all rows."""

from pyspark.sql import functions as F

from orbitlake.operators import diff

KEYS = ["channel", "y"]


def cube(spark):
    rows = [(c, y, [1, None, y], None if y % 7 else float(y)) for c in ("a", "b") for y in range(900)]
    return spark.createDataFrame(rows, "channel string, y int, counts array<int>, value double")


def test_digests_find_what_all_rows_find(spark):
    a = cube(spark)
    moved = F.array(F.lit(None).cast("int"), F.lit(1), F.lit(700))
    b = a.withColumn("counts", F.when(F.expr("y = 700 AND channel = 'a'"), moved).otherwise(F.col("counts")))
    b = b.where("NOT (y = 5 AND channel = 'b')")
    names = ["counts", "value"]
    found, want = (sorted(f(a, b, names, KEYS).collect()) for f in (diff.cube_diff, diff.row_diff))
    assert found == want and [r.only_a for r in found] == [1, 1] and [r.differing for r in found] == [1, 0]
    assert diff.differing_blocks(a, b, names, KEYS).count() == 2


def test_equal_cubes_differ_in_no_block(spark):
    a = cube(spark)
    b = a.repartition(5).withColumn("value", F.col("value") + 0.0)
    assert diff.differing_blocks(a, b, ["counts", "value"], KEYS).isEmpty()
    assert diff.equal_cubes(a, b, ["counts", "value"], KEYS)
    zero = [(r.variable, r.only_a, r.only_b, r.differing, r.first_key) for r in diff.cube_diff(a, b, ["value"], KEYS).collect()]
    assert zero == [("value", 0, 0, 0, None)]
    empty = a.withColumn("counts", F.when(F.col("y") == 3, F.array().cast("array<int>")).otherwise(F.col("counts")))
    gone = a.withColumn("counts", F.when(F.col("y") != 3, F.col("counts")))
    assert diff.differing_blocks(empty, gone, ["counts"], KEYS).count() == 2
