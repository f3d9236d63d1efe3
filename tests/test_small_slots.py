"""Cubes of many small slots, which share folders."""

from collections import Counter

import duckdb
import pytest
import small_scene as s
from pyspark.sql import functions as F

from orbitlake import CubeConfig
from orbitlake.sources import cube
from orbitlake.streaming import ingest as streaming

SLOTS = 1200


def lines(spark, slots, counts, ys=(0, 1), tile=True):
    rows = spark.range(slots.start, slots.stop).select(
        F.lit("FDHSI").alias("product_type"), F.lit("1km").alias("resolution"), F.col("id").alias("slot"),
        F.lit("vis_04").alias("channel"), F.explode(F.array(*map(F.lit, ys))).alias("y"),
    )
    rows = rows.withColumn("counts", F.lit(counts) + F.col("slot"))
    return rows.withColumn("tile", F.col("y").cast("int")) if tile else rows


def files(path):
    return {p: p.stat().st_mtime_ns for p in (path / "scanlines").rglob("part-*.parquet")}


def stored(spark, path, **where):
    found = cube.read_cube(spark, str(path), **where)
    return sorted(tuple(r) for r in found.select("slot", "y", "counts").collect())


@pytest.mark.parametrize("flat", [False, True])
def test_many_small_slots_share_files_and_a_late_tile_leaves_others_alone(spark, tmp_path, flat):
    path = tmp_path / "cube"
    cube.write_cube(lines(spark, range(SLOTS), 0), str(path), flat)
    before = files(path)
    assert len(before) < SLOTS / 10
    cube.merge_into(spark, lines(spark, range(5, 8), 9000, ys=(1, 7)), str(path), flat=flat)
    after = files(path)
    kept = {p for p in before if after.get(p) == before[p]}
    assert {p.parent.name for p in kept} == {"tile=0", "tile=1"}
    assert {p.parent.name for p in set(after) - kept} == {"tile=1", "tile=7"}
    assert {p.parent.parent.name for p in set(after) - kept} == {"slots=0"}
    wanted = [(n, y, n + 9000 * (y > 0 and 5 <= n < 8)) for n in range(SLOTS) for y in (0, 1)]
    assert stored(spark, path) == sorted(wanted + [(n, 7, n + 9000) for n in range(5, 8)])
    assert stored(spark, path, slots=(1100, 1102), rows=(1, 2)) == [(1100, 1, 1100), (1101, 1, 1101)]
    levels = ["slot", "tile"] if flat else ["product_type", "resolution", "slot", "tile"]
    assert cube.read_cube(spark, str(path)).columns == ["channel", "y", "counts", *levels]


def test_a_write_replaces_only_its_slots_where_they_share_folders(spark, tmp_path):
    path = str(tmp_path / "cube")
    cube.write_cube(lines(spark, range(SLOTS), 0, tile=False), path)
    cube.write_cube(lines(spark, range(3, 5), 100, ys=(4,), tile=False), path)
    found = stored(spark, path)
    assert [r for r in found if r[0] in (3, 4)] == [(3, 4, 103), (4, 4, 104)]
    assert len(found) == 2 * SLOTS - 2
    late = lines(spark, range(3, 6), 500, ys=(4,), tile=False)
    cube.merge_into(spark, late, path, keep_existing=True)
    assert [r for r in stored(spark, path) if r[1] == 4] == [(3, 4, 103), (4, 4, 104), (5, 4, 505)]


def test_slots_of_a_shared_folder_keep_columns_that_others_lack(spark, tmp_path):
    path = str(tmp_path / "cube")
    cube.write_cube(lines(spark, range(SLOTS), 0, tile=False).withColumn("quality", F.lit(1)), path)
    plain = lines(spark, range(3, 4), 100, tile=False)
    cube.merge_into(spark, plain, path)
    cube.write_cube(lines(spark, range(4, 5), 100, tile=False), path)
    found = cube.read_cube(spark, path).where("slot < 7").groupBy("slot").agg(F.count("quality"), F.min("counts"))
    assert sorted(map(tuple, found.collect())) == [
        (n, 0 if n in (3, 4) else 2, n + 100 * (n in (3, 4))) for n in range(7)
    ]


def test_large_slots_keep_their_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cube, "MANY_PARTITIONS", 2)
    wide = lines(spark, range(4), 0, tile=False).withColumn("counts", F.array_repeat(F.col("counts"), 40_000))
    cube.write_cube(wide, str(tmp_path / "cube"))
    folders = {p.parent.name for p in (tmp_path / "cube").rglob("part-*.parquet")}
    assert folders == {f"slot={n}" for n in range(4)}
    assert cube.in_blocks(spark, str(tmp_path / "cube")) is False
    assert cube.in_blocks(spark, str(tmp_path / "none")) is None


def test_small_files_of_one_split_are_decoded_by_many_tasks(spark, tmp_path):
    with pytest.MonkeyPatch.context() as patch:
        s.shrink(patch)
        config = CubeConfig("FDHSI", time_epoch="2024-01-01", include_geolocation=False, resolutions="2km")
        rows = [(f"s3://in/{s.name(n, cycle=c)}", f'{{"number": {n}}}'.encode()) for c in range(1, 31) for n in (1, 2, 3)]
        files = spark.createDataFrame(rows, "path string, content binary").coalesce(1)
        files.write.parquet(str(tmp_path / "in"))
        stream = streaming.file_stream(spark, str(tmp_path / "in"), "path string, content binary")
        path, checkpoint = str(tmp_path / "cube"), str(tmp_path / "checkpoint")
        streaming.ingest_stream(stream, config, path, s.decoder, checkpoint).awaitTermination()
        decoded = (tmp_path / "checkpoint-decoded").rglob("part-*.parquet")
        # The name of a file begins with the number of its task.
        assert len({p.name.split("-")[1] for p in decoded}) > 4
        assert cube.read_cube(spark, path).count() == 30 * 12


def events(spark, folder):
    """Four events of each of 1,200 users, and two of none."""
    kinds = F.array(*map(F.lit, ("view", "click")))
    rows = spark.range(4 * SLOTS + 2).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") < 4 * SLOTS, F.col("id") % SLOTS).alias("user_id"),
        F.get(kinds, (F.col("id") / SLOTS + F.col("id")).cast("int") % 2).alias("event_type"),
        F.col("id").cast("double").alias("value"),
    )
    rows.coalesce(1).write.parquet(str(folder / "parts"))
    next((folder / "parts").glob("*.parquet")).rename(folder / "events.parquet")


@pytest.mark.parametrize("query", ["late_chunk", "stream_replay"])
def test_a_stream_into_many_small_slots_lists_few_files(spark, tmp_path, query):
    import workload

    events(spark, tmp_path)
    found = workload.QUERIES[query](spark, str(tmp_path))
    # The driver holds the list of files.
    assert len(found.inputFiles()) < SLOTS / 10
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    wanted = con.execute(f"SELECT {', '.join(found.columns)} FROM ({workload.SQL[query]})").fetchall()
    assert Counter(map(tuple, found.collect())) == Counter(wanted)
