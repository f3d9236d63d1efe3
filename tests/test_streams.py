"""Streams of files and of scanlines into whole cubes, grouped and flat."""

import json

import pytest
import small_scene as s
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orbitlake import CubeConfig
from orbitlake.ingest import ingest
from orbitlake.operators import diff
from orbitlake.sources import cube
from orbitlake.streaming import ingest as streaming

EPOCH = "2024-01-01"
PIXEL = ("counts", "pixel_quality", "pixel_time")


@pytest.fixture(autouse=True, scope="module")
def small_grid():
    with pytest.MonkeyPatch.context() as patch:
        s.shrink(patch)
        yield


def table(spark, path, name):
    drop = ("logged_at", "signature", "run")
    found = spark.read.parquet(f"{path}/{name}")
    return sorted(str(r) for r in found.select(*[c for c in sorted(found.columns) if c not in drop]).collect())


@pytest.mark.parametrize("flat", [False, True])
def test_files_in_any_order_make_the_cube_of_one_ingest(spark, tmp_path, flat):
    config = CubeConfig(
        "FDHSI", time_epoch=EPOCH, include_geolocation=False, flat=flat, resolutions="1km" if flat else None
    )
    source = s.write_parts(tmp_path / "in", (3,))
    path, checkpoint = str(tmp_path / "cube"), str(tmp_path / "checkpoint")

    def stream():
        files = streaming.input_stream(spark, str(source), maxFilesPerTrigger="2")
        query = streaming.ingest_stream(files, config, path, s.decoder, checkpoint)
        query.awaitTermination()

    stream()
    assert cube.read_cube(spark, path).select("y").distinct().count() == 8 if flat else True
    # The rest of the scene, another one, a foreign file and one that cannot be read.
    s.write_parts(source / "more", (1, 2))
    s.write_parts(source / "next", (2, 1, 3), cycle=2)
    (source / s.name(1, product="HRFI")).write_text("x")
    (source / s.name(1).replace(".nc", "x.nc")).write_text("x")
    stream()
    for name in (s.name(1, product="HRFI"), s.name(1).replace(".nc", "x.nc")):
        (source / name).unlink()
    ingest(spark, str(source), config, str(tmp_path / "batch"), s.decoder)
    both = [cube.read_cube(spark, str(p)) for p in (path, tmp_path / "batch")]
    keys = ["slot", "channel", "y"] if flat else cube.ROW_KEYS
    assert both[0].count() == (96 if flat else 120)
    assert diff.equal_cubes(*both, PIXEL, keys)
    for name in ("slot_meta", "slot_channel", "channels", "axis_x", "axis_y", "attributes", "identity"):
        assert table(spark, path, name) == table(spark, tmp_path / "batch", name), name
    rejected = spark.read.parquet(f"{path}/rejected")
    assert rejected.select("name").distinct().count() == 2
    # A batch that comes again is seen in the log.
    log = spark.read.parquet(f"{path}/ingest_log")
    done = [r.batch for r in streaming.seen_batches(log, checkpoint).collect()]
    assert len(done) == len(set(done)) > 1


def test_a_replayed_batch_is_passed_over(spark, tmp_path):
    config = CubeConfig("FDHSI", time_epoch=EPOCH, include_geolocation=False, resolutions="2km")
    source = s.write_parts(tmp_path / "in", (1, 2))
    path, checkpoint = str(tmp_path / "cube"), str(tmp_path / "checkpoint")
    cube.check_identity(spark, path, config)
    cube.log_run(spark, path, config, {"stream": checkpoint, "batch": 0})
    files = streaming.input_stream(spark, str(source))
    streaming.ingest_stream(files, config, path, s.decoder, checkpoint).awaitTermination()
    assert cube.open_table(spark, path, "scanlines") is None


def scanlines(spark, folder, grid):
    rows = [("FDHSI", grid, slot, "vis_04", y, [slot, y]) for slot in (3, 4) for y in range(6)]
    schema = "product_type string, resolution string, slot bigint, channel string, y int, counts array<int>"
    frame = spark.createDataFrame(rows, schema)
    frame.write.parquet(str(folder))
    return frame.schema


def test_a_flat_cube_stays_flat_in_a_stream(spark, tmp_path):
    config = CubeConfig("FDHSI", time_epoch=EPOCH, flat=True, resolutions="1km")
    path = tmp_path / "cube"
    for number, grid in enumerate(("1km", "2km")):
        schema = scanlines(spark, tmp_path / grid, grid)
        rows = streaming.file_stream(spark, str(tmp_path / grid), schema)
        query = streaming.merge_stream(rows, str(path), str(tmp_path / f"check{number}"), config=config)
        if grid == "1km":
            query.awaitTermination()
        else:
            with pytest.raises(StreamingQueryException, match="grid the cube does not store: FDHSI 2km"):
                query.awaitTermination()
    folders = {p.name for p in (path / "scanlines").iterdir() if p.is_dir()}
    assert folders == {"slot=3", "slot=4"}
    assert json.loads(spark.read.parquet(f"{path}/identity").first().identity)["layout"] == "flat"
    found = cube.read_cube(spark, str(path))
    assert found.count() == 12 and found.where(F.col("tile") == F.floor(F.col("y") / 3)).count() == 12


def test_a_stream_of_events_goes_to_the_slots_of_their_times(spark, tmp_path):
    from workload import QUERIES

    rows = [
        (1, "2024-01-01 00:09:59.9", 7, "view", 1.5),
        (2, "2024-01-01 00:10:00", 7, "click", 2.5),
        (3, "2024-01-02 00:00:01", 7, "view", None),
        (4, None, None, "view", 4.5),
    ]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    events.coalesce(1).write.parquet(str(tmp_path / "parts"))
    next((tmp_path / "parts").glob("*.parquet")).rename(tmp_path / "events.parquet")
    found = QUERIES["stream_ingest"](spark, str(tmp_path)).select("y", "slot", "counts").collect()
    assert {tuple(r) for r in found} == {(1, 0, 1.5), (2, 1, 2.5), (3, 144, None), (4, None, 4.5)}


def test_a_cube_of_many_small_slots_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(400).select(
        F.lit("FDHSI").alias("product_type"), F.lit("1km").alias("resolution"), (F.col("id") % 40).alias("slot"),
        F.lit("vis_04").alias("channel"), F.col("id").alias("y"), F.rand(1).alias("counts"),
    )
    cube.write_cube(rows, str(tmp_path / "cube"))
    files = [p.name for p in (tmp_path / "cube").rglob("part-*.parquet")]
    # A slot stays whole in one file; the name of a file begins with the number of its task.
    assert len(files) == 40 and len({name.split("-")[1] for name in files}) > 1
