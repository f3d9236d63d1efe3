"""Whole ingests of a small scene: complete, partial, late, resumed, staged, flat, audited."""

import pytest
import small_scene as s
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orbitlake import ConfigurationError, CubeConfig
from orbitlake.ingest import ingest
from orbitlake.operators import audit, diff, rasters, scenes
from orbitlake.plans.variables import group_name
from orbitlake.sources import cube, grids

PIXEL = ("counts", "pixel_quality", "pixel_time")
EPOCH = "2024-01-01"


@pytest.fixture(autouse=True, scope="module")
def small_grid():
    with pytest.MonkeyPatch.context() as patch:
        s.shrink(patch)
        yield


def run(spark, source, path, **options):
    split = {k: options.pop(k) for k in ("write_mode", "existing") if k in options}
    options = {"include_geolocation": False, **options}
    config = CubeConfig("FDHSI", time_epoch=EPOCH, **options)
    return ingest(spark, str(source), config, str(path), s.decoder, **split)


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory, small_grid):
    """A cube of one complete scene, with geolocation; tests only read it."""
    path = tmp_path_factory.mktemp("full")
    metrics = run(spark, s.write_parts(path / "in", (3, 1, 2)), path / "cube", include_geolocation=True)
    assert metrics == {"files_processed": 1, "files_failed": 0, "count": 1}
    return path / "cube"


def scan(spark, path, **where):
    return cube.read_cube(spark, str(path), **where)


def test_full_scene(spark, full):
    rows = scan(spark, full).collect()
    assert len(rows) == 2 * 24 + 12
    for r in rows:
        size = {"1km": 24, "2km": 12}[r.resolution]
        number = r.y // (size // 3) + 1
        position = {"vis_04": 0, "vis_06": 1, "ir_38": 0}[r.channel]
        assert r.slot == 0 and r.channel_index == position
        assert r.counts == s.counts(position, r.y, size)
        assert r.pixel_quality == [(r.y + x) % 4 for x in range(size)]
        index = s.index_of(number, r.y, size)
        last = max(n for n in (1, 2, 3) if index in s.indices(n))
        assert r.pixel_time == [100.0 * index + last] * size
    meta = spark.read.parquet(f"{full}/slot_meta").collect()
    assert {m.resolution for m in meta} == {"1km", "2km"}
    assert meta[0].subsatellite_latitude == pytest.approx(10 + 5.5)
    assert meta[0].sun_earth_distance == pytest.approx(0.9833, abs=1e-3)
    calibration = {
        (r.channel): (r.slope, r.offset, r.warm_slope)
        for r in spark.read.parquet(f"{full}/slot_channel").collect()
    }
    assert calibration == {"vis_04": (1.0, 0.0, None), "vis_06": (2.0, 1.0, None), "ir_38": (1.0, 0.0, None)}
    geo = {r.resolution: (r.lines, r.total) for r in grids.geo_info(spark.read.parquet(f"{full}/geo")).collect()}
    assert geo == {"1km": (24, 24 * 24), "2km": (12, 12 * 12)}
    wide = rasters.attach_geo(scan(spark, full), spark.read.parquet(f"{full}/geo"))
    assert wide.filter(F.size("latitude") == F.size("counts")).count() == 60


def test_zip_and_loose_chunks_give_the_same_cube(spark, full, tmp_path):
    run(spark, s.zip_parts(tmp_path / "zip", (2, 3, 1)), tmp_path / "cube")
    assert diff.equal_cubes(scan(spark, full), scan(spark, tmp_path / "cube"), PIXEL)


def test_export_geo(spark, tmp_path):
    path = str(tmp_path / "geo")
    grids.export_geo(spark, ["1km", "2km"], path)
    found = {r.resolution: r.total for r in grids.geo_info(spark.read.parquet(path)).collect()}
    assert found == {"1km": 24 * 24, "2km": 12 * 12}
    with pytest.raises(ConfigurationError, match="are there already"):
        grids.export_geo(spark, ["2km"], path)
    with pytest.raises(ConfigurationError, match="unknown resolutions"):
        grids.export_geo(spark, ["9km"], path, overwrite=True)


@pytest.mark.parametrize("existing", ["force", "resume"])
def test_late_part_completes_the_slot(spark, full, tmp_path, existing):
    run(spark, s.write_parts(tmp_path / "first", (2, 3)), tmp_path / "cube")
    before = scan(spark, tmp_path / "cube").toPandas()
    late = s.write_parts(tmp_path / "late", (1,))
    with pytest.raises(ConfigurationError, match="already ingested"):
        run(spark, late, tmp_path / "cube")
    assert len(scan(spark, tmp_path / "cube").toPandas()) == len(before) == 40
    run(spark, late, tmp_path / "cube", existing=existing)

    want, now = scan(spark, full), scan(spark, tmp_path / "cube")
    assert diff.equal_cubes(want, now, ["counts", "pixel_quality"])
    # Only the last row of part 1 differs: chunk 2 wins its index in the full input.
    times = diff.cube_diff(want, now, ["pixel_time"]).first()
    assert (times.only_a, times.only_b, times.differing) == (0, 0, 3)
    meta = spark.read.parquet(f"{tmp_path}/cube/slot_meta").first()
    assert meta.subsatellite_latitude == pytest.approx(10 + 2.5)


def test_repeated_ingest_changes_nothing(spark, full, tmp_path):
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    run(spark, source, tmp_path / "cube")
    run(spark, source, tmp_path / "cube", existing="force")
    assert diff.equal_cubes(scan(spark, full), scan(spark, tmp_path / "cube"), PIXEL)
    assert spark.read.parquet(f"{tmp_path}/cube/ingest_log").count() == 2


def test_partial_scenes_are_refused_where_they_must_be(spark, tmp_path):
    source = s.write_parts(tmp_path / "in", (2, 3))
    with pytest.raises(ConfigurationError, match=r"the window .* rows \[0, 8\)"):
        run(spark, source, tmp_path / "a", write_mode="staged")
    with pytest.raises(ConfigurationError, match=r"rows \[6, 8\); missing BODY chunk\(s\) 1"):
        run(spark, source, tmp_path / "b", partial_chunk="error")
    for path in ("a", "b"):
        assert cube.open_table(spark, str(tmp_path / path), "scanlines") is None


def test_stripe_holds_its_rows_of_the_full_disk(spark, full, tmp_path):
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    run(spark, source, tmp_path / "stripe", body_chunks=(2, 2))
    stripe = scan(spark, tmp_path / "stripe")
    rows = {r.resolution: (r.a, r.z) for r in stripe.groupBy("resolution").agg(F.min("y").alias("a"), F.max("y").alias("z")).collect()}
    assert rows == {"1km": (6, 17), "2km": (3, 8)}
    window = ((F.col("resolution") == "1km") & F.col("y").between(6, 17)) | (
        (F.col("resolution") == "2km") & F.col("y").between(3, 8)
    )
    assert diff.equal_cubes(scan(spark, full).filter(window), stripe, PIXEL)
    with pytest.raises(ConfigurationError, match="stripe is 'chunks 2 to 2', not None"):
        run(spark, source, tmp_path / "stripe", existing="force")
    y = spark.read.parquet(f"{tmp_path}/stripe/axis_y").groupBy("resolution").count().collect()
    assert {r.resolution: r["count"] for r in y} == {"1km": 12, "2km": 6}


def test_channels_and_flags(spark, tmp_path):
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    run(spark, source, tmp_path / "cube", channels="vis_06", include_pixel_time=False, include_calibration=False)
    rows = scan(spark, tmp_path / "cube")
    assert "pixel_time" not in rows.columns
    assert {r.channel for r in rows.select("channel").distinct().collect()} == {"vis_06"}
    assert cube.open_table(spark, str(tmp_path / "cube"), "slot_channel") is None


def test_flat_cube(spark, tmp_path):
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    run(spark, s.write_parts(tmp_path / "part", (1, 2)), tmp_path / "flat", flat=True, resolutions="1km")
    run(spark, source, tmp_path / "flat", flat=True, resolutions="1km", existing="force")
    assert scan(spark, tmp_path / "flat").count() == 48
    with pytest.raises(ConfigurationError, match="layout is 'flat'"):
        run(spark, source, tmp_path / "flat", existing="force")
    with pytest.raises(ConfigurationError, match="grid is 'FDHSI_1km'"):
        run(spark, source, tmp_path / "flat", flat=True, resolutions="2km", existing="force")


def test_bad_files_fail_their_scene_only(spark, tmp_path):
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    (source / s.name(1, cycle=2)).write_text("broken")
    (source / s.name(2, cycle=3)).write_text('{"number": 2}')
    metrics = run(spark, source, tmp_path / "cube")
    assert metrics == {"files_processed": 2, "files_failed": 1, "count": 3}
    assert {r.slot for r in scan(spark, tmp_path / "cube").select("slot").distinct().collect()} == {0, 2}


def test_a_range_of_slots_decodes_no_other_scene(spark, full, tmp_path):
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    (source / s.name(1, cycle=2)).write_text("never decoded")
    (source / s.name(1, cycle=1, start="20240105000001")).write_text("never opened")
    config = CubeConfig("FDHSI", time_epoch=EPOCH, include_geolocation=False)
    metrics = ingest(spark, str(source), config, str(tmp_path / "cube"), s.decoder, slots=(0, 1))
    assert metrics == {"files_processed": 1, "files_failed": 0, "count": 1}
    assert diff.equal_cubes(scan(spark, full), scan(spark, tmp_path / "cube"), PIXEL)
    log = cube.run_signature(spark.read.parquet(f"{tmp_path}/cube/ingest_log")).first()
    assert log.resolutions == '["1km","2km"]'


def test_slots_cover_the_day_after_their_last():
    assert scenes.day_glob((0, 144), "2024-02-28") == "{20240228,20240229}"
    assert scenes.day_glob((143, 145), "2024-02-28") == "{20240228,20240229,20240301}"


def test_corrupt_zip_is_counted(spark, tmp_path):
    source = s.zip_parts(tmp_path / "in", (1, 2, 3))
    (source / "W_XX-FCI-1C-RRAD-FDHSI-FD-20240101001000-END.zip").write_text("not-a-real-zip")
    metrics = run(spark, source, tmp_path / "cube")
    assert metrics == {"files_processed": 1, "files_failed": 1, "count": 2}


def test_two_scenes_of_one_slot_keep_the_later(spark, tmp_path):
    source = s.zip_parts(tmp_path / "in", (1, 2, 3))
    (source / "W_XX-FCI-1C-RRAD-FDHSI-FD-20240101000500-END.zip").write_bytes(
        next(source.iterdir()).read_bytes()
    )
    run(spark, source, tmp_path / "cube")
    assert scan(spark, tmp_path / "cube").count() == 60
    times = spark.read.parquet(f"{tmp_path}/cube/slot_meta").select("time").distinct().collect()
    assert [str(r.time) for r in times] == ["2024-01-01 00:05:00"]


def test_mixed_and_foreign_inputs_fail(spark, tmp_path):
    source = s.write_parts(tmp_path / "in", (1,))
    (source / s.name(2, product="HRFI")).write_text("x")
    with pytest.raises(ConfigurationError, match="1 input file.s. are not FDHSI"):
        run(spark, source, tmp_path / "cube")
    s.zip_parts(source / "zips", (1,))
    with pytest.raises(ConfigurationError, match="mixed input"):
        run(spark, source, tmp_path / "cube")


def test_select_by_time(spark, tmp_path):
    run(spark, s.write_parts(tmp_path / "in", (1,)), tmp_path / "cube")
    rows = scan(spark, tmp_path / "cube", resolutions=["1km"])
    assert cube.select_time(spark, str(tmp_path / "cube"), rows, "2024-01-01T00:00:00").count() == 16
    assert cube.select_time(spark, str(tmp_path / "cube"), rows, "2024-01-01T00:10:00").isEmpty()


def test_fill_audit(spark, tmp_path):
    source, path = s.write_parts(tmp_path / "in", (1,)), str(tmp_path / "cube")
    run(spark, source, path)
    config = CubeConfig("FDHSI", time_epoch=EPOCH, include_geolocation=False)
    assert audit.fix_fills(spark, path, config, apply=True).isEmpty()
    stored = spark.read.parquet(f"{path}/attributes")
    is_counts = (F.col("variable") == "counts") & (F.col("attribute") == "_FillValue")

    def older(name, rows):
        rows.write.parquet(f"{tmp_path}/{name}/attributes")
        return f"{tmp_path}/{name}"

    lacking = older("lacking", stored.filter(~is_counts))
    assert audit.fix_fills(spark, lacking, config).count() == 2
    assert audit.fix_fills(spark, lacking, config, apply=True).count() == 2
    assert audit.fix_fills(spark, lacking, config, apply=True).isEmpty()
    wrong = older("wrong", stored.withColumn("value", F.when(is_counts, "7").otherwise(F.col("value"))))
    with pytest.raises(ConfigurationError, match="data_1km/counts: 7, expected 65535"):
        audit.fix_fills(spark, wrong, config, apply=True)
    root = stored.limit(1).withColumn("group", F.lit(group_name("1km", flat=True)))
    with pytest.raises(ConfigurationError, match="mixed layout"):
        audit.audit_cube(spark, older("mixed", stored.unionByName(root)), config)
    with pytest.raises(ConfigurationError, match="unknown layout"):
        audit.audit_cube(spark, str(tmp_path / "nothing"), config)


def test_second_resolution_joins_the_cube(spark, tmp_path):
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    path = tmp_path / "cube"
    run(spark, source, path, resolutions="1km")
    run(spark, source, path, resolutions="2km")
    assert scan(spark, path).groupBy("resolution").count().count() == 2
    for table in ("channels", "axis_x", "axis_y", "slot_meta"):
        stored = spark.read.parquet(f"{path}/{table}").select("resolution").distinct().collect()
        assert {r.resolution for r in stored} == {"1km", "2km"}, table
    groups = spark.read.parquet(f"{path}/attributes").select("group").distinct().collect()
    assert {r.group for r in groups} == {"data_1km", "data_2km"}


def test_unreadable_file_fails_its_own_scene_only(spark, tmp_path):
    s.write_parts(tmp_path / "in" / "good", (1, 2, 3))
    bad = s.write_parts(tmp_path / "in" / "bad", (1, 2, 3), cycle=2)
    (bad / s.name(2, cycle=2)).write_text("not a chunk")
    metrics = run(spark, tmp_path / "in", tmp_path / "cube", partial_chunk="error")
    assert metrics == {"files_processed": 1, "files_failed": 1, "count": 2}
    assert {r.slot for r in scan(spark, tmp_path / "cube").select("slot").distinct().collect()} == {0}
