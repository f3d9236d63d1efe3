"""Row runs, resume before decoding, options of stored slots, retries, merges by tile."""

import random
from pathlib import Path

import pytest
import small_scene as s
from pyspark.sql import functions as F

from orbitlake import ConfigurationError, CubeConfig
from orbitlake.ingest import ingest
from orbitlake.operators import diff
from orbitlake.operators.intervals import left_of, merge_runs
from orbitlake.sources import cube, ledger

EPOCH = "2024-01-01"
PIXEL = ("counts", "pixel_quality", "pixel_time")


@pytest.fixture(autouse=True, scope="module")
def small_grid():
    with pytest.MonkeyPatch.context() as patch:
        s.shrink(patch)
        yield


def run(spark, source, path, **options):
    split = {k: options.pop(k) for k in ("write_mode", "existing", "retry") if k in options}
    decoder = options.pop("decoder", s.decoder)
    config = CubeConfig("FDHSI", time_epoch=EPOCH, include_geolocation=False, **options)
    return ingest(spark, str(source), config, str(path), decoder, **split)


def counting(folder):
    """A decoder that leaves a mark for each file it opens, wherever it runs."""
    folder.mkdir()

    def decode(name, content, wanted):
        (folder / name).write_text("opened")
        yield from s.decoder(name, content, wanted)

    return decode


def opened(folder):
    return sorted(int(p.name[-7:-3]) for p in folder.iterdir())


def test_runs_against_sets_of_rows(spark):
    rng = random.Random(1)

    def some(n, *more):
        rows = []
        for _ in range(n):
            start = rng.randrange(60)
            rows.append((rng.choice("ab"), start, start + rng.randrange(0, 12), *more))
        return rows

    covered, wanted = some(25), [(*r, i) for i, r in enumerate(some(40))]
    covers = spark.createDataFrame(covered, "k string, row_start int, row_stop int")
    merged = merge_runs(covers, ["k"]).collect()
    for key in "ab":
        rows = {y for k, a, z in covered if k == key for y in range(a, z)}
        own = sorted((r.row_start, r.row_stop) for r in merged if r.k == key)
        assert {y for a, z in own for y in range(a, z)} == rows
        assert all(z < a for (_, z), (a, _) in zip(own, own[1:]))
    left = left_of(spark.createDataFrame(wanted, "k string, row_start int, row_stop int, id int"), covers, ["k"])
    found = {}
    for r in left.collect():
        assert r.row_start < r.row_stop
        found.setdefault(r.id, []).extend(range(r.row_start, r.row_stop))
    for k, a, z, i in wanted:
        rows = {y for key, b, c in covered if key == k for y in range(b, c)}
        assert sorted(found.get(i, [])) == sorted(set(range(a, z)) - rows)


def test_resume_opens_what_is_left(spark, tmp_path):
    whole = s.write_parts(tmp_path / "whole", (1, 2, 3))
    run(spark, s.write_parts(tmp_path / "part", (1, 3)), tmp_path / "cube")
    seen = tmp_path / "seen"
    metrics = run(spark, whole, tmp_path / "cube", existing="resume", decoder=counting(seen))
    assert opened(seen) == [2] and metrics["files_processed"] == 1
    run(spark, whole, tmp_path / "direct")
    stored = [cube.read_cube(spark, str(tmp_path / p)) for p in ("cube", "direct")]
    assert diff.equal_cubes(*stored, ["counts", "pixel_quality"])
    again = tmp_path / "again"
    metrics = run(spark, whole, tmp_path / "cube", existing="resume", decoder=counting(again))
    assert opened(again) == [] and metrics == {"files_processed": 0, "files_failed": 0, "count": 0}
    # Another scene, of which nothing is stored, is read whole.
    s.write_parts(whole / "next", (1, 2), cycle=2)
    more = tmp_path / "more"
    run(spark, whole, tmp_path / "cube", existing="resume", decoder=counting(more))
    assert opened(more) == [1, 2]


def test_resume_of_an_archive(spark, tmp_path):
    archive = s.zip_parts(tmp_path / "zip", (1, 2, 3))
    run(spark, archive, tmp_path / "cube")
    seen = tmp_path / "seen"
    run(spark, archive, tmp_path / "cube", existing="resume", decoder=counting(seen))
    assert opened(seen) == []


def test_resume_needs_the_same_options(spark, tmp_path):
    part, whole = s.write_parts(tmp_path / "part", (1,)), s.write_parts(tmp_path / "whole", (1, 2, 3))
    run(spark, part, tmp_path / "cube", partial_chunk="fill")
    with pytest.raises(ConfigurationError, match="stored with other options.* slot 0 of 1km"):
        run(spark, whole, tmp_path / "cube", existing="resume", channels="vis_04")
    # Whether partial tiles are refused does not change what is stored.
    run(spark, whole, tmp_path / "cube", existing="resume", partial_chunk="error")
    assert cube.read_cube(spark, str(tmp_path / "cube")).count() == 60
    # A forced run replaces what was there, and its options count from now on.
    run(spark, whole, tmp_path / "cube", existing="force", include_pixel_time=True, pixel_time_dtype="float32")
    latest = ledger.latest_signatures(ledger.covered_runs(spark, str(tmp_path / "cube"))).collect()
    assert len({r.stored for r in latest}) == 1
    want = ledger.signature_digest(CubeConfig("FDHSI", time_epoch=EPOCH, include_geolocation=False))
    assert latest[0].stored != want


def test_retry_reads_failed_scenes_only(spark, tmp_path):
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    s.write_parts(source / "two", (1, 2, 3), cycle=2)
    broken = source / "two" / s.name(2, cycle=2)
    good = broken.read_text()
    broken.write_text("not a chunk")
    assert run(spark, source, tmp_path / "cube")["files_failed"] == 1
    log = spark.read.parquet(f"{tmp_path}/cube/scenes")
    failed = ledger.scenes_to_retry(log).collect()
    assert len(failed) == 1 and "0002.nc" in failed[0].error
    broken.write_text(good)
    seen = tmp_path / "seen"
    metrics = run(spark, source, tmp_path / "cube", retry=True, decoder=counting(seen))
    assert metrics == {"files_processed": 1, "files_failed": 0, "count": 1}
    assert {p.name for p in seen.iterdir()} == {s.name(n, cycle=2) for n in (1, 2, 3)}
    assert ledger.scenes_to_retry(spark.read.parquet(f"{tmp_path}/cube/scenes")).isEmpty()
    assert cube.read_cube(spark, str(tmp_path / "cube")).count() == 120
    with pytest.raises(ConfigurationError, match="no earlier run"):
        run(spark, source, tmp_path / "none", retry=True)


@pytest.mark.parametrize("flat", [False, True])
def test_a_late_part_swaps_its_tiles(spark, tmp_path, flat):
    options = {"flat": flat, "resolutions": "1km"}
    run(spark, s.write_parts(tmp_path / "first", (1, 3)), tmp_path / "cube", **options)

    def files():
        found = Path(tmp_path / "cube" / "scanlines").rglob("*.parquet")
        return {p: p.stat().st_mtime_ns for p in found}

    before = files()
    # Rows 8 to 15 in tiles of three rows: 2 to 5.
    run(spark, s.write_parts(tmp_path / "late", (2,)), tmp_path / "cube", existing="force", **options)
    after = files()
    kept = {p for p in before if after.get(p) == before[p]}
    tiles = {int(p.parent.name.split("=")[1]) for p in kept}
    assert tiles == {0, 1, 6, 7}
    changed = {int(p.parent.name.split("=")[1]) for p in set(after) - kept}
    assert changed == {2, 3, 4, 5}
    assert cube.read_cube(spark, str(tmp_path / "cube")).count() == 48
    rows = cube.read_cube(spark, str(tmp_path / "cube"), rows=(4, 7))
    assert {r.y for r in rows.collect()} == {4, 5, 6}
    assert {r.tile for r in rows.select("tile").distinct().collect()} == {1, 2}
    assert "tile" in rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_tiles_of_another_height_are_refused(spark, tmp_path):
    source = s.write_parts(tmp_path / "in", (1,))
    run(spark, source, tmp_path / "cube")
    with pytest.raises(ConfigurationError, match="tiles is"):
        run(spark, source, tmp_path / "cube", existing="force", tile_rows=6)
    plain = spark.createDataFrame(
        [("FDHSI", "1km", 0, "vis_04", 0, [1])],
        "product_type string, resolution string, slot bigint, channel string, y int, counts array<int>",
    )
    with pytest.raises(ConfigurationError, match="must both have tiles"):
        cube.merge_into(spark, plain, str(tmp_path / "cube"))
    assert cube.read_cube(spark, str(tmp_path / "cube")).where(F.col("tile") == 9).isEmpty()
