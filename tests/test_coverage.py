"""Row coverage: pinned cases and brute force on random scenes."""

import random

import pytest

from orbitlake import CubeConfig
from orbitlake import constants as K
from orbitlake.operators import coverage

SCHEMA = "scene_id string, product_type string, resolution string, chunk_no int, row_start int, row_stop int"


def parts(spark, chunks, resolution="1km", scene="s"):
    ends = [0, *K.CHUNK_ROW_ENDS[("FDHSI", resolution)]]
    rows = [(scene, "FDHSI", resolution, n, ends[n - 1], ends[n]) for n in chunks]
    return spark.createDataFrame(rows, SCHEMA)


def spans(df, kind):
    found = df.filter(df.kind == kind).orderBy("start").collect()
    return [(r.start, r.stop) for r in found]


def test_single_chunk_in_error_mode(spark):
    found = coverage.partial_problems(
        coverage.attach_grid(parts(spark, [32])), staged=False, partial_chunk="error"
    ).collect()
    assert len(found) == 1
    assert "rows [8618, 8649), [8908, 9174); missing BODY chunk(s) 31, 33" in found[0].error


def test_stripe_start_in_error_mode(spark):
    config = CubeConfig("FDHSI", body_chunks=(32, 40))
    found = coverage.partial_problems(
        coverage.attach_grid(parts(spark, range(32, 41)), config), staged=False, partial_chunk="error"
    ).first()
    assert "rows [8618, 8649); missing BODY chunk(s) 31" in found.error


def test_missing_middle_chunk_splits_a_tile(spark):
    config = CubeConfig("FDHSI", tile_overrides=(("1km", 556),))
    covered = coverage.tile_coverage(coverage.attach_grid(parts(spark, [30, 32]), config))
    assert spans(covered, "run") == [(8133, 8340), (8340, 8391), (8649, 8896), (8896, 8908)]
    assert spans(covered, "gap") == [(7784, 8133), (8391, 8649), (8908, 9452)]


def test_full_disk_has_no_gaps(spark):
    grid = coverage.attach_grid(parts(spark, range(1, 41), "2km"))
    assert coverage.uncovered_rows(grid).isEmpty()
    assert coverage.overlap_guard(grid).isEmpty()
    assert coverage.exact_tiling(grid).first().exact
    assert coverage.partial_problems(grid, staged=True, partial_chunk="error").isEmpty()


def test_staged_needs_the_window_only(spark):
    config = CubeConfig("FDHSI", body_chunks=(32, 40))
    whole = coverage.attach_grid(parts(spark, range(31, 41)), config)
    assert coverage.partial_problems(whole, staged=True, partial_chunk="fill").isEmpty()
    partial = coverage.attach_grid(parts(spark, range(32, 41)), config)
    assert coverage.partial_problems(partial, staged=True, partial_chunk="fill").count() == 1
    assert coverage.partial_problems(partial, staged=False, partial_chunk="fill").isEmpty()


def test_parts_outside_the_window_do_not_matter(spark):
    config = CubeConfig("FDHSI", body_chunks=(32, 40))
    assert coverage.tile_coverage(coverage.attach_grid(parts(spark, [1, 2]), config)).isEmpty()
    assert coverage.uncovered_rows(coverage.attach_grid(parts(spark, [1, 2]), config)).isEmpty()


def test_chunk_numbers_must_fit_the_row_table(spark):
    rows = [
        ("s", "FDHSI", "1km", 1, 0, 278),
        ("s", "FDHSI", "1km", 2, 278, 555),
        ("s", "FDHSI", "1km", 41, 0, 1),
        ("s", "FDHSI", "1km", None, 0, 1),
    ]
    found = coverage.check_body_rows(spark.createDataFrame(rows, SCHEMA)).select("chunk_no", "error")
    errors = {r.chunk_no: r.error for r in found.collect()}
    assert errors == {
        1: None,
        2: "chunk 2 holds rows [278, 555), expected [278, 556)",
        41: "chunk number outside 1..40",
        None: "unreadable chunk number",
    }


@pytest.mark.parametrize("seed", range(3))
def test_random_scenes_against_brute_force(spark, seed):
    rng = random.Random(seed)
    size, height = 60, 7
    scenes, rows = {}, []
    for scene in range(40):
        spans_ = []
        for _ in range(rng.randint(1, 6)):
            start = rng.randrange(0, size)
            spans_.append((start, min(size, start + rng.randint(-2, 12))))
        scenes[str(scene)] = spans_
        rows += [(str(scene), "1km", a, max(z, 0), 0, size, height) for a, z in spans_]
    schema = "scene_id string, resolution string, row_start int, row_stop int, y_start int, y_stop int, tile_rows int"
    grid = spark.createDataFrame(rows, schema)

    def islands(values):
        out = []
        for v in sorted(values):
            if out and out[-1][1] == v:
                out[-1][1] = v + 1
            else:
                out.append([v, v + 1])
        return [tuple(o) for o in out]

    tile_spans, gaps, bad, exact = set(), set(), set(), {}
    for scene, items in scenes.items():
        items = [(a, max(z, 0)) for a, z in items]
        covered = {y for a, z in items for y in range(a, z)}
        for first in range(0, size, height):
            tile = set(range(first, min(first + height, size)))
            if tile & covered:
                tile_spans |= {(scene, first // height, "run", *i) for i in islands(tile & covered)}
                tile_spans |= {(scene, first // height, "gap", *i) for i in islands(tile - covered)}
        if covered:
            gaps |= {(scene, *i) for i in islands(set(range(size)) - covered)}
        lengths = sum(max(z - a, 0) for a, z in items)
        empty = any(
            z <= a and any(t < z and min(t + height, size) > a for t in range(0, size, height))
            for a, z in items
        )
        if lengths > len(covered) or empty:
            bad.add(scene)
        exact[scene] = all(z > a for a, z in items) and lengths == len(covered) == size

    got = coverage.tile_coverage(grid).collect()
    assert {(r.scene_id, r.tile, r.kind, r.start, r.stop) for r in got} == tile_spans
    got = coverage.uncovered_rows(grid).collect()
    assert {(r.scene_id, r.gap_start, r.gap_stop) for r in got} == gaps
    assert {r.scene_id for r in coverage.overlap_guard(grid).collect()} == bad
    assert {r.scene_id: r.exact for r in coverage.exact_tiling(grid).collect()} == exact
