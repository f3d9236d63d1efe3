"""Listing, archives and scene grouping."""

import io
import zipfile

import pytest
import small_scene as s
from pyspark.errors import PySparkException

from orbitlake.operators import scenes
from orbitlake.sources.archives import unpack_archives
from orbitlake.sources.files import list_inputs


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for member, data in members.items():
            archive.writestr(member, data)
    return buffer.getvalue()


ARCHIVES = {
    "good.zip": zipped({"a/x.nc": b"x" * 10, "y.nc": b"y"}),
    "evil.zip": zipped({"../escape.nc": b"z"}),
    "corrupt.zip": b"not-a-real-zip",
}


@pytest.mark.parametrize("by_content", [True, False])
def test_bad_archives_fail_alone(spark, tmp_path, by_content):
    for name, data in ARCHIVES.items():
        (tmp_path / name).write_bytes(data)
    listed = list_inputs(spark, str(tmp_path), content=by_content)
    found = {(r.archive.split("/")[-1], r.name): r for r in unpack_archives(listed).collect()}
    assert set(found) == {("good.zip", "a/x.nc"), ("good.zip", "y.nc"), ("evil.zip", None), ("corrupt.zip", None)}
    assert bytes(found[("good.zip", "a/x.nc")].content) == b"x" * 10
    assert "unsafe member path" in found[("evil.zip", None)].error


def test_filters(spark, tmp_path):
    for name in ("a.nc", "b.zip", "c.jpg"):
        (tmp_path / name).write_text("x")

    def names(*filters):
        return sorted(r.name for r in list_inputs(spark, str(tmp_path), filters).collect())

    assert names() == ["a.nc", "b.zip", "c.jpg"]
    assert names("!*.zip") == ["a.nc", "c.jpg"]
    assert names("*.nc", "*.zip", "!b*") == ["a.nc"]
    assert "content" not in list_inputs(spark, str(tmp_path)).columns


def chunks(spark, *names):
    rows = [(n, 10 if i else None) for i, n in enumerate(names)]
    return scenes.classify_items(spark.createDataFrame(rows, "path string, length bigint"))


def test_scene_members_are_ordered(spark):
    items = chunks(
        spark, "z/" + s.name(2), "a/" + s.name(41, kind="TRAIL"), "s3://b/" + s.name(1), s.name(3, cycle=2)
    )
    found = scenes.bundle_scenes(scenes.parse_chunks(items)).orderBy("scene_id").collect()
    assert [f.scene_id for f in found] == ["fci-scene://FDHSI/20240101000000", "fci-scene://FDHSI/20240101001000"]
    assert [m.chunk_no for m in found[0].members] == [1, 2, 41]
    assert found[0].members[0].path == "s3://b/" + s.name(1)
    assert found[0].size_bytes is None and found[1].size_bytes == 10


def test_duplicate_chunk_numbers_fail(spark):
    other = s.name(1, start="20240101000009")
    items = chunks(spark, s.name(1), other)
    with pytest.raises(PySparkException, match="duplicate chunk number 0001"):
        scenes.bundle_scenes(scenes.parse_chunks(items)).collect()
    found = scenes.bundle_scenes(scenes.parse_chunks(items), strict=False).first()
    assert found.n_duplicates == 1 and [m.name for m in found.members] == [s.name(1)]
    assert scenes.duplicate_chunks(scenes.parse_chunks(items)).first().other_name == other


def test_unreadable_chunk_names_fail(spark):
    items = chunks(spark, "FCI-1C-RRAD-FDHSI-FD--CHK-BODY---NC4E_garbage.nc")
    with pytest.raises(PySparkException, match="cannot parse chunk file name"):
        scenes.bundle_scenes(scenes.parse_chunks(items)).collect()
    assert scenes.parse_chunks(items, strict=False).isEmpty()


def test_equal_part_numbers_are_named(spark):
    rows = [("s", s.name(1)), ("s", s.name(1, start="20240101000009")), ("t", s.name(1)), ("t", "x/" + s.name(1))]
    members = spark.createDataFrame(rows, "scene_id string, name string")
    assert [r.scene_id for r in scenes.equal_parts(members).collect()] == ["s"]
    order = scenes.order_parts(members).filter("scene_id = 's'").orderBy("position").collect()
    assert [r.position for r in order] == [1, 2]
