"""Archives read member by member: what is opened, what is read, what fails."""

import json
import os
import zipfile
from pathlib import Path

import pytest
import small_scene as s
from pyspark.sql import functions as F

from orbitlake import CubeConfig
from orbitlake.ingest import ingest, read_scenes
from orbitlake.operators import diff
from orbitlake.sources import archives, cube

EPOCH = "2024-01-01"
PIXEL = ("counts", "pixel_quality", "pixel_time")


@pytest.fixture(autouse=True, scope="module")
def small_grid():
    with pytest.MonkeyPatch.context() as patch:
        s.shrink(patch)
        yield


def watched(folder):
    """An opener that notes each range it reads, as offset and length."""
    folder.mkdir()

    def opener(path):
        class Handle:
            def __init__(self):
                self.inner = open(path.removeprefix("file:"), "rb")

            def read(self, size=-1):
                at = self.inner.tell()
                data = self.inner.read(size)
                with open(folder / f"{os.getpid()}", "a") as log:
                    log.write(f"{at} {len(data)}\n")
                return data

            def __getattr__(self, name):
                return getattr(self.inner, name)

            def __enter__(self):
                return self

            def __exit__(self, *_):
                self.inner.close()

        return Handle()

    return opener


def ranges(folder):
    lines = [line.split() for f in folder.iterdir() for line in f.read_text().splitlines()]
    return [(int(a), int(n)) for a, n in lines]


def stored_zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as archive:
        for name, data in members.items():
            archive.writestr(name, data)


def paths(spark, *found):
    return spark.createDataFrame([(f"file:{p}",) for p in found], "path string")


def test_only_members_asked_for_are_read(spark, tmp_path):
    members = {f"part/{i:04d}.nc": bytes([i]) * 200_000 for i in range(20)}
    stored_zip(tmp_path / "big.zip", members)
    seen = tmp_path / "seen"
    entries = archives.list_members(paths(spark, tmp_path / "big.zip"), watched(seen))
    assert {r.name: r.length for r in entries.collect()} == {n: 200_000 for n in members}
    # The directory alone: far less than one member.
    assert sum(n for _at, n in ranges(seen)) < 100_000
    seen = tmp_path / "more"
    wanted = entries.filter(F.col("name").isin("part/0003.nc", "part/0017.nc"))
    found = {r.name: bytes(r.content) for r in archives.read_members(wanted, watched(seen)).collect()}
    assert found == {n: members[n] for n in ("part/0003.nc", "part/0017.nc")}
    offsets = {r.name: r.offset for r in entries.collect()}
    bodies = [(at, n) for at, n in ranges(seen) if n > 100]
    for name, start in offsets.items():
        inside = sum(n for at, n in bodies if start < at < start + 200_000)
        assert inside == (200_000 if name in found else 0), name


def test_members_are_dealt_to_tasks(spark, tmp_path, monkeypatch):
    stored_zip(tmp_path / "big.zip", {f"{i}.nc": bytes([i]) * 1000 for i in range(40)})
    monkeypatch.setattr(archives, "BYTES_PER_TASK", 5000)
    rows = archives.unpack_archives(paths(spark, tmp_path / "big.zip"))
    placed = rows.withColumn("task", F.spark_partition_id()).collect()
    assert len(placed) == 40 and len({r.task for r in placed}) > 4
    assert all(bytes(r.content) == bytes([int(r.name[:-3])]) * 1000 for r in placed)


def test_a_damaged_member_fails_alone(spark, tmp_path, monkeypatch):
    stored_zip(tmp_path / "a.zip", {"x.nc": b"x" * 500, "y.nc": b"y" * 500, "z.nc": b"z" * 900})
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[data.index(b"y" * 500) + 7] = 0
    (tmp_path / "a.zip").write_bytes(bytes(data))
    (tmp_path / "not.zip").write_bytes(b"no archive")
    (tmp_path / "none.zip").write_bytes(b"")
    stored_zip(tmp_path / "empty.zip", {})
    listed = paths(spark, *(tmp_path / f"{n}.zip" for n in ("a", "not", "none", "empty", "absent")))
    monkeypatch.setattr(archives, "LARGEST_MEMBER", 800)
    found = {(r.archive.split("/")[-1], r.name): r for r in archives.unpack_archives(listed).collect()}
    assert set(found) == {
        ("a.zip", "x.nc"), ("a.zip", "y.nc"), ("a.zip", "z.nc"),
        ("not.zip", None), ("none.zip", None), ("absent.zip", None),
    }
    assert bytes(found["a.zip", "x.nc"].content) == b"x" * 500
    assert "CRC" in found["a.zip", "y.nc"].error and found["a.zip", "y.nc"].content is None
    assert "does not fit a row" in found["a.zip", "z.nc"].error
    assert archives.unpack_archives(listed.limit(0)).count() == 0


def test_paths():
    with pytest.raises(OSError):
        archives.open_ranged("file:///no/such/file")
    with pytest.raises(OSError):
        archives.open_ranged("/no/such/file")


def config(**options):
    return CubeConfig("FDHSI", time_epoch=EPOCH, include_geolocation=False, **options)


def counting(folder):
    folder.mkdir()

    def decode(name, content, wanted):
        (folder / Path(name).name).write_text("opened")
        yield from s.decoder(name, content, wanted)

    return decode


def test_archives_above_the_row_limit_are_ingested(spark, tmp_path):
    """A limit on rows of whole files, as an archive of 2 GiB meets it, does not touch members."""
    source = s.zip_parts(tmp_path / "zip", (1, 2, 3))
    size = next(source.iterdir()).stat().st_size
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", size - 1)
    try:
        ingest(spark, str(source), config(), str(tmp_path / "a"), s.decoder)
        seen = tmp_path / "seen"
        opener = watched(seen)
        ingest(spark, str(source), config(), str(tmp_path / "b"), s.decoder, opener=opener)
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    loose = s.write_parts(tmp_path / "loose", (1, 2, 3))
    ingest(spark, str(loose), config(), str(tmp_path / "c"), s.decoder)
    scans = [cube.read_cube(spark, str(tmp_path / n)) for n in "abc"]
    assert diff.equal_cubes(scans[0], scans[2], PIXEL) and diff.equal_cubes(scans[1], scans[2], PIXEL)
    assert ranges(seen)


def test_resume_reads_the_members_left(spark, tmp_path):
    path = str(tmp_path / "cube")
    ingest(spark, str(s.write_parts(tmp_path / "part", (1, 3))), config(), path, s.decoder)
    source = s.zip_parts(tmp_path / "zip", (1, 2, 3))
    seen = tmp_path / "seen"
    ingest(spark, str(source), config(), path, counting(seen), existing="resume")
    assert sorted(int(p.name[-7:-3]) for p in seen.iterdir()) == [2]
    whole = str(tmp_path / "whole")
    ingest(spark, str(source), config(), whole, s.decoder)
    got, wanted = (cube.read_cube(spark, p) for p in (path, whole))
    assert diff.equal_cubes(got.drop("pixel_time"), wanted.drop("pixel_time"), PIXEL[:2])


def test_other_members_are_not_read(spark, tmp_path):
    source = tmp_path / "zip"
    source.mkdir()
    noise = {"inner/preview.jpg": b"j" * 300_000}
    chunks = {"inner/" + s.name(n): json.dumps({"number": n}).encode() for n in (1, 2, 3)}
    stored_zip(source / "W_XX-FCI-1C-RRAD-FDHSI-FD-20240101000000-END.zip", noise | chunks)
    seen = tmp_path / "seen"
    _found, decoded = read_scenes(spark, str(source), config(), s.decoder, opener=watched(seen))
    assert decoded.members.count() == 3 and decoded.errors.isEmpty()
    assert sum(n for _at, n in ranges(seen)) < 150_000
