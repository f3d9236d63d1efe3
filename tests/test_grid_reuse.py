"""Exported grids, longitudes and their reuse by an ingest."""

import json

import numpy as np
import pytest
import small_scene as s
from pyspark.sql import functions as F

from orbitlake import ConfigurationError, CubeConfig
from orbitlake.ingest import ingest
from orbitlake.plans import catalog
from orbitlake.sources import grids

EPOCH = "2024-01-01"


@pytest.fixture(autouse=True, scope="module")
def small_grid():
    with pytest.MonkeyPatch.context() as patch:
        s.shrink(patch)
        yield


def config(**options):
    return CubeConfig("FDHSI", time_epoch=EPOCH, **options)


def run(spark, source, path, existing="error", grid=None, **options):
    return ingest(
        spark, str(source), config(**options), str(path), s.decoder, existing=existing, grid=grid
    )


def lines(df):
    return {
        (r.resolution, r.y): (r.latitude, r.longitude)
        for r in df.select("resolution", "y", "latitude", "longitude").collect()
    }


def marked(spark, path, resolution, rows, lon0, value):
    """Lines of exported grids that no computation gives."""
    size = s.LAYOUT["FDHSI", resolution][1]
    rows = spark.range(*rows).select(
        F.col("id").cast("int").alias("y"),
        F.array_repeat(F.lit(value).cast("float"), size).alias("latitude"),
        F.array_repeat(F.lit(-value).cast("float"), size).alias("longitude"),
        F.lit(lon0).alias("lon0"),
        F.lit(resolution).alias("resolution"),
    )
    rows.write.partitionBy("lon0", "resolution").mode("append").parquet(path)


def test_grids_of_several_longitudes_share_a_path(spark, tmp_path):
    path = str(tmp_path / "grid")
    for lon0 in (0.0, 9.5):
        grids.export_geo(spark, ["1km", "2km"], path, lon0=lon0)
    for lon0 in (0.0, 9.5):
        for resolution in ("1km", "2km"):
            stored = lines(grids.exported_lines(spark, path, resolution, lon0))
            assert stored == lines(grids.geo_rows(spark, resolution, lon0=lon0))
    assert grids.exported_lines(spark, path, "1km", -3.0).isEmpty()
    assert grids.exported_lines(spark, str(tmp_path / "none"), "1km") is None
    with pytest.raises(ConfigurationError, match="are there already"):
        grids.export_geo(spark, ["2km"], path, lon0=9.5)
    grids.export_geo(spark, ["2km"], path, lon0=9.5, overwrite=True)
    assert spark.read.parquet(path).count() == 2 * (24 + 12)


def test_missing_lines_are_computed(spark, tmp_path):
    path = str(tmp_path / "grid")
    marked(spark, path, "2km", (2, 5), 9.5, 1.25)
    marked(spark, path, "2km", (5, 9), 0.0, 3.5)
    # Lines of another grid under the name of this one have another length.
    spark.range(7, 8).select(
        F.col("id").cast("int").alias("y"),
        F.array(F.lit(7.0).cast("float")).alias("latitude"),
        F.array(F.lit(7.0).cast("float")).alias("longitude"),
        F.lit(9.5).alias("lon0"),
        F.lit("2km").alias("resolution"),
    ).write.partitionBy("lon0", "resolution").mode("append").parquet(path)
    found = lines(grids.known_or_computed(spark, path, "2km", (1, 10), 9.5))
    plain = lines(grids.geo_rows(spark, "2km", (1, 10), 9.5))
    assert found.keys() == plain.keys()
    for (resolution, y), arrays in found.items():
        wanted = ([1.25] * 12, [-1.25] * 12) if 2 <= y < 5 else plain[resolution, y]
        assert arrays == wanted


def test_ingest_takes_exported_lines(spark, tmp_path):
    path, cube = str(tmp_path / "grid"), str(tmp_path / "cube")
    marked(spark, path, "1km", (0, 24), 9.5, 2.5)
    source = s.write_parts(tmp_path / "in", (1, 2, 3))
    run(spark, source, cube, lon0=9.5, grid=path)
    geo = lines(spark.read.parquet(f"{cube}/geo"))
    assert len(geo) == 24 + 12
    assert all(geo["1km", y] == ([2.5] * 24, [-2.5] * 24) for y in range(24))
    computed = lines(grids.geo_rows(spark, "2km", lon0=9.5))
    assert {k: v for k, v in geo.items() if k[0] == "2km"} == computed
    # A later run has all of its lines already, whatever grids it is given.
    run(spark, source, cube, existing="force", lon0=9.5)
    assert lines(spark.read.parquet(f"{cube}/geo")) == geo
    with pytest.raises(ConfigurationError, match="lon0 is 9.5, not 0.0"):
        run(spark, source, cube, existing="force")
    mapping = spark.read.parquet(f"{cube}/attributes").where(
        (F.col("variable") == "spatial_ref") & (F.col("attribute") == "longitude_of_projection_origin")
    )
    assert {float(json.loads(r.value)) for r in mapping.collect()} == {9.5}


def test_a_window_reads_its_lines_only(spark, tmp_path):
    path, cube = str(tmp_path / "grid"), str(tmp_path / "cube")
    grids.export_geo(spark, ["1km", "2km"], path, lon0=-75.2)
    options = {"lon0": -75.2, "body_chunks": (2, 2)}
    run(spark, s.write_parts(tmp_path / "in", (2,)), cube, grid=path, **options)
    found = lines(spark.read.parquet(f"{cube}/geo"))
    for resolution in ("1km", "2km"):
        start, stop = catalog.row_window(config(**options), resolution)
        own = {y: v for (r, y), v in found.items() if r == resolution}
        assert sorted(own) == list(range(start, stop))
        computed = lines(grids.geo_rows(spark, resolution, (start, stop), -75.2))
        assert own == {y: v for (_r, y), v in computed.items()}
    seen = [v for _lat, lon in found.values() for v in lon if v is not None]
    assert seen and np.all(np.abs(np.array(seen) + 75.2) < 90)


def test_longitudes_are_checked():
    for lon0 in (181.0, -200.0, float("nan")):
        with pytest.raises(ConfigurationError, match="lon0"):
            config(lon0=lon0)
