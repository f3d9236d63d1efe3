"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlake.functions import geolocation, slots
from orbitlake.operators import audit, coverage, diff, rasters, slot_values
from orbitlake.sources import cube
from workload import tables as t
from workload.registry import query

PIXEL_TIME_SQL = f"""WITH {t.SCAN_SQL}, {t.TIME_SQL}
  SELECT p.y, p.x, l.time_s FROM pixel p
  LEFT JOIN last_rows l ON l.scene_id = p.scene_id AND l.idx = p.idx"""


def _times(spark, sf):
    return rasters.time_map(t.time_rows(spark, sf))


@query("expand_pixel_time", PIXEL_TIME_SQL)
def expand_pixel_time(spark, sf):
    scan = t.scan_in(spark, sf).withColumnRenamed("index_map", "idx")
    pixels = rasters.pixels(scan.select("scene_id", "y", "idx"), "idx")
    pixels = pixels.withColumns({"x": F.col("x").cast("bigint"), "idx": F.col("idx").cast("bigint")})
    return rasters.expand_pixel_time(pixels, _times(spark, sf)).select("y", "x", "time_s")


@query("expand_scanline_time", PIXEL_TIME_SQL)
def expand_scanline_time(spark, sf):
    scan = rasters.attach_time_lut(t.scan_in(spark, sf), rasters.time_lut(_times(spark, sf)))
    times = rasters.expand_scanline_time(F.col("index_map"), F.col("lut"))
    rows = scan.select("y", times.alias("time_s"))
    return rasters.pixels(rows, "time_s").withColumn("x", F.col("x").cast("bigint"))


@query("expand_scanline_time_salted", PIXEL_TIME_SQL)
def expand_scanline_time_salted(spark, sf):
    """The same where scanlines of a scene lie in many partitions."""
    luts = rasters.time_lut(_times(spark, sf))
    scan = rasters.attach_time_lut(t.scan_in(spark, sf).repartition("scene_id", "y"), luts)
    times = rasters.expand_scanline_time(F.col("index_map"), F.col("lut"))
    rows = scan.select("y", times.alias("time_s"))
    return rasters.pixels(rows, "time_s").withColumn("x", F.col("x").cast("bigint"))


@query(
    "parts_in_tile",
    f"""WITH {t.PARTS_SQL}, tile AS (
      SELECT resolution, dimsize, s // tile_rows AS tile, s AS tile_start,
        least(s + tile_rows, dimsize) AS tile_stop
      FROM (SELECT *, unnest(range(0, dimsize, tile_rows)) AS s FROM grid))
      SELECT scene_id, p.resolution, chunk_no, CAST(tile AS INTEGER) AS tile,
        CAST(greatest(row_start, tile_start) AS INTEGER) AS start,
        CAST(least(row_stop, tile_stop) AS INTEGER) AS stop
      FROM parts p JOIN tile k ON k.resolution = p.resolution
        AND k.tile_start < p.row_stop AND k.tile_stop > p.row_start""",
)
def parts_in_tile(spark, sf):
    found = coverage.parts_in_tile(coverage.attach_grid(t.parts(spark, sf)))
    return found.select("scene_id", "resolution", "chunk_no", "tile", "start", "stop")


@query(
    "check_body_rows",
    f"""WITH {t.SHIFTED_SQL} SELECT s.event_id, CASE
        WHEN s.chunk_no IS NULL THEN 'unreadable chunk number'
        WHEN s.chunk_no NOT BETWEEN 1 AND 40 THEN 'chunk number outside 1..40'
        WHEN s.row_start <> b.row_start OR s.row_stop <> b.row_stop THEN
          format('chunk {{}} holds rows [{{}}, {{}}), expected [{{}}, {{}})',
            s.chunk_no, s.row_start, s.row_stop, b.row_start, b.row_stop) END AS error
      FROM shifted s LEFT JOIN body b
        ON b.product_type = 'FDHSI' AND b.resolution = '1km' AND b.chunk_no = s.chunk_no""",
)
def check_body_rows(spark, sf):
    return coverage.check_body_rows(t.shifted_parts(spark, sf)).select("event_id", "error")


@query(
    "missing_chunks",
    f"""WITH {t.PARTS_SQL}, gap AS (
      SELECT resolution, scene_id, y FROM (
        SELECT DISTINCT p.scene_id, p.resolution, g.dimsize FROM parts p JOIN grid g USING (resolution)),
        LATERAL (SELECT unnest(range(0, dimsize)) AS y)
      EXCEPT SELECT resolution, scene_id, y FROM covered)
      SELECT scene_id, resolution, string_agg(chunk_no, ',' ORDER BY chunk_no) AS missing
      FROM (SELECT DISTINCT scene_id, g.resolution, chunk_no FROM gap g JOIN body b
        ON b.product_type = 'FDHSI' AND b.resolution = g.resolution
        AND g.y >= b.row_start AND g.y < b.row_stop) GROUP BY scene_id, resolution""",
)
def missing_chunks(spark, sf):
    parts = coverage.attach_grid(t.parts(spark, sf))
    gaps = coverage.uncovered_rows(parts, [*coverage.KEYS, "product_type"])
    missing = coverage.missing_chunks(gaps)
    return missing.select("scene_id", "resolution", F.array_join("missing", ",").alias("missing"))


@query(
    "attach_calibration",
    f"""WITH {t.SLOT_CHANNEL_SQL} SELECT event_id, slope, "offset" FROM acq JOIN cal USING (slot, channel)""",
)
def attach_calibration(spark, sf):
    joined = rasters.attach_calibration(
        t.acquisitions(spark, sf), t.slot_channel(spark, sf), ["slot", "channel"]
    )
    return joined.select("event_id", "slope", "offset")


@query(
    "attach_geo",
    f"""WITH {t.LATLON_SQL}, geo AS (
      SELECT DISTINCT resolution, "row", col, latitude FROM ll)
      SELECT p.l_orderkey, p.l_linenumber, p.l_partkey, round(CAST(g.latitude AS DOUBLE), 3) AS latitude
      FROM px p LEFT JOIN geo g USING (resolution, "row", col)""",
)
def attach_geo(spark, sf):
    """Geolocation of pixels from a grid table derived from the pixels' own positions."""
    pixels = t.grid_pixels(spark, sf)
    at = ["resolution", "row", "col"]
    latitude = geolocation.latlon(F.col("row"), F.col("col"), F.col("resolution"))["latitude"]
    geo = pixels.select(*at).distinct().withColumn("latitude", latitude)
    joined = rasters.attach_geo(pixels, geo, at)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(F.col("latitude").cast("double"), 3).alias("latitude"),
    )


@query(
    "slot_axis",
    f"""WITH {t.ACQ_SQL}, label AS (
      SELECT slot, max(date_trunc('minute', ts)) AS t FROM acq GROUP BY slot)
      SELECT CAST(r.slot AS BIGINT) AS slot, strftime(t, '%Y-%m-%d %H:%M:%S') AS time
      FROM (SELECT unnest(range(0, (SELECT max(slot) + 1 FROM acq))) AS slot) r LEFT JOIN label USING (slot)""",
)
def slot_axis(spark, sf):
    scenes = t.acquisitions(spark, sf).select(
        "slot", slots.slot_label(F.col("ts")).alias("coordinate")
    )
    axis = slot_values.slot_axis(spark, slot_values.slot_times(scenes))
    return axis.select("slot", t.text("time").alias("time"))


@query(
    "merge_rows",
    """WITH old AS (SELECT l_orderkey AS y, l_linenumber AS slot, max(l_partkey) AS v
        FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
      new AS (SELECT l_orderkey AS y, l_linenumber AS slot, max(l_suppkey) AS v
        FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL)
      SELECT y, slot, v FROM new UNION ALL
      SELECT y, slot, v FROM old WHERE NOT EXISTS (
        SELECT 1 FROM new WHERE new.y = old.y AND new.slot = old.slot)""",
)
def merge_rows(spark, sf):
    lines = t.read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("y"),
        F.col("l_linenumber").alias("slot"),
        "l_returnflag",
        "l_partkey",
        "l_suppkey",
    )
    old = lines.filter(F.col("l_returnflag") != "R").groupBy("y", "slot").agg(
        F.max("l_partkey").alias("v")
    )
    new = lines.filter(F.col("l_returnflag") != "A").groupBy("y", "slot").agg(
        F.max("l_suppkey").alias("v")
    )
    return cube.merge_rows(old, new, ["slot", "y"])


@query(
    "resume_anti",
    f"""WITH {t.ACQ_SQL} SELECT event_id, slot FROM acq
      WHERE slot NOT IN (SELECT slot FROM acq WHERE channel = 'ir_38')""",
)
def resume_anti(spark, sf):
    scenes = t.acquisitions(spark, sf)
    present = scenes.filter(F.col("channel") == "ir_38").select("slot")
    return cube.not_ingested(scenes, present).select("event_id", "slot")


@query(
    "already_ingested",
    f"""WITH {t.ACQ_SQL} SELECT event_id, slot FROM acq
      WHERE slot IN (SELECT slot FROM acq WHERE channel = 'ir_38')""",
)
def already_ingested(spark, sf):
    scenes = t.acquisitions(spark, sf)
    present = scenes.filter(F.col("channel") == "ir_38").select("slot")
    return cube.already_ingested(scenes, present).select("event_id", "slot")


@query(
    "cube_diff",
    """WITH a AS (SELECT l_orderkey AS y, l_linenumber AS slot, max(l_quantity) AS counts,
          max(l_discount) AS quality FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
      b AS (SELECT l_orderkey AS y, l_linenumber AS slot, max(l_quantity) AS counts,
          max(l_tax) AS quality FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL),
      j AS (SELECT coalesce(a.slot, b.slot) AS slot, coalesce(a.y, b.y) AS y, a.y IS NULL AS no_a,
          b.y IS NULL AS no_b, a.counts IS DISTINCT FROM b.counts AS d1,
          a.quality IS DISTINCT FROM b.quality AS d2
        FROM a FULL JOIN b ON a.y = b.y AND a.slot = b.slot),
      v AS (SELECT 'counts' AS variable, slot, y, no_a, no_b, d1 AS d FROM j
        UNION ALL SELECT 'quality', slot, y, no_a, no_b, d2 FROM j)
      SELECT variable, count(*) FILTER (no_b) AS only_a, count(*) FILTER (no_a) AS only_b,
        count(*) FILTER (d AND NOT no_a AND NOT no_b) AS differing,
        min(CAST(slot AS BIGINT) * 100000000 + y) FILTER (d OR no_a OR no_b) AS first_key
      FROM v GROUP BY variable""",
)
def cube_diff(spark, sf):
    lines = t.read(spark, sf, "lineitem").withColumnsRenamed(
        {"l_orderkey": "y", "l_linenumber": "slot"}
    )

    def side(flag: str, quality: str):
        return lines.filter(F.col("l_returnflag") != flag).groupBy("slot", "y").agg(
            F.max("l_quantity").alias("counts"), F.max(quality).alias("quality")
        )

    found = diff.cube_diff(
        side("R", "l_discount"), side("A", "l_tax"), ["counts", "quality"], ["slot", "y"]
    )
    first = F.col("first_key.slot").cast("bigint") * 100_000_000 + F.col("first_key.y")
    return found.select("variable", "only_a", "only_b", "differing", first.alias("first_key"))


@query(
    "names_in_every_group",
    """SELECT l_suppkey AS variable FROM lineitem GROUP BY l_suppkey
      HAVING count(DISTINCT l_linenumber) = (SELECT count(DISTINCT l_linenumber) FROM lineitem)""",
)
def names_in_every_group(spark, sf):
    declared = t.read(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("group"), F.col("l_suppkey").alias("variable")
    )
    return audit.common_names(declared)


@query(
    "missing_names",
    """SELECT DISTINCT l_suppkey AS "group", l_partkey AS variable FROM lineitem l
      WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R'
        AND r.l_suppkey = l.l_suppkey AND r.l_partkey = l.l_partkey)""",
)
def missing_names(spark, sf):
    pairs = t.read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("group"), F.col("l_partkey").alias("variable"), "l_returnflag"
    )
    present = pairs.filter(F.col("l_returnflag") == "R").select("group", "variable").distinct()
    return audit.missing_names(pairs.select("group", "variable").distinct(), present)


@query(
    "fill_audit",
    """WITH declared AS (SELECT l_suppkey AS g, l_partkey AS v, max(l_linenumber) AS value
        FROM lineitem GROUP BY ALL),
      present AS (SELECT DISTINCT l_suppkey AS g, l_partkey AS v FROM lineitem WHERE l_returnflag <> 'N'),
      stored AS (SELECT l_suppkey AS g, l_partkey AS v, max(l_linenumber) AS found
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
      SELECT d.g AS "group", d.v AS variable, CASE WHEN p.g IS NULL THEN 'absent'
        WHEN found IS NULL THEN 'missing' WHEN found = value THEN 'ok' ELSE 'conflict' END AS state
      FROM declared d LEFT JOIN present p ON p.g = d.g AND p.v = d.v
      LEFT JOIN stored s ON s.g = d.g AND s.v = d.v""",
)
def fill_audit(spark, sf):
    pairs = t.read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("group"),
        F.col("l_partkey").alias("variable"),
        "l_returnflag",
        "l_linenumber",
    )
    keys = ["group", "variable"]
    declared = pairs.groupBy(*keys).agg(F.max("l_linenumber").alias("value"))
    flag = F.col("l_returnflag")
    stored = pairs.filter(flag == "R").groupBy(*keys).agg(F.max("l_linenumber").alias("value"))
    audited = audit.fill_audit(declared, pairs.filter(flag != "N"), stored)
    return audited.select(*keys, "state")


@query(
    "tiles_to_parts",
    f"""WITH {t.PARTS_SQL} SELECT p.resolution, CAST(y // tile_rows AS INTEGER) AS tile, chunk_no,
        count(DISTINCT scene_id) AS n_scenes
      FROM (SELECT scene_id, resolution, chunk_no, unnest(range(row_start, row_stop)) AS y FROM parts) p
      JOIN grid USING (resolution) GROUP BY ALL""",
)
def tiles_to_parts(spark, sf):
    """Tiles that occur in the data, joined with the parts that meet them."""
    parts = coverage.attach_grid(t.parts(spark, sf))
    tiles = coverage.parts_in_tile(parts).select("resolution", "tile").distinct()
    met = coverage.join_tiles(tiles, parts)
    return met.groupBy("resolution", "tile", "chunk_no").agg(
        F.count_distinct("scene_id").alias("n_scenes")
    )
