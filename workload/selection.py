"""Selections, windows and pruning."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlake import constants as K
from orbitlake.functions import fills
from orbitlake.operators import rasters, slot_values
from orbitlake.plans import catalog, variables
from orbitlake.plans.config import CubeConfig
from orbitlake.session import scratch_path
from orbitlake.sources import cube, grids
from workload import tables as t
from workload.registry import query


@query(
    "select_resolutions",
    f"""WITH {t.REQUEST_SQL} SELECT request_id, resolution,
      CASE WHEN resolutions IS NULL THEN order_ ELSE list_position(resolutions, resolution) - 1 END AS position
      FROM (SELECT DISTINCT r.request_id, r.resolutions, c.resolution, c.res_order AS order_
        FROM request r JOIN cat c USING (product_type)
        WHERE r.resolutions IS NULL OR list_contains(r.resolutions, c.resolution))""",
)
def select_resolutions(spark, sf):
    found = catalog.select_resolutions(t.requests(spark, sf))
    return found.select("request_id", "resolution", "position")


@query(
    "select_channels",
    f"""WITH {t.REQUEST_SQL} SELECT request_id, product_type, channel,
      coalesce(resolution, 'unknown') AS resolution, channel_index FROM chosen""",
)
def select_channels(spark, sf):
    found = catalog.select_channels(t.requests(spark, sf), strict=False)
    return found.select(
        "request_id",
        "product_type",
        "channel",
        F.coalesce("resolution", F.lit("unknown")).alias("resolution"),
        "channel_index",
    )


@query(
    "effective_resolutions",
    f"""WITH {t.REQUEST_SQL} SELECT request_id, resolution, n_channels, resolution_index FROM effective""",
)
def effective_resolutions(spark, sf):
    found = catalog.effective_resolutions(t.requests(spark, sf), strict=False)
    return found.select("request_id", "resolution", "n_channels", "resolution_index")


@query(
    "resolve_plans",
    f"""WITH {t.REQUEST_SQL} SELECT c.request_id, c.resolution, e.resolution_index, e.dimsize,
      string_agg(c.channel, ',' ORDER BY channel_index) AS channels,
      string_agg(c.nc_channel, ',' ORDER BY channel_index) AS nc_channels
      FROM chosen c JOIN effective e USING (request_id, resolution)
      GROUP BY c.request_id, c.resolution, e.resolution_index, e.dimsize""",
)
def resolve_plans(spark, sf):
    plans = catalog.resolve_plans(t.requests(spark, sf), strict=False)
    return plans.select(
        "request_id",
        "resolution",
        "resolution_index",
        "dimsize",
        F.array_join("channels", ",").alias("channels"),
        F.array_join("nc_channels", ",").alias("nc_channels"),
    )


@query(
    "only_for_channels",
    f"""WITH {t.REQUEST_SQL} SELECT request_id, resolution, bool_or(dual) AS has_warm
      FROM chosen JOIN res USING (request_id, resolution) GROUP BY request_id, resolution""",
)
def only_for_channels(spark, sf):
    plans = catalog.resolve_plans(t.requests(spark, sf), strict=False)
    warm = catalog.has_dual_gain(F.col("channels"))
    return plans.select("request_id", "resolution", warm.alias("has_warm"))


@query(
    "slot_window",
    f"WITH {t.ACQ_SQL} SELECT event_id, slot FROM acq WHERE slot >= 720 AND slot < 2160",
)
def slot_window(spark, sf):
    return slot_values.slot_window(t.acquisitions(spark, sf), 720, 2160).select("event_id", "slot")


def stripes(spark, sf):
    """One chunk range per part, sometimes reversed or out of range."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return t.read(spark, sf, "part").select(
        "p_partkey",
        F.when(key % 4 < 2, K.FDHSI).otherwise(K.HRFI).alias("product_type"),
        F.when(key % 4 == 0, "1km")
        .when(key % 4 == 1, "2km")
        .when(key % 4 == 2, "500m")
        .otherwise("1km")
        .alias("resolution"),
        size.cast("int").alias("first"),
        (size + F.pmod(key, F.lit(9)) - 1).cast("int").alias("last"),
    )


STRIPE_SQL = f"""{t.BODY_SQL},
grid(resolution, dimsize, tile_rows) AS (VALUES ('500m', 22272, 556), ('1km', 11136, 278), ('2km', 5568, 139)),
stripe AS (
  SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN 'FDHSI' ELSE 'HRFI' END AS product_type,
    CASE p_partkey % 4 WHEN 0 THEN '1km' WHEN 1 THEN '2km' WHEN 2 THEN '500m' ELSE '1km' END AS resolution,
    p_size AS first, p_size + p_partkey % 9 - 1 AS last FROM part),
span AS (
  SELECT s.*, a.row_start, z.row_stop FROM stripe s
  JOIN body a ON a.product_type = s.product_type AND a.resolution = s.resolution AND a.chunk_no = s.first
  JOIN body z ON z.product_type = s.product_type AND z.resolution = s.resolution AND z.chunk_no = s.last
  WHERE first <= last)"""


@query(
    "stripe_rows",
    f"""WITH {STRIPE_SQL} SELECT p_partkey, coalesce(row_start, -1) AS row_start,
      coalesce(row_stop, -1) AS row_stop FROM part LEFT JOIN span USING (p_partkey)""",
)
def stripe_rows(spark, sf):
    spans = catalog.stripe_rows(stripes(spark, sf), strict=False)
    return spans.select(
        "p_partkey",
        F.coalesce("row_start", F.lit(-1)).alias("row_start"),
        F.coalesce("row_stop", F.lit(-1)).alias("row_stop"),
    )


@query(
    "stripe_window",
    f"""WITH {STRIPE_SQL} SELECT p_partkey, CAST(row_start // tile_rows * tile_rows AS INTEGER) AS window_start,
      CAST(least((row_stop + tile_rows - 1) // tile_rows * tile_rows, dimsize) AS INTEGER) AS window_stop
      FROM span JOIN grid USING (resolution)""",
)
def stripe_window(spark, sf):
    spans = catalog.stripe_rows(stripes(spark, sf), strict=False)
    windows = catalog.stripe_window(spans.filter(F.col("row_start").isNotNull()))
    return windows.select("p_partkey", "window_start", "window_stop")


@query(
    "tiles",
    f"""WITH {STRIPE_SQL}, w AS (
      SELECT p_partkey, tile_rows, row_start // tile_rows * tile_rows AS a,
        least((row_stop + tile_rows - 1) // tile_rows * tile_rows, dimsize) AS z
      FROM span JOIN grid USING (resolution))
      SELECT p_partkey, CAST(s // tile_rows AS INTEGER) AS tile, CAST(s AS INTEGER) AS tile_start,
        CAST(least(s + tile_rows, z) AS INTEGER) AS tile_stop
      FROM (SELECT *, unnest(range(a, z, tile_rows)) AS s FROM w)""",
)
def tiles(spark, sf):
    spans = catalog.stripe_rows(stripes(spark, sf), strict=False)
    windows = catalog.stripe_window(spans.filter(F.col("row_start").isNotNull()))
    return catalog.tiles(windows).select("p_partkey", "tile", "tile_start", "tile_stop")


@query(
    "crop_rows",
    """SELECT l_orderkey AS y, l_orderkey - 8618 AS y_offset, l_partkey, l_linenumber
      FROM lineitem WHERE l_orderkey >= 8618 AND l_orderkey < 11136""",
)
def crop_rows(spark, sf):
    lines = t.read(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "y")
    return rasters.crop_rows(lines, *catalog.row_window(CubeConfig("FDHSI", body_chunks=(32, 40)), "1km")).select(
        "y", "y_offset", "l_partkey", "l_linenumber"
    )


@query(
    "optional_columns",
    f"""WITH {t.SCAN_SQL} SELECT y, string_agg(counts, ',' ORDER BY x) AS counts FROM pixel GROUP BY y""",
)
def optional_columns(spark, sf):
    config = CubeConfig("FDHSI", include_pixel_quality=False, include_pixel_time=False)
    chosen = variables.select_variables(t.scan_in(spark, sf), "scanlines", config, (), keep=("y",))
    # Quality, index map and time were never selected, so their sources are not computed.
    return chosen.select("y", F.array_join("counts", ",").alias("counts"))


@query(
    "probe_sources",
    f"""WITH {t.ACQ_SQL} SELECT e.user_id AS scene_id, bool_or(a.channel = 'ir_38') AS has_time
      FROM events e JOIN acq a USING (event_id) GROUP BY e.user_id""",
)
def probe_sources(spark, sf):
    events = t.read(spark, sf, "events").withColumnRenamed("user_id", "scene_id")
    times = events.filter(F.expr(t.CHANNEL_CASE) == "ir_38").select("scene_id")
    return rasters.has_time_map(events.select("scene_id").distinct(), times)


@query(
    "mask_fill",
    f"""WITH {t.SCAN_SQL} SELECT y, count(*) FILTER (counts <> 0) AS n_valid,
      CAST(sum(counts) AS BIGINT) AS total FROM pixel GROUP BY y""",
)
def mask_fill(spark, sf):
    masked = fills.mask_fill_row(F.col("counts"), 0)
    scan = t.scan_in(spark, sf).select("y", masked.alias("counts"))
    kept = F.filter("counts", lambda c: c.isNotNull())
    return scan.select(
        "y",
        F.size(kept).cast("bigint").alias("n_valid"),
        F.aggregate(kept, F.lit(0).cast("bigint"), lambda a, c: a + c).alias("total"),
    )


@query(
    "tile_of",
    f"""WITH {t.PIXELS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, resolution,
      CAST("row" // (CASE resolution WHEN '500m' THEN 556 WHEN '1km' THEN 278 ELSE 139 END) AS INTEGER) AS tile
      FROM px""",
)
def tile_of(spark, sf):
    tile = catalog.tile_of(F.col("row"), F.col("resolution"))
    return t.grid_pixels(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "resolution", tile.alias("tile")
    )


def chunk_rows(spark, sf):
    """Part rows per file channel: each event is one channel of one part of its user's scene."""
    channels = F.array(*(F.lit(c) for c in ("vis_04", "ir_38", "vis_06", "none", "ir_38_hr")))
    event = F.col("event_id")
    return t.read(spark, sf, "events").select(
        F.col("user_id").alias("scene_id"),
        F.pmod(event, F.lit(8)).cast("bigint").alias("part_order"),
        F.pmod(event, F.lit(8)).cast("int").alias("chunk_no"),
        F.element_at(channels, (F.pmod(event, F.lit(5)) + 1).cast("int")).alias("nc_channel"),
        (event * 2).cast("int").alias("row_start"),
        (event * 2 + 2).cast("int").alias("row_stop"),
    )


@query(
    "parts_of_group",
    f"""WITH {t.CHANNELS_SQL}, r AS (
      SELECT user_id AS scene_id, event_id % 8 AS part_order,
        ['vis_04', 'ir_38', 'vis_06', 'none', 'ir_38_hr'][event_id % 5 + 1] AS nc_channel,
        event_id * 2 AS row_start FROM events)
      SELECT scene_id, part_order, product_type, resolution,
        CAST(first(row_start ORDER BY nc_channel, row_start) AS INTEGER) AS row_start
      FROM r JOIN cat USING (nc_channel) GROUP BY scene_id, part_order, product_type, resolution""",
)
def parts_of_group(spark, sf):
    found = rasters.parts_of_group(chunk_rows(spark, sf))
    return found.select("scene_id", "part_order", "product_type", "resolution", "row_start")


@query(
    "rename_channels",
    f"""WITH {t.CHANNELS_SQL}, r AS (
      SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'FDHSI' ELSE 'HRFI' END AS product_type,
        ['vis_04', 'ir_38', 'vis_06_hr', 'none', 'ir_38_hr'][event_id % 5 + 1] AS nc_channel FROM events)
      SELECT event_id, channel, resolution FROM r JOIN cat USING (product_type, nc_channel)""",
)
def rename_channels(spark, sf):
    listed = F.array(*(F.lit(c) for c in ("vis_04", "ir_38", "vis_06_hr", "none", "ir_38_hr")))
    events = t.read(spark, sf, "events").select(
        "event_id",
        F.when(F.col("user_id") % 2 == 0, K.FDHSI).otherwise(K.HRFI).alias("product_type"),
        F.element_at(listed, (F.pmod("event_id", F.lit(5)) + 1).cast("int")).alias("nc_channel"),
    )
    return catalog.rename_channels(events).select("event_id", "channel", "resolution")


@query(
    "attach_wavelength",
    f"""WITH {t.CHANNELS_SQL}, {t.ACQ_SQL} SELECT event_id, a.channel,
      round(CAST(w.wavelength AS DOUBLE), 4) AS wavelength
      FROM (SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'none' ELSE channel END AS channel FROM acq) a
      LEFT JOIN (SELECT DISTINCT channel, wavelength FROM cat) w USING (channel)""",
)
def attach_wavelength(spark, sf):
    channel = F.when(F.col("event_id") % 6 == 0, "none").otherwise(F.col("channel"))
    acquired = t.acquisitions(spark, sf).select("event_id", channel.alias("channel"))
    found = catalog.attach_wavelength(acquired)
    return found.select(
        "event_id", "channel", F.round(F.col("wavelength_um").cast("double"), 4).alias("wavelength")
    )


@query(
    "variable_registry",
    f"""WITH {t.SLOT_CHANNEL_SQL} SELECT slot, channel, slope, "offset", warm_slope, warm_offset,
      channel = 'ir_38' AS dual_gain FROM cal""",
)
def variable_registry(spark, sf):
    """The per-slot calibration table as the registry declares it, and one variable more."""
    table = t.slot_channel(spark, sf)
    for name in K.CONVERSION_CONSTANTS:
        table = table.withColumn(name, F.lit(None).cast("float"))
    rows = variables.select_variables(
        table, "slot_channel", CubeConfig("FDHSI"), ["ir_38"], ("slot", "channel"), {"dual_gain": "boolean"}
    )
    return rows.select("slot", "channel", "slope", "offset", "warm_slope", "warm_offset", "dual_gain")


@query(
    "attribute_resolver",
    f"""WITH {t.PIXELS_SQL}, lines AS (SELECT DISTINCT resolution, "row" AS y, ya FROM pt WHERE resolution <> '500m')
      SELECT resolution, y, 'm' AS units, 'projection_y_coordinate' AS standard_name,
        round(ya * 35786400, 3) AS value FROM lines
      UNION ALL SELECT resolution, y, 'radian', 'projection_y_angular_coordinate', round(ya, 10) FROM lines""",
)
def attribute_resolver(spark, sf):
    """Attributes follow the options and travel with the column: both axes, each with its units."""
    lines = t.grid_pixels(spark, sf).select("resolution", F.col("row").alias("index")).distinct()
    found = []
    for units, digits in (("meter", 3), ("radian", 10)):
        axis = grids.axes(spark, CubeConfig(K.FDHSI, projection_units=units), "y")
        described = axis.schema["y"].metadata
        found.append(
            lines.join(axis, ["resolution", "index"]).select(
                "resolution",
                F.col("index").alias("y"),
                F.lit(described["units"]).alias("units"),
                F.lit(described["standard_name"]).alias("standard_name"),
                F.round("y", digits).alias("value"),
            )
        )
    return found[0].unionByName(found[1])


@query(
    "group_attributes",
    f"""WITH {t.PIXELS_SQL}, {t.WINDOWS_SQL}
      SELECT win.resolution, y_start AS disk_row_start, y_stop AS disk_row_stop,
        '[32, 40]' AS chunks, count(*) AS n_positions
      FROM win JOIN pt ON pt.resolution = win.resolution AND "row" >= y_start AND "row" < y_stop
      WHERE win.resolution <> '500m' GROUP BY ALL""",
)
def group_attributes(spark, sf):
    """The attributes of a stripe's groups, read back from the cube, say which rows they hold."""
    config = CubeConfig(K.FDHSI, body_chunks=(32, 40))
    path = scratch_path(spark, "attributes")
    cube.write_groups(variables.declared_attributes(spark, config), path, "attributes", ["group"])
    stored = spark.read.parquet(f"{path}/attributes").where("variable = ''")
    names = ("disk_row_start", "disk_row_stop", "fci_chunks")
    wide = stored.groupBy("group").pivot("attribute", list(names)).agg(F.first("value"))
    groups = wide.select(
        F.regexp_replace("group", "^data_", "").alias("resolution"),
        *(F.col(n).cast("int").alias(n) for n in names[:2]),
        F.col("fci_chunks").alias("chunks"),
    )
    positions = t.grid_pixels(spark, sf).select("resolution", F.col("row").alias("y"))
    inside = (F.col("y") >= F.col("disk_row_start")) & (F.col("y") < F.col("disk_row_stop"))
    found = positions.join(groups, "resolution").where(inside)
    return found.groupBy("resolution", *names[:2], "chunks").agg(F.count("*").alias("n_positions"))
