"""Listing, classification, archives and scenes."""

from __future__ import annotations

import io
import json
import os
import uuid
import zipfile

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from orbitlake.functions import fills, names
from orbitlake.operators import scenes
from orbitlake.session import scratch_path, staged
from orbitlake.sources.archives import list_members, read_members, unpack_archives
from orbitlake.sources.chunks import decode_chunks, table_rows
from orbitlake.sources.files import list_inputs
from workload import tables as t
from workload.registry import query


@query("list_inputs")
def list_files(spark, sf):
    return list_inputs(spark, sf, ["*.parquet", "!region*"]).select("name", "length")


@query(
    "classify_items",
    f"""WITH {t.FILES_SQL} SELECT event_id, CASE WHEN form = 'garbage' THEN 'chunk'
      WHEN form = 'other' THEN 'ignored' ELSE form END AS kind FROM mixed""",
)
def classify_items(spark, sf):
    return scenes.classify_items(t.mixed_files(spark, sf)).select("event_id", "kind")


@query(
    "mixed_input",
    f"""WITH {t.FILES_SQL} SELECT count(*) FILTER (form = 'zip') AS n_zips,
      count(*) FILTER (form IN ('chunk', 'garbage')) AS n_chunks,
      'mixed input: ' || count(*) FILTER (form = 'zip') || ' ZIP and '
        || count(*) FILTER (form IN ('chunk', 'garbage')) || ' chunk file(s)' AS error FROM mixed""",
)
def mixed_input(spark, sf):
    return scenes.mixed_input(scenes.classify_items(t.mixed_files(spark, sf)))


@query("is_zip", f"WITH {t.FILES_SQL} SELECT event_id, form = 'zip' AS is_zip FROM mixed")
def is_zip(spark, sf):
    return t.mixed_files(spark, sf).select("event_id", names.is_zip(F.col("path")).alias("is_zip"))


@query(
    "is_chunk",
    f"WITH {t.FILES_SQL} SELECT event_id, form IN ('chunk', 'garbage') AS is_chunk FROM mixed",
)
def is_chunk(spark, sf):
    return t.mixed_files(spark, sf).select(
        "event_id", names.is_chunk(F.col("path")).alias("is_chunk")
    )


@query(
    "foreign_products",
    f"""WITH {t.FILES_SQL}, alien AS (SELECT name FROM mixed WHERE form <> 'other' AND product <> 'FDHSI')
      SELECT (SELECT count(*) FROM alien) AS n_foreign,
        (SELECT string_agg(name, ', ' ORDER BY name) FROM (SELECT name FROM alien ORDER BY name LIMIT 3))
          AS shown,
        (SELECT greatest(count(*) - 3, 0) FROM alien) AS more""",
)
def foreign_products(spark, sf):
    return scenes.foreign_summary(scenes.classify_items(t.mixed_files(spark, sf)), "FDHSI")


def zip_text(batches):
    """One archive per document, holding its whole text as the only member."""
    for batch in batches:
        contents = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w") as archive:
                archive.writestr(f"part/{doc_id:04d}.nc", text.encode())
            contents.append(buffer.getvalue())
        yield pd.DataFrame(
            {"path": [f"s3://in/{d}.zip" for d in batch["doc_id"]], "content": contents}
        )


@query(
    "unpack_archives",
    """SELECT 's3://in/' || doc_id || '.zip' AS archive,
      'part/' || lpad(CAST(doc_id AS VARCHAR), CAST(greatest(4, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0') || '.nc' AS name,
      CAST(strlen(text) AS BIGINT) AS length, md5(text) AS digest FROM documents""",
)
def unpack(spark, sf):
    archives = t.read(spark, sf, "documents").select("doc_id", "text").mapInPandas(
        zip_text, "path string, content binary"
    )
    return unpack_archives(archives).select("archive", "name", "length", F.md5("content").alias("digest"))


def archive_writer(folder):
    """Write the texts of an archive to a ZIP file in the shared folder; each try under its own name."""

    def write(rows):
        number = int(rows["number"].iloc[0])
        path = f"{folder}/{number:08d}.zip"
        attempt = f"{path}.{uuid.uuid4().hex}"
        os.makedirs(folder, exist_ok=True)
        with zipfile.ZipFile(attempt, "w", zipfile.ZIP_DEFLATED) as archive:
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                archive.writestr(f"part/{doc_id}.nc", text or "")
                archive.writestr(f"preview/{doc_id}.jpg", "no chunk")
        os.replace(attempt, path)
        return pd.DataFrame({"path": [f"file:{path}"]})

    return write


@query(
    "archive_members",
    """SELECT lpad(CAST(doc_id // 100 AS VARCHAR), 8, '0') || '.zip' AS archive,
      'part/' || doc_id || '.nc' AS name, CAST(strlen(coalesce(text, '')) AS BIGINT) AS length,
      md5(coalesce(text, '')) AS digest FROM documents""",
)
def archive_members(spark, sf):
    """Archives of a hundred documents each; only the members a filter leaves are read."""
    folder = scratch_path(spark, "zips").removeprefix("file:")
    numbered = t.read(spark, sf, "documents").select(
        F.floor(F.col("doc_id") / 100).alias("number"), "doc_id", "text"
    )
    written = numbered.groupBy("number").applyInPandas(archive_writer(folder), "path string")
    entries = list_members(staged(written, "zips"))
    found = read_members(entries.filter(F.col("name").endswith(".nc")))
    return found.select(
        names.item_name(F.col("archive")).alias("archive"), "name", "length", F.md5("content").alias("digest")
    )


@query(
    "order_parts",
    f"""WITH {t.FILES_SQL} SELECT scene_id, name, row_number() OVER (
      PARTITION BY scene_id ORDER BY num = 41, num, name) AS position
      FROM (SELECT DISTINCT user_id AS scene_id, num, name FROM chunk)""",
)
def order_parts(spark, sf):
    members = t.chunk_files(spark, sf).select(
        F.col("user_id").alias("scene_id"), F.col("path").alias("name")
    )
    return scenes.order_parts(members).select("scene_id", "name", "position")


def event_decoder(name, content, wanted):
    """Decoder of a file that holds one event as JSON."""
    event = json.loads(content)
    yield (
        "time_rows",
        {"row_no": [0], "idx": [json.loads(event["props"])["k"]], "time_s": [event["value"]]},
    )


@query(
    "decode_chunks",
    f"""WITH {t.FILES_SQL} SELECT CAST(c.user_id AS VARCHAR) AS scene_id,
      CAST(num AS BIGINT) AS part_number, CAST(json_extract(e.props, '$.k') AS BIGINT) AS idx,
      e.value AS time_s FROM chunk c JOIN events e USING (event_id)""",
)
def decode(spark, sf):
    content = F.to_json(F.struct("props", "value")).cast("binary")
    events = t.read(spark, sf, "events").select("event_id", content.alias("content"))
    named = t.chunk_files(spark, sf).select("event_id", "user_id", "path")
    members = named.join(events, "event_id").select(
        F.col("user_id").cast("string").alias("scene_id"),
        names.part_number(F.col("path")).alias("part_order"),
        names.item_name(F.col("path")).alias("name"),
        "content",
    )
    rows = table_rows(decode_chunks(members, event_decoder), "time_rows")
    return rows.select("scene_id", F.col("part_order").alias("part_number"), "idx", "time_s")


SCENES_SQL = f"""WITH {t.FILES_SQL}, member AS (
  SELECT product, coordinate, num, min(name) AS name, count(*) AS n,
    arg_min_null(length, name) AS length
  FROM chunk GROUP BY product, coordinate, num)"""


@query(
    "bundle_scenes",
    f"""{SCENES_SQL} SELECT 'fci-scene://' || product || '/' || strftime(coordinate, '%Y%m%d%H%M%S')
        AS scene_id, product AS product_type,
      strftime(coordinate, '%Y-%m-%d %H:%M:%S') AS coordinate,
      string_agg(name, ' ' ORDER BY num = 41, num, name) AS members,
      CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM member GROUP BY product, coordinate""",
)
def bundle_scenes(spark, sf):
    found = scenes.bundle_scenes(_parsed(spark, sf), strict=False)
    return found.select(
        "scene_id",
        "product_type",
        t.text("coordinate").alias("coordinate"),
        F.array_join("members.name", " ").alias("members"),
        "n_duplicates",
    )


def _parsed(spark, sf):
    files = staged(t.chunk_files(spark, sf).select("path", "length"), "listing")
    return scenes.parse_chunks(scenes.classify_items(files))


@query(
    "duplicate_chunks",
    f"""WITH {t.FILES_SQL} SELECT product AS product_type,
      strftime(coordinate, '%Y-%m-%d %H:%M:%S') AS coordinate, num AS chunk_no, 2 * count(*) AS n_files,
      min(name) AS first_name, max(name) AS other_name FROM chunk GROUP BY product, coordinate, num""",
)
def duplicate_chunks(spark, sf):
    """Every chunk is delivered to two folders."""
    chunks = _parsed(spark, sf)
    copies = chunks.withColumn("path", F.concat(F.lit("s3://copy/"), "name"))
    found = scenes.duplicate_chunks(chunks.unionByName(copies))
    return found.withColumn("coordinate", t.text("coordinate"))


@query(
    "item_size",
    f"""WITH {t.FILES_SQL} SELECT user_id AS scene_id, CASE WHEN count(length) = count(*)
      THEN CAST(sum(length) AS DOUBLE) END AS size_bytes, count(*) AS n_members
      FROM chunk GROUP BY user_id, num""",
)
def item_size(spark, sf):
    path = F.col("path")
    return (
        t.chunk_files(spark, sf)
        .groupBy(F.col("user_id").alias("scene_id"), names.part_number(path).alias("num"))
        .agg(scenes.item_size("length").cast("double").alias("size_bytes"), F.count("*").alias("n_members"))
        .drop("num")
    )


def listing(spark, sf):
    """The mixed items as a listing of files, with plain columns."""
    return staged(t.mixed_files(spark, sf).select("path", "length"), "listing")


@query(
    "scene_order",
    f"""WITH {t.FILES_SQL}, scene AS (
        SELECT 0 AS r, name AS label, '' AS product, NULL::TIMESTAMP AS coordinate
          FROM mixed WHERE form = 'zip'
        UNION ALL SELECT DISTINCT 1, '', product, coordinate FROM mixed WHERE form = 'chunk')
      SELECT row_number() OVER (ORDER BY r, label, product, coordinate) AS position,
        CASE WHEN r = 0 THEN 's3://in/' || label
          ELSE 'fci-scene://' || product || '/' || strftime(coordinate, '%Y%m%d%H%M%S') END AS scene_id
      FROM scene""",
)
def scene_order(spark, sf):
    items = scenes.classify_items(listing(spark, sf))
    ordered = scenes.scene_order(scenes.discover(items, strict=False))
    # Positions of a global order: count per sorted partition, then number inside each.
    numbered = ordered.select("scene_id", F.monotonically_increasing_id().alias("id"))
    return _positions(numbered)


def _positions(numbered):
    # The high bits of the id are the sorted partition, the low 33 bits the place inside it.
    numbered = staged(numbered, "order").select(
        "scene_id",
        F.shiftright("id", 33).alias("piece"),
        F.col("id").bitwiseAND((1 << 33) - 1).alias("place"),
    )
    sizes = numbered.groupBy("piece").agg(F.count("*").alias("n"))
    # One row per sorted partition, so the running total is short.
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, "piece").select(
        "scene_id", (F.col("offset") + F.col("place") + 1).alias("position")
    )


@query(
    "union_scenes",
    f"""WITH {t.FILES_SQL} SELECT kind, product_type, count(*) AS n_scenes FROM (
        SELECT 'zip' AS kind, product AS product_type, name FROM mixed WHERE form = 'zip'
        UNION ALL SELECT DISTINCT 'bundle', product, CAST(coordinate AS VARCHAR) FROM mixed
          WHERE form = 'chunk')
      GROUP BY kind, product_type""",
)
def union_scenes(spark, sf):
    items = scenes.classify_items(listing(spark, sf))
    found = scenes.discover(items, strict=False)
    return found.groupBy("kind", "product_type").agg(F.count("*").alias("n_scenes"))


@query(
    "first_error_sample",
    f"""WITH {t.FILES_SQL} SELECT name FROM mixed WHERE form = 'garbage' ORDER BY name LIMIT 3""",
)
def first_error_sample(spark, sf):
    path = F.col("path")
    bad = t.mixed_files(spark, sf).filter(
        names.is_chunk(path) & names.parse_chunk_name(path)["error"].isNotNull()
    )
    return bad.select(names.item_name(path).alias("name")).orderBy("name").limit(scenes.SAMPLE)


@query(
    "run_metrics",
    """SELECT count(*) FILTER (event_type <> 'error') AS files_processed,
      count(*) FILTER (event_type = 'error') AS files_failed, count(*) AS count FROM events""",
)
def run_metrics(spark, sf):
    results = t.read(spark, sf, "events").select(
        F.col("event_id").alias("scene_id"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
    )
    return scenes.run_metrics(results)


@query(
    "failed_scenes",
    """SELECT event_id AS scene_id, props AS error FROM events WHERE event_type = 'error'""",
)
def failed_scenes(spark, sf):
    results = t.read(spark, sf, "events").select(
        F.col("event_id").alias("scene_id"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
    )
    return scenes.failed_scenes(results)


@query(
    "source_fill",
    """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 7 = 0 THEN NULL
      WHEN value = floor(value) AND value % 50 = 0 AND event_id % 2 = 0 THEN NULL
      ELSE value END AS value FROM events""",
)
def source_fill(spark, sf):
    event, value = F.col("event_id"), F.col("value")
    raw = (
        F.when(event % 9 == 0, F.lit(9.96921e36).cast("float").cast("double"))
        .when(event % 7 == 0, float("nan"))
        .otherwise(value)
    )
    # Even files declare their own fill: the value itself where it is a multiple of 50.
    declared = F.when((event % 2 == 0) & (event % 9 != 0) & (value % 50 == 0), value)
    return t.read(spark, sf, "events").select(
        "event_id", fills.source_fill_to_null(raw, declared).alias("value")
    )


@query(
    "row_bounds",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_suppkey % 3 = 0 THEN l_partkey - 1 WHEN l_suppkey % 3 = 1 THEN l_orderkey - 1 ELSE -1 END
        AS row_start,
      CASE WHEN l_suppkey % 3 = 0 THEN l_partkey + 10 WHEN l_suppkey % 3 = 1 THEN l_orderkey + 20 ELSE -1 END
        AS row_stop FROM lineitem""",
)
def row_bounds(spark, sf):
    kind = F.col("l_suppkey") % 3
    bounds = fills.row_bounds(
        F.when(kind == 0, F.col("l_partkey").cast("int")),
        F.when(kind == 0, (F.col("l_partkey") + 10).cast("int")),
        F.when(kind != 2, F.col("l_orderkey").cast("int")),
        F.when(kind != 2, (F.col("l_orderkey") + 20).cast("int")),
        strict=False,
    )
    return t.read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.coalesce(bounds["row_start"].cast("bigint"), F.lit(-1)).alias("row_start"),
        F.coalesce(bounds["row_stop"].cast("bigint"), F.lit(-1)).alias("row_stop"),
    )


@query(
    "attr_or_null",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
      CAST(NULL AS DOUBLE) AS absent FROM events""",
)
def attr_or_null(spark, sf):
    attrs = F.from_json("props", "map<string,string>")
    return t.read(spark, sf, "events").select(
        "event_id",
        fills.attr_or_null(attrs, "k").alias("k"),
        fills.attr_or_null(attrs, "scale_factor").alias("absent"),
    )
