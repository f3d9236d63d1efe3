"""Row coverage of scenes."""

from __future__ import annotations

from pyspark.sql import functions as F

from orbitlake.ingest import scene_problems
from orbitlake.operators import coverage
from orbitlake.operators.scenes import run_metrics
from orbitlake.plans import catalog
from orbitlake.plans.config import CubeConfig
from orbitlake.sources.chunks import TABLES, Decoded, schema_of
from workload import tables as t
from workload.registry import query


def gridded(spark, sf):
    return coverage.attach_grid(t.parts(spark, sf))


# Independent of the sweep: every covered row is listed, and islands are found by row number.
ISLANDS_SQL = f"""{t.PARTS_SQL},
touched AS (SELECT DISTINCT scene_id, resolution, tile, dimsize, tile_rows FROM covered),
tile_row AS (
  SELECT scene_id, resolution, tile, unnest(range(tile * tile_rows,
    least((tile + 1) * tile_rows, dimsize))) AS y FROM touched),
marked AS (
  SELECT r.scene_id, r.resolution, r.tile, r.y,
    CASE WHEN c.y IS NULL THEN 'gap' ELSE 'run' END AS kind
  FROM tile_row r LEFT JOIN covered c USING (scene_id, resolution, y)),
island AS (
  SELECT scene_id, resolution, tile, kind, CAST(min(y) AS INTEGER) AS start,
    CAST(max(y) + 1 AS INTEGER) AS stop
  FROM (SELECT *, y - row_number() OVER (PARTITION BY scene_id, resolution, tile, kind ORDER BY y) AS g
    FROM marked) GROUP BY scene_id, resolution, tile, kind, g)"""

WINDOW_GAPS_SQL = f"""{t.PARTS_SQL},
scene AS (SELECT DISTINCT scene_id, resolution, dimsize FROM parts JOIN grid USING (resolution)),
empty_row AS (
  SELECT s.scene_id, s.resolution, s.y
  FROM (SELECT scene_id, resolution, unnest(range(0, dimsize)) AS y FROM scene) s
  ANTI JOIN covered c USING (scene_id, resolution, y)),
window_gap AS (
  SELECT scene_id, resolution, CAST(min(y) AS INTEGER) AS gap_start, CAST(max(y) + 1 AS INTEGER) AS gap_stop
  FROM (SELECT *, y - row_number() OVER (PARTITION BY scene_id, resolution ORDER BY y) AS g FROM empty_row)
  GROUP BY scene_id, resolution, g)"""


@query(
    "tile_coverage",
    f"WITH {ISLANDS_SQL} SELECT scene_id, resolution, CAST(tile AS INTEGER) AS tile, kind, start, stop FROM island",
)
def tile_coverage(spark, sf):
    spans = coverage.tile_coverage(gridded(spark, sf))
    return spans.select("scene_id", "resolution", "tile", "kind", "start", "stop")


@query(
    "uncovered_rows",
    f"WITH {WINDOW_GAPS_SQL} SELECT scene_id, resolution, gap_start, gap_stop FROM window_gap",
)
def uncovered_rows(spark, sf):
    return coverage.uncovered_rows(gridded(spark, sf))


@query(
    "overlap_guard",
    f"""WITH {t.SHIFTED_SQL}, p AS (
        SELECT scene_id, event_id, row_start, row_stop FROM shifted WHERE row_start < row_stop),
      bad AS (
        SELECT a.scene_id, a.row_start AS "row", 'overlap' AS problem FROM p a JOIN p b
          ON b.scene_id = a.scene_id AND b.event_id <> a.event_id
          AND b.row_start <= a.row_start AND b.row_stop > a.row_start
        UNION ALL SELECT scene_id, row_start, 'empty' FROM shifted
          WHERE row_start >= row_stop AND row_start // 278 = (row_stop - 1) // 278 AND row_stop > 0)
      SELECT scene_id, CAST("row" AS INTEGER) AS "row", problem FROM (
        SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY "row", problem) AS rn FROM bad)
      WHERE rn = 1""",
)
def overlap_guard(spark, sf):
    parts = coverage.attach_grid(t.shifted_parts(spark, sf))
    return coverage.overlap_guard(parts).select("scene_id", "row", "problem")


@query(
    "exact_tiling",
    f"""WITH {t.BODY_SQL} SELECT user_id AS scene_id, CAST(event_id % 40 // 2 AS BIGINT) AS block,
      count(*) = 2 AND count(DISTINCT event_id % 40) = 2 AS exact FROM events
      GROUP BY user_id, event_id % 40 // 2""",
)
def exact_tiling(spark, sf):
    """Blocks of two chunks: exact where both are there, once."""
    rows = catalog.body_rows(spark).filter(
        (F.col("product_type") == "FDHSI") & (F.col("resolution") == "1km")
    )
    rows = rows.select(F.col("chunk_no") - 1, "row_start", "row_stop").toDF("n", "row_start", "row_stop")
    block = F.floor(F.col("n") / 2)
    ends = rows.groupBy(block.alias("block")).agg(
        F.min("row_start").alias("y_start"), F.max("row_stop").alias("y_stop")
    )
    events = t.read(spark, sf, "events").select(
        F.col("user_id").alias("scene_id"), F.pmod("event_id", F.lit(40)).cast("int").alias("n")
    )
    parts = events.join(F.broadcast(rows), "n").withColumn("block", block)
    parts = parts.join(F.broadcast(ends), "block")
    return coverage.exact_tiling(parts, ["scene_id", "block"])


@query(
    "coverage_summary",
    f"""WITH {ISLANDS_SQL}, missing AS (
        SELECT i.scene_id, i.resolution, b.chunk_no FROM island i JOIN body b
          ON b.product_type = 'FDHSI' AND b.resolution = i.resolution
          AND b.row_start < i.stop AND b.row_stop > i.start WHERE i.kind = 'gap' GROUP BY ALL)
      SELECT scene_id, resolution,
        CAST(sum(CASE WHEN kind = 'run' THEN stop - start ELSE 0 END) AS BIGINT) AS rows_written,
        CAST(sum(CASE WHEN kind = 'gap' THEN stop - start ELSE 0 END) AS BIGINT) AS gap_rows,
        count(*) FILTER (kind = 'gap') AS n_gaps,
        coalesce((SELECT string_agg(chunk_no, ',' ORDER BY chunk_no) FROM missing m
          WHERE m.scene_id = i.scene_id AND m.resolution = i.resolution), '') AS missing
      FROM island i GROUP BY scene_id, resolution""",
)
def coverage_summary(spark, sf):
    summary = coverage.coverage_summary(gridded(spark, sf))
    missing = F.coalesce(F.array_join("missing", ","), F.lit("")).alias("missing")
    return summary.select("scene_id", "resolution", "rows_written", "gap_rows", "n_gaps", missing)


def _describe_sql(gaps: str, kind: str) -> str:
    return f"""named AS (
      SELECT g.scene_id, g.resolution, string_agg('[' || g.a || ', ' || g.z || ')', ', ' ORDER BY g.a) AS rows_
      FROM {gaps} g GROUP BY g.scene_id, g.resolution),
    lost AS (
      SELECT scene_id, resolution, string_agg(chunk_no, ', ' ORDER BY chunk_no) AS chunks FROM (
        SELECT DISTINCT g.scene_id, g.resolution, b.chunk_no FROM {gaps} g JOIN body b
          ON b.product_type = 'FDHSI' AND b.resolution = g.resolution
          AND b.row_start < g.z AND b.row_stop > g.a) GROUP BY scene_id, resolution)
    SELECT scene_id, resolution, 'scene does not cover {kind} of group data_' || resolution || ' rows '
      || rows_ || '; missing BODY chunk(s) ' || chunks AS error
    FROM named JOIN lost USING (scene_id, resolution)"""


@query(
    "partial_chunk_error",
    f"""WITH {ISLANDS_SQL}, gaps AS (
      SELECT scene_id, resolution, start AS a, stop AS z FROM island WHERE kind = 'gap'),
      {_describe_sql("gaps", "the tiles it would write")}""",
)
def partial_chunk_error(spark, sf):
    return coverage.partial_problems(gridded(spark, sf), staged=False, partial_chunk="error")


@query(
    "staged_needs_window",
    f"""WITH {WINDOW_GAPS_SQL}, gaps AS (
      SELECT scene_id, resolution, gap_start AS a, gap_stop AS z FROM window_gap),
      {_describe_sql("gaps", "the window")}""",
)
def staged_needs_window(spark, sf):
    return coverage.partial_problems(gridded(spark, sf), staged=True, partial_chunk="fill")


@query(
    "groups_in_window",
    f"""WITH {t.PARTS_SQL}, {t.WINDOWS_SQL.removeprefix(t.BODY_SQL + ",")}
      SELECT DISTINCT scene_id, parts.resolution FROM parts JOIN win USING (resolution)
      WHERE row_start < y_stop AND row_stop > y_start""",
)
def groups_in_window(spark, sf):
    """Groups that get a write under a stripe: at least one part meets the window of its grid."""
    parts = coverage.attach_grid(t.parts(spark, sf), CubeConfig("FDHSI", body_chunks=(32, 40)))
    return coverage.clipped(parts).select("scene_id", "resolution").distinct()


PROBLEMS_SQL = f"""{t.SHIFTED_SQL},
p AS (SELECT scene_id, event_id, row_start, row_stop FROM shifted WHERE row_start < row_stop AND event_id % 23 <> 0),
bad AS (
  SELECT a.scene_id, a.row_start AS "row", 'overlap' AS problem FROM p a JOIN p b
    ON b.scene_id = a.scene_id AND b.event_id <> a.event_id
    AND b.row_start <= a.row_start AND b.row_stop > a.row_start
  UNION ALL SELECT scene_id, row_start, 'empty' FROM shifted WHERE event_id % 23 <> 0
    AND row_start >= row_stop AND row_start // 278 = (row_stop - 1) // 278 AND row_stop > 0),
cover AS (
  SELECT scene_id, problem || ' part rows at ' || CAST("row" AS INTEGER) AS error FROM (
    SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY "row", problem) AS rn FROM bad) WHERE rn = 1),
member AS (
  SELECT scene_id, event_id, event_id % 42 AS n, 'W_XX-FCI-1C-RRAD-FDHSI-FD--CHK-BODY---' || event_id || '_'
    || lpad(CAST(event_id % 42 AS VARCHAR), 4, '0') || '.nc' AS name FROM shifted),
twice AS (
  SELECT scene_id, min('equal part numbers: ' || lo || ' and ' || hi) AS error FROM (
    SELECT scene_id, n, min(name) AS lo, max(name) AS hi FROM member GROUP BY scene_id, n)
  WHERE lo <> hi GROUP BY scene_id),
broken AS (
  SELECT scene_id, min(name || ': broken') AS error FROM member WHERE event_id % 23 = 0 GROUP BY scene_id),
scene AS (
  SELECT DISTINCT scene_id FROM shifted UNION ALL SELECT DISTINCT user_id || '/none' FROM events),
judged AS (
  SELECT scene_id, coalesce(c.error, e.error, b.error,
    CASE WHEN scene_id LIKE '%/none' THEN 'no chunk could be read' END) AS error
  FROM scene LEFT JOIN cover c USING (scene_id) LEFT JOIN twice e USING (scene_id)
  LEFT JOIN broken b USING (scene_id))"""


def judged_scenes(spark, sf):
    """Scenes of delivered parts with their foremost problem.

    Every 23rd file cannot be decoded, so its rows are missing; a scene per user has no files at all.
    """
    parts = coverage.attach_grid(t.shifted_parts(spark, sf))
    event = F.col("event_id")
    number = F.pmod(event, F.lit(42)).cast("string")
    name = F.concat(
        F.lit("W_XX-FCI-1C-RRAD-FDHSI-FD--CHK-BODY---"), event, F.lit("_"), F.lpad(number, 4, "0"), F.lit(".nc")
    )
    files = parts.select("scene_id", event, F.pmod(event, F.lit(42)).alias("part_order"), name.alias("name"))
    parts = parts.filter(event % 23 != 0)
    tables = {n: spark.createDataFrame([], schema_of(n)) for n in TABLES}
    tables["members"] = files.select("scene_id", "part_order", "name")
    broken = F.concat("name", F.lit(": broken")).alias("error")
    tables["errors"] = files.filter(event % 23 == 0).select("scene_id", "part_order", broken)
    tables["chunk_rows"] = parts.select("scene_id", "chunk_no", "row_start", "row_stop")
    without = t.read(spark, sf, "events").select(F.concat("user_id", F.lit("/none")).alias("scene_id"))
    found = files.select("scene_id").distinct().unionByName(without.distinct())
    problems = scene_problems(found, Decoded(**tables), parts, CubeConfig("FDHSI"))
    return found.join(problems, "scene_id", "left")


@query("error_precedence", f"WITH {PROBLEMS_SQL} SELECT scene_id, error FROM judged")
def error_precedence(spark, sf):
    """Coverage comes before equal numbers, these before files that fail, these before none at all."""
    return judged_scenes(spark, sf).select("scene_id", "error")


@query(
    "failure_isolation",
    f"""WITH {PROBLEMS_SQL} SELECT count(*) FILTER (error IS NULL) AS files_processed,
      count(error) AS files_failed, count(*) AS count FROM judged""",
)
def failure_isolation(spark, sf):
    """Scenes with a problem are counted as failed; all others are processed."""
    return run_metrics(judged_scenes(spark, sf))
