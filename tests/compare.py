"""Compare a Spark result with the DuckDB result of the same query."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def kind(column) -> str:
    return {"i": "int", "u": "int", "f": "float", "b": "bool"}.get(column.dtype.kind, "other")


def cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value.item() if hasattr(value, "item") else value)


def rows(frame) -> list[tuple]:
    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(cell(v) for v in row) for row in ordered.itertuples(index=False))


def mismatch(spark_frame, sql_frame) -> str | None:
    """None when both frames hold the same columns, kinds and rows, else what differs first."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} rows != {len(sql_frame)}"
    for name in spark_frame.columns:
        if kind(spark_frame[name]) != kind(sql_frame[name]):
            return f"{name}: {spark_frame[name].dtype} != {sql_frame[name].dtype}"
    for left, right in zip(rows(spark_frame), rows(sql_frame)):
        if left != right:
            return f"{left} != {right}"
    return None


def main() -> int:
    """``python tests/compare.py <sf_dir> [query ...]``"""
    from pyspark.sql import SparkSession

    import workload

    sf_dir, wanted = sys.argv[1], sys.argv[2:] or list(workload.QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    con, bad = connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            got = workload.QUERIES[name](spark, sf_dir).toPandas()
            spent = time.time() - start
            if name in workload.SQL:
                expected = con.execute(workload.SQL[name]).df()
                problem = mismatch(got, expected)
            else:
                problem = None if len(got) else "no rows"
            status = "ok" if problem is None else f"BAD {problem}"
        except Exception as exc:  # noqa: BLE001 - report and go on
            spent, status = time.time() - start, f"ERR {str(exc)[:600]}"
        bad += status != "ok"
        print(f"{name:32s} {spent:6.1f}s {len(got) if status == 'ok' else '':>8} {status}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
