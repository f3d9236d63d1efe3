"""Chunk files to decoded tables through a caller-supplied decoder.

The codec of the files is the caller's: a decoder gets one file and yields rows of the decoded
tables. Everything after that is DataFrame work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orbitlake.constants import CONVERSION_CONSTANTS, PLATFORM_COLUMNS
from orbitlake.session import scratch_path

# Columns of each decoded table besides scene_id and part_order.
TABLES: dict[str, dict[str, str]] = {
    "chunk_rows": {
        "chunk_no": "int", "nc_channel": "string", "row_start": "int", "row_stop": "int",
    },
    "scan_in": {
        "nc_channel": "string", "y": "int", "counts": "array<int>",
        "quality": "array<smallint>", "index_map": "array<int>",
    },
    "time_rows": {"row_no": "int", "idx": "bigint", "time_s": "double"},
    "platform_rows": {
        "row_no": "int", "idx": "bigint", **{name: "double" for name in PLATFORM_COLUMNS},
    },
    "calib_rows": {
        "nc_channel": "string", "slope": "double", "offset": "double",
        "warm_slope": "double", "warm_offset": "double",
        **{name: "double" for name in CONVERSION_CONSTANTS},
    },
    "members": {"name": "string"},
    "errors": {"error": "string"},
}
KEY = {"scene_id": "string", "part_order": "bigint"}


def schema_of(table: str) -> T.StructType:
    columns = {**KEY, **TABLES[table]}
    return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in columns.items()))


def _tagged_schema() -> str:
    columns = {"table": "string", **KEY}
    for extra in TABLES.values():
        columns |= extra
    return ", ".join(f"{name} {dtype}" for name, dtype in columns.items())


TAGGED_SCHEMA = _tagged_schema()
FLUSH_BYTES = 32 << 20
FLUSH_ROWS = 1 << 14
SMALL_ROWS = 64

# (file name, content, wanted rows per file channel) -> (table name, column name -> values)
Decoder = Callable[
    [str, bytes, Mapping[str, tuple[int, int]]], Iterator[tuple[str, Mapping[str, Any]]]
]


def _plain(values: Any, kind: pa.DataType, rows: int) -> bool:
    """Whether these are so many simple values that surely fit the type, so that they can wait for others."""
    if type(values) is not list or len(values) != rows:
        return False
    if pa.types.is_string(kind):
        return all(v is None or (type(v) is str and v.isascii()) for v in values)
    if pa.types.is_integer(kind):
        top = 1 << (kind.bit_width - 1)
        return all(v is None or (type(v) is int and -top <= v < top) for v in values)
    return pa.types.is_floating(kind) and all(v is None or type(v) is float for v in values)


@dataclass(frozen=True)
class Decoded:
    """The decoded tables of a set of scenes."""

    chunk_rows: DataFrame
    scan_in: DataFrame
    time_rows: DataFrame
    platform_rows: DataFrame
    calib_rows: DataFrame
    members: DataFrame
    errors: DataFrame


def decode_chunks(
    members: DataFrame, decoder: Decoder, wanted: Mapping[str, tuple[int, int]] | None = None
) -> DataFrame:
    """Decode ``(scene_id, part_order, name, content)`` files to tagged rows of all tables.

    Each file is opened once and all its tables leave together. ``wanted`` maps file channels to the
    rows to keep; the decoder skips pixel arrays outside them, which Catalyst cannot push into
    Python. A file that fails gives one ``errors`` row and the others go on; rows leave in batches of
    a bounded size, those of many small files together.
    """
    wanted = dict(wanted or {})
    arrow_schema = to_arrow_schema(T.StructType.fromDDL(TAGGED_SCHEMA))

    fields = {field.name: field for field in arrow_schema}

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of many small files leave together: plain values become arrays once, not file by file.
        plain: dict[tuple[str, ...], dict[str, list]] = {}
        ready: dict[tuple[str, ...], list[pa.RecordBatch]] = {}
        size = rows = 0

        def take(table: str, scene: str, part: int, columns: Mapping[str, Any]) -> None:
            nonlocal size, rows
            n = len(next(iter(columns.values())))
            given = {"table": [table] * n, "scene_id": [scene] * n, "part_order": [part] * n, **columns}
            names = tuple(name for name in given if name in fields)
            if n <= SMALL_ROWS and all(_plain(values, fields[name].type, n) for name, values in columns.items() if name in fields):
                held = plain.setdefault(names, {name: [] for name in names})
                for name in names:
                    held[name].extend(given[name])
            else:
                found = batch_of(names, given)
                ready.setdefault(names, []).append(found)
                size += found.nbytes
            rows += n

        def out() -> Iterator[pa.RecordBatch]:
            for names, given in plain.items():
                ready.setdefault(names, []).append(batch_of(names, given))
            for names, parts in ready.items():
                whole = pa.concat_batches(parts)
                arrays = [
                    whole.column(name) if name in names else pa.nulls(whole.num_rows, field.type)
                    for name, field in fields.items()
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

        for batch in batches:
            for index in range(batch.num_rows):
                scene, part, name, content = (column[index].as_py() for column in batch.columns)
                take("members", scene, part, {"name": [name]})
                try:
                    for table, columns in decoder(name, content, wanted):
                        take(table, scene, part, columns)
                        if size > FLUSH_BYTES or rows > FLUSH_ROWS:
                            yield from out()
                            plain, ready, size, rows = {}, {}, 0, 0
                except Exception as exc:  # noqa: BLE001 - one bad file must not stop the others
                    take("errors", scene, part, {"error": [f"{name}: {exc}"]})
        yield from out()

    def batch_of(names: tuple[str, ...], given: Mapping[str, Any]) -> pa.RecordBatch:
        arrays = [pa.array(given[name], fields[name].type, from_pandas=True) for name in names]
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([fields[name] for name in names]))

    return members.select("scene_id", "part_order", "name", "content").mapInArrow(
        decode, TAGGED_SCHEMA
    )


def table_rows(tagged: DataFrame, table: str) -> DataFrame:
    """Rows of one decoded table with its own columns."""
    return tagged.filter(F.col("table") == table).select(*schema_of(table).fieldNames())


def write_decoded(tagged: DataFrame, path: str | None = None) -> str:
    """Write tagged rows once, one folder per table; files are decoded exactly once."""
    path = path or scratch_path(tagged.sparkSession, "decoded")
    tagged.write.partitionBy("table").mode("append").parquet(path)
    return path


def read_decoded(spark: SparkSession, path: str) -> Decoded:
    """Open decoded tables written by ``write_decoded`` (or by any other producer of them)."""
    tagged = spark.read.schema(TAGGED_SCHEMA).parquet(path)
    return Decoded(**{table: table_rows(tagged, table) for table in TABLES})
