"""Decoded rows of many small files."""

import json

import pyarrow as pa
import pytest

from orbitlake.sources.chunks import TAGGED_SCHEMA, decode_chunks


class Members:
    """Files that a test hands to the decoding function itself, to see its batches."""

    def select(self, *_columns):
        return self

    def mapInArrow(self, function, schema):  # noqa: N802 - the name of Spark
        assert schema == TAGGED_SCHEMA
        return function


def decoder(name, content, wanted):
    found = json.loads(content)
    yield "time_rows", {"row_no": [0], "idx": [found["idx"]], "time_s": [1.5, 2.5][: found.get("n", 1)]}
    yield "scan_in", {"nc_channel": ["vis_04"], "y": [1], "counts": [[1, 2]]}


def run(contents):
    rows = len(contents)
    files = pa.RecordBatch.from_pydict(
        {
            "scene_id": [str(i) for i in range(rows)],
            "part_order": list(range(rows)),
            "name": [f"{i}.nc" for i in range(rows)],
            "content": [json.dumps(c).encode() for c in contents],
        }
    )
    return list(decode_chunks(Members(), decoder)(iter([files.slice(i, 4) for i in range(0, rows, 4)])))


@pytest.mark.usefixtures("spark")
def test_rows_of_many_files_leave_in_few_batches():
    found = run([{"idx": i} for i in range(400)])
    assert len(found) < 10
    rows = pa.Table.from_batches(found).to_pylist()
    times = sorted((r["part_order"], r["scene_id"], r["idx"], r["time_s"]) for r in rows if r["table"] == "time_rows")
    assert times == [(i, str(i), i, 1.5) for i in range(400)]
    lines = sorted((r["part_order"], *r["counts"]) for r in rows if r["table"] == "scan_in")
    assert lines == [(i, 1, 2) for i in range(400)]
    assert sorted(r["name"] for r in rows if r["table"] == "members") == sorted(f"{i}.nc" for i in range(400))


@pytest.mark.usefixtures("spark")
@pytest.mark.parametrize("bad", [{"idx": "a"}, {"idx": 1 << 63}, {"idx": 2, "n": 2}])
def test_a_file_of_bad_values_fails_alone(bad):
    rows = pa.Table.from_batches(run([{"idx": 1}, bad, {"idx": None}])).to_pylist()
    assert [r["error"].split(":")[0] for r in rows if r["table"] == "errors"] == ["1.nc"]
    assert sorted(r["part_order"] for r in rows if r["table"] == "time_rows") == [0, 2]
    assert sorted(r["part_order"] for r in rows if r["table"] == "scan_in") == [0, 2]
