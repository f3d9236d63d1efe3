"""File names, slots and the Sun distance, with pinned values."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orbitlake.functions import ephemeris, names, slots

ZIP = (
    "any text FCI-1C-RRAD-FDHSI-FD more_20270211083512_20270211083019_20270211083944_end.zip"
)


def chunk(kind="BODY", start="20270306000241", cycle=144, number=1, product="FDHSI"):
    return (
        f"W_XX-FCI-1C-RRAD-{product}-FD--CHK-{kind}---NC4E_C_XXXX_{start}_IDPFI_OPE_{start}_{start}"
        f"_N__O_{cycle:04d}_{number:04d}.nc"
    )


def evaluate(spark, column, *values, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.out for r in rows.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()]


def test_sensing_start_takes_the_second_last_stamp(spark):
    got = evaluate(
        spark, names.sensing_start, "s3://b/x/" + ZIP, "a_20240102030405.zip", "a_20241301000000.zip",
        "a_20240101000060.zip", "none.zip",
    )
    assert got == [dt.datetime(2027, 2, 11, 8, 30, 19), dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None]


def test_kinds(spark):
    got = evaluate(
        spark, names.item_kind, "s3://b/" + ZIP, chunk(), chunk("TRAIL"), "preview.jpg", "a.xml",
        chunk("HEAD"), chunk().replace("RRAD", "XXXX"), ZIP.replace(".zip", ".ZIP"), ZIP[:-4] + ".nc",
        chunk()[:-20] + "short.nc",
    )
    assert got == ["zip", "chunk", "chunk"] + ["ignored"] * 6 + ["chunk"]


def test_chunk_fields_and_errors(spark):
    good, garbage, product, start = evaluate(
        spark, names.parse_chunk_name, "s3://b/" + chunk("TRAIL", number=41),
        chunk()[:-20] + "short.nc", chunk(product="OTHER"),
        chunk(start="20271306000241"),
    )
    assert (good.product_type, good.repeat_cycle, good.chunk_no, good.is_trail) == ("FDHSI", 144, 41, True)
    assert good.error is None
    assert "cannot parse" in garbage.error
    assert "no product type" in product.error
    assert "invalid sensing start" in start.error


def test_fdhsi_wins_over_hrfi(spark):
    assert evaluate(spark, names.detect_product, "HRFI_FDHSI", "HRFI", "x") == ["FDHSI", "HRFI", None]


def test_part_number(spark):
    assert evaluate(spark, names.part_number, "a_0012.nc", "a.NC", "b7.NC", "c.zip") == [12, 0, 7, 0]


@pytest.mark.parametrize(
    ("epoch", "ts", "slot"),
    [
        ("2027-02-27", "2027-02-27 00:00:00", 0),
        ("2027-02-27", "2027-02-27 07:39:59", 45),
        ("2027-02-27", "2027-02-27 07:40:00", 46),
        ("2027-02-27", "2027-03-01 00:10:30", 289),
        ("1999-12-31", "2000-01-01 01:05:00", 150),
    ],
)
def test_slot_index(spark, epoch, ts, slot):
    column = slots.slot_index(F.lit(ts).cast("timestamp_ntz"), epoch)
    assert spark.range(1).select(column).first()[0] == slot


def test_slot_index_refuses_what_is_off_the_axis(spark):
    early = F.lit("2027-02-26 23:59:59").cast("timestamp_ntz")
    with pytest.raises(PySparkException, match="outside the slot axis"):
        spark.range(1).select(slots.slot_index(early, "2027-02-27")).collect()
    assert spark.range(1).select(slots.slot_index(early, "2027-02-27", strict=False)).first()[0] is None
    late = F.lit("2027-02-27 00:20:00").cast("timestamp_ntz")
    with pytest.raises(PySparkException, match="outside the slot axis"):
        spark.range(1).select(slots.slot_index(late, "2027-02-27", slot_count=2)).collect()


def test_total_slots():
    assert slots.total_slots(10, "2026-03-17", "2026-03-15") == 10
    assert slots.total_slots(None, "2026-03-17", "2026-03-15") == 288
    assert slots.total_slots() is None
    for bad in ((0, None), (None, "2026-03-15")):
        with pytest.raises(ValueError):
            slots.total_slots(*bad, "2026-03-15")


def test_nominal_cycle_start(spark):
    def nominal(start, cycle):
        column = slots.nominal_cycle_start(F.lit(start).cast("timestamp_ntz"), F.lit(cycle))
        return spark.range(1).select(column).first()[0]

    assert nominal("2027-03-01 00:01:17", 144) == dt.datetime(2027, 2, 28, 23, 50)
    assert nominal("2027-03-01 23:51:17", 144) == dt.datetime(2027, 3, 1, 23, 50)
    assert nominal("2027-03-01 08:31:40", 52) == dt.datetime(2027, 3, 1, 8, 30)
    # Five minutes ahead still belong to the day, a second more does not.
    assert nominal("2027-03-01 08:25:00", 52) == dt.datetime(2027, 3, 1, 8, 30)
    assert nominal("2027-03-01 08:24:59", 52) == dt.datetime(2027, 2, 28, 8, 30)
    for cycle in (0, 145, -1):
        with pytest.raises(PySparkException, match="repeat cycle"):
            nominal("2027-03-01 00:01:17", cycle)


@pytest.mark.parametrize(
    ("ts", "distance", "tolerance"),
    [
        ("2025-06-15 12:14:40", 1.0157259, 2e-7),
        ("2026-09-28 12:24:30", 1.0020210, 2e-7),
        ("2026-09-29 00:14:30", 1.0018826, 2e-7),
        ("2026-01-03 17:16:00", 0.98330, 1e-5),
        ("2026-07-06 17:31:00", 1.01664, 1e-5),
    ],
)
def test_sun_earth_distance(spark, ts, distance, tolerance):
    column = ephemeris.sun_earth_distance(F.lit(ts).cast("timestamp_ntz"))
    assert spark.range(1).select(column).first()[0] == pytest.approx(distance, abs=tolerance)
