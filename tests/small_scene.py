"""A three-chunk scene on a small grid, as decoded by a JSON stand-in for the file codec."""

import json
import zipfile

from orbitlake import constants as K

LAYOUT = {
    ("FDHSI", "1km"): ([("vis_04", "vis_04"), ("vis_06", "vis_06")], 24),
    ("FDHSI", "2km"): ([("ir_38", "ir_38")], 12),
}
PARTS = 3
TILE = 3


def shrink(monkeypatch):
    """Replace the real grids by the small ones."""
    monkeypatch.setattr(K, "CHANNELS", {key: channels for key, (channels, _size) in LAYOUT.items()})
    for (product, resolution), (_channels, size) in LAYOUT.items():
        monkeypatch.setitem(K.DIMSIZE, resolution, size)
        monkeypatch.setitem(K.TILE_ROWS, resolution, TILE)
        ends = [size // PARTS * n for n in range(1, PARTS + 1)]
        monkeypatch.setitem(K.CHUNK_ROW_ENDS, (product, resolution), ends)


def name(number, cycle=1, product="FDHSI", kind="BODY", start=None):
    start = start or f"20240101{(cycle - 1) // 6:02d}{(cycle - 1) % 6}001"
    return (
        f"W_XX-FCI-1C-RRAD-{product}-FD--CHK-{kind}---NC4E_C_XXXX_{start}_IDPFI_OPE_{start}_{start}"
        f"_N__O_{cycle:04d}_{number:04d}.nc"
    )


def indices(number):
    first = 4 * (number - 1)
    return list(range(first, min(first + 6, 4 * PARTS)))


def counts(channel, y, size):
    return [10000 * (channel + 1) + 100 * y + x for x in range(size)]


def index_of(number, y, size):
    rows = size // PARTS
    local = y - rows * (number - 1)
    if number < PARTS and local == rows - 1:
        return indices(number)[0] + 4
    return indices(number)[0] + 4 * local // rows


def write_parts(folder, numbers, **options):
    folder.mkdir(parents=True)
    for number in numbers:
        (folder / name(number, **options)).write_text(json.dumps({"number": number}))
    return folder


def zip_parts(folder, numbers):
    folder.mkdir(parents=True)
    with zipfile.ZipFile(folder / "W_XX-FCI-1C-RRAD-FDHSI-FD-20240101000000-END.zip", "w") as archive:
        for number in numbers:
            archive.writestr("inner/" + name(number), json.dumps({"number": number}))
        archive.writestr("inner/readme.txt", "not a chunk")
    return folder


def decoder(file_name, content, wanted):
    number = json.loads(content)["number"]
    idx = indices(number)
    n = list(range(len(idx)))
    yield "time_rows", {"row_no": n, "idx": idx, "time_s": [100.0 * i + number for i in idx]}
    yield (
        "platform_rows",
        {
            "row_no": n,
            "idx": idx,
            "subsatellite_latitude": [10.0 + i for i in idx],
            "subsatellite_longitude": [20.0 + 2 * i for i in idx],
            "platform_altitude": [35786000.0 + 1000 * i for i in idx],
        },
    )
    for channels, size in LAYOUT.values():
        rows = size // PARTS
        start, stop = rows * (number - 1), rows * number
        for position, (_channel, nc_channel) in enumerate(channels):
            yield (
                "chunk_rows",
                {
                    "chunk_no": [number],
                    "nc_channel": [nc_channel],
                    "row_start": [start],
                    "row_stop": [stop],
                },
            )
            yield (
                "calib_rows",
                {"nc_channel": [nc_channel], "slope": [position + 1.0], "offset": [float(position)]},
            )
            if nc_channel not in wanted:
                continue
            low, high = wanted[nc_channel]
            ys = [y for y in range(start, stop) if low <= y < high]
            if ys:
                yield (
                    "scan_in",
                    {
                        "nc_channel": [nc_channel] * len(ys),
                        "y": ys,
                        "counts": [counts(position, y, size) for y in ys],
                        "quality": [[(y + x) % 4 for x in range(size)] for y in ys],
                        "index_map": [[index_of(number, y, size)] * size for y in ys],
                    },
                )
