"""ZIP archives to member files.

Archives that tasks can open are read in two steps: their directories become rows, and the members
that are left after any filter are read one by one, each by the task it is dealt to. An archive may
so be larger than a row or a task, and a member nobody asks for is never read.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlake.session import staged

MEMBER_SCHEMA = "archive string, name string, length bigint, content binary, error string"
ENTRY_SCHEMA = "archive string, entry string, name string, offset bigint, length bigint, error string"
ARCHIVES_PER_TASK = 8
BYTES_PER_TASK = 128 << 20
# A row of binary data ends at 2 GiB.
LARGEST_MEMBER = (1 << 31) - 64

#: Opens a path for reading at any position.
Opener = Callable[[str], BinaryIO]


def _unsafe(name: str) -> bool:
    clean = name.replace("\\", "/")
    return clean.startswith("/") or ":" in clean.split("/")[0] or ".." in clean.split("/")


def open_ranged(path: str) -> BinaryIO:
    """Open a local path, or one of a file system that Arrow knows, for reads of single ranges."""
    scheme, colon, rest = path.partition(":/")
    if not colon or scheme == "file":
        return open("/" + rest.lstrip("/") if colon else path, "rb")
    from pyarrow import fs

    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    filesystem, inner = fs.FileSystem.from_uri(f"{scheme}:/{rest}")
    return filesystem.open_input_file(inner)


def _entries(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """Files of an archive; one with an unsafe path makes the whole archive bad."""
    entries = [e for e in archive.infolist() if not e.is_dir()]
    bad = next((e.filename for e in entries if _unsafe(e.filename)), None)
    if bad is not None:
        raise ValueError(f"unsafe member path {bad!r}")
    return entries


def _text(exc: Exception) -> str:
    return f"{type(exc).__name__}: {exc}"


def list_members(archives: DataFrame, opener: Opener = open_ranged) -> DataFrame:
    """The directory of each ZIP in ``path``, one row per member; nothing but directories is read.

    A bad archive gives one row with ``error`` set and no name. The table is written once.
    """

    def listing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "entry", "name", "offset", "length", "error"]
        for batch in batches:
            for path in batch["path"]:
                try:
                    with opener(path) as handle, zipfile.ZipFile(handle) as archive:
                        rows = [
                            (path, e.filename, posixpath.normpath(e.filename), e.header_offset, e.file_size, None)
                            for e in _entries(archive)
                        ]
                except Exception as exc:  # noqa: BLE001 - one bad archive must not stop the others
                    rows = [(path, None, None, None, None, _text(exc))]
                yield pd.DataFrame(rows, columns=columns)

    paths = archives.select("path")
    # Spread by number: adaptive execution sees short paths and would put all of them in one task.
    tasks = -(-paths.count() // ARCHIVES_PER_TASK) or 1
    return staged(paths.repartition(tasks, "path").mapInPandas(listing, ENTRY_SCHEMA), "members")


def read_members(entries: DataFrame, opener: Opener = open_ranged) -> DataFrame:
    """Contents of listed members, one row each; ``error`` is set where a member cannot be read.

    Members are dealt to tasks by hash, about as many as hold the bytes of a task, so those of one
    large archive spread. Rows that are errors already pass through.
    """

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "name", "length", "content", "error"]
        path, archive, handle = None, None, None
        try:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    if row.entry is None:
                        yield pd.DataFrame([(row.archive, row.name, None, None, row.error)], columns=columns)
                        continue
                    try:
                        if row.length > LARGEST_MEMBER:
                            raise ValueError(f"member of {row.length:.0f} bytes does not fit a row")
                        if path != row.archive:
                            if archive is not None:
                                archive.close()
                                handle.close()
                                path, archive = None, None
                            handle = opener(row.archive)
                            path, archive = row.archive, zipfile.ZipFile(handle)
                        content = archive.read(row.entry)
                        found = (row.archive, row.name, len(content), content, None)
                    except Exception as exc:  # noqa: BLE001 - one bad member must not stop the others
                        found = (row.archive, row.name, None, None, _text(exc))
                    yield pd.DataFrame([found], columns=columns)
        finally:
            if archive is not None:
                archive.close()
                handle.close()

    total = entries.agg(F.sum(F.coalesce("length", F.lit(0)))).first()[0] or 0
    tasks = int(total // BYTES_PER_TASK) + 1
    dealt = entries.repartition(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInPandas(contents, MEMBER_SCHEMA)


def unpack_archives(files: DataFrame) -> DataFrame:
    """Members of each ZIP, one row per member; a bad archive gives one row with ``error`` set.

    ``files`` has ``path`` and optionally ``content``, which then is the whole archive. Without
    contents, tasks open the paths themselves and read member by member. The members of a content
    that fails halfway are followed by its error row: drop archives that have one.
    """
    if "content" not in files.columns:
        return read_members(list_members(files))

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "name", "length", "content", "error"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        for entry in _entries(archive):
                            name = posixpath.normpath(entry.filename)
                            member = (path, name, entry.file_size, archive.read(entry), None)
                            yield pd.DataFrame([member], columns=columns)
                except Exception as exc:  # noqa: BLE001 - one bad archive must not stop the others
                    yield pd.DataFrame([(path, None, None, None, _text(exc))], columns=columns)

    return files.select("path", "content").mapInPandas(unpack, MEMBER_SCHEMA)
