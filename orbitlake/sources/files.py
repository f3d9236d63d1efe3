"""Listing of input files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlake.functions.names import item_name


def _glob_pattern(glob: str) -> str:
    special = {"*": ".*", "?": "."}
    return "^" + "".join(special.get(c, c if c.isalnum() else "\\" + c) for c in glob) + "$"


def name_filter(path: Column, filters: Sequence[str]) -> Column:
    """Name globs; ``!glob`` excludes. Without a positive glob everything not excluded passes."""
    name = item_name(path)
    wanted = [name.rlike(_glob_pattern(g)) for g in filters if not g.startswith("!")]
    unwanted = [name.rlike(_glob_pattern(g[1:])) for g in filters if g.startswith("!")]
    keep = reduce(Column.__or__, wanted) if wanted else F.lit(True)
    return reduce(lambda kept, bad: kept & ~bad, unwanted, keep)


def list_inputs(
    spark: SparkSession,
    path: str | list[str],
    filters: Sequence[str] = (),
    content: bool = False,
    pattern: str | None = None,
) -> DataFrame:
    """Files below a local or remote path with their sizes; contents are read only on request.

    Without ``content`` the bytes are pruned from the scan, so this is a pure listing. ``pattern``
    is a glob of file names: files of other names are not opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)
    columns = ["path", "length", "modificationTime"] + (["content"] if content else [])
    return files.filter(name_filter(F.col("path"), filters)).select(
        *columns, item_name(F.col("path")).alias("name")
    )
