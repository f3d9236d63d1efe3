"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# UTC: slot labels and day boundaries are UTC wall-clock values.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings this package relies on to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Run an action under another value of a run-time setting."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ship(*packages: ModuleType) -> None:
    """Send the code of these packages along with every task that uses it.

    For sessions whose Python workers do not have the packages installed.
    """
    for package in packages:
        cloudpickle.register_pickle_by_value(package)


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; anywhere else the setting is
    required, because a machine-local folder is lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="orbitlake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """Return a fresh path below the shared folder; every call gives another one."""
    return f"{checkpoint_root(spark)}/orbitlake/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one of our own scratch tables from the shared folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def literal_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A table of given rows that stays in the plan, so that reading it needs no job."""
    schema = T.StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    arrays = [pa.array(list(values), field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    This cuts the lineage: a lost executor re-reads files instead of decoding inputs again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
