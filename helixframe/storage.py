"""Cuts of the lineage: tables in the folder that driver and executors share.

Each call writes at once, so a function that uses one runs Spark jobs while its plan is built."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only in local mode without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="helixframe-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder; what is written there goes when the driver's Python ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Writes df once to the shared folder and reads it back: the rows are settled, and a lost
    executor costs no recomputation. The files go when they are released, or when the driver's
    Python ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.scratch_path = path
    return table


def release(*tables: DataFrame | str) -> None:
    """Deletes scratch tables (or places) that nothing will read any more."""
    for table in tables:
        path = table if isinstance(table, str) else table.scratch_path
        if (spark := _written.pop(path, None)) is not None:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _clean() -> None:
    while _written:
        path, spark = _written.popitem()
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  this session may be gone at exit; others may not
            continue


atexit.register(_clean)
