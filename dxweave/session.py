"""Where shared scratch data goes, and the few folder operations that need no job."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared directory that ``spark.checkpoint.dir`` names.

    A session without that setting is an error: a folder of one machine is lost with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reaches, sorted; none if it is not there."""
    place, files = _folder(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote; nothing happens if it is not there."""
    place, files = _folder(spark, path)
    files.delete(place, True)


def known_to_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package also where only the driver's path holds it (local mode)."""
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, (root, environment.get("PYTHONPATH"))))
