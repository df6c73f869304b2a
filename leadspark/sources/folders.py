"""Folders of the shared store: what is in them, tables that may not be there yet, and deletion."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def numbered(spark: SparkSession, path: str, label: str) -> list[int]:
    """The numbers of the folders ``label=<number>`` that were written to their end, in order."""
    place, fs = _at(spark, path)
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    found = [name for name in names if name.startswith(f"{label}=")]
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(name.split("=")[1]) for name in found if fs.exists(jvm_path(f"{path}/{name}/_SUCCESS")))


def drop_folder(spark: SparkSession, path: str) -> None:
    place, fs = _at(spark, path)
    fs.delete(place, True)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at a path, or nothing if there is no such path. Any other failure is raised."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
