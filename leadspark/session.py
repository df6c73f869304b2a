"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings every job of this package relies on; sizes are left to the cluster."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        # Ranks up to this are pruned in each task before the shuffle.
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "100000")
    )


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Where the setting is missing, a local session gets a temporary folder of its own;
    on a cluster the missing setting is an error, as a machine-local folder is lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="leadspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/leadspark-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run here go when their query ends, as their rows are written by then."""
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def keep(df: DataFrame) -> DataFrame:
    """Write the rows to a new shared folder now and read them back.

    For rows that several results are built from: they are computed once, and a lost executor
    costs a read of files that every executor can reach. The job's shuffle files go with it.
    """
    path = shared_folder(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
