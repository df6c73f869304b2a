"""Rows that come by batch, read as one snapshot and the batches after it.

A batch writes its rows under its own number, so a repeated batch replaces its rows. Every so many batches the newest
snapshot and the batches after it are folded into a new snapshot, whose number says up to which batch it holds. A read
touches the newest snapshot and the batches after it. The last two snapshots are kept, with the batches after the older
one, so that a batch that is repeated after its snapshot was written finds what it was made from.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadspark.sources.folders import drop_folder, numbered

#: Brings rows of several batches down to those that still count. It may be applied to its own result.
Fold = Callable[[DataFrame], DataFrame]

#: Batches after which a new snapshot is written.
EVERY = 16


def latest_of(keys: Sequence[str]) -> Fold:
    """The row of the last batch for each key; values may be of any type."""

    def fold(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in keys]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_r"))
        return last.select([F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in rows.columns])

    return fold


def _after(spark: SparkSession, path: str, snapshot: int | None, upto: int | None = None) -> DataFrame | None:
    """The snapshot's rows and those of the batches after it, as they were written."""
    batches = [b for b in numbered(spark, f"{path}/batches", "batch") if b > (-1 if snapshot is None else snapshot) and (upto is None or b <= upto)]
    parts = [f"{path}/batches/batch={b}" for b in batches]
    if snapshot is not None:
        parts.append(f"{path}/snapshots/upto={snapshot}")
    return spark.read.parquet(*parts) if parts else None


def write_batch(rows: DataFrame, batch_id: int, path: str, fold: Fold, every: int = EVERY) -> None:
    """Write the rows of a batch, and a snapshot where one is due."""
    spark = rows.sparkSession
    rows.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/batches/batch={batch_id}")
    if (batch_id + 1) % every:
        return
    snapshots = [s for s in numbered(spark, f"{path}/snapshots", "upto") if s < batch_id]
    base = snapshots[-1] if snapshots else None
    fold(_after(spark, path, base, batch_id)).write.mode("overwrite").parquet(f"{path}/snapshots/upto={batch_id}")
    for old in snapshots[:-1]:
        drop_folder(spark, f"{path}/snapshots/upto={old}")
    if base is not None:
        for old in numbered(spark, f"{path}/batches", "batch"):
            if old <= base:
                drop_folder(spark, f"{path}/batches/batch={old}")


def read_compacted(spark: SparkSession, path: str, fold: Fold) -> DataFrame:
    """What the batches so far add up to, with the number of each row's last batch."""
    snapshots = numbered(spark, f"{path}/snapshots", "upto")
    rows = _after(spark, path, snapshots[-1] if snapshots else None)
    if rows is None:
        raise ValueError(f"no batch has been written to {path}")
    return fold(rows)
