"""Streams: ingest, deduplication, scoring, funnel, liveness and source failures.

Every batch writes under its own id or through the key-respecting append, so a batch that is
repeated after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from leadspark import schemas as S
from leadspark.functions.phrases import text_has_any
from leadspark.functions.text import present
from leadspark.functions.times import Moment
from leadspark.operators.filters import post_text, within_lookback
from leadspark.operators.keyed import POST_KEY, first_per_key
from leadspark.operators.state import fold_attempts, merge_folds
from leadspark.session import keep
from leadspark.sources.folders import drop_folder, numbered, read_if_there
from leadspark.streaming.compacted import EVERY, latest_of, read_compacted, write_batch


#: Parts that the keys of an ingested table are dealt into; a table keeps the number it was begun with.
KEY_PARTS = 64


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at a path, or an empty one before the first write."""
    found = read_if_there(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def with_event_time(src: DataFrame, column: str, late: str) -> DataFrame:
    """Watermark a stream; time columns without a zone are taken as UTC, as watermarks need a zone."""
    if isinstance(src.schema[column].dataType, T.TimestampNTZType):
        src = src.withColumn(column, F.col(column).cast(T.TimestampType()))
    return src.withWatermark(column, late)


def key_part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def keys_in_parts(held: DataFrame, touched: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """Stored keys of the named parts; no other part is listed or read."""
    return held.filter(F.col("key_part").isin(list(touched))).select("key_part", *keys)


def append_to_parts(
    arrived: DataFrame, table: str, keys: Sequence[str] = POST_KEY, order_by: Sequence[Column | str] = ("scraped_at",), parts: int = KEY_PARTS
) -> None:
    """Append the first arrival of each key that the table doesn't hold.

    The table is stored by part of its key (column ``key_part``). The arrivals are read once and kept; stored keys are
    read from the parts they fall into only. Rows already there when a failed append is repeated count as stored.
    """
    spark = arrived.sparkSession
    dealt = keep(first_per_key(arrived, keys, order_by).withColumn("key_part", key_part(keys, parts)))
    # At most one number for each part.
    touched = [r.key_part for r in dealt.select("key_part").distinct().collect()]
    # Stored columns are compared by name: a table of other columns, or of another number of parts, is an error.
    held = read_if_there(spark, table)
    if held is not None:
        if sorted(held.columns) != sorted(dealt.columns):
            raise ValueError(f"{table} has the columns {sorted(held.columns)}, the arrivals {sorted(dealt.columns)}")
        dealt = dealt.join(keys_in_parts(held, touched, keys), ["key_part", *keys], "left_anti")
    dealt.write.mode("append").partitionBy("key_part").parquet(table)


def ingest_stream(
    src: DataFrame, table: str, checkpoint: str, keys: Sequence[str] = POST_KEY, order_by: Sequence[Column | str] = ("scraped_at",), parts: int = KEY_PARTS
) -> DataStreamWriter:
    """Append the first arrival of each key, ever, to the table."""

    def load(batch: DataFrame, _: int) -> None:
        append_to_parts(batch, table, keys, order_by, parts)

    return src.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)


def dedup_stream(src: DataFrame, event_time: str, horizon: str, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """First arrivals per key within the horizon; state is bounded, so later repeats pass again."""
    return with_event_time(src, event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


def lookback_stream(src: DataFrame, event_time: str, as_of: Moment | None = None, hours: float = 24) -> DataFrame:
    """Mark rows older than the lookback as late; with ``as_of``, drop those older than that moment's lookback."""
    kept = src if as_of is None else within_lookback(src, event_time, as_of, hours)
    return with_event_time(kept, event_time, f"{int(hours * 3600)} seconds")


def moving_lookback(src: DataFrame, event_time: str, out: str, checkpoint: str, hours: float = 24) -> DataStreamWriter:
    """Write the rows no older than the lookback when they arrive; read them with ``fresh_rows``.

    The stream's clock is the greatest event time of this and all earlier batches, so the cutoff moves on with the
    stream and never back. A batch writes its clock and its rows under its own number, and a repeated batch the same
    again. Rows without a time are dropped.
    """
    width = F.expr(f"interval {int(hours * 3600)} seconds")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = keep(batch.filter(F.col(event_time).isNotNull()))
        earlier = [n for n in numbered(spark, f"{out}/clocks", "batch") if n < batch_id]
        times = rows.select(F.col(event_time).alias("clock"))
        if earlier:
            times = times.unionByName(spark.read.parquet(f"{out}/clocks/batch={earlier[-1]}"))
        times.agg(F.max("clock").alias("clock")).write.mode("overwrite").parquet(f"{out}/clocks/batch={batch_id}")
        for old in earlier[:-1]:
            drop_folder(spark, f"{out}/clocks/batch={old}")
        clock = spark.read.parquet(f"{out}/clocks/batch={batch_id}").scalar()
        rows.filter(F.col(event_time) >= clock - width).write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    return src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def fresh_rows(spark: SparkSession, out: str) -> DataFrame:
    """The rows kept by ``moving_lookback``, with the batch they came by."""
    return spark.read.parquet(f"{out}/rows")


def score_stream(src: DataFrame, scorer: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> DataStreamWriter:
    """Score each batch as it arrives; the result of a batch is replaced, not added, when it is repeated."""

    def score(batch: DataFrame, batch_id: int) -> None:
        scorer(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return src.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)


def hot_stream(src: DataFrame, phrases: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(posts holding a phrase, to be scored at once; the rest, for the batch)``."""
    hot = text_has_any(post_text(), phrases)
    return src.filter(hot), src.filter(~hot)


def stage_events(posts: DataFrame, leads: DataFrame, drafts: DataFrame) -> DataFrame:
    """One row per post, lead and draft and each funnel stage it reached: ``stage``, ``at``."""
    status = F.col("status")

    def reached(df: DataFrame, ts: str, **stages: Column) -> DataFrame:
        names = present(*[F.when(cond, F.lit(name)) for name, cond in stages.items()])
        return df.select(F.explode(names).alias("stage"), F.col(ts).alias("at"))

    return (
        reached(posts, "scraped_at", scraped=F.lit(True))
        .unionByName(
            reached(
                leads, "scored_at", scored=F.lit(True), qualified=F.col("score") >= S.QUALIFIED_SCORE,
                responded=status == "responded", converted=status == "converted",
            )
        )
        .unionByName(reached(drafts, "drafted_at", drafted=F.lit(True)))
        .unionByName(reached(drafts, "reviewed_at", approved=status == "approved", sent=status == "sent"))
    )


def funnel_stream(
    posts: DataFrame, leads: DataFrame, drafts: DataFrame, window: str = "1 day", slide: str | None = None, late: str = "1 day"
) -> DataFrame:
    """Stage counts per window of time; ``7 days`` sliding by ``1 day`` gives the rolling funnel."""
    events = with_event_time(stage_events(posts, leads, drafts).filter(F.col("at").isNotNull()), "at", late)
    spans = F.window("at", window, slide) if slide else F.window("at", window)
    counts = events.groupBy(spans.alias("span"), "stage").agg(F.count("*").alias("n"))
    return counts.select(F.col("span.start").alias("starts_at"), "stage", "n")


def upsert_by_batch(src: DataFrame, out: str, checkpoint: str, keys: Sequence[str], every: int = EVERY) -> DataStreamWriter:
    """Write changed rows of an aggregate by batch; see ``latest_rows``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, out, latest_of(keys), every)

    return src.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def latest_rows(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Each key's row from the last batch that changed it; reads the newest snapshot and the batches after it."""
    return read_compacted(spark, out, latest_of(keys)).drop("batch")


def liveness_stream(heartbeats: DataFrame, stale_s: int = 90, late: str = "90 seconds") -> DataFrame:
    """Closed stretches of beats of an instance; each marks an outage that began.

    A beat exactly at the stale time starts a new stretch, so the session gap is one microsecond shorter.
    """
    gap = f"{stale_s - 1} seconds 999 milliseconds 999 microseconds"
    beats = with_event_time(heartbeats, "beat_at", late)
    spans = beats.groupBy("instance_id", F.session_window("beat_at", gap).alias("span")).agg(
        F.min("beat_at").alias("started_at"), F.max("beat_at").alias("last_beat_at"), F.count("*").alias("beats")
    )
    return spans.drop("span")


def _merged(rows: DataFrame) -> DataFrame:
    """Folds of several batches as one; the batch says nothing about the order of their attempts."""
    return merge_folds(rows.drop("batch")).withColumn("batch", F.lit(None).cast("bigint"))


def failure_stream(attempts: DataFrame, folds: str, checkpoint: str, failing: Sequence[str] = ("failed",), every: int = EVERY) -> DataStreamWriter:
    """Keep the fold of each source up to date as attempts arrive, in whatever order; read it with ``newest_fold``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(fold_attempts(batch, failing=failing), batch_id, folds, _merged, every)

    return attempts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def newest_fold(spark: SparkSession, folds: str) -> DataFrame:
    """The fold of all batches so far, for ``state_of``; reads the newest snapshot and the batches after it."""
    return read_compacted(spark, folds, _merged).drop("batch")
