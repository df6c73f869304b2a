"""Rows to append: drafts, events, run logs, scored records, seeds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadspark.functions.text import null_if_empty
from leadspark.functions.times import Moment, moment, moment_for, to_utc
from leadspark.operators.keyed import POST_KEY, first_per_key


def new_drafts(drafted: DataFrame, as_of: Moment) -> DataFrame:
    """Drafts queued for review, one for each lead; an empty subject and a zero quality are stored as missing.

    A draft's id follows from its lead and moment, however the moment is written. Of several drafts of a lead, the
    least text stays.
    """
    drafted = first_per_key(drafted, ["lead_id"], ["body", "channel", "subject"])
    return drafted.select(
        F.sha2(F.concat_ws("|", F.col("lead_id").cast("string"), F.lit(to_utc(as_of).isoformat())), 256).alias("id"),
        "lead_id",
        "channel",
        null_if_empty(F.col("subject")).alias("subject"),
        "body",
        "rationale",
        F.nullif(F.col("estimated_quality"), F.lit(0)).cast("int").alias("estimated_quality"),
        F.lit("pending_review").alias("status"),
        F.lit(None).cast("string").alias("rejection_reason"),
        moment(as_of, T.TimestampType()).alias("drafted_at"),
        F.lit(None).cast("timestamp").alias("reviewed_at"),
    )


def log_events(
    df: DataFrame, level: str, source: str, code: str, message: Column, context: Sequence[str] = (), at: Column | None = None
) -> DataFrame:
    """One structured event per row, with the named columns as JSON context."""
    details = F.to_json(F.struct(*[F.col(c) for c in context])) if context else F.lit("{}")
    return df.select(
        F.lit(level).alias("level"),
        F.lit(source).alias("source"),
        F.lit(code).alias("code"),
        message.alias("message"),
        details.alias("context"),
        (F.lit(None).cast("timestamp") if at is None else at).alias("occurred_at"),
    )


def session_row(kind: str, started: Moment, ended: Moment | None, stats: DataFrame, status: str = "complete") -> DataFrame:
    """Run log row with a one-row stats frame as JSON; a run that failed keeps its status and no end."""
    like = T.TimestampType()
    return stats.select(
        F.sha2(F.lit(f"{kind}|{to_utc(started).isoformat()}"), 256).alias("id"),
        F.lit(kind).alias("kind"),
        moment(started, like).alias("started_at"),
        (F.lit(None).cast(like) if ended is None else moment(ended, like)).alias("ended_at"),
        F.lit(status).alias("status"),
        F.to_json(F.struct(*[F.col(c) for c in stats.columns])).alias("stats"),
    )


def cycle_stats(attempted: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: rows offered to a load and rows that were new."""
    offered = attempted.select(F.lit(1).alias("a"), F.lit(0).alias("i"))
    new = inserted.select(F.lit(0).alias("a"), F.lit(1).alias("i"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return offered.unionByName(new).agg(total("a").alias("attempted"), total("i").alias("inserted"))


def scored_records(df: DataFrame) -> DataFrame:
    """The record shape of a scored post."""
    none = F.array().cast("array<string>")
    return df.select(
        "external_id",
        F.col("platform").alias("source"),
        "score",
        "reasoning",
        F.coalesce(F.col("signal_tags"), none).alias("signal_tags"),
        F.coalesce(F.col("disqualifiers"), none).alias("disqualifiers"),
    )


def write_scored(df: DataFrame, path: str) -> None:
    """Scored records as JSON lines."""
    scored_records(df).write.mode("append").json(path)


def seed_if_empty(existing: DataFrame, seed: DataFrame) -> DataFrame:
    """The seed rows, but only while the table holds none."""
    return seed.filter(~existing.exists())


def requeue_recent(posts: DataFrame, as_of: Moment, hours: float = 24, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """``requeued`` events for the posts collected in the last hours; count them for the report."""
    cutoff = moment_for(posts, "scraped_at", as_of, -timedelta(hours=hours))
    recent = posts.filter(F.col("scraped_at") > cutoff)
    return recent.select(*keys, F.lit("requeued").alias("event"), moment_for(posts, "scraped_at", as_of).alias("at"))
