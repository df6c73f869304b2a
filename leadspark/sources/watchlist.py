"""Which sources to read next."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadspark import schemas as S
from leadspark.functions.text import join_phrases, json_config


def watchlist(sources: DataFrame, skip_degraded: bool = False) -> DataFrame:
    """Active sources that are not paused, with their configuration, the longest unread first.

    Sources never read come first. Platforms without a collector are left out, and degraded sources
    on request.
    """
    unwanted = ("paused", "degraded") if skip_degraded else ("paused",)
    chosen = sources.filter(
        F.col("is_active") & ~F.col("status").isin(*unwanted) & F.col("platform").isin(*S.COLLECTED_PLATFORMS)
    )
    config = chosen.withColumn("_c", json_config(F.col("config")))
    out = config.select(
        "id", "platform", "status", "last_scraped_at",
        F.col("_c.subreddit").alias("subreddit"),
        join_phrases(F.coalesce(F.col("_c.keywords"), F.array().cast(S.STRINGS))).alias("keywords"),
        F.col("_c.query").alias("query"),
    )
    return out.orderBy(F.col("last_scraped_at").asc_nulls_first(), "id")
