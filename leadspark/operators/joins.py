"""Joins of the funnel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from leadspark.functions.times import Moment, moment_for
from leadspark.operators.keyed import POST_KEY, last_per_key


def leads_with_posts(leads: DataFrame, posts: DataFrame, post_columns: Sequence[str] = ("title", "body", "url")) -> DataFrame:
    """Each lead with the named columns of its post; a lead without its post is dropped."""
    wanted = posts.select(F.col("id").alias("raw_post_id"), *post_columns)
    return leads.join(wanted, "raw_post_id")


def attach_users(tweets: DataFrame, users: DataFrame, order_by: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """Posts with their author's account; unknown authors are dropped, the last of repeated accounts counts.

    ``scope`` names the columns, such as the payload, within which an account id is looked up.
    """
    known = last_per_key(users, [*scope, "author_id"], order_by).drop(*order_by)
    return tweets.join(known, [*scope, "author_id"])


def attach_scores(
    batch: DataFrame, scored: DataFrame, order_by: Sequence[str] = ("seq",), keys: Sequence[str] = POST_KEY
) -> tuple[DataFrame, DataFrame]:
    """``(posts with their last result, posts that stay queued for want of one)``."""
    last = last_per_key(scored, keys, order_by).drop(*order_by)
    return batch.join(last, list(keys)), batch.join(scored.select(*keys), list(keys), "left_anti")


def skip_rate_limited(sources: DataFrame, rate_limits: DataFrame, as_of: Moment) -> DataFrame:
    """Sources whose platform is not held back; a limit that resets exactly now is over."""
    blocked = rate_limits.filter(F.col("resets_at") > moment_for(rate_limits, "resets_at", as_of))
    return sources.join(blocked.select("platform"), "platform", "left_anti")


def drop_do_not_approach(df: DataFrame, blocklist: DataFrame, column: str = "author") -> DataFrame:
    """Rows whose author is not on the blocklist."""
    return df.join(blocklist.select(column), column, "left_anti")
