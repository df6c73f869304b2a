"""Ordered queues and lists.

Ties are broken by a unique column, so every list is the same on every run. With ``n=None`` the
whole backlog is returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from leadspark import schemas as S
from leadspark.functions.times import Moment, later_than, moment_for
from leadspark.operators.filters import errors_only, unprocessed
from leadspark.operators.joins import leads_with_posts
from leadspark.operators.keyed import POST_KEY


def _top(df: DataFrame, order: Sequence[Column | str], n: int | None) -> DataFrame:
    """The first n rows; without n all rows, in no order, as an order is only of use to a list."""
    return df if n is None else df.orderBy(*order).limit(n)


def _within(posts: DataFrame, chosen: DataFrame, time: str) -> DataFrame:
    """The posts from the time of the chosen ones, so that the scan of whole posts skips the others."""
    times = chosen.select(time)
    return posts.filter((F.col(time) >= times.agg(F.min(time)).scalar()) & (F.col(time) <= times.agg(F.max(time)).scalar()))


def _top_with_posts(
    leads: DataFrame, posts: DataFrame, order: Sequence[Column | str], n: int | None, columns: Sequence[str], time: str = "scraped_at"
) -> DataFrame:
    """The first n leads that have a post, with their posts; one plan for every n.

    The leads are chosen by the ids and times of the posts alone. Texts are then read for the chosen leads, within
    the span of time that these posts come from. A list is broadcast where its length allows.
    """
    if n is None:
        return leads_with_posts(leads, posts, columns)
    known = posts.select(F.col("id").alias("raw_post_id"), F.col(time).alias("_time"))
    chosen = _top(leads.join(known, "raw_post_id"), order, n)
    near = _within(posts.select("id", time, *columns).withColumnRenamed(time, "_time"), chosen, "_time")
    return _top(leads_with_posts(chosen.drop("_time").distinct(), near, columns), order, n)


def score_batch(posts: DataFrame, score_log: DataFrame, n: int | None = 25) -> DataFrame:
    """Posts to score next, the longest waiting first.

    They are chosen by key and time alone; whole posts are read up to the time of the last one chosen. One plan for
    every n: each task keeps its first n.
    """
    if n is None:
        return unprocessed(posts, score_log)
    order = ["scraped_at", *POST_KEY]
    chosen = _top(unprocessed(posts.select(*order), score_log), order, n)
    near = _within(posts, chosen, "scraped_at").join(chosen.distinct(), order, "left_semi")
    return _top(near.select(*posts.columns), order, n)


def draft_queue(leads: DataFrame, posts: DataFrame, n: int | None = 10, min_score: int = S.QUALIFIED_SCORE) -> DataFrame:
    """New qualified leads to draft for, the best first."""
    fit = leads.filter((F.col("status") == "new") & (F.col("score") >= min_score))
    return _top_with_posts(fit, posts, [F.desc("score"), "platform", "external_id"], n, ("title", "body", "url"))


def digest_leads(
    leads: DataFrame, posts: DataFrame, as_of: Moment, hours: float = 6, min_score: int = S.DIGEST_SCORE, n: int | None = 5
) -> DataFrame:
    """The best leads of the last hours."""
    recent = leads.filter(later_than(leads, "scored_at", as_of, timedelta(hours=hours)) & (F.col("score") >= min_score))
    return _top_with_posts(recent, posts, [F.desc("score"), "platform", "external_id"], n, ("title", "url"))


def recent_leads(leads: DataFrame, posts: DataFrame, as_of: Moment, days: float = 7, n: int | None = 50) -> DataFrame:
    """Leads of the last days, best and newest first."""
    recent = leads.filter(later_than(leads, "scored_at", as_of, timedelta(days=days)))
    order = [F.desc("score"), F.desc("scored_at"), "platform", "external_id"]
    return _top_with_posts(recent, posts, order, n, ("title", "url"))


def recent_beats(heartbeats: DataFrame, n: int | None = 20) -> DataFrame:
    return _top(heartbeats, [F.desc("beat_at"), "id"], n)


def tail_errors(logs: DataFrame, n: int | None = 20) -> DataFrame:
    return _top(errors_only(logs), [F.desc("occurred_at"), "id"], n)


def rate_limit_list(rate_limits: DataFrame) -> DataFrame:
    return rate_limits.orderBy(F.desc("resets_at"), "platform")


def active_rate_limits(rate_limits: DataFrame, as_of: Moment) -> DataFrame:
    """Limits still in force; one that resets exactly now is over."""
    return rate_limits.filter(F.col("resets_at") > moment_for(rate_limits, "resets_at", as_of))
