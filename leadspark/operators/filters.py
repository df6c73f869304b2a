"""Row filters and defaults for collected posts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from leadspark import schemas as S
from leadspark.functions.once import compute_once
from leadspark.functions.phrases import fence, has_any
from leadspark.functions.text import blank_if_null, present, truthy, zero_if_null
from leadspark.functions.times import Moment, moment_for
from leadspark.operators.keyed import POST_KEY

# The author shown for a removed account, and the bot-like account bounds.
REMOVED_AUTHOR = "[deleted]"
BOT_MAX_FOLLOWERS = 10
BOT_MIN_FOLLOWING = 1000


def eligible_listing(df: DataFrame) -> DataFrame:
    """Drop adult and pinned posts and posts of removed accounts; a missing flag or author passes."""
    removed = F.coalesce(F.col("author") == REMOVED_AUTHOR, F.lit(False))
    return df.filter(~truthy(F.col("over_18")) & ~truthy(F.col("stickied")) & ~removed)


def within_lookback(df: DataFrame, ts: str, as_of: Moment, hours: float = 24) -> DataFrame:
    """Keep rows no older than the lookback; a row exactly at the cutoff stays."""
    return df.filter(F.col(ts) >= moment_for(df, ts, as_of, -timedelta(hours=hours)))


def bot_like(followers: Column, following: Column) -> Column:
    return (zero_if_null(followers) < BOT_MAX_FOLLOWERS) & (zero_if_null(following) > BOT_MIN_FOLLOWING)


def drop_bot_like(df: DataFrame, followers: str = "followers", following: str = "following") -> DataFrame:
    """Drop accounts that follow many and are followed by few."""
    return df.filter(~bot_like(F.col(followers), F.col(following)))


def drop_reposts(df: DataFrame, retweets: bool = True, replies: bool = False) -> DataFrame:
    """Drop retweets and, if asked, replies, by the types of the posts a row refers to."""
    unwanted = [kind for kind, drop in (("retweeted", retweets), ("replied_to", replies)) if drop]
    kinds = F.coalesce(F.transform("referenced_tweets", lambda r: r["type"]), F.array().cast("array<string>"))
    return df.filter(~F.arrays_overlap(kinds, F.array(*[F.lit(k) for k in unwanted]))) if unwanted else df


def scored_keys(score_log: DataFrame, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """Keys whose latest score event is ``scored``; at equal times a score outweighs a requeue.

    Two maxima per key keep the fold in hash aggregation with a map-side combine.
    """
    at = lambda event: F.max(F.when(F.col("event") == event, F.col("at")))
    folded = score_log.groupBy(*keys).agg(at("scored").alias("_scored"), at("requeued").alias("_requeued"))
    done = F.col("_scored").isNotNull() & (F.col("_requeued").isNull() | (F.col("_scored") >= F.col("_requeued")))
    return folded.filter(done).select(*keys)


def unprocessed(posts: DataFrame, score_log: DataFrame, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """Posts never scored, or requeued since."""
    return posts.join(scored_keys(score_log, keys), list(keys), "left_anti")


def promote(scored: DataFrame, threshold: int = S.PROMOTE_SCORE) -> DataFrame:
    """Scored rows that become leads; a missing score never does."""
    return scored.filter(F.col("score") >= threshold)


def errors_only(logs: DataFrame, levels: Sequence[str] = ("error", "fatal", "warn")) -> DataFrame:
    return logs.filter(F.col("level").isin(*levels))


def post_text(title: str = "title", body: str = "body") -> Column:
    """Title and body as one lower-cased text."""
    return F.lower(F.concat_ws("\n", F.col(title), F.col(body)))


def _add_reasons(df: DataFrame, reasons: Sequence[Column]) -> DataFrame:
    """Append nullable reasons to ``disqualifiers``; a row with a reason scores zero."""
    none = F.array().cast("array<string>")
    held = F.coalesce(F.col("disqualifiers"), none) if "disqualifiers" in df.columns else none
    found = F.array_union(held, present(*reasons)) if reasons else held
    out = compute_once(df, {"disqualifiers": found})
    if "score" not in df.columns:
        return out
    zero = F.lit(0).cast(df.schema["score"].dataType)
    return out.withColumn("score", F.when(F.size("disqualifiers") > 0, zero).otherwise(F.col("score")))


def language_gate(df: DataFrame, lang: str, column: str = "lang") -> DataFrame:
    """Disqualify posts in another language than the outreach; unknown language passes."""
    return _add_reasons(df, [F.when(F.col(column) != lang, F.lit("language"))])


def disqualify(
    df: DataFrame, rules: Mapping[str, Sequence[str]], bio_rules: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Disqualify posts by phrases in their text, and by phrases in the author's bio where there is one."""
    out = df.withColumn("_text", post_text())
    out = out.withColumn("_fenced", fence(F.col("_text"), [p for ps in rules.values() for p in ps]))
    reasons = [F.when(has_any(F.col("_fenced"), ps), F.lit(reason)) for reason, ps in rules.items()]
    if bio_rules and "author_meta" in df.columns:
        bio = fence(F.lower(F.col("author_meta.bio")), [p for ps in bio_rules.values() for p in ps])
        out = out.withColumn("_bio", bio)
        reasons += [F.when(has_any(F.col("_bio"), ps), F.lit(reason)) for reason, ps in bio_rules.items()]
    return _add_reasons(out, reasons).drop("_text", "_fenced", "_bio")


def with_defaults(df: DataFrame) -> DataFrame:
    """Empty instead of missing title, body, engagement and keywords."""
    return df.withColumns(
        {
            "title": blank_if_null(F.col("title")),
            "body": blank_if_null(F.col("body")),
            "engagement": F.coalesce(F.col("engagement"), F.create_map().cast(S.ENGAGEMENT)),
            "matched_keywords": F.coalesce(F.col("matched_keywords"), F.array().cast(S.STRINGS)),
        }
    )
