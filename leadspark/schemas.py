"""Table and payload schemas, allowed values and thresholds."""

from __future__ import annotations

from pyspark.sql import types as T

# Allowed values of the enumerated columns.
PLATFORMS = ("reddit", "twitter", "hackernews", "indiehackers")
SOURCE_STATUSES = ("healthy", "degraded", "paused")
LEAD_STATUSES = ("new", "drafted", "approved", "rejected", "sent", "responded", "converted", "lost")
DRAFT_STATUSES = ("drafting", "pending_review", "approved", "rejected", "sent")
LOG_LEVELS = ("debug", "info", "warn", "error", "fatal")
CHANNELS = ("reddit_dm", "reddit_comment", "twitter_dm", "twitter_reply")
SIGNAL_TAGS = ("explicit_intent", "implicit_pain", "icp_match", "high_engagement", "recent")

# Score thresholds of the funnel.
PROMOTE_SCORE = 60
QUALIFIED_SCORE = 75
DIGEST_SCORE = 85
TOP_SCORE = 90
WEAK_SCORE = 40

# Only these platforms have a payload normaliser.
COLLECTED_PLATFORMS = ("reddit", "twitter")

ENGAGEMENT = T.MapType(T.StringType(), T.LongType())
STRINGS = T.ArrayType(T.StringType())


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _I, _L, _B, _TS, _D = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.TimestampType(),
    T.DoubleType(),
)

AUTHOR_META = _struct(("followers", _L), ("following", _L), ("verified", _B), ("bio", _S))
SOURCE_CONFIG = _struct(("subreddit", _S), ("keywords", STRINGS), ("query", _S))

SOURCES = _struct(
    ("id", _S), ("platform", _S), ("config", _S), ("is_active", _B), ("status", _S),
    ("last_scraped_at", _TS), ("consecutive_failures", _I), ("notes", _S), ("created_at", _TS),
)
RAW_POSTS = _struct(
    ("id", _S), ("source_id", _S), ("platform", _S), ("external_id", _S), ("author", _S),
    ("author_meta", AUTHOR_META), ("title", _S), ("body", _S), ("url", _S), ("posted_at", _TS),
    ("engagement", ENGAGEMENT), ("matched_keywords", STRINGS), ("raw", _S), ("scraped_at", _TS),
)
LEADS = _struct(
    ("id", _S), ("raw_post_id", _S), ("platform", _S), ("external_id", _S), ("author", _S),
    ("score", _I), ("reasoning", _S), ("signal_tags", STRINGS), ("disqualifiers", STRINGS),
    ("status", _S), ("scored_at", _TS),
)
DRAFTS = _struct(
    ("id", _S), ("lead_id", _S), ("channel", _S), ("subject", _S), ("body", _S), ("rationale", _S),
    ("estimated_quality", _I), ("status", _S), ("rejection_reason", _S), ("drafted_at", _TS),
    ("reviewed_at", _TS),
)
HEARTBEATS = _struct(
    ("id", _L), ("instance_id", _S), ("beat_at", _TS), ("status", _S), ("current_task", _S),
    ("queue_depth", _I), ("metadata", _S),
)
LOGS = _struct(
    ("id", _L), ("level", _S), ("source", _S), ("code", _S), ("message", _S), ("context", _S),
    ("occurred_at", _TS),
)
RATE_LIMITS = _struct(
    ("platform", _S), ("resets_at", _TS), ("reason", _S), ("consecutive_429s", _I), ("updated_at", _TS),
)
SESSIONS = _struct(
    ("id", _S), ("kind", _S), ("started_at", _TS), ("ended_at", _TS), ("status", _S), ("stats", _S),
)

TABLES = {
    "sources": SOURCES,
    "raw_posts": RAW_POSTS,
    "leads": LEADS,
    "outreach_drafts": DRAFTS,
    "heartbeats": HEARTBEATS,
    "logs": LOGS,
    "rate_limits": RATE_LIMITS,
    "sessions": SESSIONS,
}

# Append-only facts that stand for in-place updates.
SCORE_LOG = _struct(("platform", _S), ("external_id", _S), ("event", _S), ("at", _TS))
ATTEMPTS = _struct(("event_id", _S), ("source_id", _S), ("attempted_at", _TS), ("outcome", _S))
TRANSITIONS = _struct(("id", _S), ("status", _S), ("at", _TS), ("seq", _L))

LISTING_POST = _struct(
    ("id", _S), ("subreddit", _S), ("author", _S), ("title", _S), ("selftext", _S), ("permalink", _S),
    ("created_utc", _D), ("score", _L), ("num_comments", _L), ("over_18", _B), ("stickied", _B),
)
LISTING = _struct(
    ("data", _struct(("children", T.ArrayType(_struct(("data", LISTING_POST)))))),
)

TWEET = _struct(
    ("id", _S), ("author_id", _S), ("text", _S), ("created_at", _S), ("lang", _S),
    ("public_metrics", _struct(("like_count", _L), ("reply_count", _L), ("retweet_count", _L))),
    ("referenced_tweets", T.ArrayType(_struct(("type", _S), ("id", _S)))),
)
USER = _struct(
    ("id", _S), ("username", _S), ("description", _S), ("verified", _B),
    ("public_metrics", _struct(("followers_count", _L), ("following_count", _L))),
)
SEARCH = _struct(
    ("data", T.ArrayType(TWEET)),
    ("includes", _struct(("users", T.ArrayType(USER)))),
)

POST_RECORD = _struct(
    ("source", _S), ("external_id", _S), ("subreddit", _S), ("author", _S), ("author_meta", AUTHOR_META),
    ("title", _S), ("body", _S), ("url", _S), ("posted_at", _TS), ("engagement", ENGAGEMENT),
    ("matched_keywords", STRINGS),
)
