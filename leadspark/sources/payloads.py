"""Landed API payloads to post records.

A payload is one page of results, newest first. All work on it stays inside its row until its posts
are exploded, so nothing is shuffled. What a normaliser cannot use comes out by ``bad_listing`` and ``bad_search``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadspark import schemas as S
from leadspark.functions import text as X
from leadspark.functions.times import Moment, epoch_to_ts, iso_to_ts
from leadspark.operators.filters import drop_bot_like, eligible_listing, within_lookback


#: Why a page or a post of it gives no record.
UNREADABLE, NO_POSTS, NO_ID, BAD_DATE, UNKNOWN_AUTHOR = "unreadable_page", "no_posts", "post_without_id", "bad_date", "unknown_author"


def with_payload(raw: DataFrame, schema: T.StructType, column: str = "payload") -> DataFrame:
    """Parse the payload column if it is still JSON text; a text that is no JSON object becomes null."""
    if isinstance(raw.schema[column].dataType, T.StringType):
        wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
        parsed = F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
        pages = raw.withColumn("_parsed", parsed)
        good = F.col("_parsed._bad").isNull() & F.col(column).rlike(r"^\s*\{")
        fields = F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields])
        return pages.withColumn(column, F.when(F.col("_parsed").isNotNull() & good, fields)).drop("_parsed")
    return raw


def _bad_rows(pages: DataFrame, kept: list[str], posts: Column, faults: Callable[[Column], Column]) -> DataFrame:
    """``kept, reason, external_id, detail`` of unusable pages and posts; the work stays inside the page's row."""
    fault = lambda reason, post_id, detail: F.struct(F.lit(reason).alias("reason"), post_id.alias("external_id"), detail.alias("detail"))
    none = F.lit(None).cast("string")
    of_page = F.when(F.col("payload").isNull(), F.array(fault(UNREADABLE, none, F.col("_text")))).when(posts.isNull(), F.array(fault(NO_POSTS, none, F.col("_text"))))
    of_posts = F.flatten(F.transform(posts, lambda p: F.array_compact(faults(p))))
    found = F.explode(F.coalesce(of_page, of_posts))
    return pages.select(*kept, found.alias("_f")).select(*kept, "_f.*")


def _with_text(raw: DataFrame, schema: T.StructType) -> DataFrame:
    is_text = isinstance(raw.schema["payload"].dataType, T.StringType)
    return with_payload(raw.withColumn("_text", F.col("payload") if is_text else F.to_json("payload")), schema)


def _fault(reason: str, held: Column, post_id: Column, detail: Column) -> Column:
    return F.when(held, F.struct(F.lit(reason).alias("reason"), post_id.alias("external_id"), detail.cast("string").alias("detail")))


def bad_listing(raw: DataFrame) -> DataFrame:
    """What ``normalize_listing`` leaves out as unusable: the columns passed through, ``reason``, ``external_id``, ``detail``.

    Unreadable pages and pages without a list of posts come with their whole text, posts without an id or a date
    with what they hold instead.
    """
    kept = [c for c in raw.columns if c != "payload"]

    def faults(p: Column) -> Column:
        post = p["data"]
        return F.array(
            _fault(NO_ID, post["id"].isNull(), F.lit(None).cast("string"), F.to_json(post)),
            _fault(BAD_DATE, post["id"].isNotNull() & epoch_to_ts(post["created_utc"]).isNull(), post["id"], post["created_utc"]),
        )

    return _bad_rows(_with_text(raw, S.LISTING), kept, F.col("payload.data.children"), faults)


def bad_search(raw: DataFrame) -> DataFrame:
    """What ``normalize_search`` leaves out as unusable; see ``bad_listing``. A post's author may not be on its page."""
    kept = [c for c in raw.columns if c != "payload"]
    users = F.col("payload.includes.users")

    def faults(t: Column) -> Column:
        known = F.exists(F.coalesce(users, F.array().cast(users_type)), lambda u: u["id"] == t["author_id"])
        return F.array(
            _fault(NO_ID, t["id"].isNull(), F.lit(None).cast("string"), F.to_json(t)),
            _fault(UNKNOWN_AUTHOR, t["id"].isNotNull() & ~F.coalesce(known, F.lit(False)), t["id"], t["author_id"]),
            _fault(BAD_DATE, t["id"].isNotNull() & iso_to_ts(t["created_at"]).isNull(), t["id"], F.coalesce(t["created_at"], F.lit(""))),
        )

    users_type = S.SEARCH["includes"].dataType["users"].dataType
    return _bad_rows(_with_text(raw, S.SEARCH), kept, F.col("payload.data"), faults)


def normalize_listing(raw: DataFrame, as_of: Moment, lookback_hours: float = 24) -> DataFrame:
    """Post records of listing payloads.

    ``raw`` has ``payload`` and ``keyword``; its other columns are passed through. Pages count whole; for the newest
    few per phrase, apply ``cap_per_group`` to the posts.
    """
    kept = [c for c in raw.columns if c not in ("payload", "keyword")]
    pages = with_payload(raw, S.LISTING)
    posts = pages.select(*kept, "keyword", F.explode("payload.data.children").alias("c"))
    posts = posts.select(*kept, "keyword", F.to_json("c.data").alias("raw"), "c.data.*")
    posts = eligible_listing(posts.filter(F.col("id").isNotNull()))
    posts = within_lookback(posts.withColumn("posted_at", epoch_to_ts(F.col("created_utc"))), "posted_at", as_of, lookback_hours)
    return posts.select(
        *kept,
        F.lit("reddit").alias("platform"),
        F.concat(F.lit(X.LISTING_ID_PREFIX), F.col("id")).alias("external_id"),
        "subreddit",
        "author",
        "title",
        X.blank_if_null(F.col("selftext")).alias("body"),
        X.listing_url(F.col("permalink")).alias("url"),
        "posted_at",
        F.create_map(F.lit("score"), F.col("score"), F.lit("comments"), F.col("num_comments")).alias("engagement"),
        F.array("keyword").alias("matched_keywords"),
        "raw",
    )


def search_records(raw: DataFrame) -> DataFrame:
    """Every readable post of search payloads whose author is on its page, of any age and kind of author.

    ``raw`` has ``payload`` and ``query``; its other columns are passed through. Authors are looked up
    among the accounts of the same page; the last of repeated accounts counts, unknown authors are dropped.
    """
    kept = [c for c in raw.columns if c not in ("payload", "query")]
    pages = with_payload(raw, S.SEARCH)
    users = F.col("payload.includes.users")
    # The lookup stays inside the row, which holds one page.
    paired = F.transform(
        "payload.data",
        lambda t: F.struct(
            t.alias("t"), F.try_element_at(F.filter(users, lambda u: u["id"] == t["author_id"]), F.lit(-1)).alias("u")
        ),
    )
    tweets = pages.select(*kept, "query", F.explode(paired).alias("p")).select(*kept, "query", "p.*").filter(F.col("u").isNotNull())
    count = lambda name: X.zero_if_null(F.col(f"t.public_metrics.{name}"))
    return tweets.select(
        *kept,
        F.lit("twitter").alias("platform"),
        F.col("t.id").alias("external_id"),
        X.author_handle(F.col("u.username")).alias("author"),
        F.struct(
            X.zero_if_null(F.col("u.public_metrics.followers_count")).alias("followers"),
            X.zero_if_null(F.col("u.public_metrics.following_count")).alias("following"),
            X.truthy(F.col("u.verified")).alias("verified"),
            X.blank_if_null(F.col("u.description")).alias("bio"),
        ).alias("author_meta"),
        F.lit("").alias("title"),
        F.col("t.text").alias("body"),
        X.search_url(F.col("u.username"), F.col("t.id")).alias("url"),
        iso_to_ts(F.col("t.created_at")).alias("posted_at"),
        F.create_map(
            F.lit("likes"), count("like_count"), F.lit("replies"), count("reply_count"), F.lit("retweets"), count("retweet_count")
        ).alias("engagement"),
        F.array("query").alias("matched_keywords"),
        F.to_json("t").alias("raw"),
        "t.referenced_tweets",
    )


def normalize_search(raw: DataFrame, as_of: Moment, lookback_hours: float = 24) -> DataFrame:
    """Post records of search payloads within the lookback, without those of bot-like authors; see ``search_records``."""
    people = drop_bot_like(search_records(raw), "author_meta.followers", "author_meta.following")
    return within_lookback(people, "posted_at", as_of, lookback_hours)
