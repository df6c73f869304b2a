"""Small text, number and score columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from leadspark import schemas as S

# Link and handle formats of the two collected platforms.
LISTING_ID_PREFIX = "t3_"
LISTING_SITE = "https://reddit.com"
SEARCH_SITE = "https://x.com"

# Fixed value: the code fence that a reply may be wrapped in.
FENCE_PATTERN = r"```json\s*|\s*```"


def present(*texts: Column) -> Column:
    """The distinct non-null ones of the given texts, in order."""
    # A set difference compiles, which an array filter does not.
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def truthy(flag: Column) -> Column:
    """A missing flag counts as false."""
    return F.coalesce(flag, F.lit(False))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def int_or_default(c: Column, default: int) -> Column:
    """Leading whole number of a text, or the default where there is none."""
    digits = F.regexp_extract(c, r"^\s*([+-]?\d+)", 1)
    return F.coalesce(null_if_empty(digits).try_cast(T.IntegerType()), F.lit(default))


def at_most(c: Column, cap: int) -> Column:
    return F.least(c, F.lit(cap))


def split_phrases(c: Column) -> Column:
    parts = F.transform(F.split(c, ","), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    return F.filter(parts, lambda p: p != "")


def join_phrases(phrases: Column) -> Column:
    return F.array_join(phrases, ",")


def clip(c: Column, n: int, empty: str = "") -> Column:
    """First ``n`` characters, with a stand-in text for null and empty."""
    return F.substring(F.coalesce(null_if_empty(c), F.lit(empty)), 1, n)


def strip_fences(c: Column) -> Column:
    bare = F.regexp_replace(c, FENCE_PATTERN, "")
    return F.regexp_replace(bare, r"^\s+|\s+$", "")


def listing_url(permalink: Column) -> Column:
    return F.concat(F.lit(LISTING_SITE), blank_if_null(permalink))


def search_url(username: Column, post_id: Column) -> Column:
    return F.concat(F.lit(SEARCH_SITE + "/"), username, F.lit("/status/"), post_id)


def author_handle(username: Column) -> Column:
    return F.concat(F.lit("@"), username)


def post_key(platform: Column, external_id: Column) -> Column:
    """Deterministic id of a post: the same row gets the same id on every task attempt."""
    return F.sha2(F.concat_ws("|", platform, external_id), 256)


def score_class(score: Column) -> Column:
    """Display class of a lead; everything below the qualified mark shares the lowest."""
    return (
        F.when(score >= S.TOP_SCORE, F.lit("score-90"))
        .when(score >= S.QUALIFIED_SCORE, F.lit("score-75"))
        .otherwise(F.lit("score-60"))
    )


def score_band(score: Column) -> Column:
    return (
        F.when(score >= S.TOP_SCORE, F.lit("90-100"))
        .when(score >= S.QUALIFIED_SCORE, F.lit("75-89"))
        .when(score >= S.PROMOTE_SCORE, F.lit("60-74"))
        .when(score >= S.WEAK_SCORE, F.lit("40-59"))
        .when(score >= 0, F.lit("0-39"))
    )


def json_config(c: Column) -> Column:
    return F.from_json(c, S.SOURCE_CONFIG)
