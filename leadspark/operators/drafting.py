"""Rules and examples for drafts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadspark.functions.phrases import text_has_any
from leadspark.functions.text import present, truthy
from leadspark.operators.filters import post_text
from leadspark.operators.keyed import cap_per_group

# The hard rules of a first message.
MAX_SENTENCES = 4
MAX_ASKS = 1
BANNED_PHRASES = (
    "I hope this email finds you well",
    "I came across your post",
    "I wanted to reach out",
    "I noticed that you",
)
SENTENCE_END = r"[.!?]+(\s|$)"
EMOJI_PATTERN = r"[\x{1F1E6}-\x{1F1FF}\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{231A}\x{231B}\x{23E9}-\x{23FA}\x{2B05}-\x{2B07}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}]"
EM_DASH = "—"

# Fixed value: drafts awaiting review beyond which drafting pauses.
BACKLOG_LIMIT = 50

# Phrases by which a post asks for recommendations.
ASKING_PHRASES = ("recommend", "recommendation", "recommendations", "any suggestions", "what do you use", "anyone use", "anyone using")


def lint_drafts(drafts: DataFrame, banned: Sequence[str] = BANNED_PHRASES) -> DataFrame:
    """Add ``violations``: the rules each draft's body breaks."""
    body = F.coalesce(F.col("body"), F.lit(""))
    sentences = F.size(F.filter(F.split(body, SENTENCE_END), lambda s: F.trim(s) != ""))
    asks = F.length(body) - F.length(F.replace(body, F.lit("?"), F.lit("")))
    found = [
        F.when(sentences > MAX_SENTENCES, F.lit("too_long")),
        F.when(text_has_any(F.lower(body), banned), F.lit("banned_phrase")),
        F.when(body.rlike(EMOJI_PATTERN), F.lit("emoji")),
        F.when(asks > MAX_ASKS, F.lit("many_asks")),
        F.when(body.contains(EM_DASH), F.lit("em_dash")),
    ]
    return drafts.withColumn("violations", present(*found))


def pick_channel(df: DataFrame, asking: Sequence[str] = ASKING_PHRASES) -> DataFrame:
    """Add ``channel``.

    A post that asks for recommendations gets a public comment, other posts of that platform a
    direct message; on the other platform the author's open messages decide. Unknown platforms get none.
    """
    asks = text_has_any(post_text(), asking)
    opened = truthy(F.col("open_dms")) if "open_dms" in df.columns else F.lit(False)
    channel = (
        F.when((F.col("platform") == "reddit") & asks, F.lit("reddit_comment"))
        .when(F.col("platform") == "reddit", F.lit("reddit_dm"))
        .when((F.col("platform") == "twitter") & opened, F.lit("twitter_dm"))
        .when(F.col("platform") == "twitter", F.lit("twitter_reply"))
    )
    return df.withColumn("channel", channel)


def style_examples(drafts: DataFrame, n: int = 5) -> DataFrame:
    """The last n approved and the last n rejected drafts."""
    reviewed = drafts.filter(F.col("status").isin("approved", "rejected"))
    return cap_per_group(reviewed, ["status"], n, [F.col("reviewed_at").desc_nulls_last(), F.col("id")])


def example_text(drafts: DataFrame, n: int = 5) -> DataFrame:
    """The last n approved and the last n rejected of the drafts as one text, for prompts."""
    examples = style_examples(drafts, n)
    line = F.concat(F.col("status"), F.lit(": "), F.col("body"))
    ordered = F.array_sort(F.collect_list(F.struct("status", "id", line.alias("line"))))
    return examples.agg(F.array_join(F.transform(ordered, lambda e: e["line"]), "\n").alias("examples"))


def backlog_gate(drafts: DataFrame, limit: int | Column = BACKLOG_LIMIT) -> DataFrame:
    """One row: drafts awaiting review and whether drafting may go on."""
    pending = drafts.filter(F.col("status") == "pending_review").agg(F.count("*").alias("pending"))
    return pending.withColumn("may_draft", F.col("pending") <= limit)


def gate_queue(queue: DataFrame, gate: DataFrame) -> DataFrame:
    """The queue while drafting may go on, else nothing."""
    return queue.filter(gate.select("may_draft").scalar())
