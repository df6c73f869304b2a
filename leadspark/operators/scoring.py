"""Scoring of posts: a deterministic rubric, and prompts for a completion function."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadspark import schemas as S
from leadspark.functions.once import compute_once
from leadspark.functions.phrases import fence, has_any
from leadspark.functions.replies import DRAFT_FIELDS, SCORE_FIELDS
from leadspark.functions.text import present
from leadspark.functions.times import Moment, seconds_before
from leadspark.operators.drafting import BANNED_PHRASES, EM_DASH, MAX_ASKS, MAX_SENTENCES
from leadspark.operators.filters import REMOVED_AUTHOR, post_text

# Weights of the rubric.
SIGNAL_WEIGHT = 35
FIT_WEIGHT = 30
RECENCY_WEIGHT = 15
SPECIFICITY_WEIGHT = 10
REACHABILITY_WEIGHT = 10

# Hours up to which recency counts fully, half, and at all.
FRESH_HOURS = 6
HALF_HOURS = 24
STALE_HOURS = 72


@dataclass(frozen=True)
class Profile:
    """What the user sells and whom they look for, as phrases."""

    explicit: Sequence[str] = ()
    implicit: Sequence[str] = ()
    fit: Mapping[str, Sequence[str]] = field(default_factory=dict)
    exact_pain: Sequence[str] = ()
    disqualifiers: Mapping[str, Sequence[str]] = field(default_factory=dict)
    bio_disqualifiers: Mapping[str, Sequence[str]] = field(default_factory=dict)
    lang: str | None = None
    high_engagement: int = 50
    text: str = ""


def _total_engagement(df: DataFrame) -> Column:
    if "engagement" not in df.columns:
        return F.lit(0)
    counts = F.transform(F.map_values("engagement"), lambda v: F.coalesce(v, F.lit(0)).cast("bigint"))
    return F.coalesce(F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, v: a + v), F.lit(0).cast("bigint"))


def _recency_points(hours: Column) -> Column:
    """Full up to 6 h, falling evenly to half at 24 h, half up to 72 h, then none."""
    full, half = float(RECENCY_WEIGHT), RECENCY_WEIGHT / 2
    falling = full - half * (hours - FRESH_HOURS) / (HALF_HOURS - FRESH_HOURS)
    return (
        F.when(hours < FRESH_HOURS, F.lit(full))
        .when(hours <= HALF_HOURS, falling)
        .when(hours <= STALE_HOURS, F.lit(half))
        .otherwise(F.lit(0.0))
    )


def _all(groups: Mapping[str, Sequence[str]]) -> list[str]:
    return [p for phrases in groups.values() for p in phrases]


def _signals(df: DataFrame, profile: Profile, as_of: Moment) -> DataFrame:
    """One boolean or number per thing the rubric and the tags look at, each computed once.

    Fit is looked for in the author's bio, where the platform gives one, and in the post.
    """
    wanted = [*profile.explicit, *profile.implicit, *profile.exact_pain, *_all(profile.fit), *_all(profile.disqualifiers)]
    out = df.withColumn("_text", post_text())
    out = out.withColumn("_fenced", fence(F.col("_text"), wanted))
    bio = F.lower(F.col("author_meta.bio")) if "author_meta" in df.columns else F.lit(None).cast("string")
    out = out.withColumn("_bio", fence(bio, [*_all(profile.fit), *_all(profile.bio_disqualifiers)]))
    text, bio = F.col("_fenced"), F.col("_bio")
    fits = [(has_any(text, ps) | has_any(bio, ps)).cast("int") for ps in profile.fit.values()]
    rules = [F.when(has_any(text, ps), F.lit(r)) for r, ps in profile.disqualifiers.items()]
    if profile.lang is not None and "lang" in df.columns:
        rules.append(F.when(F.col("lang") != profile.lang, F.lit("language")))
    rules += [F.when(has_any(bio, ps), F.lit(r)) for r, ps in profile.bio_disqualifiers.items()]
    held = F.coalesce(F.col("disqualifiers"), _none()) if "disqualifiers" in df.columns else _none()
    found = compute_once(
        out,
        {
            "_explicit": has_any(text, profile.explicit),
            "_implicit": has_any(text, profile.implicit),
            "_exact": has_any(text, profile.exact_pain),
            "_fit": (reduce(lambda a, b: a + b, fits) / F.lit(len(fits))) if fits else F.lit(0.0),
            "_hours": seconds_before(as_of, F.col("posted_at")) / 3600,
            "_engaged": _total_engagement(df),
            "_reasons": F.array_union(held, present(*rules)) if rules else held,
        },
    )
    return found.drop("_text", "_fenced", "_bio")


def _none() -> Column:
    return F.array().cast("array<string>")


_SIGNAL_COLUMNS = ("_explicit", "_implicit", "_exact", "_fit", "_hours", "_engaged", "_reasons")


def _tags(profile: Profile) -> Column:
    wanted = [
        ("explicit_intent", F.col("_explicit")),
        ("implicit_pain", F.col("_implicit")),
        ("icp_match", F.col("_fit") >= 0.5),
        ("high_engagement", F.col("_engaged") >= profile.high_engagement),
        ("recent", F.col("_hours") <= HALF_HOURS),
    ]
    return present(*[F.when(cond, F.lit(tag)) for tag, cond in wanted])


def signal_tags(df: DataFrame, profile: Profile, as_of: Moment) -> DataFrame:
    """Add ``signal_tags``."""
    return _signals(df, profile, as_of).withColumn("signal_tags", _tags(profile)).drop(*_SIGNAL_COLUMNS)


def rubric_score(df: DataFrame, profile: Profile, as_of: Moment) -> DataFrame:
    """Add ``score`` (0 to 100), ``reasoning``, ``signal_tags`` and ``disqualifiers``.

    Signal strength, fit, recency, specificity and reachability are weighted 35, 30, 15, 10 and 10;
    a disqualified post scores zero.
    """
    out = _signals(df, profile, as_of)
    reachable = F.col("author").isNotNull() & (F.col("author") != REMOVED_AUTHOR)
    points = {
        "signal": F.when(F.col("_explicit"), F.lit(float(SIGNAL_WEIGHT))).when(F.col("_implicit"), SIGNAL_WEIGHT / 2).otherwise(0.0),
        "fit": F.col("_fit") * FIT_WEIGHT,
        "recency": _recency_points(F.col("_hours")),
        "specificity": F.when(F.col("_exact"), F.lit(float(SPECIFICITY_WEIGHT))).when(F.col("_implicit"), SPECIFICITY_WEIGHT / 2).otherwise(0.0),
        "reachability": F.when(reachable, F.lit(float(REACHABILITY_WEIGHT))).otherwise(0.0),
    }
    total = F.floor(reduce(lambda a, b: a + b, points.values()) + 0.5).cast("int")
    shown = [F.concat(F.lit(f"{n} "), F.floor(p + 0.5).cast("string")) for n, p in points.items()]
    judged = {
        "score": F.when(F.size("_reasons") > 0, F.lit(0)).otherwise(total),
        "reasoning": F.concat_ws(", ", *shown),
        "signal_tags": _tags(profile),
        "disqualifiers": F.col("_reasons"),
    }
    return compute_once(out, judged).drop(*_SIGNAL_COLUMNS)


def _instructions(guidance: str, fields: Iterable[str], **limits: object) -> str:
    """The caller's own words, and below them the names and limits that a reply is read by."""
    return "\n".join([guidance, json.dumps({"reply": list(fields), **limits}, ensure_ascii=False)])


def scoring_instructions(guidance: str) -> str:
    bands = [S.TOP_SCORE, S.QUALIFIED_SCORE, S.PROMOTE_SCORE, S.WEAK_SCORE]
    return _instructions(guidance, SCORE_FIELDS, signal_tags=S.SIGNAL_TAGS, bands=bands)


def drafting_instructions(guidance: str) -> str:
    return _instructions(guidance, DRAFT_FIELDS, channel=S.CHANNELS, sentences=MAX_SENTENCES, asks=MAX_ASKS, banned=[*BANNED_PHRASES, EM_DASH])


def _shown(df: DataFrame, names: Iterable[str]) -> list[Column]:
    """The named columns that the rows have, moments as ISO text."""
    moments = {f.name for f in df.schema if f.dataType.typeName().startswith("timestamp")}
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(c)
    return [iso(c) if c in moments else F.col(c) for c in names if c in df.columns]


_POST_FIELDS = ("platform", "external_id", "author", "title", "body", "url", "posted_at", "engagement", "matched_keywords")
_LEAD_FIELDS = ("platform", "author", "url", "title", "body", "score", "reasoning")


def scoring_prompts(posts: DataFrame, profile: str, guidance: str) -> DataFrame:
    """Add ``system``, the instructions, and ``prompt``: one JSON object of the customer profile and the post."""
    prompt = F.to_json(F.struct(F.lit(profile).alias("profile"), F.struct(*_shown(posts, _POST_FIELDS)).alias("post")))
    return posts.withColumns({"system": F.lit(scoring_instructions(guidance)), "prompt": prompt})


def drafting_prompts(queue: DataFrame, profile: str, facts: str, examples: Column | str, guidance: str) -> DataFrame:
    """Add ``system`` and ``prompt`` for the leads of a draft queue; what a lead lacks is left out of its JSON object."""
    given = {"profile": F.lit(profile), "facts": F.lit(facts), "examples": examples if isinstance(examples, Column) else F.lit(examples)}
    prompt = F.to_json(F.struct(*[c.alias(n) for n, c in given.items()], F.struct(*_shown(queue, _LEAD_FIELDS)).alias("lead")))
    return queue.withColumns({"system": F.lit(drafting_instructions(guidance)), "prompt": prompt})
