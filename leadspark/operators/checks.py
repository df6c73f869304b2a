"""Row constraints of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from leadspark import schemas as S
from leadspark.functions.text import present

_REQUIRED = {
    "sources": ("platform", "config", "is_active", "status", "consecutive_failures", "created_at"),
    "raw_posts": ("platform", "external_id", "scraped_at"),
    "leads": ("raw_post_id", "platform", "external_id", "score", "status", "scored_at"),
    "outreach_drafts": ("lead_id", "channel", "body", "status", "drafted_at"),
    "heartbeats": ("instance_id", "beat_at", "status"),
    "logs": ("level", "source", "occurred_at"),
    "rate_limits": ("platform", "resets_at", "consecutive_429s", "updated_at"),
    "sessions": ("kind", "started_at", "status"),
}

_ALLOWED: dict[str, dict[str, tuple[str, ...]]] = {
    "sources": {"platform": S.PLATFORMS, "status": S.SOURCE_STATUSES},
    "leads": {"status": S.LEAD_STATUSES},
    "outreach_drafts": {"status": S.DRAFT_STATUSES},
    "logs": {"level": S.LOG_LEVELS},
}


def score_fault(score: Column) -> Column:
    """Why a score cannot be stored: not a whole number, or not within 0 to 100. Null if it can, or is missing."""
    number = score.cast("double")
    return F.when(number != F.floor(number), F.lit("score_whole")).when(
        ~number.between(0, 100), F.lit("score_range")
    )


_EXTRA: dict[str, dict[str, Callable[[Column], Column]]] = {"leads": {"score": score_fault}}


def check_rows(df: DataFrame, table: str) -> DataFrame:
    """Add ``violations``: the constraints each row breaks. A required column that the frame lacks is missing in every row."""
    held = set(df.columns)
    faults = [F.when(F.col(c).isNull() if c in held else F.lit(True), F.lit(f"{c}_missing")) for c in _REQUIRED[table]]
    faults += [
        F.when(~F.col(c).isin(*values), F.lit(f"{c}_unknown"))
        for c, values in _ALLOWED.get(table, {}).items()
        if c in held
    ]
    faults += [fault(F.col(c)) for c, fault in _EXTRA.get(table, {}).items() if c in held]
    return df.withColumn("violations", present(*faults))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows without the column, bad rows with their violations)``."""
    bad = F.size("violations") > 0
    return checked.filter(~bad).drop("violations"), checked.filter(bad)
