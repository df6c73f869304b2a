"""Readers for the JSON replies of a completion function."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leadspark.functions.text import strip_fences


# Numbers are read as double: an integer read would silently drop the fraction of 78.5.
SCORE_FIELDS = {"score": "double", "reasoning": "string", "signal_tags": "array<string>", "disqualifiers": "array<string>"}
DRAFT_FIELDS = {"channel": "string", "subject": "string", "body": "string", "rationale": "string", "estimated_quality": "double"}


def _struct(fields: dict[str, str]) -> str:
    return f"struct<{', '.join(f'{name}: {kind}' for name, kind in fields.items())}>"


def _document(reply: Column) -> Column:
    return F.try_parse_json(strip_fences(reply))


def _parsed(doc: Column) -> Column:
    """Malformed text and a bare JSON null are no reply."""
    return (doc.isNotNull() & ~F.is_variant_null(doc)).alias("parsed")


def parse_score(reply: Column) -> Column:
    """``struct<parsed, score, reasoning, signal_tags, disqualifiers>`` of one scoring reply."""
    doc = _document(reply)
    fields = F.try_variant_get(doc, "$", _struct(SCORE_FIELDS))
    none = F.array().cast("array<string>")
    lists = [F.coalesce(fields[name], none).alias(name) for name in ("signal_tags", "disqualifiers")]
    return F.struct(_parsed(doc), fields["score"].alias("score"), fields["reasoning"].alias("reasoning"), *lists)


def parse_draft(reply: Column) -> Column:
    """``struct<parsed, channel, subject, body, rationale, estimated_quality>`` of one drafting reply."""
    doc = _document(reply)
    fields = F.try_variant_get(doc, "$", _struct(DRAFT_FIELDS))
    return F.struct(_parsed(doc), *[fields[name].alias(name) for name in DRAFT_FIELDS])
