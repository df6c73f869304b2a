"""Whole-phrase matching on text columns.

A phrase matches where it occurs in the text, ignoring case, with no letter right before or after it.

Texts and phrases are fenced for this: every character that is no letter gets a mark on both sides.
A letter run then stands between two marks exactly if no letter touches it, so a whole-phrase match
is a plain search for the fenced phrase with a mark on either side.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from leadspark.functions.text import present

MARK = "\u0001"
_OTHER = r"([^\p{L}])"


def _fenced(phrase: str) -> str:
    if not phrase:
        raise ValueError("a phrase must not be empty")
    return MARK + "".join(ch if ch.isalpha() else MARK + ch + MARK for ch in phrase.lower()) + MARK


def fence_all(lowered: Column) -> Column:
    """Fence a lower-cased text."""
    return F.regexp_replace(lowered, _OTHER, f"{MARK}$1{MARK}")


def fence(lowered: Column, phrases: Iterable[str]) -> Column:
    """Fence a lower-cased text that holds any of the phrases, whole or not; null for the others.

    The plain search spares texts without a phrase the fencing.
    """
    plain = [lowered.contains(p.lower()) for p in dict.fromkeys(phrases)]
    if not plain:
        return F.lit(None).cast("string")
    held = reduce(lambda a, b: a | b, plain)
    return F.when(held, F.concat(F.lit(MARK), fence_all(lowered), F.lit(MARK)))


def has_phrase(fenced: Column, phrase: str) -> Column:
    """Does the fenced text hold the phrase?"""
    return F.coalesce(fenced.contains(_fenced(phrase)), F.lit(False))


def has_any(fenced: Column, phrases: Sequence[str]) -> Column:
    """Does the fenced text hold any of the phrases?"""
    return reduce(lambda a, b: a | b, (has_phrase(fenced, p) for p in phrases), F.lit(False))


def text_has_any(lowered: Column, phrases: Sequence[str]) -> Column:
    """Does the lower-cased text hold any of the phrases?"""
    return has_any(fence(lowered, phrases), phrases)


def held_phrases(fenced: Column, phrases: Sequence[str]) -> Column:
    """The phrases that the fenced text holds, in list order."""
    if not phrases:
        return F.array().cast("array<string>")
    return present(*[F.when(has_phrase(fenced, p), F.lit(p)) for p in phrases])


def free_starts(lowered: Column, length: Column) -> Column:
    """What follows each place of a text that no letter comes right before, up to ``length`` characters; in one pass."""
    pattern = F.concat(F.lit(r"(?s)(?<!\p{L})(?=(.{1,"), length.cast("string"), F.lit("}))"))
    return F.array_distinct(F.regexp_extract_all(lowered, pattern, F.lit(1)))


def first_word(lowered: Column) -> Column:
    """The letters that a text begins with; if it begins with another character, this one and the letters after it."""
    return F.regexp_extract(lowered, r"^(\p{L}+|[^\p{L}]\p{L}*)", 1)


def whole_part(following: Column, length: Column) -> Column:
    """The first characters of a text if there are so many and no letter comes right after; else null."""
    whole = (F.char_length(following) >= length) & ~F.substring(following, length + 1, F.lit(1)).rlike(r"^\p{L}")
    return F.when(whole, F.substring(following, F.lit(1), length))
