"""Licence scans by canonical digest.

A text is brought to a canonical form: lower case, copyright lines dropped, equivalent spellings made one, every run of
characters other than letters and digits made one space. Two texts that differ only in these have the same digest. The
digests of whole texts are joined with the digests of known licences.

Defined cases: a null text, or one that the canonical form leaves empty, has the digest of the empty text and matches
nothing. Known texts whose canonical form is empty are ignored. Licences of one digest are all named. Repeated rows are
each judged. Columns of the input are kept; those named as a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Spellings that count as one (fixed values, after the licence matching guidelines in public use).
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("organisation", "organization"), ("authorised", "authorized"), ("authorisation", "authorization"),
    ("favour", "favor"), ("favourable", "favorable"), ("fulfilment", "fulfillment"), ("recognise", "recognize"), ("modifications or changes", "modifications"),
    ("sublicence", "sublicense"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("merchantibility", "merchantability"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("whilst", "while"), ("wilful", "willful"), ("initialise", "initialize"), ("analogue", "analog"), ("https", "http"),
)
_RESULT = ("digest", "license_ids", "licensed")
_COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b(?!\s+(?:holder|owner|notice|law)s?\b)|\(c\)|©|all rights reserved)[^\n]*$"


def canonical(text: Column) -> Column:
    lowered = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\r\n?", "\n")
    # Only the few texts with such a line pay for the search.
    has_line = F.contains(lowered, F.lit("copyright")) | F.contains(lowered, F.lit("(c)")) | F.contains(lowered, F.lit("©")) | F.contains(lowered, F.lit("all rights reserved"))
    out = F.when(has_line, F.regexp_replace(lowered, _COPYRIGHT_LINE, "")).otherwise(lowered)
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for other, one in SPELLINGS:
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.trim(out)


def scan_licenses(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The documents with ``digest`` (SHA-256 of the canonical text), ``license_ids`` of equal texts of ``known``
    (``license_id``, ``text``), sorted, and ``licensed``."""
    columns = [c for c in docs.columns if c not in _RESULT]
    digest = F.sha2(canonical(F.col("text")), 256)
    empty = F.sha2(F.lit(""), 256)
    table = known.select(F.col("license_id").cast("string").alias("license_id"), digest.alias("_digest")).where((F.col("_digest") != empty) & F.col("license_id").isNotNull())
    table = table.groupBy("_digest").agg(F.sort_array(F.collect_set("license_id")).alias("license_ids"))
    judged = docs.select(*columns, digest.alias("digest"))
    found = judged.join(table, judged["digest"] == table["_digest"], "left")
    ids = F.coalesce("license_ids", F.array().cast("array<string>"))
    return found.select(*columns, "digest", ids.alias("license_ids"), (F.size(ids) > 0).alias("licensed"))
