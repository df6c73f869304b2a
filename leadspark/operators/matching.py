"""Which phrases a post holds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadspark.functions.phrases import fence, first_word, free_starts, held_phrases, whole_part
from leadspark.operators.filters import post_text
from leadspark.operators.keyed import POST_KEY
from leadspark.session import keep


#: Tasks that the places of one first word are dealt to where the phrases are shuffled; each phrase is sent to all of them.
_SALTS = 16

#: Characters of phrases up to which the phrases go to every task instead, with 40 more for each phrase.
_SMALL = 4_000_000


def _text_hash() -> Column:
    return F.xxhash64(post_text())


def _is_small(wanted: DataFrame) -> bool:
    return wanted.agg(F.coalesce(F.sum(F.char_length("_part") + 40), F.lit(0)) <= _SMALL).first()[0]


def phrase_hits(posts: DataFrame, phrases: DataFrame, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """One row per post and held phrase, for a phrase table of any size: ``keys, text_hash, phrase, rank``.

    ``phrases`` has ``phrase`` and ``rank``; an empty phrase matches nothing. The phrases are indexed by their first
    word, with the lengths that its phrases have. A post is read once: each place that a phrase could begin at gives
    what follows, as long as the longest phrase. Only places whose word is in the index go on, and give one part for
    each of its lengths, which an equi-join compares with the phrases. Posts are told apart by their keys and a hash of
    their text, so those equal in both are one.

    The phrases are kept in the shared folder and measured when this is called. Few of them go to every task, so that
    no place of a text is shuffled; of many, the places of one first word are dealt to several tasks.
    """
    wanted = phrases.select("phrase", "rank", F.lower("phrase").alias("_part")).filter(F.length("_part") > 0)
    wanted = keep(wanted)
    small = _is_small(wanted)
    n_salts = 1 if small else _SALTS
    salts = F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))).alias("_salt")
    size = F.char_length("_part")
    index = wanted.groupBy(first_word(F.col("_part")).alias("_first")).agg(F.collect_set(size).alias("_sizes"))
    index, table = index.select("_first", "_sizes", salts), wanted.select("*", salts)
    if small:
        index, table = F.broadcast(index), F.broadcast(table)
    longest = wanted.agg(F.max(size) + 1).scalar()
    # The hash is worked out below the generator, once for a post and not for each of its places.
    texts = posts.select(*keys, _text_hash().alias("text_hash"), post_text().alias("_text"))
    places = texts.select(*keys, "text_hash", F.explode(free_starts(F.col("_text"), longest)).alias("_at"))
    places = places.withColumns({"_first": first_word(F.col("_at")), "_salt": F.pmod(F.xxhash64("text_hash", "_at"), F.lit(n_salts)).cast("int")})
    parts = places.join(index, ["_first", "_salt"]).select(
        *keys, "text_hash", "_salt", F.explode(F.transform("_sizes", lambda n: whole_part(F.col("_at"), n))).alias("_part")
    )
    hits = parts.filter(F.col("_part").isNotNull()).join(table, ["_part", "_salt"])
    return hits.select(*keys, "text_hash", "phrase", "rank").distinct()


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def match_phrases(
    posts: DataFrame, phrases: Sequence[str] | DataFrame, keys: Sequence[str] = POST_KEY
) -> DataFrame:
    """Add ``matched_keywords`` (all held phrases, in phrase order) and ``first_match``.

    A list of phrases is matched inside each row. A phrase table is matched by ``phrase_hits``;
    the matches of one post are at most the phrases it holds.
    """
    if not isinstance(phrases, DataFrame):
        out = posts.withColumn("_fenced", fence(post_text(), phrases))
        out = out.withColumn("matched_keywords", held_phrases(F.col("_fenced"), phrases)).drop("_fenced")
    else:
        hits = phrase_hits(posts, phrases, keys)
        by = [*keys, "text_hash"]
        ranked = F.array_sort(F.collect_set(F.struct("rank", "phrase")))
        found = hits.groupBy(*by).agg(F.transform(ranked, lambda h: h["phrase"]).alias("matched_keywords"))
        found = found.select(*[F.col(k).alias(f"_{k}") for k in by], "matched_keywords")
        out = posts.drop("matched_keywords").withColumn("text_hash", _text_hash())
        out = out.join(found, _same(by), "left").drop("text_hash", *[f"_{k}" for k in by])
        none = F.array().cast("array<string>")
        out = out.withColumn("matched_keywords", F.coalesce(F.col("matched_keywords"), none))
    return out.withColumn("first_match", F.get("matched_keywords", F.lit(0)))


def mention_counts(posts: DataFrame, names: Sequence[str] | DataFrame, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """Posts that mention each name, and when the last of them was posted."""
    if isinstance(names, DataFrame):
        by = [*keys, "posted_at", "text_hash"]
        # Rows of one key and text are one row of hits, but each of them mentions the name.
        rows = posts.select(*keys, "posted_at", _text_hash().alias("text_hash"))
        copies = rows.groupBy(*by).agg(F.count("*").alias("copies")).select(*[F.col(k).alias(f"_{k}") for k in by], "copies")
        hits = phrase_hits(posts, names, by[:-1]).select(*by, "phrase").distinct().join(copies, _same(by))
    else:
        fenced = posts.select("posted_at", fence(post_text(), names).alias("_fenced"))
        hits = fenced.select("posted_at", F.explode(held_phrases(F.col("_fenced"), names)).alias("phrase"))
        hits = hits.withColumn("copies", F.lit(1).cast("bigint"))
    return hits.groupBy(F.col("phrase").alias("name")).agg(
        F.sum("copies").alias("mentions"), F.max("posted_at").alias("last_posted_at")
    )
