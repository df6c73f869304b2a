"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is cut into blocks of equal tokens. Blocks go to sources by highest quotients (target / 1, 3, 5, ...), and a
source's blocks go to its shards in the same way by the shards' sizes: each shard has an integer quota. A shard lays
its documents end to end in a seeded order and cuts them into blocks; a quota takes whole rounds of the shard and then
its first blocks, which the seed has drawn.

Seats are found without listing all quotients: every divisor between ``total / (seats + parties / 2)`` and ``total /
(seats - parties / 2)`` brackets the solution, so all but at most two seats per party are settled by division, and only
the rest are ranked. Sources are expected to be few enough to be ranked in one window (their names and sizes only);
documents are spread over shards of bounded size, however large their source is.

Defined cases: a null or empty text has size 0 and nothing is taken of it. A null source is a source of its own, the
last. Repeated rows are documents of their own, even with one ``doc_id``. An empty table gives an empty mix. Columns of
the input that have a name of the result are replaced; all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

WORD = r"[^\x20\x09-\x0D]+"
_RESULT = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _draw(seed: int) -> Column:
    """A seeded number of 60 bits for a document."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))), 1, 15), 16, 10).cast("long")


def seats(parties: DataFrame, within: list[str], claim: str, total: str, most: str, tie: list[str]) -> DataFrame:
    """Add ``seats``: ``total`` seats shared by highest quotients of ``claim`` within the group, ``most`` each at most."""
    group = Window.partitionBy(*within)
    share = F.col(total) / F.col("_claims") * F.col(claim)
    slack = F.col("_parties") / 2.0
    scaled = lambda by: F.when(F.col("_claims") > 0, share * F.greatest(F.col(total) + by, F.lit(0.0)) / F.greatest(F.col(total), F.lit(1))).otherwise(0.0)
    bounded = lambda x: F.least(F.floor(x).cast("long"), F.col(most))
    fixed = (
        parties.withColumn("_claims", F.sum(claim).over(group).cast("double")).withColumn("_parties", F.count("*").over(group))
        .withColumn("_low", bounded(scaled(-slack) + 0.5 - 1e-9)).withColumn("_high", bounded(scaled(slack) + 0.5 + 1e-9))
        .withColumn("_low", F.greatest(F.col("_low"), F.lit(0).cast("long")))
        .withColumn("_left", F.col(total) - F.sum("_low").over(group))
    )
    listed = fixed.withColumn("_seat", F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low") + 1, F.col("_high")))))
    ranked = listed.withColumn("_rank", F.row_number().over(group.orderBy(F.desc_nulls_last(F.col(claim) / (2 * F.col("_seat") - 1)), *tie, "_seat")))
    won = (F.col("_seat").isNotNull() & (F.col("_rank") <= F.col("_left"))).cast("long")
    return ranked.groupBy(*parties.columns).agg((F.first("_low") + F.sum(won)).alias("seats"))


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Add ``target`` to ``(source, source_size)``: the weights repeat over the sources by code point, null last.

    Targets are weight times one common level, but no more than ``most`` times the source's size. A source is full if
    raising the level to where it fills would not pass the mix's total.
    """
    everything, by_level = Window.partitionBy(), Window.orderBy("_full_at", "_number")
    turn = F.pmod(F.col("_number") - 1, F.lit(len(weights))) + 1
    ranked = (
        sources.withColumn("_number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
        .withColumn("_cap", most * F.col("source_size").cast("double"))
        .withColumn("_mix", share * F.sum("source_size").over(everything).cast("double"))
        .withColumn("_full_at", F.col("_cap") / F.col("_weight"))
    )
    filled = (
        ranked.withColumn("_caps", F.sum("_cap").over(by_level)).withColumn("_after", F.sum("_weight").over(everything) - F.sum("_weight").over(by_level))
        .withColumn("_is_full", F.col("_caps") + F.col("_after") * F.col("_full_at") <= F.col("_mix"))
    )
    rest = lambda c: F.coalesce(F.sum(F.when(~F.col("_is_full"), F.col(c))).over(everything), F.lit(1.0))
    caps = F.coalesce(F.sum(F.when(F.col("_is_full"), F.col("_cap"))).over(everything), F.lit(0.0))
    level = filled.withColumn("_free", (F.col("_mix") - caps) / rest("_weight"))
    return level.withColumn("target", F.when(F.col("_is_full"), F.col("_cap")).otherwise(F.least("_cap", F.col("_weight") * F.col("_free")))).select("source", "source_size", "target", "_number")


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 17, block_words: int = 16, shard_words: int = 1 << 18
) -> DataFrame:
    """The documents with ``size`` (words), ``source_size``, ``target`` (their source's) and ``taken`` (words that the mix takes).

    ``share`` is the mix's total as a share of all words; no document is taken more than ``most`` times.
    """
    kept = [c for c in docs.columns if c not in _RESULT]
    sized = docs.select(*kept, (F.col("size").cast("long") if "size" in docs.columns and "text" not in docs.columns else word_count(F.col("text"))).alias("size"))
    sized = sized.withColumn("_draw", _draw(seed))
    sources = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    sources = sources.withColumn("_blocks", F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long"))
    sources = sources.withColumn("_most", F.ceil(most * F.col("source_size") / block_words).cast("long")).withColumn("_all", F.lit(1))
    sources = seats(sources, ["_all"], "target", "_blocks", "_most", ["_number"]).withColumn("_shards", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / shard_words)))
    sources = sources.select("_number", F.col("source").alias("_source"), "source_size", "target", F.col("seats").alias("_quota"), "_shards")
    placed = sized.join(sources, sized["source"].eqNullSafe(sources["_source"])).withColumn("_shard", F.pmod(F.col("_draw"), F.col("_shards")))
    shards = placed.groupBy("_number", "_shard").agg(F.sum("size").alias("_words"), F.first("_quota").alias("_quota"))
    shards = shards.withColumn("_each", F.ceil(F.col("_words") / block_words).cast("long")).withColumn("_most", most * F.col("_each"))
    shards = seats(shards, ["_number"], "_words", "_quota", "_most", ["_shard"]).select("_number", "_shard", "_each", F.col("seats").alias("_seats"))
    line = Window.partitionBy("_number", "_shard").orderBy(F.floor(F.col("_draw") / F.col("_shards")), "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("_end", F.sum("size").over(line)).join(shards, ["_number", "_shard"])
    rounds = F.when(F.col("_each") > 0, F.floor(F.col("_seats") / F.col("_each"))).otherwise(0)
    drawn = (F.col("_seats") - rounds * F.col("_each")) * block_words
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), drawn - (F.col("_end") - F.col("size"))))
    taken = F.least(most * F.col("size"), rounds * F.col("size") + part).cast("long")
    return laid.select(*kept, "size", "source_size", "target", taken.alias("taken"))
