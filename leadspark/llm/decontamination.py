"""Benchmark decontamination by winnowing.

Every window of ``window`` words holds ``window - gram + 1`` runs of ``gram`` words; the least of their hashes is the
window's fingerprint, so a span shared by a document and an item has the same fingerprint in both, wherever it
stands. Documents are matched by their sets of fingerprints; only matching documents are looked at again, and their
hits are extended: a window counts if fingerprint and a 128-bit hash of all its words agree with the item's.

A document's hits depend on its text alone. They are worked out once for each different text and handed to all rows
that carry it, so large groups of copies cost one text.

Defined cases: null and empty texts have no words, no hits and no items. An item without words matches nothing; one of
fewer words than a window is one window of its own length, its own fingerprint. Repeated items with one ``item_id``
count once; a null ``item_id`` never counts as an item, though its words are hit. Repeated documents each get their
row. Without items or documents the result has no hits or no rows. Other columns of the documents are kept; those named
as a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadspark.llm.arrays import add_minima, add_runs
from leadspark.session import keep

_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RESULT = ("n_words", "n_hit", "n_items", "items", "contaminated")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words: runs of letters, digits and everything beyond ASCII; A-Z count as a-z."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _GAP), "")


def with_fingerprints(df: DataFrame, window: int, gram: int) -> DataFrame:
    """Add ``marks`` to ``words``: the least hash of ``gram`` words in each window, in the order of the windows."""
    columns = df.columns
    df = df.withColumn("_hash", F.transform("words", lambda w: F.xxhash64(w)))
    df = add_runs(df, "_hash", "_run", gram, lambda a, b: F.xxhash64(a, b))
    df = add_minima(df, "_run", "_least", window - gram + 1)
    return df.select(*columns, F.slice("_least", 1, F.greatest(F.size("words") - (window - 1), F.lit(0))).alias("marks"))


def _text_of(words: Column, at: Column, n: int) -> Column:
    return F.array_join(F.slice(words, at + 1, n), " ")


def _windows(words: str, length: int, window: int) -> Column:
    """Structs of place, length, fingerprint and two hashes, one for each window of so many words."""
    texts = F.transform(F.sequence(F.lit(0), F.size(words) - length), lambda at: _text_of(F.col(words), at, length))
    entry = lambda at, text, mark: F.struct(at.alias("at"), F.lit(length).alias("length"), mark.alias("mark"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"))
    if length < window:
        made = F.transform(texts, lambda text, at: entry(at, text, F.xxhash64(text)))
    else:
        made = F.zip_with(F.transform(texts, lambda text, at: F.struct(at.alias("at"), text.alias("text"))), F.col("marks"), lambda t, mark: entry(t["at"], t["text"], mark))
    return F.when(F.size(words) >= length, made).otherwise(F.array().cast("array<struct<at:int,length:int,mark:bigint,h1:bigint,h2:bigint>>"))


def _whole_windows(length: int) -> Column:
    """The hash of every run of so many words, the fingerprint of an item of this length."""
    runs = F.transform(F.sequence(F.lit(0), F.size("words") - length), lambda at: F.xxhash64(_text_of(F.col("words"), at, length)))
    return F.when(F.size("words") >= length, runs).otherwise(F.array().cast("array<bigint>"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """The documents with ``n_words``, ``n_hit`` (words in windows of an item), ``n_items``, ``items`` (their ids as sorted strings) and ``contaminated``."""
    columns = [c for c in docs.columns if c not in _RESULT]
    item_words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    item_words = keep(with_fingerprints(item_words, window, gram))
    # At most window - 1 lengths.
    short = sorted(r.n for r in item_words.select(F.size("words").alias("n")).where(F.col("n") < window).distinct().collect())
    own = [item_words.where(F.size("words") == n) for n in short] + [item_words.where(F.size("words") >= window)]
    windows = None
    for n, some in zip([*short, window], own):
        part = some.select("item_id", F.explode(_windows("words", n, window)).alias("w")).select("item_id", "w.*").drop("at")
        windows = part if windows is None else windows.union(part)
    windows = keep(windows.distinct())
    marks = windows.select("mark").distinct()

    # Only the text is needed here: the same text has the same key.
    text_key = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text").alias("k2")]
    found = F.array_distinct("marks")
    for n in short:
        found = F.array_union(found, _whole_windows(n))
    seen = with_fingerprints(docs.select(*text_key, words_of(F.col("text")).alias("words")), window, gram).select("k1", "k2", F.explode(found).alias("mark"))
    suspects = seen.join(marks, "mark", "left_semi").select("k1", "k2").distinct()

    texts = docs.select(*text_key, "text").join(suspects, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    texts = with_fingerprints(texts.select("k1", "k2", words_of(F.col("text")).alias("words")), window, gram)
    places = F.flatten(F.array(*[_windows("words", n, window) for n in [*short, window]]))
    match = ["length", "mark", "h1", "h2"]
    hits = texts.select("k1", "k2", F.explode(places).alias("w")).select("k1", "k2", "w.*").join(windows.select(*match).distinct(), match, "left_semi")
    hits = keep(hits)
    # Spans are joined within a text: each adds what lies beyond the furthest end so far.
    spans = hits.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("at", (F.col("at") + F.col("length")).alias("end")))).alias("spans"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"), (a["n"] + F.greatest(s["end"] - F.greatest(a["end"], s["at"]), F.lit(0))).alias("n")),
        lambda a: a["n"],
    )
    n_hit = spans.select("k1", "k2", covered.alias("n_hit"))
    named = hits.select("k1", "k2", *match).distinct().join(windows, match).where("item_id is not null").groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    verdicts = n_hit.join(named, ["k1", "k2"], "left")

    base = docs.select(*columns, F.size(words_of(F.col("text"))).cast("long").alias("n_words"), *[k.alias(f"_{name}") for k, name in zip(text_key, ("k1", "k2"))])
    judged = base.join(verdicts.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "n_hit", "items"), ["_k1", "_k2"], "left")
    none = F.array().cast("array<string>")
    n_hit, named = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", none)
    return judged.select(*columns, "n_words", n_hit.alias("n_hit"), F.size(named).cast("long").alias("n_items"), named.alias("items"), (n_hit > 0).alias("contaminated"))
