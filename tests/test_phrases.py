"""Both ways of phrase matching against a plain regular expression."""

from __future__ import annotations

import re
import unicodedata

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from leadspark.operators import filters, matching

TEXTS = [
    "Looking for tool", "looking for tools", "alooking for tool", "looking  for tool", "(looking for tool)", "LOOKING FOR TOOL!",
    "née looking for tool", "c++ is fun", "abc++ x", "I use #saas daily", "a#saas", "##saas", "24/7 support", "x24/7", "ölooking for tool",
    "looking for\ntool", "", None, "tool", "to ol", "--", "a -- b", "a--b",
]
PHRASES = ["looking for tool", "tool", "c++", "#saas", "24/7", "--", "for tool", "is fun"]


def holds(text: str, phrase: str) -> bool:
    text, phrase = text.lower(), phrase.lower()
    letter = lambda c: unicodedata.category(c).startswith("L")
    for m in re.finditer(f"(?={re.escape(phrase)})", text):
        i, j = m.start(), m.start() + len(phrase)
        if (i == 0 or not letter(text[i - 1])) and (j == len(text) or not letter(text[j])):
            return True
    return False


def frame(spark, texts):
    rows = [("reddit", str(i), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "platform string, external_id string, body string").withColumn("title", F.lit(None).cast("string"))


def expected(texts, phrases):
    return {str(i): [p for p in phrases if t is not None and holds(t, p)] for i, t in enumerate(texts)}


def found(df):
    return {r.external_id: r.matched_keywords for r in df.collect()}


def test_list_and_table_match_like_the_regex(spark):
    posts = frame(spark, TEXTS)
    table = spark.createDataFrame(list(zip(PHRASES, range(len(PHRASES)))), "phrase string, rank int")
    want = expected(TEXTS, PHRASES)
    assert found(matching.match_phrases(posts, PHRASES)) == want
    assert found(matching.match_phrases(posts, table)) == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab é.#1 ", max_size=12), min_size=5, max_size=40), st.lists(st.text(alphabet="ab .#", min_size=1, max_size=4), min_size=1, max_size=6, unique=True))
def test_random_texts(spark, texts, phrases):
    posts = frame(spark, texts)
    table = spark.createDataFrame(list(zip(phrases, range(len(phrases)))), "phrase string, rank int")
    want = expected(texts, phrases)
    assert found(matching.match_phrases(posts, phrases)) == want
    assert found(matching.match_phrases(posts, table)) == want


def test_rows_of_one_key_have_their_own_phrases(spark):
    rows = [("r", "1", "foo"), ("r", "1", "baz"), ("r", None, "foo baz"), (None, None, "baz"), ("r", "1", "foo"), ("r", "1", None)]
    posts = spark.createDataFrame(rows, "platform string, external_id string, body string").withColumns({"title": F.lit(None).cast("string"), "posted_at": F.lit("2024-01-01").cast("timestamp")})
    table = spark.createDataFrame([("foo", 0), ("baz", 1), ("", 2)], "phrase string, rank int")
    got = sorted((r.body or "", r.matched_keywords) for r in matching.match_phrases(posts, table).collect())
    assert got == [("", []), ("baz", ["baz"]), ("baz", ["baz"]), ("foo", ["foo"]), ("foo", ["foo"]), ("foo baz", ["foo", "baz"])]
    assert {r.name: r.mentions for r in matching.mention_counts(posts, table).collect()} == {"foo": 3, "baz": 3}


def test_many_phrases_of_one_first_word(spark):
    """Phrases that share their first word, and lengths; an empty table matches nothing."""
    texts = [f"the {a}{b} of the {b}" for a in "abc" for b in "xyz"] + ["the", "the the", "The Ax!", "there ax", "the\n\nax"]
    phrases = [f"the {a}{b}" for a in "abc" for b in "xyz"] + ["the", "the the", "of the x", "the\n", "\n"]
    posts = frame(spark, texts)
    table = spark.createDataFrame(list(zip(phrases, range(len(phrases)))), "phrase string, rank int")
    assert found(matching.match_phrases(posts, table)) == expected(texts, phrases)
    assert set(map(tuple, found(matching.match_phrases(posts, table.limit(0))).values())) == {()}


def test_places_of_texts_are_not_shuffled_for_a_small_table(spark, monkeypatch):
    """Nor does the way the phrases go change what is found."""
    posts = frame(spark, TEXTS).withColumn("posted_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    table = spark.createDataFrame(list(zip(PHRASES, range(len(PHRASES)))), "phrase string, rank int")
    plan = matching.phrase_hits(posts, table)._jdf.queryExecution().executedPlan().toString()
    assert not any("_at#" in line or "_part#" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    monkeypatch.setattr(matching, "_SMALL", 0)
    assert found(matching.match_phrases(posts, table)) == expected(TEXTS, PHRASES)
    counts = {r.name: r.mentions for r in matching.mention_counts(posts, table).collect()}
    assert counts == {p: n for p in PHRASES if (n := sum(p in ps for ps in expected(TEXTS, PHRASES).values()))}


def test_first_match_and_counts(spark):
    posts = frame(spark, TEXTS).withColumn("posted_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    row = matching.match_phrases(posts, ["tool", "looking for tool"]).filter("external_id = '0'").first()
    assert row.first_match == "tool" and row.matched_keywords == ["tool", "looking for tool"]
    names = ["tool", "#saas"]
    want = {n: sum(n in ps for ps in expected(TEXTS, names).values()) for n in names}
    table = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "phrase string, rank int")
    for given_names in (names, table):
        assert {r.name: r.mentions for r in matching.mention_counts(posts, given_names).collect()} == want


def test_reasons_add_up(spark):
    posts = frame(spark, ["we are hiring now", "nothing", "buy now"]).withColumns({"score": F.lit(80), "lang": F.lit("de")})
    out = filters.disqualify(filters.language_gate(posts, "en"), {"job_ad": ["we are hiring"], "promotion": ["buy now", "hiring now"]})
    assert {r.external_id: (r.score, r.disqualifiers) for r in out.collect()} == {
        "0": (0, ["language", "job_ad", "promotion"]), "1": (0, ["language"]), "2": (0, ["language", "promotion"]),
    }
