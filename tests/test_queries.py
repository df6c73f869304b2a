"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import re

import pytest
from oracle import SF_DIR, compare

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_matches_sql(spark, con, name):
    verdict, _ = compare(spark, con, QUERIES[name], SQL.get(name), SF_DIR)
    assert verdict == "ok"


def test_flagship_has_one_row(spark):
    assert entry.entry(spark).count() == 1


def _plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["funnel_7d", "readiness", "gated_queue", "seed_if_empty", "health_report", "draft_queue", "append_new", "match_phrase_table", "rate_budget", "source_history"])
def test_no_cross_join(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_funnel_reads_each_table_once(spark):
    plan = _plan(spark, "funnel_7d")
    # The leads view itself joins documents and labels, hence four files for three tables.
    assert plan.count("FileScan") == 4
    assert "text#" not in plan


def test_rank_is_pruned_before_the_shuffle(spark):
    for name in ("first_per_key", "cap_per_group", "cap_per_group_deep", "style_examples", "append_new"):
        plan = _plan(spark, name)
        exchange = plan.index("Exchange hashpartitioning")
        assert "Partial" in plan[exchange:] and "WindowGroupLimit" in plan[exchange:], name


def test_a_deep_rank_needs_no_setting_of_the_session(spark):
    """Only rows near the first ones are ranked, in parts first, also where Spark prunes no such rank."""
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1000")
    try:
        plan = _plan(spark, "cap_per_group_deep")
        assert "WindowGroupLimit" not in plan and "LeftSemi" in plan
        lowest = [line for line in plan.splitlines() if "hashpartitioning" in line][-1]
        assert "_part" in lowest
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("values", [3, 40, 10_000])
def test_a_deep_rank_holds_the_first_rows(spark, monkeypatch, values):
    """With few, some and many values of the leading column, with nulls in it and in the group."""
    from pyspark.sql import Window, functions as F

    from leadspark.operators import keyed

    monkeypatch.setattr(keyed, "_PRUNED", 5)
    n = F.col("id")
    df = spark.range(3000).select("id", F.when(n % 7 < 6, n % 3).alias("g"), F.when(n % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(values))).alias("v"))
    order = [F.col("v").desc(), F.col("id")]
    rank = F.row_number().over(Window.partitionBy("g").orderBy(*order))
    for cap in (1, 60, 2000):
        want = sorted(r.id for r in df.withColumn("r", rank).filter(F.col("r") <= cap).collect())
        for leading in ("v", None):
            got = keyed.cap_per_group(df, ["g"], cap, order, leading=leading)
            assert got.columns == df.columns and sorted(r.id for r in got.collect()) == want


def test_time_bound_reaches_the_scan(spark, folder):
    from leadspark.plans.reports import funnel
    from leadspark.schemas import DRAFTS, LEADS, RAW_POSTS

    frames = []
    for i, schema in enumerate((RAW_POSTS, LEADS, DRAFTS)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{i}")
        frames.append(spark.read.schema(schema).parquet(f"{folder}/{i}"))
    plan = funnel(*frames, "2024-01-31T00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3
    assert "GreaterThan(scraped_at," in plan and "GreaterThan(scored_at," in plan
    assert "ReadSchema: struct<scraped_at:timestamp>" in plan


@pytest.mark.parametrize("n", [3, 50])
def test_short_lists_are_chosen_without_texts(spark, folder, n):
    """One plan for every length: whole posts are read within a span of time and cross no shuffle."""
    from leadspark.plans import queues
    from leadspark.schemas import LEADS, RAW_POSTS, SCORE_LOG

    frames = []
    for i, schema in enumerate((RAW_POSTS, LEADS, SCORE_LOG)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{i}")
        frames.append(spark.read.schema(schema).parquet(f"{folder}/{i}"))
    posts, leads, log = frames
    now = "2024-01-31T00:00:00"
    for df in (queues.score_batch(posts, log, n), queues.draft_queue(leads, posts, n), queues.digest_leads(leads, posts, now, n=n), queues.recent_leads(leads, posts, now, n=n)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        wide = [line for line in plan.splitlines() if "FileScan" in line and "title#" in line]
        assert wide and all("scraped_at#" in line.split("DataFilters: ")[1] and ">=" in line for line in wide)
        # A broadcast list holds no texts, and no row is shuffled below the choice of texts.
        texts = set(re.findall(r"(?:title|body)#\d+", " ".join(wide)))
        exchanges = [line for line in plan.splitlines() if "Exchange" in line]
        assert not any(t in line for line in exchanges for t in texts)
        assert len(df.columns) == len(set(df.columns))


def test_short_lists_hold_the_first_rows(spark):
    from datetime import datetime, timedelta

    from leadspark.plans import queues

    at = lambda i: datetime(2024, 1, 1) + timedelta(minutes=i)
    posts = spark.createDataFrame([(f"p{i}", "reddit", str(i), at(i % 7), f"t{i}", "b", "u") for i in range(40)], "id string, platform string, external_id string, scraped_at timestamp, title string, body string, url string")
    log = spark.createDataFrame([("reddit", str(i), "scored", at(9)) for i in range(0, 40, 3)], "platform string, external_id string, event string, at timestamp")
    want = sorted(((i % 7, str(i)) for i in range(40) if i % 3), key=lambda x: (x[0], x[1]))
    for n in (1, 5, 100):
        assert [(r.external_id, r.title) for r in queues.score_batch(posts, log, n).collect()] == [(i, f"t{i}") for _, i in want[:n]]
    leads = spark.createDataFrame([(f"l{i}", f"p{i * 2}", "reddit", str(i), 70 + i, "new", at(i)) for i in range(25)], "id string, raw_post_id string, platform string, external_id string, score int, status string, scored_at timestamp")
    for n in (2, 10, 100):
        assert [(r.id, r.title) for r in queues.draft_queue(leads, posts, n).collect()] == [(f"l{i}", f"t{i * 2}") for i in range(19, 4, -1)][:n]
