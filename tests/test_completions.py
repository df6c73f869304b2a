"""Completion calls: bad rows, kept replies, cycles."""

from __future__ import annotations

import collections
import glob
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from leadspark.operators import completions
from leadspark.operators.scoring import Profile
from leadspark.plans import cycles


NOW = "2024-01-31T00:00:00"


def prompts(spark, n=20):
    return spark.range(n).select(F.lit("reddit").alias("platform"), F.col("id").cast("string").alias("external_id"), F.lit("be strict").alias("system"), F.col("id").cast("string").alias("prompt"))


def counting(folder, bad=()):
    """Notes each prompt it answers as a file; fails on the given ones."""

    def complete(requests):
        if any(t in bad for _, t in requests):
            raise RuntimeError("down")
        for _, t in requests:
            with open(os.path.join(folder, f"{t}-{os.urandom(4).hex()}"), "w"):
                pass
        return [json.dumps({"score": int(t), "reasoning": system}) for system, t in requests]

    return complete


def calls_of(folder):
    """How often each prompt was answered."""
    return collections.Counter(os.path.basename(f).split("-")[0] for f in glob.glob(f"{folder}/*"))


def test_a_bad_row_costs_only_itself(spark, folder):
    out = completions.score_with(prompts(spark), counting(folder, bad=("3", "7")), as_of=NOW, batch=5)
    rows = {r.external_id: (r.score, r.reasoning, r.error) for r in out.collect()}
    assert rows["3"] == rows["7"] == (None, None, "RuntimeError: down")
    assert all(rows[str(i)] == (i, "be strict", None) for i in range(20) if i not in (3, 7))


@pytest.mark.parametrize("tasks", [None, 1, 2])
def test_each_row_is_paid_once(spark, folder, tasks):
    """Also rows that are asked for twice at once, results that are read twice, and reruns."""
    calls, store = os.path.join(folder, "calls"), os.path.join(folder, "store")
    os.mkdir(calls)
    ask = lambda n, bad=(): completions.score_with(prompts(spark, n).union(prompts(spark, 3)), counting(calls, bad), as_of=NOW, store=store, batch=2, tasks=tasks)
    first = ask(10, ("3",))
    assert first.count() == 10 and first.filter("error is null").count() == 9
    assert calls_of(calls) == {str(i): 1 for i in range(10) if i != 3}
    again = ask(12)
    assert {r.external_id: (r.score, r.error) for r in again.collect()} == {str(i): (i, None) for i in range(12)}
    again.count()
    assert calls_of(calls) == {str(i): 1 for i in range(12)}
    assert ask(0).count() == 3


def test_without_a_store_rows_are_paid_once_too(spark, folder):
    out = completions.score_with(prompts(spark, 6), counting(folder), as_of=NOW)
    assert out.count() == 6 and out.filter("score > 2").count() == 3
    assert calls_of(folder) == {str(i): 1 for i in range(6)}


def test_replies_of_finished_tasks_outlive_a_failed_job(spark, folder):
    """One task dies before it calls; with one task at a time, the others are paid and keep their replies."""
    calls, store, mark = (os.path.join(folder, n) for n in ("calls", "store", "mark"))
    os.mkdir(calls)
    answer = counting(calls)

    def dying(requests):
        if any(t == "5" for _, t in requests) and not os.path.exists(mark):
            with open(mark, "w"):
                os._exit(1)
        return answer(requests)

    ask = lambda completer: completions.score_with(prompts(spark, 9), completer, as_of=NOW, store=store, batch=1, tasks=1)
    with pytest.raises(Exception, match="crashed|exited"):
        ask(dying)
    paid = calls_of(calls)
    assert "5" not in paid and set(paid.values()) <= {1}
    assert ask(dying).filter("error is null").count() == 9
    assert calls_of(calls) == {str(i): 1 for i in range(9)}


def test_an_unreadable_store_is_no_empty_one(spark, folder):
    spark.range(1).write.json(f"{folder}/store/deeper")
    with pytest.raises(AnalysisException):
        completions.score_with(prompts(spark, 2), counting(folder), as_of=NOW, store=f"{folder}/store")
    assert not glob.glob(f"{folder}/[0-9]*")


def test_short_answer_is_an_error(spark):
    out = completions.draft_with(prompts(spark, 3).withColumnRenamed("external_id", "lead_id"), lambda texts: [], ("lead_id",), as_of=NOW)
    assert all("ValueError" in r.error for r in out.collect())


def test_prompts_hold_the_callers_words_and_the_names_of_the_reply(spark):
    from leadspark.operators import scoring

    row = scoring.scoring_prompts(posts(spark, 1), "Founders", "Mind the date.").first()
    words, names = row.system.split("\n")
    assert words == "Mind the date." and json.loads(names)["bands"] == [90, 75, 60, 40] and json.loads(names)["reply"][0] == "score"
    assert json.loads(row.prompt) == {
        "profile": "Founders",
        "post": {"platform": "reddit", "external_id": "0", "author": "a0", "title": "t", "body": "looking for tool", "url": "u", "posted_at": "2024-01-30T23:00:00Z"},
    }
    queue = posts(spark, 1).withColumns({"score": F.lit(80), "reasoning": F.lit(None).cast("string")})
    row = scoring.drafting_prompts(queue, "me", "facts", F.lit(None).cast("string"), "Be kind.").first()
    assert json.loads(row.system.split("\n")[1])["sentences"] == 4
    assert json.loads(row.prompt) == {"profile": "me", "facts": "facts", "lead": {"platform": "reddit", "author": "a0", "url": "u", "title": "t", "body": "looking for tool", "score": 80}}


POST = "id string, platform string, external_id string, author string, title string, body string, url string, scraped_at timestamp_ntz, posted_at timestamp_ntz"
LOG = "platform string, external_id string, event string, at timestamp"
LEAD = "id string, raw_post_id string, platform string, external_id string, author string, score int, reasoning string, signal_tags array<string>, disqualifiers array<string>, status string, scored_at timestamp"


def posts(spark, n):
    return spark.range(n).selectExpr(
        "concat('p', id) id", "'reddit' platform", "cast(id as string) external_id", "concat('a', id) author", "'t' title", "'looking for tool' body",
        "'u' url", "timestamp_ntz '2024-01-30 00:00:00' scraped_at", "timestamp_ntz '2024-01-30 23:00:00' posted_at",
    )


def test_score_cycle(spark):
    scores = {"0": 59, "1": 60, "2": 140, "3": None, "4": 90, "5": 100, "6": 80}

    def scorer(df):
        table = spark.createDataFrame(list(scores.items()), "external_id string, score int")
        none = F.array().cast("array<string>")
        return df.join(table, "external_id").withColumns({"reasoning": F.lit("r"), "signal_tags": none, "disqualifiers": none})

    held = spark.createDataFrame([("l", "p4", "reddit", "4", "a4", 61, "r", [], [], "sent", None)], LEAD)
    blocked = spark.createDataFrame([("a6",)], "author string")
    out = cycles.score_cycle(posts(spark, 8), spark.createDataFrame([], LOG), held, scorer, "2024-01-31T00:00:00", blocked)
    assert {r.external_id: r.score for r in out.leads.collect()} == {"1": 60, "5": 100}
    assert sorted(r.external_id for r in out.score_log.collect()) == ["0", "1", "3", "4", "5", "6"]
    assert {r.external_id: r.violations for r in out.quarantined.collect()} == {"2": ["score_range"]}


def test_rubric_scorer_cycle(spark):
    profile = Profile(explicit=["looking for"], fit={"any": ["tool"]}, exact_pain=["tool"])
    out = cycles.score_cycle(posts(spark, 3), spark.createDataFrame([], LOG), spark.createDataFrame([], LEAD), cycles.rubric_scorer(profile, "2024-01-31T00:00:00"), "2024-01-31T00:00:00")
    assert {r.score for r in out.leads.collect()} == {100}


def test_completion_scorer_leaves_errors_queued(spark, folder):
    def complete(requests):
        if any('"external_id":"2"' in t for _, t in requests):
            raise RuntimeError("down")
        return ['{"score": 77}' for _ in requests]

    scorer = cycles.completion_scorer(complete, "Founders", "Be strict.", "2024-01-31T00:00:00", f"{folder}/store")
    out = cycles.score_cycle(posts(spark, 4), spark.createDataFrame([], LOG), spark.createDataFrame([], LEAD), scorer, "2024-01-31T00:00:00")
    assert sorted(r.external_id for r in out.leads.collect()) == ["0", "1", "3"]
    assert sorted(r.external_id for r in out.score_log.collect()) == ["0", "1", "3"]


DRAFT = "id string, lead_id string, channel string, subject string, body string, rationale string, estimated_quality int, status string, rejection_reason string, drafted_at timestamp, reviewed_at timestamp"


def new_leads(spark):
    return spark.createDataFrame([(f"l{i}", f"p{i}", "reddit", str(i), "a", 70 + i, "r", [], [], "new", None) for i in range(8)], LEAD)


def answers(folder=None):
    def complete(requests):
        for _, t in requests if folder else ():
            with open(os.path.join(folder, f"{json.loads(t)['lead']['score']}-{os.urandom(4).hex()}"), "w"):
                pass
        return [json.dumps({"channel": "reddit_dm", "body": "hi 🔥", "estimated_quality": 3}) for _ in requests]

    return complete


def test_draft_cycle_waits_for_reviews(spark):
    pending = spark.range(51).selectExpr("concat('x', id) lead_id", "'pending_review' status")
    ask = lambda drafts: cycles.draft_cycle(new_leads(spark), posts(spark, 8), drafts, answers(), "me", "", "", "", NOW, n=2)
    out = ask(pending.limit(50))
    assert {(r.lead_id, tuple(r.violations), r.status) for r in out.drafts.collect()} == {("l6", ("emoji",), "pending_review"), ("l7", ("emoji",), "pending_review")}
    assert {(r.id, r.status) for r in out.transitions.collect()} == {("l6", "drafted"), ("l7", "drafted")}
    assert ask(pending).drafts.count() == 0


def test_draft_cycle_calls_once_for_each_lead_and_adds_nothing_twice(spark, folder):
    none = spark.createDataFrame([], DRAFT)
    ask = lambda drafts, store=None: cycles.draft_cycle(new_leads(spark), posts(spark, 8), drafts, answers(folder), "me", "", "", "", NOW, store=store)
    out = ask(none)
    drafts = out.drafts.drop("violations").collect()
    assert len(drafts) == out.transitions.count() == 3 and out.failures.count() == 0
    assert calls_of(folder) == {"75": 1, "76": 1, "77": 1}
    stored = spark.createDataFrame(drafts, DRAFT)
    again = ask(stored)
    assert again.drafts.count() == again.transitions.count() == 0 and sum(calls_of(folder).values()) == 3
    # A lead whose drafts were all rejected is drafted for again.
    rejected = stored.withColumn("status", F.when(F.col("lead_id") == "l6", "rejected").otherwise(F.col("status")))
    assert [r.lead_id for r in ask(rejected).drafts.collect()] == ["l6"]


def test_draft_cycle_moves_covers_all_leads_however_many_drafts_wait(spark, con, folder):
    """More drafts await review than the usual gate lets pass, and each lead holds some."""
    from oracle import SF_DIR

    from leadspark.catalog import QUERIES, SQL
    from leadspark.sources import adapters as A

    for t in ("documents", "labels"):
        os.symlink(f"{SF_DIR}/{t}.parquet", f"{folder}/{t}.parquet")
    ids = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("doc_id conv_id")
    talks = ids.crossJoin(spark.range(5).selectExpr("id turn")).selectExpr("conv_id", "cast(turn as int) turn", "'assistant' role", "'hi' text")
    talks.coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    assert A.drafts(spark, folder).filter("status = 'pending_review'").count() > 50
    want = con.execute(SQL["draft_cycle_moves"]).fetchall()
    got = [tuple(r) for r in QUERIES["draft_cycle_moves"](spark, folder).collect()]
    assert len(want) > 0 and sorted(got) == sorted(want)
    assert QUERIES["draft_cycle"](spark, folder).count() == 0


def test_ids_follow_from_the_moment_not_from_its_text(spark):
    from datetime import datetime, timezone

    from leadspark.operators.loading import new_drafts, session_row

    draft = spark.createDataFrame([("l", "reddit_dm", "", "b", "r", 0), ("l", "reddit_dm", "", "a", "r", 0)], "lead_id string, channel string, subject string, body string, rationale string, estimated_quality int")
    moments = ["2024-01-31T00:00:00", "2024-01-31 01:00:00+01:00", datetime(2024, 1, 31), datetime(2024, 1, 31, tzinfo=timezone.utc)]
    made = [new_drafts(draft, m).collect() for m in moments]
    assert all(len(rows) == 1 and rows[0].body == "a" for rows in made) and len({rows[0].id for rows in made}) == 1
    stats = spark.range(1)
    assert len({session_row("k", m, None, stats).first().id for m in moments}) == 1
