"""The collect, score and draft cycles as sets of rows to append.

Each cycle returns frames; the caller appends them to the tables. Nothing is updated in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadspark.functions.text import post_key
from leadspark.functions.times import Moment, moment
from leadspark.operators.checks import check_rows, split_checked
from leadspark.operators.completions import Completer, draft_with, score_with
from leadspark.operators.drafting import BACKLOG_LIMIT, backlog_gate, gate_queue, lint_drafts
from leadspark.operators.filters import promote, with_defaults
from leadspark.operators.joins import drop_do_not_approach
from leadspark.operators.keyed import POST_KEY, append_new, union_posts
from leadspark.operators.loading import cycle_stats, log_events, new_drafts, session_row
from leadspark.operators.scoring import Profile, drafting_prompts, rubric_score, scoring_prompts
from leadspark.plans.queues import draft_queue, score_batch
from leadspark.session import keep


# The source and codes of the cycles' events, and the kind of a collecting run.
EVENT_SOURCE = "bot"
SCRAPE_DONE, SCRAPE_FAILED, SKIPPED, SCORE_DONE, DRAFT_FAILED = "SCRAPE_DONE", "SCRAPE_FAILED", "SKIP_RATE_LIMITED", "SCORE_DONE", "DRAFT_FAIL"
SCRAPE_RUN = "scrape_cycle"


@dataclass(frozen=True)
class Collected:
    """Rows for the post table, counts, the run's row, and events for the log."""

    new_posts: DataFrame
    stats: DataFrame
    run: DataFrame
    events: DataFrame


def _event(df: DataFrame, level: str, code: str, message: Column, as_of: Moment, context: Sequence[str] = ()) -> DataFrame:
    return log_events(df, level, EVENT_SOURCE, code, message, context, moment(as_of, T.TimestampType()))


def collect_cycle(existing: DataFrame, frames: list[DataFrame], as_of: Moment, attempts: DataFrame | None = None, ended: Moment | None = None) -> Collected:
    """Normalised posts of all platforms to the new rows of the post table.

    The payloads are read once, when this is called; the posts are kept in the shared folder, where the
    load finds their keys without reading the texts. Of a post found by several phrases, the row of the least
    ``phrase_rank`` stays, a column that the landed payloads may carry, as they may the ``source_id`` that is stored.
    ``attempts`` (``source_id``, ``outcome``) are the run's reads of its sources: failed and rate-limited ones are events.
    """
    offered = with_defaults(union_posts(*frames))
    if "phrase_rank" not in offered.columns:
        offered = offered.withColumn("phrase_rank", F.lit(None).cast("int"))
    offered = keep(offered).withColumns(
        {
            "id": post_key(F.col("platform"), F.col("external_id")),
            "scraped_at": moment(as_of, T.TimestampType()),
        }
    )
    # As if the phrases had been read one after the other: the first of them that finds a post stores it.
    order = ["scraped_at", F.col("phrase_rank").asc_nulls_last(), F.col("posted_at").asc_nulls_last(), F.array_join("matched_keywords", ",")]
    new = append_new(existing, offered, POST_KEY, order).drop("phrase_rank")
    stats = cycle_stats(offered, new)
    run = session_row(SCRAPE_RUN, as_of, as_of if ended is None else ended, stats)
    events = _event(stats, "info", SCRAPE_DONE, F.concat(F.col("inserted").cast("string"), F.lit(" new posts")), as_of, ["attempted", "inserted"])
    if attempts is not None:
        for outcome, level, code in (("failed", "error", SCRAPE_FAILED), ("rate_limited", "warn", SKIPPED)):
            some = attempts.filter(F.col("outcome") == outcome)
            events = events.unionByName(_event(some, level, code, F.concat(F.lit("source "), F.col("source_id").cast("string")), as_of, ["source_id"]))
    return Collected(new, stats, run, events)


@dataclass(frozen=True)
class Scored:
    leads: DataFrame
    score_log: DataFrame
    quarantined: DataFrame
    events: DataFrame


Scorer = Callable[[DataFrame], DataFrame]


def rubric_scorer(profile: Profile, as_of: Moment) -> Scorer:
    return lambda posts: rubric_score(posts, profile, as_of)


def completion_scorer(
    completer: Completer, profile: str, guidance: str, as_of: Moment, store: str | None = None, batch: int = 16, tasks: int | None = None
) -> Scorer:
    """Scores by completions; rows with an error are left out and so stay queued."""

    def score(posts: DataFrame) -> DataFrame:
        results = score_with(scoring_prompts(posts, profile, guidance), completer, POST_KEY, as_of=as_of, store=store, batch=batch, tasks=tasks)
        good = results.filter(F.col("error").isNull()).drop("error")
        return posts.drop("score", "reasoning", "signal_tags", "disqualifiers").join(good, list(POST_KEY))

    return score


def score_cycle(
    posts: DataFrame, score_log: DataFrame, leads: DataFrame, scorer: Scorer, as_of: Moment,
    blocklist: DataFrame | None = None, n: int | None = None,
) -> Scored:
    """Score what waits: new leads, ``scored`` events, and rows whose score cannot be stored.

    The posts are scored once, when this is called; the results, without texts, are kept in the shared
    folder and the three frames read them from there. A stored lead is never changed by scoring its post
    again. Posts of authors on the blocklist are settled without being scored.
    """
    batch = score_batch(posts, score_log, n)
    settled = None
    if blocklist is not None:
        settled = batch.join(blocklist.select("author"), "author", "left_semi").select(*POST_KEY)
        batch = drop_do_not_approach(batch, blocklist)
    at = moment(as_of, T.TimestampType())
    fields = (*POST_KEY, "author", "score", "reasoning", "signal_tags", "disqualifiers")
    results = keep(scorer(batch).select(F.col("id").alias("raw_post_id"), *fields))
    results = results.withColumns({"status": F.lit("new"), "scored_at": at})
    faults = F.filter("violations", lambda v: v != "score_missing")
    good, bad = split_checked(check_rows(results, "leads").withColumn("violations", faults))
    fresh = append_new(leads, promote(good), POST_KEY, ["scored_at", F.desc("score")])
    fresh = fresh.withColumn("id", post_key(F.col("platform"), F.col("external_id")))
    log = good.select(*POST_KEY, F.lit("scored").alias("event"), F.col("scored_at").alias("at"))
    done = results.agg(F.count("*").alias("scored"))
    events = _event(done, "info", SCORE_DONE, F.concat(F.col("scored").cast("string"), F.lit(" posts scored")), as_of, ["scored"])
    if settled is not None:
        log = log.unionByName(settled.select(*POST_KEY, F.lit("scored").alias("event"), at.alias("at")))
    return Scored(fresh, log, bad, events)


@dataclass(frozen=True)
class Drafted:
    drafts: DataFrame
    transitions: DataFrame
    failures: DataFrame
    events: DataFrame


def draft_cycle(
    leads: DataFrame, posts: DataFrame, drafts: DataFrame, completer: Completer, profile: str, facts: str,
    examples: str, guidance: str, as_of: Moment, store: str | None = None, n: int | None = None, backlog: int | Column = BACKLOG_LIMIT,
    batch: int = 16, tasks: int | None = None, redraft: bool = False,
) -> Drafted:
    """Draft for the best new leads unless too many drafts await review.

    Gives the drafts with the style rules they break, the ``drafted`` transitions of their leads, and
    the leads whose draft failed. The calls are made when this is called, once for each lead; the three frames read
    the kept replies. A lead that holds a draft is not drafted for again, even where its transition has not been
    stored yet, unless all its drafts were rejected or ``redraft`` is asked for.
    """
    held = drafts.filter((F.col("status") != "rejected") & F.lit(not redraft)).select(F.col("lead_id").alias("id"))
    open_leads = leads.join(held, "id", "left_anti")
    queue = gate_queue(draft_queue(open_leads, posts, n), backlog_gate(drafts, backlog)).withColumn("lead_id", F.col("id"))
    prompts = drafting_prompts(queue, profile, facts, examples, guidance)
    written = draft_with(prompts, completer, ("lead_id",), as_of=as_of, store=store, batch=batch, tasks=tasks)
    good = written.filter(F.col("error").isNull())
    made = lint_drafts(new_drafts(good, as_of))
    moved = good.select(
        F.col("lead_id").alias("id"), F.lit("drafted").alias("status"), moment(as_of, T.TimestampType()).alias("at"),
        F.lit(0).cast("bigint").alias("seq"),
    )
    failures = written.filter(F.col("error").isNotNull()).select("lead_id", "error")
    return Drafted(made, moved, failures, _event(failures, "error", DRAFT_FAILED, F.col("error"), as_of, ["lead_id"]))
