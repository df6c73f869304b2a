"""Folds against a plain replay, transitions, reviews, gaps and budgets."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadspark.operators import spans, state

START = datetime(2024, 1, 1)
ATTEMPT = "event_id bigint, source_id bigint, attempted_at timestamp, outcome string"


def replay(rows, resets=()):
    """The updates of each attempt in order, one by one."""
    now = {}
    history = {}
    events = [(at, 0, event, source, outcome) for event, source, at, outcome in rows] + [(at, 1, None, source, "reset") for source, at in resets]
    for at, _, event, source, outcome in sorted(events, key=lambda e: (e[0], e[1], e[2] or 0)):
        s = now.setdefault(source, {"failures": 0, "status": "healthy", "since": None})
        if outcome == "failed":
            if s["failures"] >= 2 and s["status"] != "degraded":
                s["status"], s["since"] = "degraded", at
            s["failures"] += 1
        else:
            s.update(failures=0, status="healthy", since=None)
        if event is not None:
            history[event] = (s["failures"], s["status"])
    return now, history


def attempts(seed, n=400, sources=6):
    rng = random.Random(seed)
    rows, at = [], START
    for event in range(n):
        at += timedelta(seconds=rng.randint(1, 5000))
        source = 0 if rng.random() < 0.4 else rng.randrange(sources)
        rows.append((event, source, at, rng.choices(["failed", "ok", "rate_limited"], [6, 2, 1])[0]))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_state_and_history_equal_a_replay(spark, seed):
    rows = attempts(seed)
    df = spark.createDataFrame(rows, ATTEMPT)
    now, history = replay(rows)
    got = {r.source_id: (r.consecutive_failures, r.status, r.degraded_since) for r in state.source_state(df).collect()}
    assert got == {s: (v["failures"], v["status"], v["since"]) for s, v in now.items()}
    for width in (600, 86_400):
        steps = state.source_history(df, width).collect()
        assert {r.event_id: (r.consecutive_failures, r.status) for r in steps} == history


def test_resets_heal(spark):
    rows = attempts(4)
    resets = [(0, rows[200][2] + timedelta(microseconds=1)), (1, rows[390][2] + timedelta(microseconds=1))]
    now, _ = replay(rows, resets)
    df = spark.createDataFrame(resets, "source_id bigint, reset_at timestamp")
    got = {r.source_id: (r.consecutive_failures, r.status) for r in state.source_state(spark.createDataFrame(rows, ATTEMPT), df).collect()}
    assert got == {s: (v["failures"], v["status"]) for s, v in now.items()}


def tied(seed, n=300):
    """Many attempts of one moment, which only their events order."""
    rng = random.Random(seed)
    return [(event, rng.randrange(3), START + timedelta(minutes=20 * rng.randrange(40)), rng.choices(["failed", "ok"], [5, 1])[0]) for event in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_state_and_history_agree_on_ties(spark, seed):
    rows = tied(seed)
    now, history = replay(rows)
    df = spark.createDataFrame(rows, ATTEMPT)
    assert {r.source_id: (r.consecutive_failures, r.status, r.degraded_since) for r in state.source_state(df).collect()} == {s: (v["failures"], v["status"], v["since"]) for s, v in now.items()}
    assert {r.event_id: (r.consecutive_failures, r.status) for r in state.source_history(df).collect()} == history


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_folds_merge_in_any_order(spark, seed):
    """Stretches in any order, some of them twice, merged one by one or at once."""
    rng = random.Random(seed)
    rows = tied(seed) + [(e + 1000, s, at, o) for e, s, at, o in attempts(seed, 200, 4)]
    whole = sorted(state.source_state(spark.createDataFrame(rows, ATTEMPT)).collect())
    rng.shuffle(rows)
    parts = [rows[i::5] for i in range(5)]
    folds = [state.fold_attempts(spark.createDataFrame(part, ATTEMPT)) for part in [*parts, parts[0], rows[:30]]]
    assert sorted(state.state_of(state.merge_folds(*folds)).collect()) == whole
    steps = state.merge_folds(state.merge_folds(folds[3], folds[1]), state.merge_folds(folds[4], folds[0], folds[2]))
    assert sorted(state.state_of(steps).collect()) == whole


def test_a_late_failure_before_a_success_counts_for_nothing(spark):
    success = spark.createDataFrame([(9, 1, START + timedelta(hours=10), "ok")], ATTEMPT)
    failures = spark.createDataFrame([(i, 1, START + timedelta(hours=5, minutes=i), "failed") for i in range(3)], ATTEMPT)
    merged = state.merge_folds(state.fold_attempts(success), state.fold_attempts(failures))
    assert [(r.consecutive_failures, r.status) for r in state.state_of(merged).collect()] == [(0, "healthy")]
    # What can never count again is not carried on.
    assert [r.slice for r in merged.collect()] == [(START - datetime(1970, 1, 1)) // timedelta(hours=1) + 10]


def test_state_reads_the_attempts_once(spark, folder):
    spark.createDataFrame(attempts(1), ATTEMPT).write.parquet(folder + "/a")
    plan = state.source_state(spark.read.parquet(folder + "/a"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_history_carries_columns_of_any_type(spark):
    df = spark.createDataFrame(attempts(6, 50), ATTEMPT).withColumn("context", F.create_map(F.lit("k"), "event_id"))
    assert {r.event_id: r.context for r in state.source_history(df).collect()} == {i: {"k": i} for i in range(50)}


SOURCE = "id bigint, status string, last_scraped_at timestamp, consecutive_failures int, notes string"


def test_current_sources(spark):
    at = lambda m: START + timedelta(minutes=m)
    stored = [(1, "healthy", START, 2, "n"), (2, "degraded", START, 5, None), (3, "paused", START, 0, None), (4, "degraded", START, 4, None), (5, "healthy", None, 0, None), (6, "degraded", START, 3, None), (7, "paused", START, 1, None)]
    facts = [(1, 1, at(1), "failed"), (2, 2, at(1), "ok"), (3, 2, at(2), "failed"), (4, 5, at(1), "failed"), (5, 5, at(2), "rate_limited"), (6, 7, at(1), "failed"), (8, 3, at(4), "ok")]
    resets = spark.createDataFrame([(6, at(3))], "source_id bigint, reset_at timestamp")
    out = state.current_sources(spark.createDataFrame(stored, SOURCE), spark.createDataFrame(facts, ATTEMPT), resets)
    assert out.columns == ["id", "status", "last_scraped_at", "consecutive_failures", "notes"]
    assert {r.id: tuple(r)[1:4] for r in out.collect()} == {
        1: ("degraded", START, 3), 2: ("healthy", at(1), 1), 3: ("healthy", at(4), 0), 4: ("degraded", START, 4), 5: ("healthy", at(2), 0), 6: ("healthy", None, 0), 7: ("paused", START, 2),
    }


@pytest.mark.parametrize("cut", [0, 1, 150, 399])
def test_folds_merge(spark, cut):
    rows = attempts(5)
    whole = state.source_state(spark.createDataFrame(rows, ATTEMPT)).collect()
    a = state.fold_attempts(spark.createDataFrame(rows[:cut], ATTEMPT))
    b = state.fold_attempts(spark.createDataFrame(rows[cut:], ATTEMPT))
    merged = state.state_of(state.merge_folds(a, b)).collect()
    assert sorted(merged, key=lambda r: r.source_id) == sorted(whole, key=lambda r: r.source_id)


def test_third_failure_degrades(spark):
    rows = [(i, s, START + timedelta(minutes=i), "failed") for s, n in ((1, 2), (2, 3)) for i in range(n)]
    got = {r.source_id: (r.status, r.degraded_since) for r in state.source_state(spark.createDataFrame(rows, ATTEMPT)).collect()}
    assert got == {1: ("healthy", None), 2: ("degraded", START + timedelta(minutes=2))}
    degraded = state.source_state(spark.createDataFrame(rows, ATTEMPT))
    on_time = START + timedelta(minutes=2, hours=24)
    assert state.stale_degraded(degraded, on_time).count() == 0
    assert state.stale_degraded(degraded, on_time + timedelta(microseconds=1)).count() == 1


def test_latest_transition_counts(spark):
    leads = spark.createDataFrame([("a", "new"), ("b", "new"), ("c", "new")], "id string, status string")
    moves = [("a", "drafted", START, 1), ("a", "sent", START, 2), ("a", "approved", START - timedelta(1), 9), ("b", "lost", START, 1)]
    out = state.apply_transitions(leads, spark.createDataFrame(moves, "id string, status string, at timestamp, seq bigint"))
    assert {r.id: r.status for r in out.collect()} == {"a": "sent", "b": "lost", "c": "new"}


def test_reviews(spark):
    statuses = ["pending_review"] * 4 + ["sent", "drafting"]
    drafts = spark.createDataFrame([(i, s, None, None) for i, s in enumerate(statuses)], "id int, status string, rejection_reason string, reviewed_at timestamp")
    said = [(0, "approved", None, START), (1, "skip", "tone", START), (2, "hm", None, START), (1, "later", None, START + timedelta(1)), (4, "approved", None, START), (5, "skip", "x", START)]
    out = state.apply_reviews(drafts, spark.createDataFrame(said, "id int, decision string, reason string, at timestamp"))
    assert {r.id: (r.status, r.rejection_reason, r.reviewed_at) for r in out.collect()} == {
        0: ("approved", None, START), 1: ("rejected", "tone", START), 2: ("pending_review", None, None), 3: ("pending_review", None, None),
        4: ("sent", None, None), 5: ("drafting", None, None),
    }


def beats(spark, seconds):
    rows = [(i, "w", START + timedelta(seconds=s)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "id bigint, instance_id string, beat_at timestamp")


def test_outage_is_longer_than_the_gap(spark):
    got = spans.outages(beats(spark, [0, 300, 600.000001, 601, 5000])).collect()
    assert sorted(r.gap_s for r in got) == [300.000001, 4399.0]


def test_stale_beat_starts_a_session(spark):
    got = spans.live_sessions(beats(spark, [0, 89.999999, 179.999998, 269.999998, 300, 500])).collect()
    assert sorted(r.beats for r in got) == [1, 2, 3]


@pytest.mark.parametrize("slice_s", [600, 3_600, 86_400])
def test_slices_are_stitched(spark, slice_s):
    """Sessions and outages that cross slices, empty slices and the year 1970 come out whole, whatever the width."""
    rng = random.Random(slice_s % 7)
    rows, n = [], 0
    for instance, start in (("a", START), ("b", START + timedelta(seconds=17)), ("c", datetime(1969, 12, 31, 20))):
        at = start
        for _ in range(700):
            at += timedelta(seconds=rng.choice([1, 30, 60, 89, 90, 91, 299, 300, 301, 4_000, 90_000, 9_000_000][: rng.choice([4, 9, 12])]))
            rows.append((n, instance, at))
            n += 1
    df = spark.createDataFrame(rows, "id bigint, instance_id string, beat_at timestamp")
    pauses, sessions = set(), []
    for before, now in zip([None, *rows], rows):
        gap = None if before is None or before[1] != now[1] else (now[2] - before[2]).total_seconds()
        if gap is None or gap >= 90:
            sessions.append([now[1], now[2], now[2], 0])
        sessions[-1][2:] = [now[2], sessions[-1][3] + 1]
        if gap is not None and gap > 300:
            pauses.add((now[1], before[2], now[2], gap))
    assert {tuple(r) for r in spans.outages(df, slice_s=slice_s).collect()} == pauses
    assert sorted(tuple(r) for r in spans.live_sessions(df, slice_s=slice_s).collect()) == sorted(map(tuple, sessions))


def test_no_window_over_a_whole_instance(spark):
    import re

    for df in (spans.outages(beats(spark, [0])), spans.live_sessions(beats(spark, [0]))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        keys = re.findall(r"\[(instance_id#[^\]]*)\]", plan.replace(", ", ","))
        assert "Window" in plan and not any(k.split(",")[0] == k for k in keys)


def test_budget_slides_over_slices(spark):
    rng = random.Random(7)
    seconds = sorted(rng.randrange(0, 4000) for _ in range(900))
    rows = [("reddit" if i % 3 else "twitter", START + timedelta(seconds=s, microseconds=i)) for i, s in enumerate(seconds)]
    limits = {"reddit": (9, 60), "twitter": (70, 900)}
    df = spark.createDataFrame(rows, "platform string, requested_at timestamp")
    base = int((START - datetime(1970, 1, 1)).total_seconds())
    for width in (900, 86_400):
        got = {(r.platform, r.second - base): (r.requests, r.in_span, r.over_budget) for r in spans.rate_budget(df, limits, width).collect()}
        want = {}
        for platform, (n, span) in limits.items():
            mine = [s for (p, _), s in zip(rows, seconds) if p == platform]
            for s in set(mine):
                held = sum(s - span < x <= s for x in mine)
                want[(platform, s)] = (mine.count(s), held, held > n)
        assert got == want


def test_adopts_only_old_posts_and_drafts_with_text(spark):
    now = START + timedelta(hours=1)
    posts = [("r", "1", now - timedelta(minutes=30)), ("r", "2", now - timedelta(minutes=31)), ("r", "3", now - timedelta(minutes=31))]
    log = spark.createDataFrame([("r", "3", "scored", now)], "platform string, external_id string, event string, at timestamp")
    drafts = [(1, "drafting", "x", now), (2, "drafting", " ", now), (3, "sent", "x", now), (4, "drafting", None, now)]
    waiting, resumed = state.adopt_unfinished(
        spark.createDataFrame(posts, "platform string, external_id string, scraped_at timestamp"), log,
        spark.createDataFrame(drafts, "id int, status string, body string, drafted_at timestamp"), now,
    )
    assert [r.external_id for r in waiting.collect()] == ["2"]
    assert [(r.id, r.status) for r in resumed.collect()] == [(1, "pending_review")]
