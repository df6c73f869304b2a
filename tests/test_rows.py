"""Boundaries of filters, joins, bands and checks on small literal frames."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadspark import schemas as S
from leadspark.functions import replies, text as X
from leadspark.functions.times import time_ago
from leadspark.operators import checks, drafting, filters, joins, keyed, loading, scoring
from leadspark.plans import queues, reports
from leadspark.sources import payloads, tables

NOW = datetime(2024, 1, 31)


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_lookback_keeps_the_cutoff(spark, kind):
    rows = [(1, "2024-01-30 00:00:00"), (2, "2024-01-29 23:59:59.999999"), (3, "2024-01-31 00:00:00"), (4, None)]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("t", F.col("t").cast(kind))
    assert ids(filters.within_lookback(df, "t", NOW)) == [1, 3]


def test_limit_that_resets_now_is_over(spark):
    limits = spark.createDataFrame([("reddit", NOW), ("twitter", NOW + timedelta(microseconds=1))], "platform string, resets_at timestamp_ntz")
    sources = spark.createDataFrame([(1, "reddit"), (2, "twitter"), (3, None)], "id int, platform string")
    assert ids(joins.skip_rate_limited(sources, limits, NOW)) == [1, 3]
    assert ids(queues.active_rate_limits(limits, NOW), "platform") == ["twitter"]


def test_missing_flags_pass(spark):
    rows = [(1, None, None, None), (2, True, False, "a"), (3, False, True, "a"), (4, False, False, "[deleted]"), (5, False, None, "a")]
    df = spark.createDataFrame(rows, "id int, over_18 boolean, stickied boolean, author string")
    assert ids(filters.eligible_listing(df)) == [1, 5]


def test_bot_bounds(spark):
    rows = [(1, 9, 1001), (2, 10, 1001), (3, 9, 1000), (4, None, 1001), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, followers bigint, following bigint")
    assert ids(filters.drop_bot_like(df)) == [2, 3, 5]


def test_reposts(spark):
    rows = [(1, None), (2, [("retweeted", "9")]), (3, [("replied_to", "9")]), (4, [])]
    df = spark.createDataFrame(rows, "id int, referenced_tweets array<struct<type:string,id:string>>")
    assert ids(filters.drop_reposts(df)) == [1, 3, 4]
    assert ids(filters.drop_reposts(df, replies=True)) == [1, 4]
    assert ids(filters.drop_reposts(df, retweets=False)) == [1, 2, 3, 4]


def test_score_bounds(spark):
    scores = [None, 0, 39, 40, 59, 60, 74, 75, 84, 85, 89, 90, 100]
    df = spark.createDataFrame([(s,) for s in scores], "score int")
    assert ids(filters.promote(df), "score") == [60, 74, 75, 84, 85, 89, 90, 100]
    bands = {r[0]: (r[1], r[2]) for r in df.select("score", X.score_band(F.col("score")), X.score_class(F.col("score"))).collect()}
    assert bands[59] == ("40-59", "score-60") and bands[60] == ("60-74", "score-60")
    assert bands[74] == ("60-74", "score-60") and bands[75] == ("75-89", "score-75")
    assert bands[89] == ("75-89", "score-75") and bands[90] == ("90-100", "score-90")


def test_requeue_puts_a_post_back(spark):
    at = lambda m: NOW + timedelta(minutes=m)
    posts = spark.createDataFrame([(i, "reddit", str(i)) for i in range(5)], "id int, platform string, external_id string")
    log = spark.createDataFrame(
        [("reddit", "1", "scored", at(1)), ("reddit", "2", "scored", at(1)), ("reddit", "2", "requeued", at(2)),
         ("reddit", "3", "requeued", at(1)), ("reddit", "3", "scored", at(1)), ("twitter", "4", "scored", at(1))],
        "platform string, external_id string, event string, at timestamp",
    )
    assert ids(filters.unprocessed(posts, log)) == [0, 2, 4]


def test_requeue_is_strict(spark):
    rows = [("reddit", "1", NOW - timedelta(hours=24)), ("reddit", "2", NOW - timedelta(hours=24) + timedelta(microseconds=1))]
    posts = spark.createDataFrame(rows, "platform string, external_id string, scraped_at timestamp_ntz")
    assert ids(loading.requeue_recent(posts, NOW), "external_id") == ["2"]


def test_append_new_is_idempotent_and_first_wins(spark):
    schema = "platform string, external_id string, scraped_at int, body string"
    batch = spark.createDataFrame([("r", "1", 2, "late"), ("r", "1", 1, "first"), ("t", "1", 5, "other"), ("r", "2", 3, "x")], schema)
    held = spark.createDataFrame([("r", "2", 0, "stored")], schema)
    new = keyed.append_new(held, batch)
    assert {(r.platform, r.external_id, r.body) for r in new.collect()} == {("r", "1", "first"), ("t", "1", "other")}
    assert keyed.append_new(held.unionByName(new), batch).count() == 0
    assert keyed.append_new(held.limit(0), held.limit(0)).count() == 0
    stats = loading.cycle_stats(batch, new).first()
    assert (stats.attempted, stats.inserted) == (4, 2)


def test_hot_key_keeps_every_other_row(spark):
    rows = spark.range(200_000).select(
        F.lit("r").alias("platform"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("external_id"),
        F.col("id").alias("scraped_at"),
    )
    out = keyed.append_new(rows.limit(0), rows)
    assert out.count() == 200_000 - 66_667 + 1
    assert out.filter("external_id = 'hot'").first().scraped_at == 0


def test_deep_cap_equals_plain_rank(spark):
    rows = spark.range(6000).select((F.col("id") % 2).alias("g"), F.floor(F.col("id") / 4).alias("v"))
    out = keyed.cap_per_group(rows, ["g"], 1500, [F.col("v").desc()])
    got = {r.g: (r.n, r.low) for r in out.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low")).collect()}
    assert got == {0: (1500, 750), 1: (1500, 750)}


def test_scores_match_on_platform_and_id(spark):
    batch = spark.createDataFrame([("reddit", "1"), ("twitter", "1"), ("reddit", "2")], "platform string, external_id string")
    scored = spark.createDataFrame([("reddit", "1", 50, 1), ("reddit", "1", 70, 2), ("reddit", "9", 90, 1)], "platform string, external_id string, score int, seq int")
    got, queued = joins.attach_scores(batch, scored)
    assert [(r.platform, r.external_id, r.score) for r in got.collect()] == [("reddit", "1", 70)]
    assert {(r.platform, r.external_id) for r in queued.collect()} == {("twitter", "1"), ("reddit", "2")}


def test_blocklist_ignores_missing_authors(spark):
    posts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, author string")
    assert ids(joins.drop_do_not_approach(posts, spark.createDataFrame([("a",), (None,)], "author string"))) == [2, 3]


def test_orphans_skip_null_references(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id int, fk int")
    assert ids(keyed.orphans(child, spark.createDataFrame([(10,)], "pk int"), "fk", "pk")) == [3]


REPLIES = [
    ('```json\n{"score": 78, "signal_tags": ["recent"]}\n```', True, 78.0, ["recent"]),
    ('{"score": 60, "reasoning": "r"}', True, 60.0, []),
    ("no idea", False, None, []),
    ("null", False, None, []),
    ('{"reasoning": "r"}', True, None, []),
    ('{"score": 78.5}', True, 78.5, []),
    ('{"score": 140}', True, 140.0, []),
    ('"78"', True, None, []),
    ('{"score": "78"}', True, 78.0, []),
    ("", False, None, []),
]


def test_scoring_replies(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(REPLIES)], "id int, reply string")
    out = df.select("id", replies.parse_score(F.col("reply")).alias("r"), checks.score_fault(replies.parse_score(F.col("reply"))["score"]).alias("fault")).orderBy("id").collect()
    for row, (text, parsed, score, tags) in zip(out, REPLIES):
        assert (row.r.parsed, row.r.score, row.r.signal_tags) == (parsed, score, tags), text
    assert [r.fault for r in out[5:7]] == ["score_whole", "score_range"]


def test_row_checks(spark):
    rows = [(1, "p", "r", "e", 60, "new", NOW), (2, None, "r", "e", 101, "odd", NOW), (3, "p", "r", "e", None, "lost", NOW)]
    out = checks.check_rows(spark.createDataFrame(rows, "id int, raw_post_id string, platform string, external_id string, score int, status string, scored_at timestamp"), "leads")
    assert {r.id: r.violations for r in out.collect()} == {1: [], 2: ["raw_post_id_missing", "status_unknown", "score_range"], 3: ["score_missing"]}
    good, bad = checks.split_checked(out)
    assert ids(good) == [1] and ids(bad) == [2, 3]


def test_ages(spark):
    seconds = [0, 59, 60, 3599, 3600, 86399, 86400, 200000]
    df = spark.createDataFrame([(s, NOW - timedelta(seconds=s)) for s in seconds], "s int, t timestamp_ntz")
    got = [r[0] for r in df.orderBy("s").select(time_ago(F.col("t"), NOW)).collect()]
    assert got == ["0s ago", "59s ago", "1m ago", "59m ago", "1h ago", "23h ago", "1d ago", "2d ago"]


def test_clip_counts_characters(spark):
    df = spark.createDataFrame([("🔥" * 5,), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(X.clip(F.col("t"), 3, "(no title)")).collect()] == ["🔥🔥🔥", "(no", "(no"]


def test_draft_rules(spark):
    bodies = [
        ("Saw your post on churn. We fixed that. Want a look?", []),
        ("One. Two! Three? Four. Five.", ["too_long"]),
        ("i came across your POST yesterday", ["banned_phrase"]),
        ("nice 🔥", ["emoji"]),
        ("Really? Sure?", ["many_asks"]),
        ("this — that", ["em_dash"]),
        (None, []),
    ]
    df = spark.createDataFrame([(i, b[0]) for i, b in enumerate(bodies)], "id int, body string")
    got = [r.violations for r in drafting.lint_drafts(df).orderBy("id").collect()]
    assert got == [b[1] for b in bodies]


def test_backlog_of_fifty_still_drafts(spark):
    pending = spark.range(51).select(F.lit("pending_review").alias("status"))
    queue = spark.range(3)
    assert drafting.gate_queue(queue, drafting.backlog_gate(pending.limit(50))).count() == 3
    assert drafting.gate_queue(queue, drafting.backlog_gate(pending)).count() == 0


def test_recency_points(spark):
    hours = [0, 5.999, 6, 15, 24, 24.001, 72, 72.001]
    df = spark.createDataFrame([(float(h),) for h in hours], "h double")
    got = [r[0] for r in df.orderBy("h").select(scoring._recency_points(F.col("h"))).collect()]
    assert got == [15.0, 15.0, 15.0, 11.25, 7.5, 7.5, 7.5, 0.0]


def test_rubric(spark):
    profile = scoring.Profile(
        explicit=["looking for"], implicit=["frustrated"], fit={"role": ["founder"], "size": ["solo"]}, exact_pain=["cold outreach"],
        disqualifiers={"job_ad": ["we are hiring"]}, bio_disqualifiers={"competitor": ["Rival"]}, lang="en",
    )
    rows = [
        (1, "Looking for a tool", "cold outreach takes hours", "a", ("solo founder",), "en", NOW - timedelta(hours=1)),
        (2, "frustrated", "so much", "a", (None,), "en", NOW - timedelta(hours=48)),
        (3, "Looking for a tool", "we are hiring", "a", ("x",), "en", NOW),
        (4, "Looking for a tool", "", "a", ("works at rival",), "de", NOW),
        (5, None, None, "[deleted]", None, "en", NOW - timedelta(hours=100)),
    ]
    df = spark.createDataFrame(rows, "id int, title string, body string, author string, author_meta struct<bio:string>, lang string, posted_at timestamp_ntz")
    out = {r.id: r for r in scoring.rubric_score(df, profile, NOW).collect()}
    assert out[1].score == 100 and out[1].disqualifiers == []
    assert out[1].signal_tags == ["explicit_intent", "icp_match", "recent"]
    assert out[2].score == 40 and out[2].signal_tags == ["implicit_pain"]
    assert (out[3].score, out[3].disqualifiers) == (0, ["job_ad"])
    assert (out[4].score, out[4].disqualifiers) == (0, ["language", "competitor"])
    assert out[5].score == 0 and out[5].disqualifiers == []


def test_channels(spark):
    rows = [(1, "reddit", "can you recommend one", None), (2, "reddit", "i hate this", None), (3, "twitter", "x", True), (4, "twitter", "x", None), (5, "hackernews", "x", True)]
    df = spark.createDataFrame(rows, "id int, platform string, body string, open_dms boolean").withColumn("title", F.lit(""))
    assert [r.channel for r in drafting.pick_channel(df).orderBy("id").collect()] == ["reddit_comment", "reddit_dm", "twitter_dm", "twitter_reply", None]


def test_drafts_store_missing_values(spark):
    df = spark.createDataFrame([(1, "reddit_dm", "", "b", "r", 0), (2, "reddit_dm", "s", "b", "r", 5)], "lead_id int, channel string, subject string, body string, rationale string, estimated_quality int")
    got = {r.lead_id: (r.subject, r.estimated_quality, r.status) for r in loading.new_drafts(df, NOW).collect()}
    assert got == {1: (None, None, "pending_review"), 2: ("s", 5, "pending_review")}


def test_empty_tables_give_reports(spark):
    empty = lambda s: spark.createDataFrame([], s)
    row = reports.readiness(empty(S.HEARTBEATS), empty(S.LOGS), empty(S.RATE_LIMITS), NOW).first()
    assert (row.ok, row.seconds_ago, row.fatal_count, row.active_rate_limits) == (False, None, 0, [])
    assert reports.funnel(empty(S.RAW_POSTS), empty(S.LEADS), empty(S.DRAFTS), NOW).first().asDict() == {
        f"{s}_7d": 0 for s in ("scraped", "scored", "qualified", "drafted", "approved", "sent", "responded", "converted")
    }
    tables_ = {n: empty(s) for n, s in S.TABLES.items()}
    report = {r.check: (r.state, r.detail) for r in reports.health_report(tables_, NOW).collect()}
    assert all(report[f"table {n}"] == ("passed", "present") and report[f"rows of {n}"] == ("passed", "0 break a constraint") for n in S.TABLES)
    assert report["heartbeat"] == ("warned", "no heartbeat yet")
    assert report["sources"] == ("warned", "none configured yet") and report["rate limits"] == ("passed", "none active")
    assert report["summary"] == ("warned", "19 passed, 2 warned, 0 failed")
    assert reports.digest_text(empty("score int, author string, title string, url string, platform string, external_id string")).count() == 0


def test_health_of_missing_and_broken_tables(spark):
    none = {r.check: (r.state, r.detail) for r in reports.health_report({}, NOW).collect()}
    assert all(none[f"table {n}"] == ("failed", "missing") for n in S.TABLES) and none["summary"][0] == "failed"
    hour = timedelta(hours=1)
    given = {
        "heartbeats": spark.createDataFrame([("w", NOW - 2 * hour, None)], "instance_id string, beat_at timestamp, status string"),
        "sources": spark.createDataFrame([(1, "degraded", NOW - 25 * hour), (2, "degraded", NOW - 24 * hour), (3, "healthy", None)], "id int, status string, degraded_since timestamp"),
        "logs": spark.createDataFrame([("fatal", "x", NOW - hour / 2)], "level string, source string, occurred_at timestamp"),
    }
    report = {r.check: (r.state, r.detail) for r in reports.health_report(given, NOW).collect()}
    assert report["heartbeat"] == ("failed", "7200s ago") and report["errors in last hour"] == ("warned", "1 errors")
    assert report["sources degraded for long"] == ("failed", "1") and report["sources degraded"] == ("warned", "2")
    assert report["rows of heartbeats"] == ("failed", "1 break a constraint") and report["rows of sources"] == ("failed", "3 break a constraint")
    assert report["rows of logs"][0] == "passed" and report["table logs"] == ("warned", "without id, code, message, context") and "rows of leads" not in report


def test_absent_columns_break_constraints(spark):
    from leadspark.operators.checks import check_rows

    assert check_rows(spark.range(1).selectExpr("id"), "leads").first().violations == [f"{c}_missing" for c in ("raw_post_id", "platform", "external_id", "score", "status", "scored_at")]


def test_bad_pages_and_posts_come_out(spark):
    import json

    posts = [{"id": "a", "created_utc": 1.0}, {"id": "b"}, {"title": "no id"}, {"id": "c", "created_utc": None}]
    good = json.dumps({"data": {"children": [{"data": p} for p in posts]}})
    texts = [good, "broken", "null", "[]", None, '{"error": 403}', '{"data": {"children": []}}']
    raw = spark.createDataFrame([("k", "s1", t) for t in texts], "keyword string, source_id string, payload string")
    got = sorted((r.reason, r.external_id or "", r.detail or "") for r in payloads.bad_listing(raw).collect())
    assert got == sorted(
        [("bad_date", "b", ""), ("bad_date", "c", ""), ("post_without_id", "", '{"title":"no id"}'), ("no_posts", "", '{"error": 403}')]
        + [("unreadable_page", "", t) for t in ("broken", "null", "[]", "")]
    )
    kept = payloads.normalize_listing(raw, datetime(1970, 1, 1))
    assert [(r.external_id, r.source_id, json.loads(r.raw)["id"]) for r in kept.collect()] == [("t3_a", "s1", "a")]
    tweets = [{"id": "1", "author_id": "u"}, {"id": "2", "author_id": "v", "created_at": "2024-01-01T00:00:00Z"}, {"id": "3", "author_id": "u", "created_at": "2024-01-01T00:00:00Z"}, {"author_id": "u"}]
    pages = [json.dumps({"data": tweets, "includes": {"users": [{"id": "u", "username": "n"}]}}), json.dumps({"data": tweets[1:2]}), "{", '{"meta": {}}']
    raw = spark.createDataFrame([("q", t) for t in pages], "query string, payload string")
    got = sorted((r.reason, r.external_id or "", r.detail) for r in payloads.bad_search(raw).collect())
    assert got == [
        ("bad_date", "1", ""), ("no_posts", "", '{"meta": {}}'), ("post_without_id", "", '{"author_id":"u"}'),
        ("unknown_author", "2", "v"), ("unknown_author", "2", "v"), ("unreadable_page", "", "{"),
    ]
    assert [r.external_id for r in payloads.search_records(raw).filter("posted_at is not null").collect()] == ["3"]


def test_ready_while_beating(spark):
    beat = spark.createDataFrame([(NOW - timedelta(seconds=90),)], "beat_at timestamp")
    logs = spark.createDataFrame([], S.LOGS)
    limits = spark.createDataFrame([], S.RATE_LIMITS)
    assert not reports.readiness(beat, logs, limits, NOW).first().ok
    assert reports.readiness(beat, logs, limits, NOW - timedelta(microseconds=1)).first().ok


def test_digest_text(spark):
    top = spark.createDataFrame([(90, "a", "T" * 90, "u1", "reddit", "2"), (95, None, None, "u2", "reddit", "1")], "score int, author string, title string, url string, platform string, external_id string")
    assert reports.digest_text(top).first().text == "*Lead digest*\n\n🔥 95 — \n\nu2\n\n🔥 90 — a\n" + "T" * 80 + "\nu1"


def test_listing_payload(spark):
    cutoff = int((NOW - timedelta(hours=24) - datetime(1970, 1, 1)).total_seconds())

    def post(i, **kw):
        return {"data": {"id": i, "subreddit": "SaaS", "author": "foo", "title": "t", "permalink": f"/r/{i}", "created_utc": cutoff, "score": 4, "num_comments": 2, **kw}}

    import json

    page = json.dumps({"data": {"children": [post("a"), post("b", over_18=True), post("c", stickied=True), post("d", author="[deleted]"), post("e", created_utc=cutoff - 1), post("f", selftext="body")]}})
    raw = spark.createDataFrame([("looking for tool", page), ("x", "{}"), ("y", "broken")], "keyword string, payload string")
    out = {r.external_id: r for r in payloads.normalize_listing(raw, NOW).collect()}
    assert set(out) == {"t3_a", "t3_f"}
    assert (out["t3_a"].body, out["t3_f"].body, out["t3_a"].url) == ("", "body", "https://reddit.com/r/a")
    assert out["t3_a"].engagement == {"score": 4, "comments": 2} and out["t3_a"].matched_keywords == ["looking for tool"]


def test_search_payload(spark):
    import json

    at = (NOW - timedelta(hours=1)).isoformat() + ".000Z"
    user = lambda i, name, a, b: {"id": i, "username": name, "public_metrics": {"followers_count": a, "following_count": b}}
    page = json.dumps({
        "data": [{"id": "1", "author_id": "u1", "text": "hi", "created_at": at}, {"id": "2", "author_id": "u2", "text": "bot", "created_at": at},
                 {"id": "3", "author_id": "u9", "text": "unknown", "created_at": at}],
        "includes": {"users": [user("u1", "old", 50, 5), user("u2", "bot", 9, 1001), user("u1", "new", 60, 5)]},
    })
    raw = spark.createDataFrame([("q", page), ("q", "{}"), ("q", json.dumps({"data": [{"id": "7", "author_id": "u1"}]}))], "query string, payload string")
    out = payloads.normalize_search(raw, NOW).collect()
    assert [(r.external_id, r.author, r.author_meta.followers, r.url) for r in out] == [("1", "@new", 60, "https://x.com/new/status/1")]
    assert out[0].engagement == {"likes": 0, "replies": 0, "retweets": 0} and out[0].author_meta.bio == ""


def test_records(spark, folder):
    lines = ['{"source":"reddit","external_id":"1","engagement":{"score":2}}', "", "null", "0", '"x"', "[1]", "{broken", '{"external_id":"2"}']
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{folder}/lines")
    good, bad = tables.read_records(spark, f"{folder}/lines")
    assert ids(good, "external_id") == ["1", "2"]
    assert ids(bad, "line") == sorted(["null", "0", '"x"', "[1]", "{broken"])


def test_written_scores_read_back(spark, folder):
    df = spark.createDataFrame([("reddit", "1", 60, "r", None, ["bot"])], "platform string, external_id string, score int, reasoning string, signal_tags array<string>, disqualifiers array<string>")
    loading.write_scored(df, f"{folder}/scored")
    row = spark.read.json(f"{folder}/scored").first()
    assert (row.source, row.external_id, row.score, row.signal_tags, row.disqualifiers) == ("reddit", "1", 60, [], ["bot"])


def test_tables_keep_their_schema(spark, folder):
    for name, schema in S.TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
        assert tables.read_table(spark, folder, name).schema == schema


def test_tables_are_stored_by_day(spark, folder):
    rows = spark.createDataFrame([(str(i), NOW - timedelta(hours=13 * i), i) for i in range(20)], "id string, scored_at timestamp, extra int").withColumn("score", F.lit(61.0))
    for part in (rows.filter("extra < 10"), rows.filter("extra >= 10")):
        tables.write_table(part, folder, "leads")
    everything = tables.read_table(spark, folder, "leads")
    assert everything.schema == S.LEADS and everything.count() == 20
    since = NOW - timedelta(hours=30)
    recent = tables.read_table(spark, folder, "leads", since)
    assert recent.schema == S.LEADS and ids(recent) == ["0", "1", "2"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.f.split("day=")[1][:10] for r in recent.select(F.input_file_name().alias("f")).collect()} == {str((NOW - timedelta(hours=13 * i)).date()) for i in range(3)}
    tables.write_table(spark.createDataFrame([("reddit",)], "platform string"), folder, "rate_limits")
    assert tables.read_table(spark, folder, "rate_limits").first().platform == "reddit"


def test_seed(spark):
    seed = spark.range(2)
    assert loading.seed_if_empty(spark.range(0), seed).count() == 2
    assert loading.seed_if_empty(spark.range(1), seed).count() == 0
