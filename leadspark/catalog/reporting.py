"""Queues and reports."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from leadspark import schemas as S
from leadspark.catalog.registry import AS_OF, holds, joined, query
from leadspark.functions import text as X
from leadspark.functions.times import time_ago
from leadspark.operators import drafting, filters, joins, matching, scoring
from leadspark.plans import queues, reports
from leadspark.sources import adapters as A, watchlist as watch

_LEAD = "id, platform, external_id, author, score, status, scored_at"
_LEAD_COLUMNS = [c.strip() for c in _LEAD.split(",")]


@query("funnel_7d", "posts leads drafts", """
select (select count(*) from posts where scraped_at > {now} - interval '7' day) scraped_7d,
  (select count(*) from leads where scored_at > {now} - interval '7' day) scored_7d,
  (select count(*) from leads where scored_at > {now} - interval '7' day and score >= 75) qualified_7d,
  (select count(*) from drafts where drafted_at > {now} - interval '7' day) drafted_7d,
  (select count(*) from drafts where status = 'approved' and reviewed_at > {now} - interval '7' day) approved_7d,
  (select count(*) from drafts where status = 'sent' and reviewed_at > {now} - interval '7' day) sent_7d,
  (select count(*) from leads where status = 'responded' and scored_at > {now} - interval '7' day) responded_7d,
  (select count(*) from leads where status = 'converted' and scored_at > {now} - interval '7' day) converted_7d""")
def funnel_7d(spark, sf):
    return reports.funnel(A.posts(spark, sf), A.leads(spark, sf), A.drafts(spark, sf), AS_OF)


def _score_log(spark, sf):
    """Posts marked processed were scored; every fifth of them was requeued later."""
    done = A.posts(spark, sf).filter("processed")
    at = F.col("scraped_at") + F.expr("interval '30' minute")
    events = F.when(F.col("id") % 5 == 0, F.array(F.lit("scored"), F.lit("requeued"))).otherwise(F.array(F.lit("scored")))
    log = done.select("platform", "external_id", at.alias("at"), F.posexplode(events).alias("n", "event"))
    return log.select("platform", "external_id", "event", (F.col("at") + F.make_dt_interval(mins=F.col("n"))).alias("at"))


@query("score_batch", "posts", """
select platform, external_id, author, scraped_at from posts where not (processed and id % 5 <> 0)
order by scraped_at, platform, external_id limit 25""")
def score_batch(spark, sf):
    batch = queues.score_batch(A.posts(spark, sf), _score_log(spark, sf))
    return batch.select("platform", "external_id", "author", "scraped_at")


@query("score_backlog", "posts", """
select platform, external_id, scraped_at from posts where not (processed and id % 5 <> 0)""")
def score_backlog(spark, sf):
    return queues.score_batch(A.posts(spark, sf), _score_log(spark, sf), n=None).select("platform", "external_id", "scraped_at")


@query("unprocessed", "posts", "select platform, external_id from posts where not (processed and id % 5 <> 0)")
def unprocessed(spark, sf):
    return filters.unprocessed(A.posts(spark, sf), _score_log(spark, sf)).select("platform", "external_id")


@query("draft_queue", "posts leads", f"""
select {_LEAD}, title, body, url from leads join (select id, title, body, url from posts) p using (id)
where status = 'new' and score >= 75 order by score desc, platform, external_id limit 10""")
def draft_queue(spark, sf):
    return queues.draft_queue(A.leads(spark, sf), A.posts(spark, sf)).select(*_LEAD_COLUMNS, "title", "body", "url")


@query("digest_leads", "posts leads", f"""
select {_LEAD}, title, url from leads join (select id, title, url from posts) p using (id)
where scored_at > {{now}} - interval '6' hour and score >= 85 order by score desc, platform, external_id limit 5""")
def digest_leads(spark, sf):
    return queues.digest_leads(A.leads(spark, sf), A.posts(spark, sf), AS_OF).select(*_LEAD_COLUMNS, "title", "url")


@query("recent_leads", "posts leads", f"""
select {_LEAD}, title, url from leads join (select id, title, url from posts) p using (id)
where scored_at > {{now}} - interval '7' day
order by score desc, scored_at desc, platform, external_id limit 50""")
def recent_leads(spark, sf):
    return queues.recent_leads(A.leads(spark, sf), A.posts(spark, sf), AS_OF).select(*_LEAD_COLUMNS, "title", "url")


@query("recent_beats", "heartbeats", "select id, instance_id, beat_at, status from heartbeats order by beat_at desc, id limit 20")
def recent_beats(spark, sf):
    return queues.recent_beats(A.heartbeats(spark, sf)).select("id", "instance_id", "beat_at", "status")


@query("tail_errors", "logs", """
select id, level, code, context, occurred_at from logs where level in ('error', 'fatal', 'warn')
order by occurred_at desc, id limit 20""")
def tail_errors(spark, sf):
    return queues.tail_errors(A.logs(spark, sf))


@query("errors_only", "logs", "select id, level, code, occurred_at from logs where level in ('error', 'fatal')")
def errors_only(spark, sf):
    return filters.errors_only(A.logs(spark, sf), ["error", "fatal"]).select("id", "level", "code", "occurred_at")


@query("errors_by_level", "logs", """
select 'last 5 min' span, (select count(*) from logs where level = 'fatal' and occurred_at > {now} - interval '5' minute) n
union all
select 'last 1 h', (select count(*) from logs where level in ('error', 'fatal') and occurred_at > {now} - interval '1' hour)
union all
select 'last 1 d', (select count(*) from logs where level in ('error', 'fatal') and occurred_at > {now} - interval '1' day)""")
def errors_by_level(spark, sf):
    logs = A.logs(spark, sf)

    def part(span, levels, window):
        return reports.recent_level_count(logs, levels, AS_OF, window).withColumn("span", F.lit(span))

    return (
        part("last 5 min", ["fatal"], timedelta(minutes=5))
        .unionByName(part("last 1 h", ["error", "fatal"], timedelta(hours=1)))
        .unionByName(part("last 1 d", ["error", "fatal"], timedelta(days=1)))
    )


@query("rate_limit_list", "rate_limits", "select platform, resets_at from rate_limits")
def rate_limit_list(spark, sf):
    return queues.rate_limit_list(A.rate_limits(spark, sf))


@query("active_rate_limits", "rate_limits", "select platform, resets_at from rate_limits where resets_at > {now}")
def active_rate_limits(spark, sf):
    return queues.active_rate_limits(A.rate_limits(spark, sf), AS_OF)


@query("source_status", "sources", "select status, count(*) n from sources group by status")
def source_status(spark, sf):
    return reports.status_counts(A.sources(spark, sf))


@query("heartbeat_age", "heartbeats", """
select instance_id, max(beat_at) last_beat_at,
  cast(epoch_us({now}) - epoch_us(max(beat_at)) as double) / 1000000 seconds_ago
from heartbeats group by instance_id""")
def heartbeat_age(spark, sf):
    return reports.heartbeat_age(A.heartbeats(spark, sf), AS_OF, per_instance=True)


_READY_SQL = """
with b as (select cast(epoch_us({at}) - epoch_us(max(beat_at)) as double) / 1000000 s from heartbeats),
f as (select count(*) n from logs where level = 'fatal' and occurred_at > {at} - interval '5' minute),
r as (select coalesce(string_agg(platform, ',' order by platform), '') p from rate_limits where resets_at > {at})
select coalesce(s < 90, false) and n = 0 ok, coalesce(s < 90, false) heartbeat_ok, s seconds_ago,
  n = 0 no_fatal_recent, n fatal_count, p active_rate_limits from b, f, r"""


def _readiness(spark, sf, as_of):
    row = reports.readiness(A.heartbeats(spark, sf), A.logs(spark, sf), A.rate_limits(spark, sf), as_of)
    names = F.transform("active_rate_limits", lambda x: x["platform"])
    return row.withColumn("active_rate_limits", F.array_join(names, ","))


@query("readiness", "heartbeats logs rate_limits", "select * from (" + _READY_SQL.replace("{at}", "{now}") + ")")
def readiness(spark, sf):
    return _readiness(spark, sf, AS_OF)


@query("readiness_while_beating", "heartbeats logs rate_limits",
       "select * from (" + _READY_SQL.replace("{at}", "TIMESTAMP '2024-01-30 23:57:12.5'") + ")")
def readiness_while_beating(spark, sf):
    return _readiness(spark, sf, "2024-01-30T23:57:12.500000")


def _health_tables(spark, sf):
    """The eight tables; some lack columns, and drafts lack a required one."""
    orders = A.table(spark, sf, "orders")
    return {
        "heartbeats": A.heartbeats(spark, sf), "logs": A.logs(spark, sf).withColumn("source", F.lit("bot")),
        "rate_limits": A.rate_limits(spark, sf).withColumns({"consecutive_429s": F.lit(1), "updated_at": F.col("resets_at")}),
        "sources": A.sources(spark, sf).withColumns({"consecutive_failures": F.lit(0), "created_at": F.col("last_scraped_at")}),
        "raw_posts": A.posts(spark, sf), "leads": A.leads(spark, sf), "outreach_drafts": A.drafts(spark, sf),
        "sessions": orders.select(
            F.col("o_orderkey").cast("string").alias("id"), F.lit("scrape_cycle").alias("kind"), F.col("o_orderdate").alias("started_at"),
            F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderstatus")).alias("status"),
        ),
    }


def _lacking(table: str, *lacking: str) -> str:
    assert set(lacking) <= set(S.TABLES[table].names)
    return f"select 'table {table}' as \"check\", '{'warned' if lacking else 'passed'}' state, '{'without ' + ', '.join(lacking) if lacking else 'present'}' detail"


_HEALTH_SQL = " union all ".join([
    _lacking("sources", "notes"), _lacking("raw_posts", "source_id", "author_meta", "matched_keywords", "raw"),
    _lacking("leads", "reasoning", "signal_tags", "disqualifiers"), _lacking("outreach_drafts", "channel", "subject", "rationale", "estimated_quality"),
    _lacking("heartbeats", "current_task", "metadata"), _lacking("logs", "message"), _lacking("rate_limits", "reason"), _lacking("sessions", "ended_at", "stats"),
    """
select 'heartbeat', case when s is null then 'warned' when s < 120 then 'passed' else 'failed' end, coalesce(concat(cast(cast(floor(s + 0.5) as bigint) as varchar), 's ago'), 'no heartbeat yet')
  from (select cast(epoch_us({now}) - epoch_us(max(beat_at)) as double) / 1000000 s from heartbeats)
union all select concat('sources ', status), case when status = 'healthy' then 'passed' else 'warned' end, cast(count(*) as varchar) from sources group by status
union all select 'sources degraded for long', case when count(*) = 0 then 'passed' else 'failed' end, cast(count(*) as varchar)
  from sources where status = 'degraded' and (last_scraped_at is null or last_scraped_at < {now} - interval '12' hour)
union all select 'rate limits', 'passed', 'none active' where not exists (select 1 from rate_limits where resets_at > {now})
union all select concat('rate-limited ', platform), 'warned', concat('until ', strftime(resets_at, '%Y-%m-%d %H:%M:%S')) from rate_limits where resets_at > {now}
union all select 'errors in last hour', case when count(*) = 0 then 'passed' else 'warned' end, concat(cast(count(*) as varchar), ' errors')
  from logs where level in ('error', 'fatal') and occurred_at > {now} - interval '1' hour""",
    *(
        f"select 'rows of {name}', case when count(*) = 0 then 'passed' else 'failed' end, concat(cast(count(*) as varchar), ' break a constraint') from {broken}"
        for name, broken in {
            "sources": "sources where last_scraped_at is null", "raw_posts": "posts where false", "leads": "leads where score not between 0 and 100", "outreach_drafts": "drafts",
            "heartbeats": "heartbeats where status is null", "logs": "logs where level is null", "rate_limits": "rate_limits where false", "sessions": "orders where o_orderkey % 50 = 0",
        }.items()
    ),
])


@query("health_report", "posts leads drafts heartbeats logs rate_limits sources", f"""
with c as ({_HEALTH_SQL}), t as (select count(*) filter (state = 'passed') p, count(*) filter (state = 'warned') w, count(*) filter (state = 'failed') f from c)
select * from c union all select 'summary', case when f > 0 then 'failed' when w > 0 then 'warned' else 'passed' end, concat(p, ' passed, ', w, ' warned, ', f, ' failed') from t""")
def health_report(spark, sf):
    return reports.health_report(_health_tables(spark, sf), AS_OF, degraded_hours=12)


@query("daily_stats", "posts leads drafts", """
with e as (
  select cast(scraped_at as date) "day", 1 p, 0 l, 0 q, 0 d from posts
  union all select cast(scored_at as date), 0, 1, case when score >= 75 then 1 else 0 end, 0 from leads
  union all select cast(drafted_at as date), 0, 0, 0, 1 from drafts)
select "day", cast(sum(p) as bigint) posts, cast(sum(l) as bigint) leads, cast(sum(q) as bigint) qualified,
  cast(sum(d) as bigint) drafts from e group by 1""")
def daily_stats(spark, sf):
    return reports.daily_stats(A.posts(spark, sf), A.leads(spark, sf), A.drafts(spark, sf))


@query("digest_summary", "posts leads drafts", """
select (select count(*) from leads where scored_at > {now} - interval '6' hour) new_leads,
  (select count(*) from drafts where status = 'pending_review') pending_drafts""")
def digest_summary(spark, sf):
    return reports.digest_summary(A.leads(spark, sf), A.drafts(spark, sf), AS_OF)


@query("digest_text", "posts leads", """
with t as (select score, platform, external_id, author, title, url
  from leads join (select id, title, url from posts) p using (id)
  where scored_at > {now} - interval '6' hour and score >= 85 order by score desc, platform, external_id limit 5)
select concat('*Lead digest*', chr(10), chr(10), string_agg(concat('🔥 ', cast(score as varchar), ' — ', author, chr(10),
  substring(title, 1, 80), chr(10), url), concat(chr(10), chr(10)) order by score desc, platform, external_id)) as "text"
from t having count(*) > 0""")
def digest_text(spark, sf):
    return reports.digest_text(queues.digest_leads(A.leads(spark, sf), A.posts(spark, sf), AS_OF))


@query("backlog_gate", "drafts", """
select count(*) pending, count(*) <= 50 may_draft from drafts where status = 'pending_review'""")
def backlog_gate(spark, sf):
    return drafting.backlog_gate(A.drafts(spark, sf))


@query("gated_queue", "posts leads drafts", f"""
select {_LEAD} from leads where status = 'new' and score >= 75
  and (select count(*) from drafts where status = 'pending_review') <= 50""")
def gated_queue(spark, sf):
    queue = queues.draft_queue(A.leads(spark, sf), A.posts(spark, sf), n=None)
    return drafting.gate_queue(queue, drafting.backlog_gate(A.drafts(spark, sf))).select(*_LEAD_COLUMNS)


@query("escalations", "posts leads rate_limits", """
select 'lead' kind, concat(platform, '/', external_id) as "key", cast(score as varchar) detail from leads where score >= 85
union all
select 'rate_limit', platform, strftime(resets_at, '%Y-%m-%d %H:%M:%S') from rate_limits
where resets_at > {now} + interval '1' hour""")
def escalations(spark, sf):
    return reports.escalations(A.leads(spark, sf), A.rate_limits(spark, sf), AS_OF)


@query("rejection_reasons", "drafts", """
select coalesce(rejection_reason, '(none given)') reason, count(*) n from drafts where status = 'rejected' group by 1""")
def rejection_reasons(spark, sf):
    return reports.rejection_reasons(A.drafts(spark, sf))


_NAMES = ("of the", "the and", "attion to")


def _mentions_sql() -> str:
    parts = [f"select '{n}' as name, count(*) mentions, max(posted_at) last_posted_at from posts where {holds(n)}" for n in _NAMES]
    return "select * from (" + " union all ".join(parts) + ") where mentions > 0"


@query("mention_counts", "posts", _mentions_sql())
def mention_counts(spark, sf):
    return matching.mention_counts(A.posts(spark, sf), _NAMES)


@query("mention_counts_by_table", "posts", _mentions_sql())
def mention_counts_by_table(spark, sf):
    """By a table of names, on posts of which many share a key and some have none."""
    n = F.col("id") % 50
    posts = A.posts(spark, sf).withColumn("external_id", F.when(n > 4, n.cast("string")))
    names = spark.createDataFrame([(name, i) for i, name in enumerate(_NAMES)], "phrase string, rank int")
    return matching.mention_counts(posts, names)


@query("watchlist", "sources", """
select id, platform, status, last_scraped_at, json_extract_string(config, '$.subreddit') subreddit,
  'of the,the is' keywords, cast(null as varchar) as "query"
from sources where is_active and status <> 'paused' and platform in ('reddit', 'twitter')""")
def watchlist(spark, sf):
    return watch.watchlist(A.sources(spark, sf))


@query("watchlist_healthy", "sources", """
select id, platform, status from sources where is_active and status = 'healthy' and platform in ('reddit', 'twitter')""")
def watchlist_healthy(spark, sf):
    return watch.watchlist(A.sources(spark, sf), skip_degraded=True).select("id", "platform", "status")


@query("skip_rate_limited", "sources rate_limits", """
select id, platform from sources where platform not in (select platform from rate_limits where resets_at > {now})""")
def skip_rate_limited(spark, sf):
    return joins.skip_rate_limited(A.sources(spark, sf), A.rate_limits(spark, sf), AS_OF).select("id", "platform")


@query("leads_with_posts", "posts leads", f"select {_LEAD}, title, body, url from leads join (select id, title, body, url from posts) p using (id)")
def leads_with_posts(spark, sf):
    return joins.leads_with_posts(A.leads(spark, sf), A.posts(spark, sf)).select(*_LEAD_COLUMNS, "title", "body", "url")


@query("style_examples", "drafts", """
select id, status, body, reviewed_at from (select *, row_number() over (partition by status order by reviewed_at desc, id) rn
  from drafts where status in ('approved', 'rejected')) q where rn <= 5""")
def style_examples(spark, sf):
    return drafting.style_examples(A.drafts(spark, sf)).select("id", "status", "body", "reviewed_at")


@query("example_text", "drafts", """
select string_agg(concat(status, ': ', body), chr(10) order by status, id) examples from (
  select *, row_number() over (partition by status order by reviewed_at desc, id) rn
  from drafts where status in ('approved', 'rejected')) q where rn <= 5""")
def example_text(spark, sf):
    return drafting.example_text(A.drafts(spark, sf))


@query("score_bands", "posts leads", """
select id, case when score >= 90 then '90-100' when score >= 75 then '75-89' when score >= 60 then '60-74'
    when score >= 40 then '40-59' when score >= 0 then '0-39' end band,
  case when score >= 90 then 'score-90' when score >= 75 then 'score-75' else 'score-60' end score_class
from leads""")
def score_bands(spark, sf):
    score = F.col("score")
    return A.leads(spark, sf).select("id", X.score_band(score).alias("band"), X.score_class(score).alias("score_class"))


@query("time_ago", "posts", """
select id, case when s < 60 then concat(cast(s as varchar), 's ago') when s < 3600 then concat(cast(s // 60 as varchar), 'm ago')
  when s < 86400 then concat(cast(s // 3600 as varchar), 'h ago') else concat(cast(s // 86400 as varchar), 'd ago') end age
from (select id, cast(epoch({now}) - epoch(posted_at) as bigint) s from posts)""")
def ages(spark, sf):
    return A.posts(spark, sf).select("id", time_ago(F.col("posted_at"), AS_OF).alias("age"))


@query("clip", "posts", """
select id, substring(coalesce(nullif(body, ''), '(no title)'), 1, 70) short, substring(author, 1, 24) who from posts""")
def clip(spark, sf):
    return A.posts(spark, sf).select(
        "id", X.clip(F.col("body"), 70, "(no title)").alias("short"), X.clip(F.col("author"), 24).alias("who")
    )


@query("signal_report", "posts", f"""
with t as (select case when toxic = 1 then 0 else least(100, 60 * quality + (p.id * 31) % 41) end score,
  {holds('of the')} e, {holds('the and')} i from posts p join (select doc_id, quality, toxic from labels) l on p.id = l.doc_id),
u as (select 'explicit_intent' tag, score from t where e union all select 'implicit_pain', score from t where i)
select tag, count(*) n, count(*) filter (where score >= 75) high, avg(score) mean_score from u group by tag""")
def signal_report(spark, sf):
    profile = scoring.Profile(explicit=["of the"], implicit=["the and"], high_engagement=1_000_000)
    tagged = scoring.signal_tags(A.posts(spark, sf), profile, "2034-01-31T00:00:00").select("id", "signal_tags")
    return reports.signal_report(A.leads(spark, sf).join(tagged, "id"))


@query("signal_tags", "posts", f"""
select id, concat_ws(',', case when {holds('of the')} then 'explicit_intent' end, case when {holds('the and')} then 'implicit_pain' end,
  case when engagement_score >= 50 then 'high_engagement' end,
  case when epoch({{now}}) - epoch(posted_at) <= 86400 then 'recent' end) signal_tags from posts""")
def signal_tags(spark, sf):
    profile = scoring.Profile(explicit=["of the"], implicit=["the and"])
    return scoring.signal_tags(A.posts(spark, sf), profile, AS_OF).select("id", joined("signal_tags"))
