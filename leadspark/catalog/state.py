"""State folded from facts, and spans over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.catalog.registry import AS_OF, query
from leadspark.catalog.reporting import _score_log
from leadspark.operators import spans, state
from leadspark.sources import adapters as A

# Failures in a row by plain running counts, for the SQL side.
_HISTORY = """
select event_id, source_id, attempted_at, outcome, cast(sum(failed) over (partition by source_id, run order by attempted_at, event_id) as int) consecutive_failures
from (select *, case when outcome = 'failed' then 1 else 0 end failed,
  sum(case when outcome = 'failed' then 0 else 1 end) over (partition by source_id order by attempted_at, event_id) run from attempts)"""

_FOLD = """
with g as (select source_id, max(attempted_at) filter (where outcome = 'ok') ok_at, max((attempted_at, event_id)) filter (where outcome = 'ok') ok from attempts group by 1),
f as (select a.source_id, attempted_at, row_number() over (partition by a.source_id order by attempted_at, event_id) rn
  from attempts a join g using (source_id) where outcome = 'failed' and (ok is null or (attempted_at, event_id) > ok))
select source_id, ok_at last_scraped_at, cast(coalesce(max(rn), 0) as int) consecutive_failures,
  case when coalesce(max(rn), 0) >= 3 then 'degraded' else 'healthy' end status,
  max(attempted_at) filter (where rn = 3) degraded_since
from g left join f using (source_id) group by source_id, ok_at"""


@query("source_state", "attempts", "select * from (" + _FOLD + ")")
def source_state(spark, sf):
    return state.source_state(A.attempts(spark, sf))


# Customers as sources, with some failures and a status of their own before the attempts.
_SOURCES_SQL = """select c_custkey id, cast(c_custkey % 3 as int) consecutive_failures, case when c_custkey % 5 = 0 then 'paused' when c_custkey % 5 = 1 then 'degraded' else 'healthy' end status,
  case when c_custkey % 2 = 0 then TIMESTAMP '2024-01-01' end last_scraped_at from customer"""


@query("current_sources", "attempts", f"""
with s as ({_SOURCES_SQL}), a as (select * replace (case when event_id % 7 = 0 then 'ok' else 'failed' end as outcome) from attempts),
g as (select source_id, max(attempted_at) filter (where outcome = 'ok') ok_at, max((attempted_at, event_id)) filter (where outcome = 'ok') ok from a group by 1),
n as (select source_id, any_value(ok_at) ok_at, count(*) filter (where outcome = 'failed' and (ok is null or (attempted_at, event_id) > ok)) n from a join g using (source_id) group by 1),
j as (select s.*, n, ok_at, cast(case when ok_at is not null then n else consecutive_failures + coalesce(n, 0) end as int) f from s left join n on source_id = id)
select id, f consecutive_failures, coalesce(ok_at, last_scraped_at) last_scraped_at,
  case when n is null then status when n > 0 and f >= 3 then 'degraded' when ok_at is not null then 'healthy' else status end status from j""")
def current_sources(spark, sf):
    key = F.col("c_custkey")
    sources = A.table(spark, sf, "customer").select(
        key.alias("id"), (key % 3).cast("int").alias("consecutive_failures"),
        F.when(key % 5 == 0, "paused").when(key % 5 == 1, "degraded").otherwise("healthy").alias("status"),
        F.when(key % 2 == 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("last_scraped_at"),
    )
    return state.current_sources(sources, _failing(spark, sf))


@query("source_history", "attempts", f"select *, case when consecutive_failures >= 3 then 'degraded' else 'healthy' end status from ({_HISTORY})")
def source_history(spark, sf):
    return state.source_history(A.attempts(spark, sf))


def _failing(spark, sf):
    """Attempts in which two outcomes in three are failures, so that long failure runs occur."""
    return A.attempts(spark, sf).withColumn("outcome", F.when(F.col("event_id") % 7 == 0, "ok").otherwise("failed"))


@query("stale_degraded", "attempts", "select source_id, degraded_since from (" + _FOLD.replace(
    "with g as", "with a7 as (select * replace (case when event_id % 7 = 0 then 'ok' else 'failed' end as outcome) from attempts), g as"
).replace("from attempts group", "from a7 group").replace("from attempts a join", "from a7 a join") + ") where status = 'degraded' and degraded_since < {now} - interval '24' hour")
def stale_degraded(spark, sf):
    return state.stale_degraded(state.source_state(_failing(spark, sf)), AS_OF).select("source_id", "degraded_since")


@query("reset_degraded", "attempts", "select source_id, {now} reset_at from (" + _FOLD.replace(
    "with g as", "with a7 as (select * replace (case when event_id % 7 = 0 then 'ok' else 'failed' end as outcome) from attempts), g as"
).replace("from attempts group", "from a7 group").replace("from attempts a join", "from a7 a join") + ") where status = 'degraded'")
def reset_degraded(spark, sf):
    return state.reset_degraded(state.source_state(_failing(spark, sf)), AS_OF)


@query("resets_applied", "attempts", """
select source_id, cast(count(*) filter (where outcome = 'failed' and attempted_at > r and attempted_at > coalesce(ok_at, r)) as int) consecutive_failures
from (select *, max(attempted_at) filter (where outcome = 'ok') over (partition by source_id) ok_at,
  TIMESTAMP '2024-01-30 12:00:00' r from (select * replace (case when event_id % 7 = 0 then 'ok' else 'failed' end as outcome) from attempts))
group by source_id""")
def resets_applied(spark, sf):
    attempts = _failing(spark, sf)
    resets = attempts.select("source_id").distinct().withColumn("reset_at", F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))
    return state.source_state(attempts, resets).select("source_id", "consecutive_failures")


@query("apply_transitions", "posts leads", """
with t as (select o_custkey id, case o_orderstatus when 'F' then 'approved' when 'O' then 'sent' else 'lost' end s, o_orderdate "at", o_orderkey seq
  from orders),
m as (select id, arg_max(s, ("at", seq)) s from t group by id)
select l.id, coalesce(m.s, l.status) status from leads l left join m on m.id = l.id""")
def apply_transitions(spark, sf):
    kind = F.col("o_orderstatus")
    moves = A.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.when(kind == "F", "approved").when(kind == "O", "sent").otherwise("lost").alias("status"),
        F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq"),
    )
    return state.apply_transitions(A.leads(spark, sf), moves).select("id", "status")


@query("apply_reviews", "drafts", """
with d as (select o_custkey * 100 + 1 id, case o_orderstatus when 'F' then 'approved' when 'O' then 'skip' else 'later' end decision,
  o_orderpriority reason, o_orderdate "at" from orders),
m as (select id, arg_max(decision, ("at", decision, reason)) decision, arg_max(reason, ("at", decision, reason)) reason, max("at") "at"
  from d where decision <> 'later' group by id)
select r.id, case m.decision when 'skip' then 'rejected' when 'approved' then 'approved' else r.status end status,
  case when m.decision = 'skip' then m.reason else r.rejection_reason end rejection_reason, coalesce(m."at", r.reviewed_at) reviewed_at
from drafts r left join m on m.id = r.id and r.status = 'pending_review'""")
def apply_reviews(spark, sf):
    kind = F.col("o_orderstatus")
    decisions = A.table(spark, sf, "orders").select(
        (F.col("o_custkey") * 100 + 1).alias("id"), F.when(kind == "F", "approved").when(kind == "O", "skip").otherwise("later").alias("decision"),
        F.col("o_orderpriority").alias("reason"), F.col("o_orderdate").alias("at"),
    )
    return state.apply_reviews(A.drafts(spark, sf), decisions).select("id", "status", "rejection_reason", "reviewed_at")


@query("adopt_unscored", "posts", """
select platform, external_id from posts where not (processed and id % 5 <> 0) and scraped_at < {now} - interval '30' minute""")
def adopt_unscored(spark, sf):
    return _adopted(spark, sf)[0].select("platform", "external_id")


@query("adopt_drafts", "drafts", """
select id, 'pending_review' status, {now} as "at", cast(0 as bigint) seq from drafts where status = 'drafting' and length(trim(body)) > 0""")
def adopt_drafts(spark, sf):
    return _adopted(spark, sf)[1]


def _adopted(spark, sf):
    return state.adopt_unfinished(A.posts(spark, sf), _score_log(spark, sf), A.drafts(spark, sf), AS_OF)


_GAP = "cast(epoch_us(beat_at) - epoch_us(last_beat_at) as double) / 1000000"
_LAGGED = "(select *, lag(beat_at) over (partition by instance_id order by beat_at, id) last_beat_at from heartbeats)"


@query("outages", "heartbeats", f"select instance_id, last_beat_at, beat_at recovered_at, {_GAP} gap_s from {_LAGGED} where {_GAP} > 300")
def outages(spark, sf):
    return spans.outages(A.heartbeats(spark, sf))


LIVE_SQL = f"""
select instance_id, min(beat_at) started_at, max(beat_at) last_beat_at, count(*) beats
from (select *, sum(case when last_beat_at is null or {_GAP} >= 90 then 1 else 0 end) over (partition by instance_id order by beat_at, id) s
  from {_LAGGED}) group by instance_id, s"""


@query("live_sessions", "heartbeats", LIVE_SQL)
def live_sessions(spark, sf):
    return spans.live_sessions(A.heartbeats(spark, sf))


@query("rate_budget", "requests", """
with c as (select platform, cast(floor(epoch(requested_at)) as bigint) "second", count(*) requests from requests group by 1, 2),
w as (select *, case platform when 'reddit' then sum(requests) over (partition by platform order by "second" range between 3599 preceding and current row)
  else sum(requests) over (partition by platform order by "second" range between 7199 preceding and current row) end in_span from c)
select platform, "second", requests, cast(in_span as bigint) in_span, in_span > case platform when 'reddit' then 8 else 15 end over_budget from w""")
def rate_budget(spark, sf):
    return spans.rate_budget(A.requests(spark, sf), {"reddit": (8, 3600), "twitter": (15, 7200)})
