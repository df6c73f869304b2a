"""Streams run over what is there; their result equals the batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadspark.catalog.collecting import _KEPT, _KEYS, _ORDER, _first_sql
from leadspark.catalog.registry import AS_OF, holds, joined, ntz, query
from leadspark.catalog.scoring import PROFILE, _SCORED
from leadspark.catalog.state import _FOLD, LIVE_SQL
from leadspark.operators import scoring, state
from leadspark.session import shared_folder
from leadspark.sources import adapters as A, tables
from leadspark.streaming import streams


class _Landed:
    """Stands for the session in the adapters: the named tables are streams of their files, others are read."""

    def __init__(self, spark, *streamed):
        self.spark, self.streamed, self.read = spark, streamed, self

    def parquet(self, path):
        stored = self.spark.read.parquet(path)
        if not path.endswith(tuple(f"/{name}.parquet" for name in self.streamed)):
            return stored
        return tables.stream_records(self.spark, path + "*", stored.schema, format="parquet")


@query("stream_records", "posts", "select external_id, title, body from posts")
def stream_records(spark, sf):
    out = shared_folder(spark)
    A.posts(spark, sf).select("external_id", "title", "body").write.json(f"{out}/landed")
    src = tables.stream_records(spark, f"{out}/landed", max_files=4).select("external_id", "title", "body")
    streams.run_available(src.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state"))
    return spark.read.parquet(f"{out}/rows")


@query("ingest_stream", "", _first_sql())
def ingest_stream(spark, sf):
    out = shared_folder(spark)
    src = A.arrivals(_Landed(spark, "lineitem"), sf)
    streams.run_available(streams.ingest_stream(src, f"{out}/rows", f"{out}/state", _KEYS, _ORDER))
    return spark.read.parquet(f"{out}/rows").select(*_KEPT)


@query("dedup_stream", "", "select distinct l_orderkey, l_linenumber from lineitem")
def dedup_stream(spark, sf):
    out = shared_folder(spark)
    src = streams.dedup_stream(A.arrivals(_Landed(spark, "lineitem"), sf), "l_shipdate", "3650 days", _KEYS)
    writer = src.select(*_KEYS).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
    streams.run_available(writer)
    return spark.read.parquet(f"{out}/rows")


@query("score_stream", "posts", f"select external_id, score, signal_tags from ({_SCORED})")
def score_stream(spark, sf):
    out = shared_folder(spark)
    src = A.posts(_Landed(spark, "documents"), sf)
    streams.run_available(streams.score_stream(src, lambda p: scoring.rubric_score(p, PROFILE, AS_OF), f"{out}/rows", f"{out}/state"))
    return spark.read.parquet(f"{out}/rows").select("external_id", "score", joined("signal_tags"))


@query("hot_stream", "posts", f"""
select external_id, case when {holds('of the')} or {holds('attion to')} then 'hot' else 'batch' end branch from posts""")
def hot_stream(spark, sf):
    out = shared_folder(spark)
    for branch, name in enumerate(("hot", "batch")):
        src = streams.hot_stream(A.posts(_Landed(spark, "documents"), sf), ["of the", "attion to"])[branch].select("external_id", F.lit(name).alias("branch"))
        streams.run_available(src.writeStream.format("parquet").option("path", f"{out}/{name}").option("checkpointLocation", f"{out}/{name}-state"))
    return spark.read.parquet(f"{out}/hot").unionByName(spark.read.parquet(f"{out}/batch"))


@query("lookback_stream", "posts", "select external_id, posted_at from posts where posted_at >= {now} - interval '24' hour")
def lookback_stream(spark, sf):
    out = shared_folder(spark)
    src = streams.lookback_stream(A.posts(_Landed(spark, "documents"), sf), "posted_at", AS_OF).select("external_id", ntz("posted_at"))
    streams.run_available(src.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state"))
    return spark.read.parquet(f"{out}/rows")


_STAGES_SQL = """
with e as (select 'scraped' stage, scraped_at as "at" from posts
  union all select 'scored', scored_at from leads union all select 'qualified', scored_at from leads where score >= 75
  union all select status, scored_at from leads where status in ('responded', 'converted')
  union all select 'drafted', drafted_at from drafts
  union all select status, reviewed_at from drafts where status in ('approved', 'sent'))"""


def _streamed_funnel(spark, sf, **spans):
    out = shared_folder(spark)
    landed = _Landed(spark, "documents", "conversations")
    counts = streams.funnel_stream(A.posts(landed, sf), A.leads(landed, sf), A.drafts(landed, sf), late="365 days", **spans)
    keys = ["starts_at", "stage"]
    streams.run_available(streams.upsert_by_batch(counts, f"{out}/rows", f"{out}/state", keys))
    return streams.latest_rows(spark, f"{out}/rows", keys).select(ntz("starts_at"), "stage", "n")


@query("funnel_stream", "posts leads drafts", "select * from (" + _STAGES_SQL + """
select date_trunc('day', "at") starts_at, stage, count(*) n from e group by 1, 2)""")
def funnel_stream(spark, sf):
    return _streamed_funnel(spark, sf)


@query("funnel_stream_7d", "posts leads drafts", "select * from (" + _STAGES_SQL + """
select date_trunc('day', "at") - d * interval '1' day starts_at, stage, count(*) n from e, range(7) r(d) group by 1, 2)""")
def funnel_stream_7d(spark, sf):
    return _streamed_funnel(spark, sf, window="7 days", slide="1 day")


@query("liveness_stream", "heartbeats", f"""
select * from ({LIVE_SQL}) where epoch_us(last_beat_at) + 89999999 <= (select epoch_us(max(beat_at)) // 1000 * 1000 - 90000000 from heartbeats)""")
def liveness_stream(spark, sf):
    out = shared_folder(spark)
    src = streams.liveness_stream(A.heartbeats(_Landed(spark, "events"), sf))
    streams.run_available(src.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state"))
    rows = spark.read.parquet(f"{out}/rows")
    return rows.select("instance_id", ntz("started_at"), ntz("last_beat_at"), "beats")


@query("failure_stream", "attempts", "select * from (" + _FOLD + ")")
def failure_stream(spark, sf):
    out = shared_folder(spark)
    streams.run_available(streams.failure_stream(A.attempts(_Landed(spark, "events"), sf), f"{out}/folds", f"{out}/state"))
    return state.state_of(streams.newest_fold(spark, f"{out}/folds"))


def _by_batches(spark, parts, order, writer, *frames):
    """Land the rows of each part one after the other, and let the stream take them as a batch of its own each time."""
    folders = [f"{shared_folder(spark)}/landed" for _ in frames]
    for i in range(parts):
        sources = []
        for frame, folder in zip(frames, folders):
            frame.filter(order == i).write.mode("append").parquet(folder)
            sources.append(tables.stream_records(spark, folder, frame.schema, format="parquet"))
        streams.run_available(writer(*sources))


@query("failure_stream_late", "attempts", "select * from (" + _FOLD + ")")
def failure_stream_late(spark, sf):
    """Four batches, the latest attempts first, with a snapshot after every second."""
    out = shared_folder(spark)
    newest_first = 3 - F.floor(F.dayofyear("attempted_at") / 8) % 4
    _by_batches(spark, 4, newest_first, lambda src: streams.failure_stream(src, f"{out}/folds", f"{out}/state", every=2), A.attempts(spark, sf))
    return state.state_of(streams.newest_fold(spark, f"{out}/folds"))


@query("funnel_stream_batches", "posts leads drafts", "select * from (" + _STAGES_SQL + """
select date_trunc('day', "at") starts_at, stage, count(*) n from e group by 1, 2)""")
def funnel_stream_batches(spark, sf):
    """The funnel over several batches of each table, with a snapshot after every second."""
    out, keys = shared_folder(spark), ["starts_at", "stage"]
    writer = lambda *src: streams.upsert_by_batch(streams.funnel_stream(*src, late="365 days"), f"{out}/rows", f"{out}/state", keys, every=2)
    _by_batches(spark, 3, F.pmod(F.col("id"), F.lit(3)), writer, A.posts(spark, sf), A.leads(spark, sf), A.drafts(spark, sf))
    return streams.latest_rows(spark, f"{out}/rows", keys).select(ntz("starts_at"), "stage", "n")


@query("ingest_stream_batches", "", _first_sql())
def ingest_stream_batches(spark, sf):
    """Three batches, the earliest rows first."""
    out = shared_folder(spark)
    arrivals = A.arrivals(spark, sf)
    part = F.when(F.year("l_shipdate") < 1996, 0).when(F.year("l_shipdate") < 1999, 1).otherwise(2)
    _by_batches(spark, 3, part, lambda src: streams.ingest_stream(src, f"{out}/rows", f"{out}/state", _KEYS, _ORDER), arrivals)
    return spark.read.parquet(f"{out}/rows").select(*_KEPT)


@query("lookback_stream_moving", "posts", """
with b as (select external_id, posted_at, id % 3 batch from posts), m as (select batch, max(posted_at) clock from b group by 1),
c as (select a.batch, max(z.clock) clock from m a join m z on z.batch <= a.batch group by 1)
select external_id, posted_at, cast(batch as int) batch from b join c using (batch) where posted_at >= clock - interval '24' hour""")
def lookback_stream_moving(spark, sf):
    """Three batches, each with a clock of its own."""
    out = shared_folder(spark)
    posts = A.posts(spark, sf).select("id", "external_id", "posted_at")
    _by_batches(spark, 3, F.pmod(F.col("id"), F.lit(3)), lambda src: streams.moving_lookback(src, "posted_at", out, f"{out}/state"), posts)
    return streams.fresh_rows(spark, out).select("external_id", "posted_at", "batch")


@query("dedup_stream_batches", "", "select distinct l_orderkey, l_linenumber from lineitem")
def dedup_stream_batches(spark, sf):
    """Four batches; the repeats of a key come by different ones."""
    out = shared_folder(spark)

    def writer(src):
        rows = streams.dedup_stream(src, "l_shipdate", "3650 days", _KEYS).select(*_KEYS)
        return rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")

    _by_batches(spark, 4, F.pmod(F.col("l_partkey"), F.lit(4)), writer, A.arrivals(spark, sf))
    return spark.read.parquet(f"{out}/rows")


@query("score_stream_batches", "posts", f"select external_id, score, signal_tags from ({_SCORED})")
def score_stream_batches(spark, sf):
    out = shared_folder(spark)
    scorer = lambda p: scoring.rubric_score(p, PROFILE, AS_OF)
    _by_batches(spark, 3, F.pmod(F.col("id"), F.lit(3)), lambda src: streams.score_stream(src, scorer, f"{out}/rows", f"{out}/state"), A.posts(spark, sf))
    return spark.read.parquet(f"{out}/rows").select("external_id", "score", joined("signal_tags"))


@query("liveness_stream_batches", "heartbeats", f"""
select * from ({LIVE_SQL}) where epoch_us(last_beat_at) + 89999999 <= (select epoch_us(max(beat_at)) // 1000 * 1000 - 90000000 from heartbeats)""")
def liveness_stream_batches(spark, sf):
    """Three batches, one stretch of time after the other; a session may begin in one and end in the next."""
    out = shared_folder(spark)

    def writer(src):
        return streams.liveness_stream(src).writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")

    day = F.dayofmonth("beat_at")
    _by_batches(spark, 3, F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2), writer, A.heartbeats(spark, sf))
    return spark.read.parquet(f"{out}/rows").select("instance_id", ntz("started_at"), ntz("last_beat_at"), "beats")
