"""Generic test tables seen as the tables of the funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2024-01-31T00:00:00"


def _now() -> Column:
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


def _ago(seconds: Column) -> Column:
    return _now() - F.make_dt_interval(secs=seconds)


def _platform(key: str) -> Column:
    rest = F.col(key) % 4
    return (
        F.when(rest == 0, "reddit").when(rest == 1, "twitter").when(rest == 2, "hackernews").otherwise("indiehackers")
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    age = (F.col("doc_id") * 7919) % 864000
    return d.select(
        F.col("doc_id").alias("id"),
        _platform("doc_id").alias("platform"),
        F.concat(F.lit("t3_"), F.col("doc_id").cast("string")).alias("external_id"),
        F.concat(F.lit("u"), (F.col("doc_id") % 97).cast("string")).alias("author"),
        F.substring("text", 1, 80).alias("title"),
        F.col("text").alias("body"),
        "lang",
        F.concat_ws("/", F.lit("https://example.test"), "source", F.col("doc_id").cast("string")).alias("url"),
        _ago(age).alias("posted_at"),
        (_ago(age) + F.expr("interval '1' hour")).alias("scraped_at"),
        F.create_map(F.lit("score"), F.col("n_chars") % 100).alias("engagement"),
        (F.col("doc_id") % 3 == 0).alias("processed"),
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = posts(spark, sf_dir).select("id", "platform", "external_id", "author", "scraped_at")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    joined = p.join(labels, "id")
    score = F.when(F.col("toxic") == 1, 0).otherwise(F.least(F.lit(100), 60 * F.col("quality") + (F.col("id") * 31) % 41))
    names = ("new", "drafted", "approved", "rejected", "sent", "responded", "converted", "lost")
    status = F.get(F.array(*[F.lit(n) for n in names]), (F.col("id") % 8).cast("int"))
    return joined.select(
        "id",
        F.col("id").alias("raw_post_id"),
        "platform",
        "external_id",
        "author",
        score.cast("int").alias("score"),
        status.alias("status"),
        (F.col("scraped_at") + F.expr("interval '30' minute")).alias("scored_at"),
    )


def drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    state = (F.col("conv_id") + F.col("turn")) % 5
    at = _ago(((F.col("conv_id") * 13 + F.col("turn")) * 3571) % 864000)
    names = ("drafting", "pending_review", "approved", "rejected", "sent")
    return c.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
        F.col("conv_id").alias("lead_id"),
        F.col("text").alias("body"),
        F.get(F.array(*[F.lit(n) for n in names]), state.cast("int")).alias("status"),
        F.when(state == 3, F.when(F.col("turn") % 3 == 0, "tone").otherwise("too long")).alias("rejection_reason"),
        at.alias("drafted_at"),
        F.when(state >= 2, at + F.expr("interval '2' hour")).alias("reviewed_at"),
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    level = (
        F.when((kind == "error") & (_k() % 10 == 0), "fatal").when(kind == "error", "error")
        .when(kind == "purchase", "warn").otherwise("info")
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), level.alias("level"), F.upper("event_type").alias("code"),
        F.col("props").alias("context"), F.col("ts").alias("occurred_at"),
    )


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_heartbeats(table(spark, sf_dir, "events"))


def as_heartbeats(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "click", "scraping").when(kind == "view", "scoring").when(kind == "signup", "drafting")
        .when(kind == "error", "degraded").otherwise("idle")
    )
    return events.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("worker-"), (F.col("user_id") % 3).cast("string")).alias("instance_id"),
        F.col("ts").alias("beat_at"),
        status.alias("status"),
        _k().alias("queue_depth"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_attempts(table(spark, sf_dir, "events"))


def as_attempts(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", F.col("user_id").alias("source_id"), F.col("ts").alias("attempted_at"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("outcome"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("user_id") % 2 == 0
    return table(spark, sf_dir, "events").select(
        F.when(even, "reddit").otherwise("twitter").alias("platform"), F.col("ts").alias("requested_at")
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    config = F.concat(
        F.lit('{"subreddit":"s'), (key % 9).cast("string"), F.lit('","keywords":["of the","the is"]}')
    )
    return table(spark, sf_dir, "supplier").select(
        key.alias("id"),
        _platform("s_suppkey").alias("platform"),
        config.alias("config"),
        (F.col("s_acctbal") > 0).alias("is_active"),
        F.when(key % 5 == 0, "degraded").when(key % 5 == 1, "paused").otherwise("healthy").alias("status"),
        F.when(key % 7 != 0, _ago((key * 3571) % 86400)).alias("last_scraped_at"),
    )


def rate_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").filter(key < 4).select(
        _platform("s_suppkey").alias("platform"),
        (_now() + F.make_dt_interval(hours=(key - 2).cast("int"))).alias("resets_at"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


# The same views for the checking SQL, as common table expressions over the given tables.
_NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
_K_SQL = "cast(json_extract_string(props, '$.k') as int)"
_PLATFORM_SQL = "case {key} % 4 when 0 then 'reddit' when 1 then 'twitter' when 2 then 'hackernews' else 'indiehackers' end"

VIEW_SQL = {
    "posts": f"""select doc_id id, {_PLATFORM_SQL.format(key='doc_id')} platform,
  concat('t3_', cast(doc_id as varchar)) external_id, concat('u', cast(doc_id % 97 as varchar)) author,
  substring(text, 1, 80) title, text body, lang,
  concat('https://example.test/', source, '/', cast(doc_id as varchar)) url,
  {_NOW_SQL} - ((doc_id * 7919) % 864000) * interval '1' second posted_at,
  {_NOW_SQL} - ((doc_id * 7919) % 864000) * interval '1' second + interval '1' hour scraped_at,
  n_chars % 100 engagement_score, doc_id % 3 = 0 processed,
  lower(concat(substring(text, 1, 80), chr(10), text)) lowered
from documents""",
    "leads": """select p.id, p.id raw_post_id, platform, external_id, author,
  cast(case when toxic = 1 then 0 else least(100, 60 * quality + (p.id * 31) % 41) end as int) score,
  case p.id % 8 when 0 then 'new' when 1 then 'drafted' when 2 then 'approved' when 3 then 'rejected'
    when 4 then 'sent' when 5 then 'responded' when 6 then 'converted' else 'lost' end status,
  scraped_at + interval '30' minute scored_at
from posts p join labels l on p.id = l.doc_id""",
    "drafts": f"""select conv_id * 100 + turn id, conv_id lead_id, text body,
  case (conv_id + turn) % 5 when 0 then 'drafting' when 1 then 'pending_review' when 2 then 'approved'
    when 3 then 'rejected' else 'sent' end status,
  case when (conv_id + turn) % 5 = 3 then case when turn % 3 = 0 then 'tone' else 'too long' end end rejection_reason,
  {_NOW_SQL} - (((conv_id * 13 + turn) * 3571) % 864000) * interval '1' second drafted_at,
  case when (conv_id + turn) % 5 >= 2 then
    {_NOW_SQL} - (((conv_id * 13 + turn) * 3571) % 864000) * interval '1' second + interval '2' hour end reviewed_at
from conversations where role = 'assistant'""",
    "logs": f"""select event_id id,
  case when event_type = 'error' and {_K_SQL} % 10 = 0 then 'fatal' when event_type = 'error' then 'error'
    when event_type = 'purchase' then 'warn' else 'info' end as level,
  upper(event_type) code, props context, ts occurred_at
from events""",
    "heartbeats": f"""select event_id id, concat('worker-', cast(user_id % 3 as varchar)) instance_id, ts beat_at,
  case event_type when 'click' then 'scraping' when 'view' then 'scoring' when 'signup' then 'drafting'
    when 'error' then 'degraded' else 'idle' end status,
  {_K_SQL} queue_depth
from events""",
    "attempts": """select event_id, user_id source_id, ts attempted_at,
  case when event_type = 'error' then 'failed' else 'ok' end outcome
from events""",
    "requests": """select case when user_id % 2 = 0 then 'reddit' else 'twitter' end platform, ts requested_at
from events""",
    "sources": f"""select s_suppkey id, {_PLATFORM_SQL.format(key='s_suppkey')} platform,
  concat('{{"subreddit":"s', cast(s_suppkey % 9 as varchar), '","keywords":["of the","the is"]}}') config,
  s_acctbal > 0 is_active,
  case s_suppkey % 5 when 0 then 'degraded' when 1 then 'paused' else 'healthy' end status,
  case when s_suppkey % 7 = 0 then null
    else {_NOW_SQL} - ((s_suppkey * 3571) % 86400) * interval '1' second end last_scraped_at
from supplier""",
    "rate_limits": f"""select {_PLATFORM_SQL.format(key='s_suppkey')} platform,
  {_NOW_SQL} + (s_suppkey - 2) * interval '1' hour resets_at
from supplier where s_suppkey < 4""",
}

_NEEDS = {"leads": ("posts",)}


def with_views(names: str, sql: str) -> str:
    """The SQL preceded by the named views and those they need."""
    order: list[str] = []
    for name in names.split():
        order += [n for n in (*_NEEDS.get(name, ()), name) if n not in order]
    views = ",\n".join(f"{n} as ({VIEW_SQL[n]})" for n in order)
    sql = sql.strip().replace("{now}", _NOW_SQL)
    if not views:
        return sql
    rest = f",\n{sql[5:]}" if sql.startswith("with ") else f"\n{sql}"
    return f"with {views}{rest}"
