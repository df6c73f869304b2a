"""Funnel, health and periodic reports.

One-row parts are combined by union and a second aggregate, or read as scalar subqueries; nothing
is cross joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leadspark import schemas as S
from leadspark.functions.text import blank_if_null, clip
from leadspark.functions.times import Moment, later_than, moment, moment_for, seconds_between
from leadspark.operators.checks import check_rows
from leadspark.plans.queues import active_rate_limits
from leadspark.session import keep

# Seconds after which a beat is stale, in the readiness probe and in the self-check.
READY_STALE_S = 90
DOCTOR_STALE_S = 120


def _one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row frames side by side; each column comes from the one part that has it."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.agg(*[F.max(c).alias(c) for p in parts for c in p.columns])


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def funnel(posts: DataFrame, leads: DataFrame, drafts: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """The eight stage counts of the last days, as one row.

    Each table is read once; the time bound shared by its counts also reaches the scan.
    """
    back = timedelta(days=days)
    new_posts = posts.filter(later_than(posts, "scraped_at", as_of, back))
    new_leads = leads.filter(later_than(leads, "scored_at", as_of, back))
    drafted = later_than(drafts, "drafted_at", as_of, back)
    reviewed = later_than(drafts, "reviewed_at", as_of, back)
    status, suffix = F.col("status"), f"_{days}d"
    parts = [
        new_posts.agg(F.count("*").alias("scraped" + suffix)),
        new_leads.agg(
            F.count("*").alias("scored" + suffix),
            _count_if(F.col("score") >= S.QUALIFIED_SCORE).alias("qualified" + suffix),
            _count_if(status == "responded").alias("responded" + suffix),
            _count_if(status == "converted").alias("converted" + suffix),
        ),
        drafts.filter(drafted | reviewed).agg(
            _count_if(drafted).alias("drafted" + suffix),
            _count_if((status == "approved") & reviewed).alias("approved" + suffix),
            _count_if((status == "sent") & reviewed).alias("sent" + suffix),
        ),
    ]
    stages = ("scraped", "scored", "qualified", "drafted", "approved", "sent", "responded", "converted")
    return _one_row(parts).select(*[s + suffix for s in stages])


def status_counts(sources: DataFrame) -> DataFrame:
    return sources.groupBy("status").agg(F.count("*").alias("n"))


def heartbeat_age(heartbeats: DataFrame, as_of: Moment, per_instance: bool = False) -> DataFrame:
    """Seconds since the last beat, of all or of each instance; null where there is none."""
    grouped = heartbeats.groupBy("instance_id") if per_instance else heartbeats.groupBy()
    last = grouped.agg(F.max("beat_at").alias("last_beat_at"))
    return last.withColumn("seconds_ago", seconds_between(moment(as_of, T.TimestampType()), F.col("last_beat_at")))


def recent_level_count(logs: DataFrame, levels: Sequence[str], as_of: Moment, window: timedelta) -> DataFrame:
    """One row: events of the given levels within the window."""
    hit = F.col("level").isin(*levels) & later_than(logs, "occurred_at", as_of, window)
    return logs.filter(hit).agg(F.count("*").alias("n"))


def readiness(
    heartbeats: DataFrame, logs: DataFrame, rate_limits: DataFrame, as_of: Moment, stale_s: float = READY_STALE_S
) -> DataFrame:
    """One row: is a beat fresh and are there no fatal events of the last five minutes?

    Limits in force are shown, at most one per platform, and do not count against it.
    """
    fatal = recent_level_count(logs, ["fatal"], as_of, timedelta(minutes=5))
    limits = active_rate_limits(rate_limits, as_of)
    shown = F.array_sort(F.collect_list(F.struct("platform", "resets_at"))).alias("active_rate_limits")
    parts = [
        heartbeat_age(heartbeats, as_of).select("seconds_ago"),
        fatal.withColumnRenamed("n", "fatal_count"),
        limits.agg(shown),
    ]
    row = _one_row(parts)
    fresh = F.coalesce(F.col("seconds_ago") < stale_s, F.lit(False))
    calm = F.col("fatal_count") == 0
    return row.select(
        (fresh & calm).alias("ok"), fresh.alias("heartbeat_ok"), "seconds_ago", calm.alias("no_fatal_recent"),
        "fatal_count", "active_rate_limits",
    )


PASSED, WARNED, FAILED = "passed", "warned", "failed"


def _check(df: DataFrame, name: Column, state: Column, detail: Column) -> DataFrame:
    return df.select(name.alias("check"), state.alias("state"), detail.cast("string").alias("detail"))


def _either(passed: Column, other: str) -> Column:
    return F.when(F.coalesce(passed, F.lit(False)), F.lit(PASSED)).otherwise(F.lit(other))


def health_report(tables: Mapping[str, DataFrame], as_of: Moment, stale_s: float = DOCTOR_STALE_S, degraded_hours: float = 24) -> DataFrame:
    """Rows of ``check``, ``state`` (passed, warned or failed) and ``detail``, and a ``summary`` row, over the eight tables.

    Each table there, with its columns; beat fresh; sources per status, and those degraded for longer than the hours
    (by ``degraded_since``, where the sources have it, else by their last read); limits in force; errors of the last
    hour; rows that break a constraint. What is missing warns or fails its own checks only. The checks are made when
    this is called, and kept: a row for each table, status and limit.
    """
    spark = SparkSession.active()
    given = {name: tables[name] if name in tables else spark.createDataFrame([], schema) for name, schema in S.TABLES.items()}
    lacking = {name: [c for c in schema.names if c not in tables[name].columns] for name, schema in S.TABLES.items() if name in tables}
    schema_rows = [
        (f"table {name}", *((FAILED, "missing") if name not in tables else (WARNED, "without " + ", ".join(lacking[name])) if lacking[name] else (PASSED, "present")))
        for name in S.TABLES
    ]
    now = moment(as_of, T.TimestampType())
    anchor = given["heartbeats"].agg(F.max("beat_at").alias("last_beat_at"))
    age = seconds_between(now, F.col("last_beat_at"))
    beat = F.when(age.isNull(), F.lit(WARNED)).otherwise(_either(age < stale_s, FAILED))
    beat_text = F.coalesce(F.concat(F.floor(age + 0.5).cast("string"), F.lit("s ago")), F.lit("no heartbeat yet"))
    errors = recent_level_count(given["logs"], ["error", "fatal"], as_of, timedelta(hours=1))
    limits = active_rate_limits(given["rate_limits"], as_of)
    n_limits = limits.agg(F.count("*").alias("n"))
    sources = given["sources"]
    n_sources = sources.agg(F.count("*").alias("n"))
    since = F.col("degraded_since") if "degraded_since" in sources.columns else F.col("last_scraped_at")
    long_degraded = sources.filter((F.col("status") == "degraded") & (F.coalesce(seconds_between(now, since), F.lit(float("inf"))) > degraded_hours * 3600))
    stuck = long_degraded.agg(F.count("*").alias("n"))
    rows = [
        spark.createDataFrame(schema_rows, "check string, state string, detail string"),
        _check(anchor, F.lit("heartbeat"), beat, beat_text),
        _check(n_sources.filter("n = 0"), F.lit("sources"), F.lit(WARNED), F.lit("none configured yet")),
        _check(status_counts(sources), F.concat(F.lit("sources "), "status"), _either(F.col("status") == "healthy", WARNED), F.col("n")),
        _check(stuck, F.lit("sources degraded for long"), _either(F.col("n") == 0, FAILED), F.col("n")),
        _check(n_limits.filter("n = 0"), F.lit("rate limits"), F.lit(PASSED), F.lit("none active")),
        _check(limits, F.concat(F.lit("rate-limited "), "platform"), F.lit(WARNED),
               F.concat(F.lit("until "), F.date_format("resets_at", "yyyy-MM-dd HH:mm:ss"))),
        _check(errors, F.lit("errors in last hour"), _either(F.col("n") == 0, WARNED), F.concat(F.col("n").cast("string"), F.lit(" errors"))),
    ]
    for name in S.TABLES:
        if name in tables:
            broken = check_rows(given[name], name).agg(_count_if(F.size("violations") > 0).alias("n"))
            rows.append(_check(broken, F.lit(f"rows of {name}"), _either(F.col("n") == 0, FAILED), F.concat(F.col("n").cast("string"), F.lit(" break a constraint"))))
    checks = keep(reduce(DataFrame.unionByName, rows))
    counts = F.concat_ws(", ", *[F.concat(_count_if(F.col("state") == s).cast("string"), F.lit(f" {s}")) for s in (PASSED, WARNED, FAILED)])
    worst = F.when(_count_if(F.col("state") == FAILED) > 0, F.lit(FAILED)).when(_count_if(F.col("state") == WARNED) > 0, F.lit(WARNED)).otherwise(F.lit(PASSED))
    return checks.unionByName(checks.agg(F.lit("summary").alias("check"), worst.alias("state"), counts.alias("detail")))


def daily_stats(posts: DataFrame, leads: DataFrame, drafts: DataFrame, day: date | None = None) -> DataFrame:
    """Posts, leads, qualified leads and drafts per day, or of one day."""

    def per_day(df: DataFrame, ts: str, **counts: Column) -> DataFrame:
        if day is not None:
            start = f"{day.isoformat()}T00:00:00"
            df = df.filter((F.col(ts) >= moment_for(df, ts, start)) & (F.col(ts) < moment_for(df, ts, start, timedelta(days=1))))
        return df.groupBy(F.to_date(ts).alias("day")).agg(*[c.alias(n) for n, c in counts.items()])

    parts = [
        per_day(posts, "scraped_at", posts=F.count("*")),
        per_day(leads, "scored_at", leads=F.count("*"), qualified=_count_if(F.col("score") >= S.QUALIFIED_SCORE)),
        per_day(drafts, "drafted_at", drafts=F.count("*")),
    ]
    days = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = ("posts", "leads", "qualified", "drafts")
    return days.groupBy("day").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def signal_report(leads: DataFrame, min_score: int = S.QUALIFIED_SCORE) -> DataFrame:
    """Per signal tag: scored posts, how many of them became high-score leads, and the mean score."""
    tagged = leads.select("score", F.explode("signal_tags").alias("tag"))
    return tagged.groupBy("tag").agg(
        F.count("*").alias("n"),
        _count_if(F.col("score") >= min_score).alias("high"),
        F.avg("score").alias("mean_score"),
    )


def digest_summary(leads: DataFrame, drafts: DataFrame, as_of: Moment, hours: float = 6) -> DataFrame:
    """One row: leads of the last hours and drafts awaiting review."""
    new = leads.filter(later_than(leads, "scored_at", as_of, timedelta(hours=hours)))
    pending = drafts.filter(F.col("status") == "pending_review")
    return _one_row([new.agg(F.count("*").alias("new_leads")), pending.agg(F.count("*").alias("pending_drafts"))])


def digest_text(leads: DataFrame, heading: str = "*Lead digest*", n: int = 5) -> DataFrame:
    """One row with the digest message of the first n leads of a list; no row for an empty list."""
    top = leads.orderBy(F.desc("score"), "platform", "external_id").limit(n)
    block = F.concat(
        F.lit("🔥 "), F.col("score").cast("string"), F.lit(" — "), blank_if_null(F.col("author")), F.lit("\n"),
        clip(F.col("title"), 80), F.lit("\n"), blank_if_null(F.col("url")),
    )
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("rank"), "platform", "external_id", block.alias("block"))))
    body = F.array_join(F.transform(ranked, lambda r: r["block"]), "\n\n")
    return top.agg(F.count("*").alias("n"), body.alias("body")).filter("n > 0").select(
        F.concat(F.lit(f"{heading}\n\n"), F.col("body")).alias("text")
    )


def escalations(
    leads: DataFrame, rate_limits: DataFrame, as_of: Moment, min_score: int = S.DIGEST_SCORE, hours: float = 1
) -> DataFrame:
    """Rows of ``kind``, ``key``, ``detail``: very good leads, and limits that block for longer than the hours."""
    hot = leads.filter(F.col("score") >= min_score).select(
        F.lit("lead").alias("kind"), F.concat_ws("/", "platform", "external_id").alias("key"),
        F.col("score").cast("string").alias("detail"),
    )
    bound = moment_for(rate_limits, "resets_at", as_of, timedelta(hours=hours))
    blocked = rate_limits.filter(F.col("resets_at") > bound).select(
        F.lit("rate_limit").alias("kind"), F.col("platform").alias("key"),
        F.date_format("resets_at", "yyyy-MM-dd HH:mm:ss").alias("detail"),
    )
    return hot.unionByName(blocked)


def rejection_reasons(drafts: DataFrame) -> DataFrame:
    """Rejected drafts per reason; a missing reason is shown as such."""
    reason = F.coalesce(F.col("rejection_reason"), F.lit("(none given)"))
    rejected = drafts.filter(F.col("status") == "rejected")
    return rejected.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
