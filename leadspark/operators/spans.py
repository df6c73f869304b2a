"""Gaps, sessions and rolling budgets over time.

Beats and requests are first combined per short time bucket and then taken by time slices, so that what a task sorts
of a single key is bounded by the width of a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from leadspark.functions.times import micros, seconds_between

# Requests allowed per span of seconds on the two collected platforms.
RATE_BUDGETS = {"reddit": (60, 60), "twitter": (180, 900)}


def _bucket(ts: Column, seconds: float) -> Column:
    return F.floor(micros(ts) / F.lit(int(seconds * 1_000_000)))


def _beat_buckets(heartbeats: DataFrame, gap_s: float) -> DataFrame:
    """First and last beat of each instance and bucket one gap wide.

    Beats of one bucket are less than a gap apart, so every gap lies between neighbouring buckets.
    """
    return heartbeats.groupBy("instance_id", _bucket(F.col("beat_at"), gap_s).alias("_b")).agg(
        F.min("beat_at").alias("_first"), F.max("beat_at").alias("_last"), F.count("*").alias("_n")
    )


#: Slices of one level that make one slice of the next.
_FAN = 128
#: Fixed values, in microseconds: where the calendar of timestamps begins (year 1), and more than its length.
_CALENDAR_START, _CALENDAR = -62_135_596_800_000_000, 320_000_000_000_000_000


def _widths(slice_s: float) -> list[int]:
    """Ever wider slices, in microseconds, up to one that holds all timestamps."""
    out = [int(slice_s * 1_000_000)]
    while out[-1] < _CALENDAR:
        out.append(min(out[-1] * _FAN, _CALENDAR))
    return out


def _slice_at(ts: Column, width: int) -> Column:
    return F.floor((micros(ts) - F.lit(_CALENDAR_START)) / F.lit(width))


def outages(heartbeats: DataFrame, gap_s: float = 300, slice_s: float = 3_600) -> DataFrame:
    """Pauses longer than the gap between two beats of an instance.

    Beats are compared within time slices. A slice then stands for its first and last beat, and slices are compared
    within wider ones, until one holds all: no task orders more of an instance than a slice of slices.
    """
    rows, found = _beat_buckets(heartbeats, gap_s).select("instance_id", "_first", "_last"), None
    for width in _widths(slice_s):
        rows = rows.withColumn("_slice", _slice_at(F.col("_first"), width))
        rows = rows.withColumn("last_beat_at", F.lag("_last").over(W.partitionBy("instance_id", "_slice").orderBy("_first")))
        gap = seconds_between(F.col("_first"), F.col("last_beat_at"))
        inside = rows.filter(gap > gap_s).select("instance_id", "last_beat_at", F.col("_first").alias("recovered_at"), gap.alias("gap_s"))
        found = inside if found is None else found.unionByName(inside)
        rows = rows.groupBy("instance_id", "_slice").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    return found


def live_sessions(heartbeats: DataFrame, stale_s: float = 90, slice_s: float = 3_600) -> DataFrame:
    """Stretches of beats of an instance that are each less than the stale time apart.

    Stretches are joined within time slices. All but the first and the last of a slice are complete; these two go on
    and are joined within a wider slice, until one holds all.
    """
    widths = _widths(slice_s)
    rows, closed = _beat_buckets(heartbeats, stale_s), None
    for width in widths:
        rows = rows.withColumn("_slice", _slice_at(F.col("_first"), width))
        inside = W.partitionBy("instance_id", "_slice")
        gap = seconds_between(F.col("_first"), F.lag("_last").over(inside.orderBy("_first")))
        rows = rows.withColumn("_new", F.coalesce((gap >= stale_s).cast("int"), F.lit(1)))
        so_far = inside.orderBy("_first").rowsBetween(W.unboundedPreceding, W.currentRow)
        rows = rows.withColumns({"_session": F.sum("_new").over(so_far), "_sessions": F.sum("_new").over(inside)})
        joined = rows.groupBy("instance_id", "_slice", "_session", "_sessions").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))
        complete = (F.col("_session") > 1) & (F.col("_session") < F.col("_sessions")) if width != widths[-1] else F.lit(True)
        done = joined.filter(complete).select("instance_id", "_first", "_last", "_n")
        closed = done if closed is None else closed.unionByName(done)
        rows = joined.filter(~complete).select("instance_id", "_first", "_last", "_n")
    return closed.select("instance_id", F.col("_first").alias("started_at"), F.col("_last").alias("last_beat_at"), F.col("_n").alias("beats"))


def rate_budget(requests: DataFrame, limits: dict[str, tuple[int, int]] | None = None, slice_s: int = 86_400) -> DataFrame:
    """Seconds in which a platform made requests, with the requests of the span ending there.

    A platform without a budget keeps its seconds, with neither a span nor a verdict.

    Requests are counted per second first. A second's count is then added where it begins to matter and
    taken away where its span ends, so that a running total is the rolling count at the cost of one pass.
    Each platform is cut into time slices; what still matters at the end of a slice opens the next one.
    """
    limits = RATE_BUDGETS if limits is None else limits
    allowed = F.create_map(*[x for p, (n, _) in limits.items() for x in (F.lit(p), F.lit(n))])
    lasting = F.create_map(*[x for p, (_, span) in limits.items() for x in (F.lit(p), F.lit(span))])
    width = max([slice_s, *(span for _, span in limits.values())])
    counts = (
        requests.groupBy("platform", F.floor(micros(F.col("requested_at")) / F.lit(1_000_000)).alias("second"))
        .agg(F.count("*").alias("requests"))
    )
    slice_of = lambda s: F.floor(s / width)
    start, end = F.col("second"), F.col("second") + F.element_at(lasting, F.col("platform"))
    own, reach = slice_of(start), slice_of(end - 1)

    def change(slice_: Column, at: Column, by: Column, made: Column) -> Column:
        return F.struct(slice_.alias("slice"), at.alias("second"), by.alias("by"), made.alias("requests"))

    made, none = F.col("requests"), F.lit(0).cast("bigint")
    changes = F.array(
        change(own, start, made, made),
        F.when(slice_of(end) == own, change(own, end, -made, none)),
        F.when(reach > own, change(reach, reach * width, made, none)),
        F.when(reach > own, change(reach, end, -made, none)),
    )
    budgeted = F.coalesce(F.col("platform").isin(*limits), F.lit(False))
    rows = counts.filter(budgeted).select("platform", F.inline(F.array_compact(changes)))
    so_far = W.partitionBy("platform", "slice").orderBy("second").rangeBetween(W.unboundedPreceding, W.currentRow)
    rolled = rows.withColumn("in_span", F.sum("by").over(so_far)).filter(F.col("requests") > 0)
    over = F.col("in_span") > F.element_at(allowed, F.col("platform"))
    unknown = counts.filter(~budgeted).select(
        "platform", "second", "requests", F.lit(None).cast("bigint").alias("in_span"), F.lit(None).cast("boolean").alias("over_budget")
    )
    return rolled.select("platform", "second", "requests", "in_span", over.alias("over_budget")).unionByName(unknown)
