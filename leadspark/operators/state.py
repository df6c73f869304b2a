"""Current state folded from append-only facts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from leadspark.functions.times import Moment, micros, moment_for
from leadspark.operators.filters import unprocessed
from leadspark.operators.keyed import POST_KEY

# Fixed value: failures in a row that make a source degraded.
DEGRADED_AFTER = 3


def apply_transitions(entity: DataFrame, transitions: DataFrame, key: str = "id") -> DataFrame:
    """Rows with the status of their latest transition (by ``at``, then ``seq``), else their own.

    Transitions are folded before the join, so many transitions of one row do not meet in it.
    """
    latest = transitions.groupBy(key).agg(F.max_by("status", F.struct("at", "seq")).alias("_status"))
    joined = entity.join(latest, key, "left")
    return joined.withColumn("status", F.coalesce("_status", "status")).drop("_status")


def apply_reviews(drafts: DataFrame, decisions: DataFrame, reviewable: Sequence[str] = ("pending_review",)) -> DataFrame:
    """Drafts after review: ``approved`` approves, ``skip`` rejects with its reason.

    ``decisions`` has ``id``, ``decision``, ``reason``, ``at``; the latest valid decision counts. A decision holds for
    a draft in a ``reviewable`` status only: one that has been sent is not brought back by a late word.
    """
    valid = decisions.filter(F.col("decision").isin("approved", "skip"))
    decided = F.struct("at", "decision", "reason")
    latest = valid.groupBy("id").agg(F.max(decided).alias("_d"))
    skipped = F.col("_d.decision") == "skip"
    open_draft = F.col("status").isin(*reviewable)
    return (
        drafts.join(latest, "id", "left")
        .withColumn("_d", F.when(open_draft, F.col("_d")))
        .withColumns(
            {
                "status": F.when(skipped, F.lit("rejected")).when(F.col("_d").isNotNull(), F.lit("approved")).otherwise(F.col("status")),
                "rejection_reason": F.when(skipped, F.col("_d.reason")).otherwise(F.col("rejection_reason")),
                "reviewed_at": F.coalesce(F.col("_d.at"), F.col("reviewed_at")),
            }
        )
        .drop("_d")
    )


def _with_resets(attempts: DataFrame, resets: DataFrame | None) -> DataFrame:
    facts = attempts.select("source_id", "event_id", "attempted_at", "outcome")
    if resets is None:
        return facts
    cleared = resets.select(
        "source_id", F.lit(None).cast(attempts.schema["event_id"].dataType).alias("event_id"),
        F.col("reset_at").alias("attempted_at"), F.lit("reset").alias("outcome"),
    )
    return facts.unionByName(cleared)


def _place(at: Column, event_id: Column, is_reset: Column | bool = False) -> Column:
    """What orders the facts of a source: time, resets after attempts, then the event."""
    late = is_reset.cast("int") if isinstance(is_reset, Column) else F.lit(int(is_reset))
    return F.struct(at.alias("at"), late.alias("late"), event_id.alias("event_id"))


def _open_failures(folded: DataFrame) -> DataFrame:
    """Failures that come before the slice's last success or reset can never count again."""
    later = F.filter("failures", lambda f: F.col("good").isNull() | (f > F.col("good")))
    return folded.withColumn("failures", F.array_sort(later))


def fold_attempts(
    attempts: DataFrame, resets: DataFrame | None = None, failing: Sequence[str] = ("failed",), slice_s: int = 3_600
) -> DataFrame:
    """Per source and time slice: last success and reset, and the failures after them.

    Folds of any stretches of attempts merge in any order, repeated ones included (see ``merge_folds``): the last
    success is a maximum, the failures are a set, and one that precedes a success is of no more use whatever comes
    later. The attempts are read once; a slice bounds how many failures one row holds. Facts of one moment follow in
    the order of their ``event_id``, a reset last. Rate-limited and forbidden attempts end normally, so by default
    they count as successes do. Facts without a source or time are left out.
    """
    facts = _with_resets(attempts, resets).filter(F.col("source_id").isNotNull() & F.col("attempted_at").isNotNull())
    failed = F.col("outcome").isin(*failing)
    at, is_reset = F.col("attempted_at"), F.col("outcome") == "reset"
    place = _place(at, F.col("event_id"), is_reset)
    return _open_failures(
        facts.groupBy("source_id", _slice(at, slice_s).alias("slice")).agg(
            F.max(F.when(~failed & ~is_reset, at)).alias("ok_at"),
            F.max(F.when(is_reset, at)).alias("reset_at"),
            F.max(F.when(~failed, place)).alias("good"),
            F.collect_set(F.when(failed, place)).alias("failures"),
        )
    )


def _slice(at: Column, slice_s: int) -> Column:
    return F.floor(micros(at) / F.lit(slice_s * 1_000_000))


def merge_folds(*folds: DataFrame) -> DataFrame:
    """The fold of all stretches; their order does not matter, and they may overlap."""
    rows = folds[0]
    for fold in folds[1:]:
        rows = rows.unionByName(fold)
    # Slices before a source's last success are of no more use.
    latest = F.max("good").over(W.partitionBy("source_id"))
    merged = rows.groupBy("source_id", "slice").agg(
        F.max("ok_at").alias("ok_at"), F.max("reset_at").alias("reset_at"), F.max("good").alias("good"),
        F.array_distinct(F.flatten(F.collect_list("failures"))).alias("failures"),
    )
    used = merged.withColumn("_latest", latest)
    used = used.withColumn("failures", F.filter("failures", lambda f: F.col("_latest").isNull() | (f > F.col("_latest"))))
    kept = F.col("ok_at").isNotNull() | F.col("reset_at").isNotNull() | (F.size("failures") > 0)
    return _open_failures(used.filter(kept).drop("_latest"))


def state_of(fold: DataFrame) -> DataFrame:
    """Health of each source: the third failure in a row degrades it, a success or reset heals it.

    A source's slices are ordered by one task, its attempts are not.
    """
    source = W.partitionBy("source_id")
    slices = fold.withColumn("_good", F.max("good").over(source))
    slices = slices.withColumn("_late", F.filter("failures", lambda f: F.col("_good").isNull() | (f > F.col("_good"))))
    before = F.coalesce(F.sum(F.size("_late")).over(source.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    slices = slices.withColumn("_first", F.when(before < DEGRADED_AFTER, F.slice("_late", 1, DEGRADED_AFTER)))
    states = slices.groupBy("source_id").agg(
        F.max("ok_at").alias("ok_at"), F.max("reset_at").alias("reset_at"), F.sum(F.size("_late")).alias("failures"),
        F.array_sort(F.flatten(F.collect_list("_first"))).alias("first"),
    )
    # A reset forgets when the source was last read, so it is read again first.
    scraped = F.when(F.col("reset_at").isNull() | (F.col("ok_at") > F.col("reset_at")), F.col("ok_at"))
    degraded = F.col("failures") >= DEGRADED_AFTER
    return states.select(
        "source_id",
        scraped.alias("last_scraped_at"),
        F.col("failures").cast("int").alias("consecutive_failures"),
        F.when(degraded, F.lit("degraded")).otherwise(F.lit("healthy")).alias("status"),
        F.when(degraded, F.get("first", F.lit(DEGRADED_AFTER - 1))["at"]).alias("degraded_since"),
    )


def source_state(
    attempts: DataFrame, resets: DataFrame | None = None, failing: Sequence[str] = ("failed",)
) -> DataFrame:
    """Health of each source after its attempts and manual resets."""
    return state_of(fold_attempts(attempts, resets, failing))


def current_sources(sources: DataFrame, attempts: DataFrame, resets: DataFrame | None = None, failing: Sequence[str] = ("failed",)) -> DataFrame:
    """The source table as its attempts and resets leave it, for the next read of the watchlist.

    Failures add to those stored until a success or reset. A success or reset heals any source, a paused one too, as
    it does when the row is updated in place; a reset makes the source unread. Sources without attempts stay as they are.
    """
    fold = fold_attempts(attempts, resets, failing)
    state = state_of(fold).withColumnRenamed("source_id", "id")
    good = fold.groupBy(F.col("source_id").alias("id")).agg(F.max("good").isNotNull().alias("_good"), F.max("reset_at").isNotNull().alias("_reset"))
    found = state.join(good, "id").select("id", "_good", "_reset", F.col("last_scraped_at").alias("_at"), F.col("consecutive_failures").alias("_n"))
    joined = sources.join(found, "id", "left")
    seen, healed = F.col("_n").isNotNull(), F.coalesce("_good", F.lit(False))
    failures = F.when(healed, F.col("_n")).otherwise(F.coalesce("consecutive_failures", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("int")
    updated = {
        "consecutive_failures": failures,
        "last_scraped_at": F.when(F.coalesce("_reset", F.lit(False)), F.col("_at")).otherwise(F.coalesce("_at", "last_scraped_at")),
        "status": F.when(~seen, F.col("status")).when((F.col("_n") > 0) & (failures >= DEGRADED_AFTER), F.lit("degraded"))
        .when(healed, F.lit("healthy")).otherwise(F.col("status")),
    }
    return joined.select(*[updated[c].alias(c) if c in updated else F.col(c) for c in sources.columns])


def source_history(attempts: DataFrame, slice_s: int = 3_600, failing: Sequence[str] = ("failed",)) -> DataFrame:
    """Each attempt with the failures in a row up to it and the status it left.

    Attempts are folded per source and time slice, so a busy source spreads over its slices. One row
    per slice then carries the failures at its start, and rejoins the slice on the same partitioning.
    """
    failed = F.col("outcome").isin(*failing)
    rows = attempts.filter(F.col("source_id").isNotNull()).withColumns({"_slice": _slice(F.col("attempted_at"), slice_s), "_failed": failed.cast("int")})
    inside = W.partitionBy("source_id", "_slice").orderBy("attempted_at", "event_id")
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_run", F.sum(1 - F.col("_failed")).over(so_far))
    in_run = W.partitionBy("source_id", "_slice", "_run").orderBy("attempted_at", "event_id")
    rows = rows.withColumn("_count", F.sum("_failed").over(in_run.rowsBetween(W.unboundedPreceding, W.currentRow)))

    # What a slice leaves behind: its last run of failures, added to what came before if it never succeeded.
    # It reads the same columns as the rows themselves, so that both share one shuffle.
    others = [c for c in attempts.columns if c not in ("source_id", "attempted_at", "event_id")]
    last_run = F.max_by(F.struct("_count", *others), F.struct("attempted_at", "event_id"))["_count"]
    left = rows.groupBy("source_id", "_slice").agg(last_run.alias("_tail"), F.max("_run").alias("_goods"))
    over_slices = W.partitionBy("source_id").orderBy("_slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    left = left.withColumn("_era", F.count(F.when(F.col("_goods") > 0, 1)).over(over_slices))
    in_era = W.partitionBy("source_id", "_era").orderBy("_slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    left = left.withColumn("_after", F.sum("_tail").over(in_era))
    previous = F.lag("_after", 1, 0).over(W.partitionBy("source_id").orderBy("_slice"))
    carried = left.withColumn("_before", previous).select("source_id", "_slice", "_before")

    count = F.col("_count") + F.when(F.col("_run") == 0, F.col("_before")).otherwise(F.lit(0))
    out = rows.join(carried, ["source_id", "_slice"], "left").withColumn("consecutive_failures", count.cast("int"))
    degraded = F.col("consecutive_failures") >= DEGRADED_AFTER
    out = out.withColumn("status", F.when(degraded, F.lit("degraded")).otherwise(F.lit("healthy")))
    return out.select(*attempts.columns, "consecutive_failures", "status")


def stale_degraded(state: DataFrame, as_of: Moment, hours: float = 24) -> DataFrame:
    """Sources degraded for longer than the given hours."""
    cutoff = moment_for(state, "degraded_since", as_of, -timedelta(hours=hours))
    return state.filter((F.col("status") == "degraded") & (F.col("degraded_since") < cutoff))


def reset_degraded(state: DataFrame, as_of: Moment, source_id: object = None) -> DataFrame:
    """Reset events for all degraded sources, or for one source in whatever state."""
    chosen = state.filter(F.col("status") == "degraded") if source_id is None else state.filter(F.col("source_id") == source_id)
    return chosen.select("source_id", moment_for(state, "degraded_since", as_of).alias("reset_at"))


def adopt_unfinished(
    posts: DataFrame, score_log: DataFrame, drafts: DataFrame, as_of: Moment, minutes: float = 30,
    keys: Sequence[str] = POST_KEY,
) -> tuple[DataFrame, DataFrame]:
    """After a restart: ``(unscored posts older than the given minutes, transitions of interrupted drafts)``.

    An interrupted draft goes to review if it already has a body.
    """
    cutoff = moment_for(posts, "scraped_at", as_of, -timedelta(minutes=minutes))
    waiting = unprocessed(posts.filter(F.col("scraped_at") < cutoff), score_log, keys)
    has_body = F.coalesce(F.length(F.trim("body")) > 0, F.lit(False))
    interrupted = drafts.filter((F.col("status") == "drafting") & has_body)
    resumed = interrupted.select(
        "id", F.lit("pending_review").alias("status"), moment_for(drafts, "drafted_at", as_of).alias("at"),
        F.lit(0).cast("bigint").alias("seq"),
    )
    return waiting, resumed
