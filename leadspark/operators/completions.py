"""Calls of a completion function: each row is paid once, and its reply kept before it is used.

The ledger is a table of replies by key. A row without a good reply is asked for; each task makes one call and
commits its replies as soon as it ends, so a failed task repeats its own call only, and a run that stops half-way leaves
the replies of its finished tasks to the next run.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from leadspark.functions.replies import parse_draft, parse_score
from leadspark.functions.times import Moment, moment
from leadspark.operators.checks import score_fault
from leadspark.operators.keyed import POST_KEY, first_per_key
from leadspark.session import keep, shared_folder
from leadspark.sources.folders import read_if_there

#: What a completion function is asked: the instructions and the prompt.
Request = tuple[str | None, str | None]
Completer = Callable[[list[Request]], list[str]]

#: Lets a task's files stay where they are if another task fails the job.
_KEEP_FINISHED_TASKS = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


def call_completer(prompts: DataFrame, completer: Completer, keys: Sequence[str], batch: int = 16) -> DataFrame:
    """``keys, reply, error`` of each row's ``system`` and ``prompt``, completed in batches inside the tasks.

    If a batch fails its rows are tried one by one, so that a bad row costs only itself.
    """
    fields = [prompts.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("reply", T.StringType()), T.StructField("error", T.StringType())])
    names = list(keys)

    def complete(requests: list[Request]) -> list[tuple[str | None, str | None]]:
        try:
            replies = completer(requests)
            if len(replies) != len(requests):
                raise ValueError(f"{len(replies)} replies to {len(requests)} prompts")
            return [(reply, None) for reply in replies]
        except Exception as failure:  # noqa: BLE001 - whatever the completer raises concerns these rows only
            if len(requests) == 1:
                return [(None, f"{type(failure).__name__}: {failure}")]
            return [pair for request in requests for pair in complete([request])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            requests = list(zip(frame["system"].tolist(), frame["prompt"].tolist(), strict=True))
            pairs = [pair for i in range(0, len(requests), batch) for pair in complete(requests[i : i + batch])]
            out = frame[names].copy()
            out["reply"] = [reply for reply, _ in pairs]
            out["error"] = [error for _, error in pairs]
            yield out

    return prompts.select(*keys, "system", "prompt").mapInPandas(run, schema)


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows with ``_number`` from 0 on, without a gap, and how many there are.

    The numbers are written, so that they stay whatever is computed again. A row's place is that in its part, and one
    number for each part comes to the driver.
    """
    placed = keep(rows.withColumn("_place", F.monotonically_increasing_id()))
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    starts = dict(zip([r.part for r in sizes], itertools.accumulate([0, *(r["count"] for r in sizes)])))
    offset = F.element_at(F.create_map(*[F.lit(x).cast("bigint") for pair in starts.items() for x in pair]), part) if starts else F.lit(0)
    return placed.withColumn("_number", offset + place), sum(r["count"] for r in sizes)


def ledger_replies(
    prompts: DataFrame, completer: Completer, keys: Sequence[str], as_of: Moment, store: str | None = None, batch: int = 16, tasks: int | None = None
) -> DataFrame:
    """``keys, reply, error`` of the prompts, from the ledger where it has them and newly completed where not.

    The calls are made when this is called, one for each key, and the result only reads the ledger. ``store`` is its
    path; without one, the ledger is a new shared folder that only this result uses. ``batch`` rows make one call, and
    ``tasks`` limits the calls made at a time. Keys must not be null.
    """
    spark = prompts.sparkSession
    store = store or shared_folder(spark)
    claimed = keep(first_per_key(prompts.select(*keys, "system", "prompt"), keys, ["prompt", "system"]))
    answered = read_if_there(spark, store)
    if answered is not None:
        good = answered.filter(F.col("error").isNull()).select(*keys)
        left = claimed.join(good, list(keys), "left_anti")
    else:
        left = claimed
    numbered, n = _numbered(left)
    calls = max(1, math.ceil(n / batch))
    tasks = min(tasks or calls, calls)
    call = F.floor(F.col("_number") / batch)
    for wave in range(math.ceil(calls / tasks)):
        mine = numbered.filter(F.floor(call / tasks) == wave).repartitionById(tasks, F.pmod(call, F.lit(tasks)).cast("int"))
        replies = call_completer(mine, completer, keys, batch).withColumn("at", moment(as_of, T.TimestampType()))
        replies.write.option(*_KEEP_FINISHED_TASKS).mode("append").parquet(store)
        schema = replies.schema
    held = spark.read.schema(schema).parquet(store).join(claimed.select(*keys), list(keys), "left_semi")
    # A good reply is the only one of its key; of errors the last counts.
    return first_per_key(held, keys, [F.col("error").isNotNull(), F.desc("at"), "error"]).drop("at")


def score_with(
    prompts: DataFrame, completer: Completer, keys: Sequence[str] = POST_KEY, *, as_of: Moment, store: str | None = None, batch: int = 16, tasks: int | None = None
) -> DataFrame:
    """Scores by a completion function: ``keys, score, reasoning, signal_tags, disqualifiers, error``.

    A failed call or unreadable reply becomes an error and the post stays queued. A score that
    cannot be stored is an error as well, with the score left out; other rows go on.
    """
    replies = ledger_replies(prompts, completer, keys, as_of, store, batch, tasks).withColumn("_r", parse_score(F.col("reply")))
    unread = F.when(~F.col("_r.parsed"), F.lit("unreadable reply"))
    error = F.coalesce("error", unread, score_fault(F.col("_r.score")))
    fields = [F.col(f"_r.{c}").alias(c) for c in ("reasoning", "signal_tags", "disqualifiers")]
    score = F.when(error.isNull(), F.col("_r.score")).try_cast("int")
    return replies.select(*keys, score.alias("score"), *fields, error.alias("error"))


def draft_with(
    prompts: DataFrame, completer: Completer, keys: Sequence[str] = ("lead_id",), *, as_of: Moment, store: str | None = None, batch: int = 16, tasks: int | None = None
) -> DataFrame:
    """Drafts by a completion function: ``keys, channel, subject, body, rationale, estimated_quality, error``.

    A lead whose call fails, or whose reply has no channel or body, gets an error and stays new.
    """
    replies = ledger_replies(prompts, completer, keys, as_of, store, batch, tasks).withColumn("_r", parse_draft(F.col("reply")))
    unread = F.when(~F.col("_r.parsed"), F.lit("unreadable reply"))
    partial = F.when(F.col("_r.channel").isNull() | F.col("_r.body").isNull(), F.lit("incomplete draft"))
    error = F.coalesce("error", unread, partial)
    texts = [F.col(f"_r.{c}").alias(c) for c in ("channel", "subject", "body", "rationale")]
    quality = F.col("_r.estimated_quality").try_cast("int").alias("estimated_quality")
    return replies.select(*keys, *texts, quality, error.alias("error"))
