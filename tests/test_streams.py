"""Streams over several batches give what the batch form gives."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_state import ATTEMPT, START, attempts

from leadspark.operators import state
from leadspark.sources.tables import stream_records
from leadspark.streaming import compacted, streams


def land(df, folder, parts, order):
    """One file per part, landed in order."""
    import time

    for i in range(parts):
        part = df.filter(F.col("_part") == i).drop("_part").orderBy(*order).coalesce(1)
        part.write.mode("append").parquet(folder)
        time.sleep(0.05)
    return df.drop("_part").schema


def test_ingest_keeps_the_first_ever_over_batches(spark, folder):
    rows = spark.range(3000).selectExpr("'r' platform", "cast(id % 700 as string) external_id", "id scraped_at", "cast(id div 1000 as int) _part")
    schema = land(rows, f"{folder}/in", 3, ["scraped_at"])
    for _ in range(2):
        src = stream_records(spark, f"{folder}/in", schema, max_files=1, format="parquet")
        streams.run_available(streams.ingest_stream(src, f"{folder}/out", f"{folder}/state"))
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == 700 and out.agg(F.max("scraped_at")).first()[0] == 699


def test_ingest_probes_only_the_parts_it_touches(spark, folder):
    """The stored keys are read with a partition filter, and only their columns."""
    rows = spark.range(500).selectExpr("'r' platform", "cast(id as string) external_id", "id scraped_at", "'long text' body")
    streams.append_to_parts(rows, f"{folder}/t", parts=16)
    part = streams.key_part(["platform", "external_id"], 16)
    one = rows.union(rows.withColumn("external_id", F.concat("external_id", F.lit("-new")))).filter(part == 3)
    streams.append_to_parts(one, f"{folder}/t", parts=16)
    assert spark.read.parquet(f"{folder}/t").count() == 500 + one.filter("external_id like '%new'").count()
    held = streams.keys_in_parts(spark.read.parquet(f"{folder}/t"), [3], ["platform", "external_id"])
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "(key_part#" in plan.split("PartitionFilters: ")[1].split("]")[0] and "ReadSchema: struct<platform:string,external_id:string>" in plan
    files = {r.f for r in held.select(F.input_file_name().alias("f")).collect()}
    assert {f.split("key_part=")[1].split("/")[0] for f in files} == {"3"}


def test_ingest_raises_on_a_table_of_other_columns(spark, folder):
    rows = spark.range(5).selectExpr("'r' platform", "cast(id as string) external_id", "id scraped_at")
    rows.write.parquet(f"{folder}/t")
    with pytest.raises(ValueError, match="has the columns"):
        streams.append_to_parts(rows, f"{folder}/t")
    streams.append_to_parts(rows, f"{folder}/u")
    with pytest.raises(ValueError, match="has the columns"):
        streams.append_to_parts(rows.withColumn("more", F.lit(1)), f"{folder}/u")


def test_lookback_moves_with_the_stream(spark, folder):
    """The cutoff follows the greatest time so far; a repeated batch gives the same rows."""
    hour = lambda h: START + timedelta(hours=h)
    batches = [[0, 10, -20], [40, 15, 16, None], [20, 41], [39.99, 16, 17]]
    kept = [[0, 10], [40, 16], [20, 41], [39.99, 17]]
    for i, hours in enumerate(batches):
        rows = [(i, None if h is None else hour(h)) for h in hours]
        spark.createDataFrame(rows, "n int, at timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        for _ in range(2):
            src = stream_records(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema, format="parquet")
            streams.run_available(streams.moving_lookback(src, "at", f"{folder}/out", f"{folder}/state", 24))
    got = {(r.batch, r.at) for r in streams.fresh_rows(spark, f"{folder}/out").collect()}
    assert got == {(i, hour(h)) for i, hours in enumerate(kept) for h in hours}


def test_ingest_repeats_a_batch_safely(spark, folder):
    rows = spark.range(100).selectExpr("'r' platform", "cast(id as string) external_id", "id scraped_at", "0 _part")
    schema = land(rows, f"{folder}/in", 1, ["scraped_at"])
    for attempt in range(2):  # a new checkpoint reads the same files again
        src = stream_records(spark, f"{folder}/in", schema, format="parquet")
        streams.run_available(streams.ingest_stream(src, f"{folder}/out", f"{folder}/state{attempt}"))
    assert spark.read.parquet(f"{folder}/out").count() == 100


def test_failures_over_batches(spark, folder):
    rows = attempts(11)
    df = spark.createDataFrame(rows, ATTEMPT).withColumn("_part", F.floor(F.col("event_id") / 100))
    schema = land(df, f"{folder}/in", 4, ["event_id"])
    src = stream_records(spark, f"{folder}/in", schema, max_files=1, format="parquet")
    streams.run_available(streams.failure_stream(src, f"{folder}/folds", f"{folder}/state"))
    got = state.state_of(streams.newest_fold(spark, f"{folder}/folds")).collect()
    want = state.source_state(df.drop("_part")).collect()
    key = lambda r: r.source_id
    assert sorted(got, key=key) == sorted(want, key=key)


def test_late_failures_over_batches(spark, folder):
    """The newest attempts come first; a snapshot is written after every second batch."""
    rows = attempts(12)
    df = spark.createDataFrame(rows, ATTEMPT).withColumn("_part", 3 - F.floor(F.col("event_id") / 100))
    schema = land(df, f"{folder}/in", 4, ["event_id"])
    src = stream_records(spark, f"{folder}/in", schema, max_files=1, format="parquet")
    streams.run_available(streams.failure_stream(src, f"{folder}/folds", f"{folder}/state", every=2))
    assert sorted(state.state_of(streams.newest_fold(spark, f"{folder}/folds")).collect()) == sorted(state.source_state(df.drop("_part")).collect())


def test_compacted_batches(spark, folder):
    """A read touches the newest snapshot and the batches after it; a repeated batch changes nothing."""
    from leadspark.sources.folders import numbered

    fold = compacted.latest_of(["k"])
    batch = lambda i: spark.createDataFrame([(i % 3, i, {"n": i}), (9, i, None)], "k int, n int, m map<string,int>")
    expected = lambda n: {k: max(i for i in range(n) if i % 3 == k) for k in range(min(n, 3))} | {9: n - 1}
    for i in range(11):
        compacted.write_batch(batch(i), i, folder, fold, every=3)
        if i in (2, 8):
            compacted.write_batch(batch(i), i, folder, fold, every=3)
        rows = compacted.read_compacted(spark, folder, fold)
        assert {r.k: r.n for r in rows.collect()} == expected(i + 1)
        assert all(r.m == ({"n": r.n} if r.k != 9 else None) for r in rows.collect())
    assert numbered(spark, f"{folder}/snapshots", "upto") == [5, 8] and numbered(spark, f"{folder}/batches", "batch") == [6, 7, 8, 9, 10]
    read = {f.split("/")[-2] for f in compacted.read_compacted(spark, folder, fold).inputFiles()}
    assert read == {"upto=8", "batch=9", "batch=10"}


def test_only_a_missing_path_is_an_empty_table(spark, folder):
    from pyspark.errors import AnalysisException

    from leadspark.sources.folders import read_if_there

    assert read_if_there(spark, f"{folder}/none") is None
    spark.range(1).write.json(f"{folder}/empty/deeper")
    with pytest.raises(AnalysisException):
        read_if_there(spark, f"{folder}/empty")


def test_funnel_over_batches(spark, folder):
    day = lambda d: START + timedelta(days=d)
    posts = spark.createDataFrame([(day(i % 5), i % 3) for i in range(30)], "scraped_at timestamp, _part int")
    schema = land(posts, f"{folder}/posts", 3, ["scraped_at"])
    leads = spark.createDataFrame([(day(0), 75, "responded", 0), (day(0), 74, "converted", 0), (day(1), 90, "new", 1)], "scored_at timestamp, score int, status string, _part int")
    lead_schema = land(leads, f"{folder}/leads", 2, ["scored_at"])
    drafts = spark.createDataFrame([(day(0), day(1), "approved", 0), (day(1), None, "sent", 1)], "drafted_at timestamp, reviewed_at timestamp, status string, _part int")
    draft_schema = land(drafts, f"{folder}/drafts", 2, ["drafted_at"])
    read = lambda name, s: stream_records(spark, f"{folder}/{name}", s, max_files=1, format="parquet")
    counts = streams.funnel_stream(read("posts", schema), read("leads", lead_schema), read("drafts", draft_schema), late="30 days")
    streams.run_available(streams.upsert_by_batch(counts, f"{folder}/out", f"{folder}/state", ["starts_at", "stage"]))
    got = {(r.starts_at, r.stage): r.n for r in streams.latest_rows(spark, f"{folder}/out", ["starts_at", "stage"]).collect()}
    assert {k: v for k, v in got.items() if k[1] == "scraped"} == {(day(d), "scraped"): 6 for d in range(5)}
    assert got[(day(0), "scored")] == 2 and got[(day(0), "qualified")] == 1 and got[(day(1), "qualified")] == 1
    assert got[(day(0), "responded")] == got[(day(0), "converted")] == got[(day(1), "approved")] == 1
    assert (day(1), "sent") not in got and got[(day(1), "drafted")] == 1


def test_dedup_is_bounded_by_the_horizon(spark, folder):
    rows = spark.range(60).selectExpr("'r' platform", "cast(id % 20 as string) external_id", "timestamp_seconds(1700000000 + id) at", "cast(id div 20 as int) _part")
    schema = land(rows, f"{folder}/in", 3, ["at"])
    src = stream_records(spark, f"{folder}/in", schema, max_files=1, format="parquet")
    writer = streams.dedup_stream(src, "at", "1 day").writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
    streams.run_available(writer)
    assert spark.read.parquet(f"{folder}/out").count() == 20


def test_exact_phrases_go_to_the_hot_branch(spark, folder):
    rows = spark.createDataFrame([("1", "looking for tool", None, 0), ("2", "looking for tools", None, 0), ("3", None, None, 0)], "id string, title string, body string, _part int")
    schema = land(rows, f"{folder}/in", 1, ["id"])
    got = []
    for i in (0, 1):
        src = streams.hot_stream(stream_records(spark, f"{folder}/in", schema, format="parquet"), ["looking for tool"])[i]
        streams.run_available(src.writeStream.format("parquet").option("path", f"{folder}/out{i}").option("checkpointLocation", f"{folder}/state{i}"))
        got.append(sorted(r.id for r in spark.read.parquet(f"{folder}/out{i}").collect()))
    assert got == [["1"], ["2", "3"]]


def test_score_stream_replaces_a_repeated_batch(spark, folder):
    rows = spark.range(10).selectExpr("id", "0 _part")
    schema = land(rows, f"{folder}/in", 1, ["id"])
    for attempt in range(2):
        src = stream_records(spark, f"{folder}/in", schema, format="parquet")
        streams.run_available(streams.score_stream(src, lambda df: df.withColumn("score", F.lit(1)), f"{folder}/out", f"{folder}/state{attempt}"))
    assert spark.read.parquet(f"{folder}/out").count() == 10


def test_json_records_stream(spark, folder):
    spark.createDataFrame([('{"source":"reddit","external_id":"1","posted_at":"2024-01-30T00:00:00Z"}',)], "value string").write.text(f"{folder}/in")
    src = streams.lookback_stream(stream_records(spark, f"{folder}/in"), "posted_at", datetime(2024, 1, 31))
    streams.run_available(src.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state"))
    assert spark.read.parquet(f"{folder}/out").first().external_id == "1"
