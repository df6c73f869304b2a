"""Stored tables and record streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from leadspark import schemas as S
from leadspark.functions.times import Moment, moment_for, to_utc


#: The time by whose day the rows of a table are stored, and the order of the rows within a day.
STORED_BY: dict[str, tuple[str, tuple[str, ...]]] = {
    "raw_posts": ("scraped_at", ("platform", "external_id")),
    "leads": ("scored_at", ("status", "score")),
    "outreach_drafts": ("drafted_at", ("status", "drafted_at")),
    "heartbeats": ("beat_at", ("instance_id", "beat_at")),
    "logs": ("occurred_at", ("level", "occurred_at")),
    "sessions": ("started_at", ("kind",)),
}


def write_table(df: DataFrame, base: str, name: str) -> None:
    """Append rows to one of the model tables: with its columns and types, absent ones null, by day where it has a time.

    Days are evened out over the tasks, a large one over several, and rows lie in the order that the queues and
    reports look for them, so that files hold narrow ranges of it.
    """
    schema = S.TABLES[name]
    rows = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    path = f"{base.rstrip('/')}/{name}"
    if name not in STORED_BY:
        rows.write.mode("append").parquet(path)
        return
    time, order = STORED_BY[name]
    dealt = rows.withColumn("day", F.to_date(time)).hint("rebalance", "day")
    dealt.sortWithinPartitions("day", *order).write.mode("append").partitionBy("day").parquet(path)


def read_table(spark: SparkSession, base: str, name: str, since: Moment | None = None) -> DataFrame:
    """One of the model tables, with its fixed schema; with ``since``, rows from this moment on, of no earlier days."""
    schema = S.TABLES[name]
    rows = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{name}")
    if since is not None:
        time = STORED_BY[name][0]
        rows = rows.filter(F.col(time) >= moment_for(rows, time, since))
        if "day" in rows.columns:
            rows = rows.filter(F.col("day") >= F.lit(to_utc(since).date()))
    return rows.select(*schema.names)


def parse_records(lines: DataFrame, schema: T.StructType = S.POST_RECORD, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(records, malformed lines)`` of JSON lines; blank lines are neither.

    Only JSON objects are records: bare values such as ``null`` or ``0`` are malformed, and kept.
    """
    filled = lines.filter(F.length(F.trim(column)) > 0)
    wide = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = filled.select(F.col(column).alias("line"), F.from_json(F.col(column), wide, options).alias("r"))
    is_good = F.col("line").rlike(r"^\s*\{") & F.col("r").isNotNull() & F.col("r._bad").isNull()
    return parsed.filter(is_good).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields]), parsed.filter(~is_good).select("line")


def read_records(spark: SparkSession, path: str, schema: T.StructType = S.POST_RECORD) -> tuple[DataFrame, DataFrame]:
    """``(records, malformed lines)`` of the JSON-lines files at a path."""
    return parse_records(spark.read.text(path), schema)


def stream_records(
    spark: SparkSession, folder: str, schema: T.StructType = S.POST_RECORD, max_files: int | None = None, format: str = "json"
) -> DataFrame:
    """Records as they land in a folder, a bounded number of files at a time if asked."""
    reader = spark.readStream.schema(schema).format(format)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)
