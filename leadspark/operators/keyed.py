"""First, last and newest-n rows per key, key checks, and the key-respecting append."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from leadspark.session import keep

POST_KEY = ("platform", "external_id")

# Up to this n, Spark keeps only the first n rows per group in each task before the shuffle, in any session.
_PRUNED = 1000

#: Parts that a group is ranked in before it is ranked as a whole, beyond that n.
_PARTS = 64


def _ranked(df: DataFrame, by: Sequence[str | Column], order_by: Sequence[Column | str], n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order_by))
    return df.withColumn("_rn", rank).filter(F.col("_rn") <= n).drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in a stated order.

    The rank filter becomes a group limit on both sides of the shuffle, so a hot key sends one row per task.
    """
    return _ranked(df, keys, order_by, 1)


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key in a stated ascending order."""
    return _ranked(df, keys, [F.col(c).desc() for c in order_by], 1)


def _reached(df: DataFrame, group: Sequence[str], n: int, first: Column | str, leading: str) -> DataFrame:
    """The rows whose value of ``leading`` begins among the first n rows of their group.

    The values are counted when this is called, which sorts no rows; the few that the first n rows reach to are
    kept in the shared folder, so that Spark picks the join by their size.
    """
    by = [*group, leading]
    counts = df.groupBy(*by).agg(F.count("*").alias("_n")).withColumn("_part", F.pmod(F.xxhash64(leading), F.lit(_PARTS)))
    for within in ([*group, "_part"], group):
        before = F.sum("_n").over(W.partitionBy(*within).orderBy(first).rowsBetween(W.unboundedPreceding, -1))
        counts = counts.withColumn("_before", before).filter(F.coalesce("_before", F.lit(0)) < n)
    reached = keep(counts.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(by)]))
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(by)]
    return df.join(reached, reduce(lambda a, b: a & b, same), "left_semi")


def cap_per_group(
    df: DataFrame, group: Sequence[str], n: int = 50, order_by: Sequence[Column | str] = (), cap: int | None = None,
    leading: str | None = None,
) -> DataFrame:
    """The first ``min(n, cap)`` rows of each group.

    Each task prunes to n rows per group before the shuffle, so a hot group arrives as n rows per task. Beyond an n
    that every session prunes for, a group is ranked in parts first, so that no task holds a whole group; where
    ``leading`` names the column that ``order_by`` begins with, only rows down to the value that the first n rows
    reach are ranked at all, which is found by counting when this is called.
    """
    n = n if cap is None else min(n, cap)
    if n <= _PRUNED:
        return _ranked(df, group, order_by, n)
    if leading is not None:
        df = _reached(df, group, n, order_by[0], leading)
    parts = df.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(_PARTS)))
    return _ranked(_ranked(parts, [*group, "_part"], order_by, n).drop("_part"), group, order_by, n)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    parents = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(parents, fk, "left_anti")


def union_posts(*frames: DataFrame) -> DataFrame:
    """Posts of several platforms in one shape; columns a platform lacks are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def stored_keys(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``incoming`` that ``existing`` already holds.

    Only key columns are read. A batch small enough for an automatic broadcast leaves the stored
    table unshuffled; the result is no larger than the batch.
    """
    wanted = incoming.select(*keys)
    return existing.select(*keys).join(wanted, list(keys), "left_semi")


def append_new(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = POST_KEY,
    order_by: Sequence[Column | str] = ("scraped_at",),
) -> DataFrame:
    """Rows to append so that the first arrival of each key wins and stored rows stay as they are."""
    first = first_per_key(incoming, keys, order_by)
    return first.join(stored_keys(existing, incoming, keys), list(keys), "left_anti")
