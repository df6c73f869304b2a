"""Columns that must be evaluated once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns, behind a generator.

    A filter or projection further up would otherwise be moved below these columns and repeat
    their whole expressions; nothing moves them through a generator.
    """
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
