"""Runs over array columns, built step by step.

Each step is a column of its own: an expression that two others use would otherwise be worked out twice, and twice
again at each further step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def shifted(values: str, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def add_runs(df: DataFrame, values: str, out: str, n: int, join) -> DataFrame:
    """Add ``out``: each value joined with the n - 1 after it, by doubling. The last n - 1 results are not whole."""
    columns = df.columns
    done, size, power, result = 0, 1, values, None
    while size <= n:
        if n & size:
            if result is None:
                result = power
            else:
                df = df.withColumn(f"_{out}_sum{size}", F.zip_with(result, shifted(power, done), join))
                result = f"_{out}_sum{size}"
            done += size
        if 2 * size <= n:
            df = df.withColumn(f"_{out}_{2 * size}", F.zip_with(power, shifted(power, size), join))
            power = f"_{out}_{2 * size}"
        size *= 2
    return df.select(*columns, F.col(result).alias(out))


def add_minima(df: DataFrame, values: str, out: str, n: int) -> DataFrame:
    """Add ``out``: the least of each value and the n - 1 after it, as far as there are any."""
    columns = df.columns
    low = lambda a, b: F.least(a, b)
    size, power = 1, values
    while 2 * size <= n:
        df = df.withColumn(f"_{out}_{2 * size}", F.zip_with(power, shifted(power, size), low))
        power, size = f"_{out}_{2 * size}", 2 * size
    last = F.col(power) if size == n else F.zip_with(power, shifted(power, n - size), low)
    return df.select(*columns, last.alias(out))
