"""Moments, ages and windows relative to an explicit ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

Moment = datetime | str


def to_utc(as_of: Moment) -> datetime:
    """Naive UTC datetime of a datetime or ISO text; naive input already is UTC."""
    moment = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def moment(as_of: Moment, like: T.DataType, shift: timedelta = timedelta(0)) -> Column:
    """``as_of`` + ``shift`` as a literal of the compared column's own type.

    A literal of the same type keeps the cast off the column, so the comparison reaches the file scan.
    """
    text = (to_utc(as_of) + shift).isoformat(sep=" ", timespec="microseconds")
    if isinstance(like, T.TimestampNTZType):
        return F.lit(text).cast(T.TimestampNTZType())
    return F.lit(text + "+00:00").cast(T.TimestampType())


def moment_for(df: DataFrame, column: str, as_of: Moment, shift: timedelta = timedelta(0)) -> Column:
    return moment(as_of, df.schema[column].dataType, shift)


def later_than(df: DataFrame, column: str, as_of: Moment, back: timedelta) -> Column:
    """Strictly later than ``as_of`` minus ``back``."""
    return df[column] > moment_for(df, column, as_of, -back)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast(T.TimestampType()))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds as a double; either timestamp type."""
    return (micros(later) - micros(earlier)) / F.lit(1_000_000)


def seconds_before(as_of: Moment, ts: Column) -> Column:
    return seconds_between(moment(as_of, T.TimestampType()), ts)


def time_ago(ts: Column, as_of: Moment) -> Column:
    """``42s ago``, ``5m ago``, ``3h ago``, ``2d ago``; always rounded down."""
    age = F.floor(seconds_before(as_of, ts))

    def part(size: int, unit: str) -> Column:
        return F.concat(F.floor(age / F.lit(size)).cast("string"), F.lit(f"{unit} ago"))

    return (
        F.when(age < 60, part(1, "s"))
        .when(age < 3600, part(60, "m"))
        .when(age < 86400, part(3600, "h"))
        .when(age.isNotNull(), part(86400, "d"))
    )


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds, whole or fractional, to a timestamp."""
    return F.timestamp_seconds(seconds)


def iso_to_ts(text: Column) -> Column:
    """ISO 8601 text to a timestamp; null where it does not parse."""
    return text.try_cast(T.TimestampType())
