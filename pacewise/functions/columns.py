"""Column-expression helpers. All built-in Spark expressions: they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewise.constants import AHEAD_AT, BEHIND_AT, USER_BUCKETS, USER_ID_PATTERN


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_day(ts: str | Column) -> Column:
    """``CAST(ts AS DATE)`` (H5); timestamps are UTC wall clock."""
    return col(ts).cast("date")


def utc_hour(ts: str | Column) -> Column:
    """``date_trunc('HOUR', ts)`` (H6). Spark returns an LTZ timestamp even for NTZ input,
    so it is cast back to the table's ``timestamp_ntz``."""
    return F.date_trunc("HOUR", col(ts)).cast("timestamp_ntz")


def user_bucket(user_id: str | Column, buckets: int = USER_BUCKETS) -> Column:
    """Partition transform ``bucket(n, user_id)`` (A9) as an explicit column.

    ``pmod(hash(.), n)``; a lookup literal must carry the column's exact type because the
    hash is type-sensitive.
    """
    return F.pmod(F.hash(col(user_id)), F.lit(buckets)).cast("int")


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0)`` as double (H12, H14): NULL instead of an ANSI divide error."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def count_when(cond: Column) -> Column:
    """``sum(CASE WHEN cond THEN 1 ELSE 0 END)`` (D1) as bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def any_true(cond: Column) -> Column:
    """``coalesce(bool_or(cond), false)``."""
    return F.coalesce(F.bool_or(cond), F.lit(False))


def pace_label(index: str | Column) -> Column:
    """Searched CASE (H13). A NULL index fails both tests and falls to ``on_track``."""
    idx = col(index)
    return (F.when(idx >= F.lit(AHEAD_AT), F.lit("ahead"))
            .when(idx <= F.lit(BEHIND_AT), F.lit("behind"))
            .otherwise(F.lit("on_track")))


def inclusive_days(end: str | Column, start: str | Column) -> Column:
    """``datediff(end, start) + 1`` (H7)."""
    return F.datediff(col(end), col(start)) + F.lit(1)


def seconds(n: int | Column) -> Column:
    """A day-time interval of ``n`` seconds."""
    return F.make_dt_interval(secs=n if isinstance(n, Column) else F.lit(n))


def is_valid_user_id(user_id: str | Column) -> Column:
    """Allow-list check (H20); ``\\A`` / ``\\z`` so a trailing newline is rejected."""
    return F.coalesce(col(user_id).rlike(USER_ID_PATTERN), F.lit(False))
