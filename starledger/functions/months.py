"""Month keys of epoch seconds, as column functions and as SQL functions.

The month is taken in UTC, or in an explicit zone; it never depends on the
session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

_SECONDS_PER_DAY = 86400


def _local_date(seconds: Column | str, tz: str | None) -> Column:
    if isinstance(seconds, str):
        seconds = F.col(seconds)
    if tz is None:
        return F.date_from_unix_date(F.floor(seconds / _SECONDS_PER_DAY).cast("int"))
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc).cast("date")


def year_month(seconds: Column | str, tz: str | None = None) -> Column:
    """``yyyyMM`` as int; NULL in, NULL out."""
    date = _local_date(seconds, tz)
    return F.year(date) * 100 + F.month(date)


def year_month_text(seconds: Column | str, tz: str | None = None) -> Column:
    """``yyyyMM`` as text; NULL in, NULL out."""
    return year_month(seconds, tz).cast("string")


def register_month_functions(spark: SparkSession, tz: str | None = None) -> None:
    """Make ``changeDate(int)`` and ``yyyyMM(int)`` callable from SQL text, for UTC or ``tz``.

    They are SQL functions, so the optimizer inlines their bodies.
    """
    date = f"date_from_unix_date(cast(floor(seconds / {_SECONDS_PER_DAY}) as int))"
    if tz is not None:
        zone = tz.replace("\\", "\\\\").replace("'", "\\'")
        utc = "timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, seconds)"
        date = f"cast(convert_timezone('UTC', '{zone}', {utc}) as date)"
    number = f"year({date}) * 100 + month({date})"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(seconds INT) RETURNS INT "
        f"RETURN {number}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION yyyyMM(seconds INT) RETURNS STRING "
        f"RETURN cast({number} as string)"
    )
