"""The leaderboards as SQL text over a view of ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starledger.functions.months import register_month_functions


def popular_sql(view: str) -> str:
    return f"""
        SELECT productId, count(productId) AS count
        FROM {view} GROUP BY productId ORDER BY count DESC, productId"""


def popular_by_month_sql(view: str, month_function: str = "changeDate") -> str:
    """``month_function`` is ``changeDate`` (int) or ``yyyyMM`` (text)."""
    return f"""
        SELECT productId, count(productId) AS count, {month_function}(timestamp) AS yearmonth
        FROM {view} GROUP BY productId, yearmonth
        ORDER BY yearmonth DESC, count DESC, productId"""


def top_rated_sql(view: str) -> str:
    return f"""
        SELECT productId, avg(score) AS avg
        FROM {view} GROUP BY productId ORDER BY avg DESC, productId"""


def register_ratings(ratings: DataFrame, view: str = "ratings", tz: str | None = None) -> None:
    """Name the ratings for SQL, with the month functions, in UTC or ``tz``, at hand."""
    ratings.createOrReplaceTempView(view)
    register_month_functions(ratings.sparkSession, tz)
