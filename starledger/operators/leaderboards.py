"""Leaderboards over ratings(userId, productId, score, timestamp).

Each is a grouped aggregate that Spark combines before the shuffle, so a product with a
large share of all ratings arrives as one partial row per task. The boards are complete
and ordered; ``productId`` breaks ties so that results repeat.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from starledger.functions.months import year_month
from starledger.shared import delete_folder, new_folder, stored


@dataclass(frozen=True)
class Leaderboards:
    popular: DataFrame
    popular_by_month: DataFrame
    top_rated: DataFrame
    folder: str | None

    def free(self) -> None:
        """Delete the stored counts; the boards are of no use afterwards."""
        if self.folder:
            delete_folder(self.popular.sparkSession, self.folder)


def popular(ratings: DataFrame) -> DataFrame:
    """Most rated products. Ratings without a product form a group that counts 0."""
    return _most_first(ratings.groupBy("productId").agg(F.count("productId").alias("count")))


def popular_by_month(
    ratings: DataFrame, tz: str | None = None, text_month: bool = False
) -> DataFrame:
    """Most rated products of each month, newest month first."""
    counts = ratings.groupBy("productId", year_month("timestamp", tz).alias("yearmonth")).agg(
        F.count("productId").alias("count")
    )
    return _newest_first(counts, text_month)


def top_rated(ratings: DataFrame) -> DataFrame:
    """Products by mean score. There is no minimum number of ratings."""
    return _best_first(ratings.groupBy("productId").agg(F.avg("score").alias("avg")))


def leaderboards(
    ratings: DataFrame, tz: str | None = None, text_month: bool = False
) -> Leaderboards:
    """All three boards from one pass over the ratings, which runs at once.

    Counts and score sums per product and month are stored; the boards are rolled up
    from those, which hold at most one row per product and month. ``Leaderboards.free``
    deletes them.
    """
    folder = new_folder(ratings.sparkSession, "boards")
    return boards_of(stored(monthly_counts(ratings, tz), folder), text_month, folder)


def monthly_counts(ratings: DataFrame, tz: str | None = None) -> DataFrame:
    """``schemas.RATING_COUNTS``: what all three boards follow from, per product and month."""
    return ratings.groupBy("productId", year_month("timestamp", tz).alias("yearmonth")).agg(
        F.count("productId").alias("count"),
        F.sum("score").alias("score_sum"),
        F.count("score").alias("score_count"),
    )


def merged_counts(counts: DataFrame, more: DataFrame) -> DataFrame:
    """The monthly counts of two sets of ratings together."""
    return counts.unionByName(more).groupBy("productId", "yearmonth").agg(
        *(F.sum(name).alias(name) for name in ("count", "score_sum", "score_count"))
    )


def boards_of(counts: DataFrame, text_month: bool = False, folder: str | None = None) -> Leaderboards:
    """The boards of monthly counts; ``folder`` is what ``Leaderboards.free`` deletes."""
    by_product = counts.groupBy("productId")
    mean = F.try_divide(F.sum("score_sum"), F.sum("score_count"))
    return Leaderboards(
        popular=_most_first(by_product.agg(F.sum("count").alias("count"))),
        popular_by_month=_newest_first(counts, text_month),
        top_rated=_best_first(by_product.agg(mean.alias("avg"))),
        folder=folder,
    )


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("userId").distinct()


def distinct_products(ratings: DataFrame) -> DataFrame:
    return ratings.select("productId").distinct()


def _most_first(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("count"), "productId")


def _newest_first(counts: DataFrame, text_month: bool) -> DataFrame:
    month = F.col("yearmonth")
    rows = counts.select(
        "productId", "count", (month.cast("string") if text_month else month).alias("yearmonth")
    )
    return rows.orderBy(F.desc("yearmonth"), F.desc("count"), "productId")


def _best_first(means: DataFrame) -> DataFrame:
    return means.orderBy(F.desc("avg"), "productId")
