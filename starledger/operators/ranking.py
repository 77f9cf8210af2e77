"""Ranking of scored pairs (userId, productId, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Up to this rank Spark cuts each task's rows before the shuffle by itself
# (default of spark.sql.optimizer.windowGroupLimitThreshold).
_EARLY_CUT = 1000
_TASK = "_task"


def keep_positive(scored: DataFrame, above: float = 0.0) -> DataFrame:
    """Pairs scored strictly above a bound. NaN is not, though Spark sorts it above all."""
    return scored.where((F.col("score") > above) & ~F.isnan("score"))


def top_n(scored: DataFrame, n: int = 20, min_score: float | None = 0.0) -> DataFrame:
    """The best ``n`` pairs of each user, with their ``rank`` from 1.

    ``min_score=None`` ranks all pairs. A user with fewer pairs keeps those; one without
    any is absent. Equal scores rank by ``productId``.
    """
    if min_score is not None:
        scored = keep_positive(scored, min_score)
    if n > _EARLY_CUT:
        # Cut per user and task first, so that no task is handed all pairs of one user.
        scored = _best(scored.withColumn(_TASK, F.spark_partition_id()), n, "userId", _TASK)
        scored = scored.drop("rank", _TASK)
    return _best(scored, n, "userId")


def to_lists(ranked: DataFrame) -> DataFrame:
    """Ranked pairs as one row per user: ``recs``, best first."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "productId", "score")))
    return ranked.groupBy("userId").agg(F.transform(listed, _recommendation).alias("recs"))


def _recommendation(entry: Column) -> Column:
    return F.struct(
        entry["productId"].alias("productId"), entry["score"].cast("double").alias("score")
    )


def _best(scored: DataFrame, n: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "productId")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
