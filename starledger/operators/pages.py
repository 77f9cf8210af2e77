"""Ranks of a whole board, and pages of it, without handing all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starledger.shared import new_folder, stored
from starledger.sources import Store, write_table

# monotonically_increasing_id: the partition's number, and so many bits for the row's.
_ROW_BITS = 33
_PLACE = "_place"


def ranked(board: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The board with ``rank`` from 1 in an order, which should leave no ties.

    The rows are sorted into ranges and stored; a rank is the row's number in its range and the
    sizes of the ranges before, of which there are as many as partitions.
    """
    spark = board.sparkSession
    rows = board.orderBy(*order).withColumn(_PLACE, F.monotonically_increasing_id())
    rows = stored(rows, new_folder(spark, "ranked"))
    part = F.shiftrightunsigned(_PLACE, _ROW_BITS)
    sizes = dict(rows.groupBy(part).count().collect())
    offsets, before = [], 0
    for number in sorted(sizes):
        offsets.append((number, before))
        before += sizes[number]
    starts = F.broadcast(spark.createDataFrame(offsets, "part long, before long"))
    placed = rows.withColumn("part", part).join(starts, "part")
    row = F.col(_PLACE).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.select(*board.columns, (F.col("before") + row + 1).alias("rank"))


def write_ranked(board: DataFrame, order: Sequence[Column | str], store: Store, name: str) -> None:
    """Store a board with its ranks, laid out so that a page of it is in a few row groups."""
    write_table(ranked(board, order), store, name, order_by=["rank"])


def page(spark: SparkSession, store: Store, name: str, first: int, last: int) -> DataFrame:
    """The rows of a stored board from rank ``first`` to ``last``, in order."""
    return store.load(spark, name).where(F.col("rank").between(first, last)).orderBy("rank")
