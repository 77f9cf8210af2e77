"""Physical layout of rows on their way to a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_SOURCE, _CURVE = "_source_partition", "_curve"
#: Ranges of a key, as a power of two, that the curve through several keys tells apart.
_RANGE_BITS = 8


def clustered(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``key``, so a key lookup touches few files and row groups.

    One key may hold a large share of all rows, so the source partition is the second
    range column: the rows of a hot key, exact copies included, spread over neighbouring
    partitions. The id of the source partition stays the same when a task is run again,
    which a random salt would not.
    """
    numbered = df.withColumn(_SOURCE, F.spark_partition_id())
    columns = [F.col(key), F.col(_SOURCE)]
    ranged = (
        numbered.repartitionByRange(partitions, *columns)
        if partitions
        else numbered.repartitionByRange(*columns)
    )
    return ranged.drop(_SOURCE).sortWithinPartitions(key)


def interleaved(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort along a curve through the ranges of several number keys.

    Each key is cut into ranges of about as many rows, and the bits of the ranges' numbers take
    turns in the sort key. So a file or row group has a small part of every key's values, and a
    lookup by any one of them skips most. Hot keys spread as in ``clustered``. Nulls are in the
    first range.
    """
    steps = [i / (1 << _RANGE_BITS) for i in range(1, 1 << _RANGE_BITS)]
    quantiles = df.agg(*(F.percentile_approx(key, steps, 10_000).alias(key) for key in keys)).first()
    curve = F.lit(0).cast("long")
    for place, key in enumerate(keys):
        number = _range_number(F.col(key), quantiles[key])
        for bit in range(_RANGE_BITS):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            curve = curve + F.shiftleft(one, bit * len(keys) + place)
    numbered = df.withColumn(_SOURCE, F.spark_partition_id()).withColumn(_CURVE, curve)
    columns = [F.col(_CURVE), F.col(_SOURCE)]
    ranged = numbered.repartitionByRange(*([partitions] if partitions else []), *columns)
    return ranged.sortWithinPartitions(_CURVE, *keys).drop(_CURVE, _SOURCE)


def _range_number(value: Column, bounds: list | None) -> Column:
    """How many of the ascending bounds are not above the value, by halving."""
    if bounds is None:  # no rows, or nulls only
        return F.lit(0)
    table = F.lit(bounds)
    number = F.lit(0)
    for bit in reversed(range(_RANGE_BITS)):
        further = F.get(table, number + ((1 << bit) - 1)) <= value
        number = number + F.when(further, 1 << bit).otherwise(0)
    return number
