"""Filter interaction audit: what each filter removes at each place of each order.

A set of filters is a state of the subset lattice, and applying one more is an edge; an order of
the filters is a path from the empty set to all. Documents are counted once by the set of filters
that they fail, and every figure of every order is then a figure of an edge: what the edge from
``state`` by ``filter`` removes does not depend on the order in which ``state`` was reached.
Counting the paths forward to each state and backward from it gives the number of orders that
use an edge, which weights its removals in a filter's Shapley value; the steps of an order read
the same edges.

Only the filters' failures touch texts, in one pass. What is shuffled besides is a narrow row
per document, and sums that combine before the shuffle, so a part with most of the documents
costs as many rows as there are sets of filters.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from starledger.llm.common import as_bytes, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The filters, by the bits of a set of them: too short, too few different words, too many
#: capitals, a forbidden character, a copy.
FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
FORBIDDEN = b"#$%&*|"

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point


def filter_failures(
    docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """``id``, ``part`` and ``failed`` of every row: the set of filters it fails, as bits.

    Bit 0 is filter A. A null text is an empty one, a null part the empty string. A row is a copy
    (E) if a row with a smaller id has the same text, compared by SHA-256; null ids are neither
    smaller nor greater than others, and rows that repeat both id and text are no copies of each
    other. Other columns are not read; an empty table gives no rows.
    """
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), as_bytes(text).alias("text")
    )
    judged = rows.mapInArrow(_judge, f"id {kind}, part string, failed int, digest binary")
    judged = stored(judged, "filter-failures")
    first = judged.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"))
    # Both columns are the key: the copies of a text spread over the tasks by their ids.
    marked = judged.join(first.withColumn("first", F.lit(True)), ["digest", "id"], "left")
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), F.lit(1 << FILTERS.index("E")))
    return marked.select("id", "part", (F.col("failed") + F.coalesce(copy, F.lit(0))).alias("failed"))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        failed, digests = [], []
        for text in rows.column(2):
            body = text.as_py() or b""
            failed.append(_failed(body))
            digests.append(hashlib.sha256(body).digest())
        columns = [rows.column(0), rows.column(1), pa.array(failed, pa.int32()), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "part", "failed", "digest"])


def _failed(text: bytes) -> int:
    """The filters but E that a text fails."""
    words = text.split()  # of bytes: at the six ASCII white-space characters
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUATION))
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words),
        100 * capitals > MOST_CAPITALS_PERCENT * points,
        len(text.translate(None, FORBIDDEN)) < len(text),
    )
    return sum(1 << bit for bit, fail in enumerate(fails) if fail)


def order_counts(n: int) -> tuple[list[int], list[int]]:
    """Of each set of ``n`` filters: the orders in which it is reached, and left to the end."""
    whole = (1 << n) - 1
    reach, leave = [0] * (whole + 1), [0] * (whole + 1)
    reach[0] = leave[whole] = 1
    for state in range(whole + 1):
        for bit in range(n):
            if not state >> bit & 1:
                reach[state | 1 << bit] += reach[state]
    for state in reversed(range(whole + 1)):
        for bit in range(n):
            if state >> bit & 1:
                leave[state ^ 1 << bit] += leave[state]
    return reach, leave


def audit(failures: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Of each part, order of the filters and step, what the step does, all zeros included.

    ``failures`` has ``part``, ``failed`` (bits, as above, null for none), and the booleans
    ``good`` and ``toxic`` (null: false). The result has ``part``, ``filter_order``, ``step``
    from 1, and counts of rows: ``kept`` after the step, ``removed`` by it, ``redundant`` (failing
    its filter, removed earlier), ``unique_fails`` (failing its filter only), ``good_lost`` and
    ``toxic_lost`` among the removed, ``shapley`` (the removals of its filter in all orders,
    summed). A part without rows has none in the result. Six filters at most, so that the
    lattice, which goes to all tasks, is small.
    """
    if not 0 < len(filters) <= 6 or len(set(filters)) < len(filters):
        raise ValueError("one to six different filters")
    spark = failures.sparkSession
    count = lambda flag: F.coalesce(F.sum(F.col(flag).cast("long")), F.lit(0))
    sets = failures.groupBy("part", F.coalesce("failed", F.lit(0)).alias("failed")).agg(
        F.count(F.lit(1)).alias("n"), count("good").alias("good"), count("toxic").alias("toxic")
    )
    total = lambda role, value="n": F.sum(F.when(F.col(role), F.col(value)).otherwise(0))
    edges = sets.join(F.broadcast(_edges(spark, len(filters))), "failed")
    edges = edges.groupBy("part", "state", "filter", "orders").agg(
        total("keeps").alias("kept"),
        total("removes").alias("removed"),
        total("redundant").alias("redundant"),
        total("only").alias("unique_fails"),
        total("removes", "good").alias("good_lost"),
        total("removes", "toxic").alias("toxic_lost"),
    )
    filter_edges = Window.partitionBy("part", "filter")
    edges = edges.withColumn("shapley", F.sum(F.col("orders") * F.col("removed")).over(filter_edges))
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    steps = F.broadcast(_steps(spark, filters))
    return edges.join(steps, ["state", "filter"]).select("part", "filter_order", "step", *counts)


def _edges(spark: SparkSession, n: int) -> DataFrame:
    """For each edge and each set of failed filters, what the edge does with such rows."""
    reach, leave = order_counts(n)
    rows = []
    for state in range(1 << n):
        for bit in range(n):
            one = 1 << bit
            if not state & one:
                orders = reach[state] * leave[state | one]
                for failed in range(1 << n):
                    hit, gone = bool(failed & one), bool(failed & state)
                    rows.append((failed, state, bit, orders, not hit and not gone, hit and not gone, hit and gone, failed == one))
    schema = "failed int, state int, filter int, orders long, keeps boolean, removes boolean, redundant boolean, only boolean"
    return spark.createDataFrame(rows, schema)


def _steps(spark: SparkSession, filters: str) -> DataFrame:
    """The edge of every step of every order."""
    rows = []
    for order in permutations(range(len(filters))):
        name, state = "".join(filters[bit] for bit in order), 0
        for step, bit in enumerate(order, 1):
            rows.append((name, step, state, bit))
            state |= 1 << bit
    return spark.createDataFrame(rows, "filter_order string, step int, state int, filter int")
