"""Helpers that several operators share."""

from __future__ import annotations

import base64
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starledger.shared import new_folder

#: A word of the contracts: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, prefix: str) -> DataFrame:
    """The rows, computed once and kept in the folder that all executors share.

    Later steps start from the stored rows, so losing executors does not repeat this work.
    """
    folder = new_folder(df.sparkSession, prefix)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def words_of(text: Column) -> Column:
    """The words of a text; none if it is null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def as_bytes(text: str | Column) -> Column:
    """A text's UTF-8 bytes, which Python workers take without decoding."""
    column = F.col(text) if isinstance(text, str) else text
    return column.cast("binary")


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the rows has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bits of a table that tells tasks which values there are: 8 MB, however many values.
TABLE_BITS = 26


def bit_table(number: Column, rows: DataFrame):
    """The table with the bits of the rows' numbers set, as bytes of which a number's eighth has it.

    Numbers are at least 0 and below ``2 ** TABLE_BITS``. Where there are too many of them the
    table is full, and says nothing more.
    """
    import numpy as np

    words = rows.select(number.alias("number")).groupBy(F.shiftrightunsigned("number", 6).alias("word"))
    table = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(number % 64 as int))")).alias("bits")).toArrow()
    bits = np.zeros(1 << TABLE_BITS - 6, np.int64)
    bits[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return bits.view(np.uint8)


def digest_number(key: str) -> Column:
    """The number of a binary digest in a table of bits: its first bits."""
    head = F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long")
    return F.shiftrightunsigned(head, 32 - TABLE_BITS)


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)],
        schema=schema,
    )


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()
