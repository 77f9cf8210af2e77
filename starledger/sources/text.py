"""Delimited text files to typed rows.

Scanning and parsing are separate: the parsers take any DataFrame with a string
column ``value``. All work is column expressions over one narrow stage.

Modes, named after what happens to a malformed line:

* ``strict``: the job fails, whichever columns the query goes on to use;
* ``drop``: the line is left out;
* ``permissive``: the line comes back in ``_corrupt_record`` with NULL fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starledger.functions.fields import double_field, int_field, split_fields, trim_controls

CORRUPT = "_corrupt_record"
#: Where a line is from, if the scan says so: its file, and the first byte of the part of the
#: file that was read with it.
FILE, BLOCK = "_file", "_block_start"


def scan_lines(spark: SparkSession, path: str | list[str], located: bool = False) -> DataFrame:
    """Lines of a text file or folder, or of several, in a column ``value``.

    ``located`` adds where each line is from, in columns that permissive parsers keep.
    """
    lines = spark.read.text(path)
    if not located:
        return lines
    place = lambda name: F.col(f"_metadata.{name}")
    return lines.select("value", place("file_path").alias(FILE), place("file_block_start").alias(BLOCK))


def first_line(spark: SparkSession, path: str) -> DataFrame:
    """The first line of the first non-empty file, in path order; no row if there is none.

    Only file listings and the head of one file are read.
    """
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
    first = files.agg(F.min("path")).first()[0]
    lines = spark.read.text(first if first else path)
    # The filter keeps the answer right where a plan runs every split of the file.
    return lines.where("_metadata.file_block_start = 0").limit(1)


def parse_products(lines: DataFrame, trim: bool = True, mode: str = "strict") -> DataFrame:
    """``^``-separated product lines: fields 0, 1, 4, 5 and 6 of at least seven.

    Quotes have no meaning in this format and stay in the value.
    """
    clean = trim_controls if trim else (lambda text: text)
    field = lambda position: F.get("fields", F.lit(position))
    typed = _with_fields(lines, "^").select(
        "value",
        *_places(lines),
        int_field(field(0)).alias("productId"),
        clean(field(1)).alias("name"),
        clean(field(4)).alias("imageUrl"),
        clean(field(5)).alias("categories"),
        clean(field(6)).alias("tags"),
    )
    return _apply_mode(typed, mode, "product")


def parse_ratings(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """Comma-separated rating lines: the first four fields; further fields are ignored."""
    field = lambda position: F.get("fields", F.lit(position))
    typed = _with_fields(lines, ",").select(
        "value",
        *_places(lines),
        int_field(field(0)).alias("userId"),
        int_field(field(1)).alias("productId"),
        double_field(field(2)).alias("score"),
        int_field(field(3)).alias("timestamp"),
    )
    return _apply_mode(typed, mode, "rating")


def rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a ``permissive`` result into good rows and rejected lines.

    Lines of a located scan come with ``file`` and ``block_start``.
    """
    good = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT, FILE, BLOCK)
    bad = parsed.where(F.col(CORRUPT).isNotNull())
    places = [F.col(name).alias(name[1:]) for name in _places(parsed)]
    return good, bad.select(F.col(CORRUPT).alias("value"), *places)


def _places(rows: DataFrame) -> list[str]:
    return [name for name in (FILE, BLOCK) if name in rows.columns]


def _with_fields(lines: DataFrame, separator: str) -> DataFrame:
    return lines.select("value", split_fields(F.col("value"), separator).alias("fields"), *_places(lines))


def _apply_mode(typed: DataFrame, mode: str, what: str) -> DataFrame:
    places = _places(typed)
    names = [name for name in typed.columns if name not in ("value", *places)]
    # A field that is missing or cannot be read is NULL, and no valid field is.
    valid = F.lit(True)
    for name in names:
        valid = valid & F.col(name).isNotNull()
    if mode == "permissive":
        kept = [F.when(valid, F.col(name)).alias(name) for name in names]
        # A filter on what is rejected stays above the generator, so it does not repeat the parsing.
        typed = typed.select(F.inline(F.array(F.struct(*names))), "value", *places)
        return typed.select(*kept, F.when(~valid, F.col("value")).alias(CORRUPT), *places)
    if mode not in ("strict", "drop"):
        raise ValueError(f"unknown mode: {mode}")
    # inline() checks and projects in one go: the check cannot be pruned away with
    # unused columns, and no filter repeats the parsing below it.
    return typed.select(F.inline(_row_or(valid, names, mode, what)))


def _row_or(valid: Column, names: list[str], mode: str, what: str) -> Column:
    row = F.when(valid, F.array(F.struct(*names)))
    if mode == "drop":
        return row
    return row.otherwise(F.raise_error(F.concat(F.lit(f"malformed {what} line: "), "value")))
