"""Column functions for delimited text, following JVM string rules.

Spark's own split, trim and casts differ from the JVM's in small ways (trailing
empty fields, which characters count as blank, which numbers are accepted).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# What the JVM's trim strips: every character up to and including the blank.
_BLANKS = "".join(chr(code) for code in range(0x21))


def split_fields(line: Column, separator: str) -> Column:
    """Split on a one-character separator; trailing empty fields do not count."""
    return F.split(F.rtrim(line, F.lit(separator)), re.escape(separator))


def trim_controls(text: Column) -> Column:
    """Strip blanks, tabs and control characters from both ends."""
    return F.trim(text, F.lit(_BLANKS))


def int_field(text: Column) -> Column:
    """Text to int. NULL unless it is only digits with an optional sign, within int32.

    The cast checks all but blanks at the ends, which it takes and the JVM does not. The
    first and last characters show those, far cheaper than a pattern would.
    """
    first_fits = (text >= "+") & (text < ":")
    last_fits = F.right(text, F.lit(1)).between("0", "9")
    return F.when(first_fits & last_fits, text.try_cast("int"))


def double_field(text: Column) -> Column:
    """Text to double. NULL where it is no JVM number.

    The cast takes ``inf`` and ``nan`` in any case; the JVM only knows ``Infinity`` and
    ``NaN``. No other number has an ``n``.
    """
    plain = ~(text.contains("n") | text.contains("N"))
    jvm_word = text.rlike(r"^[\x00-\x20]*[+-]?(?:Infinity|NaN)[\x00-\x20]*\z")
    return F.when(plain | jvm_word, text.try_cast("double"))


def multi_value(text: Column, separator: str = "|") -> Column:
    """``a|b|c`` to an array of its parts."""
    return F.split(text, re.escape(separator))
