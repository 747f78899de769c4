"""Column functions.  All are built from JVM-side expressions and keep null as null."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def token(value, separator: str, position: int) -> Column:
    """The ``position``-th (from 1) token; null past the end.

    A trailing empty token counts as absent, an empty one in the middle does not.
    """
    separator = re.escape(separator)
    whole = F.regexp_replace(F.nullif(_col(value), F.lit("")), separator + "$", "")
    return F.get(F.split(whole, separator, -1), F.lit(position - 1))


def strip_csv(value) -> Column:
    """Text before the first ``csv`` and the character in front of it, whatever that is."""
    return F.get(F.split(_col(value), ".csv", -1), F.lit(0))


def replace_first(value, wanted: str, replacement: str) -> Column:
    """Replace only the first occurrence of a fixed text."""
    pattern = "(?s)^(.*?)" + re.escape(wanted)
    escaped = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_col(value), pattern, "$1" + escaped)


def glue(*values, separator: str = "") -> Column:
    """Concatenate; null if any part is null (``concat_ws`` would skip nulls)."""
    parts: list[Column] = []
    for index, value in enumerate(values):
        if index and separator:
            parts.append(F.lit(separator))
        parts.append(_col(value))
    return F.concat(*parts)


def if_else(condition: Column, yes, no) -> Column:
    """Two-way choice where an unknown condition gives an unknown result."""
    return F.when(condition, yes).when(~condition, no)


def to_number(value) -> Column:
    """Text to double; anything that is not a number becomes null, NaN included."""
    number = _col(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def missing_to_null(value) -> Column:
    """Treat NaN and the texts ``NA``, ``NaN`` and blank as missing."""
    text = _col(value).cast("string")
    return F.when(~F.trim(text).isin("", "NA", "NaN"), text)


def to_date_dmy(value) -> Column:
    """Text such as ``5Sep2018`` to a date; null if it is not one."""
    return F.try_to_date(_col(value), "dMMMyyyy")


def days_between(start, end) -> Column:
    return F.datediff(_col(end), _col(start))


def divide(numerator, denominator) -> Column:
    """Division that gives null instead of failing on zero."""
    return F.try_divide(_col(numerator), _col(denominator))


def finite(value) -> Column:
    """Null for NaN and both infinities."""
    number = _col(value)
    bad = F.isnan(number) | (F.abs(number) == F.lit(float("inf")))
    return F.when(~bad, number)


def even_steps(low, high, count: int) -> Column:
    """``count`` evenly spaced values from ``low`` to ``high`` as an array."""
    low, high = _col(low), _col(high)
    steps = F.sequence(F.lit(0), F.lit(count - 1))
    return F.transform(steps, lambda i: low + i * (high - low) / F.lit(float(count - 1)))


def labelled_part(label: str, value) -> Column:
    """``"label: value, "`` or an empty text when the value is missing."""
    return F.coalesce(F.concat(F.lit(f"{label}: "), _col(value), F.lit(", ")), F.lit(""))


def hashed_uniform(*parts) -> Column:
    """A repeatable number in (0, 1) from the md5 of the parts.

    It depends on values only, not on partitioning, so a retried task draws the
    same numbers.
    """
    text = F.concat_ws("|", *[_col(part).cast("string") for part in parts])
    whole = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double")
    return (whole + 0.5) / F.lit(float(16**12))


def standard_normal(*parts) -> Column:
    """A repeatable standard normal number (Box-Muller on two hashed uniforms)."""
    first = hashed_uniform(*parts, F.lit("u"))
    second = hashed_uniform(*parts, F.lit("v"))
    return F.sqrt(F.lit(-2.0) * F.ln(first)) * F.cos(F.lit(2 * math.pi) * second)
