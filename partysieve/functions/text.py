"""Text expressions shared by the rules. All stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMERIC_CHARS = " +-.0123456789"


def blank_to_null(c: Column) -> Column:
    """Trim spaces (only spaces, tabs stay) and turn an empty rest into NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def numeric_only(c: Column) -> Column:
    """Nothing is left after digits, sign, dot and space are deleted. True for NULL."""
    return F.coalesce(F.translate(c, _NUMERIC_CHARS, "") == "", F.lit(True))


def append_text(c: Column, text: str | Column) -> Column:
    """Append, treating NULL as empty."""
    return F.concat_ws("", c, text if isinstance(text, Column) else F.lit(text))


def is_like(c: Column, pattern: str) -> Column:
    """LIKE that is false, not NULL, for a NULL text."""
    return F.coalesce(c.like(pattern), F.lit(False))


def before_dash(c: Column) -> Column:
    """Text before the first dash, NULL where there is none."""
    at = F.instr(c, "-")
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1))


def pad_to_eight(c: Column) -> Column:
    """Last eight characters of the number with three zeros in front."""
    return F.substring(F.concat(F.lit("000"), c), -8, 8)


def folded(c: Column) -> Column:
    """Key for comparing descriptions: trimmed, upper case, NULL read as '-'."""
    return F.upper(blank_to_null(F.coalesce(c, F.lit("-"))))


def all_equal(values: Mapping[str, str]) -> Column:
    """Every named column has its value; true for an empty mapping."""
    cond = F.lit(True)
    for name, value in values.items():
        cond = cond & (F.col(name) == F.lit(value))
    return cond


def choose(c: Column, values: Mapping[str, str]) -> Column:
    """The value listed for the text, NULL where none is listed."""
    out = F.lit(None).cast("string")
    for key, value in reversed(list(values.items())):
        out = F.when(c == key, F.lit(value)).otherwise(out)
    return out
