"""Row-local operators: conditional update, copying and deleting rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partysieve.functions.text import append_text, is_like
from partysieve.operators.counts import copied, marks

TRACE = "rule_trace"


def rewrite_where(
    df: DataFrame, where: Column, sets: Mapping[str, Column], code: str | Column | None = None,
    rule: str | None = None,
) -> DataFrame:
    """Set columns on the rows that meet `where` and append `code` to their rule trace.

    All conditions and values are read from the row as it came in, and a NULL
    condition leaves the row alone. Values take the type of the column they replace.
    In a run that counts, the row also notes the `rule`.
    """
    changes = dict(sets)
    if code is not None:
        changes[TRACE] = append_text(F.col(TRACE), code)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        name: F.when(where, value.cast(types[name])).otherwise(F.col(name))
        for name, value in changes.items()
    } | (marks(df, {rule: where}) if rule else {}))


def copy_rows(df: DataFrame, where: Column, sets: Mapping[str, Column], rule: str | None = None) -> DataFrame:
    """Keep every row and add a changed copy of those that meet `where`.

    One pass: each row yields itself and, if selected, its copy. A union would read
    the input twice, and three chained ones eight times.
    """
    kept, both = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
    out = df.withColumn("_copy", F.explode(F.when(where, both).otherwise(kept)))
    return rewrite_where(out, F.col("_copy"), dict(sets) | (copied(df, rule) if rule else {})).drop("_copy")


def delete_marked(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Drop the rows whose text is like the pattern; rows without a text stay."""
    return df.where(~is_like(F.col(column), pattern))
