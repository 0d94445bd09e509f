"""A number for each row that stays the same, however often the rows are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Files whose offsets are broadcast, about 200 bytes each; beyond that they are joined by shuffle.
BROADCAST_FILES = 50_000
_FILE, _INDEX, _BEFORE = "_row_file", "_row_index", "_rows_before"


def numbered(df: DataFrame, column: str, cut: Callable[[DataFrame, str], DataFrame], name: str = "source") -> DataFrame:
    """Add a unique number for each row; any later read of the same files gives the same one.

    Rows of files are told by the file source's hidden columns: the number is the row's place in its
    file, after those of all files earlier by name. Only one row per file is written. Frames without these
    columns (JDBC, results of joins and aggregates) are written whole, and numbered as they are.
    """
    own = [F.col(f"`{c}`") for c in df.columns]
    try:
        placed = df.select(*own, F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_INDEX))
    except AnalysisException:
        return cut(df.withColumn(column, F.monotonically_increasing_id()), name)
    files = cut(placed.groupBy(_FILE).agg((F.max(_INDEX) + 1).alias("_n")), f"{name}-files")
    before = Window.orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    offsets = files.select(_FILE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_BEFORE))
    if files.count() <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, _FILE).select(*own, (F.col(_BEFORE) + F.col(_INDEX)).alias(column))
