"""Writing results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from partysieve.sources.stages import CODEC, file_system


def append_columns(df: DataFrame, columns: Sequence[str], target: str) -> None:
    """Append a subset of the columns to a staging table."""
    df.select(*columns).write.mode("append").parquet(target)


def clear_staging(spark: SparkSession, target: str) -> None:
    """Empty a staging table, keeping its columns."""
    kept = spark.read.parquet(target).schema
    spark.createDataFrame([], kept).write.mode("overwrite").parquet(target)


def publish(df: DataFrame, target: str) -> str:
    """Write a new version of a table next to its earlier ones.

    The plan may read the current version, so nothing is overwritten. A version counts once its
    write has left `_SUCCESS`; a half-written one is never read.
    """
    version = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
    df.write.mode("errorifexists").parquet(f"{target}/version={version}", compression=CODEC)
    return version


def versions(spark: SparkSession, target: str) -> list[str]:
    """The finished versions, oldest first, from the folder's listing."""
    files, path = file_system(spark, target)
    if not files.exists(path):
        return []
    names = [f.getPath().getName() for f in files.listStatus(path)]
    done = [n for n in names if n.startswith("version=") and files.exists(file_system(spark, f"{target}/{n}/_SUCCESS")[1])]
    return sorted(n.removeprefix("version=") for n in done)


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """The latest finished version; no other folder is opened."""
    found = versions(spark, target)
    if not found:
        raise FileNotFoundError(f"no finished version in {target}")
    return spark.read.parquet(f"{target}/version={found[-1]}")


def retain(spark: SparkSession, target: str, keep: int) -> None:
    """Delete all but the last `keep` finished versions, once nothing reads them any more."""
    if keep < 1:
        raise ValueError("keep at least one version")
    for version in versions(spark, target)[:-keep]:
        files, path = file_system(spark, f"{target}/version={version}")
        files.delete(path, True)
