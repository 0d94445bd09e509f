"""Session settings that the plans rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles a method beyond 8000 bytes of bytecode. Rows of 55 columns
    # exceed that when a stage becomes one method; Spark then does better with the
    # operators' own, smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # What a job has shuffled goes when the job ends. Otherwise it stays until the driver happens to collect garbage, so that
    # the shuffles of all stages written so far, the derivation's among them, lie on the disks beside one another.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input with fewer splits than cores; leave larger inputs alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
