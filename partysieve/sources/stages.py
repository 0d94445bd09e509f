"""Written intermediate results of a run."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"
#: Rows of a file at least, where it is known how many there will be.
LEAST_ROWS = 10_000
#: Bytes of a row group in stages of wide rows, and the columns that make a row wide. Each task's writer holds a row group in the
#: heap; with the usual 128 MB, tasks side by side that wrote rows of 55 columns ran out of it and ended the application.
ROW_GROUP, WIDE = 8 << 20, 20
#: How tables and stages of wide rows are compressed: smaller than Spark's default, at some CPU time.
CODEC = "zstd"
_local_root: tempfile.TemporaryDirectory | None = None  # removed when the process ends
_tried: dict[tuple[str, str], str] = {}
_making = Lock()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in the session, which executors in processes of their own must share with the driver.

    One in a machine's file system may be a mount that all share: it is taken if a trial shows that, and refused otherwise, for
    stages written elsewhere by each executor would be read as empty. Where none is named, a local master takes a temporary
    folder; local-cluster takes that or the warehouse, a cluster the warehouse, on the same condition.
    """
    root, master = spark.conf.get(_SETTING, None), spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return root.rstrip("/") if root else _temporary()
    if root:
        if _is_local(spark, root) and (why := _not_shared(spark, root)):
            raise ValueError(f"{_SETTING} is {root}, which is each machine's own folder: {why}")
        return root.rstrip("/")
    warehouse = spark.conf.get(_WAREHOUSE, None)
    for found in (_temporary() if master.startswith("local-cluster") else None, warehouse):
        if found and not (_is_local(spark, found) and _not_shared(spark, found)):
            return found.rstrip("/")
    raise ValueError(f"set {_SETTING} to a folder that every executor can reach; the warehouse, {warehouse}, is none")


def _temporary() -> str:
    global _local_root
    with _making:
        if _local_root is None:
            _local_root = tempfile.TemporaryDirectory(prefix="partysieve-", ignore_cleanup_errors=True)
        return _local_root.name


def _not_shared(spark: SparkSession, root: str) -> str:
    """Empty if the driver and other tasks find what tasks write to the folder, else what went wrong; tried once per application.

    There are two tasks for each core that has registered by then; a machine that comes later is not tried.
    """
    try:
        key = (spark.sparkContext.applicationId, root)
        if key not in _tried:
            trial, n = f"{root.rstrip('/')}/trial-{uuid.uuid4().hex}", 2 * spark.sparkContext.defaultParallelism
            spark.range(0, n, 1, n).write.parquet(trial)
            found = spark.read.schema("id BIGINT").parquet(trial).count()
            files, path = file_system(spark, trial)
            files.delete(path, True)
            _tried[key] = "" if found == n else f"of {n} rows that tasks wrote there, {found} are found"
        return _tried[key]
    except Exception as error:
        return f"a trial failed by {type(error).__name__}: {error}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its form."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()), found


def _is_local(spark: SparkSession, path: str) -> bool:
    files, _ = file_system(spark, path)
    return files.getUri().getScheme() == "file"


class StageArea:
    """A folder of Parquet stages, one sub-folder per stage.

    A stage cuts the plan, survives lost executors, and later passes over it read only
    the columns they need, which a checkpoint of whole rows would not allow.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or checkpoint_root(spark)}/run-{uuid.uuid4().hex}"
        self.rows: dict[str, int] = {}
        self.counted: dict[str, dict[str, int]] = {}
        self._paths: dict[str, str] = {}
        self.made: list[str] = []

    def new_path(self, name: str) -> str:
        """A folder for a stage; a name that comes again stands for the new one."""
        self._paths[name] = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        self.made.append(self._paths[name])
        return self._paths[name]

    def cut(self, df: DataFrame, name: str, counts: Mapping[str, Column] | None = None, rows: int | None = None) -> DataFrame:
        """Write the frame, note its row count, and return a frame that reads it.

        `counts` are conditions whose rows are counted in the same pass, into `counted`. `rows` is about how many there will be:
        few rows in very many partitions then go to fewer tasks and files, of LEAST_ROWS rows each.
        """
        if rows is not None:
            df = df.coalesce(max(1, rows // LEAST_ROWS))
        path = self.new_path(name)
        seen = Observation()
        more = [F.count_if(c).alias(k) for k, c in (counts or {}).items()]
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *more).write
        if len(df.columns) >= WIDE:
            writer = writer.option("parquet.block.size", ROW_GROUP).option("compression", CODEC)
        writer.parquet(path)
        found = dict(seen.get)
        self.rows[name] = found.pop("rows")
        self.counted[name] = found
        return self.read(name, df.schema)

    def read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._paths[name])

    def has(self, name: str) -> bool:
        """Whether the stage was written to its end and is still there."""
        files, path = file_system(self.spark, f"{self._paths.get(name, self.path)}/_SUCCESS")
        return files.exists(path)

    def drop(self, name: str) -> None:
        """Delete one stage, once nothing reads from it any more."""
        files, path = file_system(self.spark, self._paths.pop(name))
        files.delete(path, True)

    def keep(self, *names: str, since: int = 0) -> None:
        """Delete all stages but the last of each of these names, once nothing reads from the others any more.

        The first `since` of the stages made stay too.
        """
        kept = {*self.made[:since], *(self._paths[n] for n in names if n in self._paths)}
        for made in [m for m in self.made if m not in kept]:
            files, path = file_system(self.spark, made)
            files.delete(path, True)
            self.made.remove(made)
        self._paths = {n: p for n, p in self._paths.items() if p in kept}

    def settle(self, *names: str, since: int = 0) -> Callable[[DataFrame], DataFrame]:
        """For steps in a row: a function that writes a frame in place of all that it reads from, but the stages of these names."""

        def settled(df: DataFrame) -> DataFrame:
            out = self.cut(df, "settled")
            self.keep("settled", *names, since=since)
            return out

        return settled

    def clear(self) -> None:
        """Delete the folder, once nothing reads from it any more."""
        files, path = file_system(self.spark, self.path)
        files.delete(path, True)
