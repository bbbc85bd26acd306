"""Tables in the folder that driver and executors share: they cut the lineage of iterative plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

#: Rows that one task of a chain of windows has, about: each of its sorts holds them once, so this bounds a task's memory at any size.
TASK_ROWS = 131_072

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a temporary folder if all runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="tracelake-")
    return _own[app]


def _scratch_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one."""
    return f"{shared_dir(spark)}/tracelake/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> None:
    """Delete all scratch tables of this application. Frames that were read from them can't be used any more, so this belongs behind the last
    use of a query's result; the end of a job is the place where nothing is in use."""
    drop_path(spark, _scratch_dir(spark))


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return fs.exists(where)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    fs, where = _path(spark, path)
    fs.delete(where, True)


def unsettle(*frames: DataFrame) -> None:
    """Delete the tables behind frames that ``settle`` returned and that nothing reads any more."""
    for df in frames:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            drop_path(df.sparkSession, path)


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back, which cuts the lineage: a lost executor costs a new read of it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *key: str | Column, rows: int | None = None) -> DataFrame:
    """``df`` dealt by ``key`` to so many tasks that each has about ``TASK_ROWS`` of its rows (counted, unless given). What comes after - windows,
    groups and further keys behind the same first ones - needs no other exchange. Few rows are left as they are: Spark deals them to all
    cores by itself. Left to itself Spark fills a task by shuffled bytes, of which narrow rows have few."""
    n = -(-(df.count() if rows is None else rows) // TASK_ROWS)
    return df if n <= df.sparkSession.sparkContext.defaultParallelism else df.repartition(n, *key)
