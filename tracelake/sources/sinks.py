"""Writers: idempotent partition overwrites of the tables, appends of progress rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.plans import store

#: Blocks in one partition folder, of every table.
BUCKET = 10_000
#: Blocks that one request may have processed again.
MOST_REQUEUED = 1_000
TRANSACTION = ["meta_network_name", "block_number", "transaction_hash"]


def write_table(df: DataFrame, path: str) -> None:
    """Overwrite the partitions (network, block bucket) that ``df`` has rows of; run again it leaves the same table."""
    out = df.withColumn("block_bucket", F.floor(F.col("block_number") / BUCKET).cast("long"))
    writer = out.repartition("meta_network_name", "block_bucket", F.col("block_number") % 16).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "zstd").partitionBy("meta_network_name", "block_bucket").parquet(path)


def replace_blocks(df: DataFrame, path: str, blocks: DataFrame) -> None:
    """Replace the given (meta_network_name, block_number) in a partitioned table: their partitions are read, the blocks exchanged, and
    rewritten. The first call makes the table. For tables that are corrected now and then; what grows all the time is ``versions``."""
    spark, by = df.sparkSession, TRANSACTION[:2]
    if not store.exists(spark, path):
        write_table(df, path)
        return
    stored = spark.read.schema(df.schema.add("block_bucket", "long")).parquet(path)
    touched = blocks.select("meta_network_name", F.floor(F.col("block_number") / BUCKET).cast("long").alias("block_bucket")).distinct()
    rest = stored.join(touched, ["meta_network_name", "block_bucket"], "left_semi").join(blocks.select(*by), by, "left_anti").drop("block_bucket")
    # what is overwritten must not be read at the same time; if the second write fails, the folder aside has all rows of its partitions
    aside = f"{path.rstrip('/')}__replaced-{uuid.uuid4().hex}"
    rest.unionByName(df.select(*rest.columns)).write.parquet(aside)
    write_table(spark.read.schema(rest.schema).parquet(aside), path)
    store.drop_path(spark, aside)


def requeue_blocks(blocks: DataFrame, known: DataFrame, recompute: Callable[[DataFrame], DataFrame], processor: str, path: str, progress: str, replace: Callable[[DataFrame, str, DataFrame], object] = replace_blocks) -> DataFrame:
    """Process the asked blocks (meta_network_name, block_number) again, for any processor's table: ``recompute`` gives their rows, which
    replace those in ``path`` (``replace`` of a versioned table is ``versions.write``). ``known`` has the blocks that there are, with task_count. Returns one row a block: status 'queued' or
    'failed', task_count and error. More than ``MOST_REQUEUED`` blocks in a request are an error."""
    block = TRANSACTION[:2]
    asked = blocks.select(*block).distinct()
    n = asked.limit(MOST_REQUEUED + 1).count()
    if n > MOST_REQUEUED:
        raise ValueError(f"a request has at most {MOST_REQUEUED} blocks")
    there = store.settle(asked.join(known.select(*block, "task_count"), block), "requeued")
    if not there.isEmpty():
        replace(recompute(there), path, there)
        append_progress(progress_rows(there, processor, 1), progress)
    out = asked.join(there, block, "left")
    found = F.col("task_count").isNotNull()
    return out.select(F.lit(processor).alias("processor"), *block, F.when(found, "queued").otherwise("failed").alias("status"), F.coalesce("task_count", F.lit(0).cast("long")).alias("task_count"), F.when(~found, "no such block").alias("error"))


def requeue_summary(results: DataFrame) -> DataFrame:
    """One row of totals of ``requeue_blocks``: total, queued, failed."""
    count = lambda s: F.sum((F.col("status") == s).cast("long"))
    return results.agg(F.count("*").alias("total"), F.coalesce(count("queued"), F.lit(0)).alias("queued"), F.coalesce(count("failed"), F.lit(0)).alias("failed"))


def progress_rows(blocks: DataFrame, processor: str, complete: int | None, now=None) -> DataFrame:
    """Version rows for (meta_network_name, block_number[, task_count]): begun (0), complete (1, no tasks) or asked for by hand (null)."""
    tasks = F.col("task_count").cast("long") if complete == 0 and "task_count" in blocks.columns else F.lit(0).cast("long")
    return blocks.select(
        (F.current_timestamp() if now is None else F.lit(now).cast("timestamp")).alias("updated_date_time"), F.col("block_number").cast("long").alias("block_number"), F.lit(processor).alias("processor"), "meta_network_name",
        F.lit(complete).cast("int").alias("complete"), (F.lit(None).cast("long") if complete is None else tasks).alias("task_count"),
    )


def append_progress(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
