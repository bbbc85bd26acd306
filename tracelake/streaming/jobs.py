"""Streaming jobs. A trace arrives whole, in one record, so each micro-batch runs the batch plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracelake.plans import store
from tracelake.plans import traces as plans
from tracelake.plans.transactions import transaction_table
from tracelake.sources import polled, readers, schemas, sinks, versions
from tracelake.streaming.completion import STALE_SECONDS, TTL_SECONDS, completions


def process_batch(traces: DataFrame, transactions: Callable[[DataFrame], DataFrame], tables: dict[str, str], progress: str, counts: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """One batch of landed traces: mark its blocks begun, add their transactions' rows to the tables as a new version, mark blocks complete
    of which all transactions are stored, from this batch and earlier ones. Run again (same batch, restart, duplicates) it leaves the same
    tables, as ``versions.read`` shows them, and one more pair of progress versions; what is written is in proportion to the batch.

    ``transactions`` gives to_address for trace headers; ``tables`` has the paths of 'structlog' and 'structlog_agg'. ``counts`` gives
    task_count, the transactions a block has, for blocks (meta_network_name, block_number); blocks that it doesn't know stay open. Traces
    don't tell this number: without ``counts`` a block is complete while all transactions up to its highest stored index are there, and
    open again when a later trace of it begins. The tables' own logs say which transactions are stored.
    """
    spark = traces.sparkSession
    traces = traces.dropDuplicates(sinks.TRANSACTION).persist()
    block = sinks.TRANSACTION[:2]
    try:
        if traces.isEmpty():
            return
        headers = transactions(readers.trace_headers(traces))
        flat = readers.flatten_traces(traces)
        landed = traces.select(*sinks.TRANSACTION, "transaction_index")
        blocks = landed.select(*block).distinct()
        known = None if counts is None else blocks.join(counts(blocks).select(*block, "task_count"), block, "left").persist()
        for name, plan in (("structlog", plans.opcode_table), ("structlog_agg", plans.frame_agg_table)):
            if name in tables:
                # the batch's own rows count for task_count before they are stored
                begun = known if known is not None else _highest(landed, tables[name])
                sinks.append_progress(sinks.progress_rows(begun, name, 0), progress)
                versions.write(plan(flat, headers), tables[name], landed)
                done = versions.done_transactions(spark, tables[name], blocks)
                done = done.withColumn("task_count", F.col("last_index") + 1) if known is None else done.join(known, block)
                sinks.append_progress(sinks.progress_rows(done.where("done >= task_count"), name, 1), progress)
        if known is not None:
            known.unpersist()
    finally:
        traces.unpersist()


def _highest(landed: DataFrame, table: str) -> DataFrame:
    """Blocks with task_count by the highest transaction index of this batch and of what is stored."""
    block = sinks.TRANSACTION[:2]
    now = landed.groupBy(*block).agg((F.max("transaction_index") + 1).alias("task_count"))
    before = versions.done_transactions(landed.sparkSession, table, now)
    return now.join(before, block, "left").select(*block, F.greatest("task_count", F.col("last_index") + 1).alias("task_count"))


def stream_traces(spark: SparkSession, landing: str, transactions: Callable[[DataFrame], DataFrame], tables: dict[str, str], progress: str, checkpoint: str, files_a_batch: int = 1000, counts: Callable[[DataFrame], DataFrame] | None = None, **trigger) -> StreamingQuery:
    """Process trace files as they land in ``landing``."""
    source = spark.readStream.schema(schemas.TRACE).option("maxFilesPerTrigger", files_a_batch).json(landing)
    writer = source.writeStream.foreachBatch(lambda df, _: process_batch(df, transactions, tables, progress, counts)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def follow_blocks(lines: DataFrame, transactions: Callable[[DataFrame], DataFrame], tables: dict[str, str], progress: str, checkpoint: str, counts: Callable[[DataFrame], DataFrame] | None = None, **trigger) -> StreamingQuery:
    """Process the traces of a ``landed_blocks`` stream (``polled``): its batches note their blocks in ``progress``, which its leash reads."""

    def batch(df: DataFrame, _: int) -> None:
        process_batch(polled.documents(df, schemas.TRACE).where("transaction_hash is not null"), transactions, tables, progress, counts)

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()


def backfill(spark: SparkSession, landing: str, transactions, tables: dict[str, str], progress: str, first: int, last: int, counts: Callable[[DataFrame], DataFrame] | None = None, step: int | None = None) -> None:
    """A bounded batch job over the traces of a block range: all at once, or from the highest blocks down, ``step`` blocks at a time, so
    that what is newest is there first."""
    traces = spark.read.schema(schemas.TRACE).json(landing)
    for high in range(last, first - 1, -(step or last - first + 1)):
        low = first if step is None else max(first, high - step + 1)
        process_batch(traces.where(F.col("block_number").between(low, high)), transactions, tables, progress, counts)


def process_blocks(transactions: DataFrame, receipts: DataFrame, table: str, progress: str, fallback: DataFrame | None = None) -> None:
    """One batch of landed blocks for the transaction table: their rows become those blocks' new version, and blocks with all receipts become
    complete; a block that lacks one stays open. Run again it leaves the same table, as ``versions.read`` shows it. Blocks without
    transactions are not in the input."""
    block = sinks.TRANSACTION[:2]
    rows = store.settle(transaction_table(transactions, receipts, fallback), "transactions")
    landed = transactions.groupBy(*block).agg(F.count("*").alias("task_count"))
    sinks.append_progress(sinks.progress_rows(landed, "transaction", 0), progress)
    done = rows.select(*block).distinct()
    versions.write(rows, table, done)
    sinks.append_progress(sinks.progress_rows(done, "transaction", 1), progress)
    store.unsettle(rows)


def completion_with_timeout(tasks: DataFrame, stale_seconds: int = STALE_SECONDS, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """(processor, network, block, status, completed, task_count) of streamed events (event_time, block key, task_id, task_count): a row with
    a task_id is a finished task, one without registers the expected count. A row once a block is 'complete', or 'stale' when
    ``stale_seconds`` of event time pass after its registration without completion; see ``completion``."""
    return completions(tasks, stale_seconds, ttl_seconds)
