"""Completion of blocks as keyed state: the tasks that finished, the number expected, and one timer from registration on.

State of a block, under its key (processor, network, block): a map of finished task ids to their event times, and one value with the time of
registration, the number of tasks expected and the number that count. Events of one batch are taken in the order of their event times,
registrations first. Nothing is kept of a block once it is complete or stale.

* A registration (no task_id) sets the number expected and the timer; tasks that finished before it belong to an earlier try and are
  forgotten. Registered again, a block begins anew, with a new timer. A number of 0 or less is complete at once.
* A finished task counts once. When the count reaches the number expected, the block is 'complete' and forgotten.
* ``stale_seconds`` of event time after registration the block is 'stale' and forgotten, however lately tasks came.
* Tasks of blocks that are not registered (late ones, or early ones) are kept for ``ttl_seconds`` from the first one on. Spark's own
  time-to-live runs on processing time only, so this is a timer as well, and replays give the same rows.

Events older than the watermark are dropped by Spark. Task ids are text; null event times are taken as the batch's watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEY = ["processor", "meta_network_name", "block_number"]
STALE_SECONDS, TTL_SECONDS = 300, 1800
#: The state store that keeps maps and timers.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Completion(StatefulProcessor):
    """Rows (key, status, completed, task_count) as blocks become 'complete' or 'stale'; with ``every``, also one 'open' a batch for each
    registered block whose count changed."""

    def __init__(self, stale_seconds: int, ttl_seconds: int, every: bool = False):
        self.stale, self.ttl, self.every = stale_seconds * 1000, ttl_seconds * 1000, every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tasks = handle.getMapState("tasks", "task_id string", "finished long")
        self.block = handle.getValueState("block", "registered long, expected long, completed long, timer long")

    def _forget(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.tasks.clear()
        self.block.clear()

    def _row(self, key, status: str, completed: int, expected: int) -> Row:
        return Row(processor=key[0], meta_network_name=key[1], block_number=key[2], status=status, completed=completed, task_count=expected)

    def _register(self, now: int, expected: int) -> tuple[int, int, int, int]:
        """The block's new value: tasks from ``now`` on count."""
        early = 0
        for (task,), (finished,) in list(self.tasks.iterator()):
            if finished < now:
                self.tasks.removeKey((task,))
            else:
                early += 1
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(now + self.stale)
        return now, expected, early, now + self.stale

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = max(timerValues.getCurrentWatermarkInMs(), 0)
        events = sorted(((mark if r["at"] is None else r["at"], r["task_id"] is not None, r["task_id"], r["task_count"]) for r in rows), key=lambda e: e[:2])
        block, changed = (tuple(self.block.get()) if self.block.exists() else None), False
        for at, is_task, task, count in events:
            if not is_task:
                if count is None or (block is not None and at < block[0]):
                    continue  # no number, or an older registration than the one that holds
                block, changed = self._register(at, count), True
            elif block is None:
                if not self.tasks.exists():
                    self.handle.registerTimer(at + self.ttl)
                if not self.tasks.containsKey((task,)):
                    self.tasks.updateValue((task,), (at,))
                continue
            elif at >= block[0] and not self.tasks.containsKey((task,)):
                self.tasks.updateValue((task,), (at,))
                block, changed = (*block[:2], block[2] + 1, block[3]), True
            if block[2] >= block[1]:
                self._forget()
                yield self._row(key, "complete", block[2], block[1])
                block, changed = None, False
        if block is not None:
            self.block.update(block)
            if self.every and changed:
                yield self._row(key, "open", block[2], block[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        block = tuple(self.block.get()) if self.block.exists() else None
        if block is not None and block[3] > expiredTimerInfo.getExpiryTimeInMs():
            return  # of an earlier registration
        self._forget()
        if block is not None:
            yield self._row(key, "stale", block[2], block[1])

    def close(self) -> None:
        pass


def completions(tasks: DataFrame, stale_seconds: int = STALE_SECONDS, ttl_seconds: int = TTL_SECONDS, every: bool = False, delay: str = "10 seconds") -> DataFrame:
    """(processor, meta_network_name, block_number, status, completed, task_count) of streamed events (event_time, key, task_id, task_count).
    Sets the session's state store to the one that keeps maps and timers."""
    tasks.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    events = tasks.withWatermark("event_time", delay).withColumn("at", F.unix_millis("event_time"))
    processor = Completion(stale_seconds, ttl_seconds, every)
    schema = "processor string, meta_network_name string, block_number long, status string, completed long, task_count long"
    return events.groupBy(*KEY).transformWithState(processor, schema, "Update" if every else "Append", "EventTime")
