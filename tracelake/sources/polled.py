"""Blocks one after the other, no further than the leash allows: a streaming data source whose offsets are block numbers.

Landed documents of block n are lines of ``<landing>/<n // 10000>/<n>.json`` (``place``): no folder is listed, the next block's file is there or
isn't. Each trigger plans the next range as a batch of the service does: from the first block that was not begun, at most as many as the
leash has room for, up to the first block that has not landed, and with a limiter no further than the latest payload block it knows. An
incomplete block ``pending`` blocks behind stops the stream; when the block completes it goes on. What was begun and completed is read from
the progress table that the batches themselves append to, new files only. Offsets are in the stream's checkpoint, so a restart goes on (or
repeats the batch that was cut off) where it was.

    polled.register(spark)
    lines = spark.readStream.format("landed_blocks").options(landing=..., progress=..., processor="structlog", network="mainnet", pending=50).load()

Rows are (block_number, value), value being a line; ``documents`` parses them. Backwards the numbers fall, from the first stored block to 0.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FOLDER = 10_000
#: Blocks that may be begun beyond the oldest incomplete one, and blocks that one task reads.
PENDING, BLOCKS_A_TASK = 50, 16
LINES = 1_000


def place(landing: str, block: int) -> str:
    """Where a block's documents land."""
    return f"{landing.rstrip('/')}/{block // FOLDER}/{block}.json"


class _Folder:
    """New rows of a Parquet table that only gets files: each call gives those of files that were not read yet."""

    def __init__(self, path: str, columns: list[str]):
        self.fs, self.root = pafs.FileSystem.from_uri(path)
        self.columns, self.seen = columns, set()

    def new_rows(self) -> Iterator[dict]:
        for f in self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            if f.path.endswith(".parquet") and f.path not in self.seen and not any(p[:1] in "_." for p in f.path.removeprefix(self.root).strip("/").split("/")):
                yield from pq.read_table(f.path, columns=self.columns, filesystem=self.fs, partitioning=None).to_pylist()
                self.seen.add(f.path)


class Plan:
    """The next range of blocks, by what the progress table and the limiter say."""

    def __init__(self, options: dict):
        self.processor, self.network = options["processor"], options["network"]
        self.pending, self.step = int(options.get("pending", PENDING)), -1 if options.get("mode", "forwards") == "backwards" else 1
        self.start = int(options["start"]) if "start" in options else None
        self.progress = _Folder(options["progress"], ["updated_date_time", "block_number", "processor", "meta_network_name", "complete"])
        self.limits = _Folder(options["limiter"], ["slot_start_date_time", "execution_payload_block_number", "meta_network_name"]) if "limiter" in options else None
        self.limit, self.limit_at = 0, None
        self.latest: dict[int, tuple] = {}  # of blocks that the leash may still be held by: time and completion of the last row
        self.furthest: int | None = None

    def look(self) -> None:
        for r in self.progress.new_rows():
            if r["processor"] != self.processor or r["meta_network_name"] != self.network:
                continue
            block, version = r["block_number"], (r["updated_date_time"], r["complete"] or 0)
            if block not in self.latest or self.latest[block] <= version:
                self.latest[block] = version
            self.furthest = block if self.furthest is None else max(self.furthest * self.step, block * self.step) * self.step
        if self.furthest is not None and self.pending > 0:  # blocks further behind hold nothing any more
            self.latest = {b: v for b, v in self.latest.items() if (self.furthest + self.step - b) * self.step <= self.pending}
        for r in self.limits.new_rows() if self.limits else ():
            if r["meta_network_name"] == self.network and r["execution_payload_block_number"] is not None and (self.limit_at is None or r["slot_start_date_time"] >= self.limit_at):
                self.limit_at, self.limit = r["slot_start_date_time"], r["execution_payload_block_number"]

    def following(self) -> int:
        """The first block that was not begun: past the furthest stored one, or where the stream is told to start."""
        if self.furthest is not None:
            return self.furthest + self.step
        if self.start is not None:
            return self.start
        return max(self.limit - 1, 0)

    def room(self, block: int) -> int:
        """How many blocks may be begun from ``block`` on."""
        if self.pending <= 0:
            return FOLDER
        behind = [(block - b) * self.step for b, (_, complete) in self.latest.items() if not complete and 0 <= (block - b) * self.step <= self.pending]
        return self.pending - max(behind, default=0)

    def end(self, block: int, landed) -> int:
        """Past the last block of the next range from ``block`` on; the block itself if there is none. ``landed`` says whether a block is there."""
        n = 0
        while n < self.room(block):
            b = block + n * self.step
            if b < 0 or (self.limits is not None and self.step > 0 and b > self.limit) or not landed(b):
                break
            n += 1
        return block + n * self.step


class Blocks(InputPartition):
    def __init__(self, blocks: list[int]):
        super().__init__(tuple(blocks))
        self.blocks = blocks


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.landing = options["landing"]
        self.plan = Plan(options)
        self.reached: int | None = None  # the end of the last range that was planned

    def _landed(self, block: int) -> bool:
        fs, at = pafs.FileSystem.from_uri(place(self.landing, block))
        return fs.get_file_info(at).type == pafs.FileType.File

    def initialOffset(self) -> dict:
        self.plan.look()
        return {"next": self.plan.following()}

    def latestOffset(self) -> dict:
        self.plan.look()
        block = self.plan.following()
        if self.reached is not None:  # a range that was planned but that nothing noted
            block = max(block * self.plan.step, self.reached * self.plan.step) * self.plan.step
        self.reached = self.plan.end(block, self._landed)
        return {"next": self.reached}

    def partitions(self, start: dict, end: dict) -> list[Blocks]:
        step = self.plan.step
        self.reached = end["next"] if self.reached is None else max(self.reached * step, end["next"] * step) * step
        blocks = list(range(start["next"], end["next"], step))
        return [Blocks(blocks[i : i + BLOCKS_A_TASK]) for i in range(0, len(blocks), BLOCKS_A_TASK)]

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        for block in partition.blocks:
            fs, at = pafs.FileSystem.from_uri(place(self.landing, block))
            with fs.open_input_stream(at) as file:
                lines = [x for x in file.read().decode().split("\n") if x.strip()]
            for i in range(0, len(lines), LINES):
                part = lines[i : i + LINES]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int64()), pa.array(part, pa.string())], names=["block_number", "value"])


class LandedBlocks(DataSource):
    """Format ``landed_blocks``; options landing, progress, processor, network, and maybe pending (0 or less: no leash), mode ('forwards' or
    'backwards'), start (first block of an empty store) and limiter (a table of beacon slots)."""

    @classmethod
    def name(cls) -> str:
        return "landed_blocks"

    def schema(self) -> str:
        return "block_number long, value string"

    def streamReader(self, schema) -> _Stream:
        return _Stream(self.options)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    environment = spark.sparkContext.environment
    root, known = str(Path(__file__).resolve().parents[2]), environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    importable(spark)
    spark.dataSource.register(LandedBlocks)


def documents(lines: DataFrame, schema) -> DataFrame:
    """The documents of lines, with block_number as the source has it; a line that is none becomes a row of nulls but for that."""
    names = [f.name for f in schema if f.name != "block_number"]
    return lines.select("block_number", F.from_json("value", schema).alias("x")).select("block_number", *[f"x.{n}" for n in names])
