"""Traces from a host that has them at hand, without files in between: a batch data source over a ``Provider``.

A provider knows the first and the last of its blocks and gives the opcode rows of a block range as Arrow batches. The source cuts the range
into partitions of ``step`` blocks, so the host is asked from many tasks at once; only ranges with asked blocks become partitions. Rows have
the columns of ``EMBEDDED``: what a tracer inside the host computes (gas_used, call_to_address, mem_size, call_transfers_value,
ext_code_copy_size) and no stack. A provider may leave columns out, and whether a trace has a tracer's values is found per trace by the
operators, so embedded and other traces can be unioned.

Blocks and networks are asked for by options, not by pushed filters: Spark 4.1 keeps one reader for all scans of a loaded frame, so with
filters pushed to it ``df.where("block_number < 10").union(df)`` would read the first ten blocks twice.

    read_embedded_traces(spark, "host:8545", "package.module:Class", first=2_000, last=2_999)
"""

from __future__ import annotations

from collections.abc import Iterator
from importlib import import_module
from typing import Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tracelake.sources import polled

#: Columns of embedded traces.
EMBEDDED = (
    "meta_network_name string, block_number long, transaction_hash string, transaction_index long, idx long, op string, gas long, gas_cost decimal(20,0), gas_used long, depth int, return_data string, refund long, error string, "
    "call_to_address string, mem_size long, call_transfers_value boolean, ext_code_copy_size long"
)
STEP = 1_000
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "decimal(20,0)": pa.decimal128(20, 0)}
ARROW = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split(" ", 1) for c in EMBEDDED.split(", "))])


class Provider(Protocol):
    """What a host implements. It is made anew in each task, from the option ``source``."""

    def blocks(self) -> tuple[int, int] | None:
        """The first and the last block that there are; none if there are none."""

    def read(self, first: int, last: int, networks: set[str] | None) -> Iterator[pa.RecordBatch]:
        """The opcode rows of blocks first to last (of these networks, if given), of any columns of ``EMBEDDED``."""


class FolderProvider:
    """A provider over a folder of Parquet files in folders ``block_range=<k>``, each with the blocks k*STEP to (k+1)*STEP - 1."""

    def __init__(self, folder: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)

    def _ranges(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(self.root, allow_not_found=True))
        return sorted(int(f.base_name.partition("=")[2]) for f in found if f.base_name.startswith("block_range="))

    def blocks(self) -> tuple[int, int] | None:
        ranges = self._ranges()
        return (ranges[0] * STEP, (ranges[-1] + 1) * STEP - 1) if ranges else None

    def read(self, first: int, last: int, networks: set[str] | None) -> Iterator[pa.RecordBatch]:
        for k in range(first // STEP, last // STEP + 1):
            at = f"{self.root}/block_range={k}"
            if self.fs.get_file_info(at).type == pafs.FileType.NotFound:
                continue
            asked = (ds.field("block_number") >= first) & (ds.field("block_number") <= last)
            asked = asked if networks is None else asked & ds.field("meta_network_name").isin(sorted(networks))
            yield from ds.dataset(at, filesystem=self.fs, format="parquet").to_batches(filter=asked)


def write_folder(traces: DataFrame, folder: str) -> None:
    """Write opcode rows as ``FolderProvider`` reads them."""
    names = [c.split()[0] for c in EMBEDDED.split(", ") if c.split()[0] in traces.columns]
    kinds = dict(c.split(" ", 1) for c in EMBEDDED.split(", "))
    rows = traces.select(*[F.col(c).cast(kinds[c]).alias(c) for c in names]).withColumn("block_range", F.floor(F.col("block_number") / STEP).cast("long"))
    rows.repartition("block_range", F.col("block_number") % 16).sortWithinPartitions("block_number").write.partitionBy("block_range").parquet(folder)


class BlockRange(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.provider, self.source, self.step = options.get("provider", f"{__name__}:FolderProvider"), options["source"], int(options.get("step", STEP))
        self.first, self.last = (int(options[k]) if k in options else None for k in ("first", "last"))
        self.only = {int(b) for b in options["blocks"].split(",") if b} if "blocks" in options else None
        self.networks = set(filter(None, options["networks"].split(","))) if "networks" in options else None

    def _host(self) -> Provider:
        module, _, name = self.provider.partition(":")
        return getattr(import_module(module), name)(self.source)

    def partitions(self) -> list[BlockRange]:
        there = self._host().blocks()
        if there is None or self.networks == set():
            return []
        first = there[0] if self.first is None else max(there[0], self.first)
        last = there[1] if self.last is None else min(there[1], self.last)
        if self.only is None:
            starts = range(first - first % self.step, last + 1, self.step) if first <= last else ()
        else:
            starts = sorted({b - b % self.step for b in self.only if first <= b <= last})
        return [BlockRange(max(k, first), min(k + self.step - 1, last)) for k in starts]

    def read(self, partition: BlockRange) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing is asked for
            return
        only = None if self.only is None else pa.array(sorted(b for b in self.only if partition.first <= b <= partition.last), pa.int64())
        for batch in self._host().read(partition.first, partition.last, self.networks):
            table = pa.Table.from_batches([batch])
            table = table if only is None else table.filter(pc.is_in(table.column("block_number"), only))
            columns = [table.column(f.name).cast(f.type) if f.name in table.column_names else pa.nulls(len(table), f.type) for f in ARROW]
            yield from pa.Table.from_arrays(columns, schema=ARROW).to_batches()


class EmbeddedTraces(DataSource):
    """Format ``embedded_traces``; options provider ("module:Class"), source (given to it), step (blocks a partition), and what is asked for:
    first, last, blocks and networks (lists with commas)."""

    @classmethod
    def name(cls) -> str:
        return "embedded_traces"

    def schema(self) -> str:
        return EMBEDDED

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    polled.importable(spark)
    spark.dataSource.register(EmbeddedTraces)


def read_embedded_traces(
    spark: SparkSession, source: str, provider: str | None = None, first: int | None = None, last: int | None = None, blocks: list[int] | None = None, networks: list[str] | None = None, step: int = STEP
) -> DataFrame:
    """Opcode rows of a host's traces: of blocks first to last, of the given blocks, of the given networks."""
    register(spark)
    asked = {"provider": provider, "first": first, "last": last, "blocks": None if blocks is None else ",".join(map(str, blocks)), "networks": None if networks is None else ",".join(networks)}
    return spark.read.format("embedded_traces").options(source=source, step=str(step), **{k: str(v) for k, v in asked.items() if v is not None}).load()
