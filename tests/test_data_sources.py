"""The data sources: embedded traces by pushed block ranges, and landed blocks within the leash."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from tracelake.operators import frames as fr
from tracelake.plans import traces as tr
from tracelake.sources import embedded, polled, readers, schemas, sinks
from tracelake.streaming import jobs

# ---------------------------------------------------------------- embedded traces


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("embedded") / "traces")
    rows = spark.range(9_000).select(
        F.when(F.col("id") % 2 == 0, "mainnet").otherwise("sepolia").alias("meta_network_name"), F.col("id").alias("block_number"), F.col("id").cast("string").alias("transaction_hash"), F.lit(0).alias("idx"), F.lit("ADD").alias("op"),
        F.lit(5).alias("gas"), F.lit("18446744073709551615").alias("gas_cost"), F.lit(1).alias("depth"), F.lit(3).alias("gas_used"),
    )
    embedded.write_folder(rows, at)
    return at


def read_ranges(df):
    """Ranges of blocks that the partitions of a scan read (Spark makes one partition without a range where there is none)."""
    return df.rdd.getNumPartitions()


def test_only_asked_ranges_become_partitions(spark, folder):
    read = lambda **asked: embedded.read_embedded_traces(spark, folder, **asked)
    for asked, n, ranges in [
        ({}, 9_000, 9), ({"first": 2_500, "last": 4_100}, 1_601, 3), ({"first": 3_000, "last": 3_999}, 1_000, 1), ({"blocks": [5, 8_001, 77_777]}, 2, 2), ({"blocks": [7, 9], "first": 8}, 1, 1), ({"first": 100_000}, 0, 1),
        ({"last": 99, "networks": ["mainnet"]}, 50, 1), ({"networks": ["other"]}, 0, 9), ({"networks": []}, 0, 1), ({"blocks": []}, 0, 1), ({"first": 0, "last": 99, "step": 10}, 100, 10),
    ]:
        df = read(**asked)
        assert (df.count(), read_ranges(df)) == (n, ranges), asked
    df = read()  # one frame in two scans of a plan
    assert df.where("block_number < 10").union(df).count() == 9_010 and df.where("block_number = 7").count() == 1


def test_only_asked_files_are_read(spark, folder, tmp_path):
    """Files of other ranges may be unreadable."""
    for k in range(9):
        at = tmp_path / "t" / f"block_range={k}"
        at.mkdir(parents=True)
        for f in os.listdir(f"{folder}/block_range={k}"):
            if f.endswith(".parquet"):
                (at / f).write_bytes(open(f"{folder}/block_range={k}/{f}", "rb").read() if k == 3 else b"no parquet")
    assert embedded.read_embedded_traces(spark, str(tmp_path / "t"), first=3_100, last=3_199).count() == 100
    with pytest.raises(Exception):
        embedded.read_embedded_traces(spark, str(tmp_path / "t")).count()


def test_no_blocks(spark, tmp_path):
    assert embedded.read_embedded_traces(spark, str(tmp_path / "none")).count() == 0


def test_embedded_and_other_traces_together(spark):
    """Whether a trace has the tracer's gas is found per trace."""
    key = ["transaction_hash"]
    rows = [("e", 0, "CALL", 100, 40, 1, 33, "0x" + "0" * 39 + "9", None), ("e", 1, "STOP", 60, 0, 1, 0, None, None), ("r", 0, "CALL", 100, 40, 1, None, None, "0xabc"), ("r", 1, "STOP", 90, 0, 1, None, None, None)]
    df = spark.createDataFrame(rows, "transaction_hash string, idx long, op string, gas long, gas_cost long, depth int, gas_used long, call_to_address string, s2 string")
    got = {(r["transaction_hash"], r["idx"]): r for r in tr.annotated(df, key).collect()}
    assert [got[k]["gas_used"] for k in (("e", 0), ("r", 0))] == [33, 10]
    assert [got[k]["target"] for k in (("e", 0), ("r", 0))] == ["0x" + "0" * 39 + "9", "0x" + "0" * 37 + "abc"]
    assert fr.normal(df).where("mem_size is null").count() == 4


# ---------------------------------------------------------------- landed blocks


def land(landing, *blocks, n_tx=1):
    for b in blocks:
        at = polled.place(str(landing), b)
        os.makedirs(os.path.dirname(at), exist_ok=True)
        docs = [{"meta_network_name": "mainnet", "block_number": b, "transaction_hash": f"0x{b}-{i}", "transaction_index": i, "gas": 21000, "failed": False, "structLogs": [{"op": "STOP", "gas": 9, "gasCost": 0, "depth": 1, "stack": []}]} for i in range(n_tx)]
        with open(at, "w") as f:
            f.write("\n".join(map(json.dumps, docs)))


def note(spark, progress, complete, *blocks):
    rows = spark.createDataFrame([("mainnet", b) for b in blocks], "meta_network_name string, block_number long")
    sinks.append_progress(sinks.progress_rows(rows, "structlog", complete), progress)


class Follow:
    """A stream whose batches mark their blocks begun; ``seen`` has the blocks of each batch."""

    def __init__(self, spark, tmp_path, **options):
        self.spark, self.path, self.seen = spark, tmp_path, []
        polled.register(spark)
        self.options = {"landing": f"{tmp_path}/in", "progress": f"{tmp_path}/progress", "processor": "structlog", "network": "mainnet", "pending": "5"} | options

    def __enter__(self):
        def batch(df, _):
            blocks = sorted(r["block_number"] for r in polled.documents(df, schemas.TRACE).select("block_number").distinct().collect())
            note(self.spark, self.options["progress"], 0, *blocks)
            self.seen.append(blocks)

        self.query = self.spark.readStream.format("landed_blocks").options(**self.options).load().writeStream.foreachBatch(batch).option("checkpointLocation", f"{self.path}/cp").start()
        return self

    def __exit__(self, *_):
        self.query.stop()

    def more(self):
        """The blocks that come now."""
        before = len(self.seen)
        self.query.processAllAvailable()
        return [b for blocks in self.seen[before:] for b in blocks]


def test_stream_stops_at_the_leash_and_goes_on(spark, tmp_path):
    land(tmp_path / "in", *range(100, 140))
    progress = f"{tmp_path}/progress"
    with Follow(spark, tmp_path, start="100") as follow:
        assert follow.more() == [100, 101, 102, 103, 104]
        assert follow.more() == []
        note(spark, progress, 1, 101, 102)  # the oldest is still open
        assert follow.more() == []
        note(spark, progress, 1, 100)
        assert follow.more() == [105, 106, 107]
        note(spark, progress, 1, *range(103, 107))
    with Follow(spark, tmp_path, start="100") as follow:  # from its offsets
        assert follow.more() == [108, 109, 110, 111]
        note(spark, progress, 1, *range(107, 112))
        assert follow.more() == [112, 113, 114, 115, 116]


def test_stream_waits_for_blocks_that_have_not_landed(spark, tmp_path):
    land(tmp_path / "in", 7, 8, 10)
    note(spark, f"{tmp_path}/progress", 1, 6)
    with Follow(spark, tmp_path, pending="50") as follow:
        assert follow.more() == [7, 8]
        land(tmp_path / "in", 9)
        assert follow.more() == [9, 10]


def test_stream_goes_no_further_than_the_limiter(spark, tmp_path):
    land(tmp_path / "in", *range(10, 30))
    beacon = lambda *rows: spark.createDataFrame([(datetime.datetime(2024, 1, 1, 0, m), b, "mainnet") for m, b in rows], schemas.BEACON).coalesce(1).write.mode("append").parquet(f"{tmp_path}/beacon")
    beacon((1, 12), (3, None))
    with Follow(spark, tmp_path, pending="0", limiter=f"{tmp_path}/beacon") as follow:
        assert follow.more() == [11, 12]  # an empty store begins one before the limit
        beacon((5, 15))
        assert follow.more() == [13, 14, 15]


def test_stream_backwards(spark, tmp_path):
    land(tmp_path / "in", *range(0, 20))
    note(spark, f"{tmp_path}/progress", 1, 4)
    with Follow(spark, tmp_path, mode="backwards", pending="3") as follow:
        assert follow.more() == [1, 2, 3]
        note(spark, f"{tmp_path}/progress", 1, 3, 2, 1)
        assert follow.more() == [0]
        assert follow.more() == []


def test_cut_off_batch_is_repeated(spark, tmp_path):
    land(tmp_path / "in", *range(1, 9))
    with pytest.raises(Exception):
        polled.register(spark)
        options = {"landing": f"{tmp_path}/in", "progress": f"{tmp_path}/progress", "processor": "structlog", "network": "mainnet", "pending": "4", "start": "1"}

        def fails(df, _):
            raise RuntimeError("cut off")

        spark.readStream.format("landed_blocks").options(**options).load().writeStream.foreachBatch(fails).option("checkpointLocation", f"{tmp_path}/cp").start().processAllAvailable()
    with Follow(spark, tmp_path, pending="4", start="1") as follow:
        assert follow.more() == [1, 2, 3, 4]


def test_traces_follow_blocks_into_tables(spark, tmp_path):
    """The whole way: blocks within the leash, tables as versions, completion that lets the next blocks in."""
    from tracelake.sources import versions

    land(tmp_path / "in", *range(1, 8), n_tx=2)
    polled.register(spark)
    progress, tables = f"{tmp_path}/progress", {"structlog": f"{tmp_path}/structlog"}
    lines = spark.readStream.format("landed_blocks").options(landing=f"{tmp_path}/in", progress=progress, processor="structlog", network="mainnet", pending="3", start="1").load()
    jobs.follow_blocks(lines, lambda df: df.withColumn("to_address", F.lit("0xto")), tables, progress, f"{tmp_path}/cp", lambda b: b.withColumn("task_count", F.lit(2)), processingTime="0 seconds").processAllAvailable()
    for q in spark.streams.active:
        q.stop()
    assert sorted(r["transaction_hash"] for r in versions.read(spark, tables["structlog"]).collect()) == sorted(f"0x{b}-{i}" for b in range(1, 8) for i in range(2))


def test_lines_that_are_no_documents(spark):
    df = spark.createDataFrame([(1, "{"), (2, '{"transaction_hash": "0x2"}')], "block_number long, value string")
    assert [tuple(r) for r in polled.documents(df, schemas.TRACE).select("block_number", "transaction_hash").orderBy("block_number").collect()] == [(1, None), (2, "0x2")]
    assert readers.flatten_traces(polled.documents(df, schemas.TRACE)).count() == 0
