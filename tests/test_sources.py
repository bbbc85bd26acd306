"""Landed JSON, sinks, the transaction table and streams."""

import base64
import datetime
import json

import pytest
from pyspark.sql import functions as F

from tracelake.functions.prices import parse_u128
from tracelake.plans import progress as pg
from tracelake.plans import transactions as tx
from tracelake.sources import readers, schemas, sinks, versions
from tracelake.streaming import completion, jobs


def land(path, block, n_tx=2):
    path.mkdir(exist_ok=True)
    docs = []
    for i in range(n_tx):
        logs = [{"op": "CALL", "gas": 1000, "gasCost": 100, "depth": 1, "stack": ["0x0", "0x0", "0xabc", "0x1"], "returnData": base64.b64encode(b"\x01\xff").decode()}, {"op": "STOP", "gas": 900, "gasCost": 0, "depth": 1, "stack": []}]
        docs.append({"meta_network_name": "mainnet", "block_number": block, "transaction_hash": f"0x{block}{i}", "transaction_index": i, "gas": 22000, "failed": False, "returnValue": "0x", "structLogs": logs if i == 0 else []})
    (path / f"{block}.json").write_text("\n".join(map(json.dumps, docs)))


def headers(df):
    return df.withColumn("to_address", F.lit("0xto"))


def test_traces_from_json(spark, tmp_path):
    land(tmp_path / "in", 7)
    df = readers.read_json(spark, str(tmp_path / "in"), schemas.TRACE)
    flat = readers.flatten_traces(df).orderBy("idx").collect()
    assert [(r["op"], r["s1"], r["s2"], r["s4"], r["return_data"]) for r in flat] == [("CALL", "0x1", "0xabc", "0x0", "01ff"), ("STOP", None, None, None, None)]
    assert {r["trace_return_value"] for r in readers.trace_headers(df).collect()} == {None}


def test_stream_of_traces_is_idempotent(spark, tmp_path):
    land(tmp_path / "in", 1)
    tables = {k: str(tmp_path / k) for k in ("structlog", "structlog_agg")}
    progress = str(tmp_path / "progress")

    def run():
        jobs.stream_traces(spark, str(tmp_path / "in"), headers, tables, progress, str(tmp_path / "cp")).awaitTermination(120)

    run()
    land(tmp_path / "in", 2)
    run()
    once = {k: versions.read(spark, v).count() for k, v in tables.items()}
    jobs.backfill(spark, str(tmp_path / "in"), headers, tables, progress, 1, 1)
    assert {k: versions.read(spark, v).count() for k, v in tables.items()} == once
    assert once["structlog"] == 2 * 3  # two opcodes and the frame of a plain account
    latest = pg.latest_version(spark.read.parquet(progress), ["complete"])
    assert latest.where("complete = 1").count() == 4


def test_block_split_over_batches(spark, tmp_path):
    """One block in two files, a file a batch: all its transactions stay, and it is complete only with the last of them."""
    land(tmp_path / "whole", 5, 3)
    first, *others = (tmp_path / "whole" / "5.json").read_text().splitlines()
    (tmp_path / "in").mkdir()
    tables = {k: str(tmp_path / k) for k in ("structlog", "structlog_agg")}
    progress = str(tmp_path / "progress")
    counts = lambda blocks: blocks.withColumn("task_count", F.lit(3))

    def run():
        jobs.stream_traces(spark, str(tmp_path / "in"), headers, tables, progress, str(tmp_path / "cp"), files_a_batch=1, counts=counts).awaitTermination(120)
        return pg.latest_version(spark.read.parquet(progress), ["complete"]).where("complete = 1").count()

    (tmp_path / "in" / "a.json").write_text(first)
    assert run() == 0
    for i, line in enumerate(others):
        (tmp_path / "in" / f"b{i}.json").write_text(line)
    assert run() == 2
    split = {k: sorted(map(str, versions.read(spark, v).drop("updated_date_time").collect())) for k, v in tables.items()}
    assert {r["transaction_hash"] for r in versions.read(spark, tables["structlog_agg"]).collect()} == {"0x50", "0x51", "0x52"}
    whole = {k: str(tmp_path / f"{k}-whole") for k in tables}
    jobs.backfill(spark, str(tmp_path / "whole"), headers, whole, str(tmp_path / "progress-whole"), 5, 5, counts)
    assert split == {k: sorted(map(str, versions.read(spark, v).drop("updated_date_time").collect())) for k, v in whole.items()}


def test_blocks_and_receipts(spark, tmp_path):
    block = {
        "meta_network_name": "mainnet", "number": "0x10", "hash": "0xAA", "parentHash": "0xBB", "baseFeePerGas": "0xa",
        "transactions": [
            {"hash": "0x01", "type": "0x2", "nonce": "0x1", "gasPrice": "0x5", "maxPriorityFeePerGas": "0x2", "maxFeePerGas": "0x64", "gas": "0x5208", "value": "0xffffffffffffffffff", "input": "0x00010002", "to": "0xCC", "from": "0xDD", "size": 9},
            {"hash": "0x02", "type": "0x3", "nonce": "0x2", "maxPriorityFeePerGas": "0x2", "maxFeePerGas": "0xb", "gas": "0x1", "value": "0x0", "input": "0x", "from": "0xDD", "blobVersionedHashes": ["0xE1"], "maxFeePerBlobGas": "0x3", "size": 9},
        ],
    }
    (tmp_path / "b.json").write_text(json.dumps(block))
    (tmp_path / "r.json").write_text(json.dumps({"transactionHash": "0x01", "status": "0x1", "gasUsed": "0x5208"}))
    (tmp_path / "s.json").write_text(json.dumps({"transactionHash": "0x02", "status": "0x0", "gasUsed": "0x1"}))
    read = lambda n, s: readers.read_json(spark, str(tmp_path / n), s)
    blocks, batch, single = readers.flatten_blocks(read("b.json", schemas.BLOCK)), readers.flatten_receipts(read("r.json", schemas.RECEIPT)), readers.flatten_receipts(read("s.json", schemas.RECEIPT))
    rows = tx.transaction_table(blocks, batch, single).orderBy("position").collect()
    assert [int(r["gas_price"]) for r in rows] == [12, 11]
    assert int(rows[0]["value"]) == 0xFFFFFFFFFFFFFFFFFF
    assert [(r["n_input_bytes"], r["n_input_zero_bytes"], r["success"], r["blob_gas"], r["blob_hashes"]) for r in rows] == [(4, 2, True, None, []), (0, 0, False, 131072, ["0xe1"])]
    assert tx.transaction_table(blocks, batch).count() == 0  # a block without all receipts fails as a whole


def test_requeue_replaces_only_its_blocks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("mainnet", b, v) for b in (1, 2, 20001) for v in (1, 2)], "meta_network_name string, block_number long, v long")
    sinks.write_table(rows, path)
    sinks.replace_blocks(spark.createDataFrame([("mainnet", 2, 9)], rows.schema), path, spark.createDataFrame([("mainnet", 2)], "meta_network_name string, block_number long"))
    assert sorted((r["block_number"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (1, 2), (2, 9), (20001, 1), (20001, 2)]


def test_requeue_has_a_result_for_each_block(spark, tmp_path):
    path, progress = str(tmp_path / "t"), str(tmp_path / "p")
    rows = spark.createDataFrame([("mainnet", b, 1) for b in (1, 2, 3)], "meta_network_name string, block_number long, v long")
    sinks.write_table(rows, path)
    known = spark.createDataFrame([("mainnet", b, 4) for b in (1, 2, 3)], "meta_network_name string, block_number long, task_count long")
    asked = spark.createDataFrame([("mainnet", 2), ("mainnet", 2), ("mainnet", 77)], "meta_network_name string, block_number long")
    for processor in ("structlog", "structlog_agg", "transaction"):
        out = sinks.requeue_blocks(asked, known, lambda b: b.select("meta_network_name", "block_number", F.lit(8).cast("long").alias("v")), processor, path, progress)
        assert {(r["block_number"], r["status"], r["task_count"], r["error"]) for r in out.collect()} == {(2, "queued", 4, None), (77, "failed", 0, "no such block")}
        assert tuple(sinks.requeue_summary(out).first()) == (2, 1, 1)
    assert sorted((r["block_number"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 8), (3, 1)]
    assert sorted(x.name for x in tmp_path.iterdir()) == ["p", "t"]  # nothing is left aside
    with pytest.raises(ValueError):
        sinks.requeue_blocks(spark.range(1001).select(F.lit("mainnet").alias("meta_network_name"), F.col("id").alias("block_number")), known, None, "structlog", path, progress)
    with pytest.raises(Exception, match="gone"):  # an error of a source is no missing table
        sinks.replace_blocks(rows.where(F.raise_error(F.lit("gone: PATH_NOT_FOUND")).isNull()), path, asked)


def test_transactions_are_located(spark):
    held = spark.createDataFrame([("n", 5, i, f"0x{i}") for i in range(3)], "meta_network_name string, block_number long, position long, hash string")
    asked = spark.createDataFrame([("n", 5, 1, "0x1"), ("n", 5, 2, "0x9"), ("n", 5, 3, "0x3"), ("n", 6, 0, "0x0")], "meta_network_name string, block_number long, transaction_index long, transaction_hash string")
    assert [r["error"] for r in tx.locate(asked, held).orderBy("block_number", "transaction_index").collect()] == [None, "transaction hash mismatch: found 0x2", "transaction index out of range", "no such block"]
    assert tx.located(asked.limit(1), held).count() == 1
    with pytest.raises(Exception, match="hash mismatch"):
        tx.located(asked.where("transaction_index = 2"), held).collect()


def test_transaction_blocks_job(spark, tmp_path):
    names = "meta_network_name string, block_number long, block_hash string, parent_hash string, position long, hash string, from_address string, to_address string, nonce long, type int, gas_price long, base_fee long, gas_tip_cap long, gas_fee_cap long, gas long, value long, input binary, size long, blob_gas long, blob_gas_fee_cap long, blob_hashes array<string>"
    rows = [("n", b, "0xb", "0xa", i, f"0x{b}{i}", "0xf", "0xt", 1, 0, 7, 1, None, None, 21000, 5, b"\x00\x01", 9, None, None, None) for b in (1, 2) for i in (0, 1)]
    txs = spark.createDataFrame(rows, names)
    receipts = spark.createDataFrame([("0x10", 1, 21000), ("0x11", 0, 21000), ("0x20", 1, 21000)], "tx_hash string, status int, gas_used long")
    table, progress = str(tmp_path / "t"), str(tmp_path / "p")
    for _ in range(2):
        jobs.process_blocks(txs, receipts, table, progress)
        assert sorted((r["block_number"], r["position"]) for r in versions.read(spark, table).collect()) == [(1, 0), (1, 1)]
    latest = pg.latest_version(spark.read.parquet(progress), ["complete"])
    assert {(r["block_number"], r["complete"]) for r in latest.collect()} == {(1, 1), (2, 0)}


def test_heads(spark):
    none = spark.createDataFrame([], schemas.PROGRESS)
    scopes = spark.createDataFrame([("structlog", "mainnet")], "processor string, meta_network_name string")
    limits = spark.createDataFrame([("mainnet", 50)], "meta_network_name string, limiter_max long")
    of = lambda **k: tuple(pg.head_distance(scopes, none, **k).first())[2:]
    assert of(chain_head=9) == (0, "execution_head")
    assert of(chain_head=9, limits=limits) == (1, "beacon_chain_head")
    assert of(chain_head=9, limited=True) == (0, "execution_head_fallback")
    for limited in (False, True):
        with pytest.raises(Exception, match="unavailable|not available"):
            of(limited=limited)
    assert of(mode="backwards") == (0, "")  # no next block, so no head is needed


def test_small_helpers(spark):
    df = spark.createDataFrame([("p", "n", 7, "0xa")], "p string, n string, b long, h string")
    r = df.select(pg.task_id(F.col("p"), F.col("n"), F.col("b")).alias("x"), pg.task_id(F.col("p"), F.col("n"), F.col("b"), F.col("h")).alias("y")).first()
    assert (r["x"], r["y"]) == ("p:n:7:block", "p:n:7:0xa")
    assert pg.is_empty(df, b=8) and not pg.is_empty(df, b=7, n="n")
    words = spark.createDataFrame([(w,) for w in ("0", "340282366920938463463", "0xff", "", None)], "w string").select(parse_u128(F.col("w")).alias("v"), parse_u128(F.col("w"), True).alias("w")).collect()
    assert [int(r["v"]) for r in words] == [0, 340282366920938463463, 0, 0, 0] and words[-1]["w"] is None


def test_next_block_of_an_empty_store(spark):
    none = spark.createDataFrame([], schemas.PROGRESS)
    scopes = spark.createDataFrame([("structlog", "mainnet")], "processor string, meta_network_name string")
    limits = spark.createDataFrame([("mainnet", 50)], "meta_network_name string, limiter_max long")
    first = lambda df: df.first()["next_block"]
    assert first(pg.next_block(scopes, none)) == 0
    assert first(pg.next_block(scopes, none, chain_head=9)) == 9
    assert first(pg.next_block(scopes, none, chain_head=9, limits=limits)) == 49
    assert pg.stored_range(none).isEmpty() and pg.gaps(pg.latest_version(none), 5).isEmpty()


def test_gap_window_and_capacity(spark):
    at = datetime.datetime(2024, 1, 1)
    rows = [(at, b, "p", "n", 0 if b in (104,) else 1, 0) for b in range(1, 105)]
    store = spark.createDataFrame(rows, schemas.PROGRESS)
    w = pg.gap_window(store.where("block_number <= 100"), 0, 5).first()
    assert (w["min_block"], w["max_block"]) == (1, 94)
    w = pg.gap_window(store.where("block_number <= 100"), 30, 5).first()
    assert (w["min_block"], w["max_block"]) == (70, 94)
    thin = pg.latest_version(store.where("block_number % 10 <> 0 or block_number = 100"))
    found = lambda *a, **b: [r["block_number"] for r in pg.gaps(thin, *a, **b).orderBy("block_number").collect()]
    assert found(lookback=40, pending=1) == [70, 80, 90] and found(2, lookback=40) == [70, 104]
    scopes = spark.createDataFrame([("p", "n", 105)], "processor string, meta_network_name string, next_block long")
    r = pg.capacity(scopes, pg.latest_version(store), 2).first()
    assert (r["capacity"], r["blocked"]) == (1, False)
    assert pg.within_leash(scopes, pg.latest_version(store), 2, 2).first()["fits"] is False
    for pending in (0, -1):
        r = pg.capacity(scopes, pg.latest_version(store), pending).first()
        assert (r["capacity"], r["blocked"]) == (None, False)
    known = spark.createDataFrame([("p", "n", 1, 1, at)], "processor string, meta_network_name string, block_number long, task_count long, enqueued_at timestamp")
    done = spark.createDataFrame([("p", "n", 1, "a")], "processor string, meta_network_name string, block_number long, task_id string")
    assert pg.block_completion(done, known).select("completed", "enqueued_at", "is_complete").collect() == [(1, at, True)]


def test_capacity_backwards_and_beyond_the_next_block(spark):
    """(next block, mode) against incomplete blocks 90 and 110 and a range of 5: distance to the one that counts; on the wrong side it blocks."""
    at = datetime.datetime(2024, 1, 1)
    latest = pg.latest_version(spark.createDataFrame([(at, b, "p", "n", int(b not in (90, 110)), 0) for b in range(80, 121)], schemas.PROGRESS))
    scope = "processor string, meta_network_name string, next_block long"
    of = lambda b, mode: tuple(pg.capacity(spark.createDataFrame([("p", "n", b)], scope), latest, 5, mode).select("nearest", "capacity", "blocked").first())
    assert of(92, "forwards") == (90, 3, False) and of(95, "forwards") == (90, 0, True)
    assert of(108, "forwards") == (110, 0, True)  # above the next block
    assert of(116, "forwards") == (None, 5, False)
    assert of(108, "backwards") == (110, 3, False) and of(105, "backwards") == (110, 0, True)
    assert of(100, "backwards") == (90, 0, True)  # below the next block
    assert of(85, "backwards") == (90, 0, True) and of(84, "backwards") == (None, 5, False)
    fits = lambda b, n, mode: pg.within_leash(spark.createDataFrame([("p", "n", b)], scope), latest, n, 5, mode).first()["fits"]
    assert fits(108, 3, "backwards") and not fits(108, 4, "backwards") and not fits(84, 6, "backwards")


def test_rows_asked_for_by_hand_count_as_incomplete(spark):
    """A progress row without ``complete`` opens its block again."""
    at = datetime.datetime(2024, 1, 1)
    asked = spark.createDataFrame([("n", 7)], "meta_network_name string, block_number long")
    rows = sinks.progress_rows(asked, "p", 1, at).unionByName(sinks.progress_rows(asked, "p", None, at + datetime.timedelta(seconds=1)))
    latest = pg.latest_version(rows)
    assert latest.select("complete", "task_count").collect() == [(0, None)]
    assert pg.incomplete_blocks(latest, 5).count() == 1 and pg.count_incomplete(latest).first()["n_incomplete"] == 1
    assert not pg.is_complete(latest, asked.selectExpr("'p' as processor", "*")).first()["is_complete"]


def test_stale_blocks_of_the_stream(spark, tmp_path):
    """A registered block without its tasks is stale when event time goes on; a late task then finds no block."""
    schema = "event_time timestamp, processor string, meta_network_name string, block_number long, task_id string, task_count long"
    at = datetime.datetime(2024, 1, 1)
    later = at + datetime.timedelta(hours=1)
    (tmp_path / "in").mkdir()
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = jobs.completion_with_timeout(events).writeStream.outputMode("append").format("memory").queryName("stale").option("checkpointLocation", str(tmp_path / "cp")).start()
    for rows in ([(at, "p", "n", 1, None, 2), (at, "p", "n", 1, "a", None), (at, "p", "n", 2, None, 1)], [(later, "p", "n", 3, None, 1)], [(later, "p", "n", 3, "x", None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q.processAllAvailable()
    q.stop()
    assert {(r["block_number"], r["status"], r["completed"]) for r in spark.table("stale").collect()} == {(1, "stale", 1), (2, "stale", 0), (3, "complete", 1)}


def test_backfill_goes_down(spark, tmp_path, monkeypatch):
    for b in (1, 2, 3, 4, 5):
        land(tmp_path / "in", b)
    seen = []
    monkeypatch.setattr(jobs, "process_batch", lambda traces, *a: seen.append(sorted({r["block_number"] for r in traces.select("block_number").collect()})))
    jobs.backfill(spark, str(tmp_path / "in"), headers, {}, "", 1, 5, step=2)
    jobs.backfill(spark, str(tmp_path / "in"), headers, {}, "", 2, 4)
    assert seen == [[4, 5], [2, 3], [1], [2, 3, 4]]


EVENT = "event_time timestamp, processor string, meta_network_name string, block_number long, task_id string, task_count long"
START = datetime.datetime(2024, 1, 1)


def event(minutes, task=None, count=None, block=1):
    return (START + datetime.timedelta(minutes=minutes), "p", "n", block, task, count)


def completed(spark, tmp_path, batches, **options):
    """What completion gives for batches of events, after each of them, and the rows of state that are left."""
    (tmp_path / "in").mkdir()
    events = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    mode, name = ("update" if options.get("every") else "append"), f"done_{tmp_path.name.replace('-', '_')}"
    q = completion.completions(events, **options).writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        for rows in batches:
            spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            q.processAllAvailable()
            state = next(p["stateOperators"][0]["numRowsTotal"] for p in reversed(q.recentProgress) if p["stateOperators"])
            yield sorted((r["block_number"], r["status"], r["completed"], r["task_count"]) for r in spark.table(name).collect()), state
    finally:
        q.stop()


def test_completion_counts_each_task_once(spark, tmp_path):
    batches = [[event(0, count=2), event(0, "a"), event(0, "a"), event(0, count=3, block=2), event(0, "a", block=2)], [event(0, "a"), event(0, "b")], [event(0, "b")]]
    rows = [r for r, _ in completed(spark, tmp_path, batches, every=True)]
    assert rows[0] == [(1, "open", 1, 2), (2, "open", 1, 3)]
    assert rows[1] == rows[2] == [(1, "complete", 2, 2), (1, "open", 1, 2), (2, "open", 1, 3)]


def test_a_block_is_stale_by_its_registration(spark, tmp_path):
    """20 tasks expected, one every 4 minutes: stale 5 minutes after registration, and then nothing of it is left but late tasks' entries,
    which go as well."""
    batches = [[event(0, count=20)], *[[event(4 * i, f"t{i}")] for i in range(1, 4)], [event(60, count=1, block=9)], [event(61, "x", block=9)]]
    out = list(completed(spark, tmp_path, batches))
    assert [r for r, _ in out] == [[], [], [(1, "stale", 2, 20)], [(1, "stale", 2, 20)], [(1, "stale", 2, 20)], [(1, "stale", 2, 20), (9, "complete", 1, 1)]]
    assert out[2][1] == 0 and out[3][1] > 0 and out[5][1] == 0


def test_registration_begins_anew(spark, tmp_path):
    """Tasks before a registration don't count, those from its time on do, even if they came first; a second registration moves the timer."""
    batches = [[event(0, "old"), event(2, "early")], [event(1, count=3)], [event(3, "b")], [event(4, count=2), event(4.1, "b")], [event(8, "b")], [event(8.5, "c")], [event(20, "z", block=7)]]
    rows = [r for r, _ in completed(spark, tmp_path, batches, every=True, delay="10 minutes")]
    assert rows[1] == [(1, "open", 1, 3)] and rows[2] == [(1, "open", 1, 3), (1, "open", 2, 3)]
    assert rows[-1][0] == (1, "complete", 2, 2) and not [r for r in rows[-1] if r[1] == "stale"]


def test_nothing_expected_is_complete(spark, tmp_path):
    assert [r for r, _ in completed(spark, tmp_path, [[event(0, count=0), event(0, None, None, 3)]])] == [[(1, "complete", 0, 0)]]
