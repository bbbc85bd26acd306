"""What must not grow with the input: rows of a task, work done again."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import normal
from tracelake import queries
from tracelake.functions import u128
from tracelake.plans import store
from tracelake.sources import versions

Q = queries.queries()


@pytest.mark.parametrize("name", ["opcode_rows", "gas_self"])
def test_tasks_of_windows_have_bounded_rows(spark, sf_dir, monkeypatch, name):
    """Tasks grow in number with the rows, and the rows are still exchanged once and the same."""
    plain = normal(map(tuple, Q[name](spark, sf_dir).collect()))
    monkeypatch.setattr(store, "TASK_ROWS", 500)
    df = Q[name](spark, sf_dir)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert df.rdd.getNumPartitions() == 12
    assert normal(map(tuple, df.collect())) == plain


def test_a_quantity_is_read_once(spark):
    """A hex quantity's digits are taken out of its text once, whatever is made of them."""
    df = spark.createDataFrame([("0x10000000000000005",), ("0xfffffffffffffff",), ("0x1000000000000000",), ("0xzz",), ("",), (None,)], "h string")
    out = df.select(u128.to_decimal(u128.from_hex(F.col("h"))).alias("n"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(h#") == 1
    assert [r["n"] for r in out.collect()] == [2**64 + 5, 2**60 - 1, 2**60, None, 0, None]


def test_written_transactions_are_computed_once(spark, sf_dir, monkeypatch):
    """Every write of a part reads the stored rows; none joins receipts again."""
    plans, write = [], queries.versions.write
    monkeypatch.setattr(queries.versions, "write", lambda rows, *rest: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), write(rows, *rest)))
    Q["write_transactions"](spark, sf_dir)
    assert len(plans) == 3 and not any("Join" in p or "Exchange" in p for p in plans)


def test_rows_are_shuffled_for_the_keys_that_there_are(spark, tmp_path, monkeypatch):
    """With too many later keys to broadcast: a table by transaction is joined once, and rows of the newest version not at all."""
    monkeypatch.setattr(versions, "FEW_KEYS", 0)
    table = lambda ids, v: spark.createDataFrame([("mainnet", i // 2, f"0x{i}", v) for i in ids], "meta_network_name string, block_number long, transaction_hash string, v int")
    path = str(tmp_path / "t")
    for ids, v in ((range(10), 1), (range(20, 25), 2), (range(5), 3)):
        versions.write(table(ids, v), path, table(ids, v))
    df = versions.read(spark, path)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and plan.count("Union") == 1
    assert sorted((r["transaction_hash"], r["v"]) for r in df.collect()) == sorted([*((f"0x{i}", 3) for i in range(5)), *((f"0x{i}", 1) for i in range(5, 10)), *((f"0x{i}", 2) for i in range(20, 25))])
    # a block that is written as a whole hides its transactions, and keys of both kinds are asked
    whole = table([20], 4)
    versions.write(whole, path, whole.select(*versions.BLOCK))
    df = versions.read(spark, path)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 2
    assert sorted(r["transaction_hash"] for r in df.where("block_number = 10").collect()) == ["0x20"]
    assert df.count() == 14


@pytest.mark.parametrize("name", ["frame_agg_table", "opcode_table", "frame_gas_self", "intrinsic_gas", "traced_create_address"])
def test_tasks_of_joins_have_bounded_rows(spark, sf_dir, monkeypatch, name):
    """Behind the scratch tables, too, every exchange is dealt by rows, none by bytes; and the rows are the same."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = normal(map(tuple, Q[name](spark, sf_dir).collect()))
        monkeypatch.setattr(store, "TASK_ROWS", 500)
        df = Q[name](spark, sf_dir)
        dealt = re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\), (\w+)", df._jdf.queryExecution().executedPlan().toString())
        assert dealt and min(int(n) for n, _ in dealt) >= 11
        assert normal(map(tuple, df.collect())) == plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["resource_gas", "frame_summary", "frame_gas_cumulative", "cold_access_count", "synthetic_frames_all", "precompile_split"])
def test_queries_of_windows_are_dealt_by_rows(spark, sf_dir, monkeypatch, name):
    """What is made of the windows keeps their tasks; only sums by operation are exchanged again."""
    monkeypatch.setattr(store, "TASK_ROWS", 500)
    plan = Q[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\), (\w+)", plan)
    assert [x[1:] for x in dealt if not x[0].startswith("op")] == [("12", "REPARTITION_BY_NUM")]


def test_tasks_of_versions_have_bounded_rows(spark, tmp_path, monkeypatch):
    """Where later keys are too many to broadcast, a read is dealt by rows, and so are a compaction's files; and the rows are the same."""
    table = lambda ids, v: spark.range(*ids).select(F.lit("n").alias("meta_network_name"), F.floor(F.col("id") / 8).alias("block_number"), F.concat(F.lit("0x"), "id").alias("transaction_hash"), F.lit(v).alias("v"))
    put = lambda ids, v, key: versions.write(table(ids, v), path, table(ids, v).select(*key).distinct())
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        put((0, 9000), 1, versions.TRANSACTION)
        put((4000, 6000), 2, versions.TRANSACTION)
        plain = normal(map(tuple, versions.read(spark, path).collect()))
        monkeypatch.setattr(versions, "FEW_KEYS", 0)
        monkeypatch.setattr(versions, "MOST_ROWS", 500)
        sizes = lambda df: re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\), \w+", df._jdf.queryExecution().executedPlan().toString())
        df = versions.read(spark, path)
        assert sizes(df).count("18") == 2
        assert normal(map(tuple, df.collect())) == plain
        versions.compact(spark, path)
        assert max(r["n"] for r in versions.read(spark, path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) <= 2000
        assert normal(map(tuple, versions.read(spark, path).collect())) == plain
        # whole blocks hide rows, too
        put((0, 800), 3, versions.BLOCK)
        put((8000, 8800), 3, versions.TRANSACTION)
        df = versions.read(spark, path)
        assert sizes(df).count("20") == 4
        assert {r["v"]: r["n"] for r in df.groupBy("v").agg(F.count("*").alias("n")).collect()} == {1: 5400, 2: 2000, 3: 1600}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
