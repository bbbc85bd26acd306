"""Cases and random traces for the trace plans."""

import random

from pyspark.sql import functions as F

from tests.conftest import normal
from tracelake import functions as fn
from tracelake.operators import frames as fr
from tracelake.operators import resources as rs
from tracelake.operators import sequential as sq
from tracelake.plans import traces as tr

SCHEMA = "tx long, idx long, op string, gas long, gas_cost decimal(20,0), depth int, mem_size long, error string, refund long, call_to_address string, s1 string, s2 string"


def frame(spark, rows, schema=SCHEMA):
    names = [c.split()[0] for c in schema.replace("decimal(20,0)", "decimal").split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def trace(ops, tx=1):
    from decimal import Decimal

    return [{"tx": tx, "idx": i, "op": o[0], "gas": o[1], "gas_cost": Decimal(o[2]), "depth": o[3]} | (o[4] if len(o) > 4 else {}) for i, o in enumerate(ops)]


def test_tracer_gas_is_taken_if_its_first_is_positive(spark):
    ops = [("CALL", 900, 40, 1, {"gas_used": 333}), ("ADD", 700, 4, 2, {"gas_used": 21}), ("STOP", 690, 0, 2), ("ADD", 500, 5, 1, {"gas_used": 6})]
    schema = SCHEMA + ", gas_used long"
    for first, want in ((333, [333, 21, 0, 6]), (0, [400, 10, 0, 5]), (None, [400, 10, 0, 5])):
        rows = trace(ops)
        rows[0]["gas_used"] = first
        df = fr.with_gas(fr.with_frames(fr.normal(frame(spark, rows, schema)), ["tx"]), ["tx"]).orderBy("idx").collect()
        assert [r["gas_used"] for r in df] == want
        assert df[0]["gas_self"] == want[0] - want[1]


def test_corrupt_cost_is_repaired(spark):
    ops = [("A", 900, 7, 1), ("B", 640, 2**63 + 5, 1), ("C", 12, 2**64 - 100, 1)]
    assert [r["gas_cost"] for r in fr.normal(frame(spark, trace(ops))).orderBy("idx").collect()] == [7, 640, 12]


def test_memory_words(spark):
    ops = [("CALL", 9, 0, 1, {"mem_size": 96}), ("ADD", 8, 0, 2, {"mem_size": 0}), ("MSTORE", 7, 0, 2, {"mem_size": 160}), ("REVERT", 6, 0, 2, {"mem_size": 224}), ("ADD", 5, 0, 1, {"mem_size": 96})]
    more = [("RETURN", 9, 0, 1, {"mem_size": 64, "s1": "c0", "s2": "0"})]
    none = [("MSTORE", 9, 0, 1), ("RETURN", 8, 0, 1, {"s1": "c0", "s2": "20"})]
    df = rs.with_memory(fr.with_frames(fr.normal(frame(spark, trace(ops) + trace(more, 2) + trace(none, 3))), ["tx"]), ["tx"]).orderBy("tx", "idx").collect()
    assert [(r["words_before"], r["words_after"]) for r in df] == [(3, 3), (0, 5), (5, 7), (7, 7), (3, 3), (2, 6), (0, 0), (0, 0)]


def test_cold_access_cases(spark):
    cases = [
        ("SLOAD", 100, 0, 0, None, False, 0, 0), ("SLOAD", 2100, 0, 0, None, False, 0, 1), ("SSTORE", 22100, 0, 0, None, False, 0, 1), ("SSTORE", 20000, 0, 0, None, False, 0, 0), ("EXTCODESIZE", 700, 0, 0, None, False, 0, 1),
        ("DELEGATECALL", 0, 150, 0, None, False, 0, 0), ("STATICCALL", 0, 2700, 0, None, False, 0, 1), ("STATICCALL", 0, 2750, 200, None, False, 0, 0), ("CALL", 0, 6000, 0, None, False, 0, 2), ("CALL", 0, 12000, 300, None, True, 0, 1),
        ("CALL", 0, 36700, 0, None, True, 0, 1), ("EXTCODECOPY", 0, 2700, 0, None, False, 64, 1), ("EXTCODECOPY", 0, 2605, 0, None, False, 64, 0), ("EXTCODECOPY", 0, 450, 400, None, False, 64, 0), ("SELFDESTRUCT", 32600, 0, 0, None, False, 0, 1),
        ("CALL", 0, 5300, 0, "0x2", False, 0, 0), ("ADD", 9999, 9999, 0, None, False, 0, 0),
    ]
    df = spark.createDataFrame(cases, "op string, gas_cost long, gas_self long, mem_exp long, target string, value boolean, size long, want long")
    got = df.select("want", rs.cold_access(*(F.col(c) for c in ("op", "gas_cost", "gas_self", "mem_exp", "target", "value", "size"))).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_hex_words(spark):
    words = ["0x20", "0xffffffffffffffff", "0x10000000000000000", "0xZZZZ", "", None, "0x100000000", "0x0", "000"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select(fn.parse_hex_u64(F.col("w")).alias("a"), fn.parse_hex_u32(F.col("w")).alias("b"), fn.is_hex_zero(F.col("w")).alias("z")).collect()
    assert [None if r["a"] is None else int(r["a"]) for r in df] == [32, 2**64 - 1, 0, 0, 0, None, 2**32, 0, 0]
    assert [r["b"] for r in df] == [32, 4294967295, 4294967295, 4294967295, 0, None, 4294967295, 0, 0]
    assert [r["z"] for r in df] == [False, False, False, False, True, None, False, True, True]


def test_intrinsic_gas(spark):
    cases = [(60000, 5000, 90000, 35000), (60000, 30000, 90000, 52500), (500, 0, 0, None), (95000, 1000, 90000, None), (0, 0, 21000, 21000), (91000, 1000, 90000, None)]
    df = spark.createDataFrame(cases, "c long, r long, g long, want long").select("want", tr.intrinsic_gas(F.col("c"), F.col("r"), F.col("g")).alias("got")).collect()
    assert [r["got"] for r in df] == [r["want"] for r in df]


def random_trace(rng, tx, steps):
    depth, gas, out = 1, 10**6, []
    for i in range(rng.randint(1, 40)):
        op = rng.choice(["CALL", "STATICCALL", "CREATE", "ADD", "SLOAD", "RETURN"])
        out.append((op, gas, rng.randint(0, 50), depth, {"mem_size": 32 * i, "s1": hex(i), "s2": "0x" + "0" * 62 + f"{rng.choice([1, 5, 77]):02d}" if rng.random() < 0.8 else None}))
        gas -= rng.randint(0, 60)
        depth = max(1, depth + rng.choice(steps))
    return trace(out, tx)


def by_definition(ops, tracer=False):
    """gas_self and the top of the stack after a create, of each opcode, from their definitions: scans over the rest of the trace."""
    out = []
    for i, r in enumerate(ops):
        behind = ops[i + 1 :]
        end = next((k for k, x in enumerate(behind) if x["depth"] <= r["depth"]), len(behind))
        alike = next((x for x in behind if x["depth"] <= r["depth"]), None)
        out.append((behind[:end], alike))
    return out


def test_created_addresses_and_inner_gas_by_definition(spark):
    rng = random.Random(9)
    for steps in ([-3, -1, 0, 0, 1], [-2, 0, 1, 2, 3]):
        rows = [r for tx in range(25) for r in random_trace(rng, tx, steps)]
        got = {(r["tx"], r["idx"]): r for r in tr.annotated(frame(spark, rows), ["tx"]).collect()}
        for tx in range(25):
            ops = sorted((r for r in rows if r["tx"] == tx), key=lambda r: r["idx"])
            for r, (inside, alike) in zip(ops, by_definition(ops)):
                g = got[tx, r["idx"]]
                again = alike if alike is not None and alike["depth"] == r["depth"] else None  # the frame goes on
                assert g["gas_used"] == (r["gas"] - again["gas"] if again is not None else r["gas_cost"])
                if r["op"] == "CREATE":
                    assert g["target"] == (None if alike is None else "0x" + alike["s1"][2:].rjust(40, "0"))
                if r["op"] in ("CREATE", "CALL", "STATICCALL"):
                    assert g["gas_self"] == max(0, g["gas_used"] - sum(got[tx, x["idx"]]["gas_used"] for x in inside if x["depth"] == r["depth"] + 1))


def test_sums_of_a_trace_hold(spark):
    """Invariants: own gas of all frames adds up to the root's; every row is in one frame; a path ends in its frame and begins at 0."""
    rng = random.Random(12)
    rows = [r for tx in range(12) for r in random_trace(rng, tx, [-2, -1, 0, 0, 1])]
    heads = spark.createDataFrame([(t, "0xab", 10**6, False, "", 0) for t in range(12)], "tx long, to_address string, trace_gas long, trace_failed boolean, trace_return_value string, transaction_index long")
    out = tr.frame_agg_table(frame(spark, rows), heads, ["tx"]).collect()
    for tx in range(12):
        frames = {r["call_frame_id"]: r for r in out if r["tx"] == tx and r["operation"] == ""}
        assert sorted(frames) == list(range(len(frames)))
        assert sum(r["opcode_count"] for r in frames.values()) == sum(r["tx"] == tx for r in rows)
        for f in frames.values():
            assert f["call_frame_path"][0] == 0 and f["call_frame_path"][-1] == f["call_frame_id"]
            if f["call_frame_id"]:
                assert f["call_frame_path"][:-1] == frames[f["parent_call_frame_id"]]["call_frame_path"]
            assert f["gas"] == max(0, f["gas_cumulative"] - sum(x["gas_cumulative"] for x in frames.values() if x["parent_call_frame_id"] == f["call_frame_id"]))


def test_plan_has_one_scan_and_one_exchange_by_the_key(spark, tmp_path):
    rng = random.Random(13)
    frame(spark, [r for tx in range(5) for r in random_trace(rng, tx, [-1, 0, 1])]).write.parquet(str(tmp_path / "t"))
    rows = tr.frame_opcodes(tr.frame_rows(tr.annotated(spark.read.parquet(str(tmp_path / "t")), ["tx"], True, created=False), ["tx"]), ["tx"])
    plan = rows._jdf.queryExecution().explainString(rows._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning(tx#") == 1 and "Join" not in plan and "Python" not in plan and "Pandas" not in plan


COLUMNS = ["tx", "idx", "frame_id", "synthetic_id", "parent_at_entry", "gas_used", "gas_self"]


def test_windows_equal_the_sequential_reading(spark):
    rng = random.Random(3)
    rows = [r for tx in range(40) for r in random_trace(rng, tx, [-2, -1, 0, 0, 1])]
    df = fr.normal(frame(spark, rows))
    assert fr.with_malformed(df, ["tx"]).where("malformed").isEmpty()
    for precompile in (False, True):
        a = fr.with_gas(fr.with_frames(df, ["tx"], precompile), ["tx"]).select(*COLUMNS).collect()
        b = sq.with_frames_and_gas(df, ["tx"], precompile).select(*COLUMNS).collect()
        assert normal(map(tuple, a)) == normal(map(tuple, b))


def test_malformed_traces_take_the_sequential_way(spark):
    rng = random.Random(4)
    rows = [r for tx in range(10) for r in random_trace(rng, tx, [-2, 0, 1, 2, 3])] + trace([("CALL", 50, 1, 2), ("ADD", 40, 1, 1)], 99)
    df = frame(spark, rows)
    bad = {r["tx"] for r in fr.with_malformed(df, ["tx"]).where("malformed").collect()}
    assert 99 in bad
    heads = spark.createDataFrame([(t, "0xab", 10**6, False, "", 0) for t in [*range(10), 99, 100]], "tx long, to_address string, trace_gas long, trace_failed boolean, trace_return_value string, transaction_index long")
    out = tr.frame_agg_table(df, heads, ["tx"])
    n = {r["tx"]: r["n"] for r in out.where("operation <> ''").groupBy("tx").agg(F.sum("opcode_count").alias("n")).collect()}
    want = {t: sum(r["tx"] == t for r in rows) for t in [*range(10), 99]}
    assert n == want
    idle = out.where("tx = 100").collect()
    assert len(idle) == 1 and idle[0]["intrinsic_gas"] == 10**6
    t1 = tr.opcode_table(df, heads, ["tx"])
    assert t1.where("operation <> ''").count() == len(rows)
    assert t1.where("size(call_frame_path) = 0 or call_frame_path is null").isEmpty()


def test_precompile_gas_is_preserved(spark):
    ops = [("CALL", 10000, 3100, 1, {"call_to_address": "0x" + "0" * 39 + "1", "mem_size": 0}), ("STOP", 6900, 0, 1)]
    df = tr.annotated(frame(spark, trace(ops)), ["tx"], True)
    r = df.where("idx = 0").first()
    assert (r["own_gas"], r["precompile_gas"]) == (100, 3000)


def tracer_fields(rng, rows):
    """Some traces with a tracer's gas and addresses, some opcodes with addresses of precompiles."""
    for r in rows:
        if r["tx"] % 3 == 0:
            r |= {"gas_used": rng.randint(1, 90), "call_to_address": rng.choice([None, "0x" + "0" * 39 + "4", "0x" + "7" * 40]) if r["op"] in ("CALL", "STATICCALL", "CREATE") else None}
        r["error"] = rng.choice([None, None, "", "out of gas"])
    return rows


def test_segments_equal_the_whole_trace(spark):
    """The same rows for chunks of 1, 7 and all places, of deep and flat traces, with and without a tracer's values."""
    rng = random.Random(21)
    rows = tracer_fields(rng, [r for tx in range(24) for r in random_trace(rng, tx, [[-2, -1, 0, 0, 1], [-1, 0, 1, 1], [-9, 1, 1, 1, 1]][tx % 3])])
    df = frame(spark, rows, SCHEMA + ", gas_used long").repartition(3)
    options = {"use_tracer_create_address": True, "resolve_targets": True}
    for precompile, created, chosen in ((False, True, {}), (True, False, {}), (True, True, options)):
        whole = tr.annotated(df, ["tx"], precompile, created=created, **chosen)
        columns = sorted(whole.columns)
        want = normal(map(tuple, whole.select(*columns).collect()))
        for chunk in (1, 7, 1_000):
            cut = tr.annotated(df, ["tx"], precompile, created=created, longest=0, chunk_rows=chunk, **chosen)
            assert sorted(cut.columns) == columns
            assert normal(map(tuple, cut.select(*columns).collect())) == want, chunk


def test_only_long_traces_are_cut(spark):
    """Long, short and malformed traces in one table; the tables are the same as without segments."""
    rng = random.Random(22)
    rows = [r for tx in range(20) for r in random_trace(rng, tx, [-1, 0, 1] if tx % 4 else [-2, 0, 1, 2, 3])]
    heads = spark.createDataFrame([(t, "0xab", 10**6, False, "", 0) for t in range(20)], "tx long, to_address string, trace_gas long, trace_failed boolean, trace_return_value string, transaction_index long")
    df = frame(spark, rows)
    for plan in (tr.opcode_table, tr.frame_agg_table):
        a, b = plan(df, heads, ["tx"]), plan(df, heads, ["tx"], longest=15)
        assert normal(map(tuple, a.collect())) == normal(map(tuple, b.select(*a.columns).collect()))


def test_malformed_traces_by_chunks(spark):
    from tracelake.operators import segmented as sg

    rng = random.Random(23)
    df = frame(spark, [r for tx in range(30) for r in random_trace(rng, tx, [-1, 0, 1, rng.choice([1, 2])])] + trace([("A", 5, 1, 2)], 98) + trace([("A", 5, 1, 1), ("A", 4, 1, None), ("A", 3, 1, 1)], 99))
    want = {r["tx"] for r in fr.with_malformed(df, ["tx"]).where("malformed").collect()}
    assert {98, 99} < want and len(want) < 32
    for chunk in (1, 4, 99):
        assert {r["tx"] for r in sg.malformed(df, ["tx"], chunk).collect()} == want


def test_one_long_trace_runs_in_many_tasks(spark):
    """300,000 opcodes in one transaction, in chunks of 20,000: the longest window task reads a fraction of the rows."""
    depth = (F.col("id") % 60 - 29)
    df = spark.range(300_000).select(
        F.lit(1).cast("long").alias("tx"), F.col("id").alias("idx"), F.when(F.col("id") % 60 < 30, "CALL").otherwise("ADD").alias("op"), (F.lit(10**9) - F.col("id") * 7).alias("gas"), F.lit(7).cast("decimal(20,0)").alias("gas_cost"),
        (F.lit(31) - F.abs(depth)).cast("int").alias("depth"), (F.col("id") % 900 * 32).alias("mem_size"), F.lit(None).cast("string").alias("error"),
    )
    names = ["idx", "frame_id", "gas_used", "gas_self", "words_before", "words_after", "mem_exp"]
    rows = tr.annotated(df, ["tx"], longest=100_000, chunk_rows=20_000, fallback=False).select(*names)
    whole = tr.annotated(df, ["tx"], fallback=False).select(*names)
    assert rows.exceptAll(whole).isEmpty() and rows.count() == 300_000
    sizes = [r["n"] for r in rows.groupBy(F.floor(F.col("idx") / 20_000)).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 15 and max(sizes) == 20_000


def read_in_order(ops):
    """Frames of a trace by reading its opcodes one after the other with the stack of open frames: entry, frame, parent, synthetic id."""
    open_, number, out = [(1, 0)], 1, []
    for r, behind in zip(ops, [*ops[1:], None]):
        level, parent = max(r["depth"], 1), None
        entry = level > open_[-1][0]
        if entry:
            parent = open_[-1][1]
            open_.append((level, number))
            number += 1
        while open_[-1][0] > level:
            open_.pop()
        address = None if r["s2"] is None else int(r["s2"][-40:], 16)
        at_once = r["op"] in ("CALL", "STATICCALL") and address is not None and behind is not None and behind["depth"] == r["depth"] and not (1 <= address <= 17 or address == 256)
        out.append((entry, open_[-1][1], parent, number if at_once else None))
        number += at_once
    return out


def test_malformed_traces_by_the_stack_of_open_frames(spark):
    rng = random.Random(31)
    rows = [r for tx in range(60) for r in random_trace(rng, tx, rng.choice([[-2, 0, 1, 2, 3], [-4, -1, 0, 3], [-1, 0, 2]]))]
    for r in rows:
        if r["tx"] % 5 == 0:
            r["depth"] += 1  # begins at 2
        elif r["tx"] % 5 == 1 and rng.random() < 0.1:
            r["depth"] = 0
    got = {(r["tx"], r["idx"]): (r["entry"], r["frame_id"], r["parent_at_entry"], r["synthetic_id"]) for r in sq.with_frames_and_gas(fr.normal(frame(spark, rows)), ["tx"]).collect()}
    assert len(got) == len(rows)
    for tx in range(60):
        ops = sorted((r for r in rows if r["tx"] == tx), key=lambda r: r["idx"])
        assert [got[tx, r["idx"]] for r in ops] == read_in_order(ops)


def test_malformed_traces_stay_in_the_jvm(spark):
    rng = random.Random(32)
    df = frame(spark, [r for tx in range(4) for r in random_trace(rng, tx, [-2, 0, 1, 2, 3])])
    assert not fr.with_malformed(df, ["tx"]).where("malformed").isEmpty()
    plan = tr.annotated(df, ["tx"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_missing_depths_and_long_malformed_traces(spark):
    rows = trace([("CALL", 90, 1, None), ("ADD", 80, 2, 3), ("ADD", 70, 3, None), ("STOP", 60, 0, 1)], 1)
    got = sq.with_frames_and_gas(fr.normal(frame(spark, rows)), ["tx"]).orderBy("idx").collect()
    assert [(r["depth"], r["frame_id"], r["gas_used"]) for r in got] == [(1, 0, 30), (3, 1, 10), (3, 1, 3), (1, 0, 0)]
    assert tr.annotated(frame(spark, rows), ["tx"]).count() == 4
    n = 20_000
    long = spark.range(n).select(F.lit(1).cast("long").alias("tx"), F.col("id").alias("idx"), F.lit("ADD").alias("op"), (F.lit(10**6) - F.col("id")).alias("gas"), F.lit(1).cast("decimal(20,0)").alias("gas_cost"), (F.col("id") % 3 * 2 + 1).cast("int").alias("depth"))
    out = sq.with_frames_and_gas(fr.normal(long), ["tx"]).agg(F.count("*"), F.max("frame_id"), F.sum(F.col("entry").cast("int"))).first()
    assert tuple(out) == (n, 2 * n // 3, 2 * n // 3)


def explained(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_tables_read_their_source_once_and_leave_nothing(spark, tmp_path):
    """Beside the check for malformed traces each table scans the traces once, when it writes its scratch table; and cleanup deletes that."""
    import os

    from tracelake.plans import store

    rng = random.Random(14)
    frame(spark, [r for tx in range(5) for r in random_trace(rng, tx, [-1, 0, 1])]).write.parquet(str(tmp_path / "t"))
    heads = spark.createDataFrame([(t, "0xab", 10**6, False, "", 0) for t in range(7)], "tx long, to_address string, trace_gas long, trace_failed boolean, trace_return_value string, transaction_index long")
    for plan in (tr.opcode_table, tr.frame_agg_table):
        out = plan(spark.read.parquet(str(tmp_path / "t")), heads, ["tx"])
        assert str(tmp_path) not in explained(out) and out.select("tx").distinct().count() == (5 if plan is tr.opcode_table else 7)
    written = set(tr.settle(tr.annotated(spark.read.parquet(str(tmp_path / "t")), ["tx"]).select("tx", *tr.OPCODE), "x").columns)
    assert not written & {"words_before", "mem_exp", "cold", "own_gas"}
    root = store._scratch_dir(spark).removeprefix("file:").replace("//", "/")
    assert os.listdir(root)
    store.cleanup(spark)
    assert not os.path.exists(root)


HEAD = "tx long, to_address string, trace_gas long, trace_failed boolean, trace_return_value string, transaction_index long"


def padded(n):
    return f"0x{n:040x}"


def test_creates_that_a_tracer_knows(spark):
    """By default they have no address, with the option the tracer's; the trace's first create decides, also where depths jump."""
    ops = [
        ("CREATE", 900, 1, 1, {"call_to_address": padded(0xA1)}), ("STOP", 800, 0, 2), ("CREATE2", 700, 1, 1, {"s1": "0xee"}), ("STOP", 600, 0, 2), ("ADD", 500, 1, 1, {"s1": "0xbb"}),
    ]
    late = [(*o[:4], {"s1": o[4].get("s1")}) if i == 0 else o for i, o in enumerate(ops)]
    late[2] = ("CREATE2", 700, 1, 1, {"s1": "0xee", "call_to_address": padded(0xA2)})
    jumps = [(op, gas, cost, 1 if depth == 1 else 4, *rest) for op, gas, cost, depth, *rest in ops]
    df = frame(spark, trace(ops, 1) + trace(late, 2) + trace(jumps, 3))
    heads = spark.createDataFrame([(t, "0xab", 10**6, False, "", 0) for t in (1, 2, 3)], HEAD)
    for chosen, traced in (({}, [None, None]), ({"use_tracer_create_address": True}, [padded(0xA1), None])):
        rows = tr.opcode_table(df, heads, ["tx"], **chosen).where("operation like 'CREATE%'").orderBy("tx", "index").collect()
        assert [r["call_to_address"] for r in rows] == [*traced, padded(0xEE), padded(0xBB), *traced]


def test_targets_of_frames_without_a_tracer(spark):
    """Null by default but for frames that return at once; resolved from the call's operand or the created address."""
    ops = [
        ("CALL", 900, 1, 1, {"s2": "0xc1"}), ("STOP", 880, 0, 2), ("STATICCALL", 860, 1, 1, {"s2": "0xc2"}), ("CREATE", 840, 1, 1), ("CALL", 820, 1, 2, {"call_to_address": padded(0xC3), "s2": "0xdd"}), ("STOP", 800, 0, 3), ("STOP", 790, 0, 2),
        ("ADD", 780, 1, 1, {"s1": "0xc4"}), ("CREATE", 760, 1, 1), ("STOP", 740, 0, 2),
    ]
    jumps = [(op, gas, cost, depth if depth == 1 else depth + 2, *rest) for op, gas, cost, depth, *rest in ops]
    df = frame(spark, trace(ops, 1) + trace(jumps, 2))
    heads = spark.createDataFrame([(t, "0xab", 10**6, False, "", 0) for t in (1, 2)], HEAD)
    # frames: root, the first call's, the static call's, the create's and in it a call's, the last create's, which never returns
    kept = ["0xab", None, padded(0xC2), None, padded(0xC3), None]
    resolved = ["0xab", padded(0xC1), padded(0xC2), padded(0xC4), padded(0xC3), None]
    for chosen, want in (({}, kept), ({"resolve_targets": True}, resolved)):
        rows = tr.frame_agg_table(df, heads, ["tx"], **chosen).where("operation = ''").orderBy("tx", "call_frame_id").collect()
        assert [r["target_address"] for r in rows] == want * 2


def test_depth_zero_is_the_root(spark):
    """Frames count it as the top; gas is found by the depths as they are."""
    ops = [("CALL", 900, 5, 0), ("ADD", 850, 3, 1), ("ADD", 840, 3, 1), ("STOP", 700, 0, 0)]
    got = tr.annotated(frame(spark, trace(ops)), ["tx"]).orderBy("idx").collect()
    assert [r["frame_id"] for r in got] == [0, 0, 0, 0]
    assert [r["gas_used"] for r in got] == [200, 10, 3, 0]
    assert got[0]["gas_self"] == 200 - 13
