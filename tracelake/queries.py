"""The registered queries: each operator over tables derived from the given ones, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake import functions as fn
from tracelake.operators import frames as fr
from tracelake.operators import resources as rs
from tracelake.plans import progress as pg
from tracelake.plans import traces as tr
from tracelake.plans import transactions as tx
from tracelake.plans import store
from tracelake.sources import derive, embedded, readers, schemas, sinks, versions

KEY = ["tx"]
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# ---------------------------------------------------------------- SQL building blocks
# Opcode names, addresses of precompiles and gas numbers in these statements are fixed values of the machine's rules.

_CALLS = "('CALL','CALLCODE','DELEGATECALL','STATICCALL')"
_PRE = "(lower(call_to_address) IN (" + ",".join(f"'0x{n:040x}'" for n in [*range(1, 18), 256]) + "))"
_T = "OVER (PARTITION BY tx ORDER BY idx)"
_RUN = "OVER (PARTITION BY tx ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_F = "OVER (PARTITION BY tx, fid ORDER BY idx)"


def _chain(all_frames: bool) -> str:
    """CTEs up to ``g``: every opcode with frame, gas, memory, cold count and precompile split."""
    plain = "" if all_frames else f" AND NOT {_PRE}"
    return f"""WITH s AS ({derive.STRUCTLOG_SRC}),
a AS (SELECT *, lead(depth) {_T} AS nd, depth > coalesce(lag(depth) {_T}, 1) AS entry, lag(op) {_T} AS prev_op, lag(call_to_address) {_T} AS prev_addr FROM s),
b AS (SELECT *, coalesce(op IN {_CALLS} AND call_to_address IS NOT NULL AND nd = depth{plain}, false) AS syn FROM a),
c AS (SELECT *, sum(CAST(entry AS INT) + CAST(syn AS INT)) {_RUN} AS iss FROM b),
d AS (SELECT *, CASE WHEN entry THEN iss - CAST(syn AS INT) END AS eid, CASE WHEN syn THEN CAST(iss AS BIGINT) END AS sid FROM c),
e AS (SELECT *, CAST(coalesce(last_value(eid IGNORE NULLS) OVER (PARTITION BY tx, depth ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT) AS fid FROM d),
f0 AS (SELECT *, CASE WHEN lead(gas) {_F} <= gas THEN gas - lead(gas) {_F} ELSE gas_cost END AS used, (mem_size + 31) // 32 AS wb, coalesce(lead((mem_size + 31) // 32) {_F}, (mem_size + 31) // 32) AS wa, lag(fid) {_T} AS before_fid FROM e),
f1 AS (SELECT *, CAST(sum(used) OVER (PARTITION BY tx, fid) AS BIGINT) AS frame_used, CASE WHEN wa > wb THEN 3 * wa + wa * wa // 512 - 3 * wb - wb * wb // 512 ELSE 0 END AS mem_exp FROM f0),
f2 AS (SELECT *, CASE WHEN op IN ('CALL','CALLCODE','DELEGATECALL','STATICCALL','CREATE','CREATE2') AND nd > depth THEN greatest(0, used - lead(frame_used) {_T}) ELSE used END AS gself FROM f1),
f3 AS (SELECT *, greatest(0, gself - mem_exp) AS r0 FROM f2),
f4 AS (SELECT *, CASE WHEN op IN ('CALL','CALLCODE') AND call_transfers_value THEN CASE WHEN greatest(0, r0 - 9000) > 5200 THEN greatest(0, r0 - 34000) ELSE greatest(0, r0 - 9000) END ELSE r0 END AS r1 FROM f3),
g AS (SELECT *, CAST(CASE WHEN op IN ('SLOAD','BALANCE','EXTCODESIZE','EXTCODEHASH') THEN CASE WHEN gas_cost > 100 THEN 1 ELSE 0 END WHEN op = 'SSTORE' THEN CASE WHEN gas_cost IN (22100, 5000, 2200) THEN 1 ELSE 0 END
  WHEN op = 'SELFDESTRUCT' THEN CASE WHEN gas_cost IN (7600, 32600) THEN 1 ELSE 0 END WHEN op = 'EXTCODECOPY' THEN CASE WHEN greatest(0, r0 - 3 * ((ext_code_copy_size + 31) // 32)) >= 2600 THEN 1 ELSE 0 END
  WHEN op IN {_CALLS} THEN CASE WHEN coalesce({_PRE}, false) THEN 0 WHEN r1 >= 5200 THEN 2 WHEN r1 >= 2600 THEN 1 ELSE 0 END ELSE 0 END AS BIGINT) AS cold,
  CAST(CASE WHEN coalesce(op IN {_CALLS} AND nd = depth AND {_PRE}, false) AND gself > 100 + mem_exp THEN gself - 100 - mem_exp ELSE 0 END AS BIGINT) AS pre FROM f4)"""


_PATHS = """,
ft AS (SELECT DISTINCT tx, CAST(0 AS BIGINT) AS fid, CAST(NULL AS BIGINT) AS parent FROM g UNION ALL SELECT tx, fid, before_fid FROM g WHERE entry UNION ALL SELECT tx, sid, fid FROM g WHERE syn),
fp(tx, fid, path) AS (SELECT tx, fid, CAST(fid AS VARCHAR) FROM ft WHERE parent IS NULL UNION ALL SELECT ft.tx, ft.fid, fp.path || '/' || CAST(ft.fid AS VARCHAR) FROM ft JOIN fp ON ft.tx = fp.tx AND ft.parent = fp.fid)"""

_AGG = """,
r AS (SELECT tx, fid, 2 * idx AS seq, op, gas, used, gself - pre AS self, CASE WHEN coalesce(error, '') <> '' THEN 1 ELSE 0 END AS err, coalesce(refund, 0) AS refund, depth, wb, wa, mem_exp, cold,
        CASE WHEN entry THEN prev_op END AS cop, CASE WHEN entry THEN prev_addr END AS ctgt, CASE WHEN entry THEN before_fid END AS parent FROM g
      UNION ALL SELECT tx, sid, 2 * idx + 1, '', 0, pre, pre, 0, 0, depth + 1, 0, 0, 0, 0, op, call_to_address, fid FROM g WHERE syn),
fs AS (SELECT tx, fid, sum(CASE WHEN op <> '' THEN 1 ELSE 0 END) AS n, sum(err) AS e, arg_min(gas, seq) AS g0, arg_max(gas, seq) AS g1, arg_max(used, seq) AS u1, max(refund) AS mr, arg_min(depth, seq) AS d0, max(cop) AS cop, max(ctgt) AS ctgt, max(parent) AS parent,
        sum(wb) AS wb, sum(wa) AS wa, sum(wb * wb) AS wb2, sum(wa * wa) AS wa2, sum(mem_exp) AS mem_exp, sum(cold) AS cold FROM r GROUP BY tx, fid),
fc AS (SELECT *, CASE WHEN g0 >= g1 THEN g0 - g1 + u1 ELSE u1 END AS cum FROM fs),
fk AS (SELECT tx, parent AS fid, sum(cum) AS inner_cum FROM fc WHERE parent IS NOT NULL GROUP BY tx, parent),
t AS (SELECT o_orderkey AS tx, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('0x', lpad(CAST(o_custkey AS VARCHAR(20)), 40, '0')) END AS to_address, CAST(21000 + floor(o_totalprice) AS BIGINT) * 20 AS trace_gas, o_orderstatus = 'F' AS trace_failed FROM orders),
fo AS (SELECT fc.*, greatest(0, cum - coalesce(inner_cum, 0)) AS own, t.to_address, t.trace_gas, t.trace_failed, CASE WHEN fc.fid = 0 AND trace_failed AND e = 0 THEN 1 ELSE e END AS errors,
        CASE WHEN fc.fid = 0 THEN 0 ELSE d0 - 1 END AS fdepth FROM fc LEFT JOIN fk ON fc.tx = fk.tx AND fc.fid = fk.fid JOIN t ON fc.tx = t.tx),
fr AS (SELECT *, CASE WHEN errors > 0 THEN 0 ELSE mr END AS ref, CASE WHEN fid = 0 THEN to_address ELSE ctgt END AS tgt, CASE WHEN fid = 0 THEN '' WHEN cop IN ('CALL','CALLCODE','DELEGATECALL','STATICCALL','CREATE','CREATE2') THEN cop ELSE 'UNKNOWN' END AS ct FROM fo),
fi AS (SELECT *, CASE WHEN fid = 0 AND trace_gas > 0 THEN CASE WHEN ref >= trace_gas // 4 THEN trace_gas * 5 // 4 - cum ELSE trace_gas + ref - cum END END AS raw FROM fr)"""


def query(name: str, sql: str | None = None):
    """Register a query and its SQL."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


# ---------------------------------------------------------------- inputs


def _traces(spark: SparkSession, d: str) -> DataFrame:
    df = derive.derived(spark, d, "structlog_src")
    return df.withColumn("idx", F.col("idx").cast("long")).withColumnRenamed("stack_top", "s1")


def _headers(spark: SparkSession, d: str) -> DataFrame:
    orders = spark.read.parquet(f"{d}/orders.parquet")
    key = F.col("o_orderkey")
    return orders.select(
        key.alias("tx"), F.when(key % 17 != 0, F.concat(F.lit("0x"), F.lpad(F.col("o_custkey").cast("string"), 40, "0"))).alias("to_address"), ((F.lit(21000) + F.floor("o_totalprice").cast("long")) * 20).cast("long").alias("trace_gas"),
        (F.col("o_orderstatus") == "F").alias("trace_failed"), F.lit(None).cast("string").alias("trace_return_value"), (key % 64).cast("long").alias("transaction_index"),
    )


def _annotated(spark: SparkSession, d: str, all_frames: bool = False) -> DataFrame:
    return tr.annotated(_traces(spark, d), KEY, all_frames, created=False)


def _transactions(spark: SparkSession, d: str) -> DataFrame:
    return derive.derived(spark, d, "tx_src")


def _progress(spark: SparkSession, d: str) -> DataFrame:
    return derive.derived(spark, d, "progress_src")


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return pg.latest_version(_progress(spark, d), ["version_tiebreak"])


def _scopes(spark: SparkSession, d: str) -> DataFrame:
    return _progress(spark, d).select(*pg.SCOPE).distinct()


def _text(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), "/")


_HEX = """WITH h AS (SELECT l_orderkey AS k, l_linenumber AS n, CASE l_partkey % 9 WHEN 0 THEN '' WHEN 1 THEN '0x' WHEN 2 THEN concat('0x', l_returnflag, l_linestatus) WHEN 3 THEN concat('0x', lpad(CAST(l_suppkey AS VARCHAR(20)), 64, '0')) WHEN 4 THEN '0x0000000000000000000000000000000000000000'
  WHEN 5 THEN concat('0x1', lpad(CAST(l_partkey AS VARCHAR(20)), 16, '0')) WHEN 6 THEN CAST(l_partkey AS VARCHAR(20)) WHEN 7 THEN concat('0x', repeat('f', CAST(1 + l_suppkey % 18 AS INT))) ELSE concat('0xAb', CAST(l_partkey AS VARCHAR(20))) END AS w FROM lineitem)"""


def _hexes(spark: SparkSession, d: str) -> DataFrame:
    """Words of all kinds, made of lineitem's keys and comments."""
    return spark.sql(_HEX.replace("FROM lineitem", f"FROM parquet.`{d}/lineitem.parquet`") + " SELECT k, n, w FROM h")


# ---------------------------------------------------------------- scalar operators


@query("sanitize_gas_cost", "SELECT l_orderkey AS k, l_linenumber AS n, CAST(least(CASE WHEN l_partkey % 7 = 0 THEN CAST(18446744073709551615 AS DECIMAL(20,0)) ELSE CAST(l_partkey AS DECIMAL(20,0)) END, CAST(l_suppkey * 40 AS DECIMAL(20,0))) AS BIGINT) AS gas_cost FROM lineitem")
def sanitize_gas_cost(spark, d):
    df = spark.read.parquet(f"{d}/lineitem.parquet")
    raw = F.when(F.col("l_partkey") % 7 == 0, F.lit("18446744073709551615").cast("decimal(20,0)")).otherwise(F.col("l_partkey").cast("decimal(20,0)"))
    df = df.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), raw.alias("gas_cost"), (F.col("l_suppkey") * 40).cast("long").alias("gas"))
    return fr.normal(df).select("k", "n", "gas_cost")


@query("format_address", _HEX + " SELECT k, n, concat('0x', lpad(right(regexp_replace(w, '^0x', ''), 40), 40, '0')) AS address FROM h")
def format_address(spark, d):
    return _hexes(spark, d).select("k", "n", fn.format_address(F.col("w")).alias("address"))


@query("parse_hex_u64", _HEX + r", z AS (SELECT *, regexp_replace(w, '^(0x)?0*', '') AS x FROM h) SELECT k, n, CAST(CASE WHEN regexp_full_match(x, '[0-9a-fA-F]{1,16}') THEN CAST(('0x' || x) AS UBIGINT) ELSE 0 END AS DECIMAL(20,0)) AS value FROM z")
def parse_hex_u64(spark, d):
    return _hexes(spark, d).select("k", "n", fn.parse_hex_u64(F.col("w")).alias("value"))


@query("parse_hex_u32", _HEX + r", z AS (SELECT *, regexp_replace(w, '^0x', '') AS x, regexp_replace(w, '^(0x)?0*', '') AS y FROM h) SELECT k, n, CAST(CASE WHEN x = '' THEN 0 WHEN regexp_full_match(x, '0+') THEN 0 WHEN regexp_full_match(y, '[0-9a-fA-F]{1,8}') THEN CAST(('0x' || y) AS UBIGINT) ELSE 4294967295 END AS BIGINT) AS value FROM z")
def parse_hex_u32(spark, d):
    return _hexes(spark, d).select("k", "n", fn.parse_hex_u32(F.col("w")).alias("value"))


@query("is_hex_zero", _HEX + " SELECT k, n, regexp_full_match(w, '(0x)?0*') AS zero FROM h")
def is_hex_zero(spark, d):
    return _hexes(spark, d).select("k", "n", fn.is_hex_zero(F.col("w")).alias("zero"))


@query("is_precompile", _HEX + " SELECT k, n, lower(concat('0x', lpad(right(regexp_replace(w, '^0x', ''), 40), 40, '0'))) IN (" + ",".join(f"'0x{n:040x}'" for n in [*range(1, 18), 256]) + ") AS precompile FROM h")
def is_precompile(spark, d):
    return _hexes(spark, d).select("k", "n", fn.is_precompile(F.col("w")).alias("precompile"))


@query("call_target", _HEX + f", z AS (SELECT *, CASE n % 4 WHEN 0 THEN 'CALL' WHEN 1 THEN 'STATICCALL' WHEN 2 THEN 'CREATE' ELSE 'ADD' END AS op, CASE WHEN k % 5 = 0 THEN 'tracer' END AS t FROM h) SELECT k, n, coalesce(t, CASE WHEN op IN {_CALLS} THEN concat('0x', lpad(right(regexp_replace(w, '^0x', ''), 40), 40, '0')) END) AS target FROM z")
def call_target(spark, d):
    op = F.element_at(F.array(*map(F.lit, ("CALL", "STATICCALL", "CREATE", "ADD"))), (F.col("n") % 4 + 1).cast("int"))
    return _hexes(spark, d).select("k", "n", fn.call_target(op, F.when(F.col("k") % 5 == 0, "tracer"), F.col("w")).alias("target"))


@query("call_has_value", _HEX + " SELECT k, n, k % 6 = 0 OR NOT regexp_full_match(w, '(0x)?0*') AS has_value FROM h")
def call_has_value(spark, d):
    return _hexes(spark, d).select("k", "n", fn.call_has_value(F.col("k") % 6 == 0, F.col("w")).alias("has_value"))


@query("extcodecopy_size", _HEX + r", z AS (SELECT *, regexp_replace(w, '^0x', '') AS x, regexp_replace(w, '^(0x)?0*', '') AS y, CASE WHEN k % 3 = 0 THEN k ELSE 0 END AS size FROM h) SELECT k, n, CAST(CASE WHEN size > 0 THEN size WHEN x = '' OR regexp_full_match(x, '0+') THEN 0 WHEN regexp_full_match(y, '[0-9a-fA-F]{1,8}') THEN CAST(('0x' || y) AS UBIGINT) ELSE 4294967295 END AS BIGINT) AS size FROM z")
def extcodecopy_size(spark, d):
    size = F.when(F.col("k") % 3 == 0, F.col("k")).otherwise(0)
    return _hexes(spark, d).select("k", "n", fn.extcodecopy_size(size, F.col("w")).cast("long").alias("size"))


@query("effective_gas_price", f"WITH t AS ({derive.TX_SRC}) SELECT tx_id, CAST(CASE WHEN type <= 1 OR base_fee IS NULL THEN gas_price ELSE least(base_fee + gas_tip_cap, gas_fee_cap) END AS DECIMAL(38,0)) AS price FROM t")
def effective_gas_price(spark, d):
    c = F.col
    return _transactions(spark, d).select("tx_id", fn.effective_gas_price(c("type"), c("gas_price"), c("base_fee"), c("gas_tip_cap"), c("gas_fee_cap")).alias("price"))


@query("calldata_stats", f"WITH t AS ({derive.TX_SRC}), z AS (SELECT tx_id, input_hex, len(list_filter(range(1, len(input_hex), 2), lambda i: substr(input_hex, i, 2) = '00')) AS zeros FROM t) SELECT tx_id, CAST(len(input_hex) // 2 AS BIGINT) AS n_input_bytes, CAST(zeros AS BIGINT) AS n_input_zero_bytes, CAST(len(input_hex) // 2 - zeros AS BIGINT) AS n_input_nonzero_bytes FROM z")
def calldata_stats(spark, d):
    stats = fn.calldata_stats(F.unhex("input_hex"))
    return _transactions(spark, d).select("tx_id", *[v.alias(k) for k, v in stats.items()])


@query("network_name", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'mainnet' WHEN 1 THEN 'sepolia' WHEN 2 THEN 'holesky' ELSE 'hoodi' END AS network FROM orders")
def network_name(spark, d):
    ids = F.array(*[F.lit(x).cast("long") for x in (1, 11155111, 17000, 560048)])
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", readers.network_name(F.element_at(ids, (F.col("o_orderkey") % 4 + 1).cast("int"))).alias("network"))


# ---------------------------------------------------------------- traces


@query("immediate_return", _chain(True) + f" SELECT tx, CAST(idx AS BIGINT) AS idx, coalesce(op IN {_CALLS} AND call_to_address IS NOT NULL AND nd = depth, false) AS at_once FROM g")
def immediate_return(spark, d):
    df = _traces(spark, d).withColumn("next_depth", F.lead("depth").over(fr.in_trace(KEY)))
    return df.select("tx", "idx", fr.immediate_return(F.col("op"), F.col("call_to_address"), F.col("depth"), F.col("next_depth")).alias("at_once"))


@query("plain_account_call", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, call_to_address FROM g WHERE syn")
def plain_account_call(spark, d):
    return fr.with_frames(fr.normal(_traces(spark, d)), KEY).where("synthetic").select("tx", "idx", "call_to_address")


@query("frame_id", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, fid AS frame_id FROM g")
def frame_id(spark, d):
    return fr.with_frames(fr.normal(_traces(spark, d)), KEY).select("tx", "idx", "frame_id")


@query("traced_gas_used", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, CAST(CASE WHEN tx % 3 = 0 THEN gas_cost + 7 ELSE used END AS BIGINT) AS gas_used FROM g")
def traced_gas_used(spark, d):
    """Traces with the tracer's gas (a third), with tracer gas that begins with 0 (a third), and without."""
    traced = F.when(F.col("tx") % 3 == 0, F.col("gas_cost") + 7).when(F.col("tx") % 3 == 1, F.when(F.col("idx") > 0, 5).otherwise(0))
    return tr.annotated(_traces(spark, d).withColumn("gas_used", traced.cast("long")), KEY, created=False).select("tx", "idx", "gas_used")


@query("stack_call_target", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, sid AS frame_id, call_to_address AS target FROM g WHERE syn")
def stack_call_target(spark, d):
    """Traces whose call targets are on the stack alone."""
    df = _traces(spark, d).withColumn("s2", F.regexp_replace("call_to_address", "^0x0*", "0x")).withColumn("call_to_address", F.lit(None).cast("string"))
    return tr.annotated(df, KEY).where("synthetic").select("tx", "idx", F.col("synthetic_id").alias("frame_id"), "target")


@query("malformed_traces", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, fid AS frame_id, sid AS synthetic_id, used AS gas_used, CAST(CASE WHEN depth >= 2 THEN used ELSE gself END AS BIGINT) AS gas_self FROM g")
def malformed_traces(spark, d):
    """Traces whose depths jump from 2 to 5 and from 5 to 7: frames stay as they are, and no opcode has a frame one level down to take off."""
    jumps = F.when(F.col("depth") == 3, 5).when(F.col("depth") == 4, 7).otherwise(F.col("depth")).cast("int")
    return tr.annotated(_traces(spark, d).withColumn("depth", jumps), KEY, created=False).select("tx", "idx", "frame_id", "synthetic_id", "gas_used", "gas_self")


@query("read_traces", "WITH s AS (" + derive.STRUCTLOG_SRC + ") SELECT CAST(tx AS VARCHAR) AS transaction_hash, CAST(idx AS BIGINT) AS idx, op, gas, gas_cost, CAST(depth AS BIGINT) AS depth, refund, error, mem_size, call_to_address, stack_top AS s1, CASE WHEN op = 'CREATE' THEN NULL ELSE '0x2' END AS s2, CASE WHEN op IN ('RETURN', 'REVERT') THEN '01ff' END AS return_data FROM s")
def read_traces(spark, d):
    """The derived traces as JSON documents, read as landed ones are."""
    bottom = F.when(F.col("op") == "CREATE", F.array("s1")).otherwise(F.array(F.lit("0x2"), "s1"))
    log = F.struct("idx", "op", "gas", F.col("gas_cost").alias("gasCost"), "depth", "refund", "error", F.col("mem_size").alias("memSize"), F.col("call_to_address").alias("callToAddress"), bottom.alias("stack"), F.when(F.col("op").isin("RETURN", "REVERT"), "Af8=").alias("returnData"))
    docs = _traces(spark, d).groupBy("tx").agg(F.array_sort(F.collect_list(log)).alias("structLogs"))
    json = docs.select(F.to_json(F.struct(F.lit("mainnet").alias("meta_network_name"), F.col("tx").cast("string").alias("transaction_hash"), "structLogs")).alias("j"))
    flat = readers.flatten_traces(json.select(F.from_json("j", schemas.TRACE).alias("x")).select("x.*"))
    return flat.select("transaction_hash", "idx", "op", "gas", F.col("gas_cost").cast("long").alias("gas_cost"), F.col("depth").cast("long").alias("depth"), "refund", "error", "mem_size", "call_to_address", "s1", "s2", "return_data")


@query("read_embedded_traces", _chain(False) + f" SELECT CAST(tx AS VARCHAR) AS transaction_hash, CAST(idx AS BIGINT) AS idx, CAST(CASE WHEN tx % 2 = 0 THEN gas_cost + 7 ELSE used END AS BIGINT) AS gas_used, wb AS words_before, CASE WHEN op IN {_CALLS} THEN call_to_address END AS target FROM g WHERE tx - tx % 3 < (SELECT max(tx) - max(tx) % 3 FROM s)")
def read_embedded_traces(spark, d):
    """The derived traces, half of them with a tracer's gas, landed as a host has them (three transactions a block) and read by ranges of
    blocks, all but the last block."""
    df = _traces(spark, d).where("tx is not null").withColumns({"meta_network_name": F.lit("mainnet"), "block_number": F.floor(F.col("tx") / 3).cast("long"), "transaction_hash": F.col("tx").cast("string"), "gas_used": F.when(F.col("tx") % 2 == 0, F.col("gas_cost") + 7)})
    folder = store.scratch(spark, "embedded")
    embedded.write_folder(df, folder)
    last = embedded.FolderProvider(folder).blocks()[1]
    end = embedded.read_embedded_traces(spark, folder, first=last - embedded.STEP + 1).agg(F.max("block_number")).first()[0]
    rows = tr.annotated(embedded.read_embedded_traces(spark, folder, last=end - 1), created=False)
    return rows.select("transaction_hash", "idx", "gas_used", "words_before", F.when(F.col("op").isin(fn.CALLS), F.col("target")).alias("target"))


@query("frame_path", _chain(False).replace("WITH s", "WITH RECURSIVE s", 1) + _PATHS + " SELECT tx, fid AS frame_id, path FROM fp")
def frame_path(spark, d):
    return fr.frame_paths(fr.frame_table(fr.with_frames(fr.normal(_traces(spark, d)), KEY), KEY), KEY).select("tx", "frame_id", _text("path").alias("path"))


@query("gas_used", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, used AS gas_used FROM g")
def gas_used(spark, d):
    return fr.with_gas(fr.with_frames(fr.normal(_traces(spark, d)), KEY), KEY).select("tx", "idx", "gas_used")


@query("gas_self", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, gself AS gas_self FROM g")
def gas_self(spark, d):
    return fr.with_gas(fr.with_frames(fr.normal(_traces(spark, d)), KEY), KEY).select("tx", "idx", "gas_self")


@query("memory_words", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, wb AS words_before, wa AS words_after FROM g")
def memory_words(spark, d):
    return rs.with_memory(fr.with_frames(fr.normal(_traces(spark, d)), KEY), KEY).select("tx", "idx", "words_before", "words_after")


@query("memory_expansion_gas", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, CAST(mem_exp AS BIGINT) AS mem_exp FROM g")
def memory_expansion_gas(spark, d):
    return rs.with_memory(fr.with_frames(fr.normal(_traces(spark, d)), KEY), KEY).select("tx", "idx", "mem_exp")


@query("create_address", _chain(False) + """, x AS (SELECT g.tx, g.idx, arg_min(h.stack_top, h.idx) AS top FROM g JOIN g h ON g.tx = h.tx AND h.idx > g.idx AND h.depth <= g.depth WHERE g.op IN ('CREATE','CREATE2') GROUP BY 1, 2)
SELECT g.tx, CAST(g.idx AS BIGINT) AS idx, CASE WHEN top IS NOT NULL THEN concat('0x', lpad(right(regexp_replace(top, '^0x', ''), 40), 40, '0')) END AS address FROM g LEFT JOIN x ON g.tx = x.tx AND g.idx = x.idx WHERE g.op IN ('CREATE','CREATE2')""")
def create_address(spark, d):
    return fr.with_created(fr.with_frames(fr.normal(_traces(spark, d)), KEY), KEY).where("op in ('CREATE', 'CREATE2')").select("tx", "idx", F.col("target").alias("address"))


@query("traced_create_address", _chain(False) + """, x AS (SELECT g.tx, g.idx, arg_min(h.stack_top, h.idx) AS top FROM g JOIN g h ON g.tx = h.tx AND h.idx > g.idx AND h.depth <= g.depth WHERE g.op IN ('CREATE','CREATE2') AND g.tx % 2 = 1 GROUP BY 1, 2)
SELECT g.tx, CAST(g.idx AS BIGINT) AS index, CASE WHEN g.tx % 2 = 0 THEN concat('0x', lpad(CAST(g.gas AS VARCHAR), 40, '0')) WHEN top IS NOT NULL THEN concat('0x', lpad(right(regexp_replace(top, '^0x', ''), 40), 40, '0')) END AS call_to_address
FROM g JOIN orders ON o_orderkey = g.tx LEFT JOIN x ON g.tx = x.tx AND g.idx = x.idx WHERE g.op IN ('CREATE','CREATE2')""")
def traced_create_address(spark, d):
    """Created addresses in the opcode table, of which a tracer gave those of every other trace."""
    address = F.when((F.col("tx") % 2 == 0) & F.col("op").isin(fn.CREATES), F.concat(F.lit("0x"), F.lpad(F.col("gas").cast("string"), 40, "0"))).otherwise(F.col("call_to_address"))
    df = tr.opcode_table(_traces(spark, d).withColumn("call_to_address", address), _headers(spark, d), KEY, use_tracer_create_address=True)
    return df.where(F.col("operation").isin(fn.CREATES)).select("tx", "index", "call_to_address")


@query("cold_access_count", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, cold FROM g")
def cold_access_count(spark, d):
    return _annotated(spark, d).select("tx", "idx", "cold")


@query("synthetic_frames_plain", _chain(False) + " SELECT tx, CAST(idx AS BIGINT) AS idx, sid AS frame_id, fid AS parent_id, CAST(depth + 1 AS BIGINT) AS depth, call_to_address AS target, error FROM g WHERE syn")
def synthetic_frames_plain(spark, d):
    df = fr.with_frames(fr.normal(_traces(spark, d)), KEY).where("synthetic")
    return df.select("tx", "idx", F.col("synthetic_id").alias("frame_id"), F.col("frame_id").alias("parent_id"), (F.col("depth") + 1).cast("long").alias("depth"), "target", "error")


@query("synthetic_frames_all", _chain(True) + " SELECT tx, CAST(idx AS BIGINT) AS idx, sid AS frame_id, fid AS parent_id, pre AS gas FROM g WHERE syn")
def synthetic_frames_all(spark, d):
    return _annotated(spark, d, True).where("synthetic").select("tx", "idx", F.col("synthetic_id").alias("frame_id"), F.col("frame_id").alias("parent_id"), F.col("precompile_gas").alias("gas"))


@query("precompile_split", _chain(True) + " SELECT tx, CAST(idx AS BIGINT) AS idx, pre AS precompile_gas, gself - pre AS own_gas FROM g")
def precompile_split(spark, d):
    return _annotated(spark, d, True).select("tx", "idx", "precompile_gas", "own_gas")


@query("call_type", _chain(True) + " SELECT tx, fid AS frame_id, CASE WHEN prev_op IN ('CALL','CALLCODE','DELEGATECALL','STATICCALL','CREATE','CREATE2') THEN prev_op ELSE 'UNKNOWN' END AS call_type, prev_addr AS target FROM g WHERE entry")
def call_type(spark, d):
    return fr.with_frames(fr.normal(_traces(spark, d)), KEY, True).where("entry").select("tx", "frame_id", tr.call_type(F.col("call_type")).alias("call_type"), F.col("tracer_target").alias("target"))


@query("opcode_table", _chain(False).replace("WITH s", "WITH RECURSIVE s", 1) + _PATHS + f""",
w AS (SELECT tx, CAST(idx AS BIGINT) AS index, op AS operation, gas, gas_cost, used AS gas_used, gself AS gas_self, CAST(depth AS BIGINT) AS depth, refund, error, fid AS call_frame_id FROM g
  UNION ALL SELECT tx, CAST(idx AS BIGINT), '', 0, 0, 0, 0, CAST(depth + 1 AS BIGINT), NULL, error, sid FROM g WHERE syn)
SELECT w.*, fp.path AS call_frame_path FROM w JOIN fp ON w.tx = fp.tx AND w.call_frame_id = fp.fid JOIN orders ON o_orderkey = w.tx""")
def opcode_table(spark, d):
    df = tr.opcode_table(_traces(spark, d), _headers(spark, d), KEY)
    return df.select("tx", "index", "operation", "gas", "gas_cost", "gas_used", "gas_self", "depth", "refund", "error", "call_frame_id", _text("call_frame_path").alias("call_frame_path"))


_SUMMED = "CAST(wb AS BIGINT) AS memory_words_sum_before, CAST(wa AS BIGINT) AS memory_words_sum_after, CAST(wb2 AS BIGINT) AS memory_words_sq_sum_before, CAST(wa2 AS BIGINT) AS memory_words_sq_sum_after, CAST(mem_exp AS BIGINT) AS memory_expansion_gas, CAST(cold AS BIGINT) AS cold_access_count"
_OPS = "oc AS (SELECT tx, fid, op, count(*) AS n, sum(err) AS e, sum(self) AS g, sum(used) AS cum, min(depth) AS d0, max(depth) AS d1, sum(wb) AS wb, sum(wa) AS wa, sum(wb * wb) AS wb2, sum(wa * wa) AS wa2, sum(mem_exp) AS mem_exp, sum(cold) AS cold FROM r WHERE op <> '' GROUP BY 1, 2, 3)"


def _rows(spark, d):
    return tr.frame_opcodes(tr.frame_rows(_annotated(spark, d, True), KEY), KEY)


@query("opcode_rows", _chain(True) + _AGG + ", " + _OPS + f" SELECT tx, fid AS frame_id, op AS operation, n AS opcode_count, CAST(e AS BIGINT) AS error_count, CAST(g AS BIGINT) AS gas, CAST(cum AS BIGINT) AS gas_cumulative, CAST(d0 AS BIGINT) AS min_depth, CAST(d1 AS BIGINT) AS max_depth, {_SUMMED} FROM oc")
def opcode_rows(spark, d):
    return tr.opcode_stats(_rows(spark, d), KEY)


@query("frame_summary", _chain(True) + _AGG + f" SELECT tx, fid AS frame_id, CAST(n AS BIGINT) AS opcode_count, CAST(e AS BIGINT) AS error_count, CAST(g0 AS BIGINT) AS first_gas, CAST(g1 AS BIGINT) AS last_gas, CAST(u1 AS BIGINT) AS last_used, CAST(mr AS BIGINT) AS max_refund, {_SUMMED} FROM fs")
def frame_summary(spark, d):
    return tr.frame_summaries(_rows(spark, d), KEY).select("tx", "frame_id", "opcode_count", "error_count", "first_gas", "last_gas", "last_used", "max_refund", *tr.SUMS)


@query("frame_gas_cumulative", _chain(True) + _AGG + " SELECT tx, fid AS frame_id, CAST(cum AS BIGINT) AS gas_cumulative FROM fc")
def frame_gas_cumulative(spark, d):
    return tr.frame_summaries(_rows(spark, d), KEY).select("tx", "frame_id", "gas_cumulative")


@query("frame_gas_self", _chain(True) + _AGG + " SELECT fc.tx, fc.fid AS frame_id, CAST(greatest(0, cum - coalesce(inner_cum, 0)) AS BIGINT) AS gas FROM fc LEFT JOIN fk ON fc.tx = fk.tx AND fc.fid = fk.fid")
def frame_gas_self(spark, d):
    return tr.with_own_gas(tr.frame_summaries(_rows(spark, d), KEY), KEY).select("tx", "frame_id", "gas")


def _agg(spark, d):
    return tr.frame_agg_table(_traces(spark, d), _headers(spark, d), KEY)


@query("intrinsic_gas", _chain(True) + _AGG + " SELECT tx, CAST(CASE WHEN raw > 0 THEN raw END AS BIGINT) AS intrinsic_gas, CAST(ref AS BIGINT) AS gas_refund, CAST(errors AS BIGINT) AS error_count FROM fi WHERE fid = 0")
def intrinsic_gas(spark, d):
    return _agg(spark, d).where("call_frame_id = 0 and operation = '' and opcode_count > 0").select("tx", "intrinsic_gas", "gas_refund", "error_count")


@query("simple_transfer_frames", "WITH s AS (" + derive.STRUCTLOG_SRC + ") SELECT o_orderkey AS tx, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('0x', lpad(CAST(o_custkey AS VARCHAR(20)), 40, '0')) END AS target_address, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS error_count, CAST(21000 + floor(o_totalprice) AS BIGINT) * 20 AS intrinsic_gas FROM orders WHERE o_orderkey NOT IN (SELECT tx FROM s)")
def simple_transfer_frames(spark, d):
    return tr.simple_transfers(_traces(spark, d), _headers(spark, d), KEY).select("tx", "target_address", "error_count", "intrinsic_gas")


@query("frame_agg_table", _chain(True).replace("WITH s", "WITH RECURSIVE s", 1) + _PATHS + _AGG + ", " + _OPS + f""",
z AS (SELECT tx, fid, '' AS operation, n, errors AS e, own AS g, cum, fdepth AS d0, fdepth AS d1, CASE WHEN fid = 0 THEN ref ELSE 0 END AS ref, CASE WHEN raw > 0 THEN raw END AS intr, wb, wa, wb2, wa2, mem_exp, cold FROM fi
  UNION ALL SELECT oc.tx, oc.fid, op, oc.n, oc.e, oc.g, oc.cum, oc.d0, oc.d1, 0, NULL, oc.wb, oc.wa, oc.wb2, oc.wa2, oc.mem_exp, oc.cold FROM oc JOIN t ON oc.tx = t.tx),
y AS (SELECT z.tx, z.fid AS call_frame_id, fi.parent AS parent_call_frame_id, fp.path AS call_frame_path, CAST(fi.fdepth AS BIGINT) AS depth, fi.tgt AS target_address, fi.ct AS call_type, operation, CAST(z.n AS BIGINT) AS opcode_count, CAST(z.e AS BIGINT) AS error_count,
  CAST(z.g AS BIGINT) AS gas, CAST(z.cum AS BIGINT) AS gas_cumulative, CAST(z.d0 AS BIGINT) AS min_depth, CAST(z.d1 AS BIGINT) AS max_depth, CAST(z.ref AS BIGINT) AS gas_refund, CAST(z.intr AS BIGINT) AS intrinsic_gas, {_SUMMED.replace('CAST(', 'CAST(z.')}
  FROM z JOIN fi ON z.tx = fi.tx AND z.fid = fi.fid JOIN fp ON z.tx = fp.tx AND z.fid = fp.fid)
SELECT * FROM y UNION ALL SELECT tx, 0, NULL, '0', 0, to_address, '', '', 0, CASE WHEN trace_failed THEN 1 ELSE 0 END, 0, 0, 0, 0, 0, trace_gas, 0, 0, 0, 0, 0, 0 FROM t WHERE tx NOT IN (SELECT tx FROM s)""")
def frame_agg_table(spark, d):
    return _agg(spark, d).drop("transaction_index").withColumn("call_frame_path", _text("call_frame_path"))


@query("resolved_targets", _chain(True) + _AGG + """,
cr AS (SELECT c.tx, e.fid, arg_min(h.stack_top, h.idx) AS top FROM g c JOIN g e ON e.tx = c.tx AND e.idx = c.idx + 1 AND e.entry JOIN g h ON h.tx = c.tx AND h.idx > c.idx AND h.depth <= c.depth WHERE c.op IN ('CREATE','CREATE2') GROUP BY 1, 2)
SELECT fr.tx, fr.fid AS call_frame_id, ct AS call_type, CASE WHEN tgt IS NOT NULL OR top IS NULL THEN tgt ELSE concat('0x', lpad(right(regexp_replace(top, '^0x', ''), 40), 40, '0')) END AS target_address FROM fr LEFT JOIN cr ON fr.tx = cr.tx AND fr.fid = cr.fid
UNION ALL SELECT tx, 0, '', to_address FROM t WHERE tx NOT IN (SELECT tx FROM s)""")
def resolved_targets(spark, d):
    """Targets of all frames of traces whose call targets are on the stack alone."""
    df = _traces(spark, d).withColumn("s2", F.regexp_replace("call_to_address", "^0x0*", "0x")).withColumn("call_to_address", F.lit(None).cast("string"))
    return tr.frame_agg_table(df, _headers(spark, d), KEY, resolve_targets=True).where("operation = ''").select("tx", "call_frame_id", "call_type", "target_address")


@query("resource_gas", _chain(True) + _AGG + ", " + _OPS + " SELECT op AS operation, CAST(sum(g) AS BIGINT) AS gas, CAST(sum(mem_exp) AS BIGINT) AS memory_gas, CAST(sum(cold * CASE op WHEN 'SLOAD' THEN 2000 WHEN 'SSTORE' THEN 2100 ELSE 2500 END) AS BIGINT) AS cold_gas, CAST(sum(g - mem_exp - cold * CASE op WHEN 'SLOAD' THEN 2000 WHEN 'SSTORE' THEN 2100 ELSE 2500 END) AS BIGINT) AS compute_gas FROM oc GROUP BY 1")
def resource_gas(spark, d):
    return tr.resource_gas(tr.opcode_stats(_rows(spark, d), KEY), ["operation"])


# ---------------------------------------------------------------- transactions


def _receipts(spark, d):
    df = derive.derived(spark, d, "receipt_src")
    return df.where("in_batch"), df.where("not in_batch")


@query("tx_receipts", f"WITH t AS ({derive.TX_SRC}), r AS ({derive.RECEIPT_SRC}) SELECT t.tx_id, r.status AS receipt_status, r.gas_used AS receipt_gas_used FROM t LEFT JOIN r ON t.hash = r.tx_hash")
def tx_receipts(spark, d):
    return tx.with_receipts(_transactions(spark, d), *_receipts(spark, d)).select("tx_id", "receipt_status", "receipt_gas_used")


def _full(df: DataFrame) -> DataFrame:
    """Derived transactions with the columns of the transaction table that they lack."""
    null = F.lit(None)
    return df.withColumns({
        "input": F.unhex("input_hex"), "block_hash": F.lit(""), "parent_hash": F.lit(""), "from_address": F.lit(""), "nonce": F.lit(0), "gas": F.lit(0).cast("long"), "value": null, "size": F.lit(0), "blob_gas": F.lit(readers.GAS_PER_BLOB).cast("long"),
        "blob_gas_fee_cap": null, "blob_hashes": null.cast("array<string>"), "meta_network_name": F.lit("mainnet"), "position": F.col("position").cast("long"),
    })


@query("transaction_table", f"""WITH t AS ({derive.TX_SRC}), r AS ({derive.RECEIPT_SRC}), z AS (SELECT *, len(list_filter(range(1, len(input_hex), 2), lambda i: substr(input_hex, i, 2) = '00')) AS zeros FROM t)
SELECT z.block_number, CAST(z.position AS BIGINT) AS position, z.hash, z.to_address, CAST(CASE WHEN z.type <= 1 OR base_fee IS NULL THEN gas_price ELSE least(base_fee + gas_tip_cap, gas_fee_cap) END AS DECIMAL(38,0)) AS gas_price,
CASE WHEN z.type >= 2 THEN CAST(gas_tip_cap AS DECIMAL(38,0)) END AS gas_tip_cap, CASE WHEN z.type >= 2 THEN CAST(gas_fee_cap AS DECIMAL(38,0)) END AS gas_fee_cap, z.type, CAST(len(input_hex) // 2 AS BIGINT) AS call_data_size, CASE WHEN z.type = 3 THEN 131072 END AS blob_gas,
r.status = 1 AS success, CAST(zeros AS BIGINT) AS n_input_zero_bytes, CAST(len(input_hex) // 2 - zeros AS BIGINT) AS n_input_nonzero_bytes FROM z JOIN r ON z.hash = r.tx_hash""".replace("131072 END", "CAST(131072 AS BIGINT) END"))
def transaction_table(spark, d):
    df = _full(_transactions(spark, d))
    out = tx.transaction_table(df, *_receipts(spark, d))
    return out.select("block_number", "position", "hash", "to_address", "gas_price", "gas_tip_cap", "gas_fee_cap", "type", "call_data_size", "blob_gas", "success", "n_input_zero_bytes", "n_input_nonzero_bytes")


_BLOCK_COLUMNS = "block_number, position, hash, type, nonce, base_fee, gas_price, gas_tip_cap, value, from_address, to_address, n_input"


@query("read_blocks", f"""WITH t AS ({derive.TX_SRC}), z AS (SELECT t.*, o.o_custkey AS c FROM t JOIN orders o ON o.o_orderkey = t.tx_id)
SELECT block_number, CAST(position AS BIGINT) AS position, hash, CAST(type AS INTEGER) AS type, CAST(c AS BIGINT) AS nonce, CAST(block_number * 1000 + 7 AS DECIMAL(38,0)) AS base_fee, CASE WHEN type <= 1 THEN CAST(gas_price AS DECIMAL(38,0)) END AS gas_price,
CASE WHEN type > 1 THEN CAST(CAST(c AS DECIMAL(38,0)) * 18446744073709551616 + 5 AS DECIMAL(38,0)) END AS gas_tip_cap, CASE tx_id % 3 WHEN 0 THEN 0 WHEN 1 THEN CAST(tx_id AS DECIMAL(38,0)) ELSE 255 END AS value,
concat('0xab', CAST(c AS VARCHAR)) AS from_address, lower(to_address) AS to_address, CAST(len(input_hex) // 2 AS BIGINT) AS n_input FROM z""")
def read_blocks(spark, d):
    """Blocks as nodes send them, made of the derived transactions: hex quantities, some absent, empty or malformed."""
    hexed = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("tx_id"), F.col("o_custkey").cast("long").alias("c"))
    t = _transactions(spark, d).join(orders, "tx_id")
    wide = F.concat(hexed(F.col("c")), F.lit("0000000000000005"))  # c * 2^64 + 5
    value = F.when(F.col("tx_id") % 3 == 0, "0xnone").when(F.col("tx_id") % 3 == 1, hexed(F.col("tx_id").cast("long"))).otherwise("0x00ff")
    tx_ = F.struct(
        "position", F.upper("hash").alias("hash"), hexed(F.col("type").cast("long")).alias("type"), hexed(F.col("c")).alias("nonce"), F.when(F.col("type") <= 1, hexed(F.col("gas_price").cast("long"))).alias("gasPrice"), F.when(F.col("type") > 1, wide).alias("maxPriorityFeePerGas"),
        value.alias("value"), F.concat(F.lit("0x"), "input_hex").alias("input"), F.concat(F.lit("0xAB"), F.col("c").cast("string")).alias("from"), F.upper("to_address").alias("to"),
    )
    blocks = t.groupBy("block_number").agg(F.array_sort(F.collect_list(tx_)).alias("transactions"))
    doc = F.struct(F.lit("mainnet").alias("meta_network_name"), hexed(F.col("block_number").cast("long")).alias("number"), hexed((F.col("block_number") * 1000 + 7).cast("long")).alias("baseFeePerGas"), "transactions")
    rows = readers.flatten_blocks(blocks.select(F.from_json(F.to_json(doc), schemas.BLOCK).alias("x")).select("x.*"))
    # upper-case 0X is no prefix that nodes send
    low = lambda c: F.regexp_replace(c, "^0X", "0x")
    return rows.withColumns({"n_input": F.octet_length("input").cast("long"), "hash": low("hash"), "to_address": low("to_address")}).select(*_BLOCK_COLUMNS.split(", "))


@query("read_receipts", "SELECT concat('0x', lpad(CAST(o_orderkey AS VARCHAR(20)), 64, '0')) AS tx_hash, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS status, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE CAST(21000 + floor(o_totalprice) AS BIGINT) END AS gas_used FROM orders")
def read_receipts(spark, d):
    """Receipts as nodes send them: quantities that are absent, malformed, or beyond 63 bits."""
    k, gas = F.col("o_orderkey"), F.concat(F.lit("0x"), F.lower(F.hex((F.lit(21000) + F.floor("o_totalprice")).cast("long"))))
    used = F.when(k % 5 == 1, "0xzz").when(k % 5 == 2, "0xffffffffffffffff").when(k % 5 > 2, gas)
    doc = F.struct(F.concat(F.lit("0x"), F.lpad(k.cast("string"), 64, "0")).alias("transactionHash"), F.when(F.col("o_orderstatus") == "F", "0x0").otherwise("0x1").alias("status"), used.alias("gasUsed"))
    docs = spark.read.parquet(f"{d}/orders.parquet").select(F.from_json(F.to_json(doc), schemas.RECEIPT).alias("x")).select("x.*")
    return readers.flatten_receipts(docs).drop("meta_network_name")


@query("locate", f"""WITH t AS ({derive.TX_SRC}), q AS (SELECT CASE WHEN tx_id % 11 = 0 THEN -1 ELSE block_number END AS block_number, CAST(CASE WHEN tx_id % 7 = 0 THEN position + 1000 ELSE position END AS BIGINT) AS transaction_index, CASE WHEN tx_id % 5 = 0 THEN concat(hash, 'x') ELSE hash END AS transaction_hash FROM t)
SELECT q.*, CASE WHEN q.block_number = -1 THEN 'no such block' WHEN t.hash IS NULL THEN 'transaction index out of range' WHEN t.hash <> q.transaction_hash THEN 'transaction hash mismatch: found ' || t.hash END AS error FROM q LEFT JOIN t ON t.block_number = q.block_number AND t.position = q.transaction_index""")
def locate(spark, d):
    t = _transactions(spark, d).withColumn("meta_network_name", F.lit("mainnet"))
    asked = t.select(
        "meta_network_name", F.when(F.col("tx_id") % 11 == 0, -1).otherwise(F.col("block_number")).cast("long").alias("block_number"), (F.col("position") + F.when(F.col("tx_id") % 7 == 0, 1000).otherwise(0)).cast("long").alias("transaction_index"),
        F.when(F.col("tx_id") % 5 == 0, F.concat("hash", F.lit("x"))).otherwise(F.col("hash")).alias("transaction_hash"),
    )
    return tx.locate(asked, t).drop("meta_network_name")


_AMOUNTS = """WITH w AS (SELECT o_orderkey AS k, CAST(o_custkey % 4 AS INT) AS kind, CASE o_orderkey % 6 WHEN 0 THEN '340282366920938463463374607431768211455' WHEN 1 THEN concat(CAST(o_custkey % 3 AS VARCHAR(20)), lpad(CAST(o_orderkey AS VARCHAR(20)), 38, '9')) WHEN 2 THEN '0' WHEN 3 THEN lpad(CAST(o_custkey AS VARCHAR(20)), 38, '1') ELSE CAST(o_custkey AS VARCHAR(20)) END AS fee_cap,
  CASE o_orderkey % 4 WHEN 0 THEN '9999999999999999999' WHEN 1 THEN lpad(CAST(o_custkey AS VARCHAR(20)), 38, '8') ELSE CAST(o_orderkey AS VARCHAR(20)) END AS tip_cap, CASE WHEN o_orderkey % 13 <> 0 THEN concat(CAST(1 + o_custkey % 9 AS VARCHAR(20)), '0000000000000000001') END AS base_fee FROM orders)"""


@query("exact_amounts", _AMOUNTS + """, n AS (SELECT *, CAST(fee_cap AS UHUGEINT) AS f, CAST(tip_cap AS UHUGEINT) AS t, CAST(base_fee AS UHUGEINT) AS b FROM w)
SELECT k, CAST(f AS VARCHAR) AS fee_cap, CAST(t + b AS VARCHAR) AS offered, CAST(CASE WHEN kind <= 1 OR b IS NULL THEN f ELSE least(t + b, f) END AS VARCHAR) AS price, f > t AS above FROM n""")
def exact_amounts(spark, d):
    """Amounts of up to 39 digits, among them 2^128 - 1, and sums that carry from limb to limb."""
    w = spark.sql(_AMOUNTS.replace("FROM orders", f"FROM parquet.`{d}/orders.parquet`") + " SELECT * FROM w")
    f, t, b = (fn.u128.from_decimal(F.col(c)) for c in ("fee_cap", "tip_cap", "base_fee"))
    price = fn.u128.effective_gas_price(F.col("kind"), f, b, t, f)
    return w.select("k", fn.u128.to_string(f).alias("fee_cap"), fn.u128.to_string(fn.u128.add(t, b)).alias("offered"), fn.u128.to_string(price).alias("price"), (f > t).alias("above"))


def _stored(rows: DataFrame, block) -> DataFrame:
    """Rows of ``tx`` with the columns of a stored table."""
    return rows.withColumns({"meta_network_name": F.lit("mainnet"), "block_number": block, "transaction_hash": F.col("tx").cast("string")})


def _through_versions(spark, rows: DataFrame) -> DataFrame:
    """Rows as a versioned table gives them back that was written in parts, with rows that were wrong at first, and compacted in between."""
    rows = store.settle(_stored(rows, F.floor(F.col("tx") / 8).cast("long")), "stored-rows")
    path = store.scratch(spark, "versions")
    part = lambda k: rows.where(F.col("tx") % 3 == k)
    keys = lambda df: df.select(*versions.TRANSACTION).distinct()
    versions.write(part(0), path, keys(part(0)))
    versions.write(part(1).unionByName(part(1).where("tx % 5 = 0")), path, keys(part(1)))
    versions.compact(spark, path)
    versions.write(part(2), path, keys(part(2)))
    versions.write(part(1), path, keys(part(1)))
    return versions.read(spark, path).drop("meta_network_name", "block_number", "transaction_hash")


@query("write_structlog", _SQL["opcode_table"])
def write_structlog(spark, d):
    return _through_versions(spark, opcode_table(spark, d))


@query("write_structlog_agg", _SQL["frame_agg_table"])
def write_structlog_agg(spark, d):
    return _through_versions(spark, frame_agg_table(spark, d))


@query("write_transactions", _SQL["transaction_table"])
def write_transactions(spark, d):
    """The transaction table written block by block; some blocks twice."""
    rows = store.settle(transaction_table(spark, d).withColumn("meta_network_name", F.lit("mainnet")), "stored-rows")
    path, block = store.scratch(spark, "versions"), ["meta_network_name", "block_number"]
    for part in (rows.where("block_number % 4 < 3").withColumn("success", ~F.col("success")), rows.where("block_number % 4 >= 1"), rows.where("block_number % 4 = 0")):
        versions.write(part, path, part.select(*block).distinct())
    return versions.read(spark, path).drop("meta_network_name")


_TWO = f"""WITH t AS ({derive.TX_SRC}), r AS ({derive.RECEIPT_SRC}), n AS (SELECT * FROM (VALUES ('mainnet'), ('sepolia')) AS v(meta_network_name)),
x AS (SELECT * FROM t CROSS JOIN n), y AS (SELECT tx_hash, meta_network_name, CASE WHEN meta_network_name = 'mainnet' THEN status ELSE 1 - status END AS status FROM r CROSS JOIN n WHERE NOT (meta_network_name = 'sepolia' AND tx_hash LIKE '%37'))"""


@query("transactions_by_network", _TWO + """, z AS (SELECT x.meta_network_name, x.block_number, CAST(x.position AS BIGINT) AS position, x.hash, y.status FROM x LEFT JOIN y ON x.hash = y.tx_hash AND x.meta_network_name = y.meta_network_name)
SELECT meta_network_name, block_number, position, hash, status = 1 AS success FROM z ANTI JOIN (SELECT DISTINCT meta_network_name, block_number FROM z WHERE status IS NULL) USING (meta_network_name, block_number)""")
def transactions_by_network(spark, d):
    """All transactions on two networks with receipts of their own, repeated ones too; some of one network's receipts are nowhere."""
    network = F.explode(F.array(F.lit("mainnet"), F.lit("sepolia")))
    receipts = derive.derived(spark, d, "receipt_src").withColumn("meta_network_name", network).withColumn("status", F.when(F.col("meta_network_name") == "mainnet", F.col("status")).otherwise(1 - F.col("status")))
    receipts = receipts.where("not (meta_network_name = 'sepolia' and tx_hash like '%37')")
    batch = receipts.where("in_batch")
    out = tx.transaction_table(_full(_transactions(spark, d)).withColumn("meta_network_name", network), batch.unionByName(batch.where("tx_hash like '%5'")), receipts.where("not in_batch"))
    return out.select("meta_network_name", "block_number", "position", "hash", "success")


# ---------------------------------------------------------------- progress

_P = f"WITH p AS ({derive.PROGRESS_SRC}), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY processor, meta_network_name, block_number ORDER BY updated_date_time DESC, version_tiebreak DESC) AS rn FROM p) WHERE rn = 1)"
_S = "processor, meta_network_name"
_R = ", m AS (SELECT processor, meta_network_name, min(block_number) AS lo, max(block_number) AS hi FROM p GROUP BY 1, 2)"
HEAD = 1_000_000


@query("latest_version", _P + f" SELECT {_S}, block_number, updated_date_time, CAST(complete AS INTEGER) AS complete, CAST(task_count AS BIGINT) AS task_count FROM l")
def latest_version(spark, d):
    return _latest(spark, d).select(*pg.KEY, "updated_date_time", "complete", F.col("task_count").cast("long").alias("task_count"))


@query("stored_range", _P + f" SELECT {_S}, min(block_number) AS min_block, max(block_number) AS max_block FROM p GROUP BY 1, 2")
def stored_range(spark, d):
    return pg.stored_range(_progress(spark, d))


@query("count_incomplete", _P + f" SELECT {_S}, CAST(sum(CASE WHEN complete = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_incomplete FROM l GROUP BY 1, 2")
def count_incomplete(spark, d):
    return pg.count_incomplete(_latest(spark, d))


@query("oldest_incomplete", _P + f" SELECT {_S}, min(block_number) AS block_number FROM l WHERE complete = 0 AND block_number >= 1050 GROUP BY 1, 2")
def oldest_incomplete(spark, d):
    return pg.oldest_incomplete(_latest(spark, d), 1050)


#: Blocks of a scope's end that may still be under way.
PENDING = 5


@query("newest_incomplete", _P + _R + f" SELECT {_S}, max(block_number) AS block_number FROM l JOIN m USING (processor, meta_network_name) WHERE complete = 0 AND block_number < hi - {PENDING} GROUP BY 1, 2")
def newest_incomplete(spark, d):
    latest = _latest(spark, d)
    return pg.newest_incomplete(latest, ranges=pg.gap_window(latest, pending=PENDING))


@query("newest_incomplete_all", _P + f" SELECT {_S}, max(block_number) AS block_number FROM l WHERE complete = 0 GROUP BY 1, 2")
def newest_incomplete_all(spark, d):
    return pg.newest_incomplete(_latest(spark, d))


_TOP = "SELECT processor, meta_network_name, block_number FROM (SELECT *, row_number() OVER (PARTITION BY processor, meta_network_name ORDER BY block_number) AS k FROM l{} WHERE complete = 0{}) WHERE k <= 10"
_MIDDLE = " AND block_number BETWEEN lo + (hi - lo) // 10 AND hi - (hi - lo) // 10"


def _middle(latest):
    """Each scope's stored range without a tenth at either end."""
    tenth = F.floor((F.col("max_block") - F.col("min_block")) / 10)
    return pg.stored_range(latest).withColumns({"min_block": F.col("min_block") + tenth, "max_block": F.col("max_block") - tenth})


@query("incomplete_blocks", _P + " " + _TOP.format("", ""))
def incomplete_blocks(spark, d):
    return pg.incomplete_blocks(_latest(spark, d), 10)


@query("incomplete_in_range", _P + _R + " " + _TOP.format(" JOIN m USING (processor, meta_network_name)", _MIDDLE))
def incomplete_in_range(spark, d):
    latest = _latest(spark, d)
    return pg.incomplete_blocks(latest, 10, ranges=_middle(latest))


@query("incomplete_in_range_all", _P + _R + " SELECT l.processor, l.meta_network_name, l.block_number FROM l JOIN m USING (processor, meta_network_name) WHERE complete = 0" + _MIDDLE)
def incomplete_in_range_all(spark, d):
    latest = _latest(spark, d)
    return pg.incomplete_within(latest, _middle(latest))


@query("missing_blocks", _P + _R + f", q AS (SELECT {_S}, unnest(generate_series(lo, hi)) AS block_number FROM m) SELECT q.* FROM q ANTI JOIN p USING (processor, meta_network_name, block_number)")
def missing_blocks(spark, d):
    return pg.missing_blocks(_progress(spark, d))


@query("next_block_forward", _P + _R + f" SELECT {_S}, hi + 1 AS next_block FROM m")
def next_block_forward(spark, d):
    return pg.next_block(_scopes(spark, d), _progress(spark, d), chain_head=HEAD)


@query("next_block_backward", _P + _R + f" SELECT {_S}, CASE WHEN lo > 0 THEN lo - 1 END AS next_block FROM m")
def next_block_backward(spark, d):
    return pg.next_block(_scopes(spark, d), _progress(spark, d), "backwards", HEAD)


_L = ", b AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'mainnet' ELSE 'sepolia' END AS meta_network_name, arg_max(1000 + (event_id - event_id % 8) // 8 - CASE WHEN user_id % 2 = 0 THEN 3 ELSE 0 END, event_id) AS limiter_max FROM events WHERE event_type <> 'purchase' GROUP BY 1)"


def _limits(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    even = F.col("user_id") % 2 == 0
    block = F.lit(1000) + F.floor(F.col("event_id") / 8) - F.when(even, 3).otherwise(0)
    beacon = events.select(F.when(even, "mainnet").otherwise("sepolia").alias("meta_network_name"), F.when(F.col("event_type") != "purchase", block).cast("long").alias("execution_payload_block_number"), F.col("event_id").alias("slot_start_date_time"))
    return pg.limiter_max(beacon)


_N = ", nb AS (SELECT processor, m.meta_network_name, b.limiter_max, CASE WHEN hi + 1 <> b.limiter_max + 1 THEN hi + 1 END AS next_block FROM m JOIN b ON m.meta_network_name = b.meta_network_name)"


@query("next_block_limited", _P + _R + _L + _N + f" SELECT {_S}, CAST(next_block AS BIGINT) AS next_block FROM nb")
def next_block_limited(spark, d):
    return pg.next_block(_scopes(spark, d), _progress(spark, d), chain_head=HEAD, limits=_limits(spark, d))


@query("next_blocks", _P + _R + f", q AS (SELECT {_S}, unnest(generate_series(lo - 1, lo - 5, -1)) AS block_number FROM m) SELECT * FROM q WHERE block_number >= 0")
def next_blocks(spark, d):
    return pg.next_blocks(_scopes(spark, d), _progress(spark, d), 5, "backwards", HEAD)


@query("head_distance", _P + _R + _L + _N + f" SELECT {_S}, CAST(CASE WHEN next_block IS NULL THEN 0 ELSE limiter_max - next_block END AS BIGINT) AS distance, CASE WHEN next_block IS NULL THEN '' ELSE 'beacon_chain_head' END AS head_type FROM nb")
def head_distance(spark, d):
    return pg.head_distance(_scopes(spark, d), _progress(spark, d), chain_head=HEAD, limits=_limits(spark, d))


_AS_OF = "(SELECT max(updated_date_time) FROM p)"


def _as_of(spark, d):
    return _progress(spark, d).agg(F.max("updated_date_time")).first()[0]


@query("recently_processed", _P + f" SELECT DISTINCT {_S}, block_number FROM p WHERE updated_date_time >= {_AS_OF} - INTERVAL 86400 SECOND")
def recently_processed(spark, d):
    return pg.recently_processed(_progress(spark, d), _as_of(spark, d), 86400)


@query("stale_blocks", _P + f" SELECT {_S}, block_number, updated_date_time FROM l WHERE complete = 0 AND updated_date_time <= {_AS_OF} - INTERVAL 86400 SECOND")
def stale_blocks(spark, d):
    return pg.stale_blocks(_latest(spark, d), _as_of(spark, d), 86400)


@query("is_complete", _P + f", q AS (SELECT DISTINCT {_S}, block_number + 3 AS block_number FROM p) SELECT q.*, coalesce(l.complete = 1, false) AS is_complete FROM q LEFT JOIN l USING (processor, meta_network_name, block_number)")
def is_complete(spark, d):
    asked = _progress(spark, d).select(*pg.SCOPE, (F.col("block_number") + 3).alias("block_number")).distinct()
    return pg.is_complete(_latest(spark, d), asked)


#: As many blocks as a scan for gaps looks back at unless told otherwise, and the gaps that one scan hands out to each scope.
LOOKBACK, PAGE = 10_000, 40


@query("gaps", _P + _R + f""", w AS (SELECT processor, meta_network_name, greatest(hi - {LOOKBACK}, lo) AS a, hi - {PENDING + 1} AS b FROM m WHERE hi > {PENDING}), x AS (
SELECT l.processor, l.meta_network_name, l.block_number, 'incomplete' AS gap_type FROM l JOIN w USING (processor, meta_network_name) WHERE complete = 0 AND block_number BETWEEN a AND b
UNION ALL SELECT q.*, 'missing' FROM (SELECT processor, meta_network_name, unnest(generate_series(a, b)) AS block_number FROM w) q ANTI JOIN p USING (processor, meta_network_name, block_number))
SELECT processor, meta_network_name, block_number, gap_type FROM (SELECT *, row_number() OVER (PARTITION BY processor, meta_network_name ORDER BY gap_type, block_number) AS k FROM x) WHERE k <= {PAGE}""")
def gaps(spark, d):
    return pg.gaps(_latest(spark, d), PAGE, lookback=LOOKBACK, pending=PENDING)


@query("gaps_all", _P + _R + """, w AS (SELECT processor, meta_network_name, lo AS a, hi - 6 AS b FROM m WHERE hi > 5)
SELECT l.processor, l.meta_network_name, l.block_number, 'incomplete' AS gap_type FROM l JOIN w USING (processor, meta_network_name) WHERE complete = 0 AND block_number BETWEEN a AND b
UNION ALL SELECT q.*, 'missing' FROM (SELECT processor, meta_network_name, unnest(generate_series(a, b)) AS block_number FROM w) q ANTI JOIN p USING (processor, meta_network_name, block_number)""")
def gaps_all(spark, d):
    return pg.gaps(_latest(spark, d), pending=5)


@query("capacity", _P + _R + f""", o AS (SELECT m.processor, m.meta_network_name, m.hi + 1 AS next_block, min(CASE WHEN l.block_number >= greatest(m.hi + 1 - 60, 0) THEN l.block_number END) AS nearest FROM m LEFT JOIN (SELECT * FROM l WHERE complete = 0) l USING (processor, meta_network_name) GROUP BY 1, 2, 3)
SELECT {_S}, next_block, nearest, CAST(CASE WHEN nearest IS NULL THEN 60 WHEN nearest > next_block THEN 0 ELSE greatest(60 - (next_block - nearest), 0) END AS INTEGER) AS capacity, nearest IS NOT NULL AND (nearest > next_block OR next_block - nearest >= 60) AS blocked FROM o""")
def capacity(spark, d):
    return pg.capacity(pg.next_block(_scopes(spark, d), _progress(spark, d)), _latest(spark, d), 60)


@query("block_completion", _P + f", e AS (SELECT {_S}, block_number, max(version_tiebreak % 3) AS task_count FROM p WHERE block_number % 4 <> 0 GROUP BY 1, 2, 3), c AS (SELECT {_S}, block_number, count(DISTINCT version_tiebreak % 5) AS completed FROM p GROUP BY 1, 2, 3) SELECT c.processor, c.meta_network_name, c.block_number, completed, e.task_count, coalesce(completed >= e.task_count, false) AS is_complete FROM c LEFT JOIN e USING (processor, meta_network_name, block_number)")
def block_completion(spark, d):
    p = _progress(spark, d)
    tasks = p.select(*pg.KEY, (F.col("version_tiebreak") % 5).cast("string").alias("task_id"))
    expected = p.where("block_number % 4 <> 0").groupBy(*pg.KEY).agg(F.max(F.col("version_tiebreak") % 3).alias("task_count"))
    return pg.block_completion(tasks, expected)


@query("reprocess_candidates", _P + f" SELECT {_S}, block_number FROM l WHERE complete = 0 AND block_number % 3 <> 0")
def reprocess_candidates(spark, d):
    latest = _latest(spark, d)
    return pg.reprocess_candidates(pg.incomplete(latest), latest.where("block_number % 3 = 0"), latest)


#: Blocks count as found if two scopes have completed them; those of the first tenth do anyway, so that the prefix ends inside the range.
@query("contiguous_prefix", _P + """, b AS (SELECT min(block_number) AS lo, max(block_number) AS hi FROM p), q AS (SELECT unnest(generate_series(lo, hi)) AS block_number FROM b),
f AS (SELECT block_number FROM p WHERE complete = 1 GROUP BY 1 HAVING count(DISTINCT (processor, meta_network_name)) > 1 UNION SELECT block_number FROM q, b WHERE block_number < lo + (hi - lo) // 10)
SELECT block_number FROM q WHERE block_number < coalesce((SELECT min(q.block_number) FROM q ANTI JOIN f USING (block_number)), (SELECT hi + 1 FROM b))""")
def contiguous_prefix(spark, d):
    progress = _progress(spark, d)
    one = [F.lit("").alias(c) for c in pg.SCOPE]  # all scopes together
    span = progress.agg(F.min("block_number").alias("min_block"), F.max("block_number").alias("max_block")).select(*one, "*")
    tenth = span.withColumn("max_block", F.col("min_block") + F.floor((F.col("max_block") - F.col("min_block")) / 10) - 1)
    done = progress.where("complete = 1").groupBy("block_number").agg(F.count_distinct(*pg.SCOPE).alias("n"))
    found = done.where("n > 1").select("block_number").union(pg.every_block(tenth).select("block_number"))
    return pg.contiguous_prefix(pg.every_block(span).select("block_number"), found)


#: A scope's block counts as found if any scope has completed it, since few blocks have a row in every scope.
@query("contiguous_prefix_all", _P + _R + f", q AS (SELECT {_S}, unnest(generate_series(lo, hi)) AS block_number FROM m), f AS (SELECT DISTINCT block_number FROM p WHERE complete = 1), u AS (SELECT {_S}, min(block_number) AS gap FROM q ANTI JOIN f USING (block_number) GROUP BY 1, 2) SELECT q.* FROM q LEFT JOIN u USING (processor, meta_network_name) WHERE gap IS NULL OR block_number < gap")
def contiguous_prefix_all(spark, d):
    progress = _progress(spark, d)
    ranges = pg.stored_range(progress)
    found = progress.where("complete = 1").select("block_number").distinct().join(F.broadcast(ranges.select(*pg.SCOPE)))  # a row a scope
    return pg.contiguous_prefix(pg.every_block(ranges), found, by_scope=True)


_RANGES = ", s AS (SELECT DISTINCT processor, meta_network_name, block_number AS b FROM p), y AS (SELECT *, lag(b) OVER (PARTITION BY processor, meta_network_name ORDER BY b) AS a FROM s), v AS (SELECT processor, meta_network_name, a + 1 AS first_block, b - 1 AS last_block FROM y WHERE b - a > 1)"


@query("missing_ranges", _P + _RANGES + " SELECT * FROM v")
def missing_ranges(spark, d):
    return pg.missing_ranges(_progress(spark, d))


@query("first_missing", _P + _RANGES + f", e AS (SELECT {_S}, unnest(generate_series(first_block, last_block)) AS block_number FROM v) SELECT {_S}, block_number FROM (SELECT *, row_number() OVER (PARTITION BY {_S} ORDER BY block_number) AS k FROM e) WHERE k <= 25")
def first_missing(spark, d):
    """The page of 25 missing blocks of each scope that a service asks for next."""
    return pg.first_of(pg.missing_ranges(_progress(spark, d)), 25)


@query("bitmap_completion", _SQL["block_completion"])
def bitmap_completion(spark, d):
    """``block_completion`` from the bitmaps of three batches, which have tasks in common."""
    p = _progress(spark, d)
    tasks = p.select(*pg.KEY, (F.col("version_tiebreak") % 5).alias("task_index"), "version_tiebreak")
    batches = [pg.task_bitmaps(tasks.where(F.col("version_tiebreak") % 4 >= k)) for k in range(3)]
    expected = p.where("block_number % 4 <> 0").groupBy(*pg.KEY).agg(F.max(F.col("version_tiebreak") % 3).alias("task_count"))
    return pg.bitmap_completion(pg.merge_bitmaps(*batches), expected)


@query("append_progress", _P + f" SELECT {_S}, block_number, CAST(complete AS INTEGER) AS complete, CAST(CASE WHEN complete = 1 THEN 0 ELSE task_count END AS BIGINT) AS task_count FROM l WHERE complete IS NOT NULL")
def append_progress(spark, d):
    """Every block's last state, written as versions (begun, then maybe complete) and read back."""
    last = store.settle(_latest(spark, d), "latest")
    path = store.scratch(spark, "progress")
    for processor in ("structlog", "structlog_agg", "transaction"):
        own = last.where(F.col("processor") == processor)
        sinks.append_progress(sinks.progress_rows(own, processor, 0), path)
        sinks.append_progress(sinks.progress_rows(own.where("complete = 1"), processor, 1), path)
    return pg.latest_version(spark.read.schema(schemas.PROGRESS).parquet(path)).select(*pg.KEY, "complete", "task_count")


@query("requeue", _P + f", q AS (SELECT {_S}, block_number, row_number() OVER (PARTITION BY {_S} ORDER BY block_number) AS k FROM l WHERE complete = 0) SELECT meta_network_name, processor, CASE WHEN k % 4 = 0 THEN -block_number ELSE block_number END AS block_number, CASE WHEN k % 4 = 0 THEN 'failed' ELSE 'queued' END AS status, CASE WHEN k % 4 = 0 THEN 0 ELSE k END AS task_count, CASE WHEN k % 4 = 0 THEN 'no such block' END AS error FROM q WHERE k <= 100 AND processor = 'structlog'")
def requeue(spark, d):
    """One processor's first hundred incomplete blocks of each network processed again; some of them are unknown."""
    open_ones = pg.incomplete(_latest(spark, d)).where("processor = 'structlog'")
    first = open_ones.withColumn("task_count", F.row_number().over(Window.partitionBy(*pg.SCOPE).orderBy("block_number")).cast("long")).where("task_count <= 100")
    first = store.settle(first.select("meta_network_name", F.when(F.col("task_count") % 4 == 0, -F.col("block_number")).otherwise(F.col("block_number")).alias("block_number"), "task_count"), "requeue")
    recompute = lambda blocks: blocks.select("meta_network_name", "block_number", F.lit(1).alias("v"))
    return sinks.requeue_blocks(first, first.where("block_number >= 0"), recompute, "structlog", store.scratch(spark, "versions"), store.scratch(spark, "progress"), versions.write)


@query("pipeline_health", _P + f" SELECT {_S}, min(block_number) AS min_block, max(block_number) AS max_block, count(*) AS n_blocks, CAST(sum(CASE WHEN complete = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_complete, CAST(sum(CASE WHEN complete = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_incomplete, max(block_number) - min(block_number) + 1 - count(*) AS n_missing, {HEAD} - max(block_number) - 1 AS head_distance FROM l GROUP BY 1, 2")
def pipeline_health(spark, d):
    return pg.pipeline_health(_latest(spark, d), HEAD)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
