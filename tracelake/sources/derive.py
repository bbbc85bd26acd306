"""Trace, transaction, receipt and progress tables derived from the star-schema tables, for queries that run on those.

The statements are the same SQL in both engines; every compared column has an explicit type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.plans import store

STRUCTLOG_SRC = """
WITH base AS (
  SELECT CAST((l_orderkey - l_orderkey % 16) / 16 AS BIGINT) AS tx, l_orderkey AS ok, l_linenumber AS ln,
         l_partkey AS pk, l_suppkey AS sk, CAST(floor(l_quantity) AS BIGINT) AS q FROM lineitem),
seqd AS (SELECT base.*, row_number() OVER (PARTITION BY tx ORDER BY ok, ln, pk, sk, q) - 1 AS idx FROM base),
dep AS (SELECT seqd.*, CASE idx % 16 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 3 WHEN 6 THEN 2 WHEN 7 THEN 2
     WHEN 10 THEN 2 WHEN 11 THEN 3 WHEN 12 THEN 4 WHEN 13 THEN 4 ELSE 1 END AS depth FROM seqd),
nxt AS (SELECT dep.*, lead(depth) OVER (PARTITION BY tx ORDER BY idx) AS nd FROM dep),
ops AS (SELECT nxt.*, CASE WHEN nd > depth THEN CASE pk % 6 WHEN 0 THEN 'CALL' WHEN 1 THEN 'STATICCALL' WHEN 2 THEN 'DELEGATECALL'
       WHEN 3 THEN 'CALLCODE' WHEN 4 THEN 'CREATE' ELSE 'CREATE2' END
     WHEN nd < depth THEN CASE pk % 3 WHEN 0 THEN 'RETURN' WHEN 1 THEN 'REVERT' ELSE 'STOP' END
     ELSE CASE pk % 10 WHEN 0 THEN 'CALL' WHEN 1 THEN 'SLOAD' WHEN 2 THEN 'SSTORE' WHEN 3 THEN 'MSTORE' WHEN 4 THEN 'BALANCE'
       WHEN 5 THEN 'EXTCODECOPY' WHEN 6 THEN 'STATICCALL' WHEN 7 THEN 'SELFDESTRUCT' WHEN 8 THEN 'ADD' ELSE 'PUSH1' END END AS op FROM nxt),
cst AS (SELECT ops.*, CASE op WHEN 'SLOAD' THEN CASE WHEN sk % 2 = 0 THEN 100 ELSE 2100 END
     WHEN 'SSTORE' THEN CASE sk % 4 WHEN 0 THEN 2200 WHEN 1 THEN 5000 WHEN 2 THEN 22100 ELSE 20000 END
     WHEN 'SELFDESTRUCT' THEN CASE WHEN sk % 2 = 0 THEN 5000 ELSE 7600 END
     WHEN 'ADD' THEN 3 WHEN 'PUSH1' THEN 3 WHEN 'STOP' THEN 0 WHEN 'RETURN' THEN 0 WHEN 'REVERT' THEN 0 WHEN 'MSTORE' THEN 3 + q
     ELSE CASE sk % 3 WHEN 0 THEN 100 WHEN 1 THEN 2600 ELSE 12000 END END AS gas_cost FROM ops)
SELECT tx, idx, op, CAST(100000000 - coalesce(sum(gas_cost) OVER (PARTITION BY tx ORDER BY idx
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS gas,
  CAST(gas_cost AS BIGINT) AS gas_cost, depth,
  CASE WHEN pk % 97 = 0 THEN 'out of gas' WHEN pk % 89 = 0 THEN '' END AS error,
  CASE WHEN op = 'SSTORE' THEN CAST(4800 * (1 + sk % 3) AS BIGINT) END AS refund,
  CAST(32 * (idx + depth) + q % 32 AS BIGINT) AS mem_size,
  CASE WHEN op IN ('CALL','STATICCALL','DELEGATECALL','CALLCODE') AND pk % 11 <> 0 THEN concat('0x', lpad(CASE WHEN sk % 4 = 0
     THEN CAST(1 + pk % 9 AS VARCHAR(20)) ELSE CAST(1000 + sk AS VARCHAR(20)) END, 40, '0')) END AS call_to_address,
  (op IN ('CALL','CALLCODE') AND sk % 7 = 0) AS call_transfers_value,
  CASE WHEN op = 'EXTCODECOPY' THEN pk % 500 ELSE 0 END AS ext_code_copy_size,
  concat('0x', CAST(pk AS VARCHAR(20))) AS stack_top
FROM cst
"""

TX_SRC = """
SELECT o_orderkey AS tx_id, CAST((o_orderkey - o_orderkey % 64) / 64 AS BIGINT) AS block_number,
  row_number() OVER (PARTITION BY CAST((o_orderkey - o_orderkey % 64) / 64 AS BIGINT) ORDER BY o_orderkey) - 1 AS position,
  concat('0x', lpad(CAST(o_orderkey AS VARCHAR(20)), 64, '0')) AS hash,
  CAST(o_custkey % 5 AS INT) AS type,
  CAST(floor(o_totalprice) AS BIGINT) * 1000 AS gas_price,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST((o_orderkey - o_orderkey % 64) / 64 AS BIGINT) * 1000 + 7 END AS base_fee,
  o_custkey * 10 AS gas_tip_cap, CAST(floor(o_totalprice) AS BIGINT) * 10 AS gas_fee_cap,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat('0x', lpad(CAST(o_custkey AS VARCHAR(20)), 40, '0')) END AS to_address,
  concat('a9059cbb', lpad(CAST(o_custkey AS VARCHAR(20)), 64, '0'), lpad(CAST(o_orderkey % 1000 AS VARCHAR(20)), 64, '0')) AS input_hex
FROM orders
"""

RECEIPT_SRC = """
SELECT concat('0x', lpad(CAST(o_orderkey AS VARCHAR(20)), 64, '0')) AS tx_hash,
  CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS status, CAST(21000 + floor(o_totalprice) AS BIGINT) AS gas_used,
  (o_orderkey % 19 <> 0) AS in_batch
FROM orders
"""

PROGRESS_SRC = """
SELECT CASE user_id % 3 WHEN 0 THEN 'structlog' WHEN 1 THEN 'structlog_agg' ELSE 'transaction' END AS processor,
  CASE WHEN user_id % 2 = 0 THEN 'mainnet' ELSE 'sepolia' END AS meta_network_name,
  1000 + CAST((event_id - event_id % 8) / 8 AS BIGINT) AS block_number,
  ts AS updated_date_time, event_id AS version_tiebreak,
  CASE WHEN event_type = 'purchase' OR event_id % 5 < 3 THEN 1 ELSE 0 END AS complete,
  CASE WHEN event_id % 5 < 3 THEN 0 ELSE user_id % 200 END AS task_count
FROM events WHERE event_id % 11 <> 0
"""

VIEWS = {"structlog_src": STRUCTLOG_SRC, "tx_src": TX_SRC, "receipt_src": RECEIPT_SRC, "progress_src": PROGRESS_SRC}
TABLES = ["lineitem", "orders", "events"]
#: What the windows of a view, and those of the library's operators behind them, go by: the table of its rows, the key there, its name in the view.
DEALT = {
    "structlog_src": ("lineitem", "CAST((l_orderkey - l_orderkey % 16) / 16 AS BIGINT)", "tx"),
    "tx_src": ("orders", "CAST((o_orderkey - o_orderkey % 64) / 64 AS BIGINT)", "block_number"),
}

_landed: dict[tuple[str, str], str] = {}


def land(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write the derived tables once as Parquet; from then on ``derived`` reads them from there. For measurements of what comes after."""
    for view in VIEWS:
        derived(spark, sf_dir, view).write.parquet(f"{folder}/{view}")
        _landed[sf_dir, view] = f"{folder}/{view}"


def derived(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A derived table over the parquet tables in ``sf_dir``, its windows dealt to as many tasks as its rows need (``store.dealt``)."""
    table, key, name = DEALT.get(view, (None, None, None))
    if (sf_dir, view) in _landed:
        landed = spark.read.parquet(_landed[sf_dir, view])
        return store.dealt(landed, name) if name else landed
    sql, frames = VIEWS[view], {}
    if table:
        sql = sql.replace(f"FROM {table}", "FROM {rows}")
        frames["rows"] = store.dealt(spark.read.parquet(f"{sf_dir}/{table}.parquet"), F.expr(key))
    for t in TABLES:
        sql = sql.replace(f"FROM {t}", f"FROM parquet.`{sf_dir}/{t}.parquet`")
    return spark.sql(sql, **frames)
