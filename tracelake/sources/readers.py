"""From landed files to flat tables. Works the same on static and on streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions import parse_hex_u64, return_data_hex, u128
from tracelake.sources import schemas

#: Gas of one blob (fixed value).
GAS_PER_BLOB = 131072


def network_name(chain_id: Column, override: str | None = None) -> Column:
    """Name of a network by chain id; an unknown id is an error unless an override names it."""
    if override:
        return F.lit(override)
    names = F.create_map(*[x for k, v in schemas.NETWORKS.items() for x in (F.lit(k).cast("long"), F.lit(v))])
    name = F.try_element_at(names, chain_id.cast("long"))
    return F.coalesce(name, F.raise_error(F.concat(F.lit("unknown chain id "), chain_id.cast("string"))).cast("string"))


def read_json(spark: SparkSession, path: str, schema, stream: bool = False, multiline: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """One JSON document a line, or with ``multiline`` one document (or an array of them) a file, over any number of lines. A file that isn't
    what is said fails the query; with ``mode`` PERMISSIVE its documents are rows of nulls, with DROPMALFORMED they are left out."""
    reader = (spark.readStream if stream else spark.read).schema(schema).option("mode", mode).option("multiLine", multiline)
    return reader.json(path)


def trace_headers(traces: DataFrame) -> DataFrame:
    """One row a transaction: its key, index, gas, failure and return value (empty ones are null)."""
    value = F.col("returnValue")
    return traces.select("meta_network_name", "block_number", "transaction_hash", "transaction_index", F.col("gas").alias("trace_gas"), F.coalesce("failed", F.lit(False)).alias("trace_failed"), F.when(~value.isin("", "0x"), value).alias("trace_return_value"))


def flatten_traces(traces: DataFrame) -> DataFrame:
    """One row an opcode, as operators.frames.normal takes it: four stack operands instead of the stack, return data as hex."""
    rows = traces.select("meta_network_name", "block_number", "transaction_hash", F.posexplode("structLogs").alias("idx", "x"))
    operands = [F.try_element_at("x.stack", F.lit(-k)).alias(f"s{k}") for k in range(1, 5)]
    return rows.select(
        "meta_network_name", "block_number", "transaction_hash", F.col("idx").cast("long").alias("idx"), "x.op", "x.gas", F.col("x.gasCost").alias("gas_cost"), F.col("x.gasUsed").alias("gas_used"), "x.depth",
        return_data_hex(F.col("x.returnData")).alias("return_data"), "x.refund", "x.error", F.col("x.callToAddress").alias("call_to_address"), F.col("x.memSize").alias("mem_size"),
        F.col("x.callTransfersValue").alias("call_transfers_value"), F.col("x.extCodeCopySize").alias("ext_code_copy_size"), *operands,
    )


def _quantity(c: Column, exact: bool) -> Column:
    """Hex quantity as a number, exact up to 128 bits (``u128.TYPE``) or as a decimal of 38 digits. Null stays null, malformed gives 0; one that
    the type can't hold is null, never another number."""
    value = u128.from_hex(c) if exact else u128.to_decimal(u128.from_hex(c))
    zero = u128.from_hex(F.lit("0x0")) if exact else F.lit(0).cast("decimal(38,0)")
    return F.when(c.isNull(), None).when(~F.regexp_like(c, F.lit("^(0x)?[0-9a-fA-F]*$")), zero).otherwise(value)


def _long(c: Column) -> Column:
    """Hex quantity as a long: malformed gives 0, 2^63 and more are null."""
    return parse_hex_u64(c).try_cast("long")


def flatten_blocks(blocks: DataFrame, exact: bool = False) -> DataFrame:
    """One row a transaction, as plans.transactions.transaction_table takes it. With ``exact``, prices and values are numbers of up to 128 bits
    (see functions.u128), else decimals of 38 digits."""
    rows = blocks.select("meta_network_name", _long(F.col("number")).alias("block_number"), F.lower("hash").alias("block_hash"), F.lower("parentHash").alias("parent_hash"), _quantity(F.col("baseFeePerGas"), exact).alias("base_fee"), F.posexplode("transactions").alias("position", "x"))
    x = lambda name: F.col(f"x.{name}")
    return rows.select(
        "meta_network_name", "block_number", "block_hash", "parent_hash", "base_fee", F.col("position").cast("long").alias("position"), F.lower(x("hash")).alias("hash"), _long(x("type")).cast("int").alias("type"), _long(x("nonce")).alias("nonce"),
        _quantity(x("gasPrice"), exact).alias("gas_price"), _quantity(x("maxPriorityFeePerGas"), exact).alias("gas_tip_cap"), _quantity(x("maxFeePerGas"), exact).alias("gas_fee_cap"), _long(x("gas")).alias("gas"), _quantity(x("value"), exact).alias("value"), x("size").alias("size"),
        F.unhex(F.regexp_replace(x("input"), "^0x", "")).alias("input"), F.lower(x("from")).alias("from_address"), F.lower(x("to")).alias("to_address"), F.transform(x("blobVersionedHashes"), F.lower).alias("blob_hashes"),
        (F.coalesce(F.size(x("blobVersionedHashes")), F.lit(0)).cast("long") * GAS_PER_BLOB).alias("blob_gas"), _quantity(x("maxFeePerBlobGas"), exact).alias("blob_gas_fee_cap"),
    )


def flatten_receipts(receipts: DataFrame) -> DataFrame:
    """One row a receipt; a source without meta_network_name leaves it null (see plans.transactions.with_receipts)."""
    return receipts.select("meta_network_name", F.lower("transactionHash").alias("tx_hash"), _long(F.col("status")).cast("int").alias("status"), _long(F.col("gasUsed")).alias("gas_used"))
