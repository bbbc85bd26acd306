"""The transaction table: blocks' transactions with their receipts and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions import calldata_stats, effective_gas_price, u128
from tracelake.functions.prices import U128


def _by_hash(receipts: DataFrame, name: str) -> DataFrame:
    """One row a hash with its different receipts: one hash can stand on several networks."""
    network = F.col("meta_network_name") if "meta_network_name" in receipts.columns else F.lit(None).cast("string")
    return receipts.groupBy(F.col("tx_hash").alias("hash")).agg(F.array_sort(F.collect_set(F.struct(network.alias("network"), "status", "gas_used"))).alias(name))


def _receipt(name: str, network):
    """Of a hash's receipts that of the network, else one that names no network."""
    own = F.filter(name, lambda r: r["network"] == network)
    return F.coalesce(F.get(own, F.lit(0)), F.get(F.filter(name, lambda r: r["network"].isNull()), F.lit(0)))


def with_receipts(transactions: DataFrame, receipts: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Transactions with receipt_status and receipt_gas_used by network and hash; a receipt that the block's batch lacks comes from
    ``fallback``. Receipts (tx_hash, status, gas_used) without meta_network_name count for their hash on every network; repeated ones count
    once, and of different ones the smallest by status and gas. One that is nowhere leaves nulls (see ``incomplete_blocks``)."""
    network = F.col("meta_network_name") if "meta_network_name" in transactions.columns else F.lit(None).cast("string")
    # without a network on the transactions' side any receipt of the hash will do
    pick = (lambda name: _receipt(name, network)) if "meta_network_name" in transactions.columns else (lambda name: F.get(name, F.lit(0)))
    out = transactions.join(_by_hash(receipts, "batch"), "hash", "left").withColumn("batch", pick("batch"))
    if fallback is None:
        return out.select(*transactions.columns, F.col("batch.status").alias("receipt_status"), F.col("batch.gas_used").alias("receipt_gas_used"))
    # only transactions without a receipt look for one in the fallback
    missing = out.where("batch is null").select("hash").distinct().join(_by_hash(fallback, "single"), "hash")
    out = out.join(missing, "hash", "left").withColumn("found", F.coalesce("batch", pick("single")))
    return out.select(*transactions.columns, F.col("found.status").alias("receipt_status"), F.col("found.gas_used").alias("receipt_gas_used"))


def locate(asked: DataFrame, transactions: DataFrame) -> DataFrame:
    """The asked (meta_network_name, block_number, transaction_index, transaction_hash) with error: null if the block has this transaction
    at this index, else what is wrong. Asked for twice, found twice."""
    key = ["meta_network_name", "block_number"]
    at = transactions.select(*key, F.col("position").cast("long").alias("transaction_index"), F.col("hash").alias("found_hash"))
    blocks = transactions.select(*key).distinct().withColumn("known", F.lit(True))
    df = asked.join(blocks, key, "left").join(at, [*key, "transaction_index"], "left")
    wrong = F.when(F.col("known").isNull(), "no such block").when(F.col("found_hash").isNull(), "transaction index out of range").when(~F.col("found_hash").eqNullSafe(F.col("transaction_hash")), F.concat(F.lit("transaction hash mismatch: found "), "found_hash"))
    return df.withColumn("error", wrong).select(*asked.columns, "error")


def located(asked: DataFrame, transactions: DataFrame) -> DataFrame:
    """The asked transactions; one that isn't where it is asked for fails the query."""
    df = locate(asked, transactions)
    return df.where(F.assert_true(F.col("error").isNull(), F.coalesce("error", F.lit(""))).isNull()).drop("error")


def incomplete_blocks(joined: DataFrame) -> DataFrame:
    """Blocks (by network, where there is one) with a transaction that has no receipt: they fail as a whole."""
    block = [c for c in ("meta_network_name", "block_number") if c in joined.columns]
    return joined.where("receipt_status is null").select(*block).distinct()


def transaction_table(transactions: DataFrame, receipts: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """One row a transaction of the blocks whose receipts are complete. Transactions carry the columns of sources.schemas.TRANSACTION and
    block_hash, parent_hash, base_fee and position; ``input`` is binary. Amounts are decimal(38,0), or, where they come as exact numbers of
    up to 128 bits (``functions.u128``), their decimal digits as text."""
    joined = with_receipts(transactions, receipts, fallback)
    failed = incomplete_blocks(joined)
    joined = joined.join(failed, failed.columns, "left_anti")
    kind = F.col("type")
    blob = kind == 3
    stats = calldata_stats(F.col("input"))
    exact = dict(transactions.dtypes)["value"].startswith("struct")
    amount = (lambda c: u128.to_string(F.col(c))) if exact else (lambda c: F.col(c).cast(U128))
    offers = [kind, *map(F.col, ("gas_price", "base_fee", "gas_tip_cap", "gas_fee_cap"))]
    price = u128.to_string(u128.effective_gas_price(*offers)) if exact else effective_gas_price(*offers)
    return joined.select(
        "block_number", "block_hash", "parent_hash", "position", "hash", F.col("from_address"), F.col("to_address"), "nonce", price.alias("gas_price"), "gas",
        F.when(kind >= 2, amount("gas_tip_cap")).alias("gas_tip_cap"), F.when(kind >= 2, amount("gas_fee_cap")).alias("gas_fee_cap"), F.coalesce(amount("value"), F.lit("0") if exact else F.lit(0).cast(U128)).alias("value"), "type", "size",
        stats["n_input_bytes"].alias("call_data_size"), F.when(blob, F.col("blob_gas")).alias("blob_gas"), F.when(blob, amount("blob_gas_fee_cap")).alias("blob_gas_fee_cap"),
        F.when(blob, F.coalesce(F.col("blob_hashes"), F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>")).alias("blob_hashes"), (F.col("receipt_status") == 1).alias("success"), *[v.alias(k) for k, v in stats.items()], "meta_network_name",
    )
