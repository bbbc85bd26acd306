"""Declared schemas of what is landed; nothing is inferred. Fields that nothing downstream uses are not read."""

from __future__ import annotations

from pyspark.sql import types as T

#: Networks by chain id (fixed values).
NETWORKS = {1: "mainnet", 11155111: "sepolia", 17000: "holesky", 560048: "hoodi"}

_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: An opcode of a trace; a cost can be close to 2**64.
STRUCTLOG = _struct(
    op=_S, gas=_L, gasCost=T.DecimalType(20, 0), gasUsed=_L, depth=T.IntegerType(), returnData=_S, refund=_L, error=_S, stack=T.ArrayType(_S), callToAddress=_S, memSize=_L, callTransfersValue=_B, extCodeCopySize=_L
)
TRACE = _struct(meta_network_name=_S, block_number=_L, transaction_hash=_S, transaction_index=_L, gas=_L, failed=_B, returnValue=_S, structLogs=T.ArrayType(STRUCTLOG))
#: Quantities are hex strings, as nodes send them.
TRANSACTION = _struct(
    hash=_S, type=_S, nonce=_S, gasPrice=_S, maxPriorityFeePerGas=_S, maxFeePerGas=_S, gas=_S, value=_S, input=_S, to=_S, blobVersionedHashes=T.ArrayType(_S), maxFeePerBlobGas=_S, size=_L, **{"from": _S}
)
BLOCK = _struct(meta_network_name=_S, number=_S, hash=_S, parentHash=_S, baseFeePerGas=_S, transactions=T.ArrayType(TRANSACTION))
RECEIPT = _struct(meta_network_name=_S, transactionHash=_S, status=_S, gasUsed=_S)
PROGRESS = _struct(updated_date_time=T.TimestampType(), block_number=_L, processor=_S, meta_network_name=_S, complete=T.IntegerType(), task_count=_L)
BEACON = _struct(slot_start_date_time=T.TimestampType(), execution_payload_block_number=_L, meta_network_name=_S)
