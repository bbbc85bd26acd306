"""Column expressions: hex words, addresses, opcodes, prices. All are native Spark expressions that never raise on bad input."""

from tracelake.functions import u128
from tracelake.functions.hexes import format_address, is_hex_zero, parse_hex_u32, parse_hex_u64, return_data_hex
from tracelake.functions.opcodes import CALLS, CREATES, call_has_value, call_target, extcodecopy_size, has_error, is_call, is_call_or_create, is_precompile
from tracelake.functions.prices import calldata_stats, effective_gas_price, parse_u128

__all__ = [
    "CALLS", "CREATES", "call_has_value", "call_target", "calldata_stats", "effective_gas_price", "extcodecopy_size", "format_address", "has_error",
    "is_call", "is_call_or_create", "is_hex_zero", "is_precompile", "parse_hex_u32", "parse_hex_u64", "parse_u128", "return_data_hex", "u128",
]
