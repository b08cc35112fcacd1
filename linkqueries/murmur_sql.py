"""Spark's ``hash`` of a string (Murmur3 x86_32, seed 42) as DuckDB SQL.

Used only by the oracle of the parity hashed copy. Follows Spark's variant:
4-byte little-endian blocks, then each remaining byte (sign-extended) mixed
as a block of its own, then the standard finaliser with the byte length.
"""

from __future__ import annotations

# Fixed values of MurmurHash3 x86_32 (public domain algorithm) and Spark's seed.
C1 = 0xCC9E2D51
C2 = 0x1B873593
H_ADD = 0xE6546B64
F1 = 0x85EBCA6B
F2 = 0xC2B2AE35
SEED = 42
_M = 1 << 32


def _mul(a: str, c: int) -> str:
    return f"CAST((CAST({a} AS HUGEINT) * {c}) % {_M} AS BIGINT)"


def _rotl(x: str, r: int) -> str:
    return f"(((({x}) << {r}) % {_M}) | (({x}) >> {32 - r}))"


def _byte(h: str, i: str) -> str:
    return f"CAST('0x' || substr({h}, 2 * ({i}) + 1, 2) AS BIGINT)"


def murmur3_string_sql(hexcol: str, ncol: str, valcol: str) -> str:
    """Expression over precomputed ``hex(encode(v))`` and its byte count."""
    words = (
        f"list_transform(range(0, {ncol} - {ncol} % 4, 4), lambda i: "
        f"{_byte(hexcol, 'i')} + {_byte(hexcol, 'i + 1')} * 256 + {_byte(hexcol, 'i + 2')} * 65536 "
        f"+ {_byte(hexcol, 'i + 3')} * 16777216)"
    )
    tail = (
        f"list_transform(range({ncol} - {ncol} % 4, {ncol}), lambda j: "
        f"CASE WHEN {_byte(hexcol, 'j')} >= 128 THEN {_byte(hexcol, 'j')} - 256 + {_M} ELSE {_byte(hexcol, 'j')} END)"
    )
    k1 = _mul(_rotl(_mul("k", C1), 15), C2)
    mix = f"(({_mul(_rotl('xor(h, ' + k1 + ')', 13), 5)} + {H_ADD}) % {_M})"
    body = f"list_reduce(list_concat({words}, {tail}), lambda h, k: {mix}, CAST({SEED} AS BIGINT))"
    fmix = (
        f"list_reduce([1, 2, 3, 4, 5, 6], lambda x, s: CASE s "
        f"WHEN 1 THEN xor(x, CAST({ncol} AS BIGINT)) "
        f"WHEN 2 THEN xor(x, x >> 16) "
        f"WHEN 3 THEN {_mul('x', F1)} "
        f"WHEN 4 THEN xor(x, x >> 13) "
        f"WHEN 5 THEN {_mul('x', F2)} "
        f"ELSE xor(x, x >> 16) END, {body})"
    )
    signed = f"(CASE WHEN {fmix} >= {1 << 31} THEN {fmix} - {_M} ELSE {fmix} END)"
    return f"CASE WHEN {valcol} IS NULL THEN '{SEED}' ELSE CAST({signed} AS VARCHAR) END"


def hashed_select(source: str, clear_cols: list[str], cols: list[str], suffix: str = "_hashed") -> str:
    pre = ", ".join(f"hex(encode({c})) AS __h_{i}, octet_length(encode({c})) AS __n_{i}" for i, c in enumerate(cols))
    outs = ", ".join(
        f"{murmur3_string_sql(f'__h_{i}', f'__n_{i}', c)} AS {c}{suffix}" for i, c in enumerate(cols)
    )
    return f"SELECT {', '.join(clear_cols)}, {outs} FROM (SELECT *, {pre} FROM {source})"
