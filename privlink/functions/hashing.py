"""Column pseudonyms.

``murmur3`` is Spark's ``hash`` (32-bit, seed 42, unkeyed, NULL -> 42): kept
for parity with the original hashed copy. ``hmac-sha256`` is keyed and keeps
NULL as NULL, so counts on the copy equal counts on the clear table.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .crypto import HmacKey, hmac_sha256_hex

ALGORITHMS = ("murmur3", "hmac-sha256")


def pseudonym(c: Column | str, algo: str = "murmur3", key: bytes | HmacKey | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if algo == "murmur3":
        return F.hash(col).cast("string")
    if algo == "hmac-sha256":
        if not key:
            raise ValueError("hmac-sha256 needs a key")
        return hmac_sha256_hex(key, col.cast("binary"))
    raise ValueError(f"unknown algorithm {algo!r}; expected one of {ALGORITHMS}")
