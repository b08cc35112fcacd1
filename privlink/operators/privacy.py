"""Hashed and encrypted copies of the linked table, and their inverse.

Both copies keep the non-personal columns in their order and append one
protected column per personal column, in list order, as the original copies
did. Each is a chain of projections without a shuffle; what several columns
need (row identity, signed bytes, decoded token) is its own column first, so
it is computed once per row.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.crypto import (
    FernetKey,
    HmacKey,
    fernet_body,
    fernet_raw,
    fernet_raw_ok,
    fernet_row,
    fernet_row_bodies,
    fernet_row_data,
    fernet_row_plain,
    fernet_sealed,
    fernet_segment,
    fernet_sign,
    new_key,
    new_salt,
    row_iv,
    row_salted_iv,
    secret,
    unpadded_text,
)
from ..functions.hashing import pseudonym
from ..schemas import KEY_RECORD, PERSONAL_COLUMNS

# Fixed value: note stored beside the key.
KEY_NOTE = "binary symetric encryption/decryption key"


def _check(df: DataFrame, cols) -> list[str]:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in frame: {missing}")
    return [c for c in df.columns if c not in cols]


def hash_columns(
    df: DataFrame,
    cols=tuple(PERSONAL_COLUMNS),
    algo: str = "murmur3",
    key: bytes | str | None = None,
    suffix: str = "_hashed",
) -> DataFrame:
    """Replace each column by its pseudonym (see ``functions.hashing``)."""
    keep = _check(df, cols)
    k = key.encode("utf-8") if isinstance(key, str) else key
    if k and algo != "murmur3":
        k = HmacKey(k)
    return df.select(*keep, *[pseudonym(c, algo, k).alias(f"{c}{suffix}") for c in cols])


_ROW, _BODY, _TOKENS = "__pl_row", "__pl_body", "__pl_tokens"
_SEG, _MESSAGE, _SEALED = "__pl_seg_{}", "__pl_message", "__pl_sealed"
_KEY, _RAW, _OK, _PLAIN, _DATA = "__pl_key", "__pl_raw", "__pl_ok", "__pl_plain", "__pl_data"


def spread(df: DataFrame, joined: bool = False) -> DataFrame:
    """``df`` dealt evenly over tasks, for what costs far more than a shuffle.

    AQE sizes the partitions from what is really there: it splits large ones
    and merges small ones. Encryption and keyed hashes are such work (about 20
    microseconds a value); a table that is read from many row groups needs no dealing.
    A row is no longer known by its place then, so give ``row_id_cols``.

    ``joined`` says that the rows come straight from a shuffled join, as linked rows do.
    That shuffle has dealt them by a hash of person and day, and AQE sizes and splits its
    partitions alike; moving every wide row once more would only cost the disk.
    """
    return df if joined else df.hint("rebalance")


def _row_id(df: DataFrame, row_id_cols):
    if row_id_cols:
        return F.to_json(F.struct(*[F.col(c) for c in row_id_cols]))
    # no identity given: a stream has no row numbers, so its rows get random ones
    return F.uuid() if df.isStreaming else F.monotonically_increasing_id().cast("string")


def _key(key: str | FernetKey | DataFrame) -> FernetKey:
    """Checks a key text early, on the driver; a key record stays a table."""
    if isinstance(key, DataFrame):
        return FernetKey.from_record(key)
    return key if isinstance(key, FernetKey) else FernetKey(key)


def encrypt_columns(
    df: DataFrame,
    key: str | FernetKey | DataFrame,
    cols=tuple(PERSONAL_COLUMNS),
    row_id_cols=None,
    *,
    salt: bytes | None = None,
    at: int | None = None,
    suffix: str = "_encrypted",
    deterministic: bool = False,
) -> DataFrame:
    """Replace each column by a Fernet token under ``key`` (its text, or a key
    record that was read back); NULL stays NULL.

    Every value gets its own IV derived from a secret per-run salt, the row identity
    and the values of the row, so equal values in different rows get unrelated
    tokens, as with random IVs. A row is encrypted in one call, in which
    each token's IV is the ciphertext of a block of its own. ``row_id_cols``
    must identify a row (e.g. message id plus condition id); a retried task
    then reproduces the same tokens wherever its rows come from. Without
    them a row is known by its place in the input (stable for a table that is
    read from storage; random in a stream), so that identical rows get
    different tokens as well.

    ``deterministic=True`` derives the IV from salt, column name and value alone, a call a value:
    within one run (one salt and time) equal values get equal tokens, so counts of distinct
    users and records on the encrypted copy equal those on the clear table.
    Equality of values is then visible in the copy; their content is not.
    """
    keep = _check(df, cols)
    k = _key(key)
    (s,) = secret(new_salt() if salt is None else salt)
    t = int(time.time()) if at is None else int(at)
    if deterministic:
        rows = df.select("*", F.array(*[fernet_body(F.col(c), k, row_iv(s, c, F.lit(""), F.col(c)), t) for c in cols]).alias(_BODY))
    else:
        seg = [_SEG.format(i) for i in range(len(cols))]
        rows = df.withColumn(_ROW, _row_id(df, row_id_cols)).select(*keep, _ROW, *[fernet_segment(F.col(c)).alias(x) for c, x in zip(cols, seg)])
        rows = rows.withColumn(_MESSAGE, F.concat(*seg))
        rows = rows.withColumn(_SEALED, fernet_row(F.col(_MESSAGE), k, row_salted_iv(s, F.col(_ROW), F.col(_MESSAGE))))
        rows = rows.select(*keep, F.array(*fernet_row_bodies(F.col(_SEALED), [F.octet_length(x) for x in seg], t)).alias(_BODY))
    # one higher-order function each for signing and unpadding: code for each column would be a method too long for the JVM's compiler
    rows = rows.select(*keep, _BODY, k.as_column().alias(_KEY))
    held = FernetKey.in_column(F.col(_KEY))
    rows = rows.select(*keep, F.transform(_BODY, lambda b: fernet_sign(b, held)).alias(_TOKENS))
    return rows.select(*keep, *[F.get(_TOKENS, i).alias(f"{c}{suffix}") for i, c in enumerate(cols)])


def decrypt_columns(
    df: DataFrame,
    key: str | FernetKey | DataFrame,
    cols=tuple(PERSONAL_COLUMNS),
    suffix: str = "_encrypted",
    check_column: str | None = None,
    ttl: int | None = None,
) -> DataFrame:
    """Inverse of ``encrypt_columns``: ``c_encrypted`` back to ``c``, under the
    key's text or a key record that was read back.
    Tokens whose MAC fails (or older than ``ttl`` seconds) decrypt to NULL;
    ``check_column`` (if given) holds True when every non-NULL token of the
    row verified. Each token is decoded and checked once; all good tokens of a row
    are decrypted in one call."""
    tokens = [f"{c}{suffix}" for c in cols]
    keep = _check(df, tokens)
    k = _key(key)
    rows = df.select(*keep, *tokens, k.as_column().alias(_KEY), F.transform(F.array(*tokens), fernet_raw).alias(_RAW))
    held = FernetKey.in_column(F.col(_KEY))
    rows = rows.withColumn(_OK, F.transform(_RAW, lambda r: fernet_raw_ok(r, held, ttl)))
    n = range(len(cols))
    rows = rows.select(*keep, *tokens, _KEY, _OK, F.zip_with(_RAW, _OK, lambda r, ok: F.when(ok, fernet_sealed(r)).otherwise(F.lit(bytearray(b"")))).alias(_SEALED))
    rows = rows.withColumn(_PLAIN, fernet_row_plain([F.get(_SEALED, i) for i in n], held))
    data = fernet_row_data(F.col(_PLAIN), [F.octet_length(F.get(_SEALED, i)) for i in n])
    rows = rows.select(*keep, *tokens, _OK, F.array(*data).alias(_DATA))
    rows = rows.withColumn(_DATA, F.transform(_DATA, unpadded_text))
    out = [F.get(_DATA, i).alias(c) for i, c in enumerate(cols)]
    if check_column:
        every = F.lit(True)
        for i, t in enumerate(tokens):
            every = every & (F.col(t).isNull() | F.get(_OK, i))
        out.append(every.alias(check_column))
    return rows.select(*keep, *out)


def key_record(spark: SparkSession, key: str, when: _dt.date | None = None, note: str = KEY_NOTE) -> DataFrame:
    """One-row table (Key, Key-String, Date, Note) describing the key.
    Written only where the caller decides; the key is never printed."""
    kb = key.encode("ascii")
    row = (bytearray(kb), key, when or _dt.date.today(), note)
    return spark.createDataFrame([row], KEY_RECORD)


__all__ = ["decrypt_columns", "encrypt_columns", "hash_columns", "key_record", "new_key", "spread"]
