"""Fernet tokens and HMAC-SHA256 built from Spark's own expressions.

A Fernet token is ``base64url(0x80 | ts(8, big endian) | iv(16) | AES-128-CBC
ciphertext | HMAC-SHA256(sign_key, everything before))``; the 32-byte key is
``sign_key(16) | enc_key(16)`` (public Fernet specification). Spark's
``aes_encrypt(..., 'CBC', 'PKCS', iv)`` already returns ``iv | ciphertext``,
and HMAC is two ``sha2`` calls over precomputed key pads, so every value is
encrypted inside whole-stage codegen, with no Python worker.

Keys never stand in a plan: a literal would be printed by ``explain()`` and
written to Spark's event log. They enter as scalar subqueries over a one-row
in-memory frame (``secret``), which plans show as a subquery number only.

The IV is never left to ``aes_encrypt``: an IV-less call counts as
deterministic, so the optimizer may duplicate it and the copies would
disagree. Callers pass an IV expression derived from a secret run salt and
the row identity, which is unique per row and stable under task retries.

Most of a call of ``aes_encrypt`` or its inverse is the making of a cipher object. The
tokens of a row therefore share a call (``fernet_segment``, ``fernet_row``): CBC of all
values one after the other, a block of zeros before each, whose ciphertext is an IV that
nobody can tell beforehand. CBC picks up again after two blocks, so tokens of whatever
origin can be decrypted in one call as well (``fernet_row_plain``).
"""

from __future__ import annotations

import base64
import hashlib
import os
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the Fernet format and of HMAC (RFC 2104).
FERNET_VERSION = b"\x80"
HMAC_BLOCK = 64
HMAC_IPAD = 0x36
HMAC_OPAD = 0x5C
_MAC_LEN = 32
_HEADER_LEN = 9  # version byte + 8-byte time
_BLOCK = 16  # bytes of an AES block, and of an IV
_MAX_CLOCK_SKEW = 60  # seconds a token may be stamped in the future


def new_key() -> str:
    """Fresh random Fernet key (urlsafe base64 of 32 bytes)."""
    return base64.urlsafe_b64encode(os.urandom(32)).decode("ascii")


def new_salt() -> bytes:
    return os.urandom(32)


def split_key(key: str | bytes) -> tuple[bytes, bytes]:
    raw = base64.urlsafe_b64decode(key if isinstance(key, bytes) else key.encode("ascii"))
    if len(raw) != 32:
        raise ValueError("Fernet key must decode to 32 bytes")
    return raw[:16], raw[16:]


def _bin(b: bytes) -> Column:
    """A literal; for public bytes only (see ``secret``)."""
    return F.lit(bytearray(b))


def secret(*values: bytes, of=()) -> list[Column]:
    """Binary columns whose values no plan text and no event log shows. With ``of``, of
    a single value: a column for each of its functions (None: the value itself)."""
    spark = SparkSession.active()
    names = [f"part_{i}" for i in range(len(values))]
    frame = spark.createDataFrame([tuple(bytearray(v) for v in values)], ", ".join(f"{n} binary" for n in names))
    if of:
        return [frame.select(fn(F.col(names[0])).alias("made") if fn else names[0]).scalar() for fn in of]
    return [frame.select(n).scalar() for n in names]


class HmacKey:
    """Padded key of HMAC-SHA256, ready for use in any number of columns."""

    def __init__(self, key: bytes):
        k = key if len(key) <= HMAC_BLOCK else hashlib.sha256(key).digest()
        k = k.ljust(HMAC_BLOCK, b"\0")
        self.ipad, self.opad = secret(bytes(b ^ HMAC_IPAD for b in k), bytes(b ^ HMAC_OPAD for b in k))

    @classmethod
    def of_row(cls, frame: DataFrame, key: Column) -> HmacKey:
        """The key that an expression over a one-row frame gives (at most a block long)."""
        out = cls.__new__(cls)
        out.ipad, out.opad = (frame.select(_padded(key, pad).alias("pad")).scalar() for pad in (HMAC_IPAD, HMAC_OPAD))
        return out


def _padded(key: Column, pad: int) -> Column:
    """A binary key, filled up with zeros to a block, each byte XOR ``pad``."""
    digits = F.rpad(F.hex(key), 2 * HMAC_BLOCK, "0")
    byte = lambda i: F.conv(F.substr(digits, 2 * i - 1, F.lit(2)), 16, 10).cast("int")
    padded = F.transform(F.sequence(F.lit(1), F.lit(HMAC_BLOCK)), lambda i: F.lpad(F.hex(byte(i).bitwiseXOR(F.lit(pad))), 2, "0"))
    return F.when(key.isNotNull(), F.unhex(F.array_join(padded, "")))


class FernetKey:
    """A Fernet key's two halves as secret columns; raises on a malformed key."""

    def __init__(self, key: str | bytes):
        sign_key, enc_key = split_key(key)
        self.sign = HmacKey(sign_key)
        self.enc, self.end = secret(enc_key, of=(None, _sealed_end))

    @classmethod
    def from_record(cls, record: DataFrame, column: str = "Key-String") -> FernetKey:
        """The key of a key record that was read back, taken from the one-row table
        straight into the plan: its text never reaches the driver. A record
        without a well-formed key, or of several rows, fails the job."""
        raw = F.try_to_binary(F.translate(F.col(f"`{column}`"), "-_", "+/"), F.lit("base64"))
        rows = record.agg(F.count("*").alias("n"), F.max(raw).alias("raw"))
        good = (F.col("n") == 1) & (F.octet_length("raw") == 32)
        one = rows.select(F.when(good, F.col("raw")).otherwise(F.raise_error("the key record holds no single Fernet key").cast("binary")).alias("raw"))
        half = lambda at: F.substr(F.col("raw"), F.lit(at), F.lit(16))
        out = cls.__new__(cls)
        out.sign, out.enc = HmacKey.of_row(one, half(1)), one.select(half(17).alias("enc")).scalar()
        out.end = one.select(_sealed_end(half(17)).alias("end")).scalar()
        return out

    def as_column(self) -> Column:
        """The key as a struct column, for functions that hold no subquery (lambdas)."""
        return F.struct(self.sign.ipad.alias("ipad"), self.sign.opad.alias("opad"), self.enc.alias("enc"), self.end.alias("end"))

    @classmethod
    def in_column(cls, held: Column) -> FernetKey:
        """The key in a struct column made by ``as_column``."""
        out = cls.__new__(cls)
        out.sign = HmacKey.__new__(HmacKey)
        out.sign.ipad, out.sign.opad, out.enc, out.end = held["ipad"], held["opad"], held["enc"], held["end"]
        return out


def _sealed_end(enc: Column) -> Column:
    """The empty text under an encryption key, IV first: an end that any ciphertext may have."""
    return F.aes_encrypt(_bin(b""), enc, F.lit("CBC"), F.lit("PKCS"), _bin(bytes(_BLOCK)))


def _pad_of(n: Column) -> Column:
    """PKCS#7 padding of ``n`` bytes."""
    return F.get(F.array(*[_bin(bytes([_BLOCK - k]) * (_BLOCK - k)) for k in range(_BLOCK)]), n % _BLOCK)


def _fernet_key(key: str | bytes | FernetKey) -> FernetKey:
    return key if isinstance(key, FernetKey) else FernetKey(key)


def hmac_sha256_hex(key: bytes | HmacKey, msg: Column) -> Column:
    """HMAC-SHA256 of a binary column under a driver-side key (lower-case hex)."""
    k = key if isinstance(key, HmacKey) else HmacKey(key)
    inner = F.unhex(F.sha2(F.concat(k.ipad, msg), 256))
    return F.sha2(F.concat(k.opad, inner), 256)


def hmac_sha256(key: bytes | HmacKey, msg: Column) -> Column:
    """HMAC-SHA256 of a binary column under a driver-side key (binary result)."""
    return F.unhex(hmac_sha256_hex(key, msg))


def row_iv(salt: bytes | Column, column_name: str, row_id: Column, value: Column) -> Column:
    """16-byte IV = first half of SHA-256(salt | column | row id | value)."""
    material = F.concat(
        salt if isinstance(salt, Column) else secret(salt)[0],
        F.lit(column_name).cast("binary"),
        _bin(b"\0"),
        F.coalesce(row_id.cast("binary"), _bin(b"")),
        _bin(b"\0"),
        value.cast("binary"),
    )
    return F.substring(F.unhex(F.sha2(material, 256)), 1, 16)


def _swapped(text: Column, pairs) -> Column:
    """Texts replaced by others; a search each, where ``translate`` looks up every character."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def base64url(b: Column) -> Column:
    """Padded urlsafe base64 without the line breaks Spark's base64 may add."""
    return _swapped(F.base64(b), (("\r\n", ""), ("+", "-"), ("/", "_")))


def fernet_body(value: Column, key: FernetKey, iv: Column, at: int) -> Column:
    """What a token signs: version, time, IV and ciphertext; NULL stays NULL."""
    header = FERNET_VERSION + at.to_bytes(8, "big")
    return F.concat(_bin(header), F.aes_encrypt(value.cast("binary"), key.enc, F.lit("CBC"), F.lit("PKCS"), iv))


def fernet_segment(value: Column) -> Column:
    """A value's part of what ``fernet_row`` encrypts: the block its IV is made of, the
    value and its padding; nothing for NULL."""
    v = value.cast("binary")
    return F.coalesce(F.concat(_bin(bytes(_BLOCK)), v, _pad_of(F.octet_length(v))), _bin(b""))


def row_salted_iv(salt: Column, row_id: Column, message: Column) -> Column:
    """16-byte IV = first half of SHA-256(salt | row id | all values of the row)."""
    material = F.concat(salt, F.coalesce(row_id.cast("binary"), _bin(b"")), _bin(b"\0"), message)
    return F.substring(F.unhex(F.sha2(material, 256)), 1, _BLOCK)


def fernet_row(message: Column, key: FernetKey, iv: Column) -> Column:
    """The segments of a row (``message``) encrypted in one call, IV first."""
    return F.aes_encrypt(message, key.enc, F.lit("CBC"), F.lit("PKCS"), iv)


def _starts(lengths: list[Column]) -> list[Column]:
    """Bytes before each part."""
    out, at = [], F.lit(0)
    for n in lengths:
        out.append(at)
        at = at + n
    return out


def fernet_row_bodies(row: Column, lengths: list[Column], at: int) -> list[Column]:
    """What each token of an encrypted row signs; NULL where its segment has no bytes."""
    header = _bin(FERNET_VERSION + at.to_bytes(8, "big"))
    return [F.when(n > 0, F.concat(header, F.substr(row, start + (_BLOCK + 1), n))) for start, n in zip(_starts(lengths), lengths)]


def fernet_sealed(raw: Column) -> Column:
    """IV and ciphertext of a token; no bytes if they are no whole blocks."""
    n = F.octet_length(raw) - (_HEADER_LEN + _MAC_LEN)
    return F.when(n % _BLOCK == 0, F.substr(raw, F.lit(_HEADER_LEN + 1), n)).otherwise(_bin(b""))


def fernet_row_plain(sealed: list[Column], key: FernetKey) -> Column:
    """The plain text of tokens (``fernet_sealed``; no bytes: no token) decrypted in one call, paddings
    and, where an IV was, unreadable blocks included; see ``fernet_row_texts``."""
    return F.try_aes_decrypt(F.concat(*sealed, key.end), key.enc, F.lit("CBC"), F.lit("PKCS"))


def fernet_row_data(plain: Column, lengths: list[Column]) -> list[Column]:
    """Each token's padded bytes in ``fernet_row_plain`` of tokens with so many sealed bytes."""
    return [F.when(n > _BLOCK, F.substr(plain, start + 1, n - _BLOCK)) for start, n in zip(_starts(lengths), lengths)]


def unpadded_text(data: Column) -> Column:
    """The text before a PKCS#7 padding; NULL if it is none."""
    n = F.octet_length(data)
    pad = F.ascii(F.substr(data, n, F.lit(1)).cast("string"))
    good = pad.between(1, _BLOCK) & (F.substr(data, n - pad + 1, pad) == _pad_of(_BLOCK - pad))
    return F.when(good, F.substr(data, F.lit(1), n - pad)).cast("string")


def fernet_sign(body: Column, key: FernetKey) -> Column:
    return base64url(F.concat(body, hmac_sha256(key.sign, body)))


def fernet_encrypt(value: Column, key: str | bytes | FernetKey, iv: Column, at: int | None = None) -> Column:
    """Fernet token of a string column; NULL stays NULL."""
    k = _fernet_key(key)
    return fernet_sign(fernet_body(value, k, iv, int(time.time()) if at is None else int(at)), k)


def fernet_raw(token: Column) -> Column:
    """The bytes of a token; NULL if it is absent or no base64url."""
    return F.try_to_binary(_swapped(token, (("-", "+"), ("_", "/"))), F.lit("base64"))


def fernet_raw_ok(raw: Column, key: FernetKey, ttl: int | None = None, now: int | None = None) -> Column:
    """Whether the bytes of a token are well formed, authentic and, with
    ``ttl`` (seconds), not older than that nor stamped more than 60 s after
    ``now`` (default: this moment on the driver)."""
    n = F.octet_length(raw)
    ok = (
        (n >= _HEADER_LEN + 16 + 16 + _MAC_LEN)
        & (F.substr(raw, F.lit(1), F.lit(1)) == _bin(FERNET_VERSION))
        & (hmac_sha256(key.sign, F.substr(raw, F.lit(1), n - _MAC_LEN)) == F.substr(raw, n - (_MAC_LEN - 1), F.lit(_MAC_LEN)))
    )
    if ttl is not None:
        t = int(time.time()) if now is None else int(now)
        stamped = F.conv(F.hex(F.substr(raw, F.lit(2), F.lit(8))), 16, 10).cast("long")
        ok = ok & (stamped + F.lit(int(ttl)) >= F.lit(t)) & (stamped <= F.lit(t + _MAX_CLOCK_SKEW))
    return F.coalesce(ok, F.lit(False))


def fernet_raw_text(raw: Column, key: FernetKey) -> Column:
    """The text in the bytes of a token, without any check."""
    payload = F.substr(raw, F.lit(_HEADER_LEN + 1), F.octet_length(raw) - (_HEADER_LEN + _MAC_LEN))
    return F.try_aes_decrypt(payload, key.enc, F.lit("CBC"), F.lit("PKCS")).cast("string")


def fernet_decrypt(token: Column, key: str | bytes | FernetKey, ttl: int | None = None, now: int | None = None) -> Column:
    """Plain text of a Fernet token; NULL when the token is absent, malformed,
    not authentic or out of time (see ``fernet_raw_ok``)."""
    k, raw = _fernet_key(key), fernet_raw(token)
    return F.when(fernet_raw_ok(raw, k, ttl, now), fernet_raw_text(raw, k))


def fernet_mac_ok(token: Column, key: str | bytes | FernetKey) -> Column:
    """True when the token is well formed and authentic; NULL for NULL."""
    return F.when(token.isNotNull(), fernet_raw_ok(fernet_raw(token), _fernet_key(key)))
