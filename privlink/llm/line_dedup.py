"""Dropping frequent lines with a sharded minimal perfect hash.

1. Each text is read once: the 64-bit hashes of its distinct line keys go to a
   small table, beside 128 bits of hash of the text. Counting them (map-side first) gives the
   documents of each line.
2. The distinct hashes are dealt into shards of about KEYS_PER_SHARD keys. Each
   shard becomes a minimal perfect hash (bit levels: a key that is alone at its
   bit of a level owns it, the others go on to the next level; the number of
   owned bits before it is the key's index) with two arrays by index: a 16-bit
   fingerprint and the saturated count.
3. The documents' hashes visit the shard that owns them and probe its arrays; no
   table of lines is joined. A shard streams in front of its probes, so a task
   holds one shard at a time. The probes of a shard are dealt to copies of it, as many as
   the corpus has probes for; a line in more than 1 / HOT_LINES of all probes has as many
   copies more as its own count asks for. Only hits travel back.
4. Which lines a text loses depends on the text alone. So hits are gathered and joined by the
   hash of the text, not by document: ids may repeat or be null, and equal texts share one list.

Every probe is a member of its shard, so the fingerprint is a check on the
structure, not a source of false hits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches, materialise, texts_of

KEYS_PER_SHARD = 1 << 18
#: Probes of one copy of a shard, and the most lines that have copies of their own.
PROBES_PER_CELL, HOT_LINES = 1 << 18, 4_096
#: Bits of a level for each key still without an index.
_GAMMA = 2
_EDGES = re.compile(r"[\x20\x09-\x0D]+")
_BLANKS = " \t\n\v\f\r"
_LOWER = {c: c + 32 for c in range(65, 91)}


def line_key(line: str) -> str:
    """The line without ASCII blanks at its ends, A-Z lower-cased."""
    line = line.strip(_BLANKS)
    return line.lower() if line.isascii() else line.translate(_LOWER)


def _hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each key for each level (xor, multiply, shift)."""
    with np.errstate(over="ignore"):
        x = keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


class PerfectCounts:
    """Minimal perfect hash over distinct 64-bit keys with fingerprint and count arrays."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, counts: np.ndarray):
        self.levels, self.prints, self.counts = levels, prints, counts
        owned = [np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))]) for bits in levels]
        self.before = [o + sum(int(p[-1]) for p in owned[:i]) for i, o in enumerate(owned)]

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, top: int = 0xFFFF) -> PerfectCounts:
        """``keys`` must be distinct; counts above ``top`` are kept as ``top``."""
        levels, rest = [], keys
        while len(rest):
            m = max(64, -(-_GAMMA * len(rest) // 64) * 64)
            at = (_mix(rest, len(levels)) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            rest = rest[~alone[at]]
        out = cls(levels, np.zeros(len(keys), np.uint16), np.zeros(len(keys), np.uint16))
        at = out.index(keys)
        out.prints[at], out.counts[at] = out.print_of(keys), np.minimum(counts, top)
        return out

    @staticmethod
    def print_of(keys: np.ndarray) -> np.ndarray:
        return (_mix(keys, 1000) >> np.uint64(48)).astype(np.uint16)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key: 0 to n - 1 for members, -1 or anything for others."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (_mix(keys[open_], k) % np.uint64(64 * len(bits))).astype(np.int64)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            has = (word >> bit) & np.uint64(1) == 1
            below = word[has] & ((np.uint64(1) << bit[has]) - np.uint64(1))
            out[open_[has]] = self.before[k][at[has] >> 6] + np.bitwise_count(below)
            open_ = open_[~has]
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 where the fingerprint says it is no member."""
        at = self.index(keys)
        known = at >= 0
        out = np.zeros(len(keys), np.int64)
        out[known] = np.where(self.prints[at[known]] == self.print_of(keys[known]), self.counts[at[known]], 0)
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), len(self.prints), *(len(x) for x in self.levels)], "<i8")
        return b"".join([head.tobytes(), *(x.tobytes() for x in self.levels), self.prints.tobytes(), self.counts.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectCounts:
        n, keys = np.frombuffer(data, "<i8", 2).tolist()
        sizes, at, levels = np.frombuffer(data, "<i8", n, 16).tolist(), 16 + 8 * n, []
        for s in sizes:
            levels.append(np.frombuffer(data, "<u8", s, at))
            at += 8 * s
        return cls(levels, np.frombuffer(data, "<u2", keys, at), np.frombuffer(data, "<u2", keys, at + 2 * keys))


def line_hashes(docs: DataFrame, text_col: str, min_chars: int) -> DataFrame:
    """(a, b, hashes array<long>) of every text: 128 bits of its hash, and the distinct keys of its lines."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, sizes = [], [0]
        for text in texts_of(batch.column(2)):
            flat += {_hash(k) for k in map(line_key, text.split("\n")) if len(k) >= min_chars}
            sizes.append(len(flat))
        hashes = pa.array(np.array(flat, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), hashes)], names=["a", "b", "hashes"])

    return map_batches(docs.select(*text_bits(text_col), text_col), run, "a long, b long, hashes array<long>")


def text_bits(text_col: str) -> list[Column]:
    """128 bits of hash of a text, null as the empty text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit("b"), text).alias("b")]


def build_index(counts: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> tuple[DataFrame, int]:
    """(shard int, data binary) of the structure over (hash long, n long), and the number of shards."""
    shards = -(-max(1, counts.count()) // keys_per_shard)

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, n = (table.column(c).to_numpy() for c in ("hash", "n"))
        return pa.table({"shard": [key[0].as_py()], "data": pa.array([PerfectCounts.build(keys.view(np.uint64), n).to_bytes()], pa.binary())}, schema=pa.schema([("shard", pa.int32()), ("data", pa.binary())]))

    sharded = counts.select("hash", "n", F.pmod("hash", F.lit(shards)).cast("int").alias("shard"))
    return sharded.groupBy("shard").applyInArrow(build, "shard int, data binary"), shards


def _probe(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """The probes (a, b, hash) of cells that hit, each cell led by its shard's data."""
    shard: PerfectCounts | None = None
    for batch in batches:
        data = batch.column(0)
        leads = np.flatnonzero(~np.asarray(data.is_null())).tolist()
        for a, b in zip([0, *(i + 1 for i in leads)], [*leads, batch.num_rows], strict=True):
            if b > a:
                part = batch.slice(a, b - a)
                hits = shard.count(part.column(3).to_numpy().view(np.uint64)) >= min_docs
                yield pa.RecordBatch.from_arrays(part.columns[1:], names=["a", "b", "hash"]).filter(pa.array(hits))
            if b < batch.num_rows:
                shard = PerfectCounts.from_bytes(data[b].as_py())


def _cells(counts: DataFrame, shards: int) -> tuple[int, DataFrame]:
    """(copies of every shard, (line long, copies int, of int) of hot lines): a line with
    over 1 / HOT_LINES of all probes, at most HOT_LINES lines therefore, is spread over copies of its own shard."""
    probes = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = max(PROBES_PER_CELL, -(-probes // HOT_LINES))
    lines = counts.where(F.col("n") > hot).select(F.col("hash").alias("line"), F.ceil(F.col("n") / hot).cast("int").alias("copies"), F.pmod("hash", F.lit(shards)).cast("int").alias("of"))
    return max(1, -(-probes // (shards * hot))), lines


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text", keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """(a, b, drop array<long>): for each text (128 bits of its hash), hashes of its lines that
    at least ``min_docs`` documents (rows) have. Texts without such lines are left out."""
    if not 1 <= min_docs <= 0xFFFF:
        raise ValueError("min_docs must be 1 to 65535")
    own = materialise(line_hashes(docs, text_col, min_chars), "line-hashes")
    posts = own.select("a", "b", F.monotonically_increasing_id().alias("row"), F.explode("hashes").alias("hash"))  # a written table
    counts = materialise(posts.groupBy("hash").agg(F.count("*").alias("n")), "line-counts")
    index, shards = build_index(counts, keys_per_shard)
    base, hot = _cells(counts, shards)
    wide = hot.groupBy("of").agg(F.max("copies").alias("copies"))
    copies = F.greatest(F.lit(base), F.coalesce("copies", F.lit(1)))
    none = F.lit(None).cast("long")
    leads = index.join(F.broadcast(wide), F.col("shard") == F.col("of"), "left").select(
        "data", none.alias("a"), none.alias("b"), none.alias("hash"), "shard", F.explode(F.sequence(F.lit(0), copies - 1)).alias("cell")
    )
    probes = posts.join(F.broadcast(hot), F.col("hash") == F.col("line"), "left").select(
        F.lit(None).cast("binary").alias("data"), "a", "b", "hash", F.pmod("hash", F.lit(shards)).cast("int").alias("shard"), F.pmod(F.xxhash64("row", "hash"), copies).cast("int").alias("cell")
    )
    dealt = leads.union(probes).repartition("shard", "cell").sortWithinPartitions("shard", "cell", F.col("data").isNull())
    hits = dealt.select("data", "a", "b", "hash").mapInArrow(lambda it: _probe(it, min_docs), "a long, b long, hash long")
    return hits.groupBy("a", "b").agg(F.collect_set("hash").alias("drop"))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text", keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """All columns of ``docs`` with the frequent lines gone from the text, and
    ``n_lines`` (before), ``n_dropped``; columns of these names are replaced.

    A line's key is the line without ASCII blanks at its ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points that at least ``min_docs`` rows
    have lose all their lines in every document. Null and empty text: one empty
    line; a null text stays null. Ids are not looked at: they may repeat or be
    null. Repeated rows and rows of equal text count as documents of their own.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # a written table: both sides of the join come through an exchange then, and AQE can split a text with many copies
    drops = materialise(frequent_lines(docs, min_docs, min_chars, text_col, keys_per_shard), "line-drops")
    left = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), *text_bits(text_col))
    at = kept.index(text_col)
    # a merge join at every size: which side is small is no property of the corpus
    joined = left.join(drops.hint("merge"), ["a", "b"], "left").drop("a", "b")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_lines, n_dropped = [], [], []
        for text, drop in zip(batch.column(at).to_pylist(), batch.column(len(kept)).to_pylist(), strict=True):
            lines = (text or "").split("\n")
            stay = lines
            if drop:
                drop = {h & 0xFFFFFFFFFFFFFFFF for h in drop}
                stay = [x for x in lines if len(k := line_key(x)) < min_chars or _hash(k) not in drop]
            texts.append(text if len(stay) == len(lines) else "\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        cols = batch.columns[: len(kept)]
        cols[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*(f"c{i}" for i in range(len(kept))), "n_lines", "n_dropped"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema[: len(kept)])
    done = map_batches(joined, run, f"{schema}, n_lines long, n_dropped long")
    return done.toDF(*kept, "n_lines", "n_dropped")
