"""SimHash near-duplicate groups by a byte-position inverted index.

Two 64-bit fingerprints that differ in at most four bits agree in at least four
of their eight bytes. The index posts each *distinct* fingerprint (copies are
collapsed first) under bytes with their positions; the count filter keeps the
pairs that share at least ``8 - max_bits`` positional bytes; the bit distance of
these is then checked.

Posting lists of single bytes would hold 1/256 of all fingerprints each, and
every pair within them. As a pair to be kept shares four positional bytes, it
also shares three of a fixed family of position triples, so the index posts
triples instead: 20 triples of the 8 positions, such that any 4 positions
contain one (checked at import). Lists are then 65,536 times shorter and the
tally runs on the pairs of a list, all eight positions at once.

Within a list no pairs are emitted but links that join two so far separate
fingerprints (a spanning forest), so a group of m gives at most m - 1 links per
triple. Lists longer than ``block`` fingerprints are dealt into cells of two
blocks each, so that a task never compares more than one cell's pairs at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, materialise

_ROWS = ((0, 1, 2), (3, 4, 5), (6, 7))


def position_triples() -> list[tuple[int, int, int]]:
    """Triples of the 8 byte positions such that any 4 positions contain one:
    three positions of one row, or two of a row and one of the next."""
    out = []
    for k, row in enumerate(_ROWS):
        out += combinations(row, 3)
        out += [tuple(sorted((*two, one))) for two in combinations(row, 2) for one in _ROWS[(k + 1) % 3]]
    return sorted(out)


TRIPLES = position_triples()
assert all(any(set(t) <= set(four) for t in TRIPLES) for four in combinations(range(8), 4))


def fingerprint(text: str, shingle: int, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of word shingles (see :func:`simhash_fingerprints`)."""
    words = text.encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, 8192):  # bounded memory for very long texts
        part = words[at : min(at + 8192, n) + shingle - 1]
        hashes = np.array([digest(b" ".join(part[i : i + shingle]), seed) for i in range(len(part) - shingle + 1)], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def simhash_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp long): the SimHash of each whole text.

    A-Z are lower-cased, words are runs of anything but ASCII blanks, shingles
    are ``shingle`` words (repeats count; a shorter text is one shingle). A bit
    is 1 if it is set in over half of the shingles' XXH64. A text without
    words, empty or null, has fingerprint zero.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [fingerprint(t or "", shingle) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, fp long")


def _forest(fps: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of equal ``group`` (sorted) that differ in at
    most ``max_bits`` bits, enough to connect all that such links connect."""
    n = len(fps)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    left, right = [], []
    live = np.arange(n)
    lag = 0
    while len(live):
        lag += 1
        live = live[live + lag < n]
        live = live[group[live] == group[live + lag]]
        other = fps[live] ^ fps[live + lag]
        # count filter: positional bytes that both share, then the distance itself
        shared = 8 - np.count_nonzero(other.view(np.uint8).reshape(-1, 8), axis=1)
        may = live[shared >= 8 - max_bits]
        may = may[np.bitwise_count(fps[may] ^ fps[may + lag]) <= max_bits]
        may = may[root[may] != root[may + lag]]
        for i in may.tolist():
            a, b = find(i), find(i + lag)
            if a != b:
                root[max(a, b)] = min(a, b)
                left.append(i)
                right.append(i + lag)
        if len(may):
            while not np.array_equal(up := root[root], root):
                root = up
    return fps[np.array(left, np.int64)], fps[np.array(right, np.int64)]


def _posting_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links of posting lists that arrive in order of (key, cell); a list may span batches."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def emit(parts):
        key, cell, fps = (np.concatenate(x) for x in zip(*parts, strict=True))
        new = np.flatnonzero((np.diff(key) != 0) | (np.diff(cell) != 0)) + 1
        group = np.zeros(len(key), np.int64)
        group[new] = 1
        a, b = _forest(fps.view(np.uint64), np.cumsum(group), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if held and (held[-1][0][-1], held[-1][1][-1]) != (cols[0][0], cols[1][0]):
            yield emit(held)
            held = []
        # all but the last list of this batch are complete
        same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
        cut = int(np.argmax(same))
        if cut:
            yield emit([*held, tuple(c[:cut] for c in cols)])
            held = []
        held.append(tuple(c[cut:] for c in cols))
    if held:
        yield emit(held)


def simhash_links(fps: DataFrame, max_bits: int = 4, block: int = 4096) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``), enough to
    connect all pairs of at most ``max_bits`` differing bits.

    Needs ``max_bits`` <= 4: beyond it the eight bytes guarantee too few matches.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0 to 4")
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("long"))
    keys = [F.lit(i << 24).cast("long") + F.shiftleft(byte(a), 16) + F.shiftleft(byte(b), 8) + byte(c) for i, (a, b, c) in enumerate(TRIPLES)]
    posts = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    long = materialise(posts.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "simhash-long-lists")
    # a fingerprint of a long list goes to the cells of its block with every block
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1), lambda j: F.least(mine, j) * F.col("blocks") + F.greatest(mine, j))
    )
    dealt = posts.join(long, "key", "left").select("key", F.explode(cells).alias("cell"), "fp")
    ordered = dealt.repartition("key", "cell").sortWithinPartitions("key", "cell")
    return ordered.mapInArrow(lambda batches: _posting_links(batches, max_bits), "a long, b long")


def connected(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Alternates two star steps (each node's larger neighbours, then its smaller
    ones, are hung on its smallest neighbour) until nothing changes. Each round that changes
    something makes the labels of the edges smaller, so it ends; about log² rounds
    are needed. Each is written to the shared folder.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    sign = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = materialise(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == sign:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        sign = now


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(id, fp long, component): the near-duplicate group of each document.

    ``component`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits, itself included. Equal fingerprints are always
    linked. A null id is passed over when the smallest is taken; a group whose
    ids are all null has component null. Repeated rows give repeated rows.
    """
    own = materialise(simhash_fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = materialise(own.groupBy("fp").agg(F.min(id_col).alias("head")), "simhash-classes")
    roots = connected(simhash_links(classes.select("fp"), max_bits))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "head", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("head").alias("component"))
    return own.join(rooted.join(heads, "root").select("fp", "component"), "fp").select(id_col, "fp", "component")
