"""Vector code compression: a codebook for each part of the vectors, and the
index of the nearest entry as the code of a part.

The nearest entry is found by slicing and intersecting. For each coordinate of a
part the codebook's values are sorted, and the sorted list carries prefix masks:
mask i has a bit for each of the first i entries of the list. The entries within
a radius of a point in one coordinate are a range of the list, hence the
difference of two masks; the ranges of all coordinates, ANDed in uint64 words,
are the entries in the box around the point. An initial radius, at which a box
holds about NEAR entries, gives few entries and the distance of the best of
them. The box of that distance as radius holds every entry that is as near, so
the exact distances of its entries settle the nearest one and its ties.

Spark assigns vectors in batches and adds up, per task and then by shuffle, what
each entry was assigned; only sums of entries (parts x entries x part width)
reach the driver, which sends the next codebooks out as a broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, materialise
from .vectors import kept_vectors, matrix, width_of

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components beyond this size (after scaling) count as of this size, so that squared distances fit 64 bits.
LIMIT = 1 << 27
#: Entries that the initial radius aims at, and pairs of point and entry that are measured at a time.
NEAR, PAIRS = 8, 1 << 19


class SliceIndex:
    """Sorted coordinates with prefix entry masks of one codebook (entries x width)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        k, width = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.values = np.ascontiguousarray(np.take_along_axis(entries, order, 0).T)
        self.words = -(-k // 64)
        self.prefix = np.zeros((width, k + 1, self.words), np.uint64)
        for i in range(k):
            self.prefix[:, i + 1] = self.prefix[:, i]
            self.prefix[np.arange(width), i + 1, order[i] // 64] |= np.uint64(1) << (order[i] % 64).astype(np.uint64)
        self.radius = self._initial_radius()

    def _initial_radius(self) -> int:
        """The median box radius at which an entry has NEAR entries around it."""
        k = len(self.entries)
        reach = [np.partition(np.abs(self.entries - e).max(axis=1, initial=0), min(NEAR, k - 1))[min(NEAR, k - 1)] for e in self.entries]
        return int(np.median(reach))

    def box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (points x words) of the entries within ``radius`` of each point in every coordinate."""
        mask = np.tile(self.all_entries(), (len(points), 1))
        for d, (values, prefix) in enumerate(zip(self.values, self.prefix, strict=True)):
            low = np.searchsorted(values, points[:, d] - radius, "left")
            high = np.searchsorted(values, points[:, d] + radius, "right")
            mask &= prefix[high] ^ prefix[low]
        return mask

    def all_entries(self) -> np.ndarray:
        bits = np.zeros(64 * self.words, np.uint8)
        bits[: len(self.entries)] = 1
        return np.packbits(bits, bitorder="little").view("<u8").astype(np.uint64)

    def best(self, points: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of the nearest masked entry, the lowest of equally
        near ones; (-1, largest number) for an empty mask."""
        entry, distance = np.full(len(points), -1, np.int64), np.full(len(points), np.iinfo(np.int64).max)
        sizes = np.bitwise_count(mask).sum(axis=1, dtype=np.int64)
        ends, lo = np.cumsum(sizes), 0
        while lo < len(points):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, "right")))
            bits = np.unpackbits(mask[lo:hi].astype("<u8").view(np.uint8), axis=1, bitorder="little")
            point, candidate = np.nonzero(bits)  # by point, then by entry
            if len(point):
                apart = points[lo:hi][point] - self.entries[candidate]
                apart = np.einsum("ij,ij->i", apart, apart)
                first = np.flatnonzero(np.diff(point, prepend=-1))
                least = np.minimum.reduceat(apart, first)
                owner = point[first]
                hit = np.flatnonzero(apart == np.repeat(least, np.diff(np.append(first, len(point)))))
                hit = hit[np.diff(point[hit], prepend=-1) > 0]
                entry[lo + owner], distance[lo + owner] = candidate[hit], least
            lo = hi
        return entry, distance

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of the nearest entry to each point; ties go to the lower index."""
        if not self.entries.shape[1]:
            return np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        near = self.box(points, np.full(len(points), self.radius))
        entry, distance = self.best(points, near)
        none = entry < 0
        if none.any():  # an empty box: any entry's distance bounds the nearest one's
            apart = points[none] - self.entries[0]
            distance[none] = np.einsum("ij,ij->i", apart, apart)
        # every entry as near as the best so far lies in the box of that distance (rounded up)
        radius = np.ceil(np.sqrt(distance.astype(np.float64))).astype(np.int64) + 1
        wide = np.flatnonzero(radius > self.radius)
        entry[wide], distance[wide] = self.best(points[wide], self.box(points[wide], radius[wide]))
        return entry, distance


class Codebooks:
    """A codebook of integer entries for each of the equal consecutive parts of a vector."""

    def __init__(self, parts: np.ndarray):
        self.parts = parts  # part x entry x position
        self._slices: list[SliceIndex] | None = None

    @property
    def slices(self) -> list[SliceIndex]:
        if self._slices is None:
            self._slices = [SliceIndex(p) for p in self.parts]
        return self._slices

    def __reduce__(self):
        return Codebooks, (self.parts,)  # the masks are built where they are used

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, squared distances) of each vector and part."""
        width = self.parts.shape[2]
        found = [s.nearest(vectors[:, p * width : (p + 1) * width]) for p, s in enumerate(self.slices)]
        return tuple(np.stack(x, axis=1) for x in zip(*found, strict=True))

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, as decimal numbers with commas."""
        return hashlib.sha256(",".join(map(str, self.parts.ravel().tolist())).encode()).hexdigest()


def train_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of (id, v array<int>), fitted on all vectors; None if there are none.

    They start as the parts of the ``entries`` vectors with the smallest ids
    (null last, equal ids by their components; all vectors if fewer). Each round
    assigns every part to its nearest entry and replaces an entry by the
    component means, rounded down, of what it was assigned; others stay.
    """
    spark = vectors.sparkSession
    width = -(-width_of(vectors) // parts)
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # at most ``entries`` rows
    if not first:
        return None
    start = matrix(pa.array([r["v"] for r in first], pa.list_(pa.int32())), parts * width)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2)))
    for _ in range(rounds if width else 0):
        sent = spark.sparkContext.broadcast(books)

        def add_up(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            k = own.parts.shape[1]
            total, n = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
            for batch in batches:
                data = matrix(batch.column(0), parts * width)
                codes, _ = own.assign(data)
                for p in range(parts):
                    np.add.at(total[p], codes[:, p], data[:, p * width : (p + 1) * width])
                    n[p] += np.bincount(codes[:, p], minlength=k)
            part, entry = np.nonzero(n)
            spread = [np.repeat(x, width) for x in (part, entry, n[part, entry])]
            place = np.tile(np.arange(width), len(part))
            columns = [*(pa.array(x.astype(np.int32)) for x in (spread[0], spread[1], place)), pa.array(total[part, entry].ravel()), pa.array(spread[2])]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "total", "n"])

        sums = vectors.select("v").mapInArrow(add_up, "part int, entry int, place int, total long, n long")
        new = books.parts.copy()
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # the size of the codebooks
            new[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
        books = Codebooks(new)
        sent.unpersist()
    return books


def encode_vectors(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, codes array<int>, error long) of every (id, label, v): the nearest
    entry's index for each part, and the squared distances summed over the parts."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    parts, _, width = books.parts.shape

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, apart = sent.value.assign(matrix(batch.column(2), parts * width))
        offsets = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * parts)
        codes = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel().astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes, pa.array(apart.sum(axis=1))], names=["id", "label", "codes", "error"])

    kind = vectors.schema["label"].dataType.simpleString()
    return map_batches(vectors, run, f"id long, label {kind}, codes array<int>, error long")


def compress_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, Codebooks | None]:
    """((id, label, codes, error), codebooks) of all rows with a whole vector.

    Rows whose vector is null or holds a null or non-finite component are left
    out. A component x counts as floor(scale * x), in size at most LIMIT. Vectors
    shorter than the longest one, or than a multiple of ``parts``, end in zeros.
    Repeated rows are repeated; null labels and ids stay null; of an empty table
    the result is empty and there are no codebooks. ``entries`` may be 256 at most.
    """
    if not (parts >= 1 and 1 <= entries <= 256):
        raise ValueError("parts must be at least 1 and entries 1 to 256")
    vectors = materialise(kept_vectors(rows, scale, LIMIT, id_col, vector_col, label_col), "code-vectors")
    books = train_codebooks(vectors, parts, entries, rounds)
    if books is None:
        return vectors.select("id", "label", F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error")), None
    return encode_vectors(vectors, books), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` and ``label_error``: the error summed over the rows of equal label, nulls together."""
    codes = materialise(codes, "vector-codes")
    # a written table: if the join is no broadcast, both sides come through an exchange and AQE can split a hot label
    sums = materialise(codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return codes.join(sums, codes["label"].eqNullSafe(F.col("of"))).drop("of")
