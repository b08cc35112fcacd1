"""Exact substring deduplication with collection suffix order.

A byte goes if it lies in a ``length``-byte string (window) that also starts
earlier. Equal windows are grouped by the collection's Burrows-Wheeler transform
and common prefixes, built column by column (:mod:`collection_bwt`). To spread
this over tasks, strings that can share a window are brought together by content:

1. *Anchors.* Each window is owned by its smallest k-byte string (by hash, the
   leftmost of equal ones), so equal windows have equal anchors. Neighbouring
   windows of one anchor make a segment. A segment travels as hashes of anchor
   and segment. Copies within an Arrow batch are settled there, before the shuffle.
2. Segments meet by anchor, in order. All but the first of equal segments are
   repeats as a whole. Where an anchor has several distinct segments these are
   candidates; everything else is unique.
3. Candidates get their text back and are cut into pieces of at most STEP
   windows, which share a core of ``length - STEP + 1`` bytes. Pieces meet by
   core; a core with one distinct piece is done.
4. The distinct pieces left are the documents of collections of about COLLECTION
   strings. Column-wise insertion gives their suffix order and common prefixes:
   runs of common prefixes of at least ``length`` bytes are equal windows, of
   which all but the earliest are repeats. A core with more than COLLECTION
   distinct pieces (a hot passage in ever different contexts) is split: its windows,
   reduced to the earliest of what a task sees at a time, are dealt anew by the whole window's
   hash, so that equal ones stay together, and form collections of their own.
5. Repeats meet their documents and are cut out.

A document is known by its id and, if ids repeat or are null, by 128 bits of its text;
rows of equal id and text are one document, which is worked on once.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .collection_bwt import shared_prefixes
from .common import map_batches, materialise

ANCHOR, STEP, COLLECTION = 24, 20, 1_024
#: Bytes that are hashed in one go, and windows of one pass over them.
_CHUNK = 1 << 20
_LAST_ID = (1 << 63) - 1
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
        return x ^ (x >> _U(33))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64))


def _hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-byte string: polynomials of 2, 4, 8, ... bytes put together."""
    with np.errstate(over="ignore"):
        part, base, size = _BYTES[data], _U(0x9E3779B97F4A7C15), 1
        out, done = None, 0
        while True:
            if k & size:
                out, done = (part, size) if out is None else (out[: len(data) - done - size + 1] * base + part[done : len(data) - size + 1], done + size)
            size *= 2
            if size > k:
                return _mix(out)
            part = part[: -(size // 2)] * base + part[size // 2 :]
            base = base * base


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width`` values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(data: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first, last): runs of windows (by start) of ``data`` with one
    anchor. Windows do not cross ``ends``, where documents end."""
    out = []
    raw, width = np.frombuffer(data, np.uint8), length - ANCHOR + 1
    for lo in range(0, len(raw) - length + 1, _CHUNK):
        part = raw[lo : lo + _CHUNK + length - 1]
        hashes = _hashes(part, ANCHOR)
        # hash above position: the smallest is the smallest hash, the leftmost of equal ones
        owner = (_least((hashes >> _U(24) << _U(24)) | np.arange(len(hashes), dtype=np.uint64), width) & _U(0xFFFFFF)).astype(np.int64)
        doc = np.searchsorted(ends, np.arange(lo, lo + len(owner)), side="right")
        new = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(doc) != 0)]))
        last = np.minimum(np.concatenate([new[1:], [len(owner)]]) - 1 + lo, ends[doc[new]] - length)
        real = last >= new + lo
        out.append((hashes[owner[new]][real], new[real] + lo, last[real]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 2)


def _changes(*columns: np.ndarray) -> np.ndarray:
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


#: A window's document (id and two halves of a text hash) and start.
_PLACE = "id long, a long, b long, pos long"
_POSITIONS = f"kind int, key long, hash long, {_PLACE}, n int"
Place = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _positions(place: Place, n: np.ndarray, kind: int, key: np.ndarray | None = None) -> pa.RecordBatch:
    zero = np.zeros(len(n), np.int64)
    columns = [np.full(len(n), kind, np.int32), zero if key is None else key, zero, *place, n.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "key", "hash", "id", "a", "b", "pos", "n"])


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(key, hash, id, a, b, pos, n) of (id, a, b, data): segments of the texts; ``n`` is the
    number of windows, negative if the batch has an earlier equal segment."""
    for batch in batches:
        own_ids, texts, at = [batch.column(c).to_numpy() for c in range(3)], batch.column(3), 0
        while at < batch.num_rows:
            taken, size, first = [], 0, at
            while at < batch.num_rows and (not taken or size < _CHUNK):
                taken.append(texts[at].as_py())
                size += len(taken[-1])
                at += 1
            data = b"".join(taken)
            sizes = np.array([len(t) for t in taken])
            ends = np.cumsum(sizes)
            key, lo, hi = segments(data, ends, length)
            if not len(key):
                continue
            doc = np.searchsorted(ends, lo, side="right")
            pos = lo - (ends[doc] - sizes[doc])
            digest = xxhash.xxh3_64_intdigest
            own = np.array([digest(data[a:b]) for a, b in zip(lo.tolist(), (hi + length).tolist(), strict=True)], np.uint64)
            place = (*(x[first:at][doc] for x in own_ids), pos)
            order = np.lexsort((*reversed(place), own, key))
            key, own, n = key[order], own[order], (hi - lo + 1)[order]
            place = tuple(x[order] for x in place)
            again = ~_changes(key, own)
            # a settled row needs no meeting: it is dealt by its own position
            with np.errstate(over="ignore"):
                alone = _mix((place[0].view(np.uint64) ^ place[1].view(np.uint64)) * _U(31) + place[3].view(np.uint64))
            key = np.where(again, alone, key).view(np.int64)
            columns = [key, own.view(np.int64), *place, np.where(again, -n, n).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "hash", "id", "a", "b", "pos", "n"])


class _Meeting:
    """Rows in order of (key, hash, place), batch by batch: which repeat an
    earlier row's hash, and which are the first of theirs while their key has others.

    Holds one row from batch to batch: the first of the last key, as long as it is the only one.
    """

    def __init__(self):
        self.key = self.hash = None
        self.alone: tuple | None = None

    def split(self, cols: tuple) -> tuple[np.ndarray, list[tuple], np.ndarray]:
        """(rows that are repeats, the held row if it now has others, rows that are first among several)."""
        key, hash_ = cols[0], cols[1]
        new = _changes(key, hash_)
        same_key = self.key is not None and key[0] == self.key
        if same_key and hash_[0] == self.hash:
            new[0] = False
        firsts = np.flatnonzero(new)
        start = np.flatnonzero(_changes(key[firsts])) if len(firsts) else firsts
        group = np.cumsum(_changes(key[firsts])) - 1 if len(firsts) else firsts
        count = np.bincount(group, minlength=len(start))
        joined = bool(len(firsts)) and same_key and key[firsts[0]] == self.key
        released = []
        if joined:
            count[0] += 1  # the key had a first row before
            if self.alone is not None:
                released.append(self.alone)
        several = firsts[count[group] > 1] if len(firsts) else firsts
        # what to hold
        if len(firsts) and (not same_key or key[firsts[-1]] != self.key or joined):
            only = count[-1] == 1
            self.alone = tuple(c[firsts[-1]] for c in cols) if only else None
        if key[-1] != self.key and not len(firsts):
            self.alone = None
        self.key, self.hash = key[-1], hash_[-1]
        return np.flatnonzero(~new), released, several


def _columns(batch: pa.RecordBatch, n: int) -> tuple:
    return tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns[:n])


def _meet_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions: kind 0 is a repeat, kind 1 a candidate."""
    meeting = _Meeting()
    for batch in batches:
        cols = _columns(batch, 7)
        done = cols[6] < 0
        yield _positions(tuple(c[done] for c in cols[2:6]), -cols[6][done], 0)
        cols = tuple(c[~done] for c in cols)
        if not len(cols[0]):
            continue
        again, released, several = meeting.split(cols)
        yield _positions(tuple(c[again] for c in cols[2:6]), cols[6][again], 0)
        yield _positions(tuple(c[several] for c in cols[2:6]), cols[6][several], 1, cols[0][several])
        if released:
            held = [np.array(x) for x in zip(*released, strict=True)]
            yield _positions(tuple(held[2:6]), held[6], 1, held[0])


_STRINGS = f"hash long, {_PLACE}, text binary"


def _strings(first: list[tuple], names: list[str]) -> pa.RecordBatch:
    """A batch of (whole numbers ..., text) rows; hashes are unsigned."""
    columns = list(zip(*first, strict=True)) or [()] * len(names)
    whole = [np.array(c, np.uint64).view(np.int64) if n in ("core", "hash", "low") else np.array(c, np.int64) for n, c in zip(names, columns[:-1], strict=False)]
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in whole), pa.array(columns[-1], pa.binary())], names=names)


def _piece_rows(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """(core, hash, id, a, b, pos, text): the pieces of a document's candidate segments.

    ``spots`` has anchor hash, start and windows of each candidate. The
    anchor's place is found again from its hash; pieces are cut at multiples of
    STEP windows before it, so equal windows fall in pieces of equal cores.
    """
    digest, rows = xxhash.xxh3_64_intdigest, []
    for *doc, text, spots in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3), batch.column(4).to_pylist(), strict=True):
        text = text.as_py()
        for spot in spots:
            lo = spot["pos"]
            hi = lo + spot["n"] - 1
            # the anchor lies in all windows of the segment: the leftmost place of its hash in the last window
            near = _hashes(np.frombuffer(text, np.uint8, length, hi), ANCHOR).view(np.int64)
            anchor = hi + int(np.argmax(near == spot["key"]))
            for c in range((anchor - hi) // STEP, (anchor - lo) // STEP + 1):
                first, last = max(lo, anchor - (c + 1) * STEP + 1), min(hi, anchor - c * STEP)
                if first > last:
                    continue
                core = text[anchor - c * STEP : anchor - (c + 1) * STEP + 1 + length]
                piece = text[first : last + length]
                rows.append((digest(core) ^ spot["key"] & (1 << 64) - 1, digest(piece), *doc, first, piece))
    return _strings(rows, ["core", "hash", "id", "a", "b", "pos", "text"])


#: A string of a collection: its document and start, and its text.
Piece = tuple[int, int, int, int, bytes]


def _repeats_in(pieces: list[Piece], length: int) -> pa.RecordBatch:
    """Windows of a collection's pieces that start earlier elsewhere in it."""
    string, offset, group = shared_prefixes([t for *_, t in pieces], length)
    *doc, pos = (np.array(x, np.int64)[string] for x in list(zip(*pieces, strict=True))[:4])
    place = (*doc, pos + offset)
    order = np.lexsort((*reversed(place), group))
    later = order[~_changes(group[order])]
    return _positions(tuple(x[later] for x in place), np.ones(len(later), np.int32), 0)


def _windows_in(pieces: list[Piece], length: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Windows of pieces: (0, positions) of those that start earlier in one of them, (2, rows)
    (low, hash, id, a, b, pos, text) of the earliest of each. ``low`` and ``hash`` are a 128-bit hash."""
    digest, earliest, again = xxhash.xxh3_128_intdigest, {}, []
    for *doc, pos, text in sorted(pieces, key=lambda p: p[:4]):
        for j in range(len(text) - length + 1):
            window = text[j : j + length]
            known = earliest.setdefault(window, (*doc, pos + j))
            if known != (*doc, pos + j):
                again.append((*doc, pos + j))
    place = tuple(np.array(x, np.int64) for x in (zip(*again, strict=True) if again else [()] * 4))
    yield 0, _positions(place, np.ones(len(again), np.int32), 0)
    yield 2, _strings([((h := digest(w)) & (1 << 64) - 1, h >> 64, *p, w) for w, p in earliest.items()], _WINDOW)


_WINDOW = ["low", "hash", "id", "a", "b", "pos", "text"]
_NEAR = f"{_POSITIONS}, low long, text binary"


def _with_text(kind: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Positions (kind 0) and windows (kind 2) as rows of one schema."""
    n = batch.num_rows
    if kind == 0:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names=[*batch.schema.names, "low", "text"])
    low, hash_, id_, a, b, pos, text = batch.columns
    kinds, ones = pa.array(np.full(n, 2, np.int32)), pa.array(np.ones(n, np.int32))
    return pa.RecordBatch.from_arrays([kinds, pa.array(np.zeros(n, np.int64)), hash_, id_, a, b, pos, ones, low, text], names=["kind", "key", "hash", "id", "a", "b", "pos", "n", "low", "text"])


def _meet_pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Kind 0 is a repeat, kind 2 a window of a core with more than
    COLLECTION distinct pieces. Holds at most twice as many pieces and a batch."""
    meeting, held, last_core, first, wide = _Meeting(), [], None, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = _columns(batch, 6)
        text = batch.column(6)
        again, released, several = meeting.split((*cols, _texts(text)))
        sizes = np.array([len(text[int(i)].as_py()) for i in again], np.int64)
        yield _with_text(0, _positions(tuple(c[again] for c in cols[2:]), sizes - length + 1, 0))
        rows = [(r[0], (*map(int, r[2:6]), r[6])) for r in released]
        rows += [(cols[0][i], (*(int(c[i]) for c in cols[2:]), text[int(i)].as_py())) for i in several.tolist()]
        spread = []
        for c, piece in rows:
            if c != last_core:
                if len(held) >= COLLECTION:
                    yield _with_text(0, _repeats_in(held, length))
                    held = []
                last_core, first, wide = c, len(held), False
            (spread if wide else held).append(piece)
            if not wide and len(held) - first > COLLECTION:
                spread += held[first:]
                del held[first:]
                wide = True
        if spread:
            for kind, found in _windows_in(spread, length):
                yield _with_text(kind, found)
    if held:
        yield _with_text(0, _repeats_in(held, length))


def _meet_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Positions of repeats among windows (low, hash, id, a, b, pos, text) in order of hash and
    place. Collections end where the hash changes; of more than COLLECTION
    equal hashes the earliest of each window goes on to the next collection."""
    held: list[Piece] = []
    last = None
    for batch in batches:
        low, hash_, *place = _columns(batch, 6)
        for i, text in enumerate(batch.column(6).to_pylist()):
            if len(held) >= COLLECTION:
                yield _repeats_in(held, length)
                seen: dict[bytes, Piece] = {}
                if (low[i], hash_[i]) == last:
                    for p in sorted(held[same:]):
                        seen.setdefault(p[4], p)
                held, same = list(seen.values()), 0
            if (low[i], hash_[i]) != last:
                last, same = (low[i], hash_[i]), len(held)
            held.append((*(int(c[i]) for c in place), text))
    if held:
        yield _repeats_in(held, length)


def _texts(column: pa.Array) -> np.ndarray:
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def _free(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are written.

    Spark does so once it sees that nothing refers to them. What the first
    collection releases may have held others; the cleaner needs a moment.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


_DOC = ["id", "a", "b"]


def _documents(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(own, id, a, b, data) of every row, and whether rows repeat.

    A null id is the largest. ``a`` and ``b`` are 128 bits of the text where ids do not
    tell texts apart, else 0: a narrow count by id says so, and moves no text.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("own"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"), F.coalesce(text_col, F.lit("")).cast("binary").alias("data"))
    bits = [F.xxhash64("data"), F.xxhash64(F.lit("b"), "data")]
    hashed = slim.select("id", *(h.alias(c) for h, c in zip(bits, "ab", strict=True)))
    ids = hashed.groupBy("id").agg(F.count("*").alias("n"), *(f(c).alias(f"{f.__name__}_{c}") for c in "ab" for f in (F.min, F.max)))
    seen = ids.agg(F.max(F.col("n") > 1).alias("repeats"), F.max((F.col("min_a") < F.col("max_a")) | (F.col("min_b") < F.col("max_b"))).alias("differ")).first()
    tags = bits if seen["differ"] else [F.lit(0).cast("long")] * 2
    return slim.select("own", "id", *(h.alias(c) for h, c in zip(tags, "ab", strict=True)), "data"), bool(seen["repeats"])


def repeated_windows(docs: DataFrame, length: int = 100) -> DataFrame:
    """(id, a, b, pos, n): runs of ``n`` windows from ``pos`` on that start earlier
    elsewhere in the documents (id, a, b, data), each of which is there once."""
    spark = docs.sparkSession
    rows = docs.mapInArrow(lambda it: _anchor_rows(it, length), f"key long, hash long, {_PLACE}, n int")
    met = rows.repartition("key").sortWithinPartitions("key", "hash", *_DOC, "pos").mapInArrow(_meet_segments, _POSITIONS)
    met = materialise(met, "repeat-segments")
    _free(spark)
    spots = met.where("kind = 1").groupBy(*_DOC).agg(F.collect_list(F.struct("key", "pos", "n")).alias("spots"))
    pieces = map_batches(docs.join(spots.hint("merge"), _DOC).select(*_DOC, "data", "spots"), lambda b: _piece_rows(b, length), f"core long, {_STRINGS}")
    near = pieces.repartition("core").sortWithinPartitions("core", "hash", *_DOC, "pos").mapInArrow(lambda it: _meet_pieces(it, length), _NEAR)
    near = materialise(near, "repeat-pieces")
    windows = near.where("kind = 2").select(*_WINDOW).repartition("hash", "low").sortWithinPartitions("hash", "low", *_DOC, "pos")
    wide = windows.mapInArrow(lambda it: _meet_windows(it, length), _POSITIONS)
    place = [*_DOC, "pos", "n"]
    return met.where("kind = 0").select(*place).union(near.where("kind = 0").select(*place)).union(wide.select(*place))


def dedup_substrings(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans array<struct<start, stop>>, kept binary) of every document.

    Every byte covered by a ``length``-byte string that also starts earlier
    (smaller id, or same document and earlier start) is cut out; ``spans`` are
    the maximal runs cut. Strings are judged on the input. Null text is empty.
    Repeated rows are one document and get the same result; rows of equal id and
    different text count as documents ordered by a hash of the text; a null id
    comes after all others. ``id_col`` must be integral.
    """
    if length < ANCHOR + 1 or length < STEP + ANCHOR:
        raise ValueError(f"length must be at least {ANCHOR + STEP}")
    rows, repeats = _documents(docs, id_col, text_col)
    once = rows.select(*_DOC, "data")
    if repeats:  # copies are merged in each task before they move
        once = materialise(once.groupBy(*_DOC).agg(F.any_value("data").alias("data")), "repeat-documents")
    found = repeated_windows(once, length)
    _free(docs.sparkSession)
    runs = found.groupBy(*_DOC).agg(F.collect_list(F.struct("pos", "n")).alias("runs"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, spans, kept = [], [], []
        for data, cuts in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            data = data.as_py()
            merged = []
            for a, n in sorted((c["pos"], c["n"]) for c in cuts or ()):
                b = a + n - 1 + length
                if merged and a <= merged[-1]["stop"]:
                    merged[-1]["stop"] = max(merged[-1]["stop"], b)
                else:
                    merged.append({"start": a, "stop": b})
            edges = [0, *(x for s in merged for x in (s["start"], s["stop"])), len(data)]
            sizes.append(len(data))
            spans.append(merged)
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "spans", "kept"])

    joined = rows.join(runs.hint("merge"), _DOC, "left").select("own", "data", "runs")
    return map_batches(joined, run, f"`{id_col}` long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
