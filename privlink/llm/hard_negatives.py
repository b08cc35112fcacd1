"""Hard-negative mining with anchor-clustered shared lists.

Anchors are a stated set of query rows. They are dealt into blocks of about
BLOCK, and the anchors of a block are clustered by direction. For a cluster with
centre c whose members lie within the angle w of c, no member's inner product
with a row r can exceed |member| * |r| * cos(max(0, angle(r, c) - w)). So the rows
of a list are sorted once for each cluster, by |r| * cos(...), and every member of the
cluster walks that one list from the top. It stops for good when the bound of
the next row, times its own length, is below what it already holds; bounds are
rounded up, and a bound equal to the worst result held goes on, so what is left
unread is certain not to matter.

Two walks find the results. The first takes an anchor's best rows of its own
label, the positives. Each positive sets a range of scores for its negatives,
and the second walk takes the best rows of other labels within each range.

In Spark, a cell is one block of anchors and about CELL_ROWS rows, both dealt by
number, so no label, vector or id can make a cell large. Cells are sorted with
the block in front and stream through a task, which holds a block and LIST_ROWS rows.
Each cell gives at most the wanted number of rows for each anchor; a window takes the best
of all cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise
from .vectors import kept_vectors, matrix

SCALE, LIMIT = 256, 1 << 24
#: Anchors of a block, rows of a cell, rows of a list, rows that members take from the list at a time.
BLOCK, CELL_ROWS, LIST_ROWS, STEP = 1_024, 2_048, 2_048, 512
#: Anchors of a cluster on average, and rounds of clustering.
MEMBERS, CLUSTER_ROUNDS = 32, 4
#: Ids sort with null last.
_NO_ID = (1 << 63) - 1


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = x.astype(np.float64)
    size = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(size > 0, size, 1)[:, None], size


def clusters_of(vectors: np.ndarray) -> np.ndarray:
    """Cluster number of each vector: spherical k-means from evenly spread vectors, ties to the lower number."""
    unit, _ = _unit(vectors)
    k = max(1, -(-len(unit) // MEMBERS))
    centre = unit[np.linspace(0, len(unit) - 1, k).astype(np.int64)]
    for _ in range(CLUSTER_ROUNDS):
        own = (unit @ centre.T).argmax(axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, unit)
        centre = np.where(np.einsum("ij,ij->i", sums, sums)[:, None] > 0, _unit(sums)[0], centre)
    return (unit @ centre.T).argmax(axis=1)


class SharedLists:
    """A block of anchors in clusters; ``walk`` takes a list of rows past them."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        own = clusters_of(vectors)
        self.members = [np.flatnonzero(own == c) for c in np.unique(own)]
        unit, self.size = _unit(vectors)
        self.centre = _unit(np.stack([unit[m].sum(axis=0) for m in self.members]))[0]
        # the widest angle between a centre and its members; an anchor of length 0 has none
        reach = [(unit[m] @ c)[self.size[m] > 0].min(initial=1.0) for m, c in zip(self.members, self.centre, strict=True)]
        self.wide = np.arccos(np.clip(np.array(reach), -1, 1))

    def bounds(self, rows: np.ndarray) -> np.ndarray:
        """For each cluster (row of the result) and row: the most that an anchor of length 1 can score, rounded up."""
        unit, size = _unit(rows)
        angle = np.arccos(np.clip(self.centre @ unit.T, -1, 1)) - self.wide[:, None]
        return (np.cos(np.clip(angle - 1e-6, 0, np.pi)) + 1e-9) * size[None, :]

    def walk(self, rows: np.ndarray, needed, take) -> int:
        """Take ``rows`` past all anchors; the pairs that were scored.

        ``needed(members)`` says for each member the least score that still matters
        to it; ``take(members, places, scores)`` gets the scores (members x places) of
        rows at ``places``.
        """
        exact = scorer(self.vectors, rows)
        scored = 0
        for members, bound in zip(self.members, self.bounds(rows), strict=True):
            order = np.argsort(-bound, kind="stable")  # the list that the cluster shares
            falling = bound[order]
            for at in range(0, len(order), STEP):
                open_ = falling[at] * self.size[members] + 1e-6 >= needed(members)
                members = members[open_]
                if not len(members):
                    break
                places = order[at : at + STEP]
                take(members, places, exact(members, places))
                scored += len(members) * len(places)
        return scored


def scorer(anchors: np.ndarray, rows: np.ndarray):
    """Exact integer inner products of some anchors (rows of the result) and some rows:
    in floating point where all sums fit its 53 bits."""
    most = int(np.abs(anchors).max(initial=0)) * int(np.abs(rows).max(initial=0)) * max(1, anchors.shape[1])
    if most < 1 << 53:
        a, b = anchors.astype(np.float64), rows.astype(np.float64)
        return lambda i, j: (a[i] @ b[j].T).astype(np.int64)
    return lambda i, j: anchors[i] @ rows[j].T


class Best:
    """The ``k`` best (score, id) of each slot: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.scores, self.ids, self.held = np.zeros((slots, k), np.int64), np.zeros((slots, k), np.int64), np.zeros(slots, np.int64)
        self.worst = np.full(slots, np.iinfo(np.int64).min)  # of a full slot

    def add(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        near = score >= self.worst[slot]
        if not near.any():
            return
        slot, score, id_ = slot[near], score[near], id_[near]
        old, place = np.nonzero(np.arange(self.k) < self.held[(touched := np.unique(slot))][:, None])
        old = touched[old]
        slot, score, id_ = np.concatenate([old, slot]), np.concatenate([self.scores[old, place], score]), np.concatenate([self.ids[old, place], id_])
        order = np.lexsort((id_, -score, slot))
        slot, score, id_ = slot[order], score[order], id_[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = place < self.k
        slot, place, score = slot[keep], place[keep], score[keep]
        self.scores[slot, place], self.ids[slot, place] = score, id_[keep]
        np.maximum.at(self.held, slot, place + 1)
        last = place == self.k - 1
        self.worst[slot[last]] = score[last]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of all that is held."""
        slot, place = np.nonzero(np.arange(self.k) < self.held[:, None])
        return slot, self.scores[slot, place], self.ids[slot, place]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(block, ids, labels, data): the anchors of a task as one row."""
    parts = [(b.column(0)[0].as_py(), b.column(1).to_numpy(), b.column(2).to_numpy(), matrix(b.column(3), width)) for b in batches if b.num_rows]
    if parts:
        ids, labels, data = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        yield pa.RecordBatch.from_arrays([pa.array([parts[0][0]], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, labels, data.astype(np.int32)))], names=["block", "ids", "labels", "data"])


class _Positives:
    """The best ``k`` rows of an anchor's own label that have another id."""

    schema = "block int, slot int, place int, score long, id long"

    def __init__(self, ids, labels, ranges: bytes | None, k: int):
        self.ids, self.labels, self.best = ids, labels, Best(len(ids), k)

    def needed(self, members):
        return self.best.worst[members].astype(np.float64)

    def take(self, members, scores, ids, labels):
        m, r = np.nonzero((self.labels[members][:, None] == labels[None, :]) & (self.ids[members][:, None] != ids[None, :]) & (scores >= self.best.worst[members][:, None]))
        self.best.add(members[m], scores[m, r], ids[r])

    def rows(self, block: int) -> pa.RecordBatch:
        slot, score, id_ = self.best.rows()
        return _result(block, slot, np.zeros(len(slot), np.int64), score, id_)


class _Negatives:
    """The best ``k`` rows of other labels in each of an anchor's ranges (slot, place, low, high)."""

    schema = _Positives.schema

    def __init__(self, ids, labels, ranges: bytes | None, k: int):
        self.ids, self.labels = ids, labels
        self.slot, self.place, self.low, self.high = np.frombuffer(ranges or b"", np.int64).reshape(-1, 4).T
        self.best = Best(len(self.slot), k)
        order = np.argsort(self.slot, kind="stable")
        self.of = order  # ranges by anchor
        self.first = np.searchsorted(self.slot[order], np.arange(len(ids) + 1))
        self.most = int(np.diff(self.first).max(initial=0))

    def _floor(self, ranges):
        return np.maximum(self.low[ranges], self.best.worst[ranges])

    def needed(self, members):
        out = np.full(len(members), np.inf)  # an anchor without a range needs nothing
        for j in range(self.most):
            has = np.flatnonzero(self.first[members] + j < self.first[members + 1])
            out[has] = np.minimum(out[has], self._floor(self.of[self.first[members[has]] + j]))
        return out

    def take(self, members, scores, ids, labels):
        other = (self.labels[members][:, None] != labels[None, :]) & (self.ids[members][:, None] != ids[None, :])
        for j in range(self.most):
            has = np.flatnonzero(self.first[members] + j < self.first[members + 1])
            ranges = self.of[self.first[members[has]] + j]
            own = scores[has]
            m, r = np.nonzero(other[has] & (own >= self._floor(ranges)[:, None]) & (own <= self.high[ranges][:, None]))
            self.best.add(ranges[m], own[m, r], ids[r])

    def rows(self, block: int) -> pa.RecordBatch:
        of, score, id_ = self.best.rows()
        return _result(block, self.slot[of], self.place[of], score, id_)


def _result(block: int, slot: np.ndarray, place: np.ndarray, score: np.ndarray, id_: np.ndarray) -> pa.RecordBatch:
    columns = [np.full(len(slot), block, np.int32), slot.astype(np.int32), place.astype(np.int32), score, id_]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "slot", "place", "score", "id"])


def _walk_cells(batches: Iterator[pa.RecordBatch], kind: type, width: int, k: int) -> Iterator[pa.RecordBatch]:
    """The results of cells, each led by its block of anchors."""
    block, lists, goal, waiting, rows = None, None, None, [], 0

    def flush() -> None:
        nonlocal waiting, rows
        if waiting and goal is not None:
            ids, labels, data = (np.concatenate([w[i] for w in waiting]) for i in range(3))
            lists.walk(data, goal.needed, lambda m, p, s: goal.take(m, s, ids[p], labels[p]))
        waiting, rows = [], 0

    for batch in batches:
        leads = np.flatnonzero(~np.asarray(batch.column(4).is_null()))
        for a, b in zip([0, *(leads + 1)], [*leads, batch.num_rows], strict=True):
            part = batch.slice(a, b - a)
            while part.num_rows:
                some = part.slice(0, max(1, LIST_ROWS - rows))
                waiting.append((some.column(1).to_numpy(), some.column(2).to_numpy(), matrix(some.column(3), width)))
                rows += some.num_rows
                part = part.slice(some.num_rows)
                if rows >= LIST_ROWS:
                    flush()
            if b < batch.num_rows:
                flush()
                if goal is not None:
                    yield goal.rows(block)
                block = batch.column(0)[b].as_py()
                ids, labels, data, ranges = (batch.column(c)[b].as_py() for c in (4, 5, 6, 7))
                ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
                lists, goal = SharedLists(np.frombuffer(data, np.int32).reshape(len(ids), width).astype(np.int64)), kind(ids, labels, ranges, k)
    flush()
    if goal is not None:
        yield goal.rows(block)


def _walked(vectors: DataFrame, rows: int, anchors: DataFrame, blocks: int, kind: type, width: int, k: int) -> DataFrame:
    """(block, slot, place, rank, score, id): the ``k`` best of every anchor and place over all cells."""
    cells = -(-rows // CELL_ROWS)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(cells)).cast("int")  # vectors are a written table
    none = F.lit(None).cast("binary")
    own = vectors.select("id", "label", "v", salt.alias("cell")).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "cell", F.coalesce("id", F.lit(_NO_ID)).alias("id"), "label", "v", *(none.alias(c) for c in ("ids", "labels", "data", "ranges"))
    )
    leads = anchors.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("label"), F.lit(None).cast("array<int>").alias("v"), "ids", "labels", "data", "ranges"
    )
    dealt = leads.union(own).repartition("block", "cell").sortWithinPartitions("block", "cell", F.col("ids").isNull())
    found = dealt.select("block", "id", "label", "v", "ids", "labels", "data", "ranges").mapInArrow(lambda it: _walk_cells(it, kind, width, k), kind.schema)
    order = Window.partitionBy("block", "slot", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).withColumn("id", F.nullif("id", F.lit(_NO_ID)))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is the inner product of its vector (components floor(scale * x),
    in size at most LIMIT; shorter vectors end in zeros) with the anchor's. An
    anchor's positives are its ``positives`` best rows of its label; for each of them the
    ``negatives`` best rows of another label are returned whose score is between
    ``low`` and ``high`` percent of the positive's. Higher scores come first, then
    smaller ids, null last.

    ``is_anchor`` is over the input's columns. Rows with a null label, a null
    vector or a null or non-finite component take no part; ``label`` (integral;
    default: ``label_col``) replaces the label before anything else. Rows with an
    anchor's own id are neither its positives nor its negatives, repeated rows count as rows of their own (a
    repeated anchor has its results repeated), and an empty table gives no rows.
    """
    spark = rows.sparkSession
    own = kept_vectors(rows.where(F.col(label_col).isNotNull()), scale, LIMIT, id_col, vector_col, label_col, F.struct((F.col(label_col) if label is None else label).cast("long").alias("of"), F.coalesce(is_anchor, F.lit(False)).alias("asks")))
    vectors = materialise(own.select("id", F.col("label.of").alias("label"), "v", F.col("label.asks").alias("asks")), "mining-vectors")
    shape = vectors.agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("asks"), F.max(F.size("v")).alias("width")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not shape["asks"]:
        return spark.createDataFrame([], schema)
    width, blocks = shape["width"], -(-shape["asks"] // BLOCK)
    asked = vectors.where("asks").select(F.coalesce("id", F.lit(_NO_ID)).alias("id"), "label", "v").repartition(blocks)
    packed = asked.select(F.spark_partition_id().alias("block"), "id", "label", "v").mapInArrow(lambda it: _blocks(it, width), "block int, ids binary, labels binary, data binary")
    packed = materialise(packed, "mining-anchors")

    first = _walked(vectors, shape["n"], packed.withColumn("ranges", F.lit(None).cast("binary")), blocks, _Positives, width, positives)
    first = materialise(first.select("block", "slot", F.col("rank").alias("place"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), "mining-positives")

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        slot, place, score = (table.column(c).to_numpy().astype(np.int64) for c in ("slot", "place", "positive_score"))
        # low <= 100 * score / positive score <= high, in whole numbers
        ranges = np.stack([slot, place, -(-low * score // 100), high * score // 100], axis=1)
        return pa.table({"of": pa.array([key[0].as_py()], pa.int32()), "ranges": pa.array([ranges.tobytes()], pa.binary())})

    ranges = first.groupBy("block").applyInArrow(pack, "of int, ranges binary")  # at most BLOCK * positives rows a group
    asking = packed.join(ranges.hint("merge"), F.col("block") == F.col("of")).drop("of")
    second = _walked(vectors, shape["n"], asking, blocks, _Negatives, width, negatives)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(ids, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block, np.int32)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)], names=["block", "slot", "anchor"])

    anchors = packed.select("block", "ids").mapInArrow(names, "block int, slot int, anchor long")
    found = second.select("block", "slot", "place", "rank", F.col("score").alias("negative_score"), F.col("id").alias("negative_id"))
    out = found.join(first, ["block", "slot", "place"]).join(anchors, ["block", "slot"])
    return out.select(F.nullif("anchor", F.lit(_NO_ID)).alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
