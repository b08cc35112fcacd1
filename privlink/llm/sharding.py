"""Shards of nearly equal bytes: a minimax contiguous partition.

Documents with equal texts form an atomic group. Groups are ordered by the hash
of their text; the largest shard of a contiguous partition into ``shards`` parts
is made as small as it can be: a search over the capacity, each capacity checked
greedily (fill a shard as far as it goes, then cut), then the cuts of the
smallest feasible one.

The sizes stay distributed. Their running sums are written once, in order; the
driver holds the totals of BUCKETS hash ranges. A greedy step asks for the last
group that ends within a bound: the driver knows the bound's hash range, and
Spark looks it up there, for FAN capacities at once.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise

BUCKETS, FAN = 1024, 24


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, grp, bucket): UTF-8 bytes plus 1, CRC-32, hash of the text and its range.

    A null text counts as the empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.substring(F.sha2(text, 256), 1, 32).alias("grp"))
    return hashed.withColumn("bucket", F.shiftright(F.conv(F.substring("grp", 1, 4), 16, 10).cast("int"), 6))


def running_sizes(rows: DataFrame) -> tuple[DataFrame, list[int], int]:
    """(grp, bucket, end): running sums over the groups in order; the sum before
    each bucket (BUCKETS + 1 numbers); the largest group."""
    groups = materialise(rows.groupBy("bucket", "grp").agg(F.sum("size").alias("bytes")), "shard-groups")
    found = groups.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")).collect()  # at most BUCKETS rows
    of = {r["bucket"]: r["bytes"] for r in found}
    before = [0]
    for b in range(BUCKETS):
        before.append(before[-1] + of.get(b, 0))
    base = F.element_at(F.lit(before), F.col("bucket") + 1).cast("long")
    within = F.sum("bytes").over(Window.partitionBy("bucket").orderBy("grp"))
    ends = groups.repartitionByRange("bucket").select("grp", "bucket", (base + within).alias("end")).sortWithinPartitions("bucket", "grp")
    return materialise(ends, "shard-ends"), before, max((r["most"] for r in found), default=0)


def _last_within(ends: DataFrame, before: list[int], bounds: list[int]) -> list[tuple[int, str | None]]:
    """For each bound, the end of the last group that ends at or below it, and
    that group (None: the last one of the bucket before, or nothing)."""
    bucket = [min(bisect_right(before, b) - 1, BUCKETS - 1) for b in bounds]
    values = ", ".join(f"({k}, {b}, {bound}L)" for k, (b, bound) in enumerate(zip(bucket, bounds, strict=True)))
    asked = ends.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(k, bucket, bound)")  # at most FAN rows
    near = ends.where(F.col("bucket").isin(*sorted(set(bucket))))
    hits = near.join(F.broadcast(asked), "bucket").where("end <= bound").groupBy("k").agg(F.max("end").alias("end"), F.max("grp").alias("grp")).collect()
    got = {r["k"]: (r["end"], r["grp"]) for r in hits}
    return [got.get(k, (before[b], None)) for k, b in enumerate(bucket)]


def minimax_cuts(ends: DataFrame, before: list[int], most: int, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and where its shards end (sums, at most ``shards``)."""
    total = before[-1]

    def greedy(capacities: list[int]) -> list[list[int]]:
        cuts: list[list[int]] = [[0] for _ in capacities]
        for _ in range(shards):
            open_ = [k for k in range(len(cuts)) if cuts[k][-1] < total]
            if not open_:
                break
            bounds = [cuts[k][-1] + capacities[k] for k in open_]
            done = {k: total for k, b in zip(open_, bounds, strict=True) if b >= total}
            ask = [(k, b) for k, b in zip(open_, bounds, strict=True) if b < total]
            if ask:
                done |= {k: end for (k, _), (end, _) in zip(ask, _last_within(ends, before, [b for _, b in ask]), strict=True)}
            for k, end in done.items():
                cuts[k].append(end)
        return cuts

    low = max(most, -(-total // shards))  # no smaller capacity can do
    high = max(most, -(-total // shards) + most)  # a greedy shard lacks less than a group
    best = None
    while low <= high:
        step = max(1, -(-(high - low) // FAN))
        tried = sorted({*range(low, high + 1, step), high})
        found = greedy(tried)
        first = next((i for i, c in enumerate(found) if c[-1] >= total), None)
        if first is None:  # the range below the best one so far has none
            break
        best = (tried[first], found[first][1:])
        low, high = (tried[first - 1] + 1 if first else tried[first]), tried[first] - 1
    return best or (0, [])


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): all documents in shards of nearly equal bytes.

    Equal texts share a shard. ``slot`` numbers a shard's documents from 0
    without gaps, in order of text hash and id (null first). Null text is empty; repeated
    rows take slots of their own; an empty table gives no rows.
    """
    rows = materialise(sized(docs, id_col, text_col), "shard-rows")
    ends, before, most = running_sizes(rows)
    _, cuts = minimax_cuts(ends, before, most, shards)
    # a cut in terms of text hashes: the last group of each shard
    inner = cuts[:-1]
    last = [r["grp"] for r in ends.where(F.col("end").isin(*inner)).select("grp").collect()] if inner else []  # at most shards - 1
    shard: Column = F.lit(0)
    for grp in last:
        shard = shard + (F.col("grp") > grp).cast("int")
    # slots: the rows are dealt in order, by ranges that cut a text with many documents too, and numbered
    # by their place in their range
    order = ["shard", "grp", "id", "row"]
    placed = rows.withColumn("shard", shard).withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(placed.drop("row").withColumn("at", F.monotonically_increasing_id()), "shard-order").withColumn("range", F.shiftright("at", 33))
    counts = placed.groupBy("range", "shard").agg(F.min("at").alias("first"), F.count("*").alias("n"))  # at most ranges + shards rows
    ahead = counts.select("range", "shard", "first", (F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n")).alias("ahead"))
    return placed.join(ahead, ["range", "shard"]).select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("at") - F.col("first") + F.col("ahead")).alias("slot"))
