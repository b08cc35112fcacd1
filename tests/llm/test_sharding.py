import random
import zlib
from collections import defaultdict

import pytest

from privlink.llm import queries, sharding
from privlink.llm.common import materialise

from .conftest import ODD, SF


def best_capacity(sizes, shards):
    """Smallest capacity by trying every one from below."""
    low, high = max(sizes, default=0), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, 0
        room = mid
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def check(rows, got, shards):
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((str(i), size(t), zlib.crc32((t or "").encode())) for i, t in rows) == sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got)
    slots, by_text, total = defaultdict(list), defaultdict(set), defaultdict(int)
    for r in got:
        slots[r.shard].append(r.slot)
        by_text[r.text_crc32].add(r.shard)
        total[r.shard] += r["size"]
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in by_text.values())
    return total


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_capacity_is_the_smallest(spark, docs_of, shards):
    rng = random.Random(shards)
    rows = [(i, "x" * rng.choice([0, 1, 5, 50, 400]) + str(i)) for i in range(120)] + [(1000 + i, "copy" * 40) for i in range(rng.choice([3, 60]))]
    frame = docs_of(rows)
    sized = materialise(sharding.sized(frame), "t")
    ends, before, most = sharding.running_sizes(sized)
    sizes = [r["s"] for r in sized.groupBy("grp").agg({"size": "sum"}).toDF("grp", "s").orderBy("grp").collect()]
    capacity, cuts = sharding.minimax_cuts(ends, before, most, shards)
    assert capacity == best_capacity(sizes, shards)
    assert cuts[-1] == sum(sizes) and len(cuts) <= shards
    total = check(rows, sharding.shard_by_bytes(frame, shards).collect(), shards)
    assert max(total.values()) <= capacity


def test_hot_copies_share_a_shard(spark, docs_of):
    rows = [(i, "hot") for i in range(50)] + [(100 + i, f"text {i}") for i in range(50)]
    check(rows, sharding.shard_by_bytes(docs_of(rows), 4).collect(), 4)


def test_odd_rows_and_empty_table(spark, docs_of):
    check(ODD, sharding.shard_by_bytes(docs_of(ODD), 3).collect(), 3)
    assert sharding.shard_by_bytes(docs_of([]), 16).collect() == []


def test_query(spark, documents):
    got = queries.QUERIES["op5_sharding"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    total = check(rows, got, 16)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    assert max(total.values()) <= sum(total.values()) / 16 + max(r["size"] for r in got) * 3


def test_main_path_is_native(spark, documents):
    plan = sharding.shard_by_bytes(documents, 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_hot_text_without_ids(spark, docs_of):
    """Copies of one text without an id: slots without gaps, dealt over ranges."""
    rows = [(None, "hot")] * 400 + [(i, f"text {i % 90}") for i in range(200)]
    got = sharding.shard_by_bytes(docs_of(rows).repartition(5), 4).collect()
    check(rows, got, 4)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, r.text_crc32, r.doc_id))
    # equal texts are neighbours, in order of id
    for x in slots.values():
        texts = [t for _, t, _ in sorted(x)]
        assert sum(a != b for a, b in zip(texts, texts[1:])) == len(set(texts)) - 1


def test_query_equals_sql(spark, documents):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(map(tuple, queries.QUERIES["op5_sharding"](spark, SF).collect())) == sorted(con.sql(queries.ORACLE["op5_sharding"]).fetchall())
