import re
from collections import Counter

import duckdb
import numpy as np

from privlink.llm import line_dedup, queries

from .conftest import ODD, SF


def brute(rows, min_docs, min_chars=1):
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate({c: c + 32 for c in range(65, 91)})
    lines = [((t or "").split("\n")) for _, t in rows]
    n = Counter(k for x in lines for k in {key(y) for y in x})
    gone = {k for k, c in n.items() if c >= min_docs and len(k) >= min_chars}
    kept = [[y for y in x if key(y) not in gone] for x in lines]
    return sorted((str(i), "\n".join(k), len(x), len(x) - len(k)) for (i, _), x, k in zip(rows, lines, kept, strict=True))


def got(frame):
    return sorted((str(r.doc_id), r.text or "", r.n_lines, r.n_dropped) for r in frame.collect())


def test_perfect_hash_is_minimal_and_checks_members():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    counts = rng.integers(1, 200_000, len(keys))
    index = line_dedup.PerfectCounts.from_bytes(line_dedup.PerfectCounts.build(keys, counts).to_bytes())
    assert sorted(index.index(keys).tolist()) == list(range(len(keys)))
    assert (index.count(keys) == np.minimum(counts, 0xFFFF)).all()
    others = rng.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64)
    assert (index.count(others) > 0).mean() < 0.001
    bits = sum(len(x) * 64 for x in index.levels) / len(keys)
    assert bits < 8


def test_empty_index():
    none = np.zeros(0, np.uint64)
    assert line_dedup.PerfectCounts.build(none, none.astype(np.int64)).count(np.array([5], np.uint64)).tolist() == [0]


def test_against_brute_force_over_many_shards(spark, docs_of, tiny_batches):
    rows = [(i, "\n".join(f"{' ' * (i % 3)}Line {j}" for j in range(i % 7, i % 7 + 5)) + "\n\nonly " + str(i)) for i in range(40)] + ODD
    assert got(line_dedup.drop_frequent_lines(docs_of(rows), min_docs=12, keys_per_shard=4)) == brute(rows, 12)


def test_hot_line_and_repeated_rows(spark, docs_of):
    rows = [(1, "hot\nhot\nHOT ")] * 6 + [(i, f"hot\nown {i}") for i in range(2, 40)] + [(None, "hot\nx"), (None, None)]
    assert got(line_dedup.drop_frequent_lines(docs_of(rows), min_docs=6)) == brute(rows, 6)


def test_hot_lines_are_spread_by_their_count(spark, docs_of, tiny_batches, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBES_PER_CELL", 8)
    rows = [(i, f"hot\nwarm {i % 4}\nown {i}") for i in range(100)]
    base, hot = line_dedup._cells(spark.createDataFrame([(7, 100), (8, 9), (9, 8)], "hash long, n long"), 4)
    assert base == 4 and sorted((r["line"], r["copies"], r["of"]) for r in hot.collect()) == [(7, 13, 3), (8, 2, 0)]
    assert got(line_dedup.drop_frequent_lines(docs_of(rows), min_docs=25, keys_per_shard=16)) == brute(rows, 25)


def test_hot_lines_are_few(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBES_PER_CELL", 1)
    monkeypatch.setattr(line_dedup, "HOT_LINES", 10)
    _, hot = line_dedup._cells(spark.createDataFrame([(i, 1 + i % 50) for i in range(500)], "hash long, n long"), 2)
    assert hot.count() <= 10


def test_a_third_of_the_rows_without_id(spark, docs_of):
    rows = [(None if i % 3 == 0 else i % 50, f"line {i % 20}\nown {i}\nline {i % 7}") for i in range(300)]
    assert got(line_dedup.drop_frequent_lines(docs_of(rows), min_docs=16)) == brute(rows, 16)


def test_rows_without_id_cost_what_others_cost(spark):
    """Lists are by text: their number and size do not depend on ids."""
    rows = spark.range(2000).selectExpr("cast(null AS bigint) AS doc_id", "concat('common\nown ', id, '\nrare ', id % 100) AS text")
    lists = line_dedup.frequent_lines(rows, 10)
    assert lists.count() == 2000 and lists.selectExpr("max(size(drop)) AS n").first()["n"] == 2


def test_short_keys_stay(spark, docs_of):
    rows = [(i, "\nab\nabc") for i in range(5)]
    assert got(line_dedup.drop_frequent_lines(docs_of(rows), min_docs=5, min_chars=3)) == brute(rows, 5, 3)


def test_null_text_stays_null_and_columns_stay(spark, docs_of):
    frame = docs_of(ODD)
    done = line_dedup.drop_frequent_lines(frame, min_docs=2)
    assert done.columns == [*frame.columns, "n_lines", "n_dropped"]
    assert [r.text for r in done.where("doc_id = 1").collect()] == [None]


def test_empty_table(spark, docs_of):
    assert line_dedup.drop_frequent_lines(docs_of([])).collect() == []


def test_query_equals_sql(spark, documents):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.sql(queries.ORACLE["op6_line_dedup"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op6_line_dedup"](spark, SF).collect())) == want
