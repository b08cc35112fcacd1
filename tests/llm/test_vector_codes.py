"""Vector codes against brute force, and the slices against plain distances."""

import hashlib
import math

import numpy as np
import pytest

from privlink.llm import vector_codes as vc
from privlink.llm.queries import QUERIES
from privlink.llm.vectors import matrix

from .conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, codes string, of string"


def brute(rows, parts, entries, rounds, scale):
    """{(id, label, vector): (codes, error)} and the codebooks of (id, vector, label) rows, entry by entry."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max((len(v) for _, v, _ in kept), default=0)
    width = -(-longest // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), lab) for i, v, lab in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in first] for p in range(parts)]

    def nearest(book, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            sums = {}
            for _, v, _ in kept:
                x = v[p * width : (p + 1) * width]
                sums.setdefault(nearest(books[p], x)[0], []).append(x)
            books[p] = [[math.floor(sum(c) / len(sums[e])) if abs(sum(c)) < 2**50 else sum(c) // len(sums[e]) for c in zip(*sums[e])] if e in sums else b for e, b in enumerate(books[p])]
    out = []
    for i, v, lab in kept:
        found = [nearest(books[p], v[p * width : (p + 1) * width]) for p in range(parts)]
        out.append((i, lab, [e for e, _ in found], sum(d for _, d in found)))
    return out, books


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "id", "v", "codes", "of") for i, v, lab in rows], SCHEMA)


def coded(spark, rows, **sizes):
    codes, books = vc.compress_vectors(frame(spark, rows), **sizes)
    got = [(r["id"], r["label"], r["codes"], r["error"]) for r in codes.collect()]
    return got, books


def in_order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("k,width,spread", [(1, 3, 5), (7, 1, 40), (64, 4, 3), (65, 2, 1000), (200, 8, 50)])
def test_slices_find_the_nearest_entry(k, width, spread):
    random = np.random.default_rng(k)
    entries = random.integers(-spread, spread, (k, width))
    points = np.concatenate([random.integers(-2 * spread, 2 * spread, (300, width)), entries])
    entry, distance = vc.SliceIndex(entries).nearest(points)
    apart = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (distance == apart.min(axis=1)).all()
    assert (entry == apart.argmin(axis=1)).all()


def test_a_box_holds_the_entries_within_a_radius():
    random = np.random.default_rng(1)
    entries, points = random.integers(0, 20, (130, 3)), random.integers(0, 20, (50, 3))
    index = vc.SliceIndex(entries)
    bits = np.unpackbits(index.box(points, np.full(50, 4)).view(np.uint8), axis=1, bitorder="little")[:, :130]
    assert (bits == (np.abs(points[:, None] - entries[None]).max(axis=2) <= 4)).all()


def test_far_points_and_large_components():
    entries = np.array([[0, 0], [1 << 27, -(1 << 27)]])
    entry, distance = vc.SliceIndex(entries).nearest(np.array([[-(1 << 27), 1 << 27], [1 << 27, 1 << 27]]))
    assert entry.tolist() == [0, 0] and distance.tolist() == [2 << 54, 2 << 54]


def test_against_brute_force(spark, tiny_batches):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=8).round(2).tolist(), i % 3) for i in range(60)]
    got, books = coded(spark, rows, parts=4, entries=9, rounds=3, scale=64)
    want, want_books = brute(rows, 4, 9, 3, 64)
    assert in_order(got) == in_order(want)
    assert books.parts.tolist() == want_books


def test_odd_rows(spark, tiny_batches):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5, 0.25, 1.0], 1), (1, [0.5, -0.5, 0.25, 1.0], 1), (1, [9.0, 9.0, 9.0, 9.0], 2), (None, [0.1, 0.2, 0.3, 0.4], None), (2, None, 1), (3, [1.0, None, 1.0, 1.0], 1), (4, [1.0, nan, 1.0, 1.0], 1)]
    rows += [(5, [1.0, inf, 1.0, 1.0], 1), (6, [-inf, 1.0, 1.0, 1.0], None), (7, [], 3), (8, [0.3], 3), (9, [1.0, 2.0, 3.0, 4.0, 5.0], None), (10, [0.5, -0.5, 0.25, 1.0], None)]
    got, books = coded(spark, rows, entries=3, rounds=2)
    want, want_books = brute(rows, 4, 3, 2, 1024)
    assert in_order(got) == in_order(want)
    assert books.parts.tolist() == want_books


def test_a_hot_vector_and_a_hot_label(spark):
    rows = [(None if i % 2 else 5, [0.25, 0.25, 0.25, 0.25], 7) for i in range(300)] + [(i, [i / 100, -i / 100, 0.0, 1.0], None) for i in range(100)]
    got, _ = coded(spark, rows, entries=8, rounds=2)
    assert in_order(got) == in_order(brute(rows, 4, 8, 2, 1024)[0])


def test_empty_table_and_no_whole_vector(spark):
    for rows in ([], [(1, None, 1)]):
        codes, books = vc.compress_vectors(frame(spark, rows))
        assert books is None and codes.count() == 0 and codes.columns == ["id", "label", "codes", "error"]
    got, _ = coded(spark, [(1, [], None), (2, [], 1)])
    assert in_order(got) == in_order([(1, None, [0] * 4, 0), (2, 1, [0] * 4, 0)])


def test_bad_sizes():
    for sizes in ({"parts": 0}, {"entries": 0}, {"entries": 257}):
        with pytest.raises(ValueError):
            vc.compress_vectors(None, **sizes)


def test_label_error_joins_nulls(spark):
    codes = spark.createDataFrame([(1, 1, [0], 5), (2, None, [0], 7), (3, 1, [1], 6), (4, None, [1], 8)], "id long, label int, codes array<int>, error long")
    assert {r["id"]: r["label_error"] for r in vc.with_label_error(codes).collect()} == {1: 11, 2: 15, 3: 11, 4: 15}


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 40").collect()]
    want, books = brute(rows, 4, 256, 4, 1024)
    done, own = vc.compress_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert in_order([(r["id"], r["label"], r["codes"], r["error"]) for r in done.collect()]) == in_order(want)
    assert own.digest() == hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    whole = QUERIES["op11_vector_codes"](spark, SF)
    assert whole.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and whole.count() == 500
    assert whole.where("length(code) <> 8").count() == 0


def test_matrix_of_a_slice():
    import pyarrow as pa

    column = pa.array([[9], [1, 2], [3], []], pa.list_(pa.int32())).slice(1)
    assert matrix(column, 2).tolist() == [[1, 2], [3, 0], [0, 0]]
