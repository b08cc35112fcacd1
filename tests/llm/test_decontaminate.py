import random

import pytest
from hypothesis import given, settings, strategies as st

from privlink.llm import decontaminate, queries

from .conftest import ODD, SF


def brute_distance(pattern, text):
    """Smallest edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != c))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=80), st.text("abc", max_size=120))
def test_myers_equals_the_matrix(pattern, text):
    distance, end = decontaminate.myers(pattern, text)
    assert distance == min(brute_distance(pattern, text), len(pattern))
    assert brute_distance(pattern[::-1], text[:end][::-1]) == distance or distance == len(pattern)


def edited(rng, text, n):
    for _ in range(n):
        k = rng.randrange(len(text))
        text = rng.choice([text[:k] + text[k + 1 :], text[:k] + "#" + text[k:], text[:k] + "#" + text[k + 1 :]])
    return text


def test_no_passage_within_the_budget_is_missed(spark, docs_of):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("etaoinshr", k=rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 50)))) for i in range(30)]
    docs = []
    for d in range(150):
        _, text = rng.choice(items)
        body = edited(rng, text, rng.randint(0, max(1, len(text) // 8))) if rng.random() < 0.8 else ""
        docs.append((d, " ".join([word(), body.upper() if rng.random() < 0.3 else body.replace(" ", "\n", 1), word()])))
    want = set()
    for d, t in docs:
        for i, text in items:
            if brute_distance(decontaminate.normalise(text), decontaminate.normalise(t)) <= int(0.1 * len(text)):
                want.add((d, i))
    bench = docs_of(items).selectExpr("doc_id AS item_id", "text")
    for block in (10**6, 300):  # one block or many
        rows = decontaminate.benchmark_matches(docs_of(docs), bench, block_chars=block).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == want
        text = dict(docs)
        for r in rows:
            part = decontaminate.normalise(text[r.doc_id])[r.start : r.end]
            assert decontaminate.myers(decontaminate.normalise(dict(items)[r.item_id]), part)[0] == r.distance


def test_odd_rows_match_nothing_by_themselves(spark, docs_of, tiny_batches):
    items = docs_of(ODD).selectExpr("doc_id AS item_id", "text")
    rows = decontaminate.benchmark_matches(docs_of(ODD), items).collect()
    assert all(r.distance == 0 for r in rows)
    assert {r.doc_id for r in rows if r.item_id == 7} == {7}
    assert len([r for r in rows if (r.doc_id, r.item_id) == (3, 3)]) == 2  # repeated rows
    assert not {r.doc_id for r in rows} & {1, 2, 5}


@pytest.mark.parametrize("docs, items", [([], [(1, "x")]), ([(1, "x")], []), ([(1, "x")], [(1, None), (2, " ")])])
def test_empty_tables(spark, docs_of, docs, items):
    assert decontaminate.benchmark_matches(docs_of(docs), docs_of(items).selectExpr("doc_id AS item_id", "text")).collect() == []


def test_length_preserving():
    for text in ["A\tB\nC", "İstanbul ΣΑΣ ß ﬁ", "ẞ"]:
        assert len(decontaminate.normalise(text)) == len(text)


def test_query_finds_exact_passages(spark, documents):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(d.doc_id, b.item_id) for d in documents.collect() for b in bench if decontaminate.normalise(b.text) in decontaminate.normalise(d.text)}
    rows = queries.QUERIES["op8_decontaminate"](spark, SF).collect()
    assert want and want <= {(r.doc_id, r.item_id) for r in rows}
    assert {(r.doc_id, r.item_id) for r in rows if r.distance == 0} == want


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_spans_and_occurrences(spark, docs_of):
    """The span is the closest passage, the first of equally close ones; every place with the item counts."""
    rng = random.Random(11)
    item = " ".join("".join(rng.choices("etaoinshr", k=rng.randint(3, 8))) for _ in range(12))
    fill = lambda n: " ".join("".join(rng.choices("xyzw", k=5)) for _ in range(n))
    near, docs, want = edited(rng, item, 3), [], {}
    for d, bodies in enumerate([[item], [near], [near, item], [item, near, item], [near, near]]):
        docs.append((d, " ".join([fill(4), *(x for b in bodies for x in (b, fill(6)))])))
        want[d] = (0 if item in bodies else None, len(bodies))
    rows = {r.doc_id: r for r in decontaminate.benchmark_matches(docs_of(docs), docs_of([(1, item)]).selectExpr("doc_id AS item_id", "text")).collect()}
    text = dict(docs)
    for d, (distance, places) in want.items():
        r = rows[d]
        assert r.occurrences == places and r.distance == min(brute_distance(item, text[d]), len(item))
        assert levenshtein(item, text[d][r.start : r.end]) == r.distance
        if distance == 0:
            assert r.start == text[d].index(item) and r.end == r.start + len(item)
