import hashlib
import random
import zlib

import pyarrow as pa
import pytest
import xxhash

from privlink.llm import queries, suffix_dedup
from privlink.llm.collection_bwt import shared_prefixes

from .conftest import ODD, SF


def hash_of(text):
    """Spark's 64-bit hash of a text, signed."""
    h = xxhash.xxh64_intdigest(text, 42)
    return h - (h >> 63 << 64)


def brute(rows, length=100):
    """Covered bytes by a set of all windows seen so far, in document order."""
    order = sorted({(float("inf") if i is None else i, (t or "").encode()) for i, t in rows}, key=lambda x: (x[0], hash_of(x[1])))
    seen, found = set(), {}
    for i, b in order:
        covered, end = bytearray(len(b)), 0
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            if w in seen:
                covered[max(k, end) : k + length] = b"\1" * (k + length - max(k, end))
                end = k + length
            seen.add(w)
        spans, k = [], 0
        while k < len(b):
            e = k
            while e < len(b) and covered[e] == covered[k]:
                e += 1
            if covered[k]:
                spans.append((k, e))
            k = e
        found[i, b] = (len(b), spans, bytes(x for x, c in zip(b, covered, strict=True) if not c))
    return sorted((str(i), *found[float("inf") if i is None else i, (t or "").encode()]) for i, t in rows)


def got(frame):
    return sorted((str(r.doc_id), r.n_bytes, [(s["start"], s["stop"]) for s in r.spans], bytes(r.kept)) for r in frame.collect())


def test_collection_groups_equal_prefixes():
    rng = random.Random(3)
    for _ in range(150):
        letters = rng.choice([b"a", b"ab", b"abc\x00\xff"])
        strings = [bytes(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(rng.randint(1, 12))]
        least = rng.randint(1, 6)
        of = {}
        string, offset, group = shared_prefixes(strings, least)
        assert len(string) == sum(max(0, len(s) - least + 1) for s in strings)
        for s, o, g in zip(string.tolist(), offset.tolist(), group.tolist(), strict=True):
            assert of.setdefault(g, strings[s][o : o + least]) == strings[s][o : o + least]
        assert len(set(of.values())) == len(of)


def test_long_strings_use_wide_prefixes():
    string, offset, group = shared_prefixes([b"ab" * 200, b"b" + b"ab" * 150], 290)
    of = {}
    for s, o, g in zip(string, offset, group, strict=True):
        of.setdefault(int(g), set()).add((b"ab" * 200, b"b" + b"ab" * 150)[s][o : o + 290])
    assert all(len(x) == 1 for x in of.values()) and len(of) == 2


def made_texts(n, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abc é", k=400)) for _ in range(8)]
    rows = []
    for i in range(n):
        a = rng.randint(0, 350)
        text = rng.choice(base)[a : rng.randint(a, 400)] + "".join(rng.choices("xyz", k=rng.randint(0, 30))) + rng.choice(base)[rng.randint(0, 300) :]
        kind = rng.random()
        text = "a" * rng.randint(90, 300) if kind < 0.1 else "ab" * rng.randint(40, 300) if kind < 0.2 else "" if kind < 0.25 else text
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("collection", [8192, 3])
def test_equals_brute_force(spark, docs_of, tiny_batches, monkeypatch, collection):
    monkeypatch.setattr(suffix_dedup, "COLLECTION", collection)
    rows = made_texts(120, collection)
    assert got(suffix_dedup.dedup_substrings(docs_of(rows))) == brute(rows)


def test_odd_rows_repeats_and_equal_ids(spark, docs_of):
    long = "The quick brown fox jumps over the lazy dog; " * 4
    rows = [*ODD, (50, long), (50, long), (51, "x" + long), (51, "y" + long), (None, long + "z"), (20, "before " + long)]
    assert got(suffix_dedup.dedup_substrings(docs_of(rows))) == brute(rows)


def test_very_long_text_is_hashed_in_chunks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 512)
    rng = random.Random(9)
    text = "".join(rng.choices("abcdefgh ", k=5000))
    rows = [(1, text), (2, text[700:2300] + "!" + text[100:900]), (3, text[::-1] + text[:150])]
    assert got(suffix_dedup.dedup_substrings(docs_of(rows))) == brute(rows)


def hot_line_texts(n):
    """One line of 96 bytes in ``n`` documents, with other neighbours in each; some have a neighbour in common."""
    rng = random.Random(4)
    line = "".join(rng.choices("abcdefghijklmnop ", k=96))
    return [(i, "".join(rng.choices("qrstu", k=30)) + ("#" if i % 3 else "##same") + line + ("!" if i % 2 else "!!same") + "".join(rng.choices("vwxyz", k=30))) for i in range(n)]


def test_hot_line_in_thousands_of_contexts(spark, docs_of):
    rows = hot_line_texts(3000)
    assert got(suffix_dedup.dedup_substrings(docs_of(rows))) == brute(rows)


def test_collections_of_a_hot_core_are_bounded(monkeypatch):
    sizes, whole = [], suffix_dedup.shared_prefixes
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 16)
    monkeypatch.setattr(suffix_dedup, "shared_prefixes", lambda strings, least: sizes.append(len(strings)) or whole(strings, least))
    rng = random.Random(5)
    # cores 0 and 2 are small, core 1 has 300 distinct pieces; a piece's first window is one of a few
    pieces = sorted({(core, i, 7, bytes(rng.choices(b"ab", k=2)) + b"core %d" % core * 15 + bytes([i % 256, i // 256])[: rng.randint(0, 2)]) for core, n in ((0, 5), (1, 300), (2, 5)) for i in range(n)})
    table = pa.table({"core": [p[0] for p in pieces], "hash": [hash(p[3]) for p in pieces], "id": [p[1] for p in pieces], "a": [0] * len(pieces), "b": [1] * len(pieces), "pos": [p[2] for p in pieces], "text": [p[3] for p in pieces]})
    table = table.sort_by([(c, "ascending") for c in ("core", "hash", "id", "pos")])
    out = [r for b in suffix_dedup._meet_pieces(iter(table.to_batches(max_chunksize=8)), 90) for r in b.to_pylist()]
    found = {(r["id"], r["pos"] + k) for r in out if r["kind"] == 0 for k in range(r["n"])}
    wide = pa.Table.from_pylist([r for r in out if r["kind"] == 2]).select(suffix_dedup._WINDOW).sort_by([(c, "ascending") for c in ("hash", "low", "id", "a", "b", "pos")])
    assert len(wide) > 100  # more than a collection, settled by collections of their own
    for b in suffix_dedup._meet_windows(iter(wide.to_batches(max_chunksize=7)), 90):
        found |= {(r["id"], r["pos"]) for r in b.to_pylist()}
    assert sizes and max(sizes) <= 32
    seen, want = {}, set()
    for core, i, pos, text in sorted(pieces, key=lambda p: (p[1], p[2])):
        for k in range(len(text) - 89):
            if seen.setdefault((core, text[k : k + 90]), (i, pos + k)) != (i, pos + k):
                want.add((core, i, pos + k))
    assert found == {(i, p) for _, i, p in want}


def test_one_hot_window_over_many_collections(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 4)
    rows = [{"low": 1, "hash": h, "id": i, "a": 0, "b": 0, "pos": 3, "text": b"%d" % h * 90} for h, n in ((1, 2), (2, 23), (3, 1)) for i in range(n)]
    found = [(r["id"], r["pos"]) for b in suffix_dedup._meet_windows(iter(pa.Table.from_pylist(rows).to_batches(max_chunksize=5)), 90) for r in b.to_pylist()]
    assert sorted(found) == sorted([(1, 3), *((i, 3) for i in range(1, 23))])


def test_texts_of_one_crc_under_null_ids(spark, docs_of):
    """Ids that say nothing and a short hash that is equal: texts are still told apart."""
    rng, seen = random.Random(8), {}
    while True:
        text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=300))
        other = seen.setdefault(zlib.crc32(text.encode()) >> 1, text)
        if other != text:
            break
    rows = [(1, other[:200]), (None, other), (None, text), (7, text[:50] + "!" + other[100:])]
    assert got(suffix_dedup.dedup_substrings(docs_of(rows))) == brute(rows)


def test_a_repeated_row_is_one_document(spark, docs_of, tiny_batches):
    rng = random.Random(6)
    long, other = ("".join(rng.choices("abcdefgh", k=250)) for _ in range(2))
    rows = [(5, long)] * 9 + [(6, other), (6, other), (None, long + other), (None, long + other), (6, "x" + long)]
    out = got(suffix_dedup.dedup_substrings(docs_of(rows)))
    assert out == brute(rows)
    assert all(not spans for i, _, spans, _ in out if i == "5")  # a copy of a row is no earlier text


def test_a_third_of_the_rows_without_id(spark, docs_of):
    rng = random.Random(2)
    base = ["".join(rng.choices("abcdefgh ", k=180)) for _ in range(5)]
    rows = [(None if i % 3 == 0 else i, rng.choice(base) + str(i % 40) + rng.choice(base)[rng.randint(0, 90) :]) for i in range(240)]
    assert got(suffix_dedup.dedup_substrings(docs_of(rows))) == brute(rows)


def test_empty_table_and_short_length(spark, docs_of):
    assert suffix_dedup.dedup_substrings(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.dedup_substrings(docs_of([]), 30)


def test_query(spark, documents):
    want = {int(i): (n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in brute([(r.doc_id, r.text) for r in documents.collect()])}
    rows = queries.QUERIES["op4_suffix_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
