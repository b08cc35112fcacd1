import hashlib
from collections import Counter

import pytest
import regex
import xxhash

from privlink.llm import imatch, queries

from .conftest import ODD, SF


def h64(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def words(text):
    return {h64(w.encode()) for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w}


def signed(x):
    return x - 2**64 if x >> 63 else x


def brute_lexicon(texts):
    """The buckets of the lexicon; equal texts count once."""
    own = {t or "" for t in texts}
    n = Counter(w % imatch.BUCKETS for t in own for w in words(t))
    least = max(imatch.LOW * len(own), min(imatch.MIN_TEXTS, 0.01 * len(own)))
    return {w for w, c in n.items() if least <= c <= max(2.0, imatch.HIGH * len(own))}


def brute_fingerprint(text, lexicon):
    held, out = sorted((w for w in words(text) if w % imatch.BUCKETS in lexicon), key=signed), []
    for j, rate in enumerate(imatch.RATES):
        for s in range(imatch.SEEDS):
            bits = rate.bit_length() - 1
            at = (j * imatch.SEEDS + s) * 5 % (64 - bits)
            part = [w for w in held if w >> at & rate - 1 == s]
            sig = 42
            for w in part:
                sig = h64(w.to_bytes(8, "little"), sig)
            if not part and rate == 1 and s == 0:  # no term at all: the text itself
                part, sig = [0], h64((text or "").encode())
            out.append(f"{sig:016x}" if part else imatch.NONE)
    return " ".join(out)


def brute_likeness(a, b):
    pairs = [(x, y) for x, y in zip(a.split(), b.split(), strict=True) if x != imatch.NONE or y != imatch.NONE]
    return sum(x == y for x, y in pairs) / len(pairs)


def brute(rows):
    lexicon = brute_lexicon([t for _, t in rows])
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(h64(r[1].encode())), r[1].encode()))
    out = []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = (brute_fingerprint(t, lexicon) for t in (text, edited, after))
        out.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(brute_likeness(a, b), 9), round(brute_likeness(a, c), 9)))
    return sorted(out)


def got(rows):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows)


@pytest.mark.parametrize("per_range", [1000, 7])
def test_query_equals_brute_force(spark, documents, monkeypatch, per_range):
    monkeypatch.setattr(imatch, "RANGE_ROWS", per_range)
    rows = queries.QUERIES["op7_imatch"](spark, SF).collect()
    assert got(rows) == brute([(r.doc_id, r.text) for r in documents.collect()])
    assert sum(r.near_edited for r in rows) > 2 * sum(r.near_next for r in rows)


@pytest.mark.parametrize("per_range", [1000, 2])
def test_odd_rows(spark, docs_of, monkeypatch, per_range):
    monkeypatch.setattr(imatch, "RANGE_ROWS", per_range)
    rows = [*ODD, (8, "word " * 5000), (9, "é" * 9 + " tail"), (-4, "a b c")]
    assert got(imatch.edit_resilience(docs_of(rows)).collect()) == brute(rows)


def test_single_and_no_document(spark, docs_of):
    assert got(imatch.edit_resilience(docs_of([(1, "ab cd")])).collect()) == brute([(1, "ab cd")])
    assert imatch.edit_resilience(docs_of([])).collect() == []
    assert imatch.imatch_fingerprints(docs_of([])).collect() == []


def test_plain_fingerprints(spark, docs_of):
    rows = [*ODD, (10, "same row"), (11, "some other words here")]
    lexicon = brute_lexicon([t for _, t in rows])
    have = sorted((str(r.doc_id), r.fingerprint) for r in imatch.imatch_fingerprints(docs_of(rows)).collect())
    assert have == sorted((str(i), brute_fingerprint(t, lexicon)) for i, t in rows)


def test_every_lexicon_term_counts(spark, docs_of):
    rows = [(i, f"word{i}") for i in range(40)] + [(40, ""), (41, "...")]
    found = {r.doc_id: r.fingerprint for r in imatch.imatch_fingerprints(docs_of(rows)).collect()}
    assert len({found[i] for i in range(40)}) == 40
    assert found[40] != found[41] and all(f.split().count(imatch.NONE) == 49 for f in (found[40], found[41]))
    near = {r.doc_id: r.near_next for r in imatch.edit_resilience(docs_of(rows)).collect()}
    assert all(near[i] == 0 for i in range(42))  # different texts, with and without terms


def test_texts_without_terms_are_like_their_equals_only(spark, docs_of):
    rows = [(1, "..."), (2, "!!!"), (3, "!!!"), (4, None), (5, "")]
    near = {r.doc_id: r.near_next for r in imatch.edit_resilience(docs_of(rows)).collect()}
    assert near == {5: 1.0, 4: 0.0, 3: 1.0, 2: 0.0, 1: 0.0}


def test_small_languages_have_terms_of_their_own(spark, docs_of):
    """Half a percent of the texts are in a language of its own words, all different."""
    import random

    rng = random.Random(1)
    common, rare = [f"word{i}" for i in range(300)], [f"mot{i}" for i in range(25)]
    rows = [(i, " ".join(rng.sample(rare if i % 200 == 7 else common, 12))) for i in range(2400)]
    found = {r.doc_id: r.fingerprint for r in imatch.imatch_fingerprints(docs_of(rows)).collect()}
    own = [found[i] for i, _ in rows if i % 200 == 7]
    assert len(own) == 12 == len(set(own)) and all(f.split().count(imatch.NONE) < 49 for f in own)


def test_copies_of_a_text_count_once_for_the_lexicon(spark, docs_of):
    rows = [(i, "copied text here") for i in range(60)] + [(100 + i, f"other words number {i % 30}") for i in range(60)]
    found = {r.doc_id: r.fingerprint for r in imatch.imatch_fingerprints(docs_of(rows)).collect()}
    lexicon = brute_lexicon([t for _, t in rows])
    assert found[0] == brute_fingerprint(rows[0][1], lexicon) and h64(b"copied") % imatch.BUCKETS in lexicon


@pytest.mark.parametrize("per_range", [1000, 9])
def test_a_third_without_id_and_one_hot_id(spark, docs_of, monkeypatch, per_range):
    monkeypatch.setattr(imatch, "RANGE_ROWS", per_range)
    monkeypatch.setattr(imatch, "COPIES", 4)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i % 50} of some words {i % 11}") for i in range(180)] + [(None, "one copied row")] * 30 + [(7, "")] * 5
    assert got(imatch.edit_resilience(docs_of(rows)).collect()) == brute(rows)


def test_hot_ids_and_null_ids_are_cut_by_hash(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 10)
    rows = spark.range(300).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7L, id)) AS doc_id", "concat('text ', id) AS text")
    sizes = [r["count"] for r in imatch.with_next(rows).where("NOT spare").groupBy("part").count().collect()]
    assert sum(sizes) == 300 and max(sizes) < 40


def test_documents_move_once_and_without_python(spark, documents, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_ROWS", 50)
    frame = imatch.edit_resilience(documents)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("hashpartitioning(part") == 1
