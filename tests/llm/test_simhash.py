import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from privlink.llm import queries, simhash

from .conftest import ODD, SF


def brute_fingerprint(text, shingle=4):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits=4):
    """Component (smallest id) of each row by all pairs of fingerprints."""
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    root = {f: f for _, f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= bits:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    low = {}
    for i, f in fps:
        if i is not None:
            low[find(f)] = min(i, low.get(find(f), i))
    return sorted((str(i), f, str(low.get(find(f)))) for i, f in fps)


def got(frame):
    return sorted((str(r.doc_id), r.fp % 2**64, str(r.component)) for r in frame.collect())


def test_triples_cover_all_matches():
    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4))


def test_fingerprint_equals_brute_force():
    rng = random.Random(4)
    for n in [0, 1, 3, 4, 5, 17, 300, 9000]:
        text = " ".join(rng.choices(["Ab", "cd", "É", "x y", "日"], k=n))
        assert simhash.fingerprint(text, 4) == brute_fingerprint(text)


def test_odd_rows(spark, docs_of, tiny_batches):
    assert got(simhash.simhash_groups(docs_of(ODD))) == brute_components(ODD)


def test_empty_table(spark, docs_of):
    assert simhash.simhash_groups(docs_of([])).collect() == []


@pytest.mark.parametrize("block", [4096, 5])
def test_links_connect_all_close_pairs(spark, block, tiny_batches):
    """Chains and balls of fingerprints, also with lists dealt into cells."""
    rng = random.Random(5)
    fps = set()
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 30])):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << b
    fps = sorted(fps)
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    links = simhash.simhash_links(frame, 4, block=block)
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 4 for r in links.collect())
    root = {r.node: r.root for r in simhash.connected(links).collect()}
    part = {}
    for f in fps:
        s = int(np.uint64(f).view(np.int64))
        part.setdefault(root.get(s, s), set()).add(f)
    want = {f: {f} for f in fps}
    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 4 and want[a] is not want[b]:
            want[a] |= want[b]
            for x in want[b]:
                want[x] = want[a]
    assert sorted(map(sorted, part.values())) == sorted({tuple(sorted(w)) for w in want.values()} and [sorted(w) for w in {id(w): w for w in want.values()}.values()])


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {(r.node, r.root) for r in simhash.connected(links).collect()} == {(i, 0) for i in range(1, 201)}


def test_query(spark, documents):
    want = brute_components([(r.doc_id, r.text) for r in documents.collect()])
    rows = queries.QUERIES["op10_simhash_groups"](spark, SF).collect()
    assert sorted((str(r.doc_id), int(r.fingerprint, 16), str(r.component_id)) for r in rows) == want
    assert all(len(r.fingerprint) == 16 for r in rows)
