import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from privlink.llm import bpe, queries

from .conftest import ODD, SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = bpe.BytePairModel(open(PATH, "rb").read())
ENCODER = MODEL.encoder
OTHER = Tokenizer.from_file(PATH)


def expected(text):
    return OTHER.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_library_on_any_text(text):
    assert MODEL.encode(text) == expected(text)
    assert MODEL.decode(np.array(MODEL.encode(text), int)) == text


def test_ids_equal_the_library_on_hard_pieces():
    rng = random.Random(1)
    parts = ["a", "aa", "é", "<|endoftext|>", "<|endof", " ", "  ", "\n", "日本", "😀", "'s", "'", "ll", "1", "22", "_", "the", "\x00", "\x1c", "\x85", "=====", "aaaaaaaaaaa"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        assert MODEL.encode(text) == expected(text)


def test_word_pattern_agrees_on_every_kind_of_character():
    for i in [*range(0x3000), *range(0x3000, 0x110000, 211)]:
        if not 0xD800 <= i < 0xE000:
            text = f"a{chr(i)}b {chr(i)}{chr(i)} x"
            assert MODEL.encode(text) == expected(text), hex(i)


def test_a_long_piece_without_blanks_takes_linear_time():
    text = "ab" * 60_000 + "a" * 60_000
    assert MODEL.encode(text) == expected(text)


def test_merge_loop_agrees_with_backtracking():
    """The plain merge loop, on random words over a few letters."""
    rng = random.Random(2)
    for _ in range(500):
        word = "".join(rng.choices("theandig ", k=rng.randint(1, 20))).replace(" ", "")
        if not word:
            continue
        ids = [i for b in word.encode() for i, x in ENCODER.bytes_of.items() if x == bytes([b]) and i in ENCODER.usable][: len(word)]
        while True:
            ranks = [(ENCODER.merge[p], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ENCODER.merge]
            if not ranks:
                break
            _, k = min(ranks)
            ids[k : k + 2] = [next(w for w, p in ENCODER.parts.items() if p == (ids[k], ids[k + 1]))]
        assert tuple(ids) == ENCODER.encode_word(word)


def test_operator_on_odd_rows(spark, docs_of, tiny_batches):
    got = bpe.bpe_decode(bpe.bpe_encode(docs_of(ODD), PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.decoded, r.ids) for r in got) == sorted((str(i), t or "", expected(t or "")) for i, t in ODD)


def test_empty_table(spark, docs_of):
    assert bpe.bpe_decode(bpe.bpe_encode(docs_of([]), PATH), PATH).collect() == []


def test_query(spark, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op1_bpe_roundtrip"](spark, SF).collect()}
    assert len(got) == documents.count()
    for doc in documents.collect():
        ids = expected(doc.text)
        assert got[doc.doc_id].n_tokens == len(ids)
        assert got[doc.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc.doc_id].decoded_sha256 == hashlib.sha256(OTHER.decode(ids, skip_special_tokens=False).encode()).hexdigest()
