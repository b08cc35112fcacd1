"""Byte-level BPE encoding by backtracking, and decoding by an offset table.

Encoding. A text is cut at added tokens and by the tokenizer's word pattern;
each piece is then encoded without running its merges one by one:

- an Aho-Corasick automaton over the reversed tokens gives the longest token
  that starts at each byte;
- tokens are placed left to right, the longest first. A token may follow
  another only if the pair is *compatible*: merging the bytes of both tokens
  in rank order gives exactly these two tokens again. Compatibility depends on
  the pair alone and is kept in a table;
- where no compatible token is left, the last token is taken back, its end is
  marked as a dead end, and the next shorter one is tried.

A byte position is marked dead at most once, so the work is linear in the
piece. A sequence of tokens whose neighbours are all compatible is the result
of the merges, hence the ids equal those of the merge loop.

Decoding gathers the bytes of all tokens from one blob by an offset table.
"""

from __future__ import annotations

import json
from array import array
from functools import cached_property, lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import kept, map_batches, texts_of

#: Fixed value: the word pattern of byte-level BPE vocabularies.
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Words kept with their ids by each Python worker, and the longest word kept.
CACHE_WORDS, CACHE_CHARS = 300_000, 64
#: Pairs of the compatibility table kept by each Python worker.
CACHE_PAIRS = 300_000
_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: bytes that
    print in Latin-1 stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairModel:
    """One tokenizer file (``tokenizers`` JSON, byte-level BPE): an encoder and a
    decoder, each built when first used.

    Raises ValueError for a file with parts that these do not have
    (normaliser, prefix space, added tokens that strip blanks, ...).
    """

    def __init__(self, spec: bytes):
        self.spec = spec

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(json.loads(self.spec))

    @cached_property
    def decoder(self) -> Decoder:
        return Decoder(json.loads(self.spec))

    def encode(self, text: str) -> list[int]:
        """Ids of the text; strings of added tokens get the ids of these."""
        return self.encoder.encode(text)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return self.decoder.decode(ids)


def _token_bytes(conf: dict) -> dict[int, bytes]:
    alphabet = byte_alphabet()
    return {i: bytes(alphabet[c] for c in t) for t, i in conf["model"]["vocab"].items()}


def _added_tokens(conf: dict) -> dict[str, int]:
    tokens = conf.get("added_tokens") or []
    if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that look at their neighbours are not supported")
    return {t["content"]: t["id"] for t in tokens}


class Decoder:
    """All token bytes in one blob; token i at offsets[i]:offsets[i + 1]."""

    def __init__(self, conf: dict):
        every = _token_bytes(conf) | {i: t.encode() for t, i in _added_tokens(conf).items()}
        top = max(every) + 1
        self.offsets = np.zeros(top + 1, np.int64)
        self.offsets[1:] = np.cumsum([len(every.get(i, b"")) for i in range(top)])
        self.blob = np.frombuffer(b"".join(every.get(i, b"") for i in range(top)), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        starts = self.offsets[ids]
        widths = self.offsets[np.asarray(ids) + 1] - starts
        ends = np.cumsum(widths)
        at = np.arange(ends[-1]) + np.repeat(starts - (ends - widths), widths)
        return self.blob[at].tobytes().decode("utf-8", "replace")


class Encoder:
    """Words to ids by longest matches, compatibility and backtracking."""

    def __init__(self, conf: dict):
        model, pre = conf["model"], conf.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True):
            raise ValueError("only byte-level BPE tokenizers with the word pattern are supported")
        if conf.get("normalizer") or pre.get("add_prefix_space") or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("this tokenizer has parts that are not supported")
        self.bytes_of = _token_bytes(conf)
        vocab = model["vocab"]
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if max(self.rank.get(left, -1), self.rank.get(right, -1)) >= r:
                raise ValueError(f"merge {r} comes before the merges that make its parts")
            self.merge[left, right] = r
            if whole not in self.rank:
                self.rank[whole], self.parts[whole] = r, (left, right)
        self._spines: dict[tuple[int, int], list[int]] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        # a token can be placed only if the merges turn its own bytes into it
        self.usable = {i for i, b in self.bytes_of.items() if len(b) == 1}
        for i in sorted(self.rank, key=self.rank.get):
            left, right = self.parts[i]
            if left in self.usable and right in self.usable and self._compatible(left, right, self.rank[i]):
                self.usable.add(i)
        self.automaton = ahocorasick.Automaton()
        ids = {self.bytes_of[i]: i for i in self.usable}
        for b, i in ids.items():
            self.automaton.add_word(b[::-1].decode("latin-1"), i)
        self.automaton.make_automaton()
        # the longest usable token that is a proper prefix of each token
        self.shorter = {i: next((ids[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in ids), None) for b, i in ids.items()}
        self.width = {i: len(b) for b, i in ids.items()}
        self.added = _added_tokens(conf)
        self.added_pattern = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.words = regex.compile(WORD_PATTERN)
        self.cache = _WordCache(self.encode_word)

    def _spine(self, token: int, side: int) -> list[int]:
        """The tokens at one edge of ``token`` while it is built: from the byte up to itself."""
        out = self._spines.get((token, side))
        if out is None:
            out, t = [token], token
            while t in self.parts:
                t = self.parts[t][side]
                out.append(t)
            out.reverse()
            self._spines[token, side] = out
        return out

    def _compatible(self, a: int, b: int, before: int = _NEVER) -> bool:
        """No merge of rank under ``before`` joins bytes of ``a`` with bytes of ``b``.

        Follows both edges as they grow: a merge across the border happens if
        its rank comes before the next merge on either edge (an equal rank on
        the left edge goes first, since equal pairs merge from the left).
        """
        xs, ys, i, j = self._spine(a, 1), self._spine(b, 0), 0, 0
        while True:
            across = self.merge.get((xs[i], ys[j]), _NEVER)
            next_x = self.rank[xs[i + 1]] if i + 1 < len(xs) else _NEVER
            next_y = self.rank[ys[j + 1]] if j + 1 < len(ys) else _NEVER
            if across < before and across < next_x and across <= next_y:
                return False
            if next_x == _NEVER and next_y == _NEVER:
                return True
            if next_x <= next_y:
                i += 1
            else:
                j += 1

    def fits(self, a: int, b: int) -> bool:
        """The pair-compatibility table, filled as pairs are met."""
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) >= CACHE_PAIRS:
                self._fits.clear()
            known = self._fits[a, b] = self._compatible(a, b)
        return known

    def encode_word(self, word: str) -> tuple[int, ...]:
        data = word.encode()
        n = len(data)
        longest: list[int | None] = [None] * n
        for end, token in self.automaton.iter(data[::-1].decode("latin-1")):
            start = n - 1 - end
            if longest[start] is None or self.width[token] > self.width[longest[start]]:
                longest[start] = token
        open_end = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        pos, token = 0, longest[0]
        while pos < n:
            last = out[-1] if out else None
            while token is not None and not (open_end[pos + self.width[token]] and (last is None or self.fits(last, token))):
                token = self.shorter[token]
            if token is not None:
                out.append(token)
                pos += self.width[token]
                token = longest[pos] if pos < n else None
            else:
                open_end[pos] = 0
                token = out.pop()
                pos -= self.width[token]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of the text; strings of added tokens get the ids of these."""
        out: list[int] = []
        at = 0
        for m in self.added_pattern.finditer(text) if self.added_pattern else ():
            out.extend(chain.from_iterable(map(self.cache.__getitem__, self.words.findall(text[at : m.start()]))))
            out.append(self.added[m.group()])
            at = m.end()
        out.extend(chain.from_iterable(map(self.cache.__getitem__, self.words.findall(text[at:] if at else text))))
        self.cache.trim()
        return out


class _WordCache(dict):
    """Ids of words, found when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.encode(word)
        if len(word) <= CACHE_CHARS:
            self[word] = ids
        return ids

    def trim(self) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()


def encoder_of(spec: bytes) -> Encoder:
    """The encoder of a tokenizer file, built once in each Python worker."""
    return kept(("bpe-encoder", spec), lambda: Encoder(json.loads(spec)))


@lru_cache(maxsize=1)
def _small_decoder(spec: bytes) -> Decoder:
    return Decoder(json.loads(spec))


def decoder_of(spec: bytes, alone: bool) -> Decoder:
    """The decoder of a tokenizer file, a small part of what the encoder needs;
    ``alone``: the worker lets go of the encoder it may hold."""
    return kept(("bpe-decoder", spec), lambda: Decoder(json.loads(spec))) if alone else _small_decoder(spec)


def _lists(flat: np.ndarray, sizes: list[int]) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text.

    ``tokenizer`` is the path of a tokenizer file on the driver; its bytes (a
    few MB, fixed by the vocabulary) go to the executors as a broadcast. A null
    text is encoded as the empty text: no ids. Repeated rows give repeated
    rows; other columns of ``docs`` are not read.
    """
    with open(tokenizer, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, flat, sizes = encoder_of(spec.value), array("i"), []
        for text in texts_of(batch.column(1)):
            before = len(flat)
            flat.extend(model.encode(text))
            sizes.append(len(flat) - before)
        return pa.RecordBatch.from_arrays([batch.column(0), _lists(np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32), sizes)], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>")


def bpe_decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", alone: bool = False) -> DataFrame:
    """(id, ids, decoded string): the texts of ids that :func:`bpe_encode` made.

    Special tokens are written out; bytes that are no UTF-8 become U+FFFD; null
    ids give the empty text. ``alone`` says that ``encoded`` is a written table, so
    no task encodes beside this.
    """
    with open(tokenizer, "rb") as f:
        spec = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, lists = decoder_of(spec.value, alone), batch.column(1)
        flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        texts = [model.decode(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=[id_col, "ids", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_batches(encoded.select(id_col, "ids"), run, f"`{id_col}` {kind}, ids array<int>, decoded string")
