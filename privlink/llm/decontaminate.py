"""Benchmark passages in documents, by pigeonhole pieces and bit-parallel edit distance.

An item of m characters may differ from a passage by up to k = floor(rate * m)
edits. Cut into k + 1 pieces, at least one piece is in the passage unchanged.
An Aho-Corasick automaton over all pieces finds these in one pass over a
document; around each find, Myers' bit-parallel algorithm gives the smallest
edit distance of the item to any part of the text there.

The benchmark is the stated query set: it is read in blocks of at most
``block_chars`` characters, and every document is held against every block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import kept, map_batches, texts_of

#: Characters of a block: its pieces take about 100 bytes of a worker for each.
ERROR_RATE, BLOCK_CHARS = 0.1, 1_000_000


def normalise(text: str) -> str:
    """Lower-cased, each blank a space; as long as the text, so offsets hold."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    for blank in "\t\n\v\f\r ":
        low = low.replace(blank, " ")
    return low


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def _search(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, now, best, end = full, 0, m, m, 0
    of = masks.get
    for j, c in enumerate(text, 1):
        eq = of(c, 0)
        x = eq | minus
        d0 = (((x & plus) + plus) ^ plus) | x
        up, down = minus | ~(d0 | plus) & full, plus & d0
        if up & top:
            now += 1
        elif down & top:
            now -= 1
            if now < best:
                best, end = now, j
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(d0 | up) & full, up & d0
    return best, end


def myers(pattern: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of ``pattern`` to any part of ``text``, and the
    first end of such a part."""
    return _search(_masks(pattern), len(pattern), text)


class _Node:
    """A part of an item, ``start`` to ``stop``, with its own error budget."""

    __slots__ = ("item", "start", "stop", "budget", "masks")

    def __init__(self, item: str, start: int, stop: int, budget: int):
        self.item, self.start, self.stop, self.budget = item, start, stop, budget
        self.masks: dict[str, int] | None = None  # made at the first find, which most parts never see

    def near(self, text: str, begin: int) -> bool:
        """Within budget where the item, laid over the text from ``begin`` on, has this part."""
        if self.masks is None:
            self.masks = _masks(self.item[self.start : self.stop])
        part = text[max(0, begin + self.start - self.budget) : max(0, begin + self.stop + self.budget)]
        return _search(self.masks, self.stop - self.start, part)[0] <= self.budget


class Pieces:
    """Pieces of a block of items: ``matches`` finds the items in a text.

    The pieces of an item are the leaves of a binary tree. A part of p pieces
    has a budget of p - 1 edits, so if a part is within its budget, one of its
    halves is within its own. A find is therefore followed from the piece up,
    part by part, and dropped at the first part over budget; chance finds end
    after a few characters.
    """

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.budget = [], []
        self.leaves: list[tuple[int, int, list[_Node]]] = []
        where: dict[str, list[int]] = {}
        for _, text in items:
            k, n = int(rate * len(text)), len(self.items)
            cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
            parts: list[tuple[int, int, list[_Node]]] = [(0, k + 1, [])]
            while parts:
                lo, hi, above = parts.pop()
                if hi - lo == 1:
                    where.setdefault(text[cuts[lo] : cuts[hi]], []).append(len(self.leaves))
                    self.leaves.append((n, cuts[lo], above))
                    continue
                # the whole item is searched in the end anyway
                own = above if (lo, hi) == (0, k + 1) else [_Node(text, cuts[lo], cuts[hi], hi - lo - 1), *above]
                mid = (lo + hi + 1) // 2
                parts += [(lo, mid, own), (mid, hi, own)]
            self.items.append(text)
            self.budget.append(k)
        self.ids = [i for i, _ in items]
        self.whole = [(_masks(t), _masks(t[::-1])) for t in self.items]
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item, start, end, distance, occurrences) of the items within their
        error budget; the closest, first occurrence gives the span."""
        if not self.items or not text:
            return []
        begins: dict[int, set[int]] = {}
        for end, (size, at) in self.automaton.iter(text):
            for leaf in at:
                n, offset, above = self.leaves[leaf]
                begin = end + 1 - size - offset
                if all(node.near(text, begin) for node in above):
                    begins.setdefault(n, set()).add(begin)
        out = []
        for n, spots in begins.items():
            item, k, (forward, back), found = self.items[n], self.budget[n], self.whole[n], set()
            m = len(item)
            for b in sorted(spots):
                if b >= 0 and text.startswith(item, b):
                    found.add((0, b, b + m))
                    continue
                lo = max(0, b - k)
                distance, end = _search(forward, m, text[lo : max(0, b + m + k)])
                if distance <= k:
                    # the part's start: the same search backwards from its end
                    size = _search(back, m, text[max(0, lo + end - m - k) : lo + end][::-1])[1]
                    found.add((distance, lo + end - size, lo + end))
            if found:
                d, s, e = min(found)
                out.append((self.ids[n], s, e, d, len({x[2] for x in found})))
        return out


def _pieces_of(items: list[tuple[int, str]], rate: float) -> Pieces:
    """The pieces of a block, built once in each Python worker."""
    key = hashlib.sha256(repr((items, rate)).encode()).hexdigest()
    return kept(("pieces", key), lambda: Pieces(items, rate))


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of at most ``block_chars`` characters (or one item)."""
    block, chars = [], 0
    for row in benchmark.where(f"length(trim(`{text_col}`)) > 0").select(id_col, text_col).distinct().orderBy(id_col, text_col).toLocalIterator():
        text = normalise(row[1]).strip(" ")
        if not text:
            continue
        if block and chars + len(text) > block_chars:
            yield block
            block, chars = [], 0
        block.append((row[0], text))
        chars += len(text)
    if block:
        yield block


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(id, item_id, start, end, distance, occurrences): a row for each document
    and item of which the document holds a passage within the error budget.

    Offsets are code points of the text. Texts are compared lower-cased with
    every blank as a space. Null and empty texts and items match nothing;
    repeated rows give repeated rows; items with equal texts match alike.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, item_id {item_kind}, start int, end int, distance int, occurrences int"

    def against(block: list[tuple[int, str]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(block)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            pieces, rows, owner = _pieces_of(sent.value, rate), [], []
            for i, text in enumerate(texts_of(batch.column(1))):
                found = pieces.matches(normalise(text))
                rows += found
                owner += [i] * len(found)
            items, *spans = zip(*rows, strict=True) if rows else [()] * 5
            ids = batch.column(0).take(pa.array(owner, pa.int32()))
            items = pa.array(items, pa.int64()) if item_kind in ("bigint", "int") else pa.array(items)
            return pa.RecordBatch.from_arrays([ids, items, *(pa.array(x, pa.int32()) for x in spans)], names=[id_col, "item_id", "start", "end", "distance", "occurrences"])

        return map_batches(docs.select(id_col, text_col), run, schema)

    found = [against(b) for b in item_blocks(benchmark, item_col, item_text_col, block_chars)]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], schema)
