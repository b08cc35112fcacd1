"""Language identification by cross-parsing entropy.

The model holds, per language, the suffix automaton of a bounded sample of
labelled text. A text is cross-parsed against each: phrase after phrase, the
longest string that occurs in that language's sample. Few, long phrases mean a
low cross entropy, estimated as ``phrases * log2(sample length) / text length``;
the language with the smallest value wins. The sample length is that of the
longest sample for all languages: a phrase, or a symbol that a sample lacks,
costs the same everywhere, so a short sample is never the cheaper one.

All texts and languages of an Arrow batch are parsed in step: one transition
of many automata positions per numpy operation. To bound the steps, a long text is
parsed in blocks of BLOCK symbols at once. A block is first parsed as if a phrase began
with it. A parse that comes from the block before runs into that one soon (two
phrases that end at one place go on alike), so each block is parsed again from the state
that the block before ended in, until it does; the phrases counted are those of
one parse of the whole text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import kept, map_batches, materialise, texts_of

#: Bounds of the labelled sample: texts a language, characters a text and a language, languages.
SAMPLE_ROWS, ROW_CHARS, SAMPLE_CHARS, MOST_LANGUAGES = 64, 4_000, 20_000, 32
#: Symbols that are parsed in one go, and characters of texts that are parsed in step (or one text).
BLOCK, STEP_CHARS = 2_048, 1 << 19
#: Symbols: end of text, any run of other characters, a letter that no sample has.
_END, _GAP, _NEW = 0, 1, 2


def labelled_sample(
    train: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS, row_chars: int = ROW_CHARS, most: int = MOST_LANGUAGES
) -> dict[str, list[str]]:
    """At most ``rows`` distinct texts of at most ``row_chars`` characters for each of
    the ``most`` labels with the most distinct texts (ties: first in order).

    The texts are those of the smallest hash. Texts are told apart and drawn by
    (label, hash), narrow rows; only the drawn ones, at most ``rows * most``, are then read.
    Repeated rows and texts count once. Null text or label is left out.
    """
    text = F.col(text_col)
    known = train.where(text.isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text).alias("h"), F.substring(text, 1, row_chars).alias("text"))
    texts = materialise(known.select("lang", "h").distinct(), "language-texts")
    langs = texts.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).select("lang")
    first = texts.join(F.broadcast(langs), "lang").withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= rows)
    drawn = known.join(F.broadcast(first.select("lang", "h")), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    sample: dict[str, list[tuple]] = {}
    for row in drawn.collect():  # at most rows * most texts of row_chars characters
        sample.setdefault(row["lang"], []).append((row["h"], row["text"]))
    return {lang: list(dict.fromkeys(t for _, t in sorted(found))) for lang, found in sorted(sample.items())}


def _automaton(data: list[int], width: int) -> np.ndarray:
    """Transitions of the suffix automaton of ``data``: a row for each state (row
    0 is no state, row 1 the start), a column for each symbol, 0 if there is none."""
    step: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in data:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    out = np.zeros((len(step), width), np.int32)
    for s, moves in enumerate(step):
        for c, t in moves.items():
            out[s, c] = t
    return out


class CrossParser:
    """Suffix automata of a labelled sample; ``scores`` cross-parses texts."""

    def __init__(self, sample: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS):
        letters = sorted({c for texts in sample.values() for t in texts for c in t.lower() if c.isalpha()})
        self.symbol = np.full(0x110000, _GAP, np.uint16)
        for i in range(0x110000):
            if chr(i).isalpha():
                self.symbol[i] = _NEW
        index = {c: 3 + i for i, c in enumerate(letters)}
        for c, s in index.items():
            self.symbol[ord(c)] = s
        for i in np.flatnonzero(self.symbol == _NEW).tolist():
            self.symbol[i] = index.get(chr(i).lower(), _NEW)
        width = 3 + len(letters)
        self.langs, tables, longest = [], [], 0
        for lang, texts in sample.items():
            data = self.symbols(texts)[0]
            data = data[(data != _END)][:sample_chars]
            if not (data > _GAP).any():
                continue
            # own numbers for symbols the sample lacks stay without transitions
            tables.append(_automaton(data.tolist(), width))
            self.langs.append(lang)
            longest = max(longest, len(data))
        self.norm = np.log2(longest + 1)
        # one table for all: an entry is the next row's offset, doubled, plus 1 if a new phrase begins
        rows = sum(map(len, tables))
        self.start = np.zeros(len(tables), np.int64)
        self.table = np.empty(rows * width, np.int32 if rows * width * 2 < 2**31 else np.int64)
        base = 0
        for k, t in enumerate(tables):
            # row 0 (no state) is where an unknown symbol leads; its next symbol begins a phrase
            own = self.table[base * width : (base + len(t)) * width].reshape(t.shape)
            miss = t == 0
            np.copyto(own, np.where(miss, t[1][None, :], t))
            own += base
            own *= 2 * width
            own += miss
            self.start[k] = base * width  # row 0: the first symbol begins the first phrase
            base += len(t)
            tables[k] = None

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' symbols one after the other (runs of other characters as
        one, none at the ends), and how many each text has."""
        data = self.symbol[np.frombuffer("\x00".join([*texts, ""]).encode("utf-32-le"), np.uint32)]
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        gap = data == _GAP
        keep = ~gap
        keep[:-1] |= gap[:-1] & ~gap[1:]  # the last of a run ...
        keep[ends] = False
        first = np.concatenate([[0], ends[:-1] + 1])
        count = np.concatenate([[0], np.cumsum(keep)])
        sizes = count[ends] - count[first]
        data = data[keep]
        # ... unless it is the text's first symbol
        starts = np.cumsum(sizes) - sizes
        lead = starts[(sizes > 0)]
        lead = lead[data[lead] == _GAP]
        drop = np.ones(len(data), bool)
        drop[lead] = False
        owner = np.searchsorted(starts + sizes, lead, side="right")
        sizes[owner] -= 1
        return data[drop], sizes

    def _parse(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases, last states) of blocks, each as if a phrase began with it: a row for
        each language, a column for each block. The blocks come longest first."""
        active = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        state = np.repeat(self.start[:, None], len(start), axis=1)
        found = np.zeros((len(self.langs), len(start)), np.int64)
        for t, n in enumerate(active.tolist()):
            entry = self.table[state[:, :n] + data[start[:n] + t]]
            found[:, :n] += entry & 1
            state[:, :n] = entry >> 1
        return found, state

    def _meet(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, carried: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases more, last states) of parses that enter blocks in the state ``carried``,
        against those that begin a phrase there; -1 for the state of parses that ran into these."""
        more, last = np.zeros(len(start), np.int64), np.full(len(start), -1, np.int64)
        row, fresh, other = np.arange(len(start)), self.start[lang], carried
        t = 0
        while len(row):
            symbol = data[start[row] + t]
            a, b = self.table[fresh + symbol], self.table[other + symbol]
            more[row] += (b & 1).astype(np.int64) - (a & 1)
            fresh, other, t = a >> 1, b >> 1, t + 1
            done = size[row] == t
            last[row[done]] = other[done]
            stay = ~done & (fresh != other)
            last[row[done & (fresh == other)]] = -1
            row, fresh, other = row[stay], fresh[stay], other[stay]
        return more, last

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text (row) against each language (column), and the texts' symbols."""
        data, sizes = self.symbols(texts)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        first = np.cumsum(blocks) - blocks
        inner = np.arange(len(owner)) - first[owner]
        start = (np.cumsum(sizes) - sizes)[owner] + inner * BLOCK
        size = np.minimum(BLOCK, sizes[owner] - inner * BLOCK)
        order = np.argsort(-size, kind="stable")
        found, state = np.empty((len(self.langs), len(order)), np.int64), np.empty((len(self.langs), len(order)), np.int64)
        found[:, order], state[:, order] = self._parse(data, start[order], size[order])
        # blocks that go on a text: again from the state that the block before ended in
        lang, block = (x.ravel() for x in np.meshgrid(np.arange(len(self.langs)), np.flatnonzero(inner > 0), indexing="ij"))
        fresh, extra = state.copy(), np.zeros(found.shape, np.int64)
        while len(block):
            more, last = self._meet(data, start[block], size[block], state[lang, block - 1], lang)
            extra[lang, block] = more
            # a parse that met the fresh one nowhere in its block ends in a state of its own: the next block is done again
            last = np.where(last < 0, fresh[lang, block], last)
            other = np.flatnonzero(last != state[lang, block])
            state[lang[other], block[other]] = last[other]
            lang, block = lang[other], block[other] + 1
            goes_on = np.append(inner, 0)[block] > 0
            lang, block = lang[goes_on], block[goes_on]
        found += extra
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        np.add.at(out, owner, found.T)
        return out, sizes

    def predict(self, texts: list[str], no_letter: str | None = "und") -> tuple[list[str | None], np.ndarray]:
        """Language and score (0 to 1) of each text; ``und`` and 0 if nothing was
        learned, ``no_letter`` and 0 if it has no letter. Ties go to the language first in order.
        The score is the winner's lead: 1 - its value / the second's."""
        langs, scores, at = [], [np.zeros(0)], 0
        while at < len(texts):
            first, size = at, 0
            while at < len(texts) and (at == first or size + len(texts[at]) <= STEP_CHARS):
                size += len(texts[at])
                at += 1
            some = self._predict(texts[first:at], no_letter)
            langs += some[0]
            scores.append(some[1])
        return langs, np.concatenate(scores)

    def _predict(self, texts: list[str], no_letter: str | None) -> tuple[list[str | None], np.ndarray]:
        if not self.langs:
            return ["und" if s else no_letter for s in self.symbols(texts)[1].tolist()], np.zeros(len(texts))
        found, sizes = self.phrases(texts)
        value = found * self.norm
        best = value.argmin(axis=1)
        low = value[np.arange(len(texts)), best]
        second = np.partition(value, 1, axis=1)[:, 1] if len(self.langs) > 1 else sizes * self.norm
        score = np.where(second > 0, 1 - low / np.maximum(second, 1e-9), 0.0).clip(0, 1)
        none = sizes == 0
        return [no_letter if n else self.langs[b] for n, b in zip(none.tolist(), best.tolist(), strict=True)], np.where(none, 0.0, score)


def parser_of(sample: dict[str, list[str]], sample_chars: int = SAMPLE_CHARS) -> CrossParser:
    """The parser of a sample, built once in each Python worker."""
    key = hashlib.sha256(repr((sorted(sample.items()), sample_chars)).encode()).hexdigest()
    return kept(("langid", key), lambda: CrossParser(sample, sample_chars))


def predict_language(docs: DataFrame, sample: dict[str, list[str]], text_col: str = "text", no_letter: str | None = "und") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score`` (see :meth:`CrossParser.predict`).

    A column of ``docs`` with one of these names is replaced. Null, empty and
    letterless texts get ``no_letter`` and 0; with None they can be told from those of
    a language that is itself labelled ``und``. The sample is at most
    SAMPLE_CHARS characters per language and goes out as a broadcast; the
    automata take about 7 MB of a worker per language.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(sample)
    at = kept.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = parser_of(sent.value).predict(texts_of(batch.column(at)), no_letter)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return map_batches(docs.select(*kept), run, f"{schema}, lang_pred string, score double")
