"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Learning takes a bounded sample of distinct labelled texts:

1. *Lexicon.* Terms are whole words and word beginnings of PREFIXES letters. Spark
   counts, per term, the distinct toxic and clean texts that have it; terms of
   enough toxic texts keep their smoothed log odds. The trees must see a term
   as they will see it in unknown texts, so sample rows are dealt into folds and
   a row's features come from the lexicon of the other folds.
2. *Features* (FEATURES): densities and strengths of lexicon hits, hits near a second-person
   word, shares of capitals and punctuation, rates of obfuscated words. All are
   shares, maxima or logarithms, so that texts of any length are comparable.
3. *Trees and calibration.* Three quarters of the rows fit the trees, the others map the trees' margin
   to the share of toxic texts (isotonic, hence a score from 0 to 1).

Scoring computes the features of every whole text in one map step; trees and
calibration are Spark ML models.
"""

from __future__ import annotations

import functools
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches, materialise, texts_of

#: Labelled rows that are learned from, folds of the lexicon, terms that the lexicon keeps.
SAMPLE_ROWS, FOLDS, LEXICON_TERMS = 20_000, 2, 4_096
#: Letters of the word beginnings; a term must be in so many toxic texts and have such log odds.
PREFIXES, MIN_TEXTS, MIN_ODDS = (4, 5, 6), 4, 1.5
#: Hits of these log odds count as fair, good and strong ones.
TIERS = (1.5, 3.0, 4.5)
#: Words on either side in which a second-person word is near.
NEAR = 5
#: Trees, their depth and their learning rate.
TREES, DEPTH, RATE = 24, 4, 0.25

#: Second-person words of the languages that the corpus may hold.
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer eure tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros vuestro".split())
#: Characters that stand for letters in obfuscated words.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})

FEATURES = (
    "fair_density", "good_density", "strong_density", "strong_hits", "strongest", "odds_density",
    "near_second_person", "second_person", "hidden_hits", "obfuscated", "masked", "drawn_out",
    "capitals", "shouted", "punctuation", "exclamations", "log_words",
)

_TOKEN = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(.)\1{2,}")
#: Signs that may stand before and after a plain word.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‚‘’…–—¿¡"
#: Words whose lookup a worker keeps.
_KEPT_WORDS = 1 << 17
#: Kinds of characters, as bits.
_LETTER, _UPPER, _SIGN = 1, 2, 4


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = _LETTER | _UPPER * c.isupper()
        elif not (c.isdigit() or c.isnumeric() or c.isspace() or i < 32 or i == 127):
            out[i] = _SIGN
    return out


def terms_of(word: str) -> list[str]:
    """The lexicon terms of a lower-case word: the word (marked) and its beginnings."""
    return [f"{word}$", *(word[:k] for k in PREFIXES if len(word) >= k)]


def text_terms(text: str) -> set[str]:
    return {t for w in set(_LETTERS.findall(text.lower())) for t in terms_of(w)}


class Features:
    """The features of texts under a lexicon (term to log odds)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self._heads = {t.removesuffix("$")[: PREFIXES[0]] for t in lexicon}
        self._words: dict[str, tuple[float, float, int]] = {}

    def odds(self, word: str) -> float:
        """The greatest log odds of a lower-case word's terms, 0 without a hit."""
        if word[: PREFIXES[0]] not in self._heads:
            return 0.0
        get = self.lexicon.get
        return max(get(t, 0.0) for t in terms_of(word))

    def _token(self, token: str) -> tuple[float, float, int]:
        """(log odds, log odds once it is read through its disguise, bits: 1 second person,
        2 obfuscated, 4 masked by signs, 8 drawn out, 16 shouted)."""
        word = token.strip(_SIGNS)
        bits = 4 * (0 < len(word) <= len(token) - 3)
        if word.isalpha():
            low = word.lower()
            bits |= (low in SECOND_PERSON) + 16 * (len(word) > 2 and word.isupper())
            odds = hidden = self.odds(low)
            if _RUN.search(low):
                bits |= 8
                hidden = max(hidden, self.odds(_RUN.sub(r"\1", low)))
            return odds, hidden, bits
        low = token.lower()
        if sum(map(str.isalpha, token)) < 2:
            return 0.0, 0.0, bits
        # letters with other characters between them
        odds = max((self.odds(w) for w in _LETTERS.findall(low)), default=0.0)
        joined = "".join(_LETTERS.findall(low.translate(LOOKALIKES)))
        hidden = max(odds, self.odds(joined), self.odds(_RUN.sub(r"\1", joined)))
        signs = sum(not c.isalnum() for c in word)
        return odds, hidden, bits | 2 | 4 * (signs >= 3)

    def of(self, text: str) -> list[float]:
        words, hits, second = self._words, [], []
        tokens = _TOKEN.findall(text)
        n = len(tokens)
        counts = [0, 0, 0, 0, 0]
        tiers, total, strongest, hidden_hits = [0, 0, 0], 0.0, 0.0, 0
        if len(words) > _KEPT_WORDS:
            words.clear()
        for i, token in enumerate(tokens):
            known = words.get(token)
            if known is None:
                known = self._token(token)
                if len(token) < 64:
                    words[token] = known
            odds, hidden, bits = known
            if hidden:
                strongest = max(strongest, hidden)
                total += hidden
                for t, least in enumerate(TIERS):
                    if hidden >= least:
                        tiers[t] += 1
                if hidden >= TIERS[1]:
                    hits.append(i)
                    hidden_hits += hidden > odds
            if bits:
                if bits & 1:
                    second.append(i)
                for b in range(5):
                    counts[b] += bits >> b & 1
        near, s = 0, 0
        for i in hits:  # both lists ascend
            while s < len(second) and second[s] < i - NEAR:
                s += 1
            near += s < len(second) and second[s] <= i + NEAR
        kinds = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=5)
        letters, capitals, signs = int(kinds[_LETTER] + kinds[_LETTER | _UPPER]), int(kinds[_LETTER | _UPPER]), int(kinds[_SIGN])
        per = 1.0 / n if n else 0.0
        return [
            tiers[0] * per, tiers[1] * per, tiers[2] * per, math.log1p(tiers[2]), strongest, total * per,
            near * per, counts[0] * per, hidden_hits * per, counts[1] * per, counts[2] * per, counts[3] * per,
            capitals / letters if letters else 0.0, counts[4] * per, signs / len(text) if text else 0.0, text.count("!") * per, math.log1p(n),
        ]


def with_features(docs: DataFrame, lexicons: dict[int, dict[str, float]], text_col: str, keep: list[str], fold_col: str | None = None) -> DataFrame:
    """``keep`` and ``features array<double>`` of every row; ``fold_col`` says which lexicon
    a row is seen with (without it, lexicon 0). The lexicons go out as a broadcast of at most
    LEXICON_TERMS terms each."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicons)
    makers: dict[int, Features] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not makers:
            makers.update({k: Features(v) for k, v in sent.value.items()})
        folds = batch.column(len(keep) + 1).to_pylist()
        rows = [makers[f].of(t) for t, f in zip(texts_of(batch.column(len(keep))), folds, strict=True)]
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
        found = pa.ListArray.from_arrays(offsets, pa.array(np.array(rows, np.float64).ravel()))
        return pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], found], names=[*keep, "features"])

    slim = docs.select(*keep, F.col(text_col).alias("own_text"), (F.col(fold_col) if fold_col else F.lit(0)).cast("int").alias("own_fold"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema[: len(keep)])
    return map_batches(slim, run, f"{schema}, features array<double>")


def mine_lexicons(sample: DataFrame, folds: int = FOLDS, most: int = LEXICON_TERMS) -> dict[int, dict[str, float]]:
    """Lexicons of (text, toxic int, fold int): key f has the terms as counted without
    fold f, key ``folds`` those of all rows. The texts are distinct."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms, toxic, fold = [], [], []
        for text, x, f in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            own = text_terms(text)
            terms += own
            toxic += [x] * len(own)
            fold += [f] * len(own)
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(toxic, pa.int32()), pa.array(fold, pa.int32())], names=["term", "toxic", "fold"])

    texts = sample.select("text", "toxic", "fold")
    totals = {(r["fold"], r["toxic"]): r["n"] for r in texts.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    counted = map_batches(texts, run, "term string, toxic int, fold int").groupBy("term").agg(
        *(F.sum(((F.col("fold") == f) & (F.col("toxic") == x)).cast("long")).alias(f"n{f}_{x}") for f in range(folds) for x in (0, 1))
    )
    counted = materialise(counted.where(sum((F.col(f"n{f}_1") for f in range(folds)), F.lit(0)) >= MIN_TEXTS), "toxicity-terms")
    out = {}
    for left_out in range(folds + 1):
        own = [f for f in range(folds) if f != left_out]
        toxic, clean = (sum((F.col(f"n{f}_{x}") for f in own), F.lit(0)) for x in (1, 0))
        n_toxic, n_clean = (sum(totals.get((f, x), 0) for f in own) for x in (1, 0))
        odds = F.log((toxic + 0.5) / (n_toxic + 1.0)) - F.log((clean + 0.5) / (n_clean + 1.0))
        best = counted.select("term", toxic.alias("n"), odds.alias("odds")).where((F.col("n") >= MIN_TEXTS) & (F.col("odds") >= MIN_ODDS))
        top = best.orderBy(F.desc(F.col("odds") * F.sqrt("n")), "term").limit(most)
        out[left_out] = {r["term"]: r["odds"] for r in top.collect()}  # at most ``most`` terms
    return out


@dataclass
class ToxicityModel:
    """A lexicon, trees over the features, and the calibration; without trees a constant score."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float

    def score(self, docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
        """``keep`` and ``score`` (0 to 1) of every row; null and empty texts are scored by their features, all 0."""
        if self.trees is None:
            return docs.select(*keep, F.lit(self.constant).alias("score"))
        rows = with_features(docs, {0: self.lexicon}, text_col, keep)
        seen = self.trees.transform(rows.withColumn("features", array_to_vector("features")))
        return self.calibration.transform(seen.withColumn("margin", _margin(seen))).select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score"))).alias("score"))


def _margin(seen: DataFrame) -> Column:
    from pyspark.ml.functions import vector_to_array

    return F.element_at(vector_to_array(seen["rawPrediction"]), 2)


def _share(rows: int, n: int) -> Column | None:
    """The greatest hash of a share of about ``rows`` of ``n`` evenly spread 64-bit hashes; None for all."""
    return None if n <= rows else F.lit(-(1 << 63) + (rows << 64) // n)


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic int, h long): about ``rows`` distinct labelled texts, those of the smallest hash.

    A label belongs to the documents of its id; of several labels of an id or a text
    the greatest counts. The labels are narrow and drawn first, ``rows`` ids at most, which go out as a
    broadcast; if ids repeat in ``docs``, the texts they lead to are drawn again by their
    hash, which is counted before any text moves.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("own_id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    known = materialise(known.withColumn("own_hash", F.xxhash64("own_id")), "toxicity-labels")
    limit = _share(rows, known.count())
    few = known if limit is None else known.where(F.col("own_hash") < limit)
    few = few.orderBy("own_hash", "own_id").limit(rows).select("own_id", "toxic")
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("own_id"), text.alias("text")).join(F.broadcast(few), "own_id").select("text", "toxic", F.xxhash64("text").alias("h"))
    limit = _share(rows, own.agg(F.approx_count_distinct("h", 0.01)).first()[0])
    own = own if limit is None else own.where(F.col("h") < limit)
    return own.groupBy("h").agg(F.any_value("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic", "h")


def fit_toxicity(sample: DataFrame, folds: int = FOLDS) -> ToxicityModel:
    """The model of (text, toxic 0/1, h) rows, as ``labelled_texts`` gives them.

    A sample with one class only, or none, gives a constant score: its share of toxic rows, 0 of none.
    """
    few = sample.select("text", "toxic", F.pmod("h", F.lit(folds)).cast("int").alias("fold"), F.pmod(F.shiftright("h", 16), F.lit(4)).cast("int").alias("part"))
    sample = materialise(few, "toxicity-sample")
    n, toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    parts = {(r["part"] == 0, r["toxic"]) for r in sample.select("part", "toxic").distinct().collect()}
    if not n or not {(False, 0), (False, 1)} <= parts:
        return ToxicityModel({}, None, None, (toxic or 0) / n if n else 0.0)
    lexicons = mine_lexicons(sample, folds)
    seen = with_features(sample, {k: v for k, v in lexicons.items() if k < folds}, "text", ["toxic", "part"], "fold")
    seen = materialise(seen, "toxicity-features").withColumn("features", array_to_vector("features")).withColumn("label", F.col("toxic").cast("double"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, minInstancesPerNode=4, seed=7).fit(seen.where("part > 0").select("features", "label"))
    apart = seen.where("part = 0") if {(True, 0), (True, 1)} <= parts else seen
    margins = trees.transform(apart.select("features", "label"))
    margins = margins.select(_margin(margins).alias("margin"), "label")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(margins)
    return ToxicityModel(lexicons[folds], trees, calibration, toxic / n)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id, score, predicted int) of every row: ``predicted`` is 1 from ``threshold`` on.

    Only the text is looked at. Repeated rows are repeated, a null id stays null,
    an empty table gives no rows.
    """
    scored = model.score(docs.select(F.col(id_col).alias("own_id"), F.col(text_col).alias("own")), "own", ["own_id"])
    return scored.select(F.col("own_id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
