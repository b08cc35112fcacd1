"""I-Match document fingerprints over randomised lexicons.

A text's terms are its distinct words (runs of letters and digits, lower-cased).
The lexicon keeps the terms whose document frequency lies within a band, i.e. an
inverse-document-frequency band: too frequent terms say nothing, too rare ones
change with a typo. The band reaches down to a hundred-thousandth of the texts, so that
languages and sources that are a small part of a corpus have terms of their own.
Equal texts count once.

Terms are counted in BUCKETS buckets of their hash, and the lexicon is the bit of each bucket: one
value of 2 MB whatever the corpus, in which a term is looked up in constant time without moving
a text. A term shares its bucket with about (distinct terms / BUCKETS) others, whose
texts count with its own.

A subset of the lexicon is drawn by a hash of the term and keeps one term in
RATES[j]; the document's terms in it are sorted and hashed. The fingerprint is
the list of the subset hashes: an edit changes only the subsets that draw one of
the edited terms. Several rates serve short and long documents alike. One subset
(rate 1) is the whole lexicon, so that every lexicon term has a say; a text without any
lexicon term has the hash of the text itself there, so that it is like no other text.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from .common import materialise

#: Shares of the distinct texts that a lexicon term must be in: at least, at most.
LOW, HIGH = 0.00001, 0.2
#: Texts that a lexicon term must be in at least (a hundredth of the texts, if that is less).
MIN_TEXTS = 5
#: Buckets that terms are counted in.
BUCKETS = 1 << 24
#: One term in so many is in a subset; SEEDS subsets for each rate. At rate 1 the first has all terms, the others none.
RATES, SEEDS = (16, 64, 256, 1_024, 1), 10
#: The hash of a subset in which a document has no term.
NONE = "-"
#: Documents of a range that one task holds, and the most ranges (of ids, of an id's hashes).
RANGE_ROWS, MOST_RANGES = 1_000, 65_536
_VARIABLE = "imatch_lexicon"
#: Rows that one row becomes at a time where copies are written out.
COPIES = 1_024


def terms(text: Column) -> Column:
    """Distinct words of a text as 64-bit hashes; null has none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.array_remove(F.transform(words, lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))


def text_bits(text: Column) -> list[Column]:
    """128 bits of hash of a text, null as the empty text."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit("b"), text).alias("b")]


def _bucket(term: Column) -> Column:
    return term.bitwiseAND(F.lit(BUCKETS - 1).cast("long"))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """(word long, bits long): the buckets, as bits of 64 at a time, whose terms are in a share of
    ``low`` to ``high`` of the distinct texts: in MIN_TEXTS (or a hundredth of the texts) at
    least, and in two or fewer where that is all a small corpus has."""
    texts = materialise(docs.select(*text_bits(F.col(text_col)), terms(F.col(text_col)).alias("terms")).groupBy("a", "b").agg(F.any_value("terms").alias("terms")).select("terms"), "lexicon-texts")
    rows = texts.count()
    counts = texts.select(F.explode("terms").alias("term")).groupBy(_bucket(F.col("term")).alias("bucket")).agg(F.count("*").alias("n"))
    least = max(low * rows, min(MIN_TEXTS, 0.01 * rows))
    known = counts.where((F.col("n") >= least) & (F.col("n") <= max(2.0, high * rows)))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bucket").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return materialise(known.groupBy(F.shiftright("bucket", 6).alias("word")).agg(F.bit_or(bit).alias("bits")), "lexicon")


def lexicon_value(lex: DataFrame) -> Column:
    """The lexicon as one value, an array of BUCKETS / 64 words: a session variable, as the functions
    over a text's terms take no subquery. A plan keeps the value that the variable has when it is built."""
    spark = lex.sparkSession
    words = spark.range(0, BUCKETS // 64, numPartitions=1).withColumnRenamed("id", "word")
    both = words.join(lex, "word", "left").select(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("w"))
    both.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["bits"]).alias("bits")).createOrReplaceTempView(_VARIABLE)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {_VARIABLE} ARRAY<BIGINT>")
    spark.sql(f"SET VAR {_VARIABLE} = (SELECT bits FROM {_VARIABLE})")
    spark.catalog.dropTempView(_VARIABLE)
    return F.expr(_VARIABLE)


def lexicon_terms(found: Column, value: Column) -> Column:
    """The sorted ones of a text's terms that are in the lexicon, found without moving the text."""
    bit = lambda t: F.getbit(F.get(value, F.shiftright(_bucket(t), 6).cast("int")), t.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return F.sort_array(F.filter(found, lambda t: bit(t) == 1))


def signatures(held: Column, text_hash: Column) -> Column:
    """The subset hashes (16 hex digits, or NONE for a subset without terms) of
    sorted lexicon terms, with a blank between; without any term the whole
    lexicon's is the text's own hash."""
    nothing, out = F.xxhash64(F.array().cast("array<bigint>")), []
    for j, rate in enumerate(RATES):
        for s in range(SEEDS):
            if s >= rate:
                out.append(F.lit(None).cast("long"))
                continue
            bits = rate.bit_length() - 1
            at = (j * SEEDS + s) * 5 % (64 - bits)
            drawn = (lambda at, mask: lambda t: F.shiftrightunsigned(t, at).bitwiseAND(F.lit(mask).cast("long")) == s)(at, (1 << bits) - 1)
            sig = F.nullif(F.xxhash64(F.filter(held, drawn)), nothing)
            out.append(F.coalesce(sig, text_hash) if rate == 1 else sig)
    return F.array_join(F.transform(F.array(*out), lambda h: F.coalesce(F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit(NONE))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of subsets on which two fingerprints agree, of those in which either
    has terms. Equal texts agree on all; different texts without any term on none."""
    both = F.zip_with(F.split(a, " "), F.split(b, " "), lambda x, y: F.when((x == NONE) & (y == NONE), F.lit(0)).when(x == y, F.lit(1)).otherwise(F.lit(2)))
    agree = F.size(F.filter(both, lambda v: v == 1))
    some = F.size(F.filter(both, lambda v: v > 0))
    return F.when(some > 0, agree / some).otherwise(F.lit(1.0))


def imatch_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint): the I-Match fingerprint of every text.

    Null and empty texts have no terms, hence NONE for all but the whole lexicon, as
    have texts without a lexicon term. Equal texts have equal fingerprints;
    repeated rows give repeated rows; an empty table gives no rows.
    """
    known = lexicon_value(lexicon(docs, text_col))
    held = docs.select(F.col(id_col).alias("id"), lexicon_terms(terms(F.col(text_col)), known).alias("held"), text_bits(F.col(text_col))[0])
    return held.select(F.col("id").alias(id_col), signatures(F.col("held"), F.col("a")).alias("fingerprint"))


class _Ranges:
    """Ranges of rows in order of id (descending, null last), then text hash.

    The ids are cut at quantiles. An id that fills several quantiles, and the rows without an id, are
    cut further, at even places of the hash. ``part`` numbers a row's range: that of
    its id times SPAN, plus that of its hash.
    """

    SPAN = 1 << 20

    def __init__(self, ids: DataFrame):
        rows, none = ids.agg(F.count("*"), F.coalesce(F.sum(F.col("id").isNull().cast("long")), F.lit(0))).first()
        n = max(1, min(MOST_RANGES, -(-(rows - none) // RANGE_ROWS)))
        cuts = ids.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * MOST_RANGES)).first()[0] if n > 1 else None
        self.cuts, self.none, self.kind = Counter(cuts or ()), max(1, min(MOST_RANGES, -(-none // RANGE_ROWS))), ids.schema["id"].dataType

    def part(self, id_: Column, hash_: Column) -> Column:
        share = hash_.cast("double") / float(1 << 64) + 0.5
        within = lambda n: F.least(F.floor(share * n), n - F.lit(1)).cast("long")
        range_of, hashed = F.lit(0).cast("long"), F.lit(0).cast("long")
        if self.cuts:
            # the last cut at or below the id, found by halving; one folded array literal, however many cuts there are
            cuts = sorted(self.cuts)
            held = F.split(F.lit(" ".join(map(str, cuts))), " ").cast(ArrayType(self.kind))
            steps = F.lit([1 << k for k in reversed(range(len(cuts).bit_length()))])

            def halve(at: Column, step: Column) -> Column:
                there = at + step
                return F.when((there <= len(cuts)) & (F.element_at(held, F.least(there, F.lit(len(cuts)))) <= id_), there).otherwise(at)

            at = F.aggregate(steps, F.lit(0), halve)
            range_of = at.cast("long")
            if max(self.cuts.values()) > 1:
                times = F.split(F.lit(" ".join(str(self.cuts[c]) for c in cuts)), " ").cast("array<long>")
                here = F.greatest(at, F.lit(1))
                full = (at > 0) & (F.element_at(held, here) == id_) & (F.element_at(times, here) > 1)
                hashed = F.when(full, 1 + within(F.element_at(times, here))).otherwise(hashed)
        return F.when(id_.isNull(), within(F.lit(self.none)) - self.SPAN).otherwise(range_of * self.SPAN + hashed)

    def order(self, part: int) -> tuple[int, int]:
        """Sorts the numbers of ranges in the order of their rows."""
        return -(part // self.SPAN), part % self.SPAN


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, row, spare, id, a, text, next_text, times): every document with the text of the
    next one in descending id (equal ids: by a hash of the text; null ids last; after the last
    comes the first), partitioned by ``part``.

    Each range is sorted by one task. The first document of a range is
    also sent, as a ``spare`` row, to the end of the range before it. ``times`` is how often the row
    occurs: of rows of equal id and text, all but the last are followed by their equal.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    slim = docs.select(F.col(id_col).alias("id"), *text_bits(F.col(text_col)), F.coalesce(text_col, F.lit("")).alias("text"))
    ids = materialise(slim.select("id", "a", "b"), "imatch-ids")
    if ids.groupBy("id", "a", "b").count().where("count > 1").isEmpty():
        slim = slim.withColumn("times", F.lit(1).cast("long"))
    else:  # copies are merged in each task before they move
        slim = materialise(slim.groupBy("id", "a", "b").agg(F.any_value("text").alias("text"), F.count("*").alias("times")), "imatch-rows")
        ids = materialise(slim.select("id", "a", "b"), "imatch-ids")
    ranges = _Ranges(ids)
    part = ranges.part(F.col("id"), F.col("a"))
    # the first row of each range: the greatest id, the least hash
    first = F.max(F.struct("id", F.bitwise_not("a").alias("c"))).alias("head")
    heads = [(r["part"], r["id"], ~r["c"]) for r in ids.select(part.alias("part"), "id", "a").groupBy("part").agg(first).select("part", "head.*").collect()]  # at most 3 * MOST_RANGES rows
    heads.sort(key=lambda h: ranges.order(h[0]))
    schema = f"part long, row int, spare boolean, id {kind.simpleString()}, a long, text string, next_text string, times long"
    if not heads:
        return spark.createDataFrame([], schema)
    # the head of each range closes the range before it; that of the first range closes the last
    values = ", ".join(f"({p[0]}L, {'NULL' if h[1] is None else h[1]}, {h[2]}L)" for p, h in zip(heads, [*heads[1:], heads[0]], strict=True)).replace(f"{-(1 << 63)}L", "(-9223372036854775807L - 1L)")
    closing = spark.sql(f"SELECT part, CAST(id AS {kind.simpleString()}) AS head, a AS head_a FROM VALUES {values} AS t(part, id, a)")
    is_head = F.col("id").eqNullSafe(F.col("head")) & (F.col("a") == F.col("head_a"))
    head_texts = slim.join(F.broadcast(closing.select("head", "head_a").distinct()), is_head).groupBy("id", "a").agg(F.min("text").alias("text"))
    spare = head_texts.join(F.broadcast(closing), is_head).select("part", F.lit(True).alias("spare"), "id", "a", "text", F.lit(1).cast("long").alias("times"))
    rows = slim.select(part.alias("part"), F.lit(False).alias("spare"), "id", "a", "text", "times").union(spare)
    order = Window.partitionBy("part").orderBy("spare", F.desc_nulls_last("id"), "a", "text")
    return rows.select("part", F.row_number().over(order).alias("row"), "spare", "id", "a", "text", F.lead("text").over(order).alias("next_text"), "times")


def _times(rows: DataFrame) -> DataFrame:
    """``rows`` written out ``times`` times, in blocks."""
    blocks = rows.withColumn("block", F.explode(F.expr(f"sequence(0L, (times - 1) div {COPIES})")))
    return blocks.withColumn("copy", F.explode(F.expr(f"sequence(1L, least({COPIES}L, times - block * {COPIES}))"))).drop("block", "copy", "times")


def edit_resilience(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every document.

    The edited text has its last half (rounded down, in code points) replaced by
    as many code points, or all, from the start of the next document (see
    :func:`with_next`). Null text is empty; a single document follows itself.
    """
    known = lexicon_value(lexicon(docs, text_col))
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    # copies but the last are followed by their equal: a row for them, ahead of the last one's
    last, others = F.struct(F.lit(1).alias("last"), F.lit(1).cast("long").alias("n")), F.struct(F.lit(0).alias("last"), (F.col("times") - 1).alias("n"))
    rows = rows.select("*", F.inline(F.when(F.col("times") > 1, F.array(others, last)).otherwise(F.array(last)))).drop("times").withColumnRenamed("n", "times")
    rows = rows.withColumn("next_text", F.when(F.col("last") == 1, F.col("next_text")).otherwise(F.col("text")))
    half = F.expr("int(n_chars div 2)")
    edited = F.concat(F.expr("substring(text, 1, int(n_chars - n_chars div 2))"), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    base = ["part", "row", "last", "spare", "id", "n_chars", "times", "a"]
    rows = rows.select(*base, "text", edited.alias("edited"))
    rows = rows.select(*base, F.sha2("edited", 256).alias("edited_sha256"), F.xxhash64("edited").alias("edited_a"), terms(F.col("text")).alias("own"), terms(F.col("edited")).alias("other"))
    rows = rows.select(*base, "edited_sha256", "edited_a", *(lexicon_terms(F.col(c), known).alias(c) for c in ("own", "other")))
    done = rows.select(*base, "edited_sha256", signatures(F.col("own"), F.col("a")).alias("fingerprint"), signatures(F.col("other"), F.col("edited_a")).alias("edited_fingerprint"))
    after = F.lead("fingerprint").over(Window.partitionBy("part").orderBy("row", "last"))
    done = _times(done.withColumn("after", after).where("NOT spare"))
    return done.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("after")).alias("near_next")
    )
