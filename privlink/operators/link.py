"""Link messages to the conditions a person had on the message day.

Semantics (parity): a left outer join on the person key with
``start <= day <= end``; every message is kept, a message inside k spells
gives k rows, and a condition without an end date never matches.

Plan: whether and what a message matches depends on its person and day
alone. The interval join therefore runs on the distinct (person, day) pairs of
the messages, and its result meets the messages in one left outer equi-join
on (person, day), in which every message is kept. Only that join moves whole messages.

A plain equi-join on the person key would compare every day of a
person with every condition of that person inside one task, which breaks
down when one person holds a large share of the rows. The join key of the pairs is
therefore ``(person, level, day bucket)`` over a few fixed bucket widths
(levels). A text key goes through the pairs as 64 bits: they are looked up once
per level, and the keys of persons with equal bits are compared in the join with
the messages, as every hit has its condition's own key. A spell belongs to the narrowest level at least as wide as itself,
where it touches at most two buckets, so it is copied at most twice, as no spell
is wider than the widest level (with ``level_days`` of one's own, such a spell is
copied into each bucket it touches). A pair is looked up once per level, in its one bucket
there, so each matching pair of day and spell is produced exactly once. An
analysis of matched rows turns the last join into an inner one.

A stream may keep no distinct pairs without state. There the messages
themselves are looked up, each level moving them once. The spans of days that any spell
covers are held on the widest level, where a message that meets none is known to have no match.

Rows that can never match (no key, no start or end, end before start) are
dropped from the condition side only, which cannot change a left outer join.
Catalyst/AQE choose sort-merge or broadcast from measured sizes; AQE splits a
skewed message partition (the left side of the outer join) at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from ..functions.dates import as_day, clinical_day, message_day
from ..functions.keys import person_file_key

#: Bucket widths in days: a month, three years, and all days that a date holds.
LEVEL_DAYS = (30, 1_095, 4_000_000)

_K, _L, _B = "__pl_key", "__pl_level", "__pl_bucket"
_BITS = "__pl_person"
_SPELL, _NEW = "__pl_spell", "__pl_span"
_HIT_K, _HIT_AT = "__pl_hit_key", "__pl_hit_day"


def _bucket(day, width):
    return F.floor(F.unix_date(day) / width)


def spell_buckets(start, end, levels=LEVEL_DAYS):
    """Array of (level, bucket) that a spell is copied to."""
    days = F.datediff(end, start) + 1
    level, width = F.lit(len(levels) - 1), F.lit(levels[-1])
    for i in reversed(range(len(levels) - 1)):
        level, width = F.when(days <= levels[i], F.lit(i)).otherwise(level), F.when(days <= levels[i], F.lit(levels[i])).otherwise(width)
    return F.transform(F.sequence(_bucket(start, width), _bucket(end, width)), lambda b: F.struct(level.alias(_L), b.alias(_B)))


def _lookups(at: str, levels):
    """A row per level with the bucket of the day there."""
    return F.inline(F.array(*[F.struct(F.lit(i).alias(_L), _bucket(F.col(at), w).alias(_B)) for i, w in enumerate(levels)]))


def link_by_interval(
    messages: DataFrame,
    conditions: DataFrame,
    *,
    message_key: str = "filename",
    condition_key=None,
    at: str = "created_at",
    start: str = "assertedDate",
    end: str = "abatementDate",
    level_days: tuple[int, ...] = LEVEL_DAYS,
    strict_dates: bool = False,
) -> DataFrame:
    """Left outer interval join; columns: all message columns, then all
    condition columns. Text dates are parsed (message: UTC day of the
    timestamp; clinical: the day written before ``T``).

    ``condition_key`` is a Column; by default it is the person file name
    built from Given_Name, Family_Name and Identifier. ``level_days`` are the
    bucket widths, ascending; they change the work, never the rows.
    """
    levels = tuple(level_days)
    if not levels or any(w < 1 for w in levels) or list(levels) != sorted(set(levels)):
        raise ValueError("level_days must be ascending widths of at least a day")
    clash = set(messages.columns) & set(conditions.columns)
    if clash:
        raise ValueError(f"message and condition columns overlap: {sorted(clash)}")

    mtypes = dict((f.name, f.dataType) for f in messages.schema.fields)
    ctypes = dict((f.name, f.dataType) for f in conditions.schema.fields)

    m = messages.withColumn(at, as_day(at, mtypes[at], message_day, strict_dates))
    m = m.withColumn(_K, F.col(message_key))

    key = person_file_key() if condition_key is None else condition_key
    c = conditions.withColumns(
        {
            start: as_day(start, ctypes[start], clinical_day, strict_dates),
            end: as_day(end, ctypes[end], clinical_day, strict_dates),
        }
    )
    c = c.withColumn(_K, key).filter(
        F.col(_K).isNotNull()
        & F.col(start).isNotNull()
        & F.col(end).isNotNull()
        & (F.col(start) <= F.col(end))
    )

    def on(*more):
        same = F.col(f"m.{message_key}") == F.col(f"c.{_K}")
        inside = (F.col(f"c.{start}") <= F.col(f"m.{at}")) & (F.col(f"m.{at}") <= F.col(f"c.{end}"))
        for x in more:
            same = same & x
        return same & inside

    found = F.col(_K).isNotNull() & F.col(at).isNotNull()
    if messages.isStreaming:
        return _link_stream(messages, m.filter(found).drop(_K), m.filter(~found), c, on, at, start, end, levels, conditions.columns)
    c = c.select("*", F.inline(spell_buckets(F.col(start), F.col(end), levels)))
    text = isinstance(m.schema[_K].dataType, StringType) and m.schema[_K].dataType == c.schema[_K].dataType
    bits = F.xxhash64(_K) if text else F.col(_K)
    days = m.filter(found).select(bits.alias(_BITS), at).distinct().select("*", _lookups(at, levels))
    # persons with equal bits share their days, so each spell meets a day once whoever's it is
    inside = (F.col(f"c.{start}") <= F.col(f"m.{at}")) & (F.col(f"m.{at}") <= F.col(f"c.{end}"))
    hit = (F.col(f"m.{_BITS}") == F.col(f"c.{_BITS}")) & (F.col(f"m.{_L}") == F.col(f"c.{_L}")) & (F.col(f"m.{_B}") == F.col(f"c.{_B}")) & inside
    spells = days.alias("m").join(c.withColumn(_BITS, bits).alias("c"), hit, "inner").select(
        F.col(f"c.{_BITS}"), F.col(f"c.{_K}").alias(_HIT_K), F.col(f"m.{at}").alias(_HIT_AT), *[F.col(f"c.{x}") for x in conditions.columns]
    )
    # the bits come first: file names begin alike, so sorting by them alone compares whole texts
    same_day = (F.col(f"m.{message_key}") == F.col(f"h.{_HIT_K}")) & (F.col(f"m.{at}") == F.col(f"h.{_HIT_AT}"))
    if text:
        same_day = (F.xxhash64(f"m.{message_key}") == F.col(f"h.{_BITS}")) & same_day
    return m.drop(_K).alias("m").join(spells.alias("h"), same_day, "left").select(
        *[F.col(f"m.{x}") for x in messages.columns], *[F.col(f"h.{x}") for x in conditions.columns]
    )


def _covered(c: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """(key, start, end, bucket): the days inside any spell as disjoint spans per person, which
    are no more than the days however many spells overlap, copied to the buckets of ``width`` they touch."""
    before = Window.partitionBy(_K).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.coalesce(F.col(start) > F.max(end).over(before), F.lit(True))
    upto = Window.partitionBy(_K).orderBy(start, end).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = c.select(_K, start, end, fresh.alias(_NEW)).select(_K, start, end, F.count_if(_NEW).over(upto).alias(_NEW))
    spans = spans.groupBy(_K, _NEW).agg(F.min(start).alias(start), F.max(end).alias(end))
    return spans.select(_K, start, end, F.explode(F.sequence(_bucket(F.col(start), width), _bucket(F.col(end), width))).alias(_B))


def _link_stream(messages: DataFrame, found: DataFrame, unfound: DataFrame, spells: DataFrame, on, at: str, start: str, end: str, levels, columns) -> DataFrame:
    """The link of a stream: one stateless join, in which a message is moved once per level.

    It is read once too: random line numbers would differ where it is read again. The widest level
    also holds the covered days, so a message that meets nothing there has no match at all."""
    last = len(levels) - 1
    looked_up = found.select("*", _lookups(at, levels)).alias("m")
    copies = spells.select("*", F.inline(spell_buckets(F.col(start), F.col(end), levels)), F.lit(True).alias(_SPELL))
    covered = _covered(spells, start, end, levels[-1]).select("*", F.lit(last).alias(_L), F.lit(False).alias(_SPELL))
    held = copies.unionByName(covered, allowMissingColumns=True).alias("c")
    met = looked_up.join(held, on(F.col(f"m.{_L}") == F.col(f"c.{_L}"), F.col(f"m.{_B}") == F.col(f"c.{_B}")), "left")
    spell = F.col(f"c.{_SPELL}")
    met = met.where(spell | (spell.isNull() & (F.col(f"m.{_L}") == last))).select(
        *[F.col(f"m.{x}") for x in messages.columns], *[F.col(f"c.{x}") for x in columns]
    )
    nothing = [F.lit(None).cast(spells.schema[x].dataType).alias(x) for x in columns]
    return met.union(unfound.select(*messages.columns, *nothing))
