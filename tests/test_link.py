"""Interval link (D2, D3, C3) and traps T3, T4; bucketed plan vs brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from privlink.operators.link import link_by_interval

MSG = "SynSocial_UID string, created_at string, text string, filename string, mid int"
COND = "display string, code long, assertedDate string, abatementDate string, Given_Name string, Identifier string, Synthea_UID string, Family_Name string, cid int"
KEY = "Ann_Lee_1TwitterData.json"


def _msg(day, mid, key=KEY):
    return ("u1", day.strftime("%a %b %d 12:00:00 +0000 %Y"), "t", key, mid)


def _cond(start, end, code=7, cid=1):
    return ("flu", code, start, end, "Ann", "1", "uid-1", "Lee", cid)


def test_inclusive_bounds_and_open_end(spark):
    d = dt.date(2010, 5, 6)
    msgs = [_msg(d + dt.timedelta(days=k), k) for k in (-1, 0, 5, 10, 11)]
    conds = [_cond("2010-05-06T10:00:00-04:00", "2010-05-16"), _cond("2010-05-06", None, code=8, cid=2)]
    out = link_by_interval(spark.createDataFrame(msgs, MSG), spark.createDataFrame(conds, COND))
    got = {r["mid"]: r["code"] for r in out.collect()}
    # day before and day after: no match; both ends inclusive; open end never matches (T3)
    assert got == {-1: None, 0: 7, 5: 7, 10: 7, 11: None}
    assert out.columns[:5] == ["SynSocial_UID", "created_at", "text", "filename", "mid"]
    assert dict(out.dtypes)["created_at"] == "date"


def test_overlapping_spells_count_twice(spark):
    """T4: a message inside two spells of one code gives two rows."""
    msgs = [_msg(dt.date(2011, 1, 10), 1)]
    conds = [_cond("2011-01-01", "2011-01-20", cid=1), _cond("2011-01-05", "2011-02-01", cid=2)]
    out = link_by_interval(spark.createDataFrame(msgs, MSG), spark.createDataFrame(conds, COND))
    assert sorted(r["cid"] for r in out.collect()) == [1, 2]


def test_key_mismatch_and_nulls_keep_message(spark):
    msgs = [_msg(dt.date(2011, 1, 10), 1, key="Other_X_2TwitterData.json"), ("u", None, "t", KEY, 2), ("u", "junk", "t", None, 3)]
    conds = [_cond("2011-01-01", "2011-01-20")]
    out = link_by_interval(spark.createDataFrame(msgs, MSG), spark.createDataFrame(conds, COND))
    assert sorted((r["mid"], r["code"]) for r in out.collect()) == [(1, None), (2, None), (3, None)]


def test_name_with_null_part_skips_it(spark):
    """concat_ws skips NULL parts of the built key."""
    msgs = [_msg(dt.date(2011, 1, 10), 1, key="Lee_1TwitterData.json")]
    c = list(_cond("2011-01-01", "2011-01-20"))
    c[4] = None
    out = link_by_interval(spark.createDataFrame(msgs, MSG), spark.createDataFrame([tuple(c)], COND))
    assert out.first()["code"] == 7


@pytest.mark.parametrize("level_days", [(1,), (7, 60), (30, 1095, 36525), (365,)])
def test_bucketed_join_equals_brute_force(spark, level_days):
    rnd = random.Random(str(level_days))
    base = dt.date(1999, 12, 1)
    people = [f"p{i}TwitterData.json" for i in range(4)]
    msgs = []
    for m in range(400):
        key = people[0] if m % 3 else rnd.choice(people)  # one hot person
        msgs.append(("u", (base + dt.timedelta(days=rnd.randint(-40, 200))).strftime("%a %b %d 01:02:03 +0000 %Y"), "t", key, m))
    conds = []
    for c in range(60):
        p = rnd.choice(range(4))
        s = base + dt.timedelta(days=rnd.randint(-60, 200))
        e = None if c % 9 == 0 else s + dt.timedelta(days=rnd.randint(-3, 120))
        conds.append(("d", c % 5, s.isoformat(), e.isoformat() if e else None, f"p{p}", None, "x", None, c))
    mdf, cdf = spark.createDataFrame(msgs, MSG), spark.createDataFrame(conds, COND)
    ck = F.concat(F.col("Given_Name"), F.lit("TwitterData.json"))
    got = sorted((r["mid"], r["cid"]) for r in link_by_interval(mdf, cdf, condition_key=ck, level_days=level_days).collect())
    # brute force in Python
    exp = []
    for m in msgs:
        day = dt.datetime.strptime(m[1], "%a %b %d %H:%M:%S +0000 %Y").date()
        hits = [
            c[8]
            for c in conds
            if f"{c[4]}TwitterData.json" == m[3] and c[3] is not None
            and dt.date.fromisoformat(c[2]) <= day <= dt.date.fromisoformat(c[3])
        ]
        exp.extend((m[4], h) for h in hits) if hits else exp.append((m[4], None))
    key = lambda t: (t[0], -1 if t[1] is None else t[1])
    assert sorted(got, key=key) == sorted(exp, key=key)


def test_column_clash_rejected(spark):
    m = spark.createDataFrame([("a", "2010-01-01", "k")], "x string, created_at string, filename string")
    c = spark.createDataFrame([("a", "2010-01-01", "2010-01-02")], "x string, assertedDate string, abatementDate string")
    with pytest.raises(ValueError):
        link_by_interval(m, c, condition_key=F.lit("k"))


@pytest.mark.parametrize("bad", [(), (0, 5), (30, 30), (30, 7)])
def test_bad_levels_rejected(spark, bad):
    m = spark.createDataFrame([("2010-01-01", "k")], "created_at string, filename string")
    c = spark.createDataFrame([("2010-01-01", "2010-01-02")], "assertedDate string, abatementDate string")
    with pytest.raises(ValueError):
        link_by_interval(m, c, condition_key=F.lit("k"), level_days=bad)


def test_a_spell_is_copied_at_most_twice(spark):
    """Only spells wider than the widest level take more: a bucket a century."""
    from privlink.operators.link import LEVEL_DAYS, spell_buckets

    rnd = random.Random(8)
    first = dt.date(1900, 1, 1)
    spans = [1, 2, 29, 30, 31, 1094, 1095, 1096, 36524, 36525] + [rnd.randint(1, 36525) for _ in range(300)]
    rows = [(s := first + dt.timedelta(days=rnd.randint(0, 50000)), s + dt.timedelta(days=n - 1)) for n in spans]
    df = spark.createDataFrame(rows, "s date, e date")
    sizes = [r[0] for r in df.select(F.size(spell_buckets(F.col("s"), F.col("e")))).collect()]
    assert max(sizes) == 2
    ever = spark.createDataFrame([(first, dt.date(9999, 12, 31))], "s date, e date")
    assert ever.select(F.size(spell_buckets(F.col("s"), F.col("e")))).first()[0] <= (9999 - 1900) * 366 // LEVEL_DAYS[-1] + 2


def test_timestamps_link_by_their_utc_day_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        m = spark.createDataFrame([(1, "k")], "mid int, filename string").withColumn("created_at", F.timestamp_seconds(F.lit(1273188600)))  # 2010-05-06 23:30 UTC
        c = spark.createDataFrame([("2010-05-06", "2010-05-06", 5)], "assertedDate string, abatementDate string, cid int")
        for z in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert [r["cid"] for r in link_by_interval(m, c, condition_key=F.lit("k")).collect()] == [5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
