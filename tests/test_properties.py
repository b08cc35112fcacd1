"""Property tests: encryption inverse, link keeps every message, murmur3 SQL."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from privlink.operators.link import link_by_interval
from privlink.operators.privacy import decrypt_columns, encrypt_columns, new_key

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
texts = st.lists(st.one_of(st.none(), st.text(max_size=300)), min_size=1, max_size=40)


@SETTINGS
@given(values=texts)
def test_decrypt_inverts_encrypt(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "rid int, v string")
    key = new_key()
    back = decrypt_columns(encrypt_columns(df, key, cols=["v"], row_id_cols=["rid"]), key, cols=["v"], check_column="ok")
    got = {r["rid"]: (r["v"], r["ok"]) for r in back.collect()}
    assert got == {i: (v, True) for i, v in enumerate(values)}


day = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31))


@SETTINGS
@given(
    msgs=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), day)), min_size=1, max_size=60),
    conds=st.lists(
        st.tuples(st.sampled_from(["a", "b", "d"]), st.one_of(st.none(), day), st.one_of(st.none(), day)), max_size=30
    ),
    width=st.sampled_from([1, 3, 30, 400]),
)
def test_link_keeps_every_message_and_matches_brute_force(spark, msgs, conds, width):
    m = spark.createDataFrame([(k, d, i) for i, (k, d) in enumerate(msgs)], "filename string, created_at date, mid int")
    c = spark.createDataFrame([(k, s, e, j) for j, (k, s, e) in enumerate(conds)], "k string, assertedDate date, abatementDate date, cid int")
    out = link_by_interval(m, c, condition_key=F.col("k"), level_days=(width, 10 * width)).select("mid", "cid").collect()
    exp = []
    for i, (k, d) in enumerate(msgs):
        hits = [j for j, (ck, s, e) in enumerate(conds) if k is not None and ck == k and None not in (d, s, e) and s <= d <= e]
        exp += [(i, j) for j in hits] or [(i, None)]
    norm = lambda rows: sorted((a, -1 if b is None else b) for a, b in rows)
    assert norm((r["mid"], r["cid"]) for r in out) == norm(exp)
    assert {r["mid"] for r in out} == set(range(len(msgs)))


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.text(max_size=50)), min_size=1, max_size=40))
def test_murmur3_sql_matches_spark_hash(spark, values):
    duckdb = pytest.importorskip("duckdb")
    from linkqueries.murmur_sql import hashed_select

    sp = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
          .orderBy("id").select(F.hash("v").cast("string")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INTEGER, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    dk = [r[1] for r in con.execute(hashed_select("t", ["id"], ["v"]) + " ORDER BY id").fetchall()]
    assert sp == dk


stamp = st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2037, 12, 31))
offset_min = st.integers(min_value=-12 * 60, max_value=14 * 60).map(lambda m: m - m % 15)


@SETTINGS
@given(values=st.lists(st.tuples(stamp, offset_min), min_size=1, max_size=60))
def test_message_day_is_the_utc_day(spark, values):
    from privlink.functions.dates import message_day

    def text(local, off):
        sign = "+" if off >= 0 else "-"
        return local.strftime("%a %b %d %H:%M:%S ") + f"{sign}{abs(off) // 60:02d}{abs(off) % 60:02d}" + local.strftime(" %Y")

    rows = [(i, text(t, o)) for i, (t, o) in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, s string")
    got = {r["i"]: r["d"] for r in df.select("i", message_day("s").alias("d")).collect()}
    exp = {i: (t - dt.timedelta(minutes=o)).date() for i, (t, o) in enumerate(values)}
    assert got == exp


@SETTINGS
@given(values=st.lists(st.tuples(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2099, 12, 31)),
                                 st.sampled_from(["", "T00:00:00", "T23:30:00-04:00", "T01:00:00+14:00", "T12:00:00Z"])),
                       min_size=1, max_size=60))
def test_clinical_day_keeps_the_written_day(spark, values):
    from privlink.functions.dates import clinical_day

    df = spark.createDataFrame([(i, d.isoformat() + suffix) for i, (d, suffix) in enumerate(values)], "i int, s string")
    got = {r["i"]: r["d"] for r in df.select("i", clinical_day("s").alias("d")).collect()}
    assert got == {i: d for i, (d, _) in enumerate(values)}
