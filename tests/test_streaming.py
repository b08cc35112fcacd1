"""Incremental link over arriving message files."""

import json
import os

from pyspark.sql import functions as F

from privlink.operators.flatten import flatten_conditions, flatten_messages, flatten_patients, patient_conditions
from privlink.operators.link import link_by_interval
from privlink.sources.files import read_bundles, read_message_docs
from privlink.streaming.incremental import link_messages_stream

from .fixtures import tweet, write_bundles, write_messages


def _conditions(spark, folder):
    b = read_bundles(spark, folder)
    pc = patient_conditions(flatten_conditions(b, with_id=True), flatten_patients(b))
    return pc.withColumn("code", F.col("code").try_cast("long"))


def test_stream_matches_batch_and_is_incremental(spark, workdir):
    bdir, mdir, out = (os.path.join(workdir, x) for x in ("b", "m", "out"))
    write_bundles(bdir)
    write_messages(mdir)
    cond = _conditions(spark, bdir)
    q = link_messages_stream(spark, mdir, cond, out, checkpoint=os.path.join(workdir, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    batch = link_by_interval(flatten_messages(read_message_docs(spark, mdir), with_position=True), cond)
    cols = ["filename", "message_pos", "condition_id", "code"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, batch.select(cols).collect()), key=str)
    n = got.count()

    # a new file arrives: only its messages are added
    with open(os.path.join(mdir, "Ann_Lee_100TwitterData-2.json"), "w") as f:
        json.dump({"messages": [tweet(11, "Ann", "Mon May 10 12:00:00 +0000 2010", "again")]}, f)
    q = link_messages_stream(spark, mdir, cond, out, checkpoint=os.path.join(workdir, "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == n + 1  # May 10: inside c1 only


def test_stream_encrypted(spark, workdir):
    bdir, mdir, out = (os.path.join(workdir, x) for x in ("b", "m", "out"))
    write_bundles(bdir)
    write_messages(mdir)
    from privlink.functions.crypto import new_key

    q = link_messages_stream(spark, mdir, _conditions(spark, bdir), out, protect="encrypt", key=new_key(),
                             checkpoint=os.path.join(workdir, "ckpt"))
    q.awaitTermination(120)
    e = spark.read.parquet(out)
    assert "SynSocial_UID_encrypted" in e.columns and "message_pos" not in e.columns
    assert e.select("SynSocial_UID_encrypted").distinct().count() == e.count()


def test_restart_in_another_process_finds_every_message_once(spark, workdir):
    """Stop, add a file, start again from a new Python process."""
    import subprocess
    import sys

    bdir, mdir, out, ckpt = (os.path.join(workdir, x) for x in ("b", "m", "out", "ckpt"))
    write_bundles(bdir)
    os.makedirs(mdir)
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession, functions as F
from privlink.operators.flatten import flatten_conditions, flatten_patients, patient_conditions
from privlink.sources.files import read_bundles
from privlink.streaming.incremental import link_messages_stream
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate()
b = read_bundles(spark, {bdir!r})
pc = patient_conditions(flatten_conditions(b, with_id=True), flatten_patients(b)).withColumn("code", F.col("code").try_cast("long"))
link_messages_stream(spark, {mdir!r}, pc, {out!r}, checkpoint={ckpt!r}).awaitTermination(120)
"""
    for k in range(2):
        with open(os.path.join(mdir, f"Nobody_X_{k}TwitterData.json"), "w") as f:
            json.dump({"messages": [tweet(33, "No", "Wed Feb 02 01:00:00 +0000 2011", f"message {k}")]}, f)
        subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == ["message 0", "message 1"]


def test_checkpoint_must_be_named(spark, workdir):
    import pytest

    with pytest.raises(TypeError):
        link_messages_stream(spark, workdir, None, workdir + "/out")


def test_broken_lines_are_no_messages(spark, workdir):
    """Batch and stream leave them out, and the rejected lines can be had."""
    from privlink.functions.crypto import new_key
    from privlink.sources.files import read_message_lines, rejected_docs, rejected_lines

    bdir, mdir, out = (os.path.join(workdir, x) for x in ("b", "m", "out"))
    write_bundles(bdir)
    os.makedirs(mdir)
    good = json.dumps(tweet(11, "Ann", "Thu May 06 12:00:00 +0000 2010", "ok"))
    with open(os.path.join(mdir, "Ann_Lee_100TwitterData.json"), "w") as f:
        f.write("\n".join([good, '{"user": {"id": ', "", "  ", "123", good, "not json"]))
    docs = read_message_lines(spark, mdir)
    assert flatten_messages(docs).count() == 2
    assert flatten_messages(docs, with_position=True).select("message_pos").distinct().count() == 2
    assert sorted(r["line"] for r in rejected_lines(spark, mdir).collect()) == ["123", "not json", '{"user": {"id": ']
    q = link_messages_stream(spark, mdir, _conditions(spark, bdir), out, as_lines=True, protect="encrypt", key=new_key(), checkpoint=os.path.join(workdir, "ckpt"))
    q.awaitTermination(120)
    e = spark.read.parquet(out)
    assert e.count() == 2 and e.select("SynSocial_UID_encrypted").distinct().count() == 2
    write_messages(os.path.join(workdir, "docs"))
    bad = [os.path.basename(r["path"]) for r in rejected_docs(spark, os.path.join(workdir, "docs")).collect()]
    assert "broken.json" in bad and not any("TwitterData" in x for x in bad)


def test_a_stream_links_messages_in_one_join_like_a_batch(spark, workdir):
    """Overlapping, touching, equal and endless spells; messages before, between and after them, without key or day."""
    spells = [("p", 1, 5), ("p", 3, 4), ("p", 6, 6), ("p", 20, 2000), ("p", 25, 30), ("p", 25, 30), ("q", 0, 900_000), ("r", 9, 7), (None, 1, 9)]
    c = spark.createDataFrame([(i, k, a, b) for i, (k, a, b) in enumerate(spells)], "cid int, k string, a int, b int")
    c = c.select("cid", "k", F.date_from_unix_date("a").alias("assertedDate"), F.date_from_unix_date("b").alias("abatementDate"))
    m = [(k, d) for k in ("p", "q", "r", "s", None) for d in (-1, 0, 1, 4, 5, 6, 7, 19, 20, 26, 31, 2000, 2001, 5000)] + [("p", None), (None, None)]
    m = spark.createDataFrame([(i, *x) for i, x in enumerate(m + m[:9])], "mid int, filename string, d int")
    m = m.select("mid", "filename", F.date_from_unix_date("d").alias("created_at"))
    src, out = f"{workdir}/src", f"{workdir}/out"
    m.write.parquet(src)
    for levels in ((30, 1095, 4_000_000), (7,)):
        linked = link_by_interval(spark.readStream.schema(m.schema).parquet(src), c, condition_key=F.col("k"), level_days=levels)
        to = f"{out}-{len(levels)}"
        q = linked.writeStream.format("parquet").option("path", to).option("checkpointLocation", f"{to}-ckpt").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        batch = link_by_interval(m, c, condition_key=F.col("k"), level_days=levels)
        rows = lambda df: sorted(map(str, df.select("mid", "filename", "created_at", "cid", "assertedDate", "abatementDate").collect()))
        assert rows(spark.read.parquet(to)) == rows(batch)
    # one join in the plan: no anti join moves the messages again
    assert linked._jdf.queryExecution().analyzed().toString().count("Join ") == 1


def test_random_line_numbers_stay_those_of_their_message(spark, workdir):
    """A message inside spells of two levels is one message, also where its number is random."""
    src, out = f"{workdir}/src", f"{workdir}/out"
    m = spark.sql("SELECT 'p' AS filename, DATE'2020-01-02' AS created_at")
    m.write.parquet(src)
    c = spark.sql("SELECT 'p' AS k, DATE'2020-01-01' AS assertedDate, explode(array(DATE'2020-01-03', DATE'2021-01-01', DATE'9999-12-31')) AS abatementDate")
    s = spark.readStream.schema(m.schema).parquet(src).withColumn("n", F.xxhash64(F.uuid()))
    q = link_by_interval(s, c, condition_key=F.col("k")).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-ckpt").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 3 and got.select("n").distinct().count() == 1
