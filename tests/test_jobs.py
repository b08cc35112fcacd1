"""The six jobs end to end from folders (L10)."""

import os

import pytest

from privlink.operators.privacy import decrypt_columns
from privlink.plans.jobs import run_jobs

from .fixtures import write_bundles, write_messages


@pytest.mark.parametrize("hop_format", ["parquet", "csv"])
def test_run_jobs(spark, workdir, hop_format):
    b, m, out = (os.path.join(workdir, x) for x in ("bundles", "messages", "out"))
    write_bundles(b)
    write_messages(m)
    res = run_jobs(spark, b, m, out, hop_format=hop_format, write_key=(hop_format == "parquet"))
    read = (lambda p: spark.read.parquet(p)) if hop_format == "parquet" else (
        lambda p: spark.read.options(header=True, multiLine=True, escape='"', inferSchema=True).csv(p)
    )
    joined = read(res.paths["joined"])
    # 6 messages; Ann's May 11 messages fall in c1 and both c2 codings -> 3 rows each
    assert joined.count() == 1 + 3 + 3 + 1 + 1 + 1
    rep = {r["Medical_Codes"]: r for r in read(res.paths["analysis-hash"]).collect()}
    assert rep[444814009]["User_Count"] == 2.0 and rep[444814009]["Message_Count"] == 4.0
    assert rep[444814009]["Avg_Msg_per_User"] == 2.0
    stats = read(res.paths["analysis-encrypt-stats"]).first()
    # encrypted copy: every non-NULL token distinct (T2); NULL not counted
    assert stats["Social-Media-Users"] == 10 and stats["Medical-Records"] == 8
    hstats = read(res.paths["analysis-hash-stats"]).first()
    # hashed copy: 3 users; 2 patients + the NULL record id hashed to 42 (T1)
    assert hstats["Social-Media-Users"] == 3 and hstats["Medical-Records"] == 3
    if hop_format == "parquet":
        enc = spark.read.parquet(res.paths["encrypted"])
        dec = decrypt_columns(enc, res.key, check_column="ok")
        assert dec.filter("NOT ok").count() == 0
        assert sorted(r["SynSocial_UID"] for r in dec.select("SynSocial_UID").distinct().collect()) == ["11", "22", "33"]
        assert spark.read.parquet(res.paths["key"]).first()["Key-String"] == res.key


def test_command_line_steps(spark, workdir):
    """The six programs as separate steps give the same analysis as one run."""
    from privlink.__main__ import main

    b, m, base = (os.path.join(workdir, x) for x in ("bundles", "messages", "DataSet1"))
    write_bundles(b)
    write_messages(m)
    main(["conditions", "--base", base, "--bundles", b, "--format", "csv"])
    main(["messages", "--base", base, "--messages", m, "--format", "csv"])
    main(["link", "--base", base, "--format", "csv"])
    main(["privacy", "--base", base, "--format", "csv", "--write-key"])
    out = main(["analysis", "--base", base, "--format", "csv", "--kind", "hash"])
    rep = spark.read.options(header=True, inferSchema=True).csv(out["analysis-hash"])
    assert {r["Medical_Codes"]: r["Message_Count"] for r in rep.collect()}[444814009] == 4.0
    assert os.path.isdir(os.path.join(base, "KEY"))


def test_run_jobs_from_resources_per_line(spark, workdir):
    import json

    b, r, m = (os.path.join(workdir, x) for x in ("bundles", "resources", "messages"))
    write_bundles(b)
    write_messages(m)
    os.makedirs(r)
    for name in sorted(os.listdir(b)):
        with open(os.path.join(b, name)) as f, open(os.path.join(r, name + ".ndjson"), "w") as out:
            for e in json.load(f)["entry"]:
                out.write(json.dumps(e["resource"]) + "\n")
    x = run_jobs(spark, b, m, os.path.join(workdir, "o1"))
    y = run_jobs(spark, r, m, os.path.join(workdir, "o2"), resources_per_line=True)
    rows = lambda res: sorted(map(tuple, spark.read.parquet(res.paths["analysis-hash"]).collect()))
    assert rows(x) == rows(y)


def test_command_line_refuses_to_lose_the_key(workdir):
    from privlink.__main__ import main

    for step in ("privacy", "all"):
        with pytest.raises(SystemExit):
            main([step, "--base", workdir, "--bundles", workdir, "--messages", workdir])


@pytest.mark.parametrize("hop_format", ["parquet", "csv"])
@pytest.mark.parametrize("lines", [False, True])
def test_identical_messages_get_tokens_of_their_own(spark, workdir, hop_format, lines):
    import json

    from .fixtures import tweet

    b, m, out = (os.path.join(workdir, x) for x in ("b", "m", "out"))
    write_bundles(b)
    os.makedirs(m)
    same = [tweet(11, "Ann", "Thu May 06 12:00:00 +0000 2010", "again")] * 5
    with open(os.path.join(m, "Ann_Lee_100TwitterData.json"), "w") as f:
        f.write("\n".join(map(json.dumps, same)) if lines else json.dumps({"messages": same}))
    res = run_jobs(spark, b, m, out, hop_format=hop_format, messages_as_lines=lines)
    read = spark.read.parquet if hop_format == "parquet" else lambda p: spark.read.options(header=True).csv(p)
    enc = read(res.paths["encrypted"])
    assert enc.count() == 5 and enc.select("SynSocial_UID_encrypted").distinct().count() == 5
    assert int(read(res.paths["analysis-encrypt-stats"]).first()["Social-Media-Users"]) == 5


def test_resume_from_folders_the_original_jobs_wrote(spark, workdir):
    """Default CSV options, no row identity: link, protect and analyse from there."""
    from privlink.operators.flatten import flatten_conditions, flatten_messages, flatten_patients, patient_conditions
    from privlink.plans.jobs import PATIENTS, SOCIAL, Hop, job_analysis, job_link, job_privacy
    from privlink.functions.crypto import new_key
    from privlink.sources.files import read_bundles, read_message_docs

    b, m, base = (os.path.join(workdir, x) for x in ("b", "m", "base"))
    write_bundles(b)
    write_messages(m)
    bundles = read_bundles(spark, b)
    pc = patient_conditions(flatten_conditions(bundles), flatten_patients(bundles))
    pc.write.csv(f"{base}/{PATIENTS}", header=True)
    one_line = flatten_messages(read_message_docs(spark, m)).filter("text NOT LIKE '%second line%'")
    one_line.write.csv(f"{base}/{SOCIAL}", header=True)
    hop = Hop(spark, base, "csv", "original")
    job_link(hop)
    job_privacy(hop, new_key())
    out = job_analysis(hop, "hash")
    rep = spark.read.options(header=True, inferSchema=True).csv(out["analysis-hash"])
    assert {r["Medical_Codes"]: r["Message_Count"] for r in rep.collect()}[444814009] == 3.0


def test_strict_dates_stop_the_jobs(spark, workdir):
    import json

    from .fixtures import tweet

    b, m = (os.path.join(workdir, x) for x in ("b", "m"))
    write_bundles(b)
    os.makedirs(m)
    with open(os.path.join(m, "Ann_Lee_100TwitterData.json"), "w") as f:
        json.dump({"messages": [tweet(11, "Ann", "not a date", "x")]}, f)
    run_jobs(spark, b, m, os.path.join(workdir, "lenient"))
    with pytest.raises(Exception, match="unparseable message time"):
        run_jobs(spark, b, m, os.path.join(workdir, "strict"), strict_dates=True)


def test_clear_staging_table_goes_unless_kept(spark, workdir):
    b, m = (os.path.join(workdir, x) for x in ("b", "m"))
    write_bundles(b)
    write_messages(m)
    gone = run_jobs(spark, b, m, os.path.join(workdir, "o1"))
    assert not os.path.exists(os.path.join(workdir, "o1", "_resources")) and "resources" not in gone.paths
    kept = run_jobs(spark, b, m, os.path.join(workdir, "o2"), keep_stage=True)
    assert os.path.isdir(kept.paths["resources"])


@pytest.mark.parametrize("hop_format", ["parquet", "csv"])
def test_hand_offs_are_not_broadcast_by_their_file_size(spark, workdir, hop_format):
    """Packed rows: a few kilobytes of files, over a megabyte in the driver's memory."""
    from pyspark.sql import functions as F

    from privlink.plans.jobs import PATIENTS, SOCIAL, Hop, job_link

    person, day = (F.col("id") % 2000).cast("string"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 2000).cast("int"))
    messages = spark.range(20_000).select(
        F.lit("u").alias("SynSocial_UID"), F.lit("n").alias("name"), F.lit("s").alias("screen_name"),
        F.date_format(day.cast("timestamp"), "EEE MMM dd HH:mm:ss +0000 yyyy").alias("created_at"), F.lit("t").alias("text"),
        F.concat(F.lit("G_F_"), person, F.lit("TwitterData.json")).alias("filename"),
    )
    conditions = spark.range(4000).select(
        F.lit("x" * 300).alias("display"), F.lit(1).cast("bigint").alias("code"), F.lit("2020-01-01").alias("assertedDate"), F.lit("2020-01-10").alias("abatementDate"),
        F.lit("G").alias("Given_Name"), person.alias("Identifier"), person.alias("Synthea_UID"), F.lit("F").alias("Family_Name"),
    )
    key, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        hop = Hop(spark, workdir, hop_format)
        hop.write(messages, SOCIAL)
        hop.write(conditions, PATIENTS)
        files = [os.path.join(workdir, PATIENTS, f) for f in os.listdir(os.path.join(workdir, PATIENTS)) if f.startswith("part-")]
        assert sum(map(os.path.getsize, files)) < 64 << 10
        out = job_link(hop)["joined"]
        assert (spark.conf.get(key), spark.conf.get(measured, None)) == ("64k", None)
    finally:
        spark.conf.set(key, before)
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    plan = [p for p in plans if "__pl_bucket" in p and workdir in p][-1]
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    joined = spark.read.parquet(out) if hop_format == "parquet" else spark.read.options(header=True).csv(out)
    assert joined.where("Synthea_UID IS NOT NULL").count() == joined.count() == 40_000
