"""A hot person: the link stays exact when AQE splits the skewed partition."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from privlink.operators.analysis import exposure_report
from privlink.operators.link import link_by_interval
from privlink.plans.jobs import run_jobs

from .fixtures import write_bundles, write_messages

MSG = "SynSocial_UID string, created_at date, text string, filename string, mid int"
COND = "display string, code long, assertedDate date, abatementDate date, Given_Name string, cid int"

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_person_split_and_exact(spark):
    rnd = random.Random(7)
    base = dt.date(2005, 1, 1)
    # person "hot" holds ~90% of the messages, all inside one bucket
    msgs = [("u", base + dt.timedelta(days=rnd.randint(0, 20)), "t", "hot" if i % 10 else f"p{i % 7}", i) for i in range(3000)]
    conds = [("d", c % 4, base + dt.timedelta(days=rnd.randint(0, 15)), None, "hot" if c % 2 else f"p{c % 7}", c) for c in range(40)]
    conds = [c[:3] + (c[2] + dt.timedelta(days=rnd.randint(0, 10)),) + c[4:] for c in conds]
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        m = spark.createDataFrame(msgs, MSG).repartition(8)
        c = spark.createDataFrame(conds, COND)
        out = link_by_interval(m, c, condition_key=F.col("Given_Name"))
        got = sorted((r["mid"], -1 if r["cid"] is None else r["cid"]) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    exp = []
    for mm in msgs:
        hits = [cc[5] for cc in conds if cc[4] == mm[3] and cc[2] <= mm[1] <= cc[3]]
        exp += [(mm[4], h) for h in hits] or [(mm[4], -1)]
    assert got == sorted(exp)
    assert "SortMergeJoin" in plan and "skew=true" in plan


def test_report_with_hot_user_and_code(spark):
    rows = [("hot", 1)] * 5000 + [(f"u{i}", 1) for i in range(50)] + [(None, 2)] * 3
    df = spark.createDataFrame(rows, "SynSocial_UID string, code long").repartition(8)
    rep = {r["Medical_Codes"]: r for r in exposure_report(df).collect()}
    assert rep[1]["User_Count"] == 51.0 and rep[1]["Message_Count"] == 5050.0 and rep[1]["Avg_Msg_per_User"] == 99.02
    assert rep[2]["User_Count"] == 1.0 and rep[2]["Message_Count"] == 3.0


def test_key_written_only_when_asked(spark, workdir):
    """T11: the key is returned, never printed, and written only on request."""
    b, m, out = (os.path.join(workdir, x) for x in ("b", "m", "out"))
    write_bundles(b)
    write_messages(m)
    res = run_jobs(spark, b, m, out)
    assert res.key and "key" not in res.paths and not os.path.exists(os.path.join(out, "KEY"))
