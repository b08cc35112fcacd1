"""Plan shapes that the scale design relies on."""

import pytest

from linkqueries.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString(), df


@pytest.mark.parametrize("name", ["link_by_interval", "exposure_report_clear", "exposure_report_encrypted", "link_from_nested"])
def test_no_nested_loop_or_cartesian(spark, name):
    plan, _ = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "__pl_key" in plan and "__pl_bucket" in plan


def test_link_join_keys_and_pruned_scans(spark):
    plan, df = _plan(spark, "link_by_interval")
    df.collect()  # final adaptive plan
    final = df._jdf.queryExecution().executedPlan().toString()
    # days are matched once, messages meet them in one outer equi-join; no anti join is left
    assert "LeftAnti" not in final and final.count("LeftOuter") <= 2 and "Inner" in final
    days = [ln for ln in final.splitlines() if "__pl_level" in ln and "Join" in ln]
    assert days and all("l_orderkey" not in ln for ln in days)  # whole messages are not looked up
    # lineitem read with only the columns the link needs, filters pushed
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," in plan
    assert "l_quantity" not in plan and "l_extendedprice" not in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_report_aggregates_before_each_shuffle(spark):
    plan, _ = _plan(spark, "exposure_report_clear")
    lines = [ln.strip(" :+-") for ln in plan.splitlines()]
    # each aggregation Exchange sits on top of a (partial) HashAggregate
    checked = 0
    for i, ln in enumerate(lines):
        if ln.startswith("Exchange hashpartitioning(code") or ln.startswith("Exchange hashpartitioning(SynSocial_UID"):
            assert lines[i + 1].startswith("HashAggregate"), lines[i : i + 2]
            checked += 1
    assert checked == 2, plan
    # the analysis keeps matched rows only, so the link under it is inner
    assert "Inner" in plan and "LeftOuter" not in plan and "LeftAnti" not in plan


def test_protection_stays_in_codegen(spark):
    for name in ("hashed_copy_hmac", "encrypt_decrypt_roundtrip"):
        plan, df = _plan(spark, name)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "PythonUDF" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_single_files_take_finished_rows(spark, workdir):
    """The one writer of a report gets aggregated rows through an exchange."""
    from privlink.sources.files import write_csv, write_parquet

    seen = []
    report = QUERIES["exposure_report_clear"](spark, SF)
    for write in (write_csv, write_parquet):
        write(report, f"{workdir}/{write.__name__}", single_file=True)
    for folder in (f"{workdir}/write_csv", f"{workdir}/write_parquet"):
        seen.append(spark.read.option("header", True).csv(folder).rdd.getNumPartitions() if "csv" in folder else spark.read.parquet(folder).rdd.getNumPartitions())
    assert seen == [1, 1]
    plan = report.repartition(1)._jdf.queryExecution().executedPlan().toString()
    lines = [ln.strip(" :+-") for ln in plan.splitlines()]
    at = next(i for i, ln in enumerate(lines) if ln.startswith("Exchange SinglePartition") or ln.startswith("Exchange RoundRobinPartitioning(1)"))
    assert any("HashAggregate" in ln for ln in lines[at + 1 : at + 4])


def test_each_token_is_decoded_and_checked_once(spark):
    df = QUERIES["encrypt_decrypt_roundtrip"](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # eight columns: one decryption each
    assert text.count("try_aes_decrypt") <= 8 or text.count("AES") <= 24


def test_a_copy_is_scanned_once_for_both_analyses(spark, workdir):
    import os

    from pyspark.sql import functions as F

    from linkqueries import testdata as td
    from privlink.functions.crypto import new_key
    from privlink.plans.jobs import PATIENTS, SOCIAL, Hop, job_analysis, job_link, job_privacy

    hop = Hop(spark, workdir, "parquet")
    hop.write(td.messages(spark, SF).select("SynSocial_UID", "name", "screen_name", F.date_format("created_at", "EEE MMM dd HH:mm:ss +0000 yyyy").alias("created_at"), "text", "filename"), SOCIAL)
    cond = td.conditions(spark, SF).select("display", F.col("code").cast("long").alias("code"), F.col("assertedDate").cast("string"), F.col("abatementDate").cast("string"), "Given_Name", "Identifier", "Synthea_UID", "Family_Name")
    hop.write(cond, PATIENTS)
    job_link(hop)
    job_privacy(hop, new_key())
    out = job_analysis(hop, "hash")
    assert spark.read.parquet(out["analysis-hash"]).count() == 40
    assert spark.read.parquet(out["analysis-hash-stats"]).count() == 1
    assert not [f for f in os.listdir(workdir) if f.startswith("_counts")]  # the stage is gone

