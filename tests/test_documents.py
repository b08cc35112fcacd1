"""Documents as files: one row, one file, read back by the document readers (A1, A3, A4, K1-K4)."""

import os

import pytest
from pyspark.sql import functions as F

from linkqueries import testdata as td
from linkqueries.queries import QUERIES
from privlink.operators.flatten import flatten_conditions, flatten_messages
from privlink.sources import files
from privlink.sources.files import packed, read_bundles, read_lineage_docs, read_message_docs, rejected_docs, write_docs

SF = "/root/testdata/sf0.001"


def _files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")]


def test_a_file_per_document_of_several_lines(spark, workdir):
    docs = td.bundle_documents(spark, SF).cache()
    write_docs(docs, f"{workdir}/b")
    files = _files(f"{workdir}/b")
    assert len(files) == docs.count() > 10
    assert all("\n" in open(f).read().strip() for f in files[:5])


def test_broken_documents_give_no_rows_and_are_known(spark, workdir):
    write_docs(td.bundle_documents(spark, SF), f"{workdir}/b")
    broken = [f for f in _files(f"{workdir}/b") if not open(f).read().rstrip().endswith("}")]
    assert broken
    seen = read_bundles(spark, f"{workdir}/b").select("entry", F.col("_metadata.file_name").alias("f")).where("entry IS NULL")
    assert {r["f"] for r in seen.collect()} == {os.path.basename(f) for f in broken}
    assert flatten_conditions(read_bundles(spark, f"{workdir}/b")).count() > 0


def test_folder_provenance_of_documents(spark, workdir):
    docs = spark.createDataFrame(
        [("Ann +50%", '{"messages":\n [{"text": "a", "user": {"id": "1"}}]}'), ("Ann +50%", '{"messages": [{"text": "b"}, {"text": "c"}]}'), ("Bo", '{"messages": [{"te'), ("Cy", '{"messages": []}')],
        "person string, document string",
    )
    write_docs(docs, f"{workdir}/m", folder="person")
    found = flatten_messages(read_message_docs(spark, f"{workdir}/m"), folder="person")
    assert sorted((r["filename"], r["text"]) for r in found.collect()) == [("Ann +50%", "a"), ("Ann +50%", "b"), ("Ann +50%", "c")]
    assert [r["path"].split("/")[-2] for r in rejected_docs(spark, f"{workdir}/m").collect()] == ["person=Bo"]


def test_arrays_of_catalogue_entities(spark, workdir):
    write_docs(td.lineage_documents(spark, SF), f"{workdir}/l")
    back = read_lineage_docs(spark, f"{workdir}/l")
    assert back.count() == td.lineage_docs(spark, SF).count()
    assert len(_files(f"{workdir}/l")) < back.count() / 10


def _layout(folder):
    """Texts by folder, whatever the files are called."""
    return sorted((os.path.relpath(os.path.dirname(f), folder), open(f, newline="").read()) for f in _files(folder))


def test_documents_are_plain_files_laid_out_as_spark_does(spark, workdir):
    odd = ["Ann +50%", "a/b", "x=y:z", "q\"'#*?", "{[]}^\\", "tab\there", "caf\u00e9/\U0001f600", "\U0001f600", "", None, "Ann +50%"]
    rows = [(p, None if i == 3 else f"{{\"n\":\n {i}, \"t\": \"\u00fc\"}}") for i, p in enumerate(odd)]
    docs = spark.createDataFrame(rows, "`per son` string, document string").repartition(3)
    write_docs(docs, f"{workdir}/m", folder="per son")
    docs.select("document", "per son").write.option("maxRecordsPerFile", 1).partitionBy("per son").text(f"{workdir}/spark")
    assert _layout(f"{workdir}/m") == _layout(f"{workdir}/spark")
    # checksum files mean Hadoop's local file system, which starts processes for each file
    assert not [f for _, _, names in os.walk(workdir + "/m") for f in names if f.endswith(".crc")]
    assert {e for e in os.listdir(f"{workdir}/m") if "=" not in e} == {"_SUCCESS"}


def test_documents_are_overwritten_only_by_a_whole_write(spark, workdir):
    write_docs(spark.createDataFrame([("old",), ("older",)], "document string"), f"{workdir}/d")
    broken = spark.range(50, numPartitions=4).select(F.when(F.col("id") == 49, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("document"))
    with pytest.raises(Exception, match="stop"):
        write_docs(broken, f"{workdir}/d")
    assert [t for _, t in _layout(f"{workdir}/d")] == ["old\n", "older\n"]
    write_docs(spark.createDataFrame([("new",)], "document string"), f"{workdir}/d")
    assert _layout(f"{workdir}/d") == [(".", "new\n")]
    assert not [e for e in os.listdir(f"{workdir}/d") if e.startswith("_temporary")]
    write_docs(spark.createDataFrame([], "document string"), f"{workdir}/d")
    assert spark.read.text(f"{workdir}/d").count() == 0


def test_listing_of_many_folders_takes_few_tasks(spark, workdir):
    docs = spark.range(600).select(F.col("id").cast("string").alias("person"), F.lit('{"messages": [{"text": "a"}]}').alias("document"))
    write_docs(docs, f"{workdir}/m", folder="person")
    spark.sparkContext.setJobGroup("listing", "listing")
    back = read_message_docs(spark, f"{workdir}/m")
    spark.sparkContext._jsc.clearJobGroup()
    seen = spark.sparkContext.statusTracker()
    stages = [seen.getStageInfo(i) for j in seen.getJobIdsForGroup("listing") for i in seen.getJobInfo(j).stageIds]
    assert max((st.numTasks for st in stages), default=0) <= files.LISTING_TASKS < 600
    assert flatten_messages(back, folder="person").select("filename").distinct().count() == 600


@pytest.mark.parametrize("name", ["bundle_documents", "lineage_documents_dangling"])
def test_both_sides_of_a_join_share_one_pass_over_the_files(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Format: Parquet") >= 2
    assert "Format: JSON" not in plan


def test_packed_documents_keep_all_rows_in_few_tasks(spark, workdir):
    texts = [f'[{{"entity": {{"typeName": "hdfs_folder",\n "attributes": {{"qualifiedName": "q{i % 390}", "inputs": {"[]" if i % 2 else "null"}}}}}}}]' for i in range(400)]
    write_docs(spark.createDataFrame([(t,) for t in [*texts, '[{"entity": {"ty']], "document string"), f"{workdir}/l")
    docs = read_lineage_docs(spark, f"{workdir}/l")
    back = packed(docs, f"{workdir}/p")
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
    # by Spark's cost of a file, 32 files a task
    assert len(_files(f"{workdir}/p")) <= 4 < 400 / 32
