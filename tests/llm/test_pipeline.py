import subprocess
import sys

import pytest

import corpus_pipeline
from privlink.llm import decontaminate, queries
from privlink.llm.common import BATCH_ROWS

from .conftest import ODD, REPO, SF
from .test_bpe import expected
from .test_line_dedup import brute as brute_lines
from .test_simhash import brute_components


def brute(spark, documents):
    """(doc_id, ids) of the documents left, stage by stage in plain Python."""
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    rows = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    rows = [(int(i), t) for i, t, *_ in brute_lines(rows, 10)]
    heads = {int(c) for *_, c in brute_components(rows)}
    rows = [r for r in rows if r[0] in heads]
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    pieces = decontaminate.Pieces(list(enumerate(items)), decontaminate.ERROR_RATE)
    rows = [r for r in rows if not pieces.matches(decontaminate.normalise(r[1]))]
    return sorted((i, expected(t), t) for i, t in rows)


def test_pipeline_equals_brute_force(spark, documents):
    got = sorted((r.doc_id, r.ids, r.decoded) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == brute(spark, documents)
    assert 0 < len(got) < documents.count()


def test_stages_keep_the_columns_of_documents(spark, docs_of, workdir):
    docs = docs_of(ODD)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert done.schema == docs.schema or done.dtypes == docs.dtypes
        done.write.parquet(f"{workdir}/{k}")
        docs = spark.read.parquet(f"{workdir}/{k}")


@pytest.mark.parametrize("k", range(5))
def test_each_stage_takes_odd_rows_and_an_empty_table(spark, docs_of, k):
    stage = corpus_pipeline.STAGES[k][1]
    assert stage(spark, docs_of([]), SF).collect() == []
    rows = [*ODD, (99, "word " * 30_000)]
    ids = [r.doc_id for r in stage(spark, docs_of(rows), SF).collect()]
    assert set(ids) <= {i for i, _ in rows}


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_a_stage_run_alone_takes_short_batches(spark, docs_of, k):
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(rows, "10000")
    corpus_pipeline.STAGES[k][1](spark, docs_of([(1, "one text")]), SF).collect()
    assert spark.conf.get(rows) == str(BATCH_ROWS)


def test_near_duplicates_leave_one_of_each_group(spark, docs_of):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "other words are here now"), (None, "a b c d e f")]
    left = corpus_pipeline.near_duplicate_stage(spark, docs_of(rows), SF).collect()
    assert sorted(str(r.doc_id) for r in left) == ["3", "9", "None"]


def test_equal_ids_leave_every_group_its_document(spark, docs_of):
    rows = [(5, "a b c d e f"), (5, "other words are here now"), (7, "a b c d e f"), (8, "other words are here now"), (8, "a third text of its own")]
    left = corpus_pipeline.near_duplicate_stage(spark, docs_of(rows), SF).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(5, "a b c d e f"), (5, "other words are here now"), (8, "a third text of its own")]


def test_a_label_called_und_is_a_language(spark, docs_of):
    from pyspark.sql import functions as F

    rows = [(i, f"deutsche worte nummer {'abcdefghij'[i % 10]}") for i in range(30)] + [(40, "..."), (41, None)]
    for label in (F.lit("und"), F.lit(None).cast("string")):
        left = corpus_pipeline.language_stage(spark, docs_of(rows).withColumn("lang", label), SF).collect()
        assert sorted(r.doc_id for r in left) == list(range(30))


def test_columns_without_an_order(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f")]).withColumn("extra_map", F.create_map(F.lit("k"), F.array(F.rand(1).cast("string"))))
    docs = docs.withColumn("nested", F.struct("extra_map", "doc_id"))
    left = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert [r.doc_id for r in left.collect()] == [5] and left.columns == docs.columns


def test_a_contaminated_row_takes_no_other_with_it(spark, docs_of):
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r.text or "") > 50)
    rows = [(None, f"before {item} after"), (None, "clean text"), (None, None), (4, item), (4, "clean too"), (4, item), (6, item)]
    left = corpus_pipeline.decontamination_stage(spark, docs_of(rows), SF).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in left) == [("4", "clean too"), ("None", "None"), ("None", "clean text")]


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the repository without these modules imports and has its other queries."""
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('privlink.llm'):\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


def test_registered_names():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
