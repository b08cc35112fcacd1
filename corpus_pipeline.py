"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, BPE encoding and decoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of ``documents``. Each prepares the session itself: it may be run alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from privlink.llm import bpe, decontaminate, langid, line_dedup, simhash
from privlink.llm.common import materialise, prepare
from privlink.llm.queries import TOKENIZER, language_sample


def _shielded(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that no operator reads under neutral names, so
    that they cannot clash with what operators add."""
    return docs.toDF(*(c if c in ("doc_id", "text", "lang") else f"column_{k}" for k, c in enumerate(docs.columns)))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language: those without one (null text, no letter) go.

    Learns from the labelled documents of its own input, the held-out third left out.
    A label that is itself ``und`` is a language like others, and without any
    label all texts with a letter stay.
    """
    prepare(spark)
    own = _shielded(docs)
    known = langid.predict_language(own, language_sample(docs), no_letter=None)
    return known.where("lang_pred IS NOT NULL").select(*own.columns).toDF(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share leave every text; ``n_chars`` follows
    the new text. Documents without a line left stay, with an empty text."""
    prepare(spark)
    own = _shielded(docs)
    done = line_dedup.drop_frequent_lines(own, min_docs=10, min_chars=1)
    for k, f in enumerate(docs.schema):
        if f.name == "n_chars":
            name = own.columns[k]
            done = done.withColumn(name, F.when(F.col("n_dropped") > 0, F.length("text").cast(f.dataType)).otherwise(F.col(name)))
    return done.select(*own.columns).toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest doc_id.

    Rows with equal doc_id and different texts are documents of their own, in
    order of a digest of the text. Of rows with equal doc_id and text the one
    with the smallest other values stays. Rows without a doc_id are in no
    position to stand for a group; all of them stay.
    """
    prepare(spark)
    own = _shielded(docs)
    own = own.withColumn("key", F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))))
    groups = simhash.simhash_groups(own, id_col="key", shingle=4, max_bits=4)
    heads = materialise(groups.where("key = component").select("key").distinct(), "simhash-heads")
    # some values have no order of their own: their text has
    plain = {f.name for f in own.schema if not isinstance(f.dataType, (MapType, ArrayType, StructType))}
    order = Window.partitionBy("key").orderBy(*(c if c in plain else F.col(c).cast("string") for c in own.columns if c not in ("key", "doc_id")))
    first = own.join(heads.hint("merge"), "key", "left_semi").withColumn("place", F.row_number().over(order)).where("place = 1")
    return first.select(own.columns[:-1]).union(own.where("doc_id IS NULL").select(own.columns[:-1])).toDF(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (within a tenth of its length in edits).

    Each row is judged by its own text, whatever other rows have its doc_id or none.
    """
    prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = _shielded(docs)
    own = own.withColumn("key", F.md5(F.concat_ws(" ", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))))
    found = materialise(decontaminate.benchmark_matches(own, benchmark, id_col="key").select("key").distinct(), "benchmark-hits")
    return own.join(found, "key", "left_anti").select(own.columns[:-1]).toDF(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every document left. The ids are written
    before they are decoded, so that a task has one Python worker at a time."""
    prepare(spark)
    both = bpe.bpe_decode(materialise(bpe.bpe_encode(docs, TOKENIZER), "pipeline-ids"), TOKENIZER, alone=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("bpe_tokens", token_stage),
]

#: SQL has no suffix automata, XXH64 or edit search; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
