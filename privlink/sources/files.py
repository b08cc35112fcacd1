"""Readers and writers for the pipeline's folders.

JSON inputs are read with a fixed schema (no inference pass over the data,
and a folder in which no file has a field still resolves). Multi-line JSON
documents are not splittable: one document is one task. Where message files
can be large, store them as JSON lines (one message per line) and use
``read_message_lines``, which Spark splits freely. Records that are no JSON
give no row; ``rejected_lines`` and ``rejected_docs`` have them.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BUNDLE, LINEAGE_DOC, MESSAGE, MESSAGE_DOC, RESOURCE
from ..session import conf_of, shuffles_released

# The two dialects of the hand-off CSV. "safe" keeps every text: NULL has a
# mark of its own, and line ends within a text are escaped before writing, so
# a file has a line for each row and Spark can split it. "original" is a plain
# header CSV as the original jobs wrote and read it (backslash escapes, outer
# blanks trimmed, a raw line end breaks a row, empty text reads as NULL).
NULL_MARK = "\\N"
CSV_SAFE = {"header": "true", "escape": '"', "nullValue": NULL_MARK, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_ORIGINAL = {"header": "true"}
DIALECTS = {"safe": CSV_SAFE, "original": CSV_ORIGINAL}

# Escapes of the safe dialect, in the order they are applied. A backslash in a
# written text always begins one of these.
_ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))

#: Bytes of a row group of the parquet hand-offs. The next job's scan splits at
#: row groups, so small ones give its CPU-heavy projections enough tasks.
ROW_GROUP_BYTES = 8 << 20

#: Codec of the parquet hand-offs: tokens are base64 of random bytes, of which
#: snappy saves nothing and zstd the quarter that base64 adds.
PARQUET_CODEC = "zstd"

#: Codec of the text hand-offs, which repeat names and dates in every row.
TEXT_CODEC = "gzip"

#: Tasks that list the folders of message documents. There can be a folder per
#: person, and Spark would start up to 10,000 tasks, most of a folder or two.
LISTING_TASKS = 256

#: What opening a file counts as, in bytes, when a folder of small documents is
#: packed. Spark's 4 MB would start a task for every 32 files.
OPEN_COST_BYTES = 256 << 10

_CORRUPT = "_corrupt_record"


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Folder of clinical bundle documents (one JSON document per file)."""
    return spark.read.schema(BUNDLE).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)


def read_resources(spark: SparkSession, path: str) -> DataFrame:
    """Folder of clinical resources, one JSON resource per line (bulk-export
    NDJSON). Splittable, unlike multi-line bundles; feeds
    ``conditions_from_resources`` / ``patients_from_resources``, which pass
    over lines that are no resource."""
    return spark.read.schema(RESOURCE).option("mode", "PERMISSIVE").json(path)


def read_message_docs(spark: SparkSession, path: str) -> DataFrame:
    """Folder of message documents; adds ``path``, the source file URI.
    A broken file gives a row with NULL ``messages`` (no messages)."""
    with conf_of(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(LISTING_TASKS)):
        docs = spark.read.schema(MESSAGE_DOC).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)
    return docs.withColumn("path", F.col("_metadata.file_path"))


def parsed_lines(lines: DataFrame) -> DataFrame:
    """(value, path, rec) of text lines that are not blank; ``rec`` has the
    message and ``_corrupt_record``, the line itself where it is no JSON object."""
    schema = StructType([*MESSAGE.fields, StructField(_CORRUPT, StringType())])
    rec = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return lines.where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("path"), rec.alias("rec"))


def messages_of_lines(lines: DataFrame) -> DataFrame:
    """Parsed lines shaped like ``read_message_docs``, with ``line``, a number
    that tells the lines of one run apart."""
    # a stream has no row numbers; random ones serve as well
    line = F.xxhash64(F.uuid()) if lines.isStreaming else F.monotonically_increasing_id()
    good = parsed_lines(lines).where(F.col(f"rec.{_CORRUPT}").isNull())
    return good.select(F.array(F.struct(*[F.col(f"rec.{f.name}") for f in MESSAGE.fields])).alias("messages"), "path", line.alias("line"))


def read_message_lines(spark: SparkSession, path: str) -> DataFrame:
    """Folder of JSON-lines message files (one message object per line),
    shaped like ``read_message_docs`` output so the same flatten applies.
    A line that is no JSON object gives no row (see ``rejected_lines``)."""
    return messages_of_lines(spark.read.text(path))


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line): the lines that ``read_message_lines`` leaves out."""
    bad = parsed_lines(spark.read.text(path)).where(F.col(f"rec.{_CORRUPT}").isNotNull())
    return bad.select("path", F.col("value").alias("line"))


def rejected_docs(spark: SparkSession, path: str) -> DataFrame:
    """(path, document): the files of a folder of documents that are no JSON."""
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    rec = F.from_json("value", StructType([*MESSAGE_DOC.fields, StructField(_CORRUPT, StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return whole.where(rec[_CORRUPT].isNotNull()).select("path", F.col("value").alias("document"))


def read_lineage_docs(spark: SparkSession, path: str) -> DataFrame:
    """Folder of catalogue entity documents (datasets and processes)."""
    return spark.read.schema(LINEAGE_DOC).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)


def packed(docs: DataFrame, path: str) -> DataFrame:
    """``docs``, rows of a folder of many documents, written as a table to ``path`` and
    read from there. A join of the documents with themselves then opens and parses each
    file once, not once a side, in tasks of some hundred files."""
    spark = docs.sparkSession
    with conf_of(spark, "spark.sql.files.openCostInBytes", str(OPEN_COST_BYTES)):
        write_parquet(docs, path)
    return spark.read.schema(docs.schema).parquet(path)


def write_docs(df: DataFrame, path: str, folder: str | None = None) -> None:
    """Write each row's ``document`` (a text) as a file of its own, in the layout that
    the document readers take; with ``folder``, under a partition folder named
    by that column. On a ``file:`` path tasks write the files themselves (see
    ``_write_doc_files``), elsewhere Spark's text writer does."""
    spark = df.sparkSession
    docs = df.select("document", *([folder] if folder else []))
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    if uri.getScheme() == "file":
        _write_doc_files(docs, uri.getPath(), folder)
        spark.catalog.refreshByPath(path)
        return
    w = docs.write.mode("overwrite").option("maxRecordsPerFile", 1)
    with shuffles_released(spark):
        (w.partitionBy(folder) if folder else w).text(path)


#: Documents of one Arrow batch on their way to files. Documents can be long.
DOC_BATCH_ROWS = 256

# What Spark escapes in the names of partition folders, and the folder of NULL.
_ESCAPED_IN_FOLDERS = r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]"""
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# File of a task attempt that lists where its documents belong.
_PLACES = "places"


def _write_doc_files(docs: DataFrame, target: str, folder: str | None) -> None:
    """``write_docs`` on a mounted file system. Hadoop's local file system, without its
    native library, starts ``chmod`` processes for each file it makes, which cost more
    than the files; plain files need none. Each task attempt writes to a folder of
    its own under a hidden one; those of the attempts that Spark counts are then
    moved to ``target`` in a second job, so repeated attempts leave nothing."""
    spark = docs.sparkSession
    run = uuid.uuid4().hex
    staging = os.path.join(target, f"_temporary-{run}")
    # local names go to the workers with the functions, which then need no privlink there
    places_file, escaped, null_folder = _PLACES, _ESCAPED_IN_FOLDERS, _NULL_FOLDER

    def folder_text(text):
        return re.sub(escaped, lambda m: f"%{ord(m[0]):02X}", text)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        attempt = os.path.join(staging, f"{part}-{uuid.uuid4().hex}")
        os.makedirs(attempt)
        n = 0
        with open(os.path.join(attempt, places_file), "w", encoding="utf-8") as places:
            for batch in batches:
                folders = batch.column(1).to_pylist() if folder else [None] * batch.num_rows
                for document, value in zip(batch.column(0), folders):
                    place = f"{folder_text(folder)}={folder_text(value or null_folder)}" if folder else ""
                    name = f"part-{part:05d}-{run}-c{n:03d}.txt"
                    with open(os.path.join(attempt, name), "wb") as f:
                        f.write((document.as_py() or b"") + b"\n")
                    places.write(os.path.join(place, name) + "\n")
                    n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    def move(attempt):
        made = set()
        with open(os.path.join(attempt, places_file), encoding="utf-8", newline="\n") as places:
            for place in places:
                to = os.path.join(target, place.rstrip("\n"))
                at, name = os.path.split(to)
                if at not in made:
                    os.makedirs(at, exist_ok=True)
                    made.add(at)
                try:
                    os.replace(os.path.join(attempt, name), to)
                except FileNotFoundError:  # another attempt of this task has moved it
                    if not os.path.exists(to):
                        raise

    columns = [F.col("document").cast("binary").alias("document")]
    if folder:
        columns.append(F.col(folder).cast("string").alias("folder"))
    try:
        os.makedirs(staging)
        with shuffles_released(spark), conf_of(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(DOC_BATCH_ROWS)):
            attempts = [r["attempt"] for r in docs.select(*columns).mapInArrow(write, "attempt string").collect()]
        for e in os.scandir(target):  # what was there is overwritten
            if e.path != staging:
                shutil.rmtree(e.path) if e.is_dir(follow_symlinks=False) else os.unlink(e.path)
        if attempts:
            spark.sparkContext.parallelize(attempts, len(attempts)).foreach(move)
    finally:
        shutil.rmtree(staging, ignore_errors=True)
    open(os.path.join(target, "_SUCCESS"), "w").close()


def _replaced(c: Column, pairs) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _on_texts(df: DataFrame, pairs) -> DataFrame:
    return df.select(*[_replaced(F.col(f"`{f.name}`"), pairs).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema])


def read_csv(spark: SparkSession, path: str, schema, dialect: str = "safe") -> DataFrame:
    """Hand-off CSV with header and a fixed schema (binds by position)."""
    df = spark.read.options(**DIALECTS[dialect]).schema(schema).csv(path)
    return _on_texts(df, [(new, old) for old, new in reversed(_ESCAPES)]) if dialect == "safe" else df


def write_csv(df: DataFrame, path: str, single_file: bool = False, dialect: str = "safe") -> None:
    """Overwrite ``path`` with a header CSV. ``single_file`` is for small
    results (a per-code report, a one-row table): their rows are computed in
    parallel and only the finished ones go to the one writer. Large tables in the
    safe dialect are packed, a file per task; the next job has a task for each."""
    out = _on_texts(df, _ESCAPES) if dialect == "safe" else df
    w = (out.repartition(1) if single_file else out).write.mode("overwrite").options(**DIALECTS[dialect])
    with shuffles_released(df.sparkSession):
        (w if single_file or dialect != "safe" else w.option("compression", TEXT_CODEC)).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Rows as packed JSON lines, which the line readers take."""
    with shuffles_released(df.sparkSession):
        df.write.option("compression", TEXT_CODEC).json(path)


def write_parquet(df: DataFrame, path: str, single_file: bool = False, append: bool = False) -> None:
    out = df.repartition(1) if single_file else df
    w = out.write.mode("append" if append else "overwrite").option("parquet.block.size", ROW_GROUP_BYTES).option("compression", PARQUET_CODEC)
    with shuffles_released(df.sparkSession):
        w.parquet(path)


def _on_its_file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a written table."""
    fs, p = _on_its_file_system(spark, path)
    return fs.getContentSummary(p).getLength()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written table, through Spark's own file systems."""
    fs, p = _on_its_file_system(spark, path)
    fs.delete(p, True)
