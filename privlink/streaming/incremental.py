"""Link newly arrived message files as a Structured Streaming job.

The batch jobs re-read the whole message folder every run. Here the file
source tracks which files were already processed (in the checkpoint), each
micro-batch is flattened and linked to the static condition table with the
same ``link_by_interval`` (stream-static joins, so every message is emitted
exactly once, with its matches), optionally protected, and appended to a
parquet folder. No state is kept across batches apart from the file log.

A message is linked to the conditions known when its batch runs. A condition
that arrives, or gets its end date, later does not reach messages that are
already linked, so the output can differ from a batch run over all files.

``trigger(availableNow=True)`` processes what is there and stops, which
suits a scheduled run; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.flatten import flatten_messages
from ..operators.link import LEVEL_DAYS, link_by_interval
from ..operators.privacy import encrypt_columns, hash_columns
from ..schemas import MESSAGE_DOC, PERSONAL_COLUMNS
from ..sources.files import messages_of_lines

_IDS = ["source_path", "message_pos", "condition_id"]


def message_stream(spark: SparkSession, path: str, as_lines: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame shaped like ``read_message_docs`` output; broken files
    and lines give no message."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if as_lines:
        return messages_of_lines(r.text(path))
    docs = r.schema(MESSAGE_DOC).option("mode", "PERMISSIVE").option("multiLine", "true").json(path)
    return docs.withColumn("path", F.col("_metadata.file_path"))


def link_messages_stream(
    spark: SparkSession,
    messages_path: str,
    conditions: DataFrame,
    out_path: str,
    *,
    checkpoint: str,
    as_lines: bool = False,
    **kw,
) -> StreamingQuery:
    """Start the incremental link over a folder of message files; returns
    the running query. Options as for ``link_stream``."""
    docs = message_stream(spark, messages_path, as_lines=as_lines)
    return link_stream(flatten_messages(docs, with_position=True), conditions, out_path, checkpoint=checkpoint, **kw)


def link_stream(
    messages: DataFrame,
    conditions: DataFrame,
    out_path: str,
    *,
    checkpoint: str,
    protect: str | None = None,
    key: str | bytes | None = None,
    hash_algo: str = "murmur3",
    level_days: tuple[int, ...] = LEVEL_DAYS,
    strict_dates: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Link a streaming message frame to the static condition table and
    append the (optionally protected) rows to a parquet folder.

    ``protect``: None (clear linked rows), ``"hash"`` or ``"encrypt"``
    (``key`` required for encryption and for keyed hashing).
    ``checkpoint`` is the folder that remembers which files are done. A job
    that is started again must name the same one, in the shared store.
    """
    linked = link_by_interval(messages, conditions, level_days=level_days, strict_dates=strict_dates)
    ids = [c for c in _IDS if c in linked.columns]
    if protect == "hash":
        k = key.encode("utf-8") if isinstance(key, str) else key
        linked = hash_columns(linked, PERSONAL_COLUMNS, algo=hash_algo, key=k).drop(*ids)
    elif protect == "encrypt":
        if not key:
            raise ValueError("encryption needs a key")
        row_id = [*ids, "code", "display"] if len(ids) == len(_IDS) else None
        linked = encrypt_columns(linked, key, PERSONAL_COLUMNS, row_id).drop(*ids)
    elif protect is not None:
        raise ValueError("protect must be None, 'hash' or 'encrypt'")
    w = linked.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
