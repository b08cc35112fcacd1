"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Rows of one Arrow batch. Texts can be long, so batches stay short.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Arrow batches of at most BATCH_ROWS rows, so that a task holds few texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the table instead of running
    the steps before it again) and gives Catalyst the table's real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``; a batch without rows is skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """A text column as Python strings, null as the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


T = TypeVar("T")
_KEPT: list[tuple[Hashable, object]] = []


def kept(key: Hashable, build: Callable[[], T]) -> T:
    """What ``build`` makes, once in each Python worker for the same key.

    A worker serves task after task of different operators and keeps only the
    last one's model.
    """
    if not _KEPT or _KEPT[0][0] != key:
        _KEPT.clear()
        gc.collect()  # a model may hold itself in a cycle
        pa.default_memory_pool().release_unused()
        _KEPT.append((key, build()))
    return _KEPT[0][1]
