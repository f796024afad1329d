"""Helpers shared by the training-data operators: shared scratch tables and grouped Arrow streams."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


class Scratch:
    """Intermediate Parquet tables in the cluster's shared checkpoint folder.

    Writing a table computes it once and cuts its lineage: a lost executor rereads files instead
    of repeating the upstream plan.  ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tallyrisk-llm/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
        """With ``batch_bytes``: Python functions of ``df`` get batches of about so many bytes, whatever the length of a row."""
        before = self.spark.conf.get(BATCH_BYTES)
        try:
            if batch_bytes:
                self.spark.conf.set(BATCH_BYTES, batch_bytes)
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        finally:
            if batch_bytes:
                self.spark.conf.set(BATCH_BYTES, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``keys``: tables that hold whole groups only, with the groups' start rows (and the end).

    A group that crosses batches is held back until it is complete, so memory holds one batch
    and one group.  Callers bound the group size (blocks).
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _starts(batch, keys)
        same = bool(held) and _key(held[-1], -1, keys) == _key(batch, 0, keys)
        if same and len(starts) == 1:
            held.append(batch)
            continue
        # rows before the last group's start are complete
        cut = int(starts[-1])
        done = held + ([batch.slice(0, cut)] if cut else [])
        if done:
            whole = pa.Table.from_batches(done).combine_chunks()
            yield whole, np.append(_starts(whole, keys), whole.num_rows)
        held = [batch.slice(cut)]
    if held:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield whole, np.append(_starts(whole, keys), whole.num_rows)


def _key(batch, i: int, keys: list[str]) -> tuple:
    i = i % batch.num_rows
    return tuple(batch.column(k)[i].as_py() for k in keys)


def _starts(batch, keys: list[str]) -> np.ndarray:
    change = np.zeros(batch.num_rows, dtype=bool)
    change[0] = True
    for k in keys:
        v = column(batch, k)
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def column(batch, name: str) -> np.ndarray:
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    return col.to_numpy(zero_copy_only=False)


def list_column(batch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls (copied out of any slice)."""
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    offsets = col.offsets.to_numpy()
    return col.values.to_numpy(zero_copy_only=False), offsets


def exact(df: DataFrame, condition, message: str) -> None:
    """Raise if any row fulfils ``condition``."""
    if df.filter(condition).limit(1).count():
        raise ValueError(message)


Runner = Callable[[SparkSession, str], DataFrame]
