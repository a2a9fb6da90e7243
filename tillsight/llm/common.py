"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder (visible to all executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: evaluated once, lineage cut, no executor holds it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, as ``doc_id`` and ``text`` (null text: empty)."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def worker_state() -> dict:
    """A dict that lives across the tasks of one stage in a Python worker process.

    Workers serve one stage after the other; what a stage kept (a tokenizer and its
    words, say) is dropped when the worker turns to another.
    """
    state = sys.modules.setdefault("_tillsight_llm_worker", types.ModuleType("_tillsight_llm_worker")).__dict__
    task = TaskContext.get()
    stage = task.stageId() if task else None
    kept = state.get("kept")
    if kept is None or state.get("stage") != stage:
        state["stage"], kept = stage, {}
        state["kept"] = kept
    return kept


def give_back() -> None:
    """Return the memory that this worker has freed to the system: it waits for its next task for as long as it lives."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of text (or one row)."""
    worker_state()
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(b.schema.get_field_index(text))
        ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi
    give_back()


def binary_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values ``data[bounds[i]:bounds[i+1]]`` of a contiguous array, without a copy."""
    width = data.dtype.itemsize
    offsets = np.ascontiguousarray(bounds * width, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
                                 ).cast(pa.binary())
