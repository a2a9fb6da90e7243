"""Token-id files (operator 1): Parquet list columns that can be read selectively.

``write_token_files`` encodes every text and writes one row per document, in
ascending id order: part files follow each other by id, and so do the rows of
a file.  Token ids are dictionary encoded (a vocabulary below 64k ids takes two
bytes a token before compression); ids, counts and offsets are delta encoded
(Parquet v2 pages without a dictionary).  Row groups and pages are bounded, and
their page index lets a reader fetch a range of documents, or only the counts
and offsets, without touching the token pages.

Null text counts as empty.  Rows with equal ids are all kept, in the order of
their texts' digests.  An empty table gives no rows.  Only the id and text
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillsight.llm.common import id_and_text, slices
from tillsight.llm.tokens import encoder, tokenizer_path, with_end

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
_FILE_SCHEMA = "shard int, doc_id long, n_tokens int, shard_start long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, *, tokenizer: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int | None = 0, row_group_bytes: int = ROW_GROUP_BYTES,
                      page_bytes: int = PAGE_BYTES) -> None:
    """Encode ``docs`` and write the token files to ``path`` (a folder every executor sees).

    ``tokenizer`` is a vocabulary name resolved on each executor.  ``end_id``
    is appended to every document (None: nothing is).  Documents are range
    partitioned by (id, digest of the text), so equal ids spread over tasks.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path(tokenizer))
        shard, done = TaskContext.get().partitionId(), 0
        for b in slices(batches):
            ids, bounds = enc.encode(b.column(1))
            if end_id is not None:
                ids, bounds = with_end(ids, bounds, end_id)
            sizes = np.diff(bounds)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sizes), shard, np.int32)), b.column(0), pa.array(sizes.astype(np.int32)),
                 pa.array(done + bounds[:-1]), lists],
                ["shard", "doc_id", "n_tokens", "shard_start", "ids"])
            done += int(bounds[-1])

    rows = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = rows.withColumn("_digest", F.xxhash64("text"))
    ordered = (keyed.repartitionByRange("doc_id", "_digest")
               .sortWithinPartitions("doc_id", "_digest").select("doc_id", "text"))
    (ordered.mapInArrow(encode, _FILE_SCHEMA).write
     .option("compression", "zstd")
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", page_bytes)
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", "true")
     .parquet(path))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, shard, shard_start)`` from the metadata columns alone; no token page is read.

    ``start`` counts the tokens of all documents before this one.  The offsets
    of the shards are a running sum over one row per file.
    """
    rows = spark.read.schema(_FILE_SCHEMA).parquet(path).select("shard", "doc_id", "n_tokens", "shard_start")
    return _with_start(rows)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the files: ``token_index`` plus the ``ids`` themselves."""
    return _with_start(spark.read.schema(_FILE_SCHEMA).parquet(path))


def _with_start(rows: DataFrame) -> DataFrame:
    # one row per part file, so both the window and the broadcast are bounded by the number of files
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("_size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(offsets), "shard")
            .withColumn("start", F.col("_before") + F.col("shard_start")).drop("_before"))


def with_checksum(rows: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``: the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")).cast("B")
            at = np.asarray(ids.offsets).astype(np.int64) * 4
            sums = [zlib.crc32(data[a:z]) for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(3)] + [pa.array(sums, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (rows.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids")
            .mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long"))
