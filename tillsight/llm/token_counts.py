"""Token counts (operator 6) with a digest cache.

The cache is a Parquet table of (digest, version, n_tokens): the digest of a
text's normalised content, the digest of the tokenizer's vocabulary, and the
stored count.  A call joins the documents' digests to the cache, encodes each
distinct text that is not there once, appends those counts, and joins again.

Normalisation must not change a count, so the default only turns null into the
empty text; ``normalise`` may widen it (a Column function) where the tokenizer
is known to ignore the difference.

Copies of one text are dropped inside each task before the shuffle, so a text
that a third of all rows share reaches the encoder at most once per task, and
its rows meet the cache in a sort-merge join that AQE can split.  Empty tables
give no rows; rows with equal ids are all returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.common import id_and_text, scratch_path, slices, worker_state
from tillsight.llm.tokens import tokenizer_path

CACHE_SCHEMA = "digest binary, version string, n_tokens int"


def tokenizer_version(name: str) -> str:
    """Digest of the vocabulary file."""
    import hashlib

    with open(tokenizer_path(name), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _counter(name: str) -> Callable[[list[str]], list[int]]:
    store = worker_state().setdefault("counters", {})
    if name not in store:
        path = tokenizer_path(name)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            store[name] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tillsight.llm.tokens import encoder

            enc = encoder(path)
            store[name] = lambda texts: [b - a for a, b in _pairs(enc.encode(pa.array(texts, pa.string()))[1].tolist())]
    return store[name]


def _pairs(bounds: list[int]) -> Iterator[tuple[int, int]]:
    return zip(bounds[:-1], bounds[1:], strict=True)


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; an empty table is created where there is none."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def count_tokens(docs: DataFrame, *, tokenizer: str, cache_path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 4096,
                 normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row.

    ``cache_path`` is a folder all executors see; None starts a new cache in
    the shared checkpoint folder.
    """
    spark = docs.sparkSession
    cache_path = cache_path or scratch_path(spark, "token-counts")
    version = tokenizer_version(tokenizer)
    content = normalise(F.col("text")) if normalise else F.col("text")
    rows = (id_and_text(docs, id_col, text_col)
            .select("doc_id", content.alias("text"), F.octet_length("text").cast("long").alias("n_bytes"))
            .withColumn("digest", F.unhex(F.sha2("text", 256))))

    def known(cache: DataFrame) -> DataFrame:
        return cache.where(F.col("version") == version).select("digest", "n_tokens")

    cache = open_cache(spark, cache_path)
    _append_misses(rows, known(cache), tokenizer, version, cache_path)
    counts = known(spark.read.schema(CACHE_SCHEMA).parquet(cache_path)).dropDuplicates(["digest"])
    return (rows.select("doc_id", "n_bytes", "digest").join(counts, "digest")
            .select("doc_id", "n_bytes", F.col("n_tokens").cast("long").alias("n_tokens"),
                    (F.col("n_tokens") > limit).alias("over_limit")))


def _append_misses(rows: DataFrame, known: DataFrame, tokenizer: str, version: str, path: str) -> None:
    """Encode every distinct text without a stored count once, and append the counts."""

    def distinct_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            new = {d.as_py(): i for i, d in enumerate(b.column(0)) if d.as_py() not in seen}
            seen |= new.keys()
            if len(seen) > 2_000_000:  # copies beyond this only cost a second shuffle row
                seen = set()
            texts = b.column(1).take(pa.array(list(new.values()), pa.int64())).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary()),
                                              pa.array([pack(t) for t in texts], pa.binary())], ["digest", "packed"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        unpack = zstandard.ZstdDecompressor().decompress
        last = None
        for b in batches:
            digests, texts, counts = [], [], []
            size = 0
            for d, p in zip(b.column(0), b.column(1), strict=True):
                d = d.as_py()
                if d == last:  # sorted: the copies of a text follow each other
                    continue
                last = d
                digests.append(d)
                texts.append(unpack(p.as_py()).decode())
                size += len(texts[-1])
                if size > 1 << 20:
                    counts += count(texts)
                    texts, size = [], 0
            counts += count(texts) if texts else []
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()),
                                              pa.array([version] * len(digests), pa.string()),
                                              pa.array(counts, pa.int32())], ["digest", "version", "n_tokens"])

    texts = rows.select("digest", "text").mapInArrow(distinct_here, "digest binary, packed binary")
    (texts.join(known, "digest", "left_anti").repartition("digest").sortWithinPartitions("digest")
     .mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(path))
