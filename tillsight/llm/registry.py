"""The operators of this package bound to the test tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import (
    best_fit,
    collocations,
    decontaminate,
    html_text,
    jaccard_join,
    nearest,
    packing,
    pii,
    repeats,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from tillsight.llm.common import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written in ascending doc_id order and read back, with each document's offset and checksum."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer=BYTE_BPE)
    return token_files.with_checksum(token_files.read_token_files(spark, path))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document within the edit budget, with its least distance."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 100-byte strings that occur earlier."""
    return repeats.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


#: the fold that is kept out of training
HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    """The model learned from the labels outside the held-out fold."""
    return toxicity.fit(toxicity.training_rows(docs, labels, where=~F.expr(HELD_OUT)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, from a lexicon learned on the training fold."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity_model(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", "predicted",
                                              "n_terms")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every document."""
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts through a digest cache that starts empty."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer=PIECE_BPE)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of shingles and the component of its near duplicates."""
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100, found by tree search."""
    return nearest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def packed_digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into windows of 1024 tokens."""
    return packed_digest(packing.pack(_table(spark, sf_dir, "documents"), tokenizer=BYTE_BPE))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract_main_text(_table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding projected on the 16 leading directions of all distinct embeddings, with unit variance."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into as few windows of 4096 tokens as best-fit decreasing needs."""
    packed = best_fit.pack_best_fit(_table(spark, sf_dir, "documents"), tokenizer=WORD_BPE)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id",
                         "offset")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best phrases of 2 to 5 words."""
    return collocations.mine(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_decontamination": op2_decontamination,
    "op3_repeated_strings": op3_repeated_strings,
    "op4_toxicity": op4_toxicity,
    "op5_personal_data": op5_personal_data,
    "op6_token_counts": op6_token_counts,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_nearest": op8_nearest,
    "op9_packing": op9_packing,
    "op10_main_text": op10_main_text,
    "op11_whitening": op11_whitening,
    "op12_best_fit": op12_best_fit,
    "op13_collocations": op13_collocations,
}

#: none of these can be written in SQL: tokenizers, learned models and iterative joins; the tests hold them to brute force
ORACLE: dict[str, str] = {}
