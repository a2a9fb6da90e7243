"""Encoder, token files, token counts and packing against the tokenizer libraries."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, edge_rows, frame, words
from tillsight.llm import packing, registry, token_counts, token_files, tokens
from tillsight.llm.common import scratch_path

BPE = "byte_bpe_50k.json"
ODD = ["a", " ", "  ", "\n", "the", "é", ".", ",", "...", "<|endoftext|>", "'s", "12", "日本", " ", "\t", "X", "!", " b",
       "\r\n", "🙂", "\x1c", " ", "ſ", "́", "don't", "×", "ª"]


def ids_of(texts, name=BPE, end=True):
    t = tokens.BatchEncoder(tokens.tokenizer_path(name)).tokenizer
    found = t.encode_batch([x or "" for x in texts], add_special_tokens=False)
    return [np.array(e.ids + [0] * end, dtype="<u4") for e in found]


@pytest.mark.parametrize("name", [BPE, "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(0, 25))) for _ in range(3000)] + [None, "", words(3000)]
    enc = tokens.BatchEncoder(tokens.tokenizer_path(name), max_words=500)
    for lo in range(0, len(texts), 700):  # the store starts afresh in between
        ids, bounds = enc.encode(pa.array(texts[lo:lo + 700], pa.string()))
        for i, want in enumerate(ids_of(texts[lo:lo + 700], name, end=False)):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want.tolist()
    assert enc.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_words_are_stored_by_pre_token():
    stems = ["bleon", "Er\u00e9ant", "hand", "Wher", "x1y", "\u00dfkeit", "23"]
    tails = ["", ".", "&&&", "$$$", ",%%%", "!!", ")", '"']
    texts = [" ".join(f"{a}{t}\n{b}{u}" for b in stems for u in tails) for a in stems for t in tails]
    texts += [f"({a}-{b}/{t or '_'}" for a in stems for b in stems for t in tails]
    enc = tokens.BatchEncoder(tokens.tokenizer_path(BPE))
    ids, bounds = enc.encode(pa.array(texts))
    for i, want in enumerate(ids_of(texts, end=False)):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == want.tolist()
    assert enc.count < 60  # of about 3,500 distinct words
    # no cut where a line end or an apostrophe joins its neighbours
    texts = ["a\n\nb c", "a \nb c", "a\n b", "a.\n", "\na.", "a'snd b's 's", "a.\r\nb", "a\n\u00a0b", "a.\u0301b", "\u00b2a \u00aa1"]
    ids, bounds = enc.encode(pa.array(texts))
    for i, want in enumerate(ids_of(texts, end=False)):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == want.tolist()


def test_token_files_round_trip(spark):
    rows = edge_rows()
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(frame(spark, rows), path, tokenizer=BPE)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    want = defaultdict(list)
    for (d, _), ids in zip(rows, ids_of([t for _, t in rows]), strict=True):
        want[d].append(ids.tolist())
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
        want[r.doc_id].remove(r.ids)
    # the index reads no token pages
    plan = token_files.token_index(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan
    empty = scratch_path(spark, "test-tokens")
    token_files.write_token_files(frame(spark, []), empty, tokenizer=BPE)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_op1_and_op9_on_all_documents(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    ids = dict(zip([d for d, _ in docs], ids_of([t for _, t in docs]), strict=True))
    got = {r.doc_id: r for r in registry.op1_token_files(spark, SF).collect()}
    at = 0
    for d, x in ids.items():
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(x), zlib.crc32(x.tobytes()))
        at += len(x)
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in registry.op9_packing(spark, SF).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for d, x in ids.items():
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(x)
            assert r.ids_crc32 == zlib.crc32(x[at:at + r.length].tobytes())
            at += r.length
        assert at == len(x)
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert sum(map(len, ids.values())) > 0.95 * 1024 * len(windows)


def test_packing_edges(spark):
    rows = edge_rows()
    got = packing.pack(frame(spark, rows), tokenizer=BPE, window=128, max_piece=32, block=50).collect()
    want = sum(len(x) for x in ids_of([t for _, t in rows]))
    assert sum(r.length for r in got) == want == sum(len(r.ids) // 4 for r in got)
    assert packing.pack(frame(spark, []), tokenizer=BPE).count() == 0
    with pytest.raises(ValueError):
        packing.pack(frame(spark, []), tokenizer=BPE, window=10, max_piece=11)


def test_differencing():
    rng = random.Random(5)
    for _ in range(50):
        sizes = [rng.randrange(1, 257) for _ in range(rng.randrange(0, 200))]
        windows = packing.pack_sizes(sizes, 1024)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= 1024 for w in windows)
    # opposed imbalances: the textbook example reaches 16 / 14
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]
    # the number rises when a window would be too full
    assert len(packing.pack_sizes([600, 600, 600], 1024)) == 3


def test_token_counts_and_cache(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_path("piece_bpe_32k.model"))
    rows = edge_rows()
    df = frame(spark, rows)
    path = scratch_path(spark, "test-cache")
    for _ in range(2):
        got = token_counts.count_tokens(df, tokenizer="piece_bpe_32k.model", cache_path=path, limit=50).collect()
        want = sorted(((d is not None, d or 0), len((t or "").encode()), len(model.encode(t or ""))) for d, t in rows)
        assert sorted(((r.doc_id is not None, r.doc_id or 0), r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 50) for r in got)
        cache = spark.read.parquet(path)
        assert cache.count() == len({t or "" for _, t in rows}) == cache.select("digest").distinct().count()
    # another tokenizer has counts of its own in the same cache
    got = token_counts.count_tokens(df, tokenizer=BPE, cache_path=path).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(x) for x in ids_of([t for _, t in rows], end=False))
    assert token_counts.count_tokens(frame(spark, []), tokenizer=BPE).count() == 0


def test_op6_on_all_documents(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in registry.op6_token_counts(spark, SF).collect()}
    assert got == {r.doc_id: (len(r.t.encode()), n, n > 4096)
                   for r, n in ((r, len(model.encode(r.t))) for r in docs)}
