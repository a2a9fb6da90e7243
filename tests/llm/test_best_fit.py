"""Best-fit packing against a literal best-fit decreasing and the tokenizer library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import SF, edge_rows, frame, words
from tillsight.llm import best_fit, registry, tokens, word_tokens

WORD = "word_bpe_49k.json"
ODD = ["a", " ", "  ", "\n", "the", "é", ".", ",", "...", "<|endoftext|>", "<|startoftext|>", "'s", "12", "日本", "\t", "X",
       "!", " b", "\r\n", "🙂", "\x1c", " ", "ſ", "́", "don't", "×", "ª", "İ", "İi", "Σ", "ΑΣ", "ß", "Ǆ", "É", "각",
       "ᄀ", "ᅡ", " ", "K"]


def ids_of(texts, end=1):
    t = tokens.BatchEncoder(tokens.tokenizer_path(WORD)).tokenizer
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def literal(sizes, capacity):
    """Number of windows that best-fit decreasing opens, one piece after the other."""
    left = []
    for s in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= s]
        if fits:
            left[min(fits)[1]] -= s
        else:
            left.append(capacity - s)
    return len(left)


def test_word_encoder_equals_the_library():
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(0, 25))) for _ in range(5000)] + [None, "", words(3000)]
    enc = word_tokens.WordEncoder(tokens.tokenizer_path(WORD), max_words=500)
    assert enc.by_space
    for lo in range(0, len(texts), 700):
        ids, bounds = enc.encode(pa.array(texts[lo:lo + 700], pa.string()))
        for i, want in enumerate(ids_of(texts[lo:lo + 700])):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want[:-1]
    assert enc.encode(pa.array([], pa.string()))[1].tolist() == [0]
    assert not word_tokens.WordEncoder(tokens.tokenizer_path("byte_bpe_50k.json")).by_space


def test_tree_finds_the_tightest():
    rng = random.Random(1)
    for capacity in (1, 7, 64, 100):
        tree, held = best_fit.CapacityTree(capacity), []
        for _ in range(300):
            if held and rng.random() < 0.4:
                tree.add(held.pop(rng.randrange(len(held))), -1)
            else:
                held.append(rng.randint(0, capacity))
                tree.add(held[-1], 1)
            size = rng.randint(0, capacity)
            assert tree.tightest(size) == min((r for r in held if r >= size), default=None)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 20, 64, 100])
    sizes = [rng.randint(1, capacity) if seed % 2 else min(capacity, 1 + int(rng.expovariate(5 / capacity)))
             for _ in range(rng.randint(0, 400))]
    counts = defaultdict(int)
    for s in sizes:
        counts[s] += 1
    places = best_fit.Places(dict(counts), capacity)
    assert places.windows == literal(sizes, capacity)
    held = defaultdict(list)
    for s, n in counts.items():
        for q, o in zip(*places.find(np.full(n, s), np.arange(n)), strict=True):
            held[q].append((o, s))
    assert len(held) == places.windows
    for pieces in held.values():
        at = 0
        for o, s in sorted(pieces):
            assert o == at
            at += s
        assert at <= capacity


def test_plan_size_depends_on_the_window_alone():
    few, many = ({s: f * (1 + s % 97) for s in range(1, 4097)} for f in (10, 10 ** 9))
    assert len(best_fit.Places(many, 4096).first) <= 4 * len(best_fit.Places(few, 4096).first) < 100_000


def check(got, rows, window, windows=None):
    texts = [t for _, t in rows]
    want = defaultdict(list)
    sizes = []
    for (d, _), ids in zip(rows, ids_of(texts), strict=True):
        cuts = [ids[i:i + window] for i in range(0, len(ids), window)]
        sizes += [len(c) for c in cuts]
        for k, c in enumerate(cuts):
            want[d, k, k * window, len(c)].append(zlib.crc32(np.array(c, dtype="<u4").tobytes()))
    held = defaultdict(list)
    for r in got:
        want[r.doc_id, r.piece, r.start, r.length].remove(r.ids_crc32)
        held[r.sequence_id].append((r.offset, r.length))
    assert not any(want.values())
    for pieces in held.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= window
    assert len(held) == literal(sizes, window)


def test_op12_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(registry.op12_best_fit(spark, SF).collect(), rows, 4096)


def test_edges(spark):
    from pyspark.sql import functions as F

    rows = edge_rows()
    for window in (4096, 16, 1):
        got = best_fit.pack_best_fit(frame(spark, rows).repartition(3), tokenizer=WORD, window=window)
        if window > 1:
            check(got.withColumn("ids_crc32", F.crc32("ids")).collect(), rows, window)
        else:
            assert got.groupBy("sequence_id").count().where("count > 1").isEmpty()
    assert best_fit.pack_best_fit(frame(spark, []), tokenizer=WORD).collect() == []
