"""Collocations against literal counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import SF, edge_rows, frame
from tillsight.llm import collocations, registry

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def literal(rows, least=100, top=2000, longest=5):
    """``rows``: (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        hidden = set()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    q = p[i:i + m]
                    if q in found and 100 * a >= 100 * found[q]:
                        hidden.add(q)
        best = []
        for p, a in found.items():
            if p not in hidden:
                score, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def mined(docs, **kw):
    df = collocations.mine(docs, **kw)
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dir_", [SF, "/root/testdata/sf0.01"])
def test_op13_equals_literal_counting(spark, dir_):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{dir_}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in registry.op13_collocations(spark, dir_).collect())
    assert got == literal(rows) and got


def corpus(seed, rows=120):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "the", "über", "日本", "é", "x y", "A", "of", "-", "🙂"]
    common = "the end of the story, it is said"
    out = []
    for _ in range(rows):
        words = [rng.choice(vocabulary[:rng.choice((2, 5, 12))]) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!?", " ; "]) for w in words)
        out.append((rng.choice([text, text + common, common, text + text]), rng.choice(["en", "en", "de", None, "und"])))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_corpora(spark, seed):
    rows = corpus(seed) + [(None, "en"), ("", None), (" \t ", "fr"), ("...", "fr"), ("one", "fr")]
    docs = frame(spark, [(i, t) for i, (t, _) in enumerate(rows)]).drop("lang")
    langs = spark.createDataFrame(list(enumerate(x for _, x in rows)), "doc_id long, lang string")
    docs = docs.join(langs, "doc_id").withColumnRenamed("phrase", "phrase")
    for least, top, period, bits in ((3, 2000, 4, 1 << 26), (2, 5, 32, 1 << 16)):
        assert mined(docs, min_count=least, top=top, period=period, filter_bits=bits) == literal(rows, least, top)


def test_long_repetition_and_edges(spark):
    """One word over and over (no cut, or a cut at every word) and texts without an end."""
    rows = [(" ".join(["na"] * 5000), "en"), (" ".join(["na", "batman"] * 3000), "en"), (" ".join(["x"] * 99), "de")]
    rows += [(t, "en") for _, t in edge_rows()]
    docs = spark.createDataFrame([(t, x, 1, "p") for t, x in rows], "text string, lang string, own int, words string")
    for period in (1, 2, 32):
        assert mined(docs, period=period) == literal(rows)
    assert mined(docs.limit(0)) == []
    assert mined(spark.createDataFrame([("a b", None)], "text string, lang string")) == []


def test_a_full_bit_table_loses_nothing(spark, monkeypatch):
    """A table far too small lets everything through, and the counts stay exact."""
    rows = corpus(9)
    docs = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(collocations.BitTable, "has", lambda self, h: np.ones(len(h), dtype=bool))
    assert mined(docs, min_count=4) == literal(rows, 4)


def test_equal_hashes_of_other_words(spark, monkeypatch):
    """Were all phrases to share one hash, their words would still be counted apart."""
    rows = corpus(11)
    docs = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(collocations._Hashed, "phrases", lambda self, at, n: np.full(len(at), 7, dtype=np.uint64))
    monkeypatch.setattr(collocations._Hashed, "among", lambda self, may, n, table: may.copy())
    assert mined(docs, min_count=4) == literal(rows, 4)


def test_counting_does_not_move_a_row_for_each_phrase(spark, monkeypatch):
    """Hashes and phrases travel as arrays, one row per bucket: no aggregate sees one row for each of them."""
    plans = {}
    whole = collocations.materialize
    monkeypatch.setattr(collocations, "materialize", lambda df, name: plans.setdefault(name, []).append(df) or whole(df, name))
    rows = corpus(5)
    assert mined(spark.createDataFrame(rows, "text string, lang string"), min_count=3) == literal(rows, 3)
    counts = [df._jdf.queryExecution().executedPlan().toString() for name in ("phrase-words", "phrase-hashes", "phrases") for df in plans[name]]
    assert len(counts) == 4
    assert not any("Aggregate" in plan for plan in counts)


def test_words_end_where_the_text_says(spark):
    """Only spaces and tabs part words, only .,;:!? and line ends part pieces; texts do not run together."""
    odd = ["a\x1c b\x1f c", "a\x85 b\u00a0 c\u2003", "x", "y", " x", "y ", "", "x\ty\x0bx\x0cy", "\u00c9t\u00c9 A\u0130 \ufeff.", "x.y", "x .", ". y"]
    odd += ["".join(["averyveryverylongword", end]) + " " + "z" * n for n in (1, 7, 8, 9, 16, 17) for end in ("", "1", "2")]
    rows = [(t, "en") for t in odd * 3] + [(" ".join(odd), "de")] * 2
    docs = spark.createDataFrame(rows, "text string, lang string")
    for period in (1, 3):
        assert mined(docs, min_count=2, period=period) == literal(rows, 2)


def test_rounds_of_ranking(spark):
    rows = [("en" if i % 3 else "de", f"p{i}", i % 7, i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "lang string, phrase string, score long, a long")
    got = {(r.lang, r.rank): r.phrase for r in collocations.top_ranked(df, 20, 2000, ranked=10).collect()}
    for lang in ("en", "de"):
        want = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[2], -r[3], r[1]))[:20]
        assert [got[lang, i + 1] for i in range(20)] == [r[1] for r in want]


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("en", "a", 4 * 10 ** 12), ("en", "b", 5 * 10 ** 12), ("en", "a b", 3 * 10 ** 12)],
                                    "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * 10 ** 17)], "lang string, n long")
    row = collocations.scored(phrases, totals).collect()[0]
    assert row.score == 1000 * 3 * 10 ** 12 * 9 * 10 ** 17 // (20 * 10 ** 24)
