"""Toxicity (operator 4): a learned weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms and case, invisible characters,
Greek and Cyrillic look-alikes, and digits or symbols that stand for letters
inside a word.  ``fit`` learns the lexicon from labelled texts: beginnings of
words that are significantly more frequent among toxic texts, with the log odds
as weight, and phrases around a term that occur in harmless texts (exceptions).
A text's load is the sum of its matched terms' weights without those inside an
exception phrase, divided by its length in words; a logistic curve fitted on
the training rows turns it into a score from 0 to 1.

The training sample is bounded by ``max_rows`` labelled rows (in the order of a
hash of the id).  Spark counts every term of the sample in both classes and tests it; only the
significant ones reach the driver, none is cut for being rare.  Scoring covers all rows and
needs no shuffle.

Null and empty texts get the score of a text without terms.  Without labels of
both classes every score is the share of toxic labels (0 without labels).
Rows with a null label or id are not used for training.  Repeated labels of an
id count once (toxic if any is); repeated texts count once.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import id_and_text, materialize, slices

MAX_ROWS = 20_000
#: terms that a task counts before it hands its sums on
HELD_TERMS = 400_000
LENGTHS = range(3, 10)

# Letters of other scripts that look like Latin ones.
_HOMOGLYPHS = str.maketrans(
    "абвгеёзіїјкмнорстухѕԁһӏԛԝαβγεικνορτυχωѵ",
    "a6bree3iijkmhopctyxsdhlqwabyeiknoptuxwv",
)
# Digits and symbols written for letters.
_STAND_INS = str.maketrans("0134578@$!|", "oieastbasil")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_FOREIGN = re.compile("[Ͱ-ԯ]")
_INSIDE = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])")
_LEADING = re.compile(r"(?<![\w@$!|])[0134578]+(?=[^\W\d_]{3})")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower-case text with look-alikes and stand-ins turned into the letters they imitate."""
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text))
    text = text.lower()
    if not text.isascii() and _FOREIGN.search(text):
        text = text.translate(_HOMOGLYPHS)
    for place in (_INSIDE, _LEADING):
        text = place.sub(lambda m: m.group().translate(_STAND_INS), text)
    return text


def words_of(text: str) -> list[str]:
    return _WORD.findall(fold(text))


@dataclass
class ToxicityModel:
    """``weights`` by term: ``"idiot"`` matches words that begin so, ``"idiot "`` the whole word."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 0.0
    intercept: float = -20.0

    def matcher(self) -> _Matcher:
        return _Matcher(self.weights, self.exceptions)

    def score(self, load: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.intercept + self.slope * load))))


class _Matcher:
    """Aho-Corasick over `` word word ... ``; each word takes the weight of its heaviest term."""

    def __init__(self, weights: dict[str, float], exceptions: list[str] = ()):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for t, w in weights.items():
            self.automaton.add_word(" " + t, (len(t) + 1, w))
        for p in exceptions:
            self.automaton.add_word(f" {p} ", (-(len(p) + 2), 0.0))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, words: list[str]) -> dict[int, float]:
        """Weight by position (in the joined words) of each matched word that no exception phrase covers."""
        if not len(self.automaton):
            return {}
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(f" {' '.join(words)} "):
            if size < 0:
                spared.append((end + 1 + size, end))
            else:
                at = end + 1 - size
                found[at] = max(weight, found.get(at, 0.0))
        for a, b in spared:
            for at in [x for x in found if a <= x < b]:
                del found[at]
        return found

    def load(self, words: list[str]) -> tuple[float, int]:
        found = self.hits(words)
        return math.log1p(100 * sum(found.values()) / (len(words) + 10)), len(found)


def _terms(words: list[str]) -> set[str]:
    out = set()
    for w in set(words):
        out.update(w[:k] for k in LENGTHS if k <= len(w))
        out.add(w + " ")
    return out


def _counted(rows: DataFrame, count) -> DataFrame:
    """Sum over all tasks of the Counters ``count(words)`` of each text: (key, toxic, benign)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(both[0].keys() | both[1].keys())
            got = [pa.array(keys, pa.string()), *(pa.array([both[c][k] for k in keys], pa.int64()) for c in (1, 0))]
            both[0].clear()
            both[1].clear()
            return pa.RecordBatch.from_arrays(got, ["key", "toxic", "benign"])

        for b in slices(batches):
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                both[toxic].update(count(words_of(text)))
                if len(both[0]) + len(both[1]) > HELD_TERMS:  # sums so far go on, a task holds no more
                    yield out()
        yield out()

    return (rows.select("text", "toxic").mapInArrow(run, "key string, toxic long, benign long")
            .groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("benign").alias("benign")))


def _significant(counts: DataFrame, n1: int, n0: int, least: float, significance: float) -> DataFrame:
    """Terms whose log odds and likelihood ratio reach the limits (less a rounding margin), decided by Spark."""
    n, both = float(n1 + n0), F.col("toxic") + F.col("benign")
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("benign") + 0.5) / (n0 + 1.0))

    def part(x: Column, size: int, share: Column) -> Column:
        return F.when((x > 0) & (share > 0), x * F.log(x / (F.lit(float(size)) * share))).otherwise(0.0)

    g = sum(part(x, size, share) for seen, size in ((F.col("toxic"), n1), (F.col("benign"), n0))
            for x, share in ((seen, both / n), (F.lit(size) - seen, 1 - both / n)))
    return counts.where((odds >= least - 1e-6) & (2 * g >= significance - 1e-6))


def _log_odds(a: int, b: int, n1: int, n0: int) -> float:
    return math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))


def _likelihood_ratio(a: int, b: int, n1: int, n0: int) -> float:
    """G statistic of a term found in ``a`` of ``n1`` toxic and ``b`` of ``n0`` benign texts."""
    total, n = a + b, n1 + n0
    g = 0.0
    for seen, size in ((a, n1), (b, n0)):
        for x, share in ((seen, total / n), (size - seen, 1 - total / n)):
            if x and share > 0:
                g += x * math.log(x / (size * share))
    return 2 * g


def _lexicon(counts: dict[str, tuple[int, int]], n1: int, n0: int, least: float, significance: float) -> dict[str, float]:
    """Significant terms; of nested ones with about the same texts only the longest, else the more general."""
    good = {}
    for t, (a, b) in counts.items():
        lo = _log_odds(a, b, n1, n0)
        if lo >= least and _likelihood_ratio(a, b, n1, n0) >= significance:
            good[t] = lo
    replaced = set()
    for t in good:
        if not t.endswith(" "):
            continue
        if t[:-1] in good and good[t] <= good[t[:-1]] + 1:
            replaced.add(t)  # the whole word says no more than the beginning
    for t in good:
        if t not in replaced:
            for k in range(LENGTHS[0], len(t)):
                if t[:k] in good and counts[t][0] >= 0.9 * counts[t[:k]][0]:
                    replaced.add(t[:k])
    kept: dict[str, float] = {}
    for t in sorted(good.keys() - replaced, key=len):
        if not any(t[:k] in kept and kept[t[:k]] >= good[t] - 0.1 for k in range(LENGTHS[0], len(t))):
            kept[t] = good[t]
    return kept


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) by Newton steps with a small ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + 1e-2 * np.array([w[0], 0])
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", where: Column | None = None, max_rows: int = MAX_ROWS) -> DataFrame:
    """Texts with their labels, at most ``max_rows`` of them, distinct; ``where`` picks labels by id."""
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)")
    if where is not None:
        known = known.where(where)
    # at most max_rows narrow rows: the broadcast is bounded
    chosen = (known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy(F.xxhash64("text").alias("_h")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def fit(rows: DataFrame, *, min_texts: int = 5, least: float = 2.0, significance: float = 30.0,
        exceptions: list[str] = ()) -> ToxicityModel:
    """Learn a model from ``(text, toxic)`` rows; ``exceptions`` are further phrases that are never toxic."""
    rows = materialize(rows, "toxicity-training")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return ToxicityModel(intercept=500.0 if n1 else -500.0)
    terms = _significant(_counted(rows, _terms).where(F.col("toxic") >= min(min_texts, n1)), n1, n0, least, significance)
    weights = _lexicon({r.key: (r.toxic, r.benign) for r in terms.collect()}, n1, n0, least, significance)
    model = ToxicityModel(weights, sorted(exceptions))
    if weights:
        phrases = _counted(rows, _phraser(weights)).where(
            (F.col("benign") >= 5) & (F.log((F.col("toxic") + 0.5) / (n1 + 1.0))
                                      < F.log((F.col("benign") + 0.5) / (n0 + 1.0)) - 1))
        model.exceptions = sorted({*exceptions, *(r.key for r in phrases.collect())})
    loads = np.array(_loads(rows, model).select("load", "toxic").collect(), dtype=np.float64)  # max_rows at most
    model.slope, model.intercept = _logistic(loads[:, 0], loads[:, 1])
    return model


def _phraser(weights: dict[str, float]):
    def count(words: list[str]) -> set[str]:
        if "m" not in store:
            store["m"] = _Matcher(weights)
        at, out = 0, set()
        hits = store["m"].hits(words)
        if hits:
            for i, w in enumerate(words):
                if at in hits:
                    if i:
                        out.add(f"{words[i - 1]} {w}")
                    if i + 1 < len(words):
                        out.add(f"{w} {words[i + 1]}")
                at += len(w) + 1
        return out

    store: dict = {}
    return count


def _loads(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """``rows`` without ``text``, with the load and the number of matched words."""
    others = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for b in slices(batches):
            loads = [matcher.load(words_of(t)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([x for x, _ in loads], pa.float64()),
                 pa.array([n for _, n in loads], pa.int32())], [*others, "load", "n_terms"])

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in others)
    return rows.select("text", *others).mapInArrow(run, f"{kinds}load double, n_terms int")


def score(docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted, n_terms)`` for every row; only the text enters the score."""
    rows = _loads(id_and_text(docs, id_col, text_col), model)
    bound = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.lit(model.intercept) + F.lit(model.slope) * F.col("load")))
    value = F.lit(1.0) / (F.lit(1.0) + F.exp(-bound))
    return rows.select("doc_id", value.alias("score"), (value >= 0.5).cast("int").alias("predicted"), "n_terms")


def reject(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` (all columns) without the rows whose score reaches ``threshold``."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for b in slices(batches, text_col):
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            good = [model.score(matcher.load(words_of(t or ""))[0]) < threshold for t in texts]
            yield b.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
