"""Benchmark decontamination (operator 2) by pigeonhole edit matching.

Texts and items are normalised (lower case, runs of anything but letters and
digits become one space).  An item of ``m`` characters may differ from a
passage by ``e = floor(rate * m)`` edits.  It is split into ``e + 1`` pieces, one of
which every such passage must hold unchanged; an Aho-Corasick automaton finds the pieces of
all items in one run over a text, and each hit is verified by Myers' bit-parallel distance over the
window the item can occupy.  The least distance per (document, item) is exact.

Items shorter than ``min_chars`` after normalisation have no budget: they match word for word, from
one word boundary to another (a character of a script without spaces is a word of its own).  An item
of a single word says nothing inside a text; it matches only a document that consists of nothing else.
An item without letters and digits matches nothing.

Items are taken in blocks of about ``BLOCK_CHARS`` characters (by a hash of
the item; on average, so a block holds that and the deviation of a hash); each
block is one broadcast and one scan of the documents, whose hits are written before the next
block is taken, so any number of items is matched without a shuffle of the documents.

Null and empty texts or items match nothing.  Repeated rows of either table are
reported once per distinct (doc_id, item_id) with the least distance; ids may be of any type; only the
id and text columns are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillsight.llm.common import id_and_text, materialize, slices

ERROR_RATE = 0.08
MIN_CHARS = 20
BLOCK_CHARS = 4 << 20
Item = tuple[object, str]
#: scripts that are written without spaces (kana, Han, Thai, Lao, Khmer, Myanmar)
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")


def normalise(texts: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", " "), " ")


class Pattern:
    """Myers' bit-parallel matching of one item against windows of text."""

    def __init__(self, text: str):
        self.text = text
        self.size = len(text)
        self.full = (1 << self.size) - 1
        self.high = 1 << (self.size - 1)
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(text):
            self.masks[c] |= 1 << i
        self.masks = dict(self.masks)

    def best(self, window: str) -> tuple[int, int]:
        """(least edit distance to any substring of ``window``, end of the first such substring)."""
        full, high, masks = self.full, self.high, self.masks.get
        up, down, score = full, 0, self.size
        best, end = score, 0
        for j, c in enumerate(window):
            eq = masks(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph = down | (full & ~(xh | up))
            mh = up & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
                if score < best:
                    best, end = score, j + 1
            ph = (ph << 1) & full
            up = ((mh << 1) & full) | (full & ~(xv | ph))
            down = ph & xv
        return best, end


def n_words(text: str) -> int:
    """Words of a normalised text; in scripts without spaces every character is one."""
    return len(_UNSPACED.sub(" x ", text).split())


def _boundary(text: str, at: int) -> bool:
    """Whether a word may begin or end at this place."""
    return at in (0, len(text)) or any(c == " " or _UNSPACED.match(c) for c in text[at - 1:at + 1])


def pieces(text: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` consecutive pieces of nearly equal length, with their offsets."""
    n, m = errors + 1, len(text)
    return [(m * i // n, text[m * i // n:m * (i + 1) // n]) for i in range(n)]


class Matcher:
    """All items of a block."""

    def __init__(self, items: list[Item], rate: float = ERROR_RATE, min_chars: int = MIN_CHARS):
        import ahocorasick

        self.whole: dict[str, list] = defaultdict(list)
        self.items: list[tuple[object, int | None, str]] = []
        at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            if not text:
                continue
            if len(text) < min_chars:
                if n_words(text) == 1:
                    self.whole[text].append(item_id)
                    continue
                at[text].append((len(self.items), 0))
                self.items.append((item_id, None, text))
                continue
            errors = int(rate * len(text))
            for offset, piece in pieces(text, errors):
                at[piece].append((len(self.items), offset))
            self.items.append((item_id, errors, text))
        self.patterns: dict[int, Pattern] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()

    def _pattern(self, k: int) -> Pattern:
        if k not in self.patterns:
            self.patterns[k] = Pattern(self.items[k][2])
        return self.patterns[k]

    def matches(self, text: str) -> dict[object, tuple[int, int]]:
        """item id -> (distance, end) of its nearest passage in the normalised ``text``."""
        found = {i: (0, len(text)) for i in self.whole.get(text, ())}
        if not len(self.automaton):
            return found
        tried: dict[int, list[int]] = defaultdict(list)
        for last, (size, places) in self.automaton.iter(text):
            for k, offset in places:
                item_id, errors, item = self.items[k]
                start = last + 1 - size - offset  # where the item would begin without edits
                if errors is None:
                    if item_id not in found and _boundary(text, start) and _boundary(text, last + 1):
                        found[item_id] = (0, last + 1)
                    continue
                # the window tried at s holds every passage whose hit puts the start within `errors` of s
                if any(abs(start - s) <= errors for s in tried[k]):
                    continue
                tried[k].append(start)
                low = max(0, start - 2 * errors)
                distance, end = self._pattern(k).best(text[low:max(0, start + len(item) + 2 * errors)])
                if distance <= errors and (item_id not in found or (distance, low + end) < found[item_id]):
                    found[item_id] = (distance, low + end)
        return found


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[Item]]:
    """The normalised items, in blocks of about ``block_chars`` characters that each fit the driver."""
    items = id_and_text(benchmark, id_col, text_col).where("doc_id is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(-(-chars // block_chars)) or 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) == k).distinct().collect()
        if rows:
            texts = normalise(pa.array([r.text for r in rows], pa.string())).to_pylist()
            yield [(r.doc_id, t) for r, t in zip(rows, texts, strict=True)]


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", rate: float = ERROR_RATE,
                 min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, item_id, distance, passage_end)``: each item found in each document.

    ``passage_end`` is the end (in the normalised text) of the first passage at the least distance.
    """
    rows = id_and_text(docs, id_col, text_col)
    kind, item_kind = rows.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_id_col].dataType
    schema = f"doc_id {kind}, item_id {item_kind.simpleString()}, distance long, passage_end long"
    item_type = to_arrow_type(item_kind)

    def scan(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate, min_chars)
            for b in slices(batches):
                out = [(i, *row) for i, text in enumerate(normalise(b.column(1)).to_pylist())
                       for row in ((item, *place) for item, place in matcher.matches(text).items())]
                if out:
                    index, item, distance, end = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(index)), pa.array(item, item_type),
                         pa.array(distance, pa.int64()), pa.array(end, pa.int64())],
                        ["doc_id", "item_id", "distance", "passage_end"])

        return rows.mapInArrow(run, schema)

    found = []
    for block in item_blocks(benchmark, item_id_col, item_text_col, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # block_chars characters at most
        found.append(materialize(scan(shared), "hits"))
        shared.unpersist()
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    nearest = F.min(F.struct("distance", "passage_end")).alias("_n")
    return (reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(nearest)
            .select("doc_id", "item_id", "_n.distance", "_n.passage_end"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
                        item_id_col: str = "item_id", item_text_col: str = "text", rate: float = ERROR_RATE,
                        min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` (all columns) without the rows that hold an item; one scan per block of items, no shuffle."""

    def scan(frame: DataFrame, block: list[Item]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate, min_chars)
            for b in slices(batches, text_col):
                texts = normalise(pc.fill_null(b.column(b.schema.get_field_index(text_col)), ""))
                yield b.filter(pa.array([not matcher.matches(t) for t in texts.to_pylist()]))

        return frame.mapInArrow(run, docs.schema)

    return reduce(scan, item_blocks(benchmark, item_id_col, item_text_col, block_chars), docs)
