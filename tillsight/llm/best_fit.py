"""Best-fit packing (operator 12): as few fixed windows as best-fit decreasing needs.

Every text becomes its token ids and an end id; a document longer than the window is cut into
whole windows and a rest, shorter ones stay whole.  Pieces are packed by best-fit decreasing
over all documents at once: longest first, each into the tightest open window that still
holds it, a new window where none does.

Only a piece's length matters to that, and lengths are at most ``window``.  So Spark counts
the pieces of each length, the driver plans on those counts (at most ``window`` numbers,
whatever the input), and Spark hands every piece its place:

* ``plan`` keeps open windows in a segment tree over their remaining capacity, which finds the
  tightest fit in logarithmic time.  Windows with the same contents are planned together: the
  pieces of one length go to all windows of the tightest capacity before the next is asked
  for, exactly as one by one.  A length splits at most one group of windows and opens at most
  two, so the plan's size depends on ``window`` alone.
* A piece knows its number among the pieces of its length in its task.  The counts per (task,
  length) turn that into its number among all pieces of its length, and a binary search in
  the plan into its window and offset.  No task holds the pieces of one length or window.

Pieces with their ids are written to the shared folder once; numbers come from those files, so
a lost task finds the same places again.  Null text is empty (the end id alone).  Rows with
equal ids are packed each on their own; a null id stays null; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import binary_array, id_and_text, materialize, slices
from tillsight.llm.tokens import tokenizer_path, with_end
from tillsight.llm.word_tokens import word_encoder

WINDOW = 4096
_PIECE = "doc_id long, piece int, start long, length int, part int, nth long, ids binary"
_PLACED = "doc_id long, piece int, start long, length long, sequence_id long, offset long, ids binary"


class CapacityTree:
    """A segment tree over remaining capacities ``0..capacity``: how many groups of windows have each."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, n: int) -> None:
        i = remaining + self.leaves
        while i:
            self.count[i] += n
            i //= 2

    def tightest(self, size: int) -> int | None:
        """The least occupied capacity of at least ``size``."""
        i = size + self.leaves
        if self.count[i]:
            return size
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:  # the right neighbour holds only larger capacities
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


@dataclass
class Group:
    """``windows`` open windows with the same contents.

    Each entry ``(size, each, first, offset)`` puts ``each`` pieces of that size, by their number
    among all of that size from ``first`` on, into every window, from ``offset`` on.
    """

    windows: int
    used: int
    contents: list[tuple[int, int, int, int]]

    def split(self, n: int) -> tuple[Group, Group]:
        rest = [(s, each, first + n * each, at) for s, each, first, at in self.contents]
        return Group(n, self.used, self.contents), Group(self.windows - n, self.used, rest)

    def filled(self, size: int, each: int, first: int) -> Group:
        return Group(self.windows, self.used + size * each, [*self.contents, (size, each, first, self.used)])


def plan(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best-fit decreasing of ``counts[size]`` pieces of each size; the filled windows, grouped by contents."""
    tree = CapacityTree(capacity)
    open_groups: dict[int, list[Group]] = {}

    def put(g: Group) -> None:
        open_groups.setdefault(capacity - g.used, []).append(g)
        tree.add(capacity - g.used, 1)

    for size in sorted(counts, reverse=True):
        left, first = counts[size], 0
        while left:
            fit = tree.tightest(size)
            if fit is None:
                group = Group(-(-left // (capacity // size)), 0, [])
            else:
                group = open_groups[fit].pop()
                tree.add(fit, -1)
            # the tightest window stays the tightest until it holds no more of this size
            each = (capacity - group.used) // size
            whole = min(group.windows, left // each)
            if whole:
                head, group = group.split(whole)
                put(head.filled(size, each, first))
                first, left = first + whole * each, left - whole * each
            if group.windows and left:
                head, group = group.split(1)
                put(head.filled(size, min(each, left), first))
                first, left = first + min(each, left), left - min(each, left)
            if group.windows and group.used:
                put(group)
    return [g for r in sorted(open_groups) for g in open_groups[r]]


class Places:
    """A plan as sorted arrays: the place of piece number ``n`` of a size by binary search."""

    def __init__(self, counts: dict[int, int], capacity: int):
        groups = plan(counts, capacity)
        self.base = np.zeros(capacity + 2, dtype=np.int64)
        for size, n in counts.items():
            self.base[size + 1] = n
        self.base = np.cumsum(self.base)  # pieces of smaller sizes
        rows, sequence = [], 0
        for g in groups:
            rows += [(self.base[size] + first, each, sequence, at) for size, each, first, at in g.contents]
            sequence += g.windows
        self.windows = sequence
        table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
        self.first, self.each, self.sequence, self.offset = (np.ascontiguousarray(table[:, i]) for i in range(4))

    def find(self, size: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and offset of each piece."""
        at = self.base[size] + number
        slot = np.searchsorted(self.first, at, side="right") - 1
        into = at - self.first[slot]
        return (self.sequence[slot] + into // self.each[slot],
                self.offset[slot] + into % self.each[slot] * size)


def token_pieces(docs: DataFrame, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                 window: int = WINDOW) -> DataFrame:
    """Each document's ids in pieces of at most ``window``, numbered within task and length (``part``, ``nth``)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(tokenizer_path(tokenizer))
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        for b in slices(batches, max_bytes=4 << 20):
            ids, bounds = with_end(*enc.encode(b.column(1)), end_id)
            n = np.diff(bounds)
            count = -(-n // window)
            doc = np.repeat(np.arange(len(n)), count)
            k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)  # piece number in its document
            length = np.minimum(window, n[doc] - k * window)
            order = np.argsort(length, kind="stable")
            sizes, first, many = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(length), dtype=np.int64)
            nth[order] = seen[length[order]] + np.arange(len(length)) - np.repeat(first, many)
            seen[sizes] += many
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(k.astype(np.int32)), pa.array(k * window),
                 pa.array(length.astype(np.int32)), pa.array(np.full(len(doc), part, np.int32)), pa.array(nth),
                 binary_array(ids.astype("<u4", copy=False), np.concatenate(([0], np.cumsum(length))))],
                ["doc_id", "piece", "start", "length", "part", "nth", "ids"])

    return (id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
            .mapInArrow(cut, _PIECE))


def pack_best_fit(docs: DataFrame, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                  window: int = WINDOW) -> DataFrame:
    """One row per piece with its window (``sequence_id``), place there and token ids (little-endian uint32)."""
    pieces = materialize(token_pieces(docs, tokenizer=tokenizer, id_col=id_col, text_col=text_col, end_id=end_id,
                                      window=window), "best-fit-pieces")
    # a row per task and length; a length's window holds one row per task
    by_task = materialize(pieces.groupBy("part", "length").count(), "best-fit-counts")
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    places = Places(counts, window)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    numbered = (pieces.join(before, ["part", "length"])
                .select("doc_id", "piece", "start", "length", (F.col("before") + F.col("nth")).alias("number"), "ids"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            sequence, offset = places.find(size, b.column(4).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(size), pa.array(sequence), pa.array(offset), b.column(5)],
                ["doc_id", "piece", "start", "length", "sequence_id", "offset", "ids"])

    return numbered.mapInArrow(place, _PLACED)
