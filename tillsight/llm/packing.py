"""Packing (operator 9): fixed windows by multiway differencing.

Every text becomes its token ids and an end id.  Whole windows are cut off the
front of a long document and stand alone; the rest of each document, in pieces
of at most ``max_piece`` tokens, is packed block by block with the
Karmarkar-Karp method: each piece starts as a partial partition of ``k``
windows, the two partial partitions with the largest spread are merged with
their imbalances opposed, until one is left, whose windows are nearly equal.
``k`` starts at the least count that can hold the block and rises by one
whenever a window exceeds the capacity.

Blocks hold a fixed number of pieces, so time and memory per block are bounded;
pieces are dealt to tasks by a hash of their source position, so neither a hot
document id nor a long document gathers in one task, and they are sorted by
that position, so a lost task packs the same windows again.

Null text is empty (one piece, the end id alone); rows with equal ids are packed
each on their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import binary_array, id_and_text, slices
from tillsight.llm.tokens import encoder, tokenizer_path, with_end

WINDOW = 1024
MAX_PIECE = 256
BLOCK = 600
_PIECE = "doc_id long, doc_tokens long, start long, length int, source long, ids binary"
_PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp multiway differencing: indices of ``sizes`` in ``k`` windows of nearly equal sums.

    A partial partition is a pair of arrays, the windows' sums in descending
    order and a node for each window's members (-1: none).  Merging adds the
    largest window of one to the smallest of the other.
    """
    if not sizes:
        return [[] for _ in range(k)]
    left: list[int] = [-1] * len(sizes)
    right: list[int] = [-1] * len(sizes)
    heap = []
    for i, s in enumerate(sizes):
        # only the occupied windows are stored; the rest are zero
        heap.append((-int(s), i, np.array([s], dtype=np.int64), np.array([i], dtype=np.int64)))
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, sa, na = heapq.heappop(heap)
        _, _, sb, nb = heapq.heappop(heap)
        overlap = len(sa) + len(sb) - k
        if overlap <= 0:  # opposed, their occupied windows do not meet
            sums, nodes = np.concatenate((sa, sb)), np.concatenate((na, nb))
        else:
            head = len(sa) - overlap
            met = np.arange(len(left), len(left) + overlap)
            left.extend(na[head:].tolist())
            right.extend(nb[::-1][:overlap].tolist())
            sums = np.concatenate((sa[:head], sa[head:] + sb[::-1][:overlap], sb[:len(sb) - overlap]))
            nodes = np.concatenate((na[:head], met, nb[:len(nb) - overlap]))
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        spread = int(sums[0] - (sums[-1] if len(sums) == k else 0))
        heapq.heappush(heap, (-spread, tie, sums, nodes))
        tie += 1
    windows = []
    for node in heap[0][3].tolist():
        members, stack = [], [node]
        while stack:
            x = stack.pop()
            if left[x] < 0:
                members.append(x)
            else:
                stack += [left[x], right[x]]
        windows.append(sorted(members))
    return windows + [[] for _ in range(k - len(windows))]


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises from the least possible until none exceeds it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        windows = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


def token_pieces(docs: DataFrame, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, window: int = WINDOW, max_piece: int = MAX_PIECE) -> DataFrame:
    """Each document's ids cut into whole windows and, from the rest, pieces of at most ``max_piece``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path(tokenizer))
        source = TaskContext.get().partitionId() << 40
        for b in slices(batches):
            ids, bounds = with_end(*enc.encode(b.column(1)), end_id)
            n = np.diff(bounds)
            whole = n // window
            count = whole + -(-(n % window) // max_piece)
            doc = np.repeat(np.arange(len(n)), count)
            k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)  # piece number in its document
            start = np.where(k <= whole[doc], k * window, whole[doc] * window + (k - whole[doc]) * max_piece)
            length = np.where(k < whole[doc], window, np.minimum(max_piece, n[doc] - start))
            cuts = np.concatenate(([0], np.cumsum(length)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(n[doc]), pa.array(start), pa.array(length.astype(np.int32)),
                 pa.array(source + np.arange(len(doc))), binary_array(ids.astype("<u4", copy=False), cuts)],
                ["doc_id", "doc_tokens", "start", "length", "source", "ids"])
            source += len(doc)

    return (id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
            .mapInArrow(cut, _PIECE))


def pack(docs: DataFrame, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0,
         window: int = WINDOW, max_piece: int = MAX_PIECE, block: int = BLOCK) -> DataFrame:
    """One row per piece with its window (``sequence_id``), place there and token ids (little-endian uint32)."""
    if not 0 < max_piece <= window:
        raise ValueError("max_piece must lie between 1 and the window")
    pieces = token_pieces(docs, tokenizer=tokenizer, id_col=id_col, text_col=text_col, end_id=end_id,
                          window=window, max_piece=max_piece)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []
        rows = 0

        def out(rest: pa.Table, windows: list[list[int]]) -> pa.RecordBatch:
            nonlocal sequence
            index = np.fromiter((i for w in windows for i in w), dtype=np.int64)
            counts = np.array([len(w) for w in windows], dtype=np.int64)
            rest = rest.take(pa.array(index)).combine_chunks()
            length = rest["length"].to_numpy().astype(np.int64)
            ends = np.cumsum(length)
            first = np.repeat((ends - length)[np.cumsum(counts) - counts], counts)
            number = sequence + np.repeat(np.arange(len(windows)), counts)
            sequence += len(windows)
            cols = {"doc_id": rest["doc_id"], "start": rest["start"], "length": pa.array(length),
                    "doc_tokens": rest["doc_tokens"], "sequence_id": pa.array(number),
                    "offset": pa.array(ends - length - first), "ids": rest["ids"]}
            return pa.table(cols).combine_chunks().to_batches()[0]

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                rest = pa.Table.from_batches(held)
                yield out(rest, pack_sizes(rest["length"].to_pylist(), window))

        for b in batches:
            full = pa.compute.equal(b.column(b.schema.get_field_index("length")), window)
            alone = b.filter(full)
            if alone.num_rows:
                yield out(pa.Table.from_batches([alone]), [[i] for i in range(alone.num_rows)])
            b = b.filter(pa.compute.invert(full))
            while b.num_rows:
                some = b.slice(0, block - rows)
                held.append(some)
                rows += some.num_rows
                b = b.slice(some.num_rows)
                if rows == block:
                    yield from flush()
                    held, rows = [], 0
        yield from flush()

    return (pieces.repartition(F.xxhash64("source")).sortWithinPartitions("source")
            .mapInArrow(place, _PACKED))
