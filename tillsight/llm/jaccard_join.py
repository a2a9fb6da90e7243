"""N-gram Jaccard join (operator 7) by universe partition and pigeonhole.

A document is the set of its distinct 5-word shingles; two documents link when
``100 * |x & y| >= 80 * |x | y|``.  For a smaller set of ``s`` elements every partner has at
most ``5s/4`` elements and differs in at most ``H = floor((s + floor(5s/4)) / 9)`` of them.

Sizes fall into bands.  For each band the universe is hashed into ``m`` segments;
a set's part in a segment has a signature.  The smaller set of a pair probes, the larger
is indexed (for its own band, and for the band below if a partner there can be large enough).
A probe may skip a segment (value -1), look for an equal part (0) or, in the relief
segment, for a part within one element (1: the part, its one-deletion
neighbours, and the neighbours that the indexed sets have stored).  If the values plus one
add up to ``H + 1``, a linked pair must meet in some segment.  Costs decide the allocation: a
segment whose signature nobody else holds is probed for nothing, and of the others
those with the fewest holders are taken until ``H + 1`` is reached.  So a text whose parts are
mostly its own needs no probe at all, and the signatures of common passages are skipped.

Stages, each written to the shared folder:

1. One scan makes, per batch of texts, a sorted array of signatures for each
   bucket; copies of a set are signed once per task.  Each bucket is one task that
   finds the signatures with several holders and tells every prober their number.
2. Every prober chooses its probes.
3. In its bucket a small group of probers and holders gives all its pairs; a large one gives a
   star: every member with the one whose parts are the least its own.
   These pairs are verified exactly on the full sets, and components are found.
4. The star also tells what each member of a large group shares with the centre and where it
   deviates from it.  Two members far from the centre that link share elements outside of it; two
   near ones share deviations; how many is known from the sizes, so a pair meets in the
   rarest of those elements (prefix filter).
   These are joined on (centre, element), a hot one in a grid of cells by member, and the distinct pairs
   of different components verified on the full sets.  So every linked pair is
   inside one component or verified itself: nothing is capped or sampled, and no task holds a group.

Shingles are compared as 64-bit hashes.  Sets below four elements link only with equal sets.
Null, empty and blank texts have no shingles and link with nothing; rows without an id
have no component and link nothing.  Rows that share an id count as one document when links are followed.
``docs`` must give the same rows in the same order when read again (files do).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import id_and_text, materialize, slices
from tillsight.llm.components import connected_components
from tillsight.llm.shingles import mix, shingle_sets
from tillsight.plans.ordered import ordered_scan
from tillsight.session import shuffle_partitions

WIDTH = 5
SMALLEST = 4  # below this size no two different sets link
DOC, SIGNED, MATCH, GROUP = range(4)
_DOC = np.dtype([("doc_id", "<i8"), ("digest", "<i8"), ("n", "<i8"), ("fp1", "<i8"), ("fp2", "<i8"), ("has_id", "<i8")])
_BLOB = "kind int, bucket int, base long, data binary"
#: a packed entry: signature, role, place in the batch
_SIGNATURE = ~np.uint64((1 << 18) - 1)
INDEXED, OWN, NEIGHBOUR, RELIEF = range(4)
_ROWS = 1 << 15


def max_difference(size: int) -> int:
    """Most elements in which a set and a partner that is not smaller can differ."""
    return (size + size * 5 // 4) // 9


def bands(limit: int) -> list[tuple[int, int]]:
    """(first size, number of segments) of each band up to ``limit``; segments leave room to skip some."""
    out, low = [], SMALLEST
    while low <= limit:
        high = -(-low * 3 // 2)
        out.append((low, -(-3 * (max_difference(high - 1) + 1) // 2) + 1))
        low = high
    return out


_BANDS = bands(1 << 40)
_LOWS = np.array([b[0] for b in _BANDS])
def _parts(elements: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment of each element, scrambled elements, and the sum of each segment."""
    segment = ((elements >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    scrambled = mix(elements + np.uint64(0x51ED270B))
    sums = np.zeros(m, dtype=np.uint64)
    np.add.at(sums, segment, scrambled)
    return segment, scrambled, sums


def _key(band: int, segments: np.ndarray, space: int) -> np.ndarray:
    return mix((np.uint64(band * 2 + space) << np.uint64(40)) + segments.astype(np.uint64))


def band_of(size: int) -> int:
    return int(np.searchsorted(_LOWS, size, side="right")) - 1


def signatures(elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, roles) of a set.

    ``OWN`` and ``RELIEF`` (segment 0) are parts in the set's own band, indexed and ready to
    be probed; ``NEIGHBOUR`` are the probes for a part within one element of segment 0;
    ``INDEXED`` are the stored one-deletion neighbours, and the parts in the band below.
    """
    size = len(elements)
    if size < SMALLEST:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    band = band_of(size)
    out: list[np.ndarray] = []
    roles: list[np.ndarray] = []

    def add(values: np.ndarray, role: int) -> None:
        out.append(values)
        roles.append(np.full(len(values), role, np.uint64))

    for k in (band, band - 1):
        if k < 0 or (k < band and size > (_BANDS[band][0] - 1) * 5 // 4):
            continue  # no partner in the band below is large enough
        m = _BANDS[k][1]
        segment, scrambled, sums = _parts(elements, m)
        own = mix(sums + _key(k, np.arange(m), 0))
        zero = np.array([0])
        less = sums[0] - scrambled[segment == 0]  # the part in segment 0 without one element
        add(mix(less + _key(k, zero, 1)), INDEXED)
        if k < band:
            add(own, INDEXED)
            continue
        add(own[1:], OWN)
        add(own[:1], RELIEF)
        add(mix(sums[:1] + _key(k, zero, 1)), NEIGHBOUR)
        add(mix(less + _key(k, zero, 0)), NEIGHBOUR)
    return np.concatenate(out), np.concatenate(roles)


def allocate(size: int, costs: np.ndarray, relief: int, neighbours: int) -> tuple[int, int]:
    """The cheapest probes: (how many of the ``OWN`` entries in the order of their costs, value + 1 of segment 0).

    ``costs``: sorted numbers of holders of the ``OWN`` parts that have others;
    ``relief`` and ``neighbours``: those of segment 0 and of its neighbourhood (0: none).
    """
    need = max_difference(size) + 1
    free = _BANDS[band_of(size)][1] - 1 - len(costs)  # parts that nobody else holds
    total = np.concatenate(([0], np.cumsum(costs)))
    best = None
    for value, price in enumerate((0, relief, relief + neighbours)):
        rest = max(0, need - free - value)
        if rest <= len(costs) and (best is None or price + total[rest] < best[0]):
            best = (price + total[rest], rest, value)
    return best[1], best[2]


def _sign(n_buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: set[tuple[int, int]] = set()
        number = 0
        for big in slices(batches, max_bytes=4 << 20):
            for lo in range(0, big.num_rows, _ROWS):
                b = big.slice(lo, _ROWS)
                base = (task << 36) | (number << 16)
                number += 1
                sets = shingle_sets(b.column(1), width)
                rows = np.zeros(len(sets), dtype=_DOC)
                rows["has_id"] = np.asarray(b.column(0).is_valid())
                rows["doc_id"] = pa.compute.fill_null(b.column(0), 0).to_numpy(zero_copy_only=False)
                rows["digest"] = b.column(2).to_numpy()
                rows["n"] = [len(s) for s in sets]
                packed = []
                for i, s in enumerate(sets):
                    first, second = int(mix(s).sum()), int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum())
                    rows[i]["fp1"], rows[i]["fp2"] = np.array([first, second], np.uint64).view(np.int64)
                    if rows[i]["has_id"] and (first, second) not in seen:
                        seen.add((first, second))
                        values, roles = signatures(s)
                        packed.append((values & _SIGNATURE) | (roles << np.uint64(16)) | np.uint64(i))
                yield _blobs([(DOC, task % n_buckets, base, rows.tobytes())])
                if packed:
                    values = np.sort(np.concatenate(packed))
                    cuts = np.searchsorted(_bucket(values, n_buckets), np.arange(n_buckets + 1))
                    yield _blobs([(SIGNED, k, base, values[cuts[k]:cuts[k + 1]].tobytes())
                                  for k in range(n_buckets) if cuts[k] < cuts[k + 1]])

    return run


def _bucket(values: np.ndarray, n: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _place(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64(0xFFFF)).astype(np.int64)


def _role(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(16) & np.uint64(3)).astype(np.int64)


def _blobs(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kind, bucket, base, data = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()),
                                       pa.array(base, pa.int64()), pa.array(data, pa.binary())],
                                      ["kind", "bucket", "base", "data"])


def _collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: signatures with several holders, and their number for every prober."""
    task = TaskContext.get().partitionId()
    parts: list[tuple[int, np.ndarray]] = []
    for b in batches:
        rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
        yield _blobs([r for r in rows if r[0] == DOC])
        parts += [(base, np.frombuffer(data, np.uint64)) for kind, _, base, data in rows if kind == SIGNED]
    if not parts:
        return
    parts.sort(key=lambda p: p[0])
    values = np.concatenate([v for _, v in parts])
    refs = np.repeat(np.array([b for b, _ in parts], np.int64), [len(v) for _, v in parts]) | _place(values)
    order = np.argsort(values & _SIGNATURE, kind="stable")
    values, refs = values[order], refs[order]
    head = np.flatnonzero(np.diff(values & _SIGNATURE, prepend=~values[:1]))
    size = np.diff(head, append=len(values))
    holds = _role(values) != NEIGHBOUR
    # distinct holders: an upper bound is enough for the cost, but a set must not meet only itself
    others = np.maximum.reduceat(refs, head) != np.minimum.reduceat(refs, head)
    holders = np.add.reduceat(holds.astype(np.int64), head)
    useful = others & (holders > 0) & (np.maximum.reduceat((_role(values) != INDEXED).astype(np.int8), head) > 0)
    keep = np.repeat(useful, size)
    if not keep.any():
        return
    cost = np.repeat(holders, size)[keep]
    values, refs, size = values[keep], refs[keep], size[useful]
    probe = np.flatnonzero(_role(values) != INDEXED)
    probe = probe[np.argsort(refs[probe] >> 16, kind="stable")]
    base = refs[probe] >> 16
    cuts = np.flatnonzero(np.diff(base, prepend=-1))
    out = [(MATCH, task, int(base[a]) << 16, values[probe[a:z]].tobytes() + cost[probe[a:z]].tobytes())
           for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(base)], strict=True)]
    for lo in range(0, len(out), 1000):
        yield _blobs(out[lo:lo + 1000])
    first = np.cumsum(size) - size
    cut = [0, *(np.flatnonzero(np.diff(first >> 17)) + 1).tolist(), len(size)]  # whole groups, a bounded number each
    for lo, hi in zip(cut[:-1], cut[1:], strict=True):
        a, z = first[lo], first[hi - 1] + size[hi - 1]
        yield _blobs([(GROUP, task, int(z - a), values[a:z].tobytes() + refs[a:z].tobytes())])


_CHOSEN = "bucket int, data binary"


def _choose(n_buckets: int):
    """Per batch: every set's probes, by bucket, as (signature, set, number of parts that are its own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sizes, entries = None, None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if current is None or not entries:
                return
            values = np.concatenate([v for v, _ in entries])
            costs = np.concatenate([c for _, c in entries])
            order = np.lexsort((costs, _role(values), _place(values)))
            values, costs = values[order], costs[order]
            place = _place(values)
            head = np.flatnonzero(np.diff(place, prepend=-1))
            chosen, own = [], []
            for a, z in zip(head.tolist(), [*head[1:].tolist(), len(place)], strict=True):
                role, cost = _role(values[a:z]), costs[a:z]
                size = int(sizes[place[a]])
                parts = cost[role == OWN]
                near, relief = int(cost[role == NEIGHBOUR].sum()), int(cost[role == RELIEF].sum())
                rest, value = allocate(size, parts, relief, near)
                pick = np.zeros(z - a, dtype=bool)
                pick[np.flatnonzero(role == OWN)[:rest]] = True
                pick |= ((role == RELIEF) & (value > 0)) | ((role == NEIGHBOUR) & (value > 1))
                if pick.any():
                    chosen.append(values[a:z][pick])
                    own.append(np.full(int(pick.sum()), _BANDS[band_of(size)][1] - 1 - len(parts)))
            if not chosen:
                return
            values, own = np.concatenate(chosen), np.concatenate(own)
            rows = np.column_stack(((values & _SIGNATURE).view(np.int64), current | _place(values), own))
            bucket = _bucket(values, n_buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            some = [k for k in range(n_buckets) if cuts[k] < cuts[k + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()),
                 pa.array([np.ascontiguousarray(rows[order[cuts[k]:cuts[k + 1]]]).tobytes() for k in some], pa.binary())],
                ["bucket", "data"])

        for b in batches:
            for kind, base, data in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if base != current:
                    yield from flush()
                    current, sizes, entries = base, None, []
                if kind == DOC:
                    sizes = np.frombuffer(data, _DOC)["n"]
                else:
                    half = len(data) // 2
                    entries.append((np.frombuffer(data[:half], np.uint64), np.frombuffer(data[half:], np.int64)))
        yield from flush()

    return run


class _Groups:
    """The signatures of a bucket that somebody probes: ranges of probers and of holders, one for each."""

    def __init__(self, data: bytes, picked: np.ndarray, signature: np.ndarray):
        half = len(data) // 2
        values, refs = np.frombuffer(data[:half], np.uint64), np.frombuffer(data[half:], np.int64)
        holds = _role(values) != NEIGHBOUR
        held, self.holders = values[holds] & _SIGNATURE, refs[holds]
        head = np.flatnonzero(np.diff(held, prepend=~held[:1]))
        lo = np.searchsorted(signature, held[head], side="left")
        hi = np.searchsorted(signature, held[head], side="right")
        probed = hi > lo
        self.probers, self.own = picked[:, 1], picked[:, 2]
        self.lo, self.hi = lo[probed], hi[probed]
        self.head, self.end = head[probed], np.append(head[1:], len(held))[probed]
        p, h = self.hi - self.lo, self.end - self.head
        self.small = p * h <= 4 * (p + h)

    def small_pairs(self) -> np.ndarray:
        """Every prober of a small group with every holder."""
        lo, head = self.lo[self.small], self.head[self.small]
        p, h = self.hi[self.small] - lo, self.end[self.small] - head
        n = p * h
        group = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        return np.column_stack((self.probers[lo[group] + k // h[group]], self.holders[head[group] + k % h[group]]))

    def large(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(probers, holders, parts of their own of the probers) of each large group."""
        for g in np.flatnonzero(~self.small).tolist():
            probers, at = np.unique(self.probers[self.lo[g]:self.hi[g]], return_index=True)
            yield probers, np.unique(self.holders[self.head[g]:self.end[g]]), self.own[self.lo[g]:self.hi[g]][at]


def _groups(groups: pa.Table, chosen: pa.Table) -> Iterator[_Groups]:
    if not chosen.num_rows:
        return
    picked = np.concatenate([np.frombuffer(d, np.int64).reshape(-1, 3) for d in chosen["data"].to_pylist()])
    signature = picked[:, 0].copy().view(np.uint64)
    order = np.lexsort((picked[:, 1], signature))
    for data in groups["data"].to_pylist():
        yield _Groups(data, picked[order], signature[order])


_META = "kind int, part int, data binary"
PAIRS, STARS = 0, 1


def _distinct(pairs: list[np.ndarray]) -> np.ndarray:
    """Distinct rows of some arrays."""
    return np.unique(np.concatenate([np.empty((0, 2), np.int64), *pairs]), axis=0)


def _first_round(n_parts: int):
    """All pairs of the small groups of a bucket, and of each large one every member with the centre, dealt by pair."""

    def run(key, groups: pa.Table, chosen: pa.Table) -> pa.Table:
        pairs, stars, held = [], [], 0
        for some in _groups(groups, chosen):
            pairs.append(np.sort(some.small_pairs(), axis=1))
            for probers, holders, own in some.large():
                centre = probers[np.lexsort((probers, own))[0]]
                everyone = np.union1d(probers, holders)
                stars.append(np.column_stack((everyone, np.full(len(everyone), centre))))
                held += len(everyone)
                if held > 1 << 20:
                    stars, held = [_distinct(stars)], 0
            pairs = [_distinct(pairs)]
        out = []
        for kind, rows in ((PAIRS, _distinct(pairs)), (STARS, _distinct(stars))):
            rows = rows[rows[:, 0] != rows[:, 1]]
            part = _bucket(mix(rows[:, 0].astype(np.uint64) * np.uint64(3) + rows[:, 1].astype(np.uint64)), n_parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(n_parts + 1))
            out += [(kind, k, rows[order[cuts[k]:cuts[k + 1]]].tobytes())
                    for k in range(n_parts) if cuts[k] < cuts[k + 1]]
        kind, part, data = zip(*out, strict=True) if out else ((), (), ())
        return pa.table([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(data, pa.binary())],
                        ["kind", "part", "data"])

    return run


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for base, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            rows = np.frombuffer(data.as_buffer(), _DOC)
            yield pa.RecordBatch.from_arrays(
                [pa.array(base + np.arange(len(rows)))]
                + [pa.array(rows[c].copy(), mask=(rows["has_id"] == 0) if c == "doc_id" else None)
                   for c in _DOC.names[:-1]], ["ref", *_DOC.names[:-1]])


def _pairs(blobs: DataFrame, kind: int, n_parts: int) -> DataFrame:
    """Distinct pairs ``(x, y)`` out of the blobs of all buckets; a pair's blobs meet in one part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            held += [np.frombuffer(d.as_buffer(), np.int64).reshape(-1, 2) for d in b.column(0)]
            if len(held) > 100:
                held = [_distinct(held)]
        rows = _distinct(held)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy())], ["x", "y"])

    return (blobs.where(F.col("kind") == kind).repartitionById(n_parts, F.col("part")).select("data")
            .mapInArrow(run, "x long, y long"))


_VERIFIED = ("a long, b long, n_a long, n_b long, shared long, linked boolean, outside array<long>, "
             "missing array<long>")
_EMPTY = np.empty(0, np.int64)


def _verified(pairs: DataFrame, sets: DataFrame, deviations: bool) -> DataFrame:
    """Whether the sets of each pair link; for stars also what the member has and the centre lacks, and the reverse.

    The reverse (``missing``) is left empty for a member far from the centre, which is never asked for it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, others, common, good, outside, missing = [], [], [], [], [_EMPTY], [_EMPTY]
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = np.intersect1d(x, y, assume_unique=True)
                n = len(shared)
                sizes.append(len(x))
                others.append(len(y))
                common.append(n)
                good.append(100 * n >= 80 * (len(x) + len(y) - n))
                if deviations:
                    outside.append(np.setdiff1d(x, shared, assume_unique=True).view(np.int64))
                    near = 5 * n >= 4 * len(x)
                    missing.append(np.setdiff1d(y, shared, assume_unique=True).view(np.int64) if near else _EMPTY)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(others, pa.int64()),
                 pa.array(common, pa.int64()), pa.array(good, pa.bool_()), *(_lists(v, b.num_rows) for v in (outside, missing))],
                ["a", "b", "n_a", "n_b", "shared", "linked", "outside", "missing"])

    one, two = sets.select(F.col("node").alias("a"), F.col("elements").alias("x")), sets.select(
        F.col("node").alias("b"), F.col("elements").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, _VERIFIED)


def _lists(values: list[np.ndarray], rows: int) -> pa.Array:
    """A list column of the arrays after the first; without any, empty lists."""
    sizes = [len(v) for v in values[1:]] or [0] * rows
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)),
                                    pa.array(np.concatenate(values)))


_CELL = 2048  # most probing or held members of one element in a cell


def _within_stars(spokes: DataFrame, cell: int = _CELL) -> DataFrame:
    """``(a, b)``: members of one star, in different components, that may link.

    The members that link with the centre are of one component, the core; so one of the two is apart from it.

    With sizes n, s elements shared with the centre, and c the centre's size, x and y link if they share
    ``t = 4 (nx + ny) / 9`` elements.  At most ``min(sx, sy)`` of those lie in the centre.

    * One of them is far from the centre (5 s < 4 n, so it does not link with it): the two share at least
      ``t - min(sx, sy)`` elements *outside* the centre, ``4 n / 5 - s`` by the size of either alone, and one at
      least.  What all far members lack of the centre plays no part.
    * Both are near, one apart (so not linked with the centre): with the deviations D from the centre,
      ``18 * |Dx & Dy| >= 9 * |Dx| - nx + 9 * |Dy| - ny``, so the one apart shares at least ``(9 * |Dx| - nx - c) / 10``
      elements with any partner, as ny <= c + |Dy|, and a partner ``(1 + 9 * |Dy| - ny + c) / 18`` with any one apart.

    Both kinds meet in the rarest elements that can be shared, each in its own space (``far``: 1 or 0).
    """
    active = (spokes.groupBy("b").agg(F.max(F.expr("if(linked, component, null)")).alias("core"),
                                      (F.min("component") != F.max("component")).alias("several"))
              .where("several").select("b", "core"))
    deviation = F.expr("n_a + n_b - 2 * shared")
    members = spokes.join(active, "b").select(
        "b", "a", "component", F.col("n_a").alias("n"), F.col("shared").alias("s"),
        F.expr("5 * shared < 4 * n_a").alias("is_far"), F.expr("core is null or component != core").alias("apart"), "outside", "missing",
        (9 * deviation - F.col("n_a")).alias("need"), (9 * deviation - F.col("n_a") - F.col("n_b")).alias("excess"), "n_b")
    one = materialize(members, "members")
    narrow = [c for c in one.columns if c not in ("outside", "missing")]
    # a member's elements outside the centre, and a near one's deviation; what a member probes with and what it is found by
    spaces = materialize(
        one.select(*narrow, F.lit(1).alias("far"), F.col("is_far").alias("probes"), F.col("outside").alias("elements"),
                   F.expr("greatest(1L, (4 * n + 4) div 5 - s)").alias("ask"),
                   F.expr("greatest(1L, (4 * n + 4) div 5 - s)").alias("give"))
        .unionByName(one.where("not is_far").select(
            *narrow, F.lit(0).alias("far"), F.col("apart").alias("probes"), F.concat("outside", "missing").alias("elements"),
            F.expr("(excess + 9) div 10").alias("ask"), F.expr("(1 + need + n_b + 17) div 18").alias("give"))), "spaces")
    star = ["b", "far"]
    elements = spaces.select(*star, "a", "component", F.col("probes").cast("int").alias("probes"), F.explode("elements").alias("e"))
    # an element that no probing member or one component alone has joins nothing: rarer than all others, and left out
    live = (elements.groupBy(*star, "e").agg(F.count("*").alias("held"), F.sum("probes").alias("probed"),
                                             (F.min("component") != F.max("component")).alias("several"))
            .where("several and probed > 0").drop("several"))
    ranked = (elements.drop("component", "probes").join(live, [*star, "e"]).groupBy(*star, "a")
              .agg(F.sort_array(F.collect_list(F.struct("held", "e", "probed"))).alias("live")))
    found = spaces.drop("elements").join(ranked, [*star, "a"])

    def prefix(least: str) -> DataFrame:
        some = F.expr(f"cast(greatest(0L, least(size(live), size(live) - ({least}) + 1)) as int)")
        return (found.select("*", F.posexplode(F.slice("live", F.lit(1), some)).alias("at", "l"))
                .select(*star, "a", "component", (F.size("live") - F.col("at")).alias("rest"), "n", "s", "need", "probes", "l.*"))

    def cells(count: str) -> F.Column:
        return F.expr(f"(({count}) + {cell - 1}) div {cell}")

    held = (prefix("give").withColumn("row", F.expr("pmod(xxhash64(a), held)") % cells("held"))
            .withColumn("column", F.explode(F.sequence(F.lit(0).cast("long"), cells("probed") - 1)))
            .select(*star, "e", "row", "column", F.col("a").alias("y"), F.col("component").alias("cy"),
                    F.col("rest").alias("ry"), F.col("need").alias("dy"), F.col("n").alias("ny"), F.col("s").alias("sy"),
                    F.col("probes").alias("py")))
    probes = (prefix("ask").where("probes")
              .withColumn("column", F.expr("pmod(xxhash64(a), probed)") % cells("probed"))
              .withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), cells("held") - 1)))
              .select(*star, "e", "row", "column", F.col("a").alias("x"), F.col("component").alias("cx"),
                      F.col("rest").alias("rx"), F.col("need").alias("dx"), F.col("n").alias("nx"), F.col("s").alias("sx")))
    # in the first element they share, a pair still has all it shares before it; two probing members meet once
    enough = ("if(far = 1, 9 * (least(rx, ry) + least(sx, sy)) >= 4 * (nx + ny), 18 * least(rx, ry) >= dx + dy) "
              "and 5 * nx >= 4 * ny and 5 * ny >= 4 * nx")
    return (probes.join(held, [*star, "e", "row", "column"])
            .where(f"cx != cy and x != y and (x > y or not py) and {enough}")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def _fewer_stars(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """The stars ``(member a, centre b)``, those of one family around one centre.

    A family of near copies has a group, and so a star, for each signature that many of it share, mostly of the same
    members.  A centre that is a member of stars with smaller centres moves, with its members, to the smallest one
    that it links with.  Whoever was in one star still is: with the old centre as a member, and the pairs with the
    new centre are verified like any spoke.  One step only, so that a centre remains close to its members.
    """
    centres = stars.select(F.col("b").alias("a")).distinct()
    smaller = stars.where("b < a").join(centres, "a", "left_semi")
    homes = materialize(_verified(smaller, sets, deviations=False).where("linked")
                        .groupBy("a").agg(F.min("b").alias("home")), "homes")
    moved = stars.join(homes.withColumnRenamed("a", "b"), "b", "left").select("a", F.coalesce("home", "b").alias("b"))
    return materialize(moved.unionByName(homes.withColumnRenamed("home", "b")).where("a != b").distinct(), "stars")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row."""
    n_buckets = max(1, shuffle_partitions(docs.sparkSession))
    rows = id_and_text(docs, id_col, text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    signed = rows.mapInArrow(_sign(n_buckets, width), _BLOB)
    blobs = materialize(signed.repartitionById(n_buckets, F.col("bucket")).mapInArrow(_collide, _BLOB), "signatures")
    kind = F.col("kind")

    table = blobs.where(kind == DOC).select("base", "data").mapInArrow(
        _documents, "ref long, doc_id long, digest long, n long, fp1 long, fp2 long")
    same_set = ["fp1", "fp2", "n"]
    linked = table.where("doc_id is not null and n > 0")
    first = F.min(F.struct("doc_id", "digest")).alias("first")
    groups = linked.groupBy(*same_set).agg(first).select(*same_set, "first.*").withColumnRenamed("doc_id", "node")
    nodes = materialize(linked.select("ref", *same_set).join(groups, same_set)
                        .select("ref", "node", "n", F.col("digest").alias("node_digest")), "nodes")

    # the sets of a batch choose their probes together
    asked = blobs.where(kind.isin(DOC, MATCH)).repartition("base").sortWithinPartitions("base", "kind")
    chosen = materialize(asked.mapInArrow(_choose(n_buckets), _CHOSEN), "probes")
    held = blobs.where(kind == GROUP).select("bucket", "base", "data")
    found = materialize(held.groupBy("bucket").cogroup(chosen.groupBy("bucket")).applyInArrow(_first_round(n_buckets), _META),
                        "found")

    of = nodes.select("ref", "node")

    def by_node(pairs: DataFrame) -> DataFrame:
        return (pairs.join(of.toDF("x", "a"), "x").join(of.toDF("y", "b"), "y").where("a != b")
                .select("a", "b").distinct())

    stars = materialize(by_node(_pairs(found, STARS, n_buckets)), "stars")  # (member, centre)
    pairs = by_node(_pairs(found, PAIRS, n_buckets)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = materialize(pairs, "pairs")
    either = stars.unionByName(pairs)
    met = either.select(F.col("a").alias("node")).union(either.select(F.col("b").alias("node"))).distinct()
    wanted = (nodes.select("node", "node_digest").distinct().join(met, "node", "left_semi")
              .select(F.col("node").alias("doc_id"), F.col("node_digest").alias("digest")))

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1), width)], pa.binary())],
                ["node", "elements"])

    sets = materialize(rows.join(wanted, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
                       .select("doc_id", "text").mapInArrow(elements, "node long, elements binary"), "elements")
    around = materialize(_verified(_fewer_stars(stars, sets), sets, deviations=True), "around")
    links = materialize(_verified(pairs, sets, deviations=False).unionByName(around).where("linked").select("a", "b"),
                        "links")
    known = connected_components(links)

    component = known.select(F.col("node").alias("a"), "component")
    spokes = around.join(component, "a", "left").withColumn("component", F.coalesce("component", "a"))
    more = materialize(_verified(materialize(_within_stars(spokes), "candidates"), sets, deviations=False)
                       .where("linked").select("a", "b"), "links")
    if not more.isEmpty():
        known = connected_components(links.unionByName(more))

    named = groups.join(known, "node", "left").select(*same_set, F.coalesce("component", "node").alias("component_id"))
    result = table.select("doc_id", *same_set).join(named, same_set, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` (all columns) with one row of each group of near duplicates, the one with the smallest id.

    Rows that share an id are documents of their own: of the distinct (id, text) of a group the first by
    id, then by the text's SHA-256, stays.  Of rows with the same id and text the first in the order of the
    other columns' JSON text stays.  Rows without an id are all kept.  Texts without words are near nothing.
    """
    key, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    named, unnamed = docs.where(key.isNotNull()), docs.where(key.isNull())
    first, sha, nth = (_free(docs, c) for c in ("_first", "_sha", "_nth"))
    if named.groupBy(key.alias("k")).count().where("count > 1").isEmpty():
        found = near_duplicates(named, id_col=id_col, text_col=text_col, width=width)
        stay = found.where("doc_id = component_id").select(F.col("doc_id").alias(first))
        return named.join(stay, key == F.col(first), "left_semi").unionByName(unnamed)
    distinct = (named.select(key.alias("k"), F.sha2(text, 256).alias("sha"), text.alias("text"))
                .groupBy("k", "sha").agg(F.first("text").alias("text")))
    rows = materialize(ordered_scan(distinct, ["k", "sha"], row_number="number"), "rows")
    found = near_duplicates(rows, id_col="number", width=width).where("doc_id = component_id")
    stay = (rows.join(found.select(F.col("doc_id").alias("number")), "number", "left_semi")
            .select(F.col("k").alias(first), F.col("sha").alias(sha)))
    order = F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)), {"ignoreNullFields": "false"})
    kept = (named.withColumn(first, key).withColumn(sha, F.sha2(text, 256)).join(stay, [first, sha], "left_semi")
            .withColumn(nth, F.row_number().over(Window.partitionBy(first, sha).orderBy(order))).where(F.col(nth) == 1))
    return kept.select(*(f"`{c}`" for c in docs.columns)).unionByName(unnamed)
