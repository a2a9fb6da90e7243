"""Suffix-array deduplication (operator 3): remove byte strings that occur earlier.

Every byte covered by a 100-byte string that also starts earlier (smaller id, or
earlier in the same text) is removed; overlaps count and strings are judged on the
input.  Suffixes are sorted by a difference-cover algorithm (``suffix_ranks``):
the sampled positions (index modulo 3 not 0) are sorted by their triples and named,
the names are sorted by recursion, the remaining positions are sorted by their
first character and the next rank, and the two lists are merged; adjacent suffixes are then
compared in their first 100 bytes.

To distribute the work without moving every suffix, each 100-byte string is assigned by its own
content: its anchor is the smallest hash among its 50-byte substrings.  Equal
strings have equal anchors, so

1. a scan sends the anchors' hashes (about one in 26 bytes) to buckets and keeps the ones
   that occur twice; strings around all other anchors are unique;
2. the texts that hold such anchors send, per anchor, the fragment of text whose
   strings have this anchor; equal fragments are merged on both sides of the shuffle, so a passage
   that all texts share travels once per task;
3. each bucket sorts the suffixes of its distinct fragments, whole anchors at a time, and reports every
   string that is not the first of its kind.

Copies of a whole text of 100 bytes or more are removed entirely; only the first is searched.
Texts are UTF-8; null counts as empty; matches never cross texts.  Rows without an id come
first; rows that repeat an id are ordered by their place in the table.  ``docs`` must give the same rows when read
again (files do).  Every row gives one row; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import id_and_text, materialize, slices, worker_state
from tillsight.llm.shingles import mix, text_bytes
from tillsight.session import shuffle_partitions

LENGTH = 100
GRAM = 50
_SPAN = LENGTH - GRAM + 1  # substrings of GRAM bytes in a string
_CHUNK = 1 << 20
_PRIME = 0x9E3779B97F4A7C15
_RNG = np.random.default_rng(31)
_BYTE = _RNG.integers(1, 1 << 62, 256, dtype=np.uint64)
DOC, SIG = 0, 1
_BLOB = "kind int, bucket int, data binary"
_DOC = np.dtype([("id", "<i8"), ("has_id", "<i8"), ("place", "<i8"), ("digest", "<i8"), ("n_bytes", "<i8"), ("sha", "S64")])
_LOW16 = np.uint64(0xFFFF)


# ---------------------------------------------------------------- anchors

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    store = worker_state()
    if len(store.get("powers", ((),))[0]) < n:
        size = max(n, _CHUNK + 2 * LENGTH)
        inverse = pow(_PRIME, -1, 1 << 64)
        store["powers"] = tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, x, np.uint64))))
                                for x in (_PRIME, inverse))
    return store["powers"]


def _sliding(a: np.ndarray, width: int, f) -> np.ndarray:
    """``f`` over each window of ``width`` values."""
    step = 1
    out = a
    while step * 2 <= width:
        out = f(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return f(out[:len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each GRAM-byte substring, anchor of each LENGTH-byte string; 0 where the string is not ``valid``)."""
    up, down = _powers(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)])))
    grams = mix((total[GRAM:] - total[:-GRAM]) * down[:len(data) - GRAM + 1]) | np.uint64(1)
    least = _sliding(grams, _SPAN, np.minimum)
    return grams, np.where(valid[:len(least)], least, np.uint64(0))


def _chunks(data: np.ndarray, valid: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for low in range(0, max(0, len(data) - LENGTH + 1), _CHUNK):
        part = slice(low, low + _CHUNK + LENGTH - 1)
        yield low, *anchors(data[part], valid[low:low + _CHUNK])


def valid_starts(bounds: np.ndarray) -> np.ndarray:
    """Where a LENGTH-byte string that stays inside its text can start."""
    out = np.ones(int(bounds[-1]), dtype=bool)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out[max(a, b - LENGTH + 1):b] = False
    return out


def anchor_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of each place that is the anchor of some string."""
    values, texts = [], []
    for low, grams, least in _chunks(data, valid_starts(bounds)):
        edge = np.zeros(_SPAN - 1, np.uint64)
        most = _sliding(np.concatenate((edge, least, edge)), _SPAN, np.maximum)  # of the strings that hold the place
        at = np.flatnonzero(most == grams)
        values.append(grams[at])
        texts.append(np.searchsorted(bounds, at + low, side="right") - 1)
    if not values:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(values), np.concatenate(texts)


def fragments(data: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(anchor, first string, past the last string) of each run of strings with one wanted anchor; sorted ``wanted``."""
    valid = valid_starts(np.array([0, len(data)]))
    for low, _, least in _chunks(data, valid):
        head = np.flatnonzero(np.diff(least, prepend=~least[:1]))
        end = np.append(head[1:], len(least))
        value = least[head] & ~_LOW16
        at = np.searchsorted(wanted, value)
        keep = (least[head] > 0) & (wanted[np.minimum(at, len(wanted) - 1)] == value) if len(wanted) else at < 0
        yield from zip(value[keep].tolist(), (head[keep] + low).tolist(), (end[keep] + low).tolist(), strict=True)


# ---------------------------------------------------------------- suffixes

def _dense(*columns: np.ndarray) -> np.ndarray:
    """Dense ranks (from 0) of the rows of the columns in lexicographic order."""
    key, bits = None, 0
    for c in columns:
        c = c.astype(np.uint64)
        width = max(1, int(c.max(initial=0)).bit_length())
        if key is None:
            key, bits = c, width
            continue
        if bits + width > 64:
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            bits = max(1, int(key.max(initial=0)).bit_length())
        if bits + width > 64:
            c = np.unique(c, return_inverse=True)[1].astype(np.uint64)
            width = max(1, int(c.max(initial=0)).bit_length())
        key, bits = (key << np.uint64(width)) | c, bits + width
    return np.unique(key, return_inverse=True)[1]


def _smaller(of: np.ndarray, than: np.ndarray) -> np.ndarray:
    """How many of ``of`` are smaller than each of ``than``; both are ranks below a few times their number."""
    count = np.bincount(of, minlength=int(than.max(initial=0)) + 1)
    return (np.cumsum(count) - count)[than]


def suffix_ranks(chars: np.ndarray, cover: int, depth: int) -> np.ndarray:
    """Ranks of all suffixes of ``chars`` (``cover`` bytes each), right for suffixes that differ in ``depth`` bytes.

    Suffixes that agree in ``depth`` bytes may have equal or different ranks, but
    no other suffix ranks between them.
    """
    n = len(chars)
    padded = np.concatenate((chars, np.zeros(3, chars.dtype)))
    index = np.arange(n)
    one, two, none = index[1::3], index[2::3], index[0::3]
    sample = np.concatenate((one, two))
    names = _dense(padded[sample], padded[sample + 1], padded[sample + 2])
    if 3 * cover < depth and len(sample) > 3 and int(names.max(initial=0)) + 1 < len(sample):
        names = suffix_ranks(names + 1, 3 * cover, depth)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample] = names + 1
    # the others meet the first class by (character, next rank), the second by (two characters, the rank after)
    k1 = _dense(np.concatenate((padded[none], padded[one])), np.concatenate((rank[none + 1], rank[one + 1])))
    k2 = _dense(np.concatenate((padded[none], padded[two])), np.concatenate((padded[none + 1], padded[two + 1])),
                np.concatenate((rank[none + 2], rank[two + 2])))
    a1, b1, a2, b2 = k1[:len(none)], k1[len(none):], k2[:len(none)], k2[len(none):]
    out = np.empty(n, dtype=np.int64)
    own = _smaller(names, names)
    out[none] = _smaller(a1, a1) + _smaller(b1, a1) + _smaller(b2, a2)
    out[one] = own[:len(one)] + _smaller(a1, b1)
    out[two] = own[len(one):] + _smaller(a2, b2)
    return out


def string_classes(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in suffix order, and whether each begins a new LENGTH-byte string.

    The text's four-byte words at the four byte residues, one after the other, are the string
    whose suffixes are sorted: every byte position is a suffix, 25 words long.
    """
    padded = np.concatenate((text, np.zeros(LENGTH + 8, np.uint8)))
    n = -(-len(padded) // 4) * 4
    padded = np.concatenate((padded, np.zeros(n - len(padded) + 8, np.uint8)))
    words = np.concatenate([padded[r:r + n].view(">u4").astype(np.uint64) for r in range(4)])
    ranks = suffix_ranks(words, 4, LENGTH)
    order = starts[np.argsort(ranks[(starts % 4) * (n // 4) + starts // 4], kind="stable")]
    new = np.ones(len(order), dtype=bool)
    if len(order) > 1:
        # compare each suffix with the one before it, eight bytes at a time
        eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
        same = np.ones(len(order) - 1, dtype=bool)
        for off in (*range(0, LENGTH - 7, 8), LENGTH - 8):
            live = np.flatnonzero(same)
            if not len(live):
                break
            value = np.ascontiguousarray(eight[order + off]).view(np.uint64).ravel()
            same &= value[1:] == value[:-1]
        new[1:] = ~same
    return order, new


def repeated_strings(texts: list[bytes], keys: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(fragment, first, past the last) of the runs of strings in ``texts`` that begin earlier elsewhere.

    ``keys`` has each fragment's (order of its document, its own order, its place there).
    """
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(texts), dtype=np.uint8)
    windows = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = begin[owner] + offset
    order, new = string_classes(text, starts)
    documents = {d: i for i, d in enumerate(sorted({k[:2] for k in keys}))}
    place = np.array([(documents[k[:2]] << 36) + k[2] for k in keys], dtype=np.int64)
    at = np.zeros(len(text), dtype=np.int64)
    at[starts] = place[owner] + offset
    head = np.flatnonzero(new)
    first = np.repeat(np.minimum.reduceat(at[order], head), np.diff(head, append=len(order)))
    repeated = np.zeros(len(text) + 1, dtype=bool)
    repeated[order] = at[order] > first
    flags = repeated[starts]
    edge = np.concatenate(([True], owner[1:] != owner[:-1], [True]))  # runs end at a fragment's end
    on = np.concatenate(([False], flags, [False]))
    lows = np.flatnonzero(flags & (edge[:-1] | ~on[:-2]))
    highs = np.flatnonzero(flags & (edge[1:] | ~on[2:]))
    for a, b in zip(lows.tolist(), highs.tolist(), strict=True):
        yield int(owner[a]), int(offset[a]), int(offset[b]) + 1


# ---------------------------------------------------------------- jobs

def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, bucket, data = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()),
                                       pa.array(data, pa.binary())], ["kind", "bucket", "data"])


def _buckets(values: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each anchor; anchors are least hashes, so they are scrambled once more to spread."""
    return ((mix(values & ~_LOW16) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _scan(n_buckets: int):
    """Each text's size and digests, and the anchors of distinct texts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place = TaskContext.get().partitionId(), 0
        seen: set[bytes] = set()
        for b in slices(batches, max_bytes=2 << 20):
            data, bounds = text_bytes(b.column(1))
            rows = np.zeros(b.num_rows, dtype=_DOC)
            rows["has_id"] = np.asarray(b.column(0).is_valid())
            rows["id"] = pa.compute.fill_null(b.column(0), 0).to_numpy(zero_copy_only=False)
            rows["place"] = (task << 36) + place + np.arange(b.num_rows)
            rows["digest"] = b.column(2).to_numpy()
            rows["n_bytes"] = np.diff(bounds)
            place += b.num_rows
            fresh = []
            for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                digest = hashlib.sha256(data[lo:hi]).hexdigest().encode()
                rows[i]["sha"] = digest
                if hi - lo >= LENGTH and digest not in seen:
                    seen.add(digest)
                    fresh.append(i)
            yield _blobs([(DOC, task % n_buckets, rows.tobytes())])
            if not fresh:
                continue
            if len(fresh) < b.num_rows:  # copies within a task need no second look
                data = np.concatenate([data[bounds[i]:bounds[i + 1]] for i in fresh])
                bounds = np.concatenate(([0], np.cumsum(rows["n_bytes"][fresh])))
            values, texts = anchor_places(data, bounds)
            for lo in range(0, len(fresh), 1 << 15):
                some = (texts >= lo) & (texts < lo + (1 << 15))
                packed = (values[some] & ~_LOW16) | (texts[some] - lo).astype(np.uint64)
                bucket = _buckets(packed, n_buckets)
                order = np.argsort(bucket, kind="stable")
                packed, bucket = packed[order], bucket[order]
                digests = rows["digest"][fresh[lo:lo + (1 << 15)]]
                cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
                out = []
                for k in range(n_buckets):
                    if cuts[k] < cuts[k + 1]:
                        part = packed[cuts[k]:cuts[k + 1]]
                        held, number = np.unique(part & _LOW16, return_inverse=True)
                        out.append((SIG, k, np.concatenate((
                            np.array([len(held)], np.uint64), digests[held.astype(np.int64)].view(np.uint64),
                            (part & ~_LOW16) | number.astype(np.uint64))).tobytes()))
                yield _blobs(out)

    return run


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: (digest of the text, anchor) of the anchors that occur in two texts or twice in one."""
    values, digests, batch = [], [], []
    for b in batches:
        kinds = b.column(0).to_pylist()
        yield _blobs([(DOC, 0, d.as_py()) for k, d in zip(kinds, b.column(2), strict=True) if k == DOC])
        for k, d in zip(kinds, b.column(2), strict=True):
            if k == SIG:
                a = np.frombuffer(d.as_buffer(), np.uint64)
                n = int(a[0])
                values.append(a[1 + n:] & ~_LOW16)
                digests.append(a[1:1 + n][(a[1 + n:] & _LOW16).astype(np.int64)])
                batch.append(np.full(len(a) - 1 - n, len(batch)))
    if not values:
        return
    values, digests, batch = map(np.concatenate, (values, digests, batch))
    order = np.argsort(values, kind="stable")
    values, digests, batch = values[order], digests[order], batch[order]
    head = np.flatnonzero(np.diff(values, prepend=~values[:1]))
    size = np.diff(head, append=len(values))
    # one entry of a batch and text: other entries of that text in the same batch are other places of the anchor
    texts = np.minimum.reduceat(digests, head) != np.maximum.reduceat(digests, head)
    again = np.zeros(len(head), dtype=bool)
    group = np.repeat(np.arange(len(head)), size)
    pair = np.lexsort((digests, batch, group))
    same = (np.diff(group[pair]) == 0) & (np.diff(batch[pair]) == 0) & (digests[pair][1:] == digests[pair][:-1])
    again[group[pair][1:][same]] = True
    keep = np.repeat(texts | again, size)
    found = np.unique(np.column_stack((digests[keep], values[keep])), axis=0)
    for lo in range(0, len(found), 1 << 16):
        yield _blobs([(SIG, 0, found[lo:lo + (1 << 16)].tobytes())])


def _decode_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for d in b.column(0):
            rows = np.frombuffer(d.as_buffer(), _DOC)
            ids = pa.array(rows["id"].copy(), mask=rows["has_id"] == 0)
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(rows[c].copy()) for c in ("place", "digest", "n_bytes")),
                 pa.array([s.decode() for s in rows["sha"].tolist()], pa.string())],
                ["doc_id", "place", "digest", "n_bytes", "sha"])


def _decode_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, its anchors) of each text, once per task or for every few million anchors."""
    held: list[np.ndarray] = []
    size = 0

    def out() -> pa.RecordBatch:
        rows = np.concatenate([np.empty((0, 2), np.uint64), *held])
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        head = np.flatnonzero(np.diff(rows[:, 0], prepend=~rows[:1, 0]))
        parts = np.split(rows[:, 1], head[1:]) if len(head) else []
        return pa.RecordBatch.from_arrays([pa.array(rows[head, 0].view(np.int64)),
                                           pa.array([p.tobytes() for p in parts], pa.binary())], ["digest", "anchors"])

    for b in batches:
        for d in b.column(0):
            held.append(np.frombuffer(d.as_buffer(), np.uint64).reshape(-1, 2))
            size += len(held[-1])
            if size > 4 << 20:
                yield out()
                held, size = [], 0
    yield out()


_FRAGMENT = "bucket int, anchor long, document long, place long, low long, text binary, done boolean"


def _cut(n_buckets: int):
    """Fragments around the wanted anchors of each text; equal fragments of a task once, the rest as done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _FRAGMENT.split(", ")]
        kinds = [pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.bool_()]
        first: dict[bytes, tuple[int, int, int, int]] = {}
        held = 0

        def rows(out: list[tuple]) -> pa.RecordBatch:
            cols = zip(*out, strict=True) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        def flush() -> pa.RecordBatch:
            anchors_ = np.fromiter((v[0] for v in first.values()), np.uint64, len(first))
            buckets = _buckets(anchors_, n_buckets).tolist()
            return rows([(k, a, d, p, lo, t, False) for k, a, (t, (_, d, p, lo)) in
                         zip(buckets, anchors_.view(np.int64).tolist(), first.items(), strict=True)])

        for b in slices(batches):
            done = []
            for document, place, text, wanted in zip(*(b.column(i) for i in range(4)), strict=True):
                document, place, text = document.as_py(), place.as_py(), text.as_py().encode()
                wanted = np.sort(np.frombuffer(wanted.as_buffer(), np.uint64))
                data = np.frombuffer(text, np.uint8)
                for anchor, lo, hi in fragments(data, wanted):
                    piece = text[lo:hi + LENGTH - 1]
                    new = (anchor, document, place, lo)
                    old = first.get(piece)
                    if old is None:
                        first[piece] = new
                        held += len(piece) + 200
                    elif new[1:] < old[1:]:
                        first[piece] = new
                        done.append((old, hi - lo))
                    else:
                        done.append((new, hi - lo))
            yield rows([(-1, size, d, p, lo, b"", True) for (_, d, p, lo), size in done])
            if held > 64 << 20:
                yield flush()
                first, held = {}, 0
        yield flush()

    return run


_MARK = "place long, low long, high long"


def _sort_bucket(block_bytes: int):
    """One bucket: strings that begin earlier, from the suffix order of the distinct fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, tuple[int, int, int]] = {}  # fragment -> its first (document, place, low)
        by_anchor: dict[int, list[bytes]] = {}

        def marks(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
            cols = zip(*out, strict=True) if out else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["place", "low", "high"])

        for b in batches:
            out = []
            for anchor, document, place, low, text in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                new, old = (document, place, low), first.get(text)
                if old is None:
                    first[text] = new
                    by_anchor.setdefault(anchor, []).append(text)
                    continue
                later = max(new, old)
                first[text] = min(new, old)
                out.append((later[1], later[2], later[2] + len(text) - LENGTH + 1))
            yield marks(out)
        block: list[bytes] = []
        size = 0

        def solve() -> pa.RecordBatch:
            keys = [first[t] for t in block]
            return marks([(keys[k][1], keys[k][2] + a, keys[k][2] + z) for k, a, z in repeated_strings(block, keys)])

        for anchor in sorted(by_anchor):  # whole anchors at a time
            texts = by_anchor[anchor]
            if len(texts) == 1 and len(texts[0]) == LENGTH:
                continue
            block += texts
            size += sum(map(len, texts))
            if size > block_bytes:
                yield solve()
                block, size = [], 0
        if block:
            yield solve()

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without its marked strings."""
    for b in batches:
        out = []
        for place, text, lows, highs in zip(*(b.column(i) for i in range(4)), strict=True):
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            change = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(change, np.asarray(lows.values), 1)
            np.add.at(change, np.asarray(highs.values) - 1 + LENGTH, -1)
            gone = np.cumsum(change[:-1]) > 0
            spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            out.append((place.as_py(), int(gone.sum()), spans, data[~gone].tobytes()))
        cols = zip(*out, strict=True) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["place", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   block_bytes: int = 1 << 20) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row.

    ``kept`` holds the remaining bytes of the texts that lost a part but not all
    (null elsewhere: the text is unchanged where ``n_removed`` is 0, empty where it equals ``n_bytes``).
    """
    n_buckets = max(1, shuffle_partitions(docs.sparkSession))
    rows = id_and_text(docs, id_col, text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    blobs = materialize(rows.mapInArrow(_scan(n_buckets), _BLOB).repartitionById(n_buckets, F.col("bucket"))
                        .mapInArrow(_twice, _BLOB), "anchors")
    table = blobs.where(F.col("kind") == DOC).select("data").mapInArrow(
        _decode_docs, "doc_id long, place long, digest long, n_bytes long, sha string")
    first = table.groupBy("sha").agg(F.min(F.struct("doc_id", "place")).alias("f"), F.first("digest").alias("digest"),
                                     F.first("n_bytes").alias("n_bytes"))
    first = first.select("sha", "digest", "n_bytes", F.col("f.doc_id").alias("first_id"), F.col("f.place").alias("place"))

    # a text's own anchors: their number is bounded by its length
    wanted = (blobs.where(F.col("kind") == SIG).select("data").mapInArrow(_decode_anchors, "digest long, anchors binary")
              .groupBy("digest").agg(F.array_join(F.transform(F.collect_list("anchors"), F.hex), "").alias("anchors")))
    wanted = wanted.select("digest", F.unhex("anchors").alias("anchors"))
    least = F.lit(-(1 << 63))
    chosen = (first.where(F.col("n_bytes") >= LENGTH).join(wanted, "digest")
              .select("digest", F.coalesce("first_id", least).alias("document"), "place", "anchors"))
    source = rows.select(F.coalesce("doc_id", least).alias("document"), "digest", "text")
    texts = materialize(source.join(chosen, ["document", "digest"]).dropDuplicates(["place"])
                        .select("document", "place", "text", "anchors"), "texts")

    pieces = texts.mapInArrow(_cut(n_buckets), _FRAGMENT)
    everywhere = pieces.withColumn("bucket", F.expr(f"if(done, cast(pmod(xxhash64(place), {n_buckets}) as int), bucket)"))
    dealt = everywhere.repartitionById(n_buckets, F.col("bucket"))
    marks = materialize(dealt.select("anchor", "document", "place", "low", "text", "done").mapInArrow(
        _split_done(_sort_bucket(block_bytes)), _MARK), "marks")
    per_text = marks.groupBy("place").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))
    changed = texts.select("place", "text").join(per_text, "place").select("place", "text", "lows", "highs").mapInArrow(
        _kept, "place long, n_removed long, n_spans long, kept binary")

    whole = F.col("is_first") | (F.col("n_bytes") < LENGTH)
    result = (table.join(first.select("sha", F.col("place").alias("first_place")), "sha")
              .withColumn("is_first", F.col("place") == F.col("first_place")).join(changed, "place", "left"))
    return result.select(
        "doc_id", "n_bytes",
        F.when(whole, F.coalesce("n_removed", F.lit(0))).otherwise(F.col("n_bytes")).alias("n_removed"),
        F.when(whole, F.coalesce("n_spans", F.lit(0))).otherwise(F.lit(1)).cast("long").alias("n_spans"),
        F.when(~whole, F.sha2(F.lit(b""), 256)).when(F.col("n_removed") > 0, F.sha2("kept", 256))
        .otherwise(F.col("sha")).alias("kept_sha256"),
        F.when(whole & (F.col("n_removed") > 0), F.col("kept")).alias("kept"))


def _split_done(sort):
    """Pass the strings already known to be repeated through as marks, sort the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[pa.RecordBatch] = []

        def rest() -> Iterator[pa.RecordBatch]:
            for b in batches:
                done = b.column(5)
                some = b.filter(done)
                if some.num_rows:
                    low = some.column(3)
                    known.append(pa.RecordBatch.from_arrays(
                        [some.column(2), low, pa.compute.add(low, some.column(0))], ["place", "low", "high"]))
                yield b.filter(pa.compute.invert(done))

        for out in sort(rest()):
            yield from known
            known.clear()
            yield out
        yield from known

    return run
