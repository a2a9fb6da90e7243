"""Phrase collocation mining (operator 13) by prefix-free parsing.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, pieces into words.  A
candidate is a phrase of 2 to ``max_words`` words that occurs at least ``min_count`` times in its
language; its score is the least, over all cuts in two, of
``floor(1000 * count * n / (count of the first part * count of the rest))``.

Parsing.  The words of a text are cut into chunks where their content says so: two neighbouring
words whose joint hash is 0 modulo ``period`` start a new chunk, so equal passages are cut alike
wherever they stand.  A chunk also holds the ``max_words - 1`` words that follow it (its overlap,
up to the end of their piece).  Distinct chunks form a dictionary with their frequency in the
parse.  Every n-gram is counted in the one chunk where it starts, as often as that chunk
occurs; an overlap's words start nothing, so nothing is counted twice.

Counting over the dictionary:

1. words, exactly;
2. phrases of two words by 64-bit hash, then longer ones by hash, each only where its parts are
   frequent.  "Is frequent" is a bit table of ``filter_bits`` bits at most, whatever the input:
   a bit set by another phrase lets a rare phrase through, it never loses one;
3. the phrases that are left, exactly, by their words.

So rare phrases, nearly all there are, never travel as text.  Every count is combined in the task
before it is shuffled, so a word or phrase that fills a third of a corpus is a few entries; hashes
travel as sorted arrays and exact counts as record batches, one row per bucket, not per entry.  All sums and products are exact (decimals of 38 digits).

Null text is empty, a null language counts as ``und``.  Repeated rows all count, the id is not
read, nor are other columns.  Ties in score and count go by the phrase's UTF-8 bytes.  An empty table, or one without a frequent phrase, gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import binary_array, give_back, materialize, slices, worker_state
from tillsight.llm.shingles import mix, text_bytes
from tillsight.session import shuffle_partitions

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
#: words between two cuts of the parse, on average
PERIOD = 32
#: a chunk without a cut ends after so many words
LONGEST = 512
#: largest bit table that is broadcast, in bits (8 MB)
FILTER_BITS = 1 << 26
#: rows that one task may rank at the end
RANKED = 200_000
#: hashes that a task holds before it deals them out, and of the dictionary's words for each bucket
HELD = 1 << 21
_CHUNK = "lang string, own int, words string"
_HASHES = "bucket int, size int, hashes binary, counts binary"
_RNG = np.random.default_rng(1301)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: part of a word, 1: between words, 2: between pieces
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _hashes(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, given its letters end to end."""
    if not len(size):
        return np.empty(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(first, size)
    powers = np.cumprod(np.full(int(size.max()), _BASE, dtype=np.uint64))
    return mix(np.add.reduceat(_BYTE[data] * powers[place], first) + size.astype(np.uint64))


def _marks(text: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each word's length, first 8 and last 8 bytes: enough to say where to cut."""
    eights = np.ndarray(len(text), dtype="<u8", buffer=np.append(text, np.zeros(8, np.uint8)), strides=(1,))
    some = np.minimum(size, 8)
    drop = (64 - 8 * some).astype(np.uint64)
    head, tail = eights[first] << drop, eights[first + size - some] << drop
    return mix(mix(head) + tail * _BASE + size.astype(np.uint64))


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
          period: int = PERIOD) -> DataFrame:
    """The dictionary ``(lang, own, words, freq, hashes)`` in the shared folder.

    ``words`` are a chunk's words with one byte between two: a line end where the piece ends, else a
    space.  The first ``own`` words belong to the chunk, the rest is overlap.
    ``hashes`` has 32 bits for each word, so that the passes that count by hash read no text.
    """
    overlap = max_words - 1

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, max_bytes=1 << 20):
            data, bounds = text_bytes(b.column(1))
            if not len(data):
                continue
            kind = _KIND[data]
            inside = kind == 0
            start, last = inside.copy(), inside.copy()
            start[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            inner = bounds[(bounds > 0) & (bounds < len(data))]  # no word goes from one text to the next
            start[inner] |= inside[inner]
            last[inner - 1] |= inside[inner - 1]
            begin = np.flatnonzero(start)
            if not len(begin):
                continue
            end = np.flatnonzero(last) + 1
            size = end - begin
            doc = np.searchsorted(bounds, begin, side="right") - 1
            new_doc = np.diff(doc, prepend=-1) != 0
            new_piece = np.append(new_doc, False)
            new_piece[np.searchsorted(begin, np.flatnonzero(kind == 2))] = True  # the word after each piece end
            new_piece = new_piece[:-1]
            ends = np.append(new_piece[1:], True)  # the word ends its piece
            # the words' letters, after each word the byte that follows it
            spaced = end < len(data)
            spaced[spaced] = ~inside[end[spaced]]
            kept = inside
            kept[end[spaced]] = True
            text = _LOWER[data[kept]]
            offset = np.concatenate(([0], np.cumsum(size + spaced)))
            text[(offset[:-1] + size)[spaced]] = np.where(ends[spaced], np.uint8(0x0A), np.uint8(0x20))
            hashes = _marks(text, offset[:-1], size)
            cut = new_doc.copy()
            cut[1:] |= mix(hashes[:-1] * _STEP + hashes[1:]) % np.uint64(period) == 0
            at = np.flatnonzero(cut)
            gap = np.diff(at, append=len(begin))
            if gap.max() > LONGEST:  # no cut for long: every LONGEST words from the last one
                extra = (gap - 1) // LONGEST
                k = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra)
                at = np.sort(np.concatenate((at, np.repeat(at, extra) + (k + 1) * LONGEST)))
                gap = np.diff(at, append=len(begin))
            # words after the chunk, to the end of the piece of its last word
            stop = np.append(np.flatnonzero(new_piece), len(begin))
            until = stop[np.searchsorted(stop, at + gap - 1, side="right")]
            till = np.minimum(at + gap + overlap, np.maximum(until, at + gap))
            lo = offset[at]
            n = offset[till - 1] + size[till - 1] - lo
            out = np.concatenate(([0], np.cumsum(n)))
            body = text[np.repeat(lo - out[:-1], n) + np.arange(out[-1])]
            words = pa.Array.from_buffers(pa.large_string(), len(at),
                                          [None, pa.py_buffer(out.astype(np.int64)), pa.py_buffer(body)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc[at])), pa.array(gap.astype(np.int32)), words.cast(pa.string())],
                ["lang", "own", "words"])

    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    counted = rows.mapInArrow(chunks, _CHUNK).groupBy("lang", "own", "words").agg(F.count("*").alias("freq"))
    return materialize(counted.mapInArrow(_with_hashes, f"{_CHUNK}, freq long, hashes binary"), "phrase-dictionary")


def _with_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "words", 4 << 20):
        w = _Words(b)
        yield pa.RecordBatch.from_arrays([*b.columns, binary_array(w.hashes(), w.bounds)], [*b.schema.names, "hashes"])


class _Words:
    """The words of a batch of dictionary rows, as codes into their distinct values."""

    def __init__(self, b: pa.RecordBatch):
        data, bounds = text_bytes(b.column(b.schema.get_field_index("words")))
        spaces = np.flatnonzero(_KIND[data])
        # each word with the byte after it, if there is one
        cuts = np.sort(np.concatenate((spaces + 1, bounds)))
        coded = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1,
                                      [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        plain = pc.ascii_rtrim_whitespace(coded.dictionary).cast(pa.string()).dictionary_encode()
        self.names = plain.dictionary
        self.code = plain.indices.to_numpy(zero_copy_only=False)[coded.indices.to_numpy(zero_copy_only=False)]
        langs = b.column(b.schema.get_field_index("lang")).dictionary_encode()
        self.langs = langs.dictionary
        self.bounds = np.searchsorted(cuts, bounds)
        self.lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(self.bounds))
        self.linked = data[cuts[1:] - 1] == 0x20  # the next word follows in the same piece

    def hashes(self) -> np.ndarray:
        """For each word 31 bits of its hash in its language, above the bit that says whether it is linked."""
        both = mix(_whole(self.names)[self.code] + mix(_whole(self.langs))[self.lang])
        return (both >> np.uint64(32)).astype(np.uint32) & ~np.uint32(1) | self.linked


def _whole(names: pa.Array) -> np.ndarray:
    """A hash of each string."""
    data, bounds = text_bytes(names)
    size = np.diff(bounds)
    out = np.zeros(len(size), dtype=np.uint64)
    some = size > 0
    out[some] = _hashes(data, bounds[:-1][some], size[some])
    return out


class _Hashed:
    """The words of a batch of dictionary rows by their stored hashes."""

    def __init__(self, b: pa.RecordBatch):
        own, freq, hashes = (b.column(b.schema.get_field_index(c)) for c in ("own", "freq", "hashes"))
        data, bounds = text_bytes(hashes)
        bounds = bounds // 4
        size = np.diff(bounds)
        word = data.view(np.uint32)
        self.hash = (word >> np.uint32(1)).astype(np.uint64)
        self.linked = (word & np.uint32(1)).astype(bool)
        self.starts = np.arange(len(word)) < np.repeat(bounds[:-1] + own.to_numpy(zero_copy_only=False), size)
        self.weight = np.repeat(freq.to_numpy(zero_copy_only=False), size)

    def phrases(self, at: np.ndarray, n: int) -> np.ndarray:
        """The hashes of the ``n`` words from each of these words on."""
        out = mix(self.hash[at])
        for j in range(1, n):
            out = mix(out * _STEP + self.hash[at + j])
        return out

    def among(self, may: np.ndarray, n: int, table: BitTable) -> np.ndarray:
        """Which of the words ``may`` begin a phrase of ``n`` words that is in the table."""
        at = np.flatnonzero(may)
        out = np.zeros(len(may), dtype=bool)
        out[at[table.has(self.phrases(at, n))]] = True
        return out


def _at(mask: np.ndarray, j: int) -> np.ndarray:
    """``mask`` at the word ``j`` places on."""
    out = np.zeros(len(mask), dtype=bool)
    out[:max(0, len(mask) - j)] = mask[j:]
    return out


def _sums(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(distinct keys, exact sum of their weights)``; keys that weigh 1, nearly all there are, are only sorted."""
    once = np.sort(keys[weight == 1])
    first = np.flatnonzero(np.diff(once, prepend=~once[:1]))
    many = np.flatnonzero(weight != 1)
    if not len(many):
        return once[first], np.diff(first, append=len(once))
    keys = np.concatenate((once[first], keys[many]))
    weight = np.concatenate((np.diff(first, append=len(once)), weight[many]))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[first], np.add.reduceat(weight[order], first)


class BitTable:
    """Whether a hash is among those added: no misses, some false hits."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = h & np.uint64(self.bits - 1)
        return (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def bit_table(hashes: DataFrame, rows: int, most_bits: int) -> BitTable:
    """A table of the column ``h``: at most ``most_bits`` bits come to the driver, merged by Spark first."""
    bits = 1 << 16
    while bits < 32 * rows and bits < min(most_bits, 1 << 32):
        bits *= 2

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 64, dtype=np.uint64)
        for b in batches:
            slot = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(bits - 1)
            np.bitwise_or.at(table, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(table[used].view(np.int64))],
                                         ["i", "w"])

    merged = hashes.select("h").mapInArrow(sparse, "i int, w long").groupBy("i").agg(F.bit_or("w").alias("w")).toArrow()
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[merged["i"].to_numpy()] = merged["w"].to_numpy().view(np.uint64)
    return BitTable(words, bits)


def _dealt(size: int, keys: np.ndarray, weight: np.ndarray, buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket for the hashes that occur once here, one for the others with their counts up to ``most``."""
    placed = (keys >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)
    placed, total = _sums(placed, weight)
    for some in (total == 1, total != 1):
        here, counts = placed[some], np.minimum(total[some], most).astype(np.uint32)
        bounds = np.searchsorted(here, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        used = np.flatnonzero(np.diff(bounds))
        if len(used):
            bounds = np.append(bounds[used], len(here))
            hashes = binary_array(here.astype(np.uint32), bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(np.full(len(used), size, np.int32)), hashes,
                 binary_array(counts, bounds) if counts[0] > 1 else pa.nulls(len(used), pa.binary())],
                ["bucket", "size", "hashes", "counts"])


def hashed_counts(dictionary: DataFrame, lengths: list[int], part: int, table: BitTable, min_count: int,
                  buckets: int) -> DataFrame:
    """``(size, h)`` of the phrases of these lengths whose hash reaches ``min_count``; ``h`` is its lower half.

    Only phrases whose parts of ``part`` words are all in the table count.  Hashes travel as sorted
    arrays per bucket, in which they are 32 bits; phrases that share bucket and bits are one.
    """
    shared = dictionary.sparkSession.sparkContext.broadcast(table)
    most = min(min_count, (1 << 32) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        kept: dict[int, list] = {n: [] for n in lengths}
        held = 0
        for b in batches:
            w = _Hashed(b)
            may, here = np.ones(len(w.hash), dtype=bool), w.starts.copy()
            for j in range(part - 1):
                may &= _at(w.linked, j)
            known = w.among(may, part, shared.value)
            links = parts = 0  # how many of each are in ``here``
            for n in lengths:
                for j in range(links, n - 1):
                    here &= _at(w.linked, j)
                links = n - 1
                for j in range(parts, n - part + 1):
                    here &= _at(known, j)
                parts = n - part + 1
                at = np.flatnonzero(here)
                kept[n].append((w.phrases(at, n), w.weight[at]))
                held += len(at)
            if held > HELD:
                yield from flushed(kept)
                held = 0
        yield from flushed(kept)
        give_back()

    def flushed(kept: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for n, found in kept.items():
            if found:
                keys, weight = (np.concatenate(x) for x in zip(*found, strict=True))
                found.clear()
                if len(keys):
                    yield from _dealt(n, keys, weight, buckets, most)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        found = defaultdict(list)
        for b in batches:
            for bucket, size, hashes, counts in zip(*(c.to_pylist() for c in b.columns[:2]), *b.columns[2:], strict=True):
                found[bucket, size].append((np.frombuffer(hashes.as_buffer(), np.uint32),
                                            np.frombuffer(counts.as_buffer(), np.uint32) if counts.is_valid else None))
        for (_, size), parts in found.items():
            packed = np.concatenate([h.astype(np.uint64) << np.uint64(32) | (np.uint64(1) if c is None else c)
                                     for h, c in parts])
            packed.sort()
            keys = (packed >> np.uint64(32)).astype(np.uint32)
            first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            often = keys[first][np.add.reduceat(packed & np.uint64(0xFFFFFFFF), first) >= most]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(often), size, np.int32)),
                                              pa.array(often.astype(np.int64))], ["size", "h"])
        found.clear()
        give_back()

    return materialize(dictionary.select("own", "freq", "hashes").mapInArrow(count, _HASHES)
                       .repartitionById(buckets, F.col("bucket")).mapInArrow(merge, "size int, h long"), "phrase-hashes")


def _exact(w: _Words, at: np.ndarray, n: int, hashes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(where each phrase stands, its exact count)`` of the phrases of ``n`` words at these words."""
    space = len(w.langs) * len(w.names)
    if n == 1 and space <= 4 * len(w.code):
        key = w.lang[at].astype(np.int64) * len(w.names) + w.code[at]
        total, place = np.zeros(space, dtype=np.int64), np.zeros(space, dtype=np.int64)
        np.add.at(total, key, weight)
        place[key] = at
        found = np.flatnonzero(total)
        return place[found], total[found]
    order = np.argsort(hashes)
    new = np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0
    first = np.flatnonzero(new)
    # equal hashes, equal words?
    of = at[order]
    like = of[first][np.cumsum(new) - 1]
    if any((w.code[of + j] != w.code[like + j]).any() for j in range(n)) or (w.lang[of] != w.lang[like]).any():
        key = w.lang[at].astype(np.int64)
        for j in range(n):  # one word more, made dense each time
            key = np.unique(key, return_inverse=True)[1] * len(w.names) + w.code[at + j]
        order = np.argsort(key)
        first = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
    return at[order[first]], np.add.reduceat(weight[order], first)


def joined(batches: Iterator[pa.RecordBatch], text: str, min_bytes: int) -> Iterator[pa.RecordBatch]:
    """Record batches put together until they hold so much text."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.column(x.schema.get_field_index(text)).nbytes for x in held) >= min_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def exact_counts(dictionary: DataFrame, found: Callable[[_Words, _Hashed], Iterator[tuple[int, np.ndarray]]],
                 min_count: int, buckets: int) -> DataFrame:
    """``(lang, phrase, f)``: exact counts, from ``min_count`` on, of phrases of so many words found at these words.

    Counts are added up in the task, and travel as one record batch per bucket of hashes.
    """
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for b in slices(joined(batches, "words", 8 << 20), "words", 16 << 20):
            w, h = _Words(b), _Hashed(b)
            for n, at in found(w, h):
                if not len(at):
                    continue
                at, total = _exact(w, at, n, h.phrases(at, n), h.weight[at])
                parts = [w.names.take(pa.array(w.code[at + j])) for j in range(n)]
                bucket = (h.phrases(at, n) >> np.uint64(32)) % np.uint64(buckets)
                kept.append(pa.RecordBatch.from_arrays(
                    [pa.array(bucket.astype(np.int32)), w.langs.take(pa.array(w.lang[at])),
                     pc.binary_join_element_wise(*parts, " "), pa.array(total)], ["bucket", *schema.names]))
            if sum(x.num_rows for x in kept) > HELD:
                yield from dealt(kept)
        yield from dealt(kept)

    def dealt(kept: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            return
        rows = added(pa.Table.from_batches(kept), ["bucket", "lang", "phrase"]).sort_by("bucket").combine_chunks()
        kept.clear()
        used, first = np.unique(rows["bucket"].to_numpy(), return_index=True)
        rows = rows.select(schema.names).to_batches()[0]
        parts = [rows.slice(i, j - i).serialize().to_pybytes()
                 for i, j in zip(first.tolist(), [*first[1:].tolist(), rows.num_rows], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(parts, pa.binary())], ["bucket", "rows"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        parts = [pa.ipc.read_record_batch(rows.as_buffer(), schema) for b in batches for rows in b.column(1)]
        if parts:
            rows = added(pa.Table.from_batches(parts), ["lang", "phrase"])
            del parts
            yield from rows.filter(pc.greater_equal(rows["f"], min_count)).to_batches(max_chunksize=50_000)
            del rows
        give_back()

    def added(rows: pa.Table, keys: list[str]) -> pa.Table:
        return (rows.group_by(keys, use_threads=False).aggregate([("f", "sum")]).rename_columns([*keys, "f"]))

    return (dictionary.mapInArrow(count, "bucket int, rows binary").repartitionById(buckets, F.col("bucket"))
            .mapInArrow(merge, "lang string, phrase string, f long"))


def word_counts(dictionary: DataFrame, min_count: int, buckets: int) -> DataFrame:
    """``(lang, phrase, h, f)``: the exact counts of all words that reach ``min_count``, with their hashes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = mix(mix(_whole(b.column(1)) + mix(_whole(b.column(0)))) >> np.uint64(33))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(h.view(np.int64)), b.column(2)],
                                             ["lang", "phrase", "h", "f"])

    counts = exact_counts(dictionary, lambda w, h: iter([(1, np.flatnonzero(h.starts))]), min_count, buckets)
    return counts.mapInArrow(hashed, "lang string, phrase string, h long, f long")


def phrase_counts(dictionary: DataFrame, tables: dict[int, BitTable], min_count: int, buckets: int) -> DataFrame:
    """``(lang, phrase, f)``: exact counts of all phrases of two words or more that reach ``min_count``."""
    shared = dictionary.sparkSession.sparkContext.broadcast(tables)

    def found(w: _Words, h: _Hashed) -> Iterator[tuple[int, np.ndarray]]:
        may = h.linked
        for n in range(2, max(shared.value) + 1):
            if n not in shared.value:
                break
            known = h.among(may, n, shared.value[n])
            yield n, np.flatnonzero(known & h.starts)
            may = known & _at(known, 1) & _at(h.linked, n - 1)  # a phrase's parts are as frequent as it is

    return exact_counts(dictionary, found, min_count, buckets)


def frequent_phrases(dictionary: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                     filter_bits: int = FILTER_BITS) -> DataFrame:
    """``(lang, phrase, f)`` of all words and phrases with at least ``min_count`` occurrences."""
    held = dictionary.agg(F.sum(F.col("own").cast("long"))).first()[0] or 0
    least = shuffle_partitions(dictionary.sparkSession)
    many, few = max(least, -(-held // HELD)), max(least, -(-held // (4 * HELD)))
    words = materialize(word_counts(dictionary, min_count, few), "phrase-words")
    singles = words.select("lang", "phrase", "f")
    if max_words < 2:
        return singles
    table = bit_table(words, words.count(), filter_bits)
    pairs = hashed_counts(dictionary, [2], 1, table, min_count, many)
    tables = {2: bit_table(pairs, pairs.count(), filter_bits)}
    if max_words > 2:
        longer = hashed_counts(dictionary, list(range(3, max_words + 1)), 2, tables[2], min_count, many)
        rows = {r["size"]: r["count"] for r in longer.groupBy("size").count().collect()}
        tables |= {n: bit_table(longer.where(F.col("size") == n), rows[n], filter_bits) for n in sorted(rows)}
    return materialize(singles.unionByName(phrase_counts(dictionary, tables, min_count, few)), "phrases")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, phrase, size, a, l, r, n, score)`` of all candidates, at their lowest-scoring cut.

    ``phrases`` holds every candidate and, as they are at least as frequent, every part of one.
    """
    exact = "decimal(19,0)"
    split = F.split("phrase", " ")
    candidates = phrases.withColumn("w", split).withColumn("size", F.size("w")).where("size > 1")
    cuts = (candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "size", F.col("f").alias("a"), "k",
                    F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("right")))
    part = phrases.select("lang", F.col("phrase").alias("p"), "f")
    counted = (cuts.join(part.select("lang", F.col("p").alias("left"), F.col("f").alias("l")), ["lang", "left"])
               .join(part.select("lang", F.col("p").alias("right"), F.col("f").alias("r")), ["lang", "right"])
               .join(totals, "lang")
               .withColumn("score", F.expr(f"(cast(a as {exact}) * cast(n as {exact}) * cast(1000 as decimal(4,0))) "
                                           f"div (cast(l as {exact}) * cast(r as {exact}))")))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return (counted.groupBy("lang", "phrase", "size", "a", "n").agg(lowest)
            .select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score"))


def without_contained(candidates: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """Candidates that no longer candidate holds as often as they occur."""
    w = F.split("phrase", " ")
    inner = (candidates.where("size > 2").withColumn("w", w)
             .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
             .select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), F.col("a").alias("f"))
             .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    return (candidates.join(inner, ["lang", "phrase"], "left")
            .where("longer is null or 100 * longer < 100 * a").drop("longer"))


def top_ranked(rows: DataFrame, top: int, count: int, ranked: int = RANKED) -> DataFrame:
    """Each language's first ``top`` rows with their rank.

    Ranked in rounds: a language's rows are dealt to groups by phrase, only each group's first rows go
    on, until all that may be left of a language fits in one group.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    groups = 1
    while count > groups * ranked:
        groups *= 16
    while groups > 1:
        deal = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(groups))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(deal)).where(F.col("rank") <= top).drop("rank")
        groups //= 16
    return (rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))


def mine(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
         min_count: int = MIN_COUNT, top: int = TOP, period: int = PERIOD, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best collocations."""
    dictionary = parse(docs, text_col, lang_col, max_words, period)
    totals = (dictionary.groupBy("lang").agg(F.sum(F.col("own").cast("long") * F.col("freq")).alias("n")))
    candidates = materialize(scored(frequent_phrases(dictionary, max_words, min_count, filter_bits), totals),
                             "phrase-scores")
    kept = without_contained(candidates, max_words)
    ranked = top_ranked(kept, top, candidates.count())
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
