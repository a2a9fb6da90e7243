"""Byte-level BPE over Arrow batches, one merge run per distinct word.

Natural text repeats its words, and BPE never merges across a pre-token
boundary.  A space whose two neighbours are not both white space always
starts a pre-token in the byte-level pattern, so a text can be cut there and
each distinct piece encoded once; the pieces' ids concatenated are exactly the
ids of the whole text.  Pieces of plain characters are cut further, into
their pre-tokens: runs of letters, of digits, of punctuation, and single line ends.  Texts where the
rule does not hold (a space between two white-space characters, a special token's string)
are encoded whole, and a tokenizer with another pre-tokenizer encodes every text whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillsight.llm.common import worker_state
from tillsight.llm.shingles import mix, text_bytes

#: Unicode white space (and the four separators that only some engines count).
WHITE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: characters of one class to every engine: letters, digits, punctuation but the apostrophe (which may open a contraction)
_PLAIN = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}0-9!-&(-/:-@\[-`{-~]"
#: a word whose pre-tokens are its runs of one class; a line end between two such characters stands alone
PLAIN_WORD = f"^{_PLAIN}+(?:\n{_PLAIN}+)*$"
_CLASS = np.full(256, 2, dtype=np.uint8)  # of each UTF-8 byte of a plain word: punctuation
_CLASS[[*range(0x30, 0x3A)]] = 1
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 0
_CLASS[0x0A] = _LINE_END = 3
#: distinct pieces kept per worker process (about 60 bytes each) before the store starts afresh
MAX_WORDS = 1_500_000
_RNG = np.random.default_rng(97)
_BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_BYTES = _RNG.integers(1, 1 << 62, (2, 256), dtype=np.uint64)


def tokenizer_path(name: str) -> str:
    """Where the vocabulary file lies on this machine (the package is installed on every node)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


class BatchEncoder:
    """``encode(texts)`` gives the ids of all texts and the bounds of each text."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.max_words = max_words
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if len(line_end) == 1 else None
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not pre.get("add_prefix_space") and not spec.get("normalizer")
                        and self.line_end is not None and not any(c.isspace() for t in added for c in t["content"]))
        marks = [t for t in added if t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])]
        self.separator = (marks[0]["content"], marks[0]["id"]) if marks else None
        unsafe = [f"{WHITE} {WHITE}"] + [_quote(t["content"]) for t in added]
        self.unsafe = "|".join(unsafe)
        spaced = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        spaced[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("\u0120")]] = True
        self.spaced = spaced  # ids of tokens that begin with a space
        self._reset()

    def _reset(self) -> None:
        self.keys = [np.empty(0, np.uint64), np.empty(0, np.uint64)]  # two digests of each piece, sorted by the first
        self.slots = np.empty(0, np.int32)
        self.pool = np.empty(1 << 20, dtype=np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 16, dtype=np.int64)
        self.sizes = np.zeros(1 << 16, dtype=np.int32)
        self.count = 2  # slot 0: no ids, slot 1: a line end
        if self.line_end is not None:
            self.pool[0], self.sizes[1], self.used = self.line_end, 1, 1

    def _encode_pieces(self, pieces: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces and the number of ids of each; ``words``: single pre-tokens, all after a space or none."""
        ids, sizes = [], []
        for lo in range(0, len(pieces), 1000):
            some = pieces[lo:lo + 1000]
            if words:
                # a space opens a pre-token, and a line end between two is one of its own
                spaced = some[0].startswith(" ")
                text = "".join(some) if spaced else "\n" + "\n".join(some)
                got = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                opens = self.spaced[got] if spaced else got == self.line_end
                sizes.append(np.diff(np.flatnonzero(opens), append=len(got)) - (not spaced))
                ids.append(got if spaced else got[~opens])
            elif self.separator:
                mark, mark_id = self.separator
                got = np.array(self.tokenizer.encode_batch_fast([mark.join(some)], add_special_tokens=False)[0].ids,
                               np.uint32)
                cuts = np.flatnonzero(got == mark_id)
                sizes.append(np.diff(cuts, prepend=-1, append=len(got)) - 1)
                ids.append(got[got != mark_id])
            else:
                found = self.whole(some)
                ids += found
                sizes.append(np.array([len(f) for f in found], dtype=np.int64))
        return np.concatenate(ids), np.concatenate(sizes)

    def _add(self, pieces: list[str], words: bool) -> np.ndarray:
        """Encode and store pieces; their slots."""
        data, sizes = self._encode_pieces(pieces, words)
        n = len(pieces)
        if len(sizes) != n or int(sizes.sum()) != len(data):
            raise ValueError("the tokenizer does not keep pieces apart")
        self.pool = _grown(self.pool, self.used + len(data))
        self.pool[self.used:self.used + len(data)] = data
        self.starts = _grown(self.starts, self.count + n)
        self.sizes = _grown(self.sizes, self.count + n)
        self.starts[self.count:self.count + n] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.count:self.count + n] = sizes
        self.used += len(data)
        self.count += n
        return np.arange(self.count - n, self.count)

    def _slots_of(self, bases: pa.Array, lead: str, words: bool) -> np.ndarray:
        """The slot of ``lead + base`` for each base."""
        coded = bases.dictionary_encode()
        distinct = coded.dictionary
        one, two = _digests(distinct, 2 * bool(lead) + words)
        at = np.minimum(np.searchsorted(self.keys[0], one), max(0, len(self.keys[0]) - 1))
        slots = np.full(len(one), -1, dtype=np.int64)
        if len(self.keys[0]):
            known = (self.keys[0][at] == one) & (self.keys[1][at] == two)
            slots[known] = self.slots[at[known]]
        if not lead:
            slots[np.asarray(pc.equal(pc.binary_length(distinct), 0))] = 0
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            new = [lead + p for p in distinct.take(pa.array(missing)).to_pylist()]
            slots[missing] = self._add(new, words)
            keys = [np.concatenate((k, d[missing])) for k, d in zip(self.keys, (one, two), strict=True)]
            order = np.argsort(keys[0], kind="stable")
            self.slots = np.concatenate((self.slots, slots[missing].astype(np.int32)))[order]
            self.keys = [k[order] for k in keys]
        return slots[coded.indices.to_numpy(zero_copy_only=False)]

    def _words(self, words: pa.Array, lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``lead + word`` for each word, and their bounds; plain words are stored by pre-token."""
        plain = np.asarray(pc.match_substring_regex(words, PLAIN_WORD))
        counts = np.ones(len(words), dtype=np.int64)
        runs, first, line_end = _runs(words.take(pa.array(np.flatnonzero(plain))))
        counts[plain] = np.diff(np.flatnonzero(first), append=len(runs))
        of_runs = np.ones(len(runs), dtype=np.int64)  # slot 1: a line end
        for at, before in ((first, lead), (~first & ~line_end, "")):
            if at.any():
                of_runs[at] = self._slots_of(runs.take(pa.array(np.flatnonzero(at))), before, words=True)
        in_plain = np.repeat(plain, counts)
        slots = np.empty(len(in_plain), dtype=np.int64)
        slots[in_plain] = of_runs
        if not plain.all():
            slots[~in_plain] = self._slots_of(words.take(pa.array(np.flatnonzero(~plain))), lead, words=False)
        ids, ends = self._gather(self.pool, self.starts[slots], self.sizes[slots])
        return ids, np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]

    @staticmethod
    def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)], ends

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text ``i`` has ``ids[bounds[i]:bounds[i + 1]]``; a null text has none."""
        texts = pc.fill_null(texts, "")
        n = len(texts)
        if not self.by_word:
            parts = self.whole(texts.to_pylist())
            return (np.concatenate([np.empty(0, np.uint32), *parts]),
                    np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int64))
        if self.count > self.max_words:
            self._reset()
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.unsafe).to_numpy(zero_copy_only=False))
        if len(odd):
            keep = np.ones(n, dtype=bool)
            keep[odd] = False
            whole = self.whole(texts.take(pa.array(odd)).to_pylist())
            texts = pc.if_else(pa.array(keep), texts, "")
        lists = pc.split_pattern(texts, " ")
        first = np.asarray(lists.offsets)[:-1].astype(np.int64) - lists.offsets[0].as_py()
        words = lists.flatten().dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False)
        names = words.dictionary
        later = np.ones(len(codes), dtype=bool)
        later[first] = False
        used = np.flatnonzero(np.bincount(codes[later], minlength=len(names)))
        spaced, spaced_bounds = self._words(names.take(pa.array(used)), " ")
        heads, head_bounds = self._words(names.take(pa.array(codes[first])), "")
        rank = np.zeros(len(names), dtype=np.int64)
        rank[used] = np.arange(len(used))
        word = rank[codes]
        begin = spaced_bounds[word]
        sizes = spaced_bounds[word + 1] - begin if len(used) else np.zeros(len(codes), dtype=np.int64)
        begin[first] = head_bounds[:-1] + len(spaced)
        sizes[first] = np.diff(head_bounds)
        ids, ends = self._gather(np.concatenate((spaced, heads)), begin, sizes)
        marks = np.concatenate((first, [len(codes)]))
        bounds = np.concatenate(([0], ends))[marks]
        if len(odd):
            pieces = np.split(ids, bounds[1:-1])
            for i, w in zip(odd, whole, strict=True):
                pieces[i] = w
            ids = np.concatenate(pieces)
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        return ids, bounds.astype(np.int64)


def _digests(texts: pa.Array, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each string."""
    data, bounds = text_bytes(texts)
    size = np.diff(bounds)
    place = np.arange(len(data)) - np.repeat(bounds[:-1], size)
    powers = np.cumprod(np.full((int(size.max(initial=0)) + 1, 2), _BASES, dtype=np.uint64), axis=0)
    out = []
    for k in range(2):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[k][data] * powers[place, k])))
        out.append(mix(total[bounds[1:]] - total[bounds[:-1]] + mix(size.astype(np.uint64) * np.uint64(4) + np.uint64(salt))))
    return out[0], out[1]


def _runs(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The runs of one class in plain words, which of them open a word and which are line ends."""
    data, bounds = text_bytes(words)
    kind = _CLASS[data]
    opens = np.zeros(len(data), dtype=bool)
    opens[bounds[:-1]] = True
    begin = np.flatnonzero(opens | (np.diff(kind, prepend=_LINE_END) != 0))
    offsets = np.append(begin, len(data)).astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_string(), len(begin),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return runs, opens[begin], kind[begin] == _LINE_END


def _quote(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    b = np.empty(max(n, 2 * len(a)), dtype=a.dtype)
    b[:len(a)] = a
    return b


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every text."""
    n = len(bounds) - 1
    out_bounds = bounds + np.arange(n + 1)
    out = np.full(len(ids) + n, end_id, dtype=np.uint32)
    body = np.ones(len(out), dtype=bool)
    body[out_bounds[1:] - 1] = False
    out[body] = ids
    return out, out_bounds


def encoder(path: str) -> BatchEncoder:
    """The worker process's encoder for this vocabulary file (made once, its words kept across tasks)."""
    store = worker_state().setdefault("encoders", {})
    if path not in store:
        store[path] = BatchEncoder(path)
    return store[path]
