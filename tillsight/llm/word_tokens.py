"""Encoding for tokenizers that drop white space, one merge run per distinct word.

Where the normaliser works character by character (NFC, white space, lower case) and the
pre-tokenizer drops white space, nothing is ever merged or composed across a space: a text
can be cut at its spaces and line ends, each distinct word encoded once, and the words' ids concatenated
are exactly the ids of the whole text.  Other tokenizers encode every text whole.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillsight.llm.common import worker_state
from tillsight.llm.tokens import BatchEncoder

#: letters to every engine that stay one letter in lower case (the dotted capital I does not), and a tail that never joins them
_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
_LETTERS = re.compile(_LETTER)
_NONE = np.empty(0, np.uint32)


class WordEncoder(BatchEncoder):
    """``encode(texts)`` gives the ids of all texts and the bounds of each text."""

    def __init__(self, path: str, max_words: int = 1_500_000):
        super().__init__(path, max_words)
        spec = json.loads(self.tokenizer.to_str())
        added = spec.get("added_tokens") or []
        self.marks = [t["content"] for t in added]
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"]
                        for t in added)
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_space = (plain and self.separator is not None and _local(spec.get("normalizer"))
                         and _drops_space(spec.get("pre_tokenizer")))
        self.folds = any(s["type"] == "Lowercase" for s in _steps(spec.get("normalizer"), "normalizers"))
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)  # ids that end a word
        if suffix:
            self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def _encode_pieces(self, pieces: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces: words of plain letters, words that hold a special token's text, and the rest."""
        kinds = [0 if _LETTERS.fullmatch(p) else 2 if any(m in p for m in self.marks) else 1 for p in pieces]
        parts: list[np.ndarray] = [_NONE] * len(pieces)
        for kind, encode in enumerate((self._letters, super()._encode_pieces, self._special)):
            at = [i for i, k in enumerate(kinds) if k == kind]
            if at:
                ids, sizes = encode([pieces[i] for i in at], False)
                for i, ids_of in zip(at, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
                    parts[i] = ids_of
        return np.concatenate([_NONE, *parts]), np.array([len(p) for p in parts], dtype=np.int64)

    def _letters(self, pieces: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters alone: each ends with the one id that carries the end-of-word suffix."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, np.uint32)
        sizes = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        return (ids, sizes) if len(sizes) == len(pieces) else super()._encode_pieces(pieces, False)

    def _special(self, pieces: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        found = self.whole(pieces)
        return np.concatenate(found), np.array([len(f) for f in found], dtype=np.int64)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word and their bounds; letters and a tail of ``.,`` are stored apart."""
        plain = np.asarray(pc.match_substring_regex(words, f"^{_LETTER}[.,]*$"))
        slots = np.zeros((len(words), 2), dtype=np.int64)
        at = np.flatnonzero(plain)
        some = words.take(pa.array(at))
        base = pc.utf8_rtrim(some, ".,")
        slots[at, 0] = self._slots_of(pc.ascii_lower(base) if self.folds else base, "", words=False)
        cut = np.flatnonzero(np.asarray(pc.binary_length(base)) < np.asarray(pc.binary_length(some)))
        if len(cut):
            tail = pc.replace_substring_regex(some.take(pa.array(cut)), "^[^.,]+", "")
            slots[at[cut], 1] = self._slots_of(tail, "", words=False)
        rest = np.flatnonzero(~plain)
        slots[rest, 0] = self._slots_of(words.take(pa.array(rest)), "", words=False)
        slots = slots.ravel()
        ids, ends = self._gather(self.pool, self.starts[slots], self.sizes[slots])
        return ids, np.concatenate(([0], ends[1::2])).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text ``i`` has ``ids[bounds[i]:bounds[i + 1]]``; a null text has none."""
        if not self.by_space:
            return super().encode(texts)
        if self.count > self.max_words:
            self._reset()
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        marks = np.asarray(lists.offsets).astype(np.int64)
        words = lists.flatten().dictionary_encode()
        ids, bounds = self._distinct(words.dictionary)
        word = words.indices.to_numpy(zero_copy_only=False)
        ids, ends = self._gather(ids, bounds[word], np.diff(bounds)[word])
        return ids, np.concatenate(([0], ends)).astype(np.int64)[marks - marks[0]]


def _steps(spec: dict | None, kind: str) -> list[dict]:
    if not spec:
        return []
    return spec[kind] if spec.get("type") == "Sequence" else [spec]


def _local(normalizer: dict | None) -> bool:
    """Whether no step of the normaliser looks past a space."""
    return all(s["type"] in ("NFC", "Lowercase") or
               (s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " ")
               for s in _steps(normalizer, "normalizers"))


def _drops_space(pre_tokenizer: dict | None) -> bool:
    """Whether the first split keeps only matches of a pattern that no white space can be part of."""
    first = next(iter(_steps(pre_tokenizer, "pretokenizers")), {})
    if first.get("type") == "WhitespaceSplit":
        return True
    pattern = first.get("pattern", {}).get("Regex", " ")
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
            and pattern.replace("[^\\s", "").find("\\s") < 0 and "." not in pattern and " " not in pattern)


def word_encoder(path: str) -> WordEncoder:
    """The worker process's encoder for this vocabulary file."""
    store = worker_state().setdefault("word_encoders", {})
    if path not in store:
        store[path] = WordEncoder(path)
    return store[path]
