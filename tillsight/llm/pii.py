"""Personal data (operator 5) by anchor expansion.

An Aho-Corasick automaton runs once over each text and reports anchors: the
at-sign, ``://``, a plus before a digit, digit pairs, digit-dot-digit, and cue
words such as "IBAN" or "account".  At each anchor a local parser expands to
the boundaries of the candidate and validates it (address parts, Luhn, digit
counts, the IBAN remainder).  Text without anchors is never parsed.

Kinds, in the order they are listed:

* ``email``, ``ip``, ``card``, ``phone``: the base kinds; leftmost and
  non-overlapping per kind, exactly as their patterns say (a candidate that
  fails validation is dropped and not retried);
* ``login``: user and password before the host of a URL;
* ``iban``, ``account``, ``ssn``: numbers that follow a cue word.

Spans are code points, end exclusive.  Null and empty texts have no spans; every
input row gives one row, repeated ids included; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import id_and_text, slices

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("login", "iban", "account", "ssn")
KINDS = BASE_KINDS + EXTRA_KINDS

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"://([^\s/@:]+:[^\s/@]+)@[A-Za-z0-9]")
_AFTER_CUE = re.compile(r"(?:\s*(?:no|nr|num|number|nummer)\b\.?)?[\s:#=.]{0,4}", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){7,16}(?![0-9])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])")
_CUES = {"iban": "iban", "account": "account", "acct": "account", "konto": "account", "cuenta": "account",
         "compte": "account", "ssn": "ssn", "social security": "ssn"}


def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    a.add_word("://", ("login", 3))
    for x in _DIGITS:
        a.add_word("+" + x, ("phone", 2))
        for y in _DIGITS:
            a.add_word(f"{x}.{y}", ("ip", 3))
            a.add_word(x + y, ("card", 2))
            a.add_word(f"{x} {y}", ("card", 3))
            a.add_word(f"{x}-{y}", ("card", 3))
    for cue, kind in _CUES.items():
        for form in (cue, cue.title(), cue.capitalize(), cue.upper()):
            a.add_word(form, (kind, len(form)))
    a.make_automaton()
    return a


def luhn(number: str) -> bool:
    """Whether the digits of ``number`` pass the Luhn check."""
    digits = [int(c) for c in number if c in _DIGITS]
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def iban_valid(number: str) -> bool:
    """Whether the letters and digits of ``number`` leave remainder 1 (ISO 13616)."""
    s = number.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def find_spans(text: str, automaton) -> list[Span]:
    """All spans of a text, by kind as listed, then by start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)  # where the search of each kind resumes
    for end, (kind, size) in automaton.iter(text):
        at = end + 1 - size
        if at < done[kind]:
            continue
        if kind == "email":
            if m := _DOMAIN.match(text, at):
                low = at
                while low > done[kind] and text[low - 1] in _LOCAL:
                    low -= 1
                if low < at:
                    found[kind].append((low, m.end()))
                    done[kind] = m.end()
        elif kind == "ip":
            low = at
            while low > done[kind] and text[low - 1] in _DIGITS:
                low -= 1
            if m := _IP.match(text, low):
                done[kind] = m.end()
                if all(map(_small, m.group().split("."))):
                    found[kind].append(m.span())
        elif kind == "card":
            m = _CARD.match(text, at)
            done[kind] = m.end()
            if m.end() - at >= 16:
                n = sum(c in _DIGITS for c in m.group())
                if 16 <= n <= 19 and luhn(m.group()):
                    found[kind].append(m.span())
        elif kind == "phone":
            if m := _PHONE.match(text, at):
                done[kind] = m.end()
                if 8 <= sum(c in _DIGITS for c in m.group()) <= 15:
                    found[kind].append(m.span())
        elif kind == "login":
            if m := _LOGIN.match(text, at):
                done[kind] = m.end(1)
                found[kind].append(m.span(1))
        elif not (at and text[at - 1].isalnum()):  # a cue word
            parser = {"iban": _IBAN, "account": _ACCOUNT, "ssn": _SSN}[kind]
            low = _AFTER_CUE.match(text, end + 1).end()
            named = kind
            m = parser.match(text, low)
            if kind == "account" and not m and (m := _IBAN.match(text, low)):
                named = "iban"
            if m and low >= done[named] and (named != "iban" or iban_valid(m.group())):
                found[named].append(m.span())
                done[named] = m.end()
    return [(k, a, b) for k in KINDS for a, b in found[k]]


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping spans become one."""
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join(out) + text[at:]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the number of each base kind, the digest of the base spans, and all spans."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for b in slices(batches):
            spans = [find_spans(t, automaton) for t in b.column(1).to_pylist()]
            counts = [pa.array([sum(s[0] == k for s in row) for row in spans], pa.int64()) for k in BASE_KINDS]
            digests = [hashlib.sha256(_joined([s for s in row if s[0] in BASE_KINDS]).encode()).hexdigest()
                       for row in spans]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, pa.array(digests, pa.string()), pa.array(map(_joined, spans), pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    rows = id_and_text(docs, id_col, text_col)
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return rows.mapInArrow(scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {counts}, "
                                 "base_sha256 string, spans string")


def mask_personal_data(docs: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span of ``text_col`` masked; ``length_col`` (if present) is brought up to date.

    All other columns, whatever their names, and all rows are kept; a null text stays null.
    """

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for b in slices(batches, text_col):
            i = b.schema.get_field_index(text_col)
            texts = b.column(i).to_pylist()
            clean = [t if t is None else mask(t, find_spans(t, automaton)) for t in texts]
            yield b.set_column(i, b.schema.field(i), pa.array(clean, b.schema.field(i).type))

    out = docs.mapInArrow(cover, docs.schema)
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.length(f"`{text_col}`").cast(kind))
    return out
