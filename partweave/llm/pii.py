"""Personal data with offset-preserving deobfuscation.

Plain identifiers are found by their patterns (the base). Then a chain of small
transducers rewrites the text step by step: invisible characters go, homoglyphs
and full-width forms become ASCII, spelled digits become digits, at/dot
disguises become ``@`` and ``.``. Each step yields, with the new text, the source
position of every character, so an identifier found in the rewritten text is
mapped back to the span of source characters it came from. Spans found that way
are added unless a base span of their kind overlaps; base spans always stay.

A rewritten text is searched only where something was rewritten: a found span
must contain a rewritten character, so clean text gains nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def identifiers(text: str) -> list[Span]:
    """Base spans by kind, then start: leftmost, not overlapping within a kind; a
    match that fails its kind's check is dropped without another try."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _DIGITS.sub("", m.group())) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


# Characters that look like ASCII ones, by script.
_GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαινορυχϲ", "ABEZHIKMNOPTYXaivopuxc", strict=True))
_CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝ", "ABESIJKMHOPCTYXaesijopcyxhdqw", strict=True))
_MARKS = {
    "＠": "@", "﹫": "@", "．": ".", "。": ".", "․": ".", "﹒": ".", "｡": ".", "·": ".", "•": ".",
    "＋": "+", "﹢": "+", "－": "-", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "（": "(", "）": ")",
    " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
}
_FULL_WIDTH = {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
_DIGIT_FORMS = {chr(zero + d): str(d) for zero in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
_ENCLOSED = {chr(0x2460 + d): str(d + 1) for d in range(9)} | {"⓪": "0"}
_SUPER = dict(zip("⁰⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉", "04567890123456789", strict=True))
_GLYPHS = _FULL_WIDTH | _GREEK | _CYRILLIC | _MARKS | _DIGIT_FORMS | _ENCLOSED | _SUPER
_GLYPH = re.compile("[" + "".join(map(re.escape, _GLYPHS)) + "]+")
_INVISIBLE = re.compile("[­᠎​-‏‪-‮⁠-⁤︀-️﻿]+")

# Digits in English, German, French and Spanish; at and dot likewise.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "nought": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9", "niner": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
_TIMES = {"double": 2, "triple": 3}
_NUMBER = "(?:" + "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True)) + r")(?![^\W_])"
_UNIT = rf"(?:(?:double|triple)[\s-]+)?(?:{_NUMBER}|[0-9])"
_POINT = r"\s?(?:\.|\b(?:dot|point|punkt|punto)\b)\s?"
_ANY_NUMBER = re.compile(rf"(?<![^\W_]){_NUMBER}")
_RUN = re.compile(rf"(?:\bplus[\s-]+|\+\s?)?(?<![^\W_]){_UNIT}(?:(?:[\s,()-]{{0,3}}|{_POINT}){_UNIT})+(?![^\W_])")
_STEP = re.compile(
    rf"(?P<sign>\bplus[\s-]+|\+\s?)|(?P<times>double|triple)[\s-]+(?P<more>{_NUMBER}|[0-9])|(?P<word>{_NUMBER})|(?P<point>{_POINT})|(?P<gap>[\s,()-]+)"
)
_MIXED = re.compile(r"[0-9][OoIl]|[OoIl][0-9]")
_MIXED_RUN = re.compile(r"(?<![^\W_])[0-9OoIl]+(?![^\W_])")
_LIKE_DIGIT = {"O": "0", "o": "0", "I": "1", "l": "1"}

_AT_WORDS, _DOT_WORDS = "at|arobase|arroba|klammeraffe", "dot|punkt|punto|point"
_AT_SIGN = rf"\s*[\[({{<]\s*(?:{_AT_WORDS}|a|ät|@)\s*[\])}}>]\s*|&#0*64;|&commat;|%40|_at_|\s+@\s*|@\s+"
_AT = re.compile(rf"(?P<sign>{_AT_SIGN})|(?P<word>\s+(?:{_AT_WORDS})\s+)|(?P<plain>@)")
_DOT = rf"\s*[\[({{<]\s*(?:{_DOT_WORDS}|d0t|\.)\s*[\])}}>]\s*|&#0*46;|&period;|%2e|_dot_|\s+(?:{_DOT_WORDS})\s+|\s\.\s?(?=[a-z0-9])"
_DOT_ONE = re.compile(_DOT)
_DOMAIN_ANY = re.compile(rf"[a-z0-9-]+(?:(?:\.|{_DOT})[a-z0-9-]+)+")
_DOMAIN_HID = re.compile(rf"[a-z0-9-]+(?:\.[a-z0-9-]+)*(?:{_DOT})[a-z0-9-]+(?:(?:\.|{_DOT})[a-z0-9-]+)*")
_LOCAL_HID = re.compile(rf"(?:[a-z0-9%+_-]+(?:\.|{_DOT}))*[a-z0-9._%+-]+\Z")
_LOCAL_REACH = 256  # an address part has at most 64 characters; disguised dots make it longer


class _Source:
    """A text under rewriting: for each character, the source span it stands for
    and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = self.end = self.new = None

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces ``text[a:b]`` by a string for each ``(a, b, string)``, in order of ``a``; every
        new character stands for the whole source span of what it replaces."""
        if not edits:
            return
        if self.start is None:
            self.start = np.arange(len(self.text))
            self.end = self.start + 1
            self.new = np.zeros(len(self.text), bool)
        text, start, end, new, done = [], [], [], [], 0
        for a, b, put in [*edits, (len(self.text), len(self.text), "")]:
            text += [self.text[done:a], put]
            start += [self.start[done:a], np.full(len(put), self.start[a] if put else 0)]
            end += [self.end[done:a], np.full(len(put), self.end[b - 1] if put else 0)]
            new += [self.new[done:a], np.ones(len(put), bool)]
            done = b
        self.text = "".join(text)
        self.start, self.end, self.new = np.concatenate(start), np.concatenate(end), np.concatenate(new)


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _glyphs(s: _Source) -> None:
    if not s.text.isascii():
        s.apply([(*m.span(), "") for m in _INVISIBLE.finditer(s.text)])
        found = _GLYPH.finditer(s.text)
        s.apply([(i, i + 1, _GLYPHS[s.text[i]]) for m in found for i in range(*m.span())])


def _lookalikes(s: _Source) -> None:
    if _MIXED.search(s.text):
        s.apply(
            [
                (i, i + 1, _LIKE_DIGIT[s.text[i]])
                for m in _MIXED_RUN.finditer(s.text)
                if any(c.isdigit() for c in m.group())
                for i in range(*m.span())
                if s.text[i] in _LIKE_DIGIT
            ]
        )


def _spelled(s: _Source) -> None:
    low = _lower(s.text)
    if not _ANY_NUMBER.search(low):
        return
    edits = []
    for run in _RUN.finditer(low):
        if not _ANY_NUMBER.search(low, *run.span()):
            continue
        for m in _STEP.finditer(low, *run.span()):
            if m["sign"]:
                put = "+"
            elif m["times"]:
                put = _DIGIT_WORDS.get(m["more"], m["more"]) * _TIMES[m["times"]]
            elif m["word"]:
                put = _DIGIT_WORDS[m["word"]]
            else:
                put = "." if m["point"] else ""
            edits.append((*m.span(), put))
    s.apply(edits)


def _addresses(s: _Source) -> None:
    low, edits, done = _lower(s.text), [], 0
    for at in _AT.finditer(low):
        if at.start() < done:
            continue
        domain = (_DOMAIN_ANY if at["sign"] else _DOMAIN_HID).match(low, at.end())
        if not domain:
            continue
        near = low[max(done, at.start() - _LOCAL_REACH) : at.start()]
        local = _LOCAL_HID.search(near)
        if not local:
            continue
        first = at.start() - len(near) + local.start()
        edits += [(*m.span(), ".") for m in _DOT_ONE.finditer(low, first, at.start())]
        edits.append((*at.span(), "@"))
        edits += [(*m.span(), ".") for m in _DOT_ONE.finditer(low, *domain.span())]
        done = domain.end()
    s.apply(edits)


def hidden_identifiers(text: str, base: list[Span]) -> list[Span]:
    """Spans of disguised identifiers, in source positions; none overlaps one of its kind in ``base``."""
    s = _Source(text)
    for step in (_glyphs, _lookalikes, _spelled, _addresses):
        step(s)
    if s.start is None:
        return []
    taken, out = {k: [(a, b) for kind, a, b in base if kind == k] for k in KINDS}, []
    for kind, a, b in identifiers(s.text):
        if s.new[a:b].any():
            first, last = int(s.start[a]), int(s.end[b - 1])
            if all(last <= x or y <= first for x, y in taken[kind]):
                taken[kind].append((first, last))
                out.append((kind, first, last))
    return out


_FOUND = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_()), ("value", pa.string())])
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            text = text or ""
            base = identifiers(text)
            spans = [(k, a, b, False) for k, a, b in base] + [(k, a, b, True) for k, a, b in hidden_identifiers(text, base)]
            spans.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
            rows.append([{"kind": k, "start": a, "end": b, "added": n, "value": text[a:b]} for k, a, b, n in spans])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _FOUND)], ["doc_id", "found"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, found`` for each row: ``found`` lists kind, start, end (code points, end
    exclusive), whether deobfuscation added it, and the source text, by kind
    (email, ip, card, phone) and start. Null texts count as empty; repeated rows
    are searched each; ids may be null; other columns, whatever their names, are ignored. A very long
    text is read in one task, in time linear in it. An empty table gives no rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = "array<struct<kind:string,start:long,end:long,added:boolean,value:string>>"
    return in_arrow(rows, _find, f"doc_id {id_type}, found {found}")
