"""Texts whose characters were read in the wrong encoding, or otherwise damaged on their way, made readable again."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings that UTF-8 is read in by mistake, likely ones first; and how often in a row.
ENCODINGS, DEPTH = ("windows-1252", "latin-1", "mac-roman", "cp437", "windows-1251"), 3


def _bytes_of(encoding: str) -> dict[str, int]:
    """The byte of each character of an encoding; bytes that it leaves out stand for the control characters of their number."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


_BYTES = {e: _bytes_of(e) for e in ENCODINGS}


def _damage(encoding: str) -> re.Pattern:
    """Whole UTF-8 sequences of two to four bytes as they look in an encoding."""
    chars = {b: re.escape(c) for c, b in _BYTES[encoding].items()}
    some = lambda lo, hi: "[" + "".join(chars[b] for b in range(lo, hi + 1)) + "]"
    tail = some(0x80, 0xBF)
    return re.compile(f"{some(0xC2, 0xDF)}{tail}|{some(0xE0, 0xEF)}{tail}{{2}}|{some(0xF0, 0xF4)}{tail}{{3}}")


_DAMAGED = {e: _damage(e) for e in ENCODINGS}
#: What a lone sequence of two bytes has to look like to be taken for damage; two letters may well be meant.
_ODD_TAIL = re.compile(r"[^\w\s]|[\x80-\x9fªºƒˆŠŒŽšœžŸ¹²³¼½¾µ]")
#: First halves of such sequences, symbols that do not stand before letters.
_ODD_HEADS = frozenset("√¬├┬┼─╨╤")
_UNSEEN = re.compile(r"\x1b\[[0-9;]*[A-Za-z]|[\x00-\x08\x0b\x0e-\x1f\x7f﻿￹-￻⁪-⁯]")
_QUOTES = {ord(c): "'" for c in "‘’‚‛ʼ"} | {ord(c): '"' for c in "“”„‟"}
_BREAKS = {ord(c): "\n" for c in "\u0085  "}
_LIGATURES = {c: unicodedata.normalize("NFKD", chr(c)) for c in range(0xFB00, 0xFB07)}


def _plausible(sequence: str, meant: str) -> bool:
    """Whether a damaged sequence is more likely damage than meant: what it stands for is a visible character, and its own form is none that words have."""
    if unicodedata.category(meant)[0] == "C" and meant != "­":
        return False
    return len(sequence) > 2 or sequence[0] in _ODD_HEADS or bool(_ODD_TAIL.match(sequence[1]))


def _mended(text: str, encoding: str) -> str:
    """The text with sequences that are damage in this encoding read as UTF-8, where they are plausible or stand next to such ones."""
    table = _BYTES[encoding]
    found = []
    for m in _DAMAGED[encoding].finditer(text):
        try:
            meant = bytes(table[c] for c in m[0]).decode("utf-8")
        except UnicodeDecodeError:
            continue
        beside = text[m.start() - 1 : m.start()] + text[m.end() : m.end() + 1]
        mixed = m[0][0] >= "Ѐ" and any(c.isascii() and c.isalpha() for c in beside)  # a Cyrillic letter within a Latin word
        found.append([m.start(), m.end(), meant, mixed or _plausible(m[0], meant)])
    # a word of another script is damaged as a whole: its doubtful sequences follow each other
    for a, b in zip(found, found[1:]):
        b[3] = b[3] or (a[3] and a[1] == b[0])
    for a, b in zip(reversed(found[:-1]), reversed(found[1:])):
        a[3] = a[3] or (b[3] and a[1] == b[0])
    out, at = [], 0
    for start, end, meant, sure in found:
        if sure:
            out += [text[at:start], meant]
            at = end
    return "".join([*out, text[at:]])


def _cost(text: str) -> int:
    """How much of a text looks damaged: characters of plausible sequences in any encoding, and control characters."""
    worst = max(sum(len(m[0]) for m in _DAMAGED[e].finditer(text) if _mended(m[0], e) != m[0]) for e in ENCODINGS)
    return worst + 2 * sum("\x80" <= c <= "\x9f" for c in text)


def _chains(text: str) -> Iterator[str]:
    """What chains of mending, up to DEPTH long, make of a text."""
    seen, wave = {text}, [text]
    for _ in range(DEPTH):
        wave = [t for now in wave for e in ENCODINGS if (t := _mended(now, e)) not in seen and not seen.add(t)]
        yield from wave


def repaired(text: str) -> str:
    """The text with UTF-8 that was read in another encoding mended, through several such readings, and other damage undone.

    Of all chains of mending the one counts after which least looks damaged, the shorter one of equals. Beyond that: curly quotes, ligatures and full-width
    forms become plain ones, line breaks are one kind, terminal codes and characters without a form go, accents are composed.
    A clean text stays as it is.
    """
    if not text.isascii():
        cost = _cost(text)
        if cost:
            for other in _chains(text):
                if (new := _cost(other)) < cost:
                    text, cost = other, new
        text = text.translate(_QUOTES | _BREAKS | _LIGATURES)
        text = "".join(unicodedata.normalize("NFKC", c) if "！" <= c <= "￯" or c == "　" else c for c in text)
        text = unicodedata.normalize("NFC", text)
    return _UNSEEN.sub("", text.replace("\r\n", "\n").replace("\r", "\n"))


@F.pandas_udf(T.StringType())
def clean_prompt(prompt: pd.Series) -> pd.Series:
    """Text repaired, without HTML entities (unescaped twice), white space collapsed; null stays null."""
    return prompt.map(lambda p: None if p is None else " ".join(html.unescape(html.unescape(repaired(p))).split()))
