"""Texts as they are spoken: numbers, abbreviations, folded characters, and long texts cut for alignment. Arrow functions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import COMMON_ABBREVIATIONS, MORE_ABBREVIATIONS

ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
GROUPS = ["", "thousand", "million", "billion", "trillion", "quadrillion", "quintillion"]
ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}


def _below_thousand(n: int) -> str:
    words = []
    if n >= 100:
        words.append(f"{ONES[n // 100]} hundred")
        n %= 100
        if n:
            words.append("and")
    if n >= 20:
        words.append(TENS[n // 10 - 2] + (f"-{ONES[n % 10]}" if n % 10 else ""))
    elif n or not words:
        words.append(ONES[n])
    return " ".join(words)


def number_words(n: int) -> str:
    """A whole number in English words; beyond its largest group digit by digit."""
    if n < 0:
        return f"minus {number_words(-n)}"
    if n >= 1000 ** len(GROUPS):
        return " ".join(ONES[int(d)] for d in str(n))
    parts = []
    rest, i = n, 0
    while rest:
        rest, low = divmod(rest, 1000)
        if low:
            parts.append((low, i))
        i += 1
    if not parts:
        return ONES[0]
    said = [f"{_below_thousand(low)} {GROUPS[i]}".strip() for low, i in reversed(parts)]
    low, i = parts[0]
    if i == 0 and low < 100 and len(said) > 1:
        return ", ".join(said[:-1]) + " and " + said[-1]
    return ", ".join(said)


def ordinal_words(n: int) -> str:
    head, last = re.match(r"(.*?)([a-z]+)$", number_words(n)).groups()
    return head + (ORDINALS.get(last) or (last[:-1] + "ieth" if last.endswith("y") else last + "th"))


def decimal_words(text: str) -> str:
    whole, _, part = text.partition(".")
    return number_words(int(whole or 0)) + (" point " + " ".join(ONES[int(d)] for d in part) if part else "")


_TIME = re.compile(r"\b(\d{1,2}):([0-5]\d)(?:\s*([ap])\.?m\.?)?(?![\w:])", re.I)
_MONEY = re.compile(r"\$\s?(\d{1,3}(?:,\d{3})+|\d+)(?:\.(\d{1,2}))?(?!\d)")
_ORDINAL = re.compile(r"\b(\d+)(?:st|nd|rd|th)\b", re.I)
_NUMBER = re.compile(r"(?<![\w.])(\d{1,3}(?:,\d{3})+|\d+)(\.\d+)?(?!\w)")


def say_numbers(text: str) -> str:
    """Times, dollars, ordinals and numbers in words; groups of three after commas are one number."""

    def time(m: re.Match) -> str:
        out = number_words(int(m[1])) + (f" {number_words(int(m[2]))}" if int(m[2]) else "")
        return f"{out} {m[3].lower()}m" if m[3] else out

    def money(m: re.Match) -> str:
        n, cents = int(m[1].replace(",", "")), int((m[2] or "").ljust(2, "0") or 0)
        out = f"{number_words(n)} dollar{'' if n == 1 else 's'}"
        return out + (f" and {number_words(cents)} cent{'' if cents == 1 else 's'}" if cents else "")

    text = _TIME.sub(time, text)
    text = _MONEY.sub(money, text)
    text = _ORDINAL.sub(lambda m: ordinal_words(int(m[1])), text)
    return _NUMBER.sub(lambda m: decimal_words(m[1].replace(",", "") + (m[2] or "")), text)


_FOLDED = str.maketrans({"’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...", "ß": "ss", "æ": "ae", "Æ": "AE", "ø": "o", "Ø": "O", "œ": "oe", "Œ": "OE", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ı": "i"})


def to_ascii(text: str) -> str:
    """Letters without marks and signs by their plain counterpart; what has none falls away."""
    plain = unicodedata.normalize("NFKD", text.translate(_FOLDED))
    return "".join(c for c in plain if ord(c) < 128)


def english_lowered(text: str) -> str:
    """Letters without marks, quotes and dashes folded, in lower case."""
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")
    return plain.translate(_FOLDED).lower()


def any_language(text: str) -> str:
    """Composed characters, the right quotation mark as an apostrophe."""
    return unicodedata.normalize("NFC", text).replace("’", "'")


def cleaned(text: str, version: str = "common", marks: dict[str, str] | None = None, delete: str = "") -> str:
    """A text for speech: ASCII, lower case, numbers and abbreviations said, marks replaced by words, others deleted.

    version: 'common' abbreviations, or 'expanded' with more of them.
    """
    out = say_numbers(re.sub(r"\s+", " ", to_ascii(text).lower()))
    for a, b in COMMON_ABBREVIATIONS + (MORE_ABBREVIATIONS if version == "expanded" else []):
        out = re.sub(rf"\b{a}\.", b, out)
    for mark, word in (marks or {}).items():
        out = out.replace(mark, f" {word} ")
    return re.sub(r"\s+", " ", out.translate({ord(c): None for c in delete})).strip()


_CUT = re.compile(r"(?<![A-Z]\.)(?<!\b[A-Z][a-z]\.)(?<!\b[A-Z][a-z]{2}\.)(?<=[.?!…])[\"”»']?\s+(?=[\"“«A-ZÀ-ÞА-Я¿¡0-9])")


def cut_for_alignment(text: str, longest: int = 40, more: str = "", brackets: bool = False) -> list[str]:
    """Sentences without line ends and, if told, bracketed parts; a sentence of more than longest words is cut at further
    signs (more, then commas), and pieces are joined again while they stay within longest."""
    text = re.sub(r"\s+", " ", re.sub(r"\([^()]*\)|\[[^\[\]]*\]", " ", text) if brackets else text).strip()
    out: list[str] = []
    for s in _CUT.split(text):
        pieces = [s]
        for signs in (more, ",;:"):
            if signs and any(len(p.split()) > longest for p in pieces):
                pieces = [q for p in pieces for q in (re.split(rf"(?<=[{re.escape(signs)}])\s+", p) if len(p.split()) > longest else [p])]
        joined: list[str] = []
        for p in pieces:
            if joined and len(joined[-1].split()) + len(p.split()) <= longest:
                joined[-1] += f" {p}"
            else:
                joined.append(p)
        out += [p.strip() for p in joined if p.strip()]
    return out


def arrow(f: Callable, kind: T.DataType = T.StringType()) -> Callable[[str | Column], Column]:
    """A function of one text as a column function; null stays null."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    udf = F.pandas_udf(run, kind)
    return lambda c: udf(F.col(c) if isinstance(c, str) else c)
