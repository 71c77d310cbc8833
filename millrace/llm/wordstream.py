"""Words of many texts at once, as numbers: the front end of the operators that look for repeated or known word runs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd

from millrace.llm.skeleton import PROTOTYPES, skeleton

END = "\x00"
# What opens a line but isn't its text: quote marks, bullets, numbering, a time in brackets, a speaker's name with a colon.
_OPENING = re.compile(r"(?m)^[ \t>]*(?:(?:[*\-\u2022\u2013\u2014+]|\d{1,3}[.)])[ \t]+)*(?:[\[(]?\d{1,2}:\d\d(?::\d\d)?(?:[.,]\d+)?[\])]?[ \t]*)?(?:[^\W\d_][^\s:\uff1a]{0,30}(?:[ _][^\s:\uff1a]{1,20})?[ \t]?[:\uff1a](?=\s|$|[^\x00-\x7f]))?")
_HEADING = re.compile(r"(?m)^[ \t]*#{1,6}[ \t].*$")
_WORD = re.compile("\x00|[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]|[^\\W_\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\x00]+")


class Words(NamedTuple):
    """All words of a batch in order. doc: the text each word is in; code: equal for equal words; words: the distinct
    words by code. A character of Chinese or Japanese is a word."""

    doc: np.ndarray
    code: np.ndarray
    words: np.ndarray


def one_form(text: str) -> str:
    """Lower case in one character form; a text of ASCII, or of composed Latin letters and Chinese, only needs the former."""
    if text.isascii() or (unicodedata.is_normalized("NFC", text) and not _ODD.search(text)):
        return text.lower()
    return unicodedata.normalize("NFC", "\n".join(map(_line_form, text.split("\n"))))


def _line_form(line: str) -> str:
    """The skeleton in lower case.

    In a line of Cyrillic, Greek or Armenian, case goes first, as only some of its capitals look Latin; elsewhere a
    look-alike may stand for a Latin capital, so its prototype is taken first.
    """
    if 2 * len(_OWN.findall(line)) > len(_LATIN.findall(line)):
        return skeleton(_LETTERS.sub(_own_capitals, line).lower())
    return skeleton(line).lower()


def _own_capitals(word: re.Match) -> str:
    """Latin capitals in a word that has Cyrillic letters too as Cyrillic ones."""
    return word[0].translate(_TO_CYRILLIC) if _CYRILLIC.search(word[0]) and not word[0].islower() else word[0]


# Letters of these scripts that don't look Latin, and those of any Latin text.
_OWN = re.compile("[" + "".join(chr(c) for c in range(0x370, 0x590) if chr(c).isalpha() and chr(c) not in PROTOTYPES) + "]")
_LATIN, _CYRILLIC, _LETTERS = re.compile("[A-Za-z\u00c0-\u024f]"), re.compile("[\u0400-\u052f]"), re.compile(r"[^\W\d_]+")
# Latin capitals by the Cyrillic ones they look like.
_TO_CYRILLIC = str.maketrans("ABCEHKMOPTXY", "АВСЕНКМОРТХУ")
# Any character outside Latin letters and signs, Chinese and Japanese: such a text is mapped whole, alike everywhere.
_ODD = re.compile("[^\x00-\x7f\u00a1-\u00ac\u00ae-\u024f\u2010-\u2027\u3001-\u30ff\u3400-\u9fff\uff01-\uff0f\uff1a-\uff20]")


def chunks(batches: Iterator[pd.DataFrame], text: str, size: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """The rows of the batches in chunks of about size characters; a longer text is a chunk of its own."""
    for pdf in batches:
        upto = pdf[text].str.len().fillna(0).cumsum().to_numpy()
        at = 0
        while at < len(pdf):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, side="right")))
            yield pdf.iloc[at:end]
            at = end


def word_stream(texts: list[str], headings: bool = True, numbers: bool = True, form: Callable[[str], str] = one_form) -> Words:
    """The words of texts (none null). Line openings are left out; headings and words of digits only if so told."""
    whole = f"\n{END}\n".join(form(t.replace(END, " ")) for t in texts)
    if not headings:
        whole = _HEADING.sub("", whole)
    found = _WORD.findall(_OPENING.sub("", whole))
    code, words = pd.factorize(np.array(found, dtype=object)) if found else (np.empty(0, np.int64), np.empty(0, object))
    ends = np.flatnonzero(np.array([w == END for w in words]))
    is_end = np.isin(code, ends) if len(ends) else np.zeros(len(code), bool)
    doc = np.cumsum(is_end)
    keep = ~is_end
    if not numbers:
        digits = np.array([not any(c.isalpha() for c in w) for w in words], bool) if len(words) else np.zeros(0, bool)
        keep &= ~digits[code]
    return Words(doc[keep], code[keep].astype(np.int64), words)
