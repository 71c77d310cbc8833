"""Evaluation items that occur in documents, whole or in part, also with other numbers, names and units (problem 8)."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.wordstream import Words, chunks, word_stream

WINDOW = 3
LEAST_WORDS = 8
#: Characters of items that go to the tasks at once; their index takes about eight bytes a character.
BLOCK_CHARS = 8_000_000
#: Cells of an alignment's table; beyond, it is cut in halves so that memory stays in proportion to the lengths.
TABLE_CELLS = 4_000_000
# Codes of the typed placeholders; words of the items have codes from FIRST on, all others none.
NONE, NUMBER, NAME, UNIT, FIRST = -1, 1, 2, 3, 8
_LEAD_IN = re.compile(r"^[^.!?:\uff1a\n]{1,80}?\s?[:\uff1a]\s")
_PART = "[A-Z\u00c0-\u00d6\u00d8-\u00deА-ЯЁ][a-z\u00df-\u00f6\u00f8-\u00ffа-яё]{2,}"
_NAME = re.compile(rf"\b({_PART}) ({_PART})\b")
_LOWER = re.compile("\\b[a-z\u00df-\u00f6\u00f8-\u00ffа-яё]+\\b")


class Items(NamedTuple):
    """A block of items: ids, their words as word codes and template codes, and the postings of their windows."""

    ids: list
    words: list[np.ndarray]
    templates: list[np.ndarray]
    vocabulary: dict[str, int]
    names: frozenset[str]
    keys: np.ndarray
    first: np.ndarray
    posting_item: np.ndarray
    posting_pos: np.ndarray


def _template(doc: np.ndarray, code: np.ndarray, digit: np.ndarray, name: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Words as template codes: numbers, names and the word after a number become placeholders."""
    out = known.copy()
    out[name] = NAME
    out[digit] = NUMBER
    unit = np.zeros(len(code), bool)
    unit[1:] = digit[:-1] & ~digit[1:] & (doc[1:] == doc[:-1])
    out[unit] = UNIT
    return out


def _window_keys(template: np.ndarray) -> np.ndarray:
    n = len(template) - WINDOW + 1
    if n < 1:
        return np.empty(0, np.uint64)
    key = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WINDOW):
            key = key * np.uint64(0x9E3779B97F4A7C15) + template[i : i + n].astype(np.uint64)
            key ^= key >> np.uint64(31)
    return key


def index_items(ids: list, texts: list[str]) -> Items:
    """The index of a block of items; an item under LEAST_WORDS words without its lead-in gets no postings."""
    bare = [_LEAD_IN.sub("", t) for t in texts]
    w = word_stream(bare)
    lower = {x for t in bare for x in _LOWER.findall(t)}
    names = frozenset(x.lower() for t in bare for pair in _NAME.findall(t) for x in pair if x.lower() not in lower)
    vocabulary = {x: i + FIRST for i, x in enumerate(w.words)}
    digit = np.array([x.isdigit() for x in w.words], bool)
    is_name = np.array([x in names for x in w.words], bool)
    known = np.arange(len(w.words), dtype=np.int64) + FIRST
    template = _template(w.doc, w.code, digit[w.code], is_name[w.code], known[w.code]) if len(w.code) else w.code
    at = np.searchsorted(w.doc, np.arange(len(texts) + 1))
    words = [w.code[a:b] + FIRST for a, b in zip(at[:-1], at[1:], strict=True)]
    templates = [template[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    keys, item, pos = [], [], []
    for i, t in enumerate(templates):
        if len(t) >= LEAST_WORDS:
            k = _window_keys(t)
            keys.append(k)
            item.append(np.full(len(k), i))
            pos.append(np.arange(len(k)))
    if not keys:
        empty = np.empty(0, np.int64)
        return Items(ids, words, templates, vocabulary, names, np.empty(0, np.uint64), np.zeros(1, np.int64), empty, empty)
    key, item, pos = np.concatenate(keys), np.concatenate(item), np.concatenate(pos)
    order = np.argsort(key, kind="stable")
    distinct, first = np.unique(key[order], return_index=True)
    return Items(ids, words, templates, vocabulary, names, distinct, np.append(first, len(key)), item[order], pos[order])


def _doc_codes(w: Words, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """The documents' words in the items' codes, plain and as templates; two unknown words in a row may be a name.

    A plain word that is in no item has a code of its own, above the items'.
    """
    known = np.array([items.vocabulary.get(x, NONE) for x in w.words], np.int64)
    digit = np.array([x.isdigit() for x in w.words], bool)
    name = np.array([x in items.names for x in w.words], bool)
    plain, is_digit, is_name = known[w.code], digit[w.code], name[w.code]
    new = (plain == NONE) & ~is_digit
    pair = np.zeros(len(new), bool)
    both = new[1:] & new[:-1] & (w.doc[1:] == w.doc[:-1])
    pair[1:] |= both
    pair[:-1] |= both
    own = np.where(plain == NONE, w.code + FIRST + len(items.vocabulary), plain)
    return own, _template(w.doc, w.code, is_digit, is_name | pair, plain)


def _candidates(w: Words, template: np.ndarray, items: Items) -> pd.DataFrame:
    """Documents and items that share windows in one stretch: doc, item, the place of the item's first word, hits."""
    n = len(template) - WINDOW + 1
    if n < 1 or not len(items.keys):
        return pd.DataFrame(columns=["doc", "item", "at", "hits"])
    key = _window_keys(template)
    ok = w.doc[:n] == w.doc[WINDOW - 1 :]
    for i in range(WINDOW):
        ok &= template[i : i + n] != NONE
    at = np.flatnonzero(ok)
    slot = np.searchsorted(items.keys, key[at])
    slot[slot == len(items.keys)] = 0
    met = items.keys[slot] == key[at]
    at, slot = at[met], slot[met]
    count = items.first[slot + 1] - items.first[slot]
    place = np.repeat(at, count)
    run = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)
    posting = np.repeat(items.first[slot], count) + run
    item, pos = items.posting_item[posting], items.posting_pos[posting]
    length = np.array([len(t) for t in items.templates], np.int64)[item]
    # Offsets are banded by a quarter of the item's length, in two layouts so that no stretch falls between bands.
    width = np.maximum(8, length // 4)
    start = place - pos + 1_000
    found = []
    for shift in (0, 1):
        band = (start + shift * width // 2) // width
        hits = pd.DataFrame({"doc": w.doc[place], "item": item, "band": band, "start": start - 1_000, "pos": pos, "length": length})
        hits = hits.drop_duplicates(["doc", "item", "band", "pos"])
        g = hits.groupby(["doc", "item", "band"], sort=False).agg(hits=("pos", "size"), at=("start", "median"), length=("length", "first")).reset_index()
        found.append(g[g.hits + WINDOW - 1 >= np.maximum(WINDOW, 0.22 * g.length)])
    out = pd.concat(found)
    out["at"] = out["at"].astype(np.int64)
    return out.drop_duplicates(["doc", "item", "at"])


def _gain(a: np.ndarray, ta: np.ndarray, b: np.ndarray, tb: np.ndarray) -> np.ndarray:
    """What a word of the item (or each of them) earns at each place of the stretch: equal words before equal slots."""
    return np.where(a == b, 1.0, np.where((ta == tb) & (ta < FIRST), 0.6, 0.0))


def _last_row(a: np.ndarray, ta: np.ndarray, b: np.ndarray, tb: np.ndarray) -> np.ndarray:
    """The best score of all of a with each beginning of b, a row of the table at a time."""
    row = np.zeros(len(b) + 1)
    for i in range(len(a)):
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + _gain(a[i], ta[i], b, tb)))
    return row


def _align(a: np.ndarray, ta: np.ndarray, b: np.ndarray, tb: np.ndarray) -> list[tuple[int, int, bool]]:
    """Longest common subsequence of the templates of an item (a) and a stretch (b), equal words before equal slots.

    A long pair is halved where the scores of both halves add up to the most, so memory grows with the lengths only.
    """
    n, m = len(a), len(b)
    if n * m > TABLE_CELLS and n > 1:
        half = n // 2
        first, rest = _last_row(a[:half], ta[:half], b, tb), _last_row(a[half:][::-1], ta[half:][::-1], b[::-1], tb[::-1])[::-1]
        at = int(np.argmax(first + rest))
        return _align(a[:half], ta[:half], b[:at], tb[:at]) + [(i + half, j + at, e) for i, j, e in _align(a[half:], ta[half:], b[at:], tb[at:])]
    score = np.zeros((n + 1, m + 1), np.float64)
    gain = _gain(a[:, None], ta[:, None], b[None, :], tb[None, :])
    for i in range(1, n + 1):
        score[i, 1:] = np.maximum.accumulate(np.maximum(score[i - 1, 1:], score[i - 1, :-1] + gain[i - 1]))
    out, i, j = [], n, m
    while i and j:
        if gain[i - 1, j - 1] and score[i, j] == score[i - 1, j - 1] + gain[i - 1, j - 1]:
            out.append((i - 1, j - 1, bool(a[i - 1] == b[j - 1])))
            i, j = i - 1, j - 1
        elif score[i, j] == score[i - 1, j]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def _consistent(pairs: list[tuple[int, int, bool]], a: np.ndarray, ta: np.ndarray, b: np.ndarray) -> list[tuple[int, int, bool]]:
    """Drop slots whose filling isn't one-to-one: a value of the item must stand for one value of the document.

    Slots that hold the item's own value are kept and bind it; of others the first filling binds.
    """
    there = {int(a[i]): int(a[i]) for i, _, exact in pairs if exact and ta[i] < FIRST}
    back = dict(there)
    out = []
    for i, j, exact in pairs:
        x, y = int(a[i]), int(b[j])
        if not exact:
            if there.get(x, y) != y or back.get(y, x) != x:
                continue
            there[x], back[y] = y, x
        out.append((i, j, exact))
    return out


def _stretch(pairs: list[tuple[int, int, bool]], slack: float) -> tuple[int, int]:
    """The most equal words, and equal words or slots, in a stretch of the document barely longer than them."""
    if not pairs:
        return 0, 0
    j = np.array([p[1] for p in pairs])
    i = np.array([p[0] for p in pairs])
    exact = np.concatenate([[0], np.cumsum([p[2] for p in pairs])])
    n, most, longest = len(pairs), 0, 0
    # A row of first places for each last one, some rows at a time: memory in proportion to the pairs.
    step = max(1, TABLE_CELLS // n)
    for k in range(0, n, step):
        last = np.arange(k, min(n, k + step))[:, None]
        first = np.arange(int(last[-1, 0]) + 1)[None, :]
        count = last - first + 1
        good = (count > 0) & (j[last] - j[first] + 1 <= slack * count + 2) & (i[last] - i[first] + 1 <= slack * count + 2)
        most = max(most, int(np.where(good, exact[last + 1] - exact[first], 0).max()))
        longest = max(longest, int(np.where(good, count, 0).max()))
    return most, longest


def find_in_batch(texts: list[str], items: Items, slack: float = 1.3) -> list[tuple[int, int, int, int, int]]:
    """(text's index, item's index, item's words, equal words, equal words and slots) of each candidate met."""
    w = word_stream(texts)
    if not len(w.code):
        return []
    plain, template = _doc_codes(w, items)
    begin = np.searchsorted(w.doc, np.arange(len(texts) + 1))
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for doc, item, at in _candidates(w, template, items)[["doc", "item", "at"]].itertuples(index=False):
        a, ta = items.words[item], items.templates[item]
        room = max(8, len(a) // 3)
        lo, hi = max(begin[doc], at - room), min(begin[doc + 1], at + len(a) + room)
        if hi <= lo:
            continue
        b, tb = plain[lo:hi], template[lo:hi]
        pairs = _align(a, ta, b, tb)
        kept = _consistent(pairs, a, ta, b)
        equal = _stretch([p for p in pairs if p[2]], slack)[0]
        literal = int((ta >= FIRST).sum())  # the item's words that aren't slots: half of them must be there as well
        told = sum(e and ta[i] >= FIRST for i, _, e in kept)
        got = equal, (_stretch(kept, slack)[1] if 2 * told >= literal else equal)
        old = best.get((doc, item), (0, 0))
        best[doc, item] = max(old[0], got[0]), max(old[1], got[1])
    return [(d, i, len(items.words[i]), e, s) for (d, i), (e, s) in best.items()]


def _scan(index: Broadcast, share: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items: Items = index.value
        for pdf in chunks(batches, "_text"):
            found = find_in_batch(pdf["_text"].fillna("").tolist(), items)
            found = [x for x in found if max(x[3], x[4]) >= math.ceil(share * x[2])]
            rows = pdf["_id"].to_numpy()[[x[0] for x in found]] if found else []
            yield pd.DataFrame({"_id": rows, "_item": [items.ids[x[1]] for x in found], "item_words": [x[2] for x in found], "equal_words": [x[3] for x in found], "template_words": [x[4] for x in found]})

    return run


def leaked_items(docs: DataFrame, ident: str, text: str, items: DataFrame, item_ident: str, item_text: str, share: float = 0.5) -> DataFrame:
    """Each document and each item of which it holds at least share of the words in one stretch.

    Columns: ident, item_ident, item_words, equal_words, template_words. A lead-in ending in a colon isn't part of the
    item; an item under 8 words has no row. Case, punctuation, character forms, line openings and line breaks make no
    difference. equal_words counts the item's very words, in order; template_words also slots (numbers, names, the word
    after a number) that hold another value, each value of the item standing for one value of the document; slots count
    only where half of the item's other words are there. A row is given if either reaches share; equal_words / item_words tells a copy from a re-parameterised one. The stretch may be
    1.3 times as long as its matches, and 2 words. Null and empty texts give nothing; ids that repeat give rows each.

    Method: item and document words become templates. The items' windows of three template words, hashed and sorted once,
    are the build side of a hash join that goes to every machine, of about 64 MB at most as the items are cut into blocks
    of BLOCK_CHARS characters; the documents' windows are its probe side, so the documents, whole, are never shuffled.
    Hits are gathered by document, item and offset, and what has hits for over a fifth of the item is aligned exactly, in
    memory that grows with the item's length only. Items beyond a block take another reading of the documents.
    """
    kinds = docs.schema[ident].dataType.simpleString(), items.schema[item_ident].dataType.simpleString()
    given = items.select(item_ident, item_text).where(F.col(item_ident).isNotNull() & (F.length(F.trim(item_text)) > 0))
    blocks = max(1, math.ceil((given.agg(F.sum(F.length(item_text))).first()[0] or 0) / BLOCK_CHARS))
    rows = docs.select(F.col(ident).alias("_id"), F.col(text).alias("_text")).where(F.length("_text") > 0)
    out = None
    for k in range(blocks):
        block = given if blocks == 1 else given.where(F.pmod(F.xxhash64(item_ident, item_text), F.lit(blocks)) == k)
        got = block.toPandas()
        index = docs.sparkSession.sparkContext.broadcast(index_items(got[item_ident].tolist(), got[item_text].tolist()))
        part = rows.mapInPandas(_scan(index, share), f"_id {kinds[0]}, _item {kinds[1]}, item_words int, equal_words int, template_words int")
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("_id").alias(ident), F.col("_item").alias(item_ident), "item_words", "equal_words", "template_words")
