"""Tokenizers with vocabularies, as column expressions or Arrow functions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import characters, split_words


def lookup(tokens: Column, vocabulary: dict[str, int], unknown: int | None = None) -> Column:
    """Ids of an array of tokens; a token that isn't in the vocabulary becomes unknown, or falls away if that is None.

    The vocabulary is a literal of the plan, so it should have some thousands of entries at most.
    """
    table = F.create_map(*[F.lit(x) for pair in vocabulary.items() for x in pair]) if vocabulary else F.create_map().cast("map<string,int>")
    ids = F.transform(tokens, lambda t: F.coalesce(F.try_element_at(table, t), F.lit(unknown).cast("int")))
    return ids if unknown is not None else F.filter(ids, lambda x: x.isNotNull())


def char_ids(text: str | Column, vocabulary: dict[str, int], unknown: int | None = None, before: Sequence[int] = (), after: Sequence[int] = ()) -> Column:
    """Ids of characters with special ids around."""
    ids = lookup(characters(text), vocabulary, unknown)
    return F.concat(F.array(*map(F.lit, before)).cast("array<int>"), ids, F.array(*map(F.lit, after)).cast("array<int>"))


def word_ids(text: str | Column, vocabulary: dict[str, int], unknown: int) -> Column:
    return lookup(split_words(text), vocabulary, unknown)


def parsed_ids(text: str | Column, labels: Sequence[str], unknown: int = -1, blank: int = -1, lower: bool = True) -> Column:
    """Ids of a transcript by a list of labels; labels of several characters stand for whole words; blanks fall away."""
    table = {x: i for i, x in enumerate(labels)}
    longer = {x for x in labels if len(x) > 1}
    words = split_words(F.lower(F.col(text) if isinstance(text, str) else text) if lower else text)
    pieces = F.transform(words, lambda w: F.when(w.isin(*longer), F.array(w)).otherwise(characters(w))) if longer else F.transform(words, characters)
    spaced = F.flatten(F.transform(pieces, lambda p, i: F.when(i > 0, F.concat(F.array(F.lit(" ")), p)).otherwise(p)))
    return F.filter(lookup(spaced, table, unknown), lambda x: x != blank)


def offsets(sizes: Sequence[tuple[str, int]]) -> dict[str, int]:
    """The first id of each of several vocabularies laid end to end."""
    out, at = {}, 0
    for name, n in sizes:
        out[name] = at
        at += n
    return out


def shifted_ids(ids: Column, language: Column, sizes: Sequence[tuple[str, int]]) -> Column:
    """Ids of a language's own tokenizer in the joint vocabulary; an unknown language gives null."""
    by = F.create_map(*[F.lit(x) for pair in offsets(sizes).items() for x in pair])
    first = F.try_element_at(by, language)
    return F.when(first.isNotNull(), F.transform(ids, lambda x: x + first))


def language_of_id(ident: Column, sizes: Sequence[tuple[str, int]]) -> Column:
    out = F.lit(None).cast("string")
    for name, first in offsets(sizes).items():
        out = F.when(ident >= first, name).otherwise(out)
    return F.when(ident < sum(n for _, n in sizes), out)


def integer_code(value: Column, least: int, length: int, base: int = 100, start: int = 0, with_nan: bool = True) -> Column:
    """A whole number less least as length digits of base, most significant first, each digit with ids of its own.

    A null is the reserved id of each digit's range; a number that needs more digits is an error when it is met.
    """
    v = value.cast("bigint") - least
    # Ids run from the least significant digit up; the most significant one's range ends with the id for nan.
    first = [start + base * i for i in range(length)]
    codes = F.array(*[(F.floor(v / base**i) % base + first[i]).cast("int") for i in reversed(range(length))])
    nan = F.array(*[F.lit(first[i] + base - (0 if i == length - 1 else 1)) for i in reversed(range(length))])
    fits = F.when((v >= 0) & (v < base**length), codes).otherwise(F.raise_error(F.lit("the number is too long for its code")).cast("array<int>"))
    return F.when(value.isNull(), nan if with_nan else F.raise_error(F.lit("the column takes no nan")).cast("array<int>")).otherwise(fits)


def category_codes(df: DataFrame, column: str, start: int = 0, most: int = 100_000) -> dict[str, int]:
    """Ids of a category column's values in sorted order; more than most values are an error, as the driver holds them.

    A column of more values is coded by a join with label_index, which no one machine holds.
    """
    found = df.select(F.col(column).cast("string").alias("v")).where("v is not null").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"the column {column} has more than {most} values")
    return {v: start + i for i, v in enumerate(sorted((r["v"] for r in found), key=lambda v: v.encode()))}


class Quantiles:
    """A map of a float column to 0..1 by its quantiles (exact ones of the whole column)."""

    def __init__(self, df: DataFrame, column: str, n: int = 100):
        shares = [i / (n - 1) for i in range(n)]
        got = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).agg(F.percentile(F.col(column).cast("double"), F.array(*map(F.lit, shares)))).first()[0]
        self.edges, self.shares = np.array(got if got is not None else [0.0, 1.0]), np.array(shares if got is not None else [0.0, 1.0])

    def column(self, value: str | Column) -> Column:
        edges, shares = self.edges, self.shares

        def scale(s: pd.Series) -> pd.Series:
            x = s.to_numpy(float)
            # Ties of edges: the mean of the interpolations from both sides.
            up = np.interp(x, edges, shares)
            down = -np.interp(-x, -edges[::-1], -shares[::-1])
            return pd.Series(np.where(np.isnan(x), np.nan, (up + down) / 2))

        return F.pandas_udf(scale, T.DoubleType())(F.col(value) if isinstance(value, str) else value)

    def digits(self, value: str | Column, length: int, base: int = 100) -> Column:
        """The scaled value as a whole number of length digits."""
        top = base ** (length - int(math.log(max(float(self.shares[-1]), 1e-9), base)) - 1)
        return F.floor(self.column(value) * top).cast("bigint")


def sentencepiece_ids(text: str | Column, model: str) -> Column:
    """Ids by a sentencepiece model file, which must be there on every machine; null for null."""

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for s in batches:
            out = iter(sp.encode([t for t in s if t is not None], num_threads=1))
            yield pd.Series([None if t is None else next(out) for t in s], dtype=object)

    return F.pandas_udf(encode, T.ArrayType(T.IntegerType()))(F.col(text) if isinstance(text, str) else text)


def sentencepiece_text(ids: str | Column, model: str) -> Column:
    """The text of ids; the inverse of sentencepiece_ids but for blanks at the ends."""

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        for s in batches:
            yield pd.Series([None if x is None else sp.decode([int(i) for i in x]) for x in s], dtype=object)

    return F.pandas_udf(decode, T.StringType())(F.col(ids) if isinstance(ids, str) else ids)


def library_ids(text: str | Column, vocabulary: str) -> Column:
    """Ids by a tokenizer file of the tokenizers library, special tokens in the text being ordinary text."""

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(vocabulary)
        t.encode_special_tokens = True
        for s in batches:
            out = iter(t.encode_batch([x for x in s if x is not None], add_special_tokens=False))
            yield pd.Series([None if x is None else next(out).ids for x in s], dtype=object)

    return F.pandas_udf(encode, T.ArrayType(T.IntegerType()))(F.col(text) if isinstance(text, str) else text)


def ids_as_characters(ids: Column, offset: int = 100) -> Column:
    """Ids as characters above offset with blanks between, for count-based language models."""
    one = lambda i: F.decode(F.unhex(F.lpad(F.hex((i + offset).cast("bigint")), 4, "0")), "UTF-16BE")
    return F.array_join(F.transform(ids, one), " ")


def special_pieces(text: str | Column) -> Column:
    """A text as its special tokens, <|...|>, and the texts between them, none empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.regexp_replace(c, r"(<\|[^|<>]*\|>)", "\u0001$1\u0001"), "\u0001"), lambda x: x != "")


Coder = Callable[..., tuple[Column, int]]


def _int_coder(df: DataFrame, column: str, start: int, length: int = 2, base: int = 100) -> tuple[Column, int]:
    least = df.agg(F.min(column)).first()[0] or 0
    return integer_code(F.col(column), least, length, base, start), start + length * base + 1


def _float_coder(df: DataFrame, column: str, start: int, length: int = 2, base: int = 100) -> tuple[Column, int]:
    return integer_code(Quantiles(df, column).digits(column, length, base), 0, length, base, start), start + length * base + 1


def _category_coder(df: DataFrame, column: str, start: int, most: int = 100_000) -> tuple[Column, int]:
    codes = category_codes(df, column, start, most)
    return F.array(F.element_at(lookup(F.array(F.col(column).cast("string")), codes, start + len(codes)), 1)), start + len(codes) + 1


#: Coders of table columns by name: each fits itself to a column and gives its ids' column and the first id after its own.
CODERS: dict[str, Coder] = {"int": _int_coder, "float": _float_coder, "category": _category_coder}


def register_coder(name: str, make: Coder) -> None:
    CODERS[name] = make


def row_codes(df: DataFrame, columns: Sequence[tuple], start: int = 0) -> Column:
    """The ids of several columns as one array, each column's range after the one before: (name, kind, options) each."""
    parts, at = [], start
    for name, kind, *options in columns:
        if kind not in CODERS:
            raise ValueError(f"no such coder: {kind}; there are {sorted(CODERS)}")
        code, at = CODERS[kind](df, name, at, **(options[0] if options else {}))
        parts.append(code)
    return F.concat(*parts)


def _english_ids(text: str | Column, labels: Sequence[str], **options) -> Column:
    from millrace.functions.text import clean_label

    return parsed_ids(clean_label(text), labels, **options)


#: Transcript parsers by name: base takes the text as it is, en cleans it first.
TRANSCRIPT_PARSERS: dict[str, Callable[..., Column]] = {"base": parsed_ids, "en": _english_ids}


def transcript_parser(name: str) -> Callable[..., Column]:
    if name not in TRANSCRIPT_PARSERS:
        raise ValueError(f"no such parser: {name}; there are {sorted(TRANSCRIPT_PARSERS)}")
    return TRANSCRIPT_PARSERS[name]
