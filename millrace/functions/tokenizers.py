"""One interface for all tokenizers, working on columns, and the registry of those that are there."""

from __future__ import annotations

import base64
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import tokens as K
from millrace.functions.text import byte_ids, characters, split_words

#: The names under which special tokens are asked for.
ROLES = ("bos", "eos", "pad", "unk", "cls", "sep", "mask", "eod")


class Tokenizer(ABC):
    """Text to ids and back. ids and text take a column and give a column; a null text has null ids and the other way round.

    special holds tokens and their ids; the ids of tokens added by with_special follow the vocabulary. By its role
    (bos, eos, ...) a special token is found with special_id; eod is eos where there is none of its own.
    """

    def __init__(self, size: int, special: dict[str, int] | None = None, roles: dict[str, str] | None = None) -> None:
        self.own_size, self.special, self.roles = size, dict(special or {}), dict(roles or {})

    @property
    def vocab_size(self) -> int:
        return max([self.own_size, *(i + 1 for i in self.special.values())])

    @abstractmethod
    def _ids(self, text: Column) -> Column:
        """Ids of a text without special tokens."""

    @abstractmethod
    def _text(self, ids: Column) -> Column:
        """The text of ids of the own vocabulary."""

    def with_special(self, **roles: str) -> Tokenizer:
        """The same tokenizer with special tokens by role, those that are new with ids after the vocabulary."""
        unknown = set(roles) - set(ROLES)
        if unknown:
            raise ValueError(f"no such roles: {sorted(unknown)}")
        out = object.__new__(type(self))
        out.__dict__ = {**self.__dict__, "special": dict(self.special), "roles": {**self.roles, **roles}}
        for token in roles.values():
            if token not in out.special:
                out.special[token] = out.vocab_size
        return out

    def special_id(self, role: str) -> int:
        token = self.roles.get(role) or (self.roles.get("eos") if role == "eod" else None)
        if token is None:
            raise KeyError(f"the tokenizer has no {role} token")
        return self.special[token]

    def ids(self, text: str | Column, before: Sequence[str] = (), after: Sequence[str] = ()) -> Column:
        """Ids of a text with the special tokens of the given roles around."""
        c = F.col(text) if isinstance(text, str) else text
        around = lambda names: F.array(*[F.lit(self.special_id(n)) for n in names]).cast("array<int>")
        own = self._ids(c)
        return F.concat(around(before), own, around(after)) if before or after else own

    def text(self, ids: str | Column) -> Column:
        """The text of ids; special ones fall away."""
        c = F.col(ids) if isinstance(ids, str) else ids
        own = F.filter(c, lambda x: ~x.isin(*self.special.values())) if self.special else c
        return self._text(own)

    def length(self, text: str | Column) -> Column:
        return F.size(self.ids(text))


class Bytes(Tokenizer):
    """UTF-8 bytes as ids 0 to 255."""

    def __init__(self) -> None:
        super().__init__(256)

    def _ids(self, text: Column) -> Column:
        return byte_ids(text)

    def _text(self, ids: Column) -> Column:
        code = F.array_join(F.transform(ids, lambda x: F.lpad(F.hex(x.cast("bigint")), 2, "0")), "")
        return F.decode(F.unhex(code), "UTF-8")


class Listed(Tokenizer):
    """Characters or words by a vocabulary; others are unk where there is one, else they fall away."""

    joint = ""

    def __init__(self, vocabulary: Sequence[str], unk: str | None = None) -> None:
        super().__init__(len(vocabulary), {unk: list(vocabulary).index(unk)} if unk else {}, {"unk": unk} if unk else {})
        self.vocabulary = list(vocabulary)

    def pieces(self, text: Column) -> Column:
        return characters(text)

    def _ids(self, text: Column) -> Column:
        return K.lookup(self.pieces(text), {x: i for i, x in enumerate(self.vocabulary)}, self.special_id("unk") if "unk" in self.roles else None)

    def _text(self, ids: Column) -> Column:
        table = F.array(*map(F.lit, self.vocabulary)) if self.vocabulary else F.array().cast("array<string>")
        return F.array_join(F.transform(ids, lambda x: F.get(table, x)), self.joint)


class Characters(Listed):
    """A character is a token."""


class Words(Listed):
    """What stands between blanks is a token."""

    joint = " "

    def pieces(self, text: Column) -> Column:
        return split_words(text)


class SentencePieces(Tokenizer):
    """A sentencepiece model file, which must be there on every machine."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        found = {role: sp.id_to_piece(i) for role, i in (("bos", sp.bos_id()), ("eos", sp.eos_id()), ("unk", sp.unk_id()), ("pad", sp.pad_id())) if i >= 0}
        super().__init__(sp.get_piece_size(), {p: sp.piece_to_id(p) for r, p in found.items() if r != "unk"}, {r: p for r, p in found.items() if r != "unk"})
        self.model = model

    def _ids(self, text: Column) -> Column:
        return K.sentencepiece_ids(text, self.model)

    def _text(self, ids: Column) -> Column:
        return K.sentencepiece_text(ids, self.model)


class LibraryFile(Tokenizer):
    """A tokenizer file of the tokenizers library, which must be there on every machine."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer as Loaded

        super().__init__(Loaded.from_file(path).get_vocab_size())
        self.path = path

    def _ids(self, text: Column) -> Column:
        return K.library_ids(text, self.path)

    def _text(self, ids: Column) -> Column:
        path = self.path

        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from tokenizers import Tokenizer as Loaded

            t = Loaded.from_file(path)
            for s in batches:
                yield pd.Series([None if x is None else t.decode([int(i) for i in x], skip_special_tokens=False) for x in s], dtype=object)

        return F.pandas_udf(decode, T.StringType())(ids)


class Ranks(Tokenizer):
    """A file of byte-pair ranks with the pattern that splits texts before the merges."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            super().__init__(max(int(line.split()[1]) for line in f if line.strip()) + 1)
        self.path, self.pattern = path, pattern

    def _run(self, kind: T.DataType, one: Callable) -> Callable:
        path, pattern = self.path, self.pattern

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            for s in batches:
                yield pd.Series([None if x is None else one(enc, x) for x in s], dtype=object)

        return F.pandas_udf(run, kind)

    def _ids(self, text: Column) -> Column:
        return self._run(T.ArrayType(T.IntegerType()), lambda enc, t: enc.encode_ordinary(t))(text)

    def _text(self, ids: Column) -> Column:
        return self._run(T.StringType(), lambda enc, x: enc.decode([int(i) for i in x]))(ids)


#: Tokenizers by name; register adds to them.
TOKENIZERS: dict[str, Callable[..., Tokenizer]] = {"byte": Bytes, "char": Characters, "word": Words, "sentencepiece": SentencePieces, "library": LibraryFile, "ranks": Ranks}


def register(name: str, make: Callable[..., Tokenizer]) -> None:
    TOKENIZERS[name] = make


def tokenizer(name: str, *args, **options) -> Tokenizer:
    """A tokenizer by its registered name."""
    if name not in TOKENIZERS:
        raise ValueError(f"no such tokenizer: {name}; there are {sorted(TOKENIZERS)}")
    return TOKENIZERS[name](*args, **options)
