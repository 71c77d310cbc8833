"""One form for texts that look the same but are stored in different characters (problem 4)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stage

# Letters of common scripts that look like another letter, by prototype.
LOOKALIKES = {
    "A": "ΑАᎪ", "B": "ΒВᏴ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ΕЕᎬ", "F": "Ϝ", "G": "ԌᏀ", "H": "ΗНᎻ", "I": "ΙІӀ", "J": "ЈᎫͿ", "K": "ΚКᏦ",
    "L": "Ꮮ", "M": "ΜМᎷϺ", "N": "Ν", "O": "ΟОՕ", "P": "ΡРᏢ", "Q": "Ԛ", "S": "ЅՏᏚ", "T": "ΤТᎢ", "U": "Ս", "V": "ѴᏙ", "W": "ԜᎳ",
    "X": "ΧХ", "Y": "ΥҮᎩУ", "Z": "ΖᏃ", "a": "αаɑ", "c": "сϲᴄ", "d": "ԁ", "e": "еҽ", "g": "ɡց", "h": "һհ", "i": "ιіɩ", "j": "јϳ",
    "k": "κ", "l": "ӏ", "n": "ո", "o": "οоօᴏ", "p": "ρр", "q": "ԛզ", "s": "ѕꜱ", "u": "υսᴜ", "v": "νѵᴠ", "w": "ԝաᴡ", "x": "хᕁ",
    "y": "уүγʏ", "z": "ᴢ", "Г": "Γ", "П": "Π", "Ф": "Φ", "ß": "β", "-": "‐‑﹣", "æ": "ӕ", "Æ": "Ӕ", "ə": "ә",
}
# Signs of no width that are not of category Cf.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"
PROTOTYPES = {x: k for k, v in LOOKALIKES.items() for x in v}


# Letters of the public table that a reader tells from their prototype: without the dot, as with another accent.
DOTLESS = "\u0131\u0237"
# Compatibility forms that differ from the plain character in width or ligature only.
_SAME_LOOK = ("<wide>", "<narrow>", "<compat>")


class _Prototypes(dict):
    """Character to prototype, filled as characters are met: width and ligatures undone, look-alikes replaced."""

    def __init__(self, prototypes: dict[str, str]) -> None:
        super().__init__()
        self.prototypes = prototypes

    def __missing__(self, o: int) -> str:
        ch = chr(o)
        if unicodedata.category(ch) == "Cf" or ch in INVISIBLE or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF:
            out = ""
        elif unicodedata.category(ch) in ("Zs", "Zl", "Zp") or ch in "\t\n\r\x0b\x0c\x85":
            out = " "
        else:
            tag = "" if ch in self.prototypes else unicodedata.decomposition(ch).partition(" ")[0]
            plain = unicodedata.normalize("NFKD", ch) if tag in _SAME_LOOK else unicodedata.normalize("NFD", ch)
            plain = ch if plain.startswith(" ") else plain
            out = "".join(self.prototypes.get(c, c) for c in plain)
        self[o] = out
        return out


_TABLE = _Prototypes(PROTOTYPES)
_found: dict[str, dict[str, str]] = {}


def _kind(ch: str) -> str:
    """Capital, small, digit or, for letters without case and letter-like signs, other; empty for what isn't compared."""
    return {"Lu": "capital", "Lt": "capital", "Ll": "small", "Nd": "digit", "Lo": "other", "Lm": "other", "Nl": "other", "So": "other"}.get(unicodedata.category(ch), "")


def public_prototypes(spark: SparkSession) -> dict[str, str]:
    """The whole public table of look-alike characters (Unicode's confusables), as far as a reader sees no difference.

    The table is that of the ICU library that Spark brings along, asked once a session for all letters, digits and
    letter-like signs. Its classes are cut by letter case and digits, as those are seen; the prototype of such a class is
    its ASCII character, else its first one. Left out: punctuation, other signs and accents (a reader sees them), bold,
    raised, circled and similar forms (seen too), dotless letters, Chinese characters and Hangul syllables, and classes that equal several
    characters (a ligature counts as one letter). LOOKALIKES goes before the table.
    """
    app = spark.sparkContext.applicationId
    if app in _found:
        return _found[app]
    skip = lambda c: 0x3400 <= c <= 0x4DBF or 0x4E00 <= c <= 0x9FFF or 0xAC00 <= c <= 0xD7FF or 0xD800 <= c <= 0xDFFF or 0x20000 <= c <= 0x3FFFF
    chars = [ch for ch in map(chr, (c for c in range(0x21, 0xE0000) if not skip(c))) if _kind(ch) and ch not in DOTLESS and (ch.isascii() or not unicodedata.decomposition(ch))]
    asked = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build().getSkeleton("\n".join(chars)).split("\n")
    classes: dict[tuple[str, str], list[str]] = {}
    for ch, alike in zip(chars, asked, strict=True):
        classes.setdefault((alike, _kind(ch)), []).append(ch)
    out = {}
    for (alike, kind), members in classes.items():
        first = members[0]  # in the order of code points, so an ASCII character is first
        if kind == "other" and len(alike) == 1 and alike.isascii() and alike.isalnum():
            first = alike
        out |= {ch: first for ch in members if ch != first and not ch.isascii()}
    _found[app] = out | PROTOTYPES
    return _found[app]


def skeleton(text: str, table: dict[int, str] = _TABLE) -> str:
    """Decompose, replace every character by its prototype, decompose again; runs of blanks become one."""
    return " ".join(unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).translate(table)).split())


def _skeletons(prototypes: dict[str, str]):
    """The skeleton as a function of a column; the table goes along, some thousand characters."""
    table: list[_Prototypes] = []

    def run(texts: pd.Series) -> pd.Series:
        if not table:
            table.append(_Prototypes(prototypes))
        return texts.map(lambda t: skeleton(t, table[0]), na_action="ignore")

    return F.pandas_udf(run, T.StringType())


def skeleton_column(text: str | Column, prototypes: dict[str, str]) -> Column:
    """The skeleton of a text; null stays null.

    A text of printable ASCII is its own skeleton but for its blanks, so only the others go through Python.
    """
    c = F.col(text) if isinstance(text, str) else text
    plain = c.rlike(r"^[\x20-\x7e]*$")
    return F.when(c.isNull(), c).when(plain, F.trim(F.regexp_replace(c, " {2,}", " "))).otherwise(_skeletons(prototypes)(F.when(~plain, c)))


def with_skeleton(df: DataFrame, text: str, name: str = "skeleton") -> DataFrame:
    """df with the one form of its text; equal for texts that look the same, different for all others.

    Null stays null and an empty text empty; letters, accents, case and punctuation stay apart.
    """
    return df.withColumn(name, skeleton_column(text, public_prototypes(df.sparkSession)))


def lookalike_pairs(df: DataFrame, group: str, ident: str, pos: str, text: str, chunk: int = 20_000) -> DataFrame:
    """Pairs of rows of one group whose texts look the same but aren't the same string.

    Columns: group, id_a, pos_a, id_b, pos_b, the smaller (ident, pos) first. Null, empty and blank texts, and rows
    with a null group or ident, take no part. Rows are grouped by the 128-bit hash of their skeleton; groups that hold
    one string only are dropped by an aggregation before anything is paired, so common phrases cost nothing. What is
    left is joined with itself; of a group over chunk rows the left side is cut into chunks and the right side repeated.
    """
    rows = df.select(F.col(group).alias("_g"), F.col(ident).alias("_i"), F.col(pos).alias("_p"), F.col(text).alias("_t")).where("_g is not null and _i is not null and _t <> ''")
    skeletons = skeleton_column("_t", public_prototypes(df.sparkSession))
    rows = stage(rows.select("_g", "_i", "_p", F.unhex(F.md5(skeletons)).alias("_s"), F.unhex(F.md5("_t")).alias("_t")), "skeletons")
    rows = rows.where(F.col("_s") != F.unhex(F.md5(F.lit(""))))  # a filter on the text itself would work it out twice
    mixed = rows.groupBy("_g", "_s").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.count(F.lit(1)).alias("_n")).where("_lo <> _hi")
    mixed = mixed.select("_g", "_s", F.ceil(F.col("_n") / chunk).cast("int").alias("_cuts"))
    kept = stage(rows.join(mixed, ["_g", "_s"]), "lookalikes")
    a = kept.withColumn("_cut", F.pmod(F.xxhash64("_i", "_p"), F.col("_cuts")).cast("int")).drop("_cuts")
    b = kept.withColumn("_cut", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1))).drop("_cuts")
    a, b = a.alias("a"), b.alias("b")
    same = (F.col("a._g") == F.col("b._g")) & (F.col("a._s") == F.col("b._s")) & (F.col("a._cut") == F.col("b._cut"))
    first = (F.col("a._i") < F.col("b._i")) | ((F.col("a._i") == F.col("b._i")) & (F.col("a._p") < F.col("b._p")))
    pairs = a.join(b, same & (F.col("a._t") != F.col("b._t")) & first)
    return pairs.select(F.col("a._g").alias(group), F.col("a._i").alias("id_a"), F.col("a._p").alias("pos_a"), F.col("b._i").alias("id_b"), F.col("b._p").alias("pos_b"))
