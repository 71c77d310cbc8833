"""Text functions as column expressions; all run in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str methods see it; the class is valid in Java's and RE2's syntax alike.
BLANK = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
#: Word characters over all scripts.
WORDISH = r"[\p{L}\p{N}_]"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def char_class(chars: Iterable[str]) -> str:
    """A regular-expression class of the given characters, escaped for Java and RE2."""
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(set(chars))) + "]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value worked out once; inside a lambda an expression would be worked out for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: str | Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_c(text), rf"^{BLANK}+|{BLANK}+$", "")


def split_words(text: str | Column) -> Column:
    """Words between runs of white space, none empty; an empty or blank text has no words; null stays null."""
    return F.filter(F.split(_c(text), rf"{BLANK}+"), lambda x: x != "")


def squeeze(text: str | Column) -> Column:
    """Words with one blank between them."""
    return F.array_join(split_words(text), " ")


def count_words(text: str | Column) -> Column:
    return F.size(split_words(text))


#: Fixed value: the signs deleted by default; the apostrophe stays.
PUNCTUATION = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def delete_chars(text: str | Column, chars: str = PUNCTUATION) -> Column:
    """The text without any of the characters."""
    return F.regexp_replace(_c(text), char_class(chars), "")


def attach_punctuation(text: str | Column) -> Column:
    """No blanks between a word character and a following . , ; ! or ?"""
    return F.regexp_replace(_c(text), rf"({WORDISH}){BLANK}+([.,;!?])", "$1$2")


# Signs that become a blank, and that vanish, when a label is cleaned.
LABEL_BLANKS = '/?*",.:=?_{|}~¨«·»¡¿„…‧‹›≪≫!:;ː→'
LABEL_NOTHING = "`¨´‘’“”`ʻ‘’“\"‘”"
DIGIT_WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]


def spell_digits(text: str | Column) -> Column:
    """Words of digits only are read out digit by digit, without leading zeros (so 0 alone vanishes)."""

    def say(w: Column) -> Column:
        digits = F.regexp_replace(w, "^0+", "")
        out = digits
        for i, word in enumerate(DIGIT_WORDS):
            out = F.replace(out, F.lit(str(i)), F.lit(f"{word} "))
        return F.when(w.rlike("^[0-9]+$"), F.trim(out)).otherwise(w)

    return F.array_join(F.filter(F.transform(split_words(text), say), lambda x: x != ""), " ")


def clean_label(text: str | Column, digits_to_words: bool = True) -> Column:
    """A transcript in plain form: lower case, quotes deleted, other signs blanked, digits spelt, one blank between words."""
    out = F.lower(strip(text))
    out = F.regexp_replace(out, char_class(LABEL_NOTHING), "")
    out = F.regexp_replace(out, char_class(LABEL_BLANKS), " ")
    return spell_digits(out) if digits_to_words else squeeze(out)


def separate_marks(text: str | Column, marks: str = ".,?") -> Column:
    """Each mark stands alone between blanks."""
    out = F.regexp_replace(_c(text), f"({char_class(marks)})", " $1 ")
    return strip(F.regexp_replace(out, rf"{BLANK}{{2,}}", " "))


def remove_marks(text: str | Column, marks: str = ".,?") -> Column:
    """Marks replaced by blanks, runs of blanks by one."""
    return strip(F.regexp_replace(F.regexp_replace(_c(text), char_class(marks), " "), rf"{BLANK}{{2,}}", " "))


#: Fixed value: ASCII punctuation.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def normalize_answer(text: str | Column) -> Column:
    """Lower case without punctuation, articles and extra blanks, for comparing answers."""
    out = F.regexp_replace(F.lower(_c(text)), char_class(ASCII_PUNCTUATION), "")
    return squeeze(F.regexp_replace(out, rf"(^|[^\p{{L}}\p{{N}}_])(?:(?:a|an|the)(?=[^\p{{L}}\p{{N}}_]|$))+", "$1 "))


def keep_alphanumeric(text: str | Column, keep: str = "") -> Column:
    """Lower case; only letters, numbers, white space and the given symbols stay."""
    kept = "".join(f"\\x{{{ord(c):x}}}" for c in keep)
    return F.regexp_replace(F.lower(_c(text)), rf"[^\p{{L}}\p{{N}}\s\x0B\x1C-\x1F\x85\p{{Z}}{kept}]", "")


def mark_end(text: str | Column, token: str = "<eou>", endings: str = ".!?。！？…") -> Column:
    """Append the token to a text that ends as a sentence; any other text stays as it is."""
    bare = F.regexp_replace(_c(text), rf"{BLANK}+$", "")
    return F.when(bare.rlike(f"{char_class(endings)}$"), F.concat(bare, F.lit(f" {token}"))).otherwise(_c(text))


def split_sentences(text: str | Column, marks: str = ".?!") -> Column:
    """Sentences that end in a mark followed by a blank; hyphens become blanks, asterisks go, first letters are raised."""
    plain = F.replace(F.replace(_c(text), F.lit("-"), F.lit(" ")), F.lit("*"), F.lit(""))
    pieces = F.filter(F.transform(F.split(plain, rf"(?<={char_class(marks)}) "), strip), lambda s: s != "")
    return F.transform(pieces, lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 2147483647)))


_LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COMMON = "0123456789 '.,!?;:-"
# Letters and signs that a language has beside the basic ones.
_MORE = {
    "en": "", "fr": "àâäéèêëïîôùûüÿçœæ«»", "de": "äöüß„\"", "es": "áéíóúüñ¿¡«»", "it": "àèéìíîòóùú«»", "pt": "àáâãçéêíóôõú«»",
    "da": "æøå", "nl": "àáâäèéêëïíîóôöúû", "sv": "åäö", "tr": "çğıöşü", "vi": "àáảãạăằắẳẵặâầấẩẫậèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵđ",
}
_UKRAINIAN = "абвгґдеєжзиіїйклмнопрстуфхцчшщьюя"
# Fixed value: languages whose characters aren't checked.
UNCHECKED = ("zh", "ar", "he", "ja", "ko")


def alphabet(language: str) -> set[str]:
    """The characters allowed in a language's texts; the empty set means any, an unknown language counts as English."""
    if language in UNCHECKED:
        return set()
    if language == "uk":
        return set(_UKRAINIAN + _UKRAINIAN.upper() + _COMMON + "ʼ«»—")
    more = _MORE.get(language, "")
    raised = "".join(c.upper() for c in more if len(c.upper()) == 1)
    return set(_LATIN + _COMMON + more + raised + ("İ" if language == "tr" else "")) - ({"ẞ"} if language == "de" else set())


def allowed_chars(languages: Sequence[str]) -> set[str]:
    """The union of the languages' alphabets."""
    return set().union(*map(alphabet, languages)) if languages else set()


def has_only(text: str | Column, chars: set[str]) -> Column:
    """Whether every character is among chars; an empty text isn't valid, no chars mean that anything is."""
    c = F.coalesce(_c(text), F.lit(""))
    return c != "" if not chars else c.rlike(rf"\A{char_class(chars)}+\z")


# Texts that are nothing but a music tag, traces of page code, and escaped entities.
MUSIC_TAGS = ["[Music]", "[Musique]", "[Música]", "[Musik]", "[音乐]"]
CODE_TRACES = ["codecs=", "bitrate", ".NET CLR", "ytcfg", "https://", "http://", "indexRange", "initRange", "contentLength", "clickTrackingParams", "navigationEndpoint", "thumbnailRenderer", "clientName", "clientVersion"]
ENTITIES = ["&lt;", "&gt;", "&amp;", "&quot;"]


def is_speech_text(text: str | Column) -> Column:
    """Whether a text may be a transcript, not a tag, code, an endless repetition or mostly signs."""
    c = F.coalesce(_c(text), F.lit(""))
    size = F.length(c)
    signs = F.regexp_count(c, F.lit(r"[^\p{L}\p{N}\s\x0B\x1C-\x1F\x85\p{Z}]"))
    start = F.substring(c, 1, 10)
    again = (size - F.length(F.replace(c, start, F.lit("")))) / F.when(start != "", F.length(start))
    # Characters that stand ten times in a row, all found in one reading of the text.
    runs = F.arrays_overlap(F.regexp_extract_all(c, F.lit(r"(?s)(.)\1{9}"), F.lit(1)), characters(F.substring(c, 1, 20)))
    traces = "|".join(map(re.escape, CODE_TRACES + ENTITIES))
    tags = "|".join(map(re.escape, MUSIC_TAGS))
    return (
        c.rlike(rf"[^{BLANK[1:-1]}]")
        & ~c.rlike(rf"\A{BLANK}*(?:{tags}){BLANK}*\z")
        & ~c.rlike(traces)
        & (F.regexp_count(c, F.lit(r"[{}\[\]]")) <= 3)
        & ~((size > 20) & ((again >= 3) | runs))
        & (signs <= 0.3 * size)
    )


def expand_abbreviations(text: str | Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Each abbreviation with its period replaced by its word, in order."""
    return reduce(lambda c, p: F.regexp_replace(c, rf"(^|[^\p{{L}}\p{{N}}_]){p[0]}\.", f"$1{p[1]}"), pairs, _c(text))


# Abbreviations (without the period) and what is said.
COMMON_ABBREVIATIONS = [
    ("ms", "miss"), ("mrs", "misess"), ("mr", "mister"), ("messrs", "messeurs"), ("dr", "doctor"), ("drs", "doctors"), ("st", "saint"), ("co", "company"),
    ("jr", "junior"), ("sr", "senior"), ("rev", "reverend"), ("hon", "honorable"), ("sgt", "sergeant"), ("capt", "captain"), ("maj", "major"),
    ("col", "colonel"), ("lt", "lieutenant"), ("gen", "general"), ("prof", "professor"), ("lb", "pounds"), ("rep", "representative"), ("ave", "avenue"),
    ("etc", "et cetera"), ("jan", "january"), ("feb", "february"), ("mar", "march"), ("apr", "april"), ("jun", "june"), ("jul", "july"), ("aug", "august"),
    ("sep", "september"), ("oct", "october"), ("nov", "november"), ("dec", "december"),
]
MORE_ABBREVIATIONS = [
    ("ltd", "limited"), ("fig", "figure"), ("figs", "figures"), ("gent", "gentlemen"), ("ft", "fort"), ("esq", "esquire"), ("prep", "preperation"),
    ("bros", "brothers"), ("ind", "independent"), ("mme", "madame"), ("pro", "professional"), ("vs", "versus"), ("inc", "include"),
]


def render(template: str, fields: Sequence[str]) -> Column:
    """A template with {field} places filled from columns; read once, so braces in values stay as they are.

    Null counts as an empty text. A place that isn't among fields is an error.
    """
    parts = re.split(r"\{(\w+)\}", template.replace("\\n", "\n"))
    unknown = set(parts[1::2]) - set(fields)
    if unknown:
        raise ValueError(f"the template names {sorted(unknown)}, which aren't given")
    return F.concat(*[F.coalesce(F.col(p).cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p])


def byte_ids(text: str | Column) -> Column:
    """The UTF-8 bytes of a text as numbers."""
    code = F.hex(F.encode(_c(text), "UTF-8"))
    at = F.sequence(F.lit(0), (F.length(code) / 2 - 1).cast("int"))
    ids = F.transform(at, lambda i: F.conv(F.substring(code, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))
    return F.when(F.length(code) > 0, ids).otherwise(F.when(_c(text).isNotNull(), F.array().cast("array<int>")))


def characters(text: str | Column) -> Column:
    """The characters of a text."""
    return F.filter(F.split(_c(text), ""), lambda x: x != "")


def find_tokens(text: str | Column, pattern: str) -> Column:
    """All matches of the pattern, or else single characters but line ends; the pattern must have no groups."""
    return F.regexp_extract_all(_c(text), F.lit(f"({pattern}|.)"), F.lit(1))


#: How many distinct words a pair may have: as many as there are code points beside the surrogates and zero.
MOST_DISTINCT = 0x10FFFF - 2048


def edit_distance_words(a: str | Column, b: str | Column) -> Column:
    """The edit distance of two texts in words, without Python: each distinct word of a pair becomes one character.

    Exact at any length; null only where a text is null. A pair with over 1,112,063 distinct words is an error, as there
    are no more characters.
    """

    def as_chars(ws: Column, words: Column) -> Column:
        places = F.transform(ws, lambda w: F.array_position(words, w).cast("int"))
        points = F.transform(places, lambda p: F.lpad(F.hex(F.when(p < 0xD800, p).otherwise(p + 2048)), 8, "0"))
        # The mark of the byte order comes first, so that a word's own character is never taken for one.
        return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.array_join(points, ""))), "UTF-32")

    def distance(t: Column) -> Column:
        too_many = F.raise_error(F.lit(f"a pair has more than {MOST_DISTINCT} distinct words")).cast("int")
        return F.when(F.size(t["v"]) > MOST_DISTINCT, too_many).otherwise(F.levenshtein(as_chars(t["x"], t["v"]), as_chars(t["y"], t["v"])))

    both = F.struct(split_words(a).alias("x"), split_words(b).alias("y"))
    found = let(both, lambda s: let(F.struct(s["x"].alias("x"), s["y"].alias("y"), F.array_distinct(F.concat(s["x"], s["y"])).alias("v")), distance))
    return F.when(_c(a).isNotNull() & _c(b).isNotNull(), found)


def common_suffix_length(column: str | Column, limit: int | None = None) -> Column:
    """An aggregate: the length of the longest suffix, or of its last limit characters, that all texts share.

    What the first and the last of the reversed texts begin with alike, all between them do.
    """
    turned = F.reverse(_c(column))
    first, last = F.min(turned), F.max(turned)
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
    pairs = F.arrays_zip(F.split(first, "").alias("a"), F.split(last, "").alias("b"))
    step = lambda s, p: F.when(s["on"] & (p["a"] == p["b"]), F.struct((s["n"] + 1).alias("n"), F.lit(True).alias("on"))).otherwise(F.struct(s["n"].alias("n"), F.lit(False).alias("on")))
    same = F.coalesce(F.least(F.aggregate(pairs, start, step)["n"], F.length(first)), F.lit(0))
    return same if limit is None else F.least(same, F.lit(limit))


def common_prefix_length(a: str | Column, b: str | Column) -> Column:
    """How many characters two texts begin with alike; null where a text is null."""
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
    step = lambda s, p: F.struct((s["n"] + (s["on"] & (p["a"] == p["b"])).cast("int")).alias("n"), (s["on"] & (p["a"] == p["b"])).alias("on"))
    met = F.aggregate(F.arrays_zip(characters(a).alias("a"), characters(b).alias("b")), start, lambda s, p: step(s, F.struct(F.coalesce(p["a"], F.lit("")).alias("a"), F.coalesce(p["b"], F.lit("\u0000")).alias("b"))))
    return met["n"]


def newly_stable(before: str | Column, now: str | Column) -> Column:
    """What a step adds to a stable prefix: the new one without what it shares with the one before."""
    return F.substring(_c(now), common_prefix_length(before, now) + 1, F.length(_c(now)))


# How English is cut into tokens, as patterns and what takes their place, in order. A run of dots is held by
# a character of private use for each dot; a hyphen inside a word is written @-@.
ENGLISH_CUTS = [
    (r"\s+", " "), (r"[\x00-\x1f]", ""), (r"([^\s.'`,\-\p{L}\p{N}_]|[_\p{No}])", " $1 "), (r"([\p{L}\p{N}_])-([\p{L}\p{N}_])", "$1 @-@ $2"), (r"([\p{L}\p{N}_])-([\p{L}\p{N}_])", "$1 @-@ $2"),
    (r"([^\p{Nd}]),", "$1 , "), (r",([^\p{Nd}])", " , $1"), (r"(\p{Nd}),$", "$1 ,"), (r"([^\p{L}])'([^\p{L}])", "$1 ' $2"), (r"([^\p{L}\p{N}_])'([\p{L}])", "$1 ' $2"),
    (r"([^\p{Nd}\s])'([^\p{L}\s])", "$1 ' $2"), (r"([^\p{Nd}\s])'([\p{L}])", "$1 '$2"), (r"(\p{Nd})'(s)", "$1 '$2"), (r"([^\s.])\.(?:\s|$)", "$1 . "),
]
# Signs that are written as entities.
ENGLISH_ENTITIES = [("&", "&amp;"), ("|", "&#124;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&apos;"), ('"', "&quot;"), ("[", "&#91;"), ("]", "&#93;")]
_DOT = "\ue000"


def english_tokens(text: str | Column) -> Column:
    """English in tokens with one blank between: signs, commas beside numbers, contractions and final periods stand alone."""
    held = F.regexp_replace(F.regexp_replace(_c(text), r"\.(?=\.)", _DOT), rf"({_DOT})\.", f"$1{_DOT}")
    out = F.concat(F.lit(" "), F.regexp_replace(held, f"({_DOT}+)", " $1 "), F.lit(" "))
    for pattern, new in ENGLISH_CUTS:
        out = F.regexp_replace(out, pattern.replace(r"\-\p{L}", rf"{_DOT}\-\p{{L}}"), new)
    out = squeeze(F.replace(out, F.lit(_DOT), F.lit(".")))
    for sign, entity in ENGLISH_ENTITIES:
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out
