"""Queries over the text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.plans.tables import table

QUERIES, SQL = {}, {}
BLANK = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
STRIP = rf"regexp_replace(§, '^{BLANK}+|{BLANK}+$', '', 'g')"
WORDS = rf"list_filter(regexp_split_to_array(§, '{BLANK}+'), lambda x: x <> '')"


def _strip(x: str) -> str:
    return STRIP.replace("§", x)


def _words(x: str) -> str:
    return WORDS.replace("§", x)


def _squeeze(x: str) -> str:
    return f"array_to_string({_words(x)}, ' ')"


def _class(chars: str) -> str:
    return T.char_class(chars).replace("'", "''")


def _add(name: str, source: str, key: str, build, sql: str) -> None:
    """A query of key and value over a text column of a table, with the SQL of the value."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return table(spark, folder, source).select(key, build("text").alias("value"))

    QUERIES[name] = run
    SQL[name] = f"select {key}, {sql} as value from {source}"


_add("q_strip", "documents", "doc_id", T.strip, _strip("text"))
_add("q_word_count", "documents", "doc_id", lambda c: T.count_words(c).cast("bigint"), f"cast(len({_words('text')}) as bigint)")
_add("q_squeeze", "manifest_entries", "entry_id", T.squeeze, _squeeze("text"))
_add("q_remove_punct", "manifest_entries", "entry_id", T.delete_chars, f"regexp_replace(text, '{_class(T.PUNCTUATION)}', '', 'g')")


def q_strip_space_punct(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "messages").select("message_id", T.attach_punctuation(F.regexp_replace("content", r"([.,!?])", " $1")).alias("value"))


QUERIES["q_strip_space_punct"] = q_strip_space_punct
SQL["q_strip_space_punct"] = rf"select message_id, regexp_replace(regexp_replace(content, '([.,!?])', ' \1', 'g'), '([\p{{L}}\p{{N}}_]){BLANK}+([.,;!?])', '\1\2', 'g') as value from messages"

_LABEL = f"regexp_replace(regexp_replace(lower({_strip('text')}), '{_class(T.LABEL_NOTHING)}', '', 'g'), '{_class(T.LABEL_BLANKS)}', ' ', 'g')"
_SAY = "trim(" + "".join("replace(" for _ in range(10)) + "regexp_replace(w, '^0+', '')" + "".join(f", '{i}', '{w} ')" for i, w in enumerate(T.DIGIT_WORDS)) + ")"
_SPELL = f"array_to_string(list_filter(list_transform({_words('¤')}, lambda w: case when regexp_full_match(w, '[0-9]+') then {_SAY} else w end), lambda x: x <> ''), ' ')"
_add("q_clean_label", "manifest_entries", "entry_id", T.clean_label, _SPELL.replace("¤", _LABEL))
_add("q_spell_digits", "documents", "doc_id", T.spell_digits, _SPELL.replace("¤", "text"))
_add("q_separate_marks", "manifest_entries", "entry_id", T.separate_marks, _strip(rf"regexp_replace(regexp_replace(text, '({_class('.,?')})', ' \1 ', 'g'), '{BLANK}{{2,}}', ' ', 'g')"))
_add("q_remove_marks", "manifest_entries", "entry_id", lambda c: F.lower(T.remove_marks(c)), "lower(" + _strip(rf"regexp_replace(regexp_replace(text, '{_class('.,?')}', ' ', 'g'), '{BLANK}{{2,}}', ' ', 'g')") + ")")
_add("q_hf_clean", "manifest_entries", "entry_id", lambda c: T.keep_alphanumeric(c, "'-"), r"regexp_replace(lower(text), '[^\p{L}\p{N}\s\x0B\x1C-\x1F\x85\p{Z}\x{27}\x{2d}]', '', 'g')")
_add(
    "q_eou", "manifest_entries", "entry_id", T.mark_end,
    f"case when regexp_matches(regexp_replace(text, '{BLANK}+$', ''), '{_class('.!?。！？…')}$') then regexp_replace(text, '{BLANK}+$', '') || ' <eou>' else text end",
)
_SENTENCES = f"list_filter(list_transform(string_split(regexp_replace(replace(replace(text, '-', ' '), '*', ''), '([.?!]) ', chr(1) || '\\1' || chr(2), 'g'), chr(2)), lambda s: {_strip("replace(s, chr(1), '')")}), lambda s: s <> '')"
_add("q_sentence_split", "documents", "doc_id", lambda c: T.split_sentences(c), f"list_transform({_SENTENCES}, lambda s: upper(s[1:1]) || s[2:])")


def q_byte_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes as ids, with the text's bytes counted by the engine itself."""
    ids = T.byte_ids("text")
    return table(spark, folder, "manifest_entries").select("entry_id", F.size(ids).cast("bigint").alias("n"), F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.element_at(F.when(F.size(ids) > 0, ids), 1).alias("first"))


QUERIES["q_byte_tokens"] = q_byte_tokens
SQL["q_byte_tokens"] = """
with h as (select entry_id, hex(encode(text)) as h, text from manifest_entries),
b as (select entry_id, text, list_transform(range(0, cast(length(h) / 2 as bigint)), lambda i: (instr('0123456789ABCDEF', h[2 * i + 1 : 2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2 : 2 * i + 2]) - 1) as ids from h)
select entry_id, case when text is not null then len(ids) end as n, case when text is not null then coalesce(list_sum(ids), 0)::bigint end as total, ids[1]::int as first from b
"""


def q_regex_tokens(spark: SparkSession, folder: str) -> DataFrame:
    t = T.find_tokens("text", r"[A-Za-z]+|[0-9]+")
    return table(spark, folder, "documents").select("doc_id", F.size(t).cast("bigint").alias("n"), F.md5(F.array_join(t, "|")).alias("tokens"))


QUERIES["q_regex_tokens"] = q_regex_tokens
SQL["q_regex_tokens"] = "select doc_id, len(t) as n, md5(array_to_string(t, '|')) as tokens from (select doc_id, regexp_extract_all(text, '([A-Za-z]+|[0-9]+|.)', 1) as t from documents)"


def q_valid_chars(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each text keeps to the alphabet of its row's language."""
    lang = F.lower(F.substring(F.coalesce("lang", F.lit("en")), 1, 2))
    ok = F.lit(None).cast("boolean")
    for x in ("en", "de", "es", "fr", "ru", "zh"):
        ok = F.when(lang == x, T.has_only("text", T.allowed_chars([x]))).otherwise(ok)
    return table(spark, folder, "manifest_entries").select("entry_id", ok.alias("valid"))


QUERIES["q_valid_chars"] = q_valid_chars
SQL["q_valid_chars"] = (
    "select entry_id, case lower(coalesce(lang, 'en')[1:2]) "
    + " ".join(f"when '{x}' then " + (f"regexp_full_match(coalesce(text, ''), '{_class(''.join(T.allowed_chars([x])))}+')" if T.allowed_chars([x]) else "coalesce(text, '') <> ''") for x in ("en", "de", "es", "fr", "ru", "zh"))
    + " end as valid from manifest_entries"
)


def q_valid_text_rules(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", T.is_speech_text("text").alias("valid"))


_TRACES = "|".join(x.replace(".", r"\.") for x in T.CODE_TRACES + T.ENTITIES)
QUERIES["q_valid_text_rules"] = q_valid_text_rules
SQL["q_valid_text_rules"] = rf"""
with d as (select doc_id, coalesce(text, '') as t from documents),
x as (select doc_id, t, length(t) as n, {_strip('t')} as bare, length(regexp_replace(t, '[^\p{{L}}\p{{N}}\s\x0B\x1C-\x1F\x85\p{{Z}}]', '', 'g')) as w from d)
select doc_id, bare <> '' and bare not in ({', '.join(f"'{x}'" for x in T.MUSIC_TAGS)}) and not regexp_matches(t, '{_TRACES}')
  and length(regexp_replace(t, '[^{{}}\[\]]', '', 'g')) <= 3
  and not (n > 20 and ((n - length(replace(t, t[1:10], ''))) / length(t[1:10]) >= 3
    or len(list_filter(range(1, 21), lambda i: t[i:i] <> '' and contains(t, repeat(t[i:i], 10)))) > 0))
  and w >= 0.5 * n and n - w <= 0.3 * n as valid
from x
"""


def q_normalize_answer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "eval_items").select("item_id", T.normalize_answer("text").alias("value"))


QUERIES["q_normalize_answer"] = q_normalize_answer
SQL["q_normalize_answer"] = rf"""
select item_id, array_to_string(list_filter({_words("regexp_replace(lower(text), '" + _class(T.ASCII_PUNCTUATION) + "', '', 'g')")}, lambda w: w not in ('a', 'an', 'the')), ' ') as value from eval_items
"""


def q_abbreviations(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose abbreviations are written out."""
    return table(spark, folder, "documents").select("doc_id", F.md5(T.expand_abbreviations(F.lower("text"), T.COMMON_ABBREVIATIONS)).alias("value"))


_EXPANDED = "lower(text)"
for _a, _b in T.COMMON_ABBREVIATIONS:
    _EXPANDED = rf"regexp_replace({_EXPANDED}, '(^|[^\p{{L}}\p{{N}}_]){_a}\.', '\1{_b}', 'g')"
QUERIES["q_abbreviations"] = q_abbreviations
SQL["q_abbreviations"] = f"select doc_id, md5({_EXPANDED}) as value from documents"


def q_template(spark: SparkSession, folder: str) -> DataFrame:
    """Rows rendered through a template."""
    rows = table(spark, folder, "generation_records")
    return rows.select("record_id", T.render("{model_tag} {{#}}{sample_idx}:\\n{text}".replace("{{#}}", "#"), ["model_tag", "sample_idx", "text"]).alias("value"))


QUERIES["q_template"] = q_template
SQL["q_template"] = "select record_id, coalesce(model_tag, '') || ' #' || coalesce(sample_idx::varchar, '') || ':' || chr(10) || coalesce(text, '') as value from generation_records"


def q_common_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """The longest common suffix of each source's file names."""
    return table(spark, folder, "manifest_entries").groupBy("source").agg(T.common_suffix_length("audio_filepath").cast("bigint").alias("n"))


QUERIES["q_common_suffix"] = q_common_suffix
SQL["q_common_suffix"] = """
with m as (select source, min(reverse(audio_filepath)) as a, max(reverse(audio_filepath)) as b from manifest_entries group by source)
select source, coalesce(list_max(list_filter(range(0, least(length(a), length(b)) + 1), lambda k: a[1:k] = b[1:k])), 0)::bigint as n from m
"""


def q_lower_normalized(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "manifest_entries").select("entry_id", "text", F.lower("text").alias("normalized_text"))


QUERIES["q_lower_normalized"] = q_lower_normalized
SQL["q_lower_normalized"] = "select entry_id, text, lower(text) as normalized_text from manifest_entries"


def q_ass_time(spark: SparkSession, folder: str) -> DataFrame:
    """Seconds as subtitle time H:MM:SS.cc."""
    s = F.col("start_time")
    cs = F.floor(s * 100).cast("bigint")
    shown = F.format_string("%d:%02d:%02d.%02d", F.floor(cs / 360000), F.floor(cs / 6000) % 60, F.floor(cs / 100) % 60, cs % 100)
    return table(spark, folder, "segment").where(s.isNotNull() & ~F.isnan(s) & (s >= 0)).select("segment_id", shown.alias("value"))


QUERIES["q_ass_time"] = q_ass_time
SQL["q_ass_time"] = """
select segment_id, format('{}:{:02d}:{:02d}.{:02d}', cs // 360000, (cs // 6000) % 60, (cs // 100) % 60, cs % 100) as value
from (select segment_id, cast(floor(start_time * 100) as bigint) as cs from segment where start_time is not null and not isnan(start_time) and start_time >= 0)
"""
