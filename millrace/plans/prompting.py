"""Queries over dialogue templates and tokenizers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import prompts as P
from millrace.functions import text as T
from millrace.functions import tokens as K
from millrace.operators.islands import runs_of_equal
from millrace.plans.tables import table
from millrace.plans.texts import _words

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _dialogues(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as arrays of user and assistant turns, turns of one role in a row joined."""
    m = table(spark, folder, "messages").groupBy("conv_id", "turn").agg(F.min_by(F.struct(F.lower(F.trim("role")).alias("role"), F.coalesce("content", F.lit("")).alias("content")), "message_id").alias("m")).select("conv_id", "turn", "m.*")
    role = F.when(F.col("role").isin("user", "human"), "user").when(F.col("role").isin("assistant", "gpt"), "assistant").otherwise(F.col("role"))
    m = m.withColumn("role", role).where("role in ('user', 'assistant')")
    r = runs_of_equal(m, ["conv_id"], ["turn"], "role")
    joined = r.groupBy("conv_id", "run").agg(F.first("role").alias("role"), F.array_sort(F.collect_list(F.struct("turn", "content"))).alias("x"))
    one = joined.select("conv_id", F.struct("run", "role", F.array_join(F.transform("x", lambda x: x["content"]), " ").alias("content")).alias("t"))
    return one.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("turns"))


DIALOGUE = """with m as (select conv_id, turn, case when r in ('user', 'human') then 'user' when r in ('assistant', 'gpt') then 'assistant' else r end as role, coalesce(c, '') as c from (select conv_id, turn, lower(trim(arg_min(role, message_id))) as r, arg_min_null(content, message_id) as c from messages group by 1, 2)),
k as (select * from m where role in ('user', 'assistant')), b as (select *, case when lag(role) over w = role then 0 else 1 end as n from k window w as (partition by conv_id order by turn)), i as (select *, sum(n) over (partition by conv_id order by turn) as run from b),
t as (select conv_id, run, any_value(role) as role, string_agg(c, ' ' order by turn) as content from i group by 1, 2), l as (select *, max(run) over (partition by conv_id) as last from t)"""


@query(DIALOGUE + """ select conv_id, md5('<|begin_of_text|>' || string_agg('<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || content || '<|eot_id|>', '' order by run) || case when arg_max(role, run) = 'assistant' then '' else '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) end) as text from l group by 1""")
def q_prompt_render(spark, folder):
    """Conversations in a chat template with preamble and headers."""
    return _dialogues(spark, folder).select("conv_id", F.md5(P.rendered("llama3", F.col("turns"))).alias("text"))


@query(DIALOGUE + """ select conv_id, md5('{bos}' || string_agg(case when role = 'user' then '<start_of_turn>user' || chr(10) || content || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10) else content || '<end_of_turn>' || chr(10) end, '' order by run) || case when arg_max(role, run) = 'assistant' then '{eos}' else '' end) as text from l group by 1""")
def q_prompt_marks(spark, folder):
    """A template that marks the beginning and end of the whole dialogue."""
    return _dialogues(spark, folder).select("conv_id", F.md5(P.rendered("gemma", F.col("turns"))).alias("text"))


@query(DIALOGUE + """, x as (select conv_id, string_agg(content, '' order by run) as plain, string_agg(case when role = 'user' then 'Instruct: ' || content || chr(10) || 'Output: ' else content end, '' order by run) as qa,
  string_agg(case when role = 'user' then '{bos}[INST] ' || content || ' [/INST]' else content || ' {eos}' end, '' order by run) as inst, string_agg(case when role = 'user' then '<|im_start|>user' else '<|im_start|>assistant' end || chr(10) || content || '<|im_end|>' || chr(10), '' order by run) || case when arg_max(role, run) = 'assistant' then '' else '<|im_start|>assistant' || chr(10) end as im,
  '<s>' || string_agg(case when role = 'user' then '[INST] ' || content || ' [/INST] ' else content || '</s>' end, '' order by run) as pre from l group by 1)
select conv_id, md5(plain) as plain, md5(qa) as qa, md5(inst) as inst, md5(im) as im, md5(pre) as pre from x""")
def q_prompt_templates(spark, folder):
    """Several templates at once."""
    names = {"plain": "plain", "qa": "phi2_qa", "inst": "llama2", "im": "qwen", "pre": "mistral"}
    return _dialogues(spark, folder).select("conv_id", *[F.md5(P.rendered(t, F.col("turns"))).alias(n) for n, t in names.items()])


@query(DIALOGUE + """ select conv_id, sum(octet_length(encode(case when role = 'user' then 'Human: ' || content || chr(10) || 'AI: ' else content end)))::bigint as input, case when arg_max(role, run) = 'assistant' then arg_max(octet_length(encode(content)), run) end::bigint as answer, case when arg_max(role, run) = 'assistant' then coalesce(sum(octet_length(encode(content))) filter (where role = 'assistant'), 0) end::bigint as masked from l group by 1""")
def q_context_answer_split(spark, folder):
    """Token arrays of dialogues: whole length, the answer's, and the places under the mask."""
    rows = P.encode_dialogues(_dialogues(spark, folder), "phi2_chat", "turns").select("conv_id", F.col("input_ids").alias("i"), F.col("answer_ids").alias("a"), F.col("mask").alias("m"))
    return rows.select("conv_id", F.size("i").cast("bigint").alias("input"), F.when(F.col("a").isNotNull(), F.size("a")).cast("bigint").alias("answer"), F.when(F.col("m").isNotNull(), F.size(F.filter("m", lambda x: x))).cast("bigint").alias("masked"))


@query(DIALOGUE + """ select conv_id, count(*) + 1 as turns, 'system' as first from l group by 1""")
def q_prepend_system(spark, folder):
    """A system turn before conversations that have none."""
    t = P.with_system(F.col("turns"), "Answer briefly.")
    return _dialogues(spark, folder).select("conv_id", F.size(t).cast("bigint").alias("turns"), F.element_at(t, 1)["role"].alias("first"))


@query("""
with t as (select message_id, coalesce(replace(content, 'the', '<sound>'), '') as x from messages), p as (select message_id, x, string_split(x, '<sound>') as s from t)
select message_id, case when contains(x, '<sound>') then array_to_string(list_filter([trim(s[1]), '<sound>', trim(s[2])], lambda v: v <> ''), '|') else x end as parts from p
""")
def q_placeholder_split(spark, folder):
    """Turns taken apart around a placeholder."""
    t = table(spark, folder, "messages").select("message_id", F.coalesce(F.replace("content", F.lit("the"), F.lit("<sound>")), F.lit("")).alias("x"))
    return t.select("message_id", F.array_join(F.transform(P.split_placeholder(F.col("x")), lambda p: p["value"]), "|").alias("parts"))


@query("select request_id, '<' || coalesce(target_language, 'en') || '> ' || coalesce(texts[1], '') as text from translate_requests where len(texts) > 0")
def q_translation_prompt(spark, folder):
    """The language's tag before the text."""
    r = table(spark, folder, "translate_requests").where(F.size("texts") > 0)
    return r.select("request_id", P.turn("t5_translation", "user", target_lang=P.angle(F.coalesce("target_language", F.lit("en"))), message=F.coalesce(F.element_at("texts", 1), F.lit(""))).alias("text"))


@query("select entry_id, '<|startoftranscript|><|' || coalesce(lang, 'en') || '|><|transcribe|><|' || coalesce(lang, 'en') || '|>' || case when entry_id % 2 = 0 then '<|pnc|>' else '<|nopnc|>' end as text from manifest_entries")
def q_speech_prompt(spark, folder):
    """The tags of a transcription task."""
    lang = P.language_tag(F.coalesce("lang", F.lit("en")))
    flag = F.when(F.col("entry_id") % 2 == 0, "yes").otherwise("no")
    return table(spark, folder, "manifest_entries").select("entry_id", P.turn("speech_tags", "user", source_lang=lang, task=P.task_tag(F.lit("asr")), target_lang=lang, pnc=P.flag_tag(flag, "pnc")).alias("text"))


@query("select item_id, 'Context: ' || coalesce(task, '') || ' Question: ' || coalesce(text, '') || ' Answer:' as text from eval_items")
def q_reading_prompt(spark, folder):
    return table(spark, folder, "eval_items").select("item_id", P.question_prompt("task", "text").alias("text"))


@query("select item_id, case when position(': ' in text) > 0 then string_split(text, ': ')[1] else text end as text from eval_items")
def q_before_marker(spark, folder):
    """What stands before a marker, the whole text where there is none."""
    return table(spark, folder, "eval_items").select("item_id", P.before_marker("text", ": ").alias("text"))


_VOC = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz ", 4)}
_IDS = "instr('abcdefghijklmnopqrstuvwxyz ', c)"


@query(f"with c as (select entry_id, list_transform(list_filter(string_split(lower(text), ''), lambda c: c <> ''), lambda c: case when {_IDS} > 0 then {_IDS} + 3 else 1 end) as v from manifest_entries where text is not null) select entry_id, list_concat([2], list_concat(v, [3])) as ids from c")
def q_char_tokens(spark, folder):
    """Characters as ids between special ones."""
    return table(spark, folder, "manifest_entries").where("text is not null").select("entry_id", K.char_ids(F.lower("text"), _VOC, 1, [2], [3]).alias("ids"))


@query(f"with c as (select entry_id, list_transform(list_filter(string_split(array_to_string({_words('lower(text)')}, ' '), ''), lambda c: {_IDS} > 0 and c <> ''), lambda c: {_IDS} - 1) as v from manifest_entries where text is not null) select entry_id, v as ids from c")
def q_parser_ids(spark, folder):
    """A transcript by labels; other characters fall away."""
    labels = list("abcdefghijklmnopqrstuvwxyz ")
    return table(spark, folder, "manifest_entries").where("text is not null").select("entry_id", K.parsed_ids("text", labels, -1, -1).alias("ids"))


@query(f"with w as (select item_id, list_transform({_words('text')}, lambda w: case w when 'the' then 6 when 'a' then 7 when 'and' then 8 else 1 end) as v from eval_items) select item_id, v as ids from w")
def q_word_tokens(spark, folder):
    return table(spark, folder, "eval_items").select("item_id", K.word_ids("text", {"the": 6, "a": 7, "and": 8}, 1).alias("ids"))


@query(f"with w as (select item_id, list_transform({_words('text')}, lambda w: length(w)) as v, lang from eval_items where lang in ('en', 'de', 'es')) select item_id, list_transform(v, lambda x: x + case lang when 'en' then 0 when 'de' then 100 else 150 end) as ids from w")
def q_aggregate_tokens(spark, folder):
    """Ids of languages' own tokenizers in one vocabulary."""
    ids = F.transform(T.split_words("text"), lambda w: F.length(w))
    rows = table(spark, folder, "eval_items").where("lang in ('en', 'de', 'es')")
    return rows.select("item_id", K.shifted_ids(ids, F.col("lang"), [("en", 100), ("de", 50), ("es", 70)]).alias("ids"))


@query("with s as (select p_partkey, p_size::bigint * 37 - (select min(p_size) * 37 from part) as v from part) select p_partkey, [(v // 100) % 100 + 100, v % 100] as codes from s")
def q_tabular_codes(spark, folder):
    """A whole-number column as digits."""
    p = table(spark, folder, "part").select("p_partkey", (F.col("p_size").cast("bigint") * 37).alias("v"))
    least = p.agg(F.min("v")).first()[0] or 0
    return p.select("p_partkey", F.transform(K.integer_code(F.col("v"), least, 2), lambda x: x.cast("bigint")).alias("codes"))


@query("with c as (select doc_kind, row_number() over (order by doc_kind) - 1 + 10 as code from (select distinct doc_kind from documents)) select doc_id, code::int as code from documents join c using (doc_kind)")
def q_category_codes(spark, folder):
    d = table(spark, folder, "documents")
    return d.where("doc_kind is not null").select("doc_id", F.element_at(K.lookup(F.array("doc_kind"), K.category_codes(d, "doc_kind", 10), 0), 1).alias("code"))


def q_quantile_codes(spark: SparkSession, folder: str) -> DataFrame:
    """A float column scaled by its quantiles, as digits."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    q = K.Quantiles(o, "o_totalprice")
    return o.select("o_orderkey", F.round(q.column("o_totalprice"), 6).alias("scaled"), q.digits("o_totalprice", 2).alias("digits"))


def q_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as ids of a sentencepiece model, and back."""
    model = "/opt/tokenizers/piece_bpe_32k.model"
    ids = table(spark, folder, "eval_items").select("item_id", "text", K.sentencepiece_ids("text", model).alias("ids"))
    return ids.select("item_id", F.size("ids").alias("n"), (K.sentencepiece_text("ids", model) == F.col("text")).alias("same"))


def q_library_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as ids of a tokenizer file."""
    return table(spark, folder, "eval_items").select("item_id", K.library_ids("text", "/opt/tokenizers/byte_bpe_50k.json").alias("ids"))


# The value's place between the quantiles on either side, no two of which are equal here.
SQL["q_quantile_codes"] = """
with q as (select quantile_cont(o_totalprice::double, list_transform(range(0, 100), lambda i: i / 99.0::double)) as q from orders),
o as (select o_orderkey, o_totalprice::double as v, len(list_filter(q, lambda e: e <= o_totalprice)) as i, q from orders, q),
s as (select o_orderkey, case when i >= 100 then 1.0 else (i - 1 + (v - q[i]) / (q[i + 1] - q[i])) / 99 end as s from o)
select o_orderkey, round(s, 6) as scaled, floor(s * 100)::bigint as digits from s
"""
QUERIES |= {"q_quantile_codes": q_quantile_codes, "q_sentencepiece": q_sentencepiece, "q_library_tokens": q_library_tokens}


@query(f"with w as (select item_id, list_transform({_words('text')}, lambda w: length(w)) as v from eval_items) select item_id, array_to_string(list_transform(v, lambda x: chr((x + 100)::int)), ' ') as text from w")
def q_lm_encoding(spark, folder):
    """Ids as characters for count-based language models."""
    ids = F.transform(T.split_words("text"), lambda w: F.length(w))
    return table(spark, folder, "eval_items").select("item_id", K.ids_as_characters(ids).alias("text"))


@query(f"""
with w as (select item_id, unnest({_words('lower(text)')}) as word, generate_subscripts({_words('lower(text)')}, 1) as p from eval_items), x as (select word, 'W' || length(word) as said from (select distinct word from w) where length(word) > 3)
select item_id, string_agg(coalesce(said, word), ' ' order by p) as said from w left join x using (word) group by 1
""")
def q_lexicon(spark, folder):
    """Words by a lexicon, with the word itself where it has none."""
    w = table(spark, folder, "eval_items").select("item_id", F.posexplode(T.split_words(F.lower("text"))).alias("p", "word"))
    lex = w.select("word").distinct().where(F.length("word") > 3).select("word", F.concat(F.lit("W"), F.length("word").cast("string")).alias("said"))
    met = w.join(lex, "word", "left").groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("p", F.coalesce("said", "word").alias("s")))).alias("x"))
    return met.select("item_id", F.array_join(F.transform("x", lambda x: x["s"]), " ").alias("said"))


@query("select entry_id, list_filter(['<|' || coalesce(lang, 'en') || '|>', coalesce(text, ''), '<|endoftext|>'], lambda x: x <> '') as pieces from manifest_entries")
def q_special_pieces(spark, folder):
    """Texts with special tokens around, taken apart."""
    t = F.concat(P.language_tag(F.coalesce("lang", F.lit("en"))), F.coalesce("text", F.lit("")), F.lit("<|endoftext|>"))
    return table(spark, folder, "manifest_entries").select("entry_id", K.special_pieces(t).alias("pieces"))
