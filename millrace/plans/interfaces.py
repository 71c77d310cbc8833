"""Queries over what others may add to: tokenizers, metrics, parsers, extra fields, coders; and over whole data sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import prompts as P
from millrace.functions import text as T
from millrace.functions import tokens as K
from millrace.functions.tokenizers import tokenizer
from millrace.operators import aggregates as A
from millrace.operators import buckets as B
from millrace.operators import mergeable as G
from millrace.operators.filters import drop_reason
from millrace.plans.metrics import PAIRS, WORD_PAIRS, _pairs
from millrace.plans.tables import table
from millrace.plans.texts import _squeeze, _words
from millrace.session import fresh_path
from millrace.sources import corpus as C
from millrace.sources import hub as H
from millrace.sources import manifest as M
from millrace.sources.store import StoredFile

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("select entry_id, octet_length(encode(text)) + 2 as n, 256 as first, 257 as last, true as same from manifest_entries where text is not null")
def q_tokenizer_bytes(spark, folder):
    """Texts to ids and back by a tokenizer with special tokens around."""
    tok = tokenizer("byte").with_special(bos="<s>", eos="</s>")
    m = table(spark, folder, "manifest_entries").where("text is not null").select("entry_id", "text", tok.ids("text", ["bos"], ["eos"]).alias("ids"))
    return m.select("entry_id", F.size("ids").cast("bigint").alias("n"), F.element_at("ids", 1).alias("first"), F.element_at("ids", -1).alias("last"), (tok.text("ids") == F.col("text")).alias("same"))


_VOCABULARY = ["<unk>", "the", "a", "and", "of", "to"]
_LOOKUP = "coalesce(list_position(['<unk>', 'the', 'a', 'and', 'of', 'to'], w), 1) - 1"


@query(f"with w as (select doc_id, {_words('text')} as w from documents where text is not null) select doc_id, list_transform(w, lambda w: ({_LOOKUP})::int) as ids, array_to_string(list_filter(w, lambda w: {_LOOKUP} > 0), ' ') as back from w")
def q_tokenizer_words(spark, folder):
    """Words by a vocabulary with an id for all others."""
    tok = tokenizer("word", _VOCABULARY, unk="<unk>")
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", tok.ids("text").alias("ids"))
    return d.select("doc_id", "ids", tok.text("ids").alias("back"))


@query(f"{WORD_PAIRS} select model_tag, round(avg((hyp = ref)::int), 9) as exact, round(sum(e) / sum(n), 9) as wer, max(length(hyp)) - min(length(hyp)) as spread from e group by 1")
def q_metric_merged(spark, folder):
    """Metrics kept as states by shard, merged, and worked out by model."""
    rows = _pairs(spark, folder).withColumns({"shard": F.col("record_id") % 7, "size": F.length("hyp").cast("bigint")})
    metrics = {"exact": G.METRICS["exact_match"]("hyp", "ref"), "wer": G.METRICS["word_errors"]("hyp", "ref"), "spread": G.METRICS["spread"]("size")}
    parts = [G.updated(rows.where(f"shard {when}"), metrics, ["model_tag", "shard"]) for when in ("< 3", ">= 3")]
    out = G.computed(G.merged(parts, metrics, ["model_tag"]), metrics, ["model_tag"])
    return out.withColumns({"exact": F.round("exact", 9), "wer": F.round("wer", 9)})


@query(r"select message_id, coalesce(role, '') as role, regexp_replace(content, '[\t\r\n]', ' ', 'g') as content from messages where content is not null")
def q_parsed_lines(spark, folder):
    """Lines in a form of their own by a parser given for it; bad ones are dropped."""
    m = table(spark, folder, "messages")
    flat = F.regexp_replace("content", r"[\t\r\n]", " ")
    line = F.when(F.col("content").isNull(), F.concat(F.lit("broken "), F.col("message_id").cast("string"))).otherwise(F.concat_ws("\t", F.col("message_id").cast("string"), F.coalesce("role", F.lit("")), flat))
    out = fresh_path(spark, "files")
    m.select(line.alias("value")).write.text(out)

    def tabbed(line, file, schema):
        x = F.split(line, "\t")
        return F.when(F.size(x) == 3, F.struct(x[0].cast("bigint").alias("message_id"), x[1].alias("role"), x[2].alias("content")))

    M.register_parser("tabbed", tabbed)
    return M.items(spark, out, "message_id bigint, role string, content string", "tabbed", "drop").drop("id")


@query("""
with e as (select doc_id, row_number() over (order by doc_id) - 1 as p, ('0x' || substr(md5(doc_id || ':7'), 1, 8))::bigint % 25 as h from documents), a as (select message_id, row_number() over (order by message_id) - 1 as p from messages), n as (select n_name, row_number() over (order by n_nationkey) - 1 as p from nation)
select doc_id, 'line ' || message_id as note, n_name as place from e join a on a.p = e.p join n on n.p = e.h
""")
def q_extra_fields(spark, folder):
    """Fields attached by name: lines in turn, and lines by hash."""
    lines, places = fresh_path(spark, "lines"), fresh_path(spark, "places")
    table(spark, folder, "messages").orderBy("message_id").select(F.concat(F.lit("line "), F.col("message_id").cast("string"))).write.text(lines)
    table(spark, folder, "nation").orderBy("n_nationkey").select("n_name").write.text(places)
    fields = [{"type": "text_iter", "name": "note", "path": lines}, {"type": "text_sample", "name": "place", "path": places, "seed": 7}]
    return M.with_extra_fields(table(spark, folder, "documents").select("doc_id"), ["doc_id"], fields).select("doc_id", "note", "place")


@query("select record_id, octet_length(encode('Say: ' || coalesce(model_tag, '')))::int as input_length, coalesce(octet_length(encode(text)), 0)::int as output_length, (input_length + output_length)::int as total_length, output_length as masked from generation_records")
def q_formatted_lengths(spark, folder):
    """Formatted rows with their lengths."""
    rows = table(spark, folder, "generation_records").select("record_id", F.concat(F.lit("Say: "), F.coalesce("model_tag", F.lit(""))).alias("prompt"), "text")
    out = P.formatted(rows, "prompt", "text", tokenizer("byte").ids)
    return out.select("record_id", "input_length", "output_length", "total_length", F.size(F.filter("mask", lambda x: x)).alias("masked"))


@query("""
with s as (select p_partkey, p_size::bigint - (select min(p_size) from part) as v, p_brand from part), c as (select p_brand, row_number() over (order by p_brand) - 1 as c from (select distinct p_brand from part where p_brand is not null))
select p_partkey, [((v // 100) % 100 + 100)::int, (v % 100)::int, (201 + c)::int] as codes from s join c using (p_brand)
""")
def q_coded_rows(spark, folder):
    """A whole-number and a category column as one array of ids, by registered coders."""
    p = table(spark, folder, "part").where("p_brand is not null").select("p_partkey", F.col("p_size").cast("bigint").alias("p_size"), "p_brand")
    return p.select("p_partkey", K.row_codes(p, [("p_size", "int", {"length": 2}), ("p_brand", "category")]).alias("codes"))


@query(f"""
with l as (select request_id, list_transform(texts, lambda t: len({_words("coalesce(t, '')")})) as n from translate_requests), o as (select request_id, flatten(list_transform(range(1, len(n) + 1), lambda i: list_transform(range(0, n[i]), lambda k: i))) as o from l)
select request_id, list_transform(range(1, len(o) + 1), lambda i: list_transform(range(1, len(o) + 1), lambda j: o[i] = o[j] and j <= i)) as mask from o
""")
def q_block_mask(spark, folder):
    """Attention masks of packs of texts."""
    n = F.transform("texts", lambda t: F.size(T.split_words(F.coalesce(t, F.lit("")))))
    return table(spark, folder, "translate_requests").select("request_id", B.block_causal_mask(n).alias("mask")).where("mask is not null")


SQL["q_block_mask"] += " where o is not null"


def _hub(spark: SparkSession, folder: str) -> str:
    """Entries as a dataset's table with nested audio."""
    out = fresh_path(spark, "hub")
    audio = F.struct(F.concat(F.lit("zip://"), "audio_filepath", F.lit("::https://h/x.zip")).alias("path"), F.array_repeat(F.lit(0.0), (1 + F.col("entry_id") % 50).cast("int")).alias("array"), F.lit(16).alias("sampling_rate"))
    rows = table(spark, folder, "manifest_entries").where("audio_filepath is not null").select("entry_id", audio.alias("audio"), F.col("audio_filepath").alias("file"), F.regexp_replace("text", r"[\r\n]", " ").alias("text"), "lang")
    rows.write.parquet(out)
    return out


HUB_SQL = r"""
select entry_id, regexp_replace(case when starts_with(p, '/') then p else '/data/' || regexp_replace(p, '^/+', '') end, '([^/.])\.[^./]*$', '\1') || '.wav' as audio_filepath, t as text, lang, (1 + entry_id % 50) / 16.0::double as duration
from (select *, string_split(replace(audio_filepath, 'zip://', ''), '::')[1] as p, regexp_replace(text, '[\r\n]', ' ', 'g') as t from manifest_entries where audio_filepath is not null)
"""
_ROW = "audio_filepath string, entry_id bigint, text string, lang string, duration double"


def q_hub_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A dataset's table converted to a manifest in one job."""
    out = fresh_path(spark, "manifest")
    H.convert(spark, _hub(spark, folder), "/data", out)
    return M.items(spark, out, _ROW).select("entry_id", "audio_filepath", "text", "lang", "duration")


def q_hub_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream that takes each file once."""
    out = fresh_path(spark, "manifest")
    H.convert(spark, _hub(spark, folder), "/data", out, streaming=True, checkpoint=fresh_path(spark, "state"))
    return spark.read.schema(_ROW).json(out).select("entry_id", "audio_filepath", "text", "lang", "duration")


QUERIES |= {"q_hub_manifest": q_hub_manifest, "q_hub_stream": q_hub_stream}
SQL |= {"q_hub_manifest": HUB_SQL, "q_hub_stream": HUB_SQL}


@query(rf"select entry_id, 16 as sample_rate, (1 + entry_id % 50)::int as samples, {_squeeze("lower(coalesce(text, ''))")} as text from manifest_entries where audio_filepath is not null")
def q_hub_rows(spark, folder):
    """A dataset's table read by dotted keys, texts normalized."""
    rows = H.read_hub_table(spark, _hub(spark, folder), normalize=True, keep=["entry_id"])
    return rows.select("entry_id", "sample_rate", F.size("samples").alias("samples"), "text")


def _lengths(x: str) -> str:
    return f"list_transform({_words(x)}, lambda w: length(w))"


@query(f"""
with t as (select 0 as source, doc_id as k, unnest({_lengths('text')}) as v, generate_subscripts({_lengths('text')}, 1) as p from documents union all select 1, item_id, unnest({_lengths('text')}), generate_subscripts({_lengths('text')}, 1) from eval_items),
o as (select source, v, row_number() over (partition by source order by k, p) - 1 as i from t), s as (select source, i // 32 as sample, list(v order by i) as tokens from o group by 1, 2 having count(*) = 32), z as (select source, count(*) as size from s group by 1),
b as (select b::int as b, case when b < 30 then 0 else 1 end as source, case when b < 30 then b else b - 30 end as bias, case when b < 30 then 30 else 70 end as held from range(100) t(b)),
p as (select place, source, (bias + place // 100 * held) % size as sample from range(1000) t(place) join b on b.b = place % 100 join z using (source))
select place, source, sample, tokens from p join s using (source, sample)
""")
def q_token_blend(spark, folder):
    """Two token corpora blended by weights, place by place."""
    ids = F.transform(T.split_words("text"), lambda w: F.length(w))
    paths = {}
    for name, source, key in (("d", "documents", "doc_id"), ("e", "eval_items", "item_id")):
        paths[name] = fresh_path(spark, "corpus")
        table(spark, folder, source).where("text is not null").select(F.col(key).alias("k"), ids.alias("tokens")).write.parquet(paths[name])
    weighted = C.weighted_paths(["30", paths["d"], "70", paths["e"]])
    return C.blended([(w, C.token_samples(spark.read.parquet(p), ["k"], "tokens", 32)) for w, p in weighted], 1000)


@query(f"select row_number() over (order by doc_id) - 1 as sequence, list_transform({_lengths('text')}, lambda x: x::bigint) as tokens from documents where text is not null")
def q_token_files(spark, folder):
    """Documents as files of ids with an index, read again."""
    out = fresh_path(spark, "ids").removeprefix("file://")
    os.makedirs(out, exist_ok=True)
    ids = F.transform(T.split_words("text"), lambda w: F.length(w))
    prefixes = C.write_token_files(table(spark, folder, "documents").where("text is not null").select("doc_id", ids.alias("ids")), ["doc_id"], "ids", out, parts=1)
    return C.read_token_files(spark, prefixes[0])


_SOURCES = {"en": ["parlor_en", "homecmd_en", "townhall_en"], "de": ["aula_de", "telefonat_de"]}


@query("""
with p as (select * from (values ('en', 'parlor_en', 0), ('en', 'homecmd_en', 1), ('en', 'townhall_en', 2), ('de', 'aula_de', 0), ('de', 'telefonat_de', 1)) p(lang, source, turn)),
k as (select entry_id, lang, source, turn, entry_id % 8 as shard, coalesce(duration, 0) >= 3 and coalesce(duration, 0) <= 4 and not coalesce(isnan(duration), false) as kept from manifest_entries join p using (lang, source)),
c as (select lang, source, shard, count(*) filter (where kept) as n from k group by all),
d as (select *, case when n = 0 and lag(n) over w = 0 then 1 else 0 end as dry from c window w as (partition by lang, source order by shard)),
r as (select lang, source, shard from (select *, coalesce(max(dry) over (partition by lang, source order by shard rows between unbounded preceding and 1 preceding), 0) as gone from d) where gone = 0)
select entry_id, lang, source, row_number() over (partition by lang order by turn, shard, entry_id) - 1 as place from k join r using (lang, source, shard) where kept
""")
def q_language_sources(spark, folder):
    """Rows of each language in the order in which its sources and their shards are read."""
    d = F.coalesce("duration", F.lit(0.0))
    rows = table(spark, folder, "manifest_entries").select("entry_id", "lang", "source", (F.col("entry_id") % 8).alias("shard"), "duration")
    out = M.source_streams(rows, "lang", "source", "shard", ["entry_id"], _SOURCES, (d >= 3) & (d <= 4) & ~F.isnan(d))
    return out.select("entry_id", "lang", "source", "place")


@query(f"{PAIRS} select record_id, substr(hyp, coalesce(list_max(list_filter(range(0, least(length(hyp), length(ref)) + 1), lambda k: hyp[1:k] = ref[1:k])), 0) + 1) as added from p")
def q_stable_prefix(spark, folder):
    """What a text adds to the one before it."""
    return _pairs(spark, folder).select("record_id", T.newly_stable("ref", "hyp").alias("added"))


@query("with s as (select coalesce(sum(coalesce(octet_length(encode(text)), 0) + coalesce(octet_length(encode(model_tag)), 0)), 0) / 32 * 0.0025 as s from generation_records) select round(s, 6) as seconds, case when s < 60 then format('{:.2f} seconds', s) when s < 3600 then format('{:.2f} minutes', s / 60) else format('{:.2f} hours', s / 3600) end as shown from s")
def q_job_time(spark, folder):
    """How long an epoch over prompts and completions takes."""
    return A.epoch_time(table(spark, folder, "generation_records"), ["text", "model_tag"], 32).withColumn("seconds", F.round("seconds", 6))


_GRAMS = "select unnest(list_zip(list_concat(['<s>'], w), list_concat(w, ['</s>']))) as g from {0}"


@query(f"""
with d as (select {_words('lower(text)')} as w, case when lang = 'en' then 1.0 else 0.5 end as weight from documents where text is not null), dg as (select unnest(list_zip(list_concat(['<s>'], w), list_concat(w, ['</s>']))) as g, weight from d),
c as (select g[1] as h, g[2] as x, sum(weight) as n from dg group by 1, 2), v as (select count(distinct x) as v from c), h as (select h, sum(n) as n from c group by 1),
e as (select {_words('lower(text)')} as w from eval_items where text is not null), eg as (select g[1] as h, g[2] as x, count(*) as n from ({_GRAMS.format('e')}) group by 1, 2)
select sum(eg.n)::bigint as words, round(exp(-sum(eg.n * ln((coalesce(c.n, 0) + 1) / (coalesce(h.n, 0) + v))) / sum(eg.n)), 4) as perplexity from eg left join c using (h, x) left join h using (h), v
""")
def q_ngram_perplexity(spark, folder):
    """Perplexity of items under word pairs counted in two weighted corpora."""
    d = table(spark, folder, "documents").where("text is not null")
    words = T.split_words(F.lower("text"))
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    counts = A.merged_counts([(A.ngram_counts(d.where(english), words), 1.0), (A.ngram_counts(d.where(~english), words), 0.5)])
    out = A.ngram_perplexity(counts, A.ngram_counts(table(spark, folder, "eval_items").where("text is not null"), words))
    return out.withColumn("perplexity", F.round("perplexity", 4))


@query(f"""
with recursive o as materialized (select doc_id as d, len({_words('text')}) as n, row_number() over (order by md5('3:' || doc_id), doc_id) as k from documents where text is not null),
f as (select 0::bigint as i, []::bigint[] as room, null::bigint as doc_id, null::bigint as pack union all
  select k, case when p > len(room) then list_append(room, 8192 - n) else list_transform(room, lambda r, j: case when j = p then r - n else r end) end, d, p - 1
  from (select room, k, n, d, coalesce(list_position(list_transform(room, lambda r: r >= n), true), len(room) + 1) as p from f join o on k = i + 1))
select doc_id, pack from f where i > 0
""")
def q_first_fit_shuffled(spark, folder):
    """Documents by words in packs of 8,192, first-fit in shuffled order."""
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", T.count_words("text").alias("n"))
    return B.first_fit_shuffled(d, "doc_id", "n", 8192, 3).select("doc_id", "pack")


@query("select n_nationkey, n_name from nation")
def q_stored_file(spark, folder):
    """A file put into a store and got from it again."""
    local = fresh_path(spark, "local").removeprefix("file://") + ".csv"
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w", encoding="utf-8") as f:
        f.writelines(f"{r[0]},{r[1]}\n" for r in table(spark, folder, "nation").select("n_nationkey", "n_name").collect())  # 25 rows
    there = fresh_path(spark, "store") + ".csv"
    StoredFile(spark, there, local).put()
    got = StoredFile(spark, there, f"{local}.copy").get()
    return spark.read.schema("n_nationkey int, n_name string").csv(f"file://{got}")


def q_english_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Texts in English tokens."""
    return table(spark, folder, "documents").where("lang = 'en' and text is not null").select("doc_id", T.english_tokens("text").alias("tokens"))


QUERIES["q_english_tokens"] = q_english_tokens
