"""Queries over evaluation metrics and corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import aggregates as A
from millrace.plans.tables import table
from millrace.plans.texts import _class, _words

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Generated texts with the text of their context entry."""
    g = table(spark, folder, "generation_records").select("record_id", "model_tag", F.coalesce("text", F.lit("")).alias("hyp"), F.col("context_entry_id").alias("entry_id"))
    m = table(spark, folder, "manifest_entries").select("entry_id", F.coalesce("text", F.lit("")).alias("ref"), "lang", "source")
    return g.join(m, "entry_id")


PAIRS = """with p as (select record_id, model_tag, coalesce(g.text, '') as hyp, coalesce(m.text, '') as ref, lang, source from generation_records g join manifest_entries m on m.entry_id = g.context_entry_id)"""
_MAP = "array_to_string(list_transform({0}, lambda w: chr(cast(33 + list_position(v, w) as int))), '')"
WORD_PAIRS = f"""{PAIRS},
w as (select *, {_words('hyp')} as h, {_words('ref')} as r from p), v as (select *, list_distinct(list_concat(h, r)) as v from w),
e as (select *, levenshtein({_MAP.format('h')}, {_MAP.format('r')}) as e, len(r) as n from v)"""


_CHARS = "list_filter(string_split({0}, ''), lambda c: c <> '')"


def _char_edits(a: str, b: str) -> str:
    """Edits in characters, each distinct one of a pair as one byte."""
    v = f"list_distinct(list_concat({_CHARS.format(a)}, {_CHARS.format(b)}))"
    one = lambda x: f"array_to_string(list_transform({_CHARS.format(x)}, lambda w: chr(cast(33 + list_position({v}, w) as int))), '')"
    return f"levenshtein({one(a)}, {one(b)})"


@query(f"{PAIRS} select record_id, {_char_edits('hyp', 'ref')} as errors, length(ref) as size from p")
def q_cer_pairs(spark, folder):
    """Character errors of each pair."""
    e, n = A.errors_and_size("hyp", "ref", chars=True)
    return _pairs(spark, folder).select("record_id", e.cast("bigint").alias("errors"), n.cast("bigint").alias("size"))


@query(f"{WORD_PAIRS} select record_id, e as errors, n as size from e")
def q_wer_pairs(spark, folder):
    """Word errors of each pair."""
    e, n = A.errors_and_size("hyp", "ref")
    return _pairs(spark, folder).select("record_id", e.cast("bigint").alias("errors"), n.cast("bigint").alias("size"))


@query(f"""
with w as (select doc_id, unnest({_words('text')}) as w, generate_subscripts({_words('text')}, 1) as p from documents)
select doc_id, count(*) filter (where p % 2 = 0 or p % 11 = 0) as errors, count(*) as size from w group by 1
""")
def q_wer_long(spark, folder):
    """Word errors of whole documents, every word being its own: each second one replaced, each eleventh left out.

    As no word comes twice, the edits are the words that aren't there any more, whatever the length.
    """
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", F.transform(T.split_words("text"), lambda w, i: F.concat(w, F.lit("#"), i.cast("string"))).alias("w")).where(F.size("w") > 0)
    changed = F.filter(F.transform("w", lambda w, i: F.when((i + 1) % 11 == 0, "").when((i + 1) % 2 == 0, F.concat(F.lit("x"), w)).otherwise(w)), lambda w: w != "")
    d = d.select("doc_id", F.array_join("w", " ").alias("ref"), F.array_join(changed, " ").alias("hyp"))
    e, n = A.errors_and_size("hyp", "ref")
    return d.select("doc_id", e.cast("bigint").alias("errors"), n.cast("bigint").alias("size"))


@query(f"{WORD_PAIRS} select model_tag, source, sum(e)::bigint as errors, sum(n)::bigint as size, round(sum(e) / sum(n), 9) as rate from e group by grouping sets ((), (model_tag), (source)) having sum(n) > 0")
def q_wer_by_attribute(spark, folder):
    """Word error rate overall, by model and by source, in one scan."""
    return A.error_rates(_pairs(spark, folder), "hyp", "ref", ["model_tag", "source"]).where("size > 0").withColumn("rate", F.round("rate", 9))


@query(f"{WORD_PAIRS}, s as (select *, case when length(ref) >= 0 and length(ref) < 40 then '0-40' when length(ref) >= 40 and length(ref) < 80 then '40-80' end as slot from e) select slot, sum(e)::bigint as errors, sum(n)::bigint as size, round(sum(e) / sum(n), 9) as rate from s group by 1")
def q_slot_groups(spark, folder):
    """Word error rate by slots of the reference's length."""
    p = _pairs(spark, folder).withColumn("slot", A.slot(F.length("ref"), [(0, 40), (40, 80)]))
    e, n = A.errors_and_size("hyp", "ref")
    x = p.select("slot", e.alias("e"), n.alias("n")).groupBy("slot").agg(F.sum("e").alias("errors"), F.sum("n").alias("size"))
    return x.withColumn("rate", F.round(F.col("errors") / F.col("size"), 9))


@query(f"{PAIRS} select record_id, round_even({_char_edits('hyp[1:10]', 'ref[1:10]')} / 10 * 100, 2) as start_cer, round_even({_char_edits('right(hyp, 10)', 'right(ref, 10)')} / 10 * 100, 2) as end_cer from p where length(hyp) >= 10 and length(ref) >= 10")
def q_edge_cer(spark, folder):
    """Character errors at both ends, in percent."""
    p = _pairs(spark, folder).where((F.length("hyp") >= 10) & (F.length("ref") >= 10))
    cer = lambda cut: F.bround(F.levenshtein(cut("hyp"), cut("ref")) / 10 * 100, 2)
    return p.select("record_id", cer(lambda c: F.substring(c, 1, 10)).alias("start_cer"), cer(lambda c: F.right(F.col(c), F.lit(10))).alias("end_cer"))


_NORM = "list_filter(" + _words("regexp_replace(lower({0}), '" + _class(T.ASCII_PUNCTUATION).replace("{", "{{").replace("}", "}}") + "', '', 'g')").replace("{", "{{").replace("}", "}}").replace("{{0}}", "{0}").replace("{{{{", "{{").replace("}}}}", "}}") + ", lambda w: w not in ('a', 'an', 'the'))"


@query(f"""{PAIRS}, t as (select record_id, {_NORM.format('hyp')} as h, {_NORM.format('ref')} as r from p),
s as (select record_id, h, r, list_sum(list_transform(list_distinct(h), lambda w: least(len(list_filter(h, lambda x: x = w)), len(list_filter(r, lambda x: x = w))))) as k from t)
select record_id, h = r as exact, round(case when k > 0 then 2 * (k / len(h)) * (k / len(r)) / (k / len(h) + k / len(r)) else 0 end, 9) as f1 from s""")
def q_f1_em(spark, folder):
    """Exact match and token F1 after normalization."""
    n = _pairs(spark, folder).select("record_id", T.split_words(T.normalize_answer("hyp")).alias("h"), T.split_words(T.normalize_answer("ref")).alias("r"))
    return n.select("record_id", (F.col("h") == F.col("r")).alias("exact"), F.round(A.token_f1(F.col("h"), F.col("r")), 9).alias("f1"))


@query("""
with r as (select vec_id, label, list_position(list_sort(list_transform(range(0, len(embedding)), lambda i: {'s': -embedding[i + 1]::double, 'i': i})), {'s': -embedding[label + 1]::double, 'i': label::bigint}) as p from embeddings where label < len(embedding))
select count(*) as n, count(*) filter (where p <= 1) as top1, count(*) filter (where p <= 5) as top5 from r
""")
def q_topk_accuracy(spark, folder):
    """Rows whose label is among the highest scores."""
    e = table(spark, folder, "embeddings").where(F.col("label") < F.size("embedding"))
    s = F.transform("embedding", lambda x: x.cast("double"))
    return e.agg(F.count(F.lit(1)).alias("n"), F.count_if(A.top_k_correct(s, F.col("label"), 1)).alias("top1"), F.count_if(A.top_k_correct(s, F.col("label"), 5)).alias("top5"))


@query("select lang, count(*) as n, round(avg(case when doc_kind = 'log' then 1.0 else 0 end), 9) as accuracy from documents group by grouping sets ((), (lang))")
def q_accuracy_by_lang(spark, folder):
    """Exact match overall and per category."""
    d = table(spark, folder, "documents").select("lang", (F.col("doc_kind") == "log").cast("double").alias("ok"))
    return d.groupingSets([[F.col("lang")], []], "lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("ok"), 9).alias("accuracy"))


_SOFT = """with s as (select vec_id, list_transform(embedding, lambda x: exp(x::double - list_max(embedding)::double)) as e from embeddings), p as (select vec_id, list_transform(e, lambda x: x / list_sum(e)) as p from s)"""


@query(f"{_SOFT} select round(avg(exp(-list_sum(list_transform(p, lambda x: x * ln(x))))), 6) as perplexity from p")
def q_perplexity(spark, folder):
    """Mean perplexity of distributions."""
    return table(spark, folder, "embeddings").agg(F.round(F.avg(F.exp(A.entropy(A.softmax(F.col("embedding"))))), 6).alias("perplexity"))


@query(f"""{_SOFT}, v as (select *, len(p)::double as v from p)
select vec_id, round((list_max(p) * v - 1) / (v - 1), 6) as max_prob, round(1 + list_sum(list_transform(p, lambda x: x * ln(x))) / ln(v), 6) as gibbs_lin,
  round((pow(list_sum(list_transform(p, lambda x: pow(x, 0.33))), 1 / (0.33 - 1)) * v - 1) / (v - 1), 6) as renyi_exp,
  round((exp((1 - list_sum(list_transform(p, lambda x: pow(x, 0.33)))) / 0.67) - exp((1 - pow(v, 0.67)) / 0.67)) / (1 - exp((1 - pow(v, 0.67)) / 0.67)), 6) as tsallis_exp,
  round(1 + list_sum(list_transform(p, lambda x: pow(x, 0.33) * ln(x))) / ln(v) / pow(v, 0.67), 6) as gibbs_alpha from v""")
def q_confidence_measures(spark, folder):
    """Confidence of distributions by several measures."""
    e = table(spark, folder, "embeddings")
    size = e.select(F.max(F.size("embedding"))).first()[0] or 2
    p = e.select("vec_id", A.softmax(F.col("embedding")).alias("p"))
    one = lambda m, a=1.0: F.round(A.confidence(F.col("p"), size, m, a), 6)
    return p.select("vec_id", one("max_prob").alias("max_prob"), one("entropy_gibbs_lin").alias("gibbs_lin"), one("entropy_renyi_exp", 0.33).alias("renyi_exp"), one("entropy_tsallis_exp", 0.33).alias("tsallis_exp"), one("entropy_gibbs_lin", 0.33).alias("gibbs_alpha"))


@query("select vec_id, round(list_avg(embedding[1:4]), 6) as mean, round(list_min(embedding[1:4])::double, 6) as min, round(list_max(embedding[1:4])::double, 6) as max, round(embedding[1]::double * embedding[2]::double * embedding[3]::double * embedding[4]::double, 9) as prod from embeddings")
def q_confidence_aggregations(spark, folder):
    """Scores of several tokens as one."""
    s = F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double"))
    return table(spark, folder, "embeddings").select("vec_id", *[F.round(A.aggregate_scores(s, h), 9 if h == "prod" else 6).alias(h) for h in ("mean", "min", "max", "prod")])


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    g = table(spark, folder, "generation_records")
    ok = F.col("cer_gts").isNotNull() & F.col("pred_context_similarity").isNotNull() & ~F.isnan("cer_gts") & ~F.isnan("pred_context_similarity")
    return g.where(ok).select((F.col("cer_gts") <= 0.05).cast("int").alias("truth"), ((F.col("pred_context_similarity") + 1) / 2).alias("score"))


SCORED = "with x as (select case when cer_gts <= 0.05 then 1 else 0 end as y, (pred_context_similarity + 1) / 2 as s from generation_records where not isnan(cer_gts) and not isnan(pred_context_similarity) and cer_gts is not null and pred_context_similarity is not null)"


@query(f"""{SCORED}, c as (select s, sum(y) as p, sum(1 - y) as n from x group by 1),
u as (select *, sum(p) over (order by s desc) as ap, sum(n) over (order by s desc) as an, sum(p) over (order by s) as cp, sum(n) over (order by s) as cn, sum(p) over () as tp, sum(n) over () as tn from c)
select round(sum(p * (cn - n / 2)) / max(tp * tn), 6) as auc_roc, round(sum(p * ap / (ap + an)) / max(tp), 6) as auc_pr, round(sum(n * cn / (cn + cp)) / max(tn), 6) as auc_nt from u""")
def q_auc(spark, folder):
    """Areas under the curves of a score."""
    out = A.ranking_metrics(_scored(spark, folder), "truth", "score")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(f"""{SCORED}, a as (select avg(y) as p, avg(-case when y = 1 then ln(greatest(least(s, 1 - 2.220446049250313e-16), 2.220446049250313e-16)) else ln(1 - greatest(least(s, 1 - 2.220446049250313e-16), 2.220446049250313e-16)) end) as l from x),
h as (select l, -(ln(p + 1e-15) * p + ln(1 - p + 1e-15) * (1 - p)) as h from a) select round((h - l) / h, 6) as nce from h""")
def q_nce(spark, folder):
    return _scored(spark, folder).agg(F.round(A.normalized_cross_entropy(F.col("truth"), F.col("score")), 6).alias("nce"))


@query(f"""{SCORED}, b as (select m, m / 100.0::double as a, (m + 1) / 100.0::double as b from range(100) t(m)),
r as (select m, y, case when s >= (m / 100 + (m + 1) / 100) / 2 then 1 else 0 end as c, case when s >= (m / 100 + (m + 1) / 100) / 2 then s else 1 - s end as v from x, b),
k as (select m, count(*) as n, sum(case when c = y then 1 else 0 end) as ok, sum(v) as conf from r where ceil(v * 100) - 1 = m group by m)
select round(sum(abs(ok - conf)) / sum(n), 6) as ece, sum(n)::bigint as counted from k""")
def q_ece(spark, folder):
    """Expected calibration error."""
    return A.calibration_error(_scored(spark, folder), "truth", "score").withColumn("ece", F.round("ece", 6))


@query(f"""{SCORED}, t as (select k from range(0, 101) t(k)), n as (select sum(y) as p, sum(1 - y) as n from x),
c as (select k, abs(count(*) filter (where y = 0 and floor(s * 100 + 1e-9) < k) / max(n.n) - count(*) filter (where y = 1 and floor(s * 100 + 1e-9) < k) / max(n.p)) as y from x, t, n group by k)
select round(avg(y), 6) as auc_yc, round(stddev_pop(y), 6) as std, round(max(y), 6) as max from c""")
def q_auc_yc(spark, folder):
    """Area, deviation and maximum of Youden's curve."""
    out = A.youden_curve(_scored(spark, folder), "truth", "score")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(f"{SCORED} select count(*) filter (where s >= 0.8 and y = 1) as tp, count(*) filter (where s >= 0.8 and y = 0) as fp, count(*) filter (where s < 0.8 and y = 1) as fn, round(2 * tp / (2 * tp + fp + fn), 9) as f1 from x")
def q_binary_counts(spark, folder):
    """True and false positives and F1 at a threshold."""
    x = _scored(spark, folder)
    hit = F.col("score") >= 0.8
    out = x.agg(F.count_if(hit & (F.col("truth") == 1)).alias("tp"), F.count_if(hit & (F.col("truth") == 0)).alias("fp"), F.count_if(~hit & (F.col("truth") == 1)).alias("fn"))
    return out.withColumn("f1", F.round(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), 9))


@query("select l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) as loss from lineitem group by 1")
def q_weighted_mean(spark, folder):
    """Mean loss weighted by batch size."""
    return table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_quantity")) / F.sum("l_quantity"), 4).alias("loss"))


@query("select coalesce(doc_kind, 'default') as doc_kind, round(avg(n_chars), 6) as mean, round(stddev_samp(n_chars), 6) as std from documents group by grouping sets ((), (doc_kind))")
def q_stats_grouping_sets(spark, folder):
    """Mean and deviation per kind and over all."""
    out = A.stats_by(table(spark, folder, "documents"), "doc_kind", "n_chars")
    return out.select("doc_kind", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("select coalesce(event_type, 'default') as event_type, round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std from events where value <> 0 group by grouping sets ((), (event_type))")
def q_nonzero_stats(spark, folder):
    """As q_stats_grouping_sets, zeros left out."""
    out = A.stats_by(table(spark, folder, "events").where("value <> 0"), "event_type", "value")
    return out.select("event_type", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("select speaker, row_number() over (order by speaker) - 1 as index from (select distinct speaker from segment where speaker is not null)")
def q_label_index(spark, folder):
    return A.label_index(table(spark, folder, "segment"), "speaker")


@query("""
with l as (select lang, source, sum(n_chars)::double as w from documents where lang is not null and source is not null group by 1, 2),
i as (select *, pow(w, 0.5) / sum(pow(w, 0.5)) over (partition by lang) as i from l), g as (select lang, pow(sum(w), 0.7) as g from l group by 1), o as (select lang, g / sum(g) over () as o from g)
select lang, source, round(i * o, 9) as weight from i join o using (lang)
""")
def q_temperature_weights(spark, folder):
    """Weights of sources within languages, reweighted at both levels."""
    d = table(spark, folder, "documents").where("lang is not null and source is not null")
    return A.hierarchical_weights(d, "lang", "source", "n_chars", (0.7, 0.5)).withColumn("weight", F.round("weight", 9))


@query("select lang, source, count(*) as n, sum(n_chars)::bigint as chars from documents group by rollup (lang, source)")
def q_rollup_sizes(spark, folder):
    return table(spark, folder, "documents").rollup("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query(f"with n as (select len({_words(chr(39) + chr(39) + ' || text')}) as n from documents where text is not null) select v::int as value, count(n.n) as n from range(0, (select max(n) + 1 from n)) t(v) left join n on n.n = v group by 1")
def q_len_histogram(spark, folder):
    """Documents by words, zeros included."""
    return A.dense_histogram(table(spark, folder, "documents").where("text is not null").select(T.count_words("text").alias("w")), "w")


@query("with r as (select n_chars, row_number() over (order by n_chars) as r, count(*) over () as n from documents where n_chars is not null) select n_chars as value from r where r = ceil(0.995 * n)")
def q_rank_percentile_995(spark, folder):
    """The nearest-rank 99.5th percentile of sizes."""
    got = A.nearest_rank(table(spark, folder, "documents"), "n_chars", 0.995)
    return spark.createDataFrame([(got,)], "value long")


@query("""
with s as (select count(*) as n, avg(n_chars) as m, stddev_pop(n_chars) as sd, max(n_chars) as mx from documents), r as (select n_chars, row_number() over (order by n_chars) as r from documents), p as (select n_chars as p from r, s where r.r = ceil(0.995 * n)), b as (select case when n >= 128 then 128 else coalesce((select max(v) from (select unnest([2, 4, 8, 12, 16, 32, 64, 128]) as v) where v < n * 0.9), 2) end as mb from s)
select least(mb, 32)::int as batch_size, mb::int as max_batch_size, floor(greatest(least(m + 2 * sd, mx), p) / 4)::bigint + 100 as max_seq_length, case when n <= 100 then 1024 when n <= 1000 then 2048 else 4096 end as encoder_hidden_size from s, p, b
""")
def q_hyperparameters(spark, folder):
    """Settings recommended from the rows' number and sizes."""
    d = table(spark, folder, "documents")
    s = d.agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("m"), F.stddev_pop("n_chars").alias("sd"), F.max("n_chars").alias("mx"))
    p = A.nearest_rank(d, "n_chars", 0.995) or 0
    cap = F.greatest(F.least(F.col("m") + 2 * F.col("sd"), F.col("mx").cast("double")), F.lit(float(p)))
    sizes = [2, 4, 8, 12, 16, 32, 64, 128]
    most = F.lit(2)
    for b in sizes:
        most = F.when(F.lit(b) < F.col("n") * 0.9, b).otherwise(most)
    most = F.when(F.col("n") >= 128, 128).otherwise(most)
    hidden = F.when(F.col("n") <= 100, 1024).when(F.col("n") <= 1000, 2048).otherwise(4096)
    return s.select(F.least(most, F.lit(32)).alias("batch_size"), most.alias("max_batch_size"), (F.floor(cap / 4) + 100).alias("max_seq_length"), hidden.alias("encoder_hidden_size"))


@query("with c as (select task, count(*) as n from eval_items group by 1), t as (select count(*) as d, sum(n) as s from c) select task, n, round(100 * n / s, 6) as percent from c, t where d < s / 3 order by n desc, task limit 5")
def q_imbalance(spark, folder):
    """The commonest labels where few labels cover the rows."""
    e = table(spark, folder, "eval_items")
    t = e.agg(F.count(F.lit(1)).alias("s"), F.countDistinct("task").alias("d")).first()
    c = e.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    return c.where(F.lit(t["d"] < t["s"] / 3)).select("task", "n", F.round(100 * F.col("n") / max(1, t["s"]), 6).alias("percent")).orderBy(F.desc("n"), "task").limit(5)


@query("with c as (select unnest(string_split(text, '')) as ch, doc_id from documents), d as (select ch, count(*) as n, min(doc_id) as f from c where ch <> '' group by 1) select ch, n from d order by n desc, f, ch limit 40")
def q_char_vocab_top(spark, folder):
    """The commonest characters."""
    c = table(spark, folder, "documents").select("doc_id", F.explode(T.characters("text")).alias("ch"))
    return c.groupBy("ch").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("f")).orderBy(F.desc("n"), "f", "ch").limit(40).select("ch", "n")


@query(f"""
with w as (select doc_id, unnest({_words('text')}) as w, generate_subscripts({_words('text')}, 1) as p from documents), f as (select w, min((doc_id, p)) as f from w group by 1)
select w as token, row_number() over (order by f) + 5 as id from f
""")
def q_token_first_appearance(spark, folder):
    """Token ids in the order of first appearance, after six special ones."""
    from millrace.operators.ordered import with_position

    w = table(spark, folder, "documents").select("doc_id", F.posexplode(T.split_words("text")).alias("p", "token"))
    f = w.groupBy("token").agg(F.min(F.struct("doc_id", "p")).alias("f"))
    return with_position(f, ["f"], "at").select("token", (F.col("at") + 6).alias("id"))


@query("""
with r as (select record_id, prompt_id, cer_gts as c, pred_context_similarity as s from generation_records where not isnan(cer_gts) and not isnan(pred_context_similarity) and cer_gts is not null and pred_context_similarity is not null)
select record_id from r a where not exists (select 1 from r b where b.prompt_id = a.prompt_id and b.c <= a.c and b.s >= a.s and (b.c < a.c or b.s > a.s))
""")
def q_pareto_front(spark, folder):
    """Records that none of their prompt beats in both scores."""
    r = table(spark, folder, "generation_records").where("cer_gts is not null and pred_context_similarity is not null and not isnan(cer_gts) and not isnan(pred_context_similarity)")
    front = A.pareto_front(r, ["prompt_id"], "cer_gts", "pred_context_similarity")
    best = front.groupBy("prompt_id", "pred_context_similarity").agg(F.min("cer_gts").alias("cer_gts"))
    return front.join(best, ["prompt_id", "pred_context_similarity", "cer_gts"], "left_semi").select("record_id")


@query("""
with d as (select prompt_id, list(wer_gts order by record_id) as delays, count(*) as n from generation_records where wer_gts is not null and not isnan(wer_gts) group by 1)
select prompt_id, round(case when delays[1] > 60 then delays[1] else (select sum(x.d - x.i / (greatest(n, 5) / 60)) / count(*) from (select unnest(delays) as d, unnest(range(0, n)) as i) x where x.i <= coalesce(list_position(list_transform(delays, lambda v: v >= 60), true) - 1, n)) end, 6) as laal from d
""")
def q_laal(spark, folder):
    """Average lagging of arrays of delays."""
    d = table(spark, folder, "generation_records").where("wer_gts is not null and not isnan(wer_gts)").groupBy("prompt_id").agg(F.array_sort(F.collect_list(F.struct("record_id", "wer_gts"))).alias("x"))
    delays = F.transform("x", lambda t: t["wer_gts"])
    return d.select("prompt_id", F.round(A.average_lagging(delays, F.lit(60.0), F.lit(5)), 6).alias("laal"))


@query("""
with c as (select unnest([0.0, 0.25, 0.5, 0.75, 1.0]) as c), r as (select prompt_id, record_id, cer_gts as d, wer_gts as w, pred_context_similarity as s from generation_records where cer_gts is not null and pred_context_similarity is not null and wer_gts is not null and not isnan(cer_gts) and not isnan(wer_gts) and not isnan(pred_context_similarity)),
b as (select c, prompt_id, arg_max(d, (s - c * w, -record_id)) as d from r, c group by 1, 2) select c::double as coefficient, round(avg(d), 9) as rate from b group by 1
""")
def q_linear_search(spark, folder):
    """The error rate of the best record per prompt for each weight of a second score."""
    r = table(spark, folder, "generation_records").where("cer_gts is not null and pred_context_similarity is not null and wer_gts is not null and not isnan(cer_gts) and not isnan(wer_gts) and not isnan(pred_context_similarity)")
    x = r.withColumn("coefficient", F.explode(F.array(*[F.lit(v) for v in (0.0, 0.25, 0.5, 0.75, 1.0)])))
    best = x.groupBy("coefficient", "prompt_id").agg(F.max_by("cer_gts", F.struct(F.col("pred_context_similarity") - F.col("coefficient") * F.col("wer_gts"), -F.col("record_id"))).alias("d"))
    return best.groupBy("coefficient").agg(F.round(F.avg("d"), 9).alias("rate"))


@query("select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double)) / len(embedding)), 6) as rms, round(20 * log10(list_max(list_transform(embedding, lambda x: abs(x::double)))), 6) as peak_db from embeddings")
def q_levels(spark, folder):
    """Levels of arrays of samples."""
    from millrace.functions import levels as L

    e = F.col("embedding")
    return table(spark, folder, "embeddings").select("vec_id", F.round(L.rms(e), 6).alias("rms"), F.round(L.magnitude_to_db(L.peak(e)), 6).alias("peak_db"))
