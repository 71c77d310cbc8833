"""Queries over scores that need an alignment or a matching, and over spoken texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import spoken as K
from millrace.operators import scoring as O
from millrace.operators.intervals import periods_and_gaps, to_millis
from millrace.operators.joins import bounded_hash
from millrace.operators.ordered import with_position
from millrace.plans.metrics import PAIRS, WORD_PAIRS, _pairs
from millrace.plans.tables import table
from millrace.plans.texts import _words
from millrace.session import stage

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"{WORD_PAIRS} select round(sum(e) / sum(n), 9) as rate, sum(n)::bigint as size from e")
def q_wer_detail(spark, folder):
    """The word error rate from insertions, deletions and substitutions."""
    return O.error_detail(_pairs(spark, folder), "hyp", "ref").select(F.round("rate", 9).alias("rate"), "size")


@query(f"{WORD_PAIRS} select record_id, e as errors, n as size from e")
def q_wer_per_utterance(spark, folder):
    """Word errors of each row by an alignment."""
    x = _pairs(spark, folder).select("record_id", O.edit_kinds("hyp", "ref").alias("e"))
    return x.select("record_id", (F.col("e.ins") + F.col("e.del") + F.col("e.sub")).cast("bigint").alias("errors"), F.col("e.size").cast("bigint").alias("size"))


_TOKENS = f"{PAIRS}, t as (select record_id, {_words('lower(hyp)')} as h, {_words('lower(ref)')} as r from p)"


def _ngrams(side: str, n: str) -> str:
    return f"select record_id, {n} as n, unnest(list_transform(range(1, len({side}) - {n} + 2), lambda i: array_to_string({side}[i : i + {n} - 1], chr(1)))) as g from t"


def _counted(side: str, most: int) -> str:
    return f"select record_id, n, g, count(*) as k from ({' union all '.join(_ngrams(side, str(n)) for n in range(1, most + 1))}) group by all"


@query(f"""
{_TOKENS}, h as ({_counted('h', 4)}), r as ({_counted('r', 4)}), m as (select n, sum(least(h.k, coalesce(r.k, 0))) as met, sum(h.k) as whole from h left join r using (record_id, n, g) group by n),
q as (select n, case when n > 1 then (met + 1) / (whole + 1) else met / whole end as p from m), z as (select sum(len(h)) as hn, sum(len(r)) as rn from t)
select round(100 * case when hn >= rn then 1 else exp(1 - rn / hn) end * exp(avg(ln(p))), 6) as bleu from q, z group by hn, rn
""")
def q_bleu(spark, folder):
    """Corpus BLEU of generated texts."""
    return O.bleu(_pairs(spark, folder), "record_id", "hyp", "ref", smooth=True).select(F.round("bleu", 6).alias("bleu"))


@query(f"""
with recursive {_TOKENS.removeprefix('with ')}, h as ({_counted('h', 2)}), r as ({_counted('r', 2)}),
m as (select record_id, n, sum(least(h.k, r.k)) as k from h join r using (record_id, n, g) group by 1, 2), z as (select record_id, n, greatest(len(h) - n + 1, 0) + greatest(len(r) - n + 1, 0) as z from t, range(1, 3) x(n)),
f as (select n, avg(case when k > 0 then 2 * k / z else 0 end) as f from z left join m using (record_id, n) group by 1),
l as (select record_id, h, r, 0 as i, list_transform(range(0, len(r) + 1), lambda j: 0) as row from t union all
  select record_id, h, r, i + 1, list_transform(range(1, len(r) + 2), lambda j: list_max(v[: j])) from (select *, list_transform(range(1, len(r) + 2), lambda j: case when j > 1 and r[j - 1] = h[i + 1] then row[j - 1] + 1 else row[j] end) as v from l where i < len(h))),
g as (select avg(case when row[len(row)] > 0 then 2 * row[len(row)] / (len(h) + len(r)) else 0 end) as f from l where i = len(h))
select round((select f from f where n = 1), 6) as rouge1, round((select f from f where n = 2), 6) as rouge2, round(f, 6) as "rougeL" from g
""")
def q_rouge(spark, folder):
    """Mean ROUGE of generated texts."""
    x = _pairs(spark, folder).select(O.rouge("hyp", "ref").alias("r"))
    return x.agg(*[F.round(F.avg(f"r.{k}"), 6).alias(k) for k in ("rouge1", "rouge2", "rougeL")])


@query()
def q_punctuation_rates(spark, folder):
    """Errors of punctuation marks."""
    return O.punctuation_rates(_pairs(spark, folder), "ref", "hyp")


_SPEECH = """
with rows as (select distinct session_id, speaker, cast(round(start_time * 1000) as bigint) as s, cast(round(end_time * 1000) as bigint) as e from segment
  where session_id is not null and speaker is not null and start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time)),
m as (select *, max(e) over (partition by session_id, speaker order by s, e rows between unbounded preceding and 1 preceding) as prior from rows where e > s),
l as (select *, sum(case when prior is null or s > prior then 1 else 0 end) over (partition by session_id, speaker order by s, e rows unbounded preceding) as label from m),
p as (select session_id, speaker, min(s) / 1000 as s, max(e) / 1000 as e from l group by session_id, speaker, label)
"""


def _speech(spark: SparkSession, folder: str) -> DataFrame:
    """Periods of each session and speaker in seconds."""
    s = table(spark, folder, "segment").select("session_id", "speaker", to_millis("start_time").alias("s"), to_millis("end_time").alias("e"))
    p = periods_and_gaps(s, ["session_id", "speaker"], "s", "e").where("kind = 'period'")
    return stage(p.select("session_id", "speaker", (F.col("start") / 1000).alias("start"), (F.col("end") / 1000).alias("end")), "speech")  # read several times


@query(f"""
with w as (select session_id, len({_words('words')}) as n, end_time - start_time >= 1 as kept from segment where speaker is not null and words is not null)
select session_id, sum(case when coalesce(kept, false) then 0 else n end)::bigint as errors, sum(n)::bigint as size, case when sum(n) > 0 then sum(case when coalesce(kept, false) then 0 else n end) / sum(n) end as cpwer from w group by 1
""")
def q_cpwer(spark, folder):
    """Word errors per session at the best matching of speakers; hypotheses are the texts of segments of a second or more.

    A hypothesis is its speaker's text without some segments, so no matching has fewer edits than the words that lack.
    """
    s = table(spark, folder, "segment").where("speaker is not null and words is not null")
    text = lambda df, side: df.groupBy("session_id", "speaker").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_id", "words"))), lambda x: x["words"]), " ").alias("text")).withColumn("side", F.lit(side))
    rows = text(s, "ref").unionByName(text(s.where("end_time - start_time >= 1"), "hyp"))
    return O.speaker_word_errors(rows, "session_id", "side", "speaker", "text")


@query(f"""
{_SPEECH}, r as (select session_id, speaker, s, e from p), h as (select session_id, speaker, s + 0.1 as s, e + 0.1 as e from p where e - s >= 1),
c as (select r.session_id, greatest(r.s, h.s) as s, least(r.e, h.e) as e from r join h using (session_id, speaker) where r.s < h.e and h.s < r.e),
ev as (select session_id, s as t, 1 as r, 0 as h, 0 as c from r union all select session_id, e, -1, 0, 0 from r union all select session_id, s, 0, 1, 0 from h union all select session_id, e, 0, -1, 0 from h union all select session_id, s, 0, 0, 1 from c union all select session_id, e, 0, 0, -1 from c),
b as (select session_id, t, sum(r) as r, sum(h) as h, sum(c) as c from ev group by 1, 2), x as (select session_id, t - lag(t) over w as d, sum(r) over w - r as r, sum(h) over w - h as h, sum(c) over w - c as c from b window w as (partition by session_id order by t)),
o as (select session_id, sum(r * d) as total, sum(greatest(r - h, 0) * d) as miss, sum(greatest(h - r, 0) * d) as fa, sum((least(r, h) - c) * d) as conf from x where d is not null group by 1)
select session_id, round(total, 6) as total, round(miss, 6) as miss, round(fa, 6) as false_alarm, round(conf, 6) as confusion, round((miss + fa + conf) / total, 6) as der from o
""")
def q_diarization(spark, folder):
    """Diarization errors of periods of a second or more, moved by a little, under other names."""
    ref = _speech(spark, folder)
    hyp = ref.where(F.col("end") - F.col("start") >= 1).select("session_id", F.concat(F.lit("x"), "speaker").alias("speaker"), (F.col("start") + 0.1).alias("start"), (F.col("end") + 0.1).alias("end"))
    out = O.diarization_errors(ref, hyp, "session_id")
    return out.select("session_id", *[F.round(c, 6).alias(c) for c in ("total", "miss", "false_alarm", "confusion", "der")])


@query("""
with r as (select segment_id, session_id, speaker, start_time as s, end_time as e from segment where start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time)), t as (select session_id, max(e) as t from r where speaker = 'A' group by 1)
select segment_id, s as start, least(e, t) as end from r join t using (session_id) where s < t
""")
def q_partial_references(spark, folder):
    """References up to the last predicted end."""
    r = table(spark, folder, "segment").where("start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time)").select("segment_id", "session_id", "speaker", F.col("start_time").alias("start"), F.col("end_time").alias("end"))
    return O.clipped_references(r, r.where("speaker = 'A'"), "session_id").select("segment_id", "start", "end")


@query(f"""
{_SPEECH}, ev as (select session_id, s as t, 1 as n from p union all select session_id, e, -1 from p), b as (select session_id, t, sum(n) as n from ev group by 1, 2),
x as (select session_id, t - lag(t) over w as d, sum(n) over w - n as on_ from b window w as (partition by session_id order by t)),
o as (select session_id, sum(d) as span, sum(case when on_ = 0 then d else 0 end) as silence, sum(case when on_ > 1 then d else 0 end) as overlap from x where d is not null group by 1)
select session_id, round(span, 6) as span, round(silence, 6) as silence, round(overlap, 6) as overlap, round(silence / span, 6) as silence_share, round(overlap / span, 6) as overlap_share from o
""")
def q_session_talk(spark, folder):
    """Silence and overlap per session."""
    out = O.session_talk(_speech(spark, folder), "session_id")
    return out.select("session_id", *[F.round(c, 6).alias(c) for c in out.columns if c != "session_id"])


@query("""
with recursive o as materialized (select user_id as u, list({'id': event_id, 's': ('0x' || substr(md5(event_id || ':1'), 1, 8))::bigint % 3000, 'v': value} order by event_id) as x from events group by 1),
f as (select u, x, 0 as i, [x[1]] as kept from o where false union all select u, x, 0, x[: 0] from o union all
  select u, x, i + 1, case when b is not null then list_append(list_filter(kept, lambda k, j: j <> b and k.s <> x[i + 1].s), x[i + 1]) when met then kept else list_append(list_filter(kept, lambda k: k.s <> x[i + 1].s), x[i + 1]) end
  from (select *, list_position(list_transform(kept, lambda k: 100 * greatest(0, 21 - abs(k.s - x[i + 1].s)) / 21 >= 10 and x[i + 1].v > k.v), true) as b, len(list_filter(kept, lambda k: 100 * greatest(0, 21 - abs(k.s - x[i + 1].s)) / 21 >= 10)) > 0 as met from f where i < len(x)))
select u as utt, unnest(list_transform(kept, lambda k: k.id)) as event_id from f where i = len(x)
""")
def q_best_spots(spark, folder):
    """Of overlapping spotted words the better ones."""
    e = table(spark, folder, "events").select(F.col("user_id").alias("utt"), "event_id", (bounded_hash(3000, F.col("event_id"), 1)).cast("int").alias("start"), F.col("value").alias("score"))
    return O.spotted_words(e.withColumn("end", F.col("start") + 20), "utt", ["event_id"], "start", "end", "score").select("utt", "event_id")


@query("""
with w as (select session_id as k, start_time as s, end_time as e, segment_id as i, 0.5::double as v from segment where speaker is not null and start_time >= 0 and end_time > start_time and not isnan(end_time) and not isnan(start_time)),
x as (select k, s + 0.2 as s, e + 0.2 as e, i, ('0x' || substr(md5(i || ':1'), 1, 8))::bigint % 10 / 10 as v from w where e - s < 0.5),
m as (select w.k, w.i as wi, x.i as xi, x.v as xv from w join x on w.k = x.k and w.s - 1e-9 < x.e and x.s < w.e + 1e-9 where 100 * (least(w.e, x.e) - greatest(w.s, x.s)) / greatest(w.e - w.s, 1e-9) >= 10),
lost as (select distinct xi from m where xv < 0.5), good as (select * from x where i not in (select xi from lost)), gone as (select distinct wi from m where xi not in (select xi from lost))
select k as session_id, spotted, count(*) as n from (select k, false as spotted from w where i not in (select wi from gone) union all select k, true from good) group by 1, 2
""")
def q_replaced_words(spark, folder):
    """Aligned words with spotted ones in place of those they cover."""
    s = table(spark, folder, "segment").where("speaker is not null and start_time >= 0 and end_time > start_time and not isnan(end_time) and not isnan(start_time)")
    w = s.select("session_id", F.col("start_time").alias("start"), F.col("end_time").alias("end"), F.concat("speaker", F.lit("-"), F.col("segment_id").cast("string")).alias("word"), F.lit(0.5).alias("score"), "segment_id")
    x = w.where(F.col("end") - F.col("start") < 0.5).select("session_id", (F.col("start") + 0.2).alias("start"), (F.col("end") + 0.2).alias("end"), F.concat(F.lit("spot-"), "word").alias("word"), (bounded_hash(10, F.col("segment_id"), 1) / 10).alias("score"))
    return O.replaced_words(w, x, "session_id").groupBy("session_id", "spotted").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
{PAIRS}, q as (select unnest(['the', 'each', 'of course']) as phrase), t as (select phrase, ' ' || regexp_replace(lower(hyp), '\\s+', '  ', 'g') || ' ' as h, ' ' || regexp_replace(lower(ref), '\\s+', '  ', 'g') || ' ' as r, ' ' || replace(phrase, ' ', '  ') || ' ' as f from p, q),
k as (select phrase, (length(h) - length(replace(h, f, ''))) // length(f) as h, (length(r) - length(replace(r, f, ''))) // length(f) as r from t),
o as (select phrase, sum(least(h, r))::bigint as tp, sum(r)::bigint as gt, sum(greatest(h - r, 0))::bigint as fp from k group by grouping sets ((phrase), ())), v as (select *, tp / (tp + fp + 1e-8) as precision, tp / (gt + 1e-8) as recall from o)
select *, 2 * precision * recall / (precision + recall + 1e-8) as f1 from v
""")
def q_phrase_scores(spark, folder):
    """Precision and recall of phrases."""
    return O.phrase_scores(_pairs(spark, folder), "record_id", "hyp", "ref", ["the", "each", "of course"])


@query("""
with recursive r as (select record_id, prompt_id, cer_gts as c, pred_context_similarity as s from generation_records where not isnan(cer_gts) and not isnan(pred_context_similarity) and cer_gts is not null and pred_context_similarity is not null),
l as (select record_id, 1 as layer from r union all select distinct b.record_id, l.layer + 1 from l join r a on a.record_id = l.record_id join r b on b.prompt_id = a.prompt_id and a.c <= b.c and a.s >= b.s and (a.c < b.c or a.s > b.s))
select record_id, max(layer) as layer from l group by 1
""")
def q_pareto_rank(spark, folder):
    """Layers of unbeaten records per prompt."""
    r = table(spark, folder, "generation_records").where("not isnan(cer_gts) and not isnan(pred_context_similarity)").select("record_id", "prompt_id", "cer_gts", "pred_context_similarity")
    return O.pareto_layers(r, "prompt_id", "cer_gts", "pred_context_similarity").select("record_id", "layer")


_ERF = "case when abs({0}) > 4.5 then sign({0}) else 2 / sqrt(pi()) * list_sum(list_transform(range(0, 120), lambda n: case when n % 2 = 0 then 1 else -1 end * sign({0}) * exp((2 * n + 1) * ln(greatest(abs({0}), 1e-300)) - lgamma(n + 1)) / (2 * n + 1))) end"


@query(f"""
with r as (select record_id, cer_gts as a, pred_context_similarity as b from generation_records where cer_gts is not null and pred_context_similarity is not null and not isnan(cer_gts) and not isnan(pred_context_similarity)),
z as (select record_id, (a - avg(a) over ()) / stddev_pop(a) over () / sqrt(2) as a, (b - avg(b) over ()) / stddev_pop(b) over () / sqrt(2) as b from r)
select record_id, round(1 - 0.5 * (1 + {_ERF.format('a')}) - 0.5 * (1 + {_ERF.format('b')}), 6) as reward from z
""")
def q_rewards(spark, folder):
    """Rewards from normal probabilities of two scores."""
    r = table(spark, folder, "generation_records").where("cer_gts is not null and pred_context_similarity is not null and not isnan(cer_gts) and not isnan(pred_context_similarity)")
    return O.normalized_rewards(r.select("record_id", "cer_gts", "pred_context_similarity"), ["cer_gts", "pred_context_similarity"]).select("record_id", F.round("reward", 6).alias("reward"))


@query("""
with s as (select session_id, speaker, segment_id, row_number() over (partition by session_id order by segment_id) as n, 1.0 / (1 + segment_id % 7) as der from segment)
select segment_id, round(sum(der) over w / n * 100, 3) as avg_der, round(max(round(100 * der, 3)) over w, 3) as max_der from s window w as (partition by session_id order by segment_id rows unbounded preceding)
""")
def q_online_der(spark, folder):
    """Running mean and maximum of an error rate per session."""
    from pyspark.sql import Window

    from millrace.operators.ordered import running_sum

    s = table(spark, folder, "segment").select("session_id", "segment_id", (1.0 / (1 + F.col("segment_id") % 7)).alias("der"), F.lit(1).alias("one"))
    s = running_sum(running_sum(s, ["session_id"], ["segment_id"], "der", "c"), ["session_id"], ["segment_id"], "one", "n")
    w = Window.partitionBy("session_id").orderBy("segment_id").rowsBetween(Window.unboundedPreceding, 0)
    return s.select("segment_id", F.round(F.col("c") / F.col("n") * 100, 3).alias("avg_der"), F.round(F.max(F.round(100 * F.col("der"), 3)).over(w), 3).alias("max_der"))


@query("""
with b as (select doc_id, row_number() over (order by doc_id) - 1 as p from documents), n as (select count(*) as n from b),
c as (select item_id, k, case when task = 'qa' then 3 else 1 end as times, ('0x' || substr(md5(item_id || ':' || k || ':2'), 1, 8))::bigint % n as p from eval_items, n, range(1, 4) t(k))
select item_id, k::int as k, doc_id from c join b using (p) where k <= times
""")
def q_context_pairs(spark, folder):
    """Each item with as many contexts as its class calls for, picked by hash."""
    d = with_position(table(spark, folder, "documents").select("doc_id"), ["doc_id"], "p")
    n = d.count()
    e = table(spark, folder, "eval_items").select("item_id", F.explode(F.sequence(F.lit(1), F.when(F.col("task") == "qa", 3).otherwise(1))).alias("k"))
    return e.withColumn("p", bounded_hash(max(1, n), F.col("item_id"), F.col("k"), 2)).join(d, "p").select("item_id", "k", "doc_id")


@query("""
with recursive m as (select entry_id, lang, duration, row_number() over (partition by lang order by entry_id) - 1 as p from manifest_entries where duration > 0.5 and duration < 8 and lang in ('en', 'de') and not isnan(duration)), z as (select lang, greatest(count(*), 1) as z from m group by 1),
d as (select uid, k, case when ('0x' || substr(md5(uid || ':' || k || ':l'), 1, 8))::bigint % 2 = 0 then 'en' else 'de' end as lang from range(500) u(uid), range(16) t(k)),
o as materialized (select uid, list({'lang': lang, 'id': entry_id, 'd': duration} order by k) as x from (select uid, k, lang, ('0x' || substr(md5(uid || ':' || k), 1, 8))::bigint % z as p from d join z using (lang)) join m using (lang, p) group by 1),
f as (select uid, x, 0 as i, 0.0::double as t, x[: 0] as y from o union all select uid, x, i + 1, case when t >= 5 or t + x[i + 1].d > 12 then t else t + x[i + 1].d end, case when t >= 5 or t + x[i + 1].d > 12 then y else list_append(y, x[i + 1]) end from f where i < len(x))
select uid, round(t, 6) as duration, list_transform(y, lambda r: r.lang) as langs, list_transform(y, lambda r: r.id) as entries from f where i = len(x) and t >= 5
""")
def q_code_switched(spark, folder):
    """Composite utterances of two languages: draws by hash until five seconds, none above twelve."""
    m = table(spark, folder, "manifest_entries").where("duration > 0.5 and duration < 8 and lang in ('en', 'de') and not isnan(duration)").select("entry_id", "lang", "duration")
    e, d = (with_position(m.where(F.col("lang") == x), ["entry_id"], "p").select("p", "lang", "entry_id", "duration") for x in ("en", "de"))
    sizes = {"en": max(1, e.count()), "de": max(1, d.count())}
    draws = spark.range(500).select(F.col("id").alias("uid"), F.explode(F.sequence(F.lit(0), F.lit(15))).alias("k"))
    draws = draws.withColumn("lang", F.when(bounded_hash(2, F.col("uid"), F.col("k"), "l") == 0, "en").otherwise("de"))
    draws = draws.withColumn("p", F.when(F.col("lang") == "en", bounded_hash(sizes["en"], F.col("uid"), F.col("k"))).otherwise(bounded_hash(sizes["de"], F.col("uid"), F.col("k"))))
    x = draws.join(e.unionByName(d), ["lang", "p"]).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("k", "lang", "entry_id", "duration"))).alias("x"))
    none = F.array().cast("array<struct<lang:string,entry_id:bigint,duration:double>>")
    step = lambda a, r: F.when((a["t"] >= 5.0) | (a["t"] + r["duration"] > 12.0), a).otherwise(F.struct((a["t"] + r["duration"]).alias("t"), F.array_append(a["x"], F.struct(r["lang"].alias("lang"), r["entry_id"].alias("entry_id"), r["duration"].alias("duration"))).alias("x")))
    out = x.select("uid", F.aggregate("x", F.struct(F.lit(0.0).alias("t"), none.alias("x")), step).alias("a"))
    return out.where("a.t >= 5").select("uid", F.round("a.t", 6).alias("duration"), F.transform("a.x", lambda r: r["lang"]).alias("langs"), F.transform("a.x", lambda r: r["entry_id"]).alias("entries"))


# Spoken texts.


@query()
def q_cleaned_text(spark, folder):
    """Texts for speech: ASCII, numbers and abbreviations said."""
    return table(spark, folder, "documents").where("lang = 'en'").select("doc_id", F.md5(K.arrow(K.cleaned)("text")).alias("text"))


@query()
def q_said_numbers(spark, folder):
    """Items with their numbers in words."""
    return table(spark, folder, "eval_items").select("item_id", K.arrow(K.say_numbers)("text").alias("text"))


@query()
def q_folded_text(spark, folder):
    """English texts without marks, other languages composed."""
    t = table(spark, folder, "eval_items")
    return t.select("item_id", F.when(F.col("lang") == "en", K.arrow(K.english_lowered)("text")).otherwise(K.arrow(K.any_language)("text")).alias("text"))


@query()
def q_alignment_pieces(spark, folder):
    """Documents cut into pieces for alignment."""
    from pyspark.sql import types as T

    cut = K.arrow(lambda t: K.cut_for_alignment(t, 20), T.ArrayType(T.StringType()))
    return table(spark, folder, "documents").select("doc_id", F.posexplode(cut("text")).alias("place", "piece"))
