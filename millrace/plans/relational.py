"""Queries over filters, joins, set operations and sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import filters as O
from millrace.operators import joins as J
from millrace.operators.ordered import with_position
from millrace.plans.tables import table
from millrace.plans.texts import _strip, _words

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


CLEAN = "(duration is not null and not isnan(duration))"
REASON = f"case when coalesce(duration, 0) < 0.5 then 'too_short' when duration > 30 then 'too_long' when length({_strip('coalesce(text, ' + chr(39) * 2 + ')')}) < 1 then 'too_few_chars' when length({_strip('text')}) > 90 then 'too_many_chars' end"


@query(f"""
with r as (select source, duration, {REASON} as reason from (select source, text, case when not isnan(duration) then duration end as duration from manifest_entries))
select coalesce(reason, 'kept') as reason, count(*) as n, round(coalesce(sum(duration), 0) / 3600, 6) as hours from r group by 1
""")
def q_reason_filter_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest rows by the first rule that drops them."""
    rows = table(spark, folder, "manifest_entries").withColumn("duration", F.when(~F.isnan("duration"), F.col("duration")))
    reason = O.drop_reason(F.col("duration"), "text", max_chars=90)
    return rows.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("duration"), F.lit(0.0)) / 3600, 6).alias("hours"))


@query("select entry_id, duration from manifest_entries where duration between 1 and 10 or duration is null")
def q_duration_filter(spark, folder):
    return table(spark, folder, "manifest_entries").where(O.within(F.col("duration"), 1.0, 10.0)).select("entry_id", "duration")


@query("select record_id from generation_records where coalesce(cer_gts <= 0.2, true) and coalesce(pred_context_similarity >= 0.5, true) and coalesce(model_tag = 'base', true)")
def q_optional_filters(spark, folder):
    """Character error, speaker similarity and status filters that let missing values pass."""
    rows = table(spark, folder, "generation_records")
    return rows.where(O.within(F.col("cer_gts"), most=0.2) & O.within(F.col("pred_context_similarity"), least=0.5) & O.equals_or_missing(F.col("model_tag"), "base")).select("record_id")


@query(f"""
with t as (select entry_id, len({_words('text')}) as n, duration from manifest_entries)
select entry_id, n::bigint as n from t where coalesce(n between 3 and 40, true) and (duration is null or isnan(duration) or duration <= 0 or coalesce(n / duration between 0.5 and 4, true))
""")
def q_token_filters(spark, folder):
    """Token counts and tokens per second in range."""
    rows = table(spark, folder, "manifest_entries").select("entry_id", F.when(F.col("text").isNotNull(), T.count_words("text")).alias("n"), F.when(~F.isnan("duration"), F.col("duration")).alias("d"))
    return rows.where(O.within(F.col("n"), 3, 40) & O.tokens_per_second(F.col("n"), F.col("d"), 0.5, 4.0)).select("entry_id", F.col("n").cast("bigint").alias("n"))


@query(f"""
with m as (select conv_id, turn, min_by(content, message_id) as content from messages group by 1, 2),
p as (select a.conv_id, a.turn, len({_words('coalesce(a.content, ' + chr(39) * 2 + ')')}) as n, len({_words('coalesce(b.content, ' + chr(39) * 2 + ')')}) as k from m a join m b on a.conv_id = b.conv_id and a.turn = b.turn + 1)
select conv_id, turn from p where k = 0 or n * 1.0 / k between 0.5 and 2
""")
def q_tokens_per_token(spark, folder):
    """Turns whose length is between half and twice that of the turn before."""
    m = table(spark, folder, "messages").groupBy("conv_id", "turn").agg(F.min_by("content", "message_id").alias("content"))
    n = m.select("conv_id", "turn", T.count_words(F.coalesce("content", F.lit(""))).alias("n"))
    before = n.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("n").alias("k"))
    return n.join(before, ["conv_id", "turn"]).where(O.tokens_per_token(F.col("n"), F.col("k"), 0.5, 2.0)).select("conv_id", "turn")


@query(f"select count(*) as n, round(sum(duration) / 3600, 6) as hours, count(*) filter (where duration >= 2 and duration <= 12) as kept, round(sum(duration) filter (where duration >= 2 and duration <= 12) / 3600, 6) as kept_hours from manifest_entries where {CLEAN}")
def q_duration_hours(spark, folder):
    """Total and kept hours in one pass."""
    rows = table(spark, folder, "manifest_entries").where(F.col("duration").isNotNull() & ~F.isnan("duration"))
    ok = O.within(F.col("duration"), 2.0, 12.0)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("duration") / 3600, 6).alias("hours"), F.count_if(ok).alias("kept"), F.round(F.sum(F.when(ok, F.col("duration"))) / 3600, 6).alias("kept_hours"))


@query(f"""
with t as (select entry_id, len({_words("coalesce(text, '')")}) as n from manifest_entries)
select n >= 4 and n <= 12 as kept, count(*) as utterances, sum(n)::bigint as words from t group by 1
""")
def q_word_count_range(spark, folder):
    """Kept and skipped utterances and words by word count."""
    n = T.count_words(F.coalesce("text", F.lit("")))
    rows = table(spark, folder, "manifest_entries").select(n.alias("n"))
    return rows.groupBy(((F.col("n") >= 4) & (F.col("n") <= 12)).alias("kept")).agg(F.count(F.lit(1)).alias("utterances"), F.sum("n").cast("bigint").alias("words"))


@query("""
select record_id from generation_records
where cer_gts <= 0.3 and wer_gts <= 30 and not isnan(cer_gts) and not isnan(wer_gts) and length(text) > 20 and length(text) < 120
""")
def q_metric_filters(spark, folder):
    """Error thresholds, and a strict range of sizes."""
    rows = table(spark, folder, "generation_records")
    n = F.length("text")
    return rows.where((F.col("cer_gts") <= 0.3) & (F.col("wer_gts") <= 30) & ~F.isnan("cer_gts") & ~F.isnan("wer_gts") & (n > 20) & (n < 120)).select("record_id")


@query("select doc_id, source from documents where coalesce(source, '') in (select coalesce(source, '') from documents group by 1 having count(*) >= 60)")
def q_min_count_source(spark, folder):
    return O.frequent_only(table(spark, folder, "documents"), "source", 60).select("doc_id", "source")


@query("with s as (select avg(n_chars) as m, stddev_pop(n_chars) as s from documents) select doc_id, n_chars from documents, s where (n_chars - m) / s <= 1.5")
def q_z_outliers(spark, folder):
    return O.without_outliers(table(spark, folder, "documents"), "n_chars", 1.5).select("doc_id", "n_chars")


@query("select doc_id from documents where not coalesce(n_chars < 300, false)")
def q_skip_flag(spark, folder):
    """Rows flagged to be skipped fall away."""
    return O.unskipped(table(spark, folder, "documents").withColumn("_skipme", F.col("n_chars") < 300)).select("doc_id")


@query("select entry_id, entry_id % 16 as shard_id from manifest_entries where entry_id % 16 >= 3 and entry_id % 16 < 7")
def q_select_shards(spark, folder):
    rows = table(spark, folder, "manifest_entries").select("entry_id", (F.col("entry_id") % 16).alias("shard_id"))
    return O.select_shards(rows, "shard_id", "3:7")


@query("select message_id from messages where coalesce(length(role), 0) + coalesce(length(content), 0) <= 200")
def q_drop_long_rows(spark, folder):
    size = F.coalesce(F.length("role"), F.lit(0)) + F.coalesce(F.length("content"), F.lit(0))
    return table(spark, folder, "messages").where(size <= 200).select("message_id")


@query("select message_id from messages where content is null or content = ''")
def q_empty_rows(spark, folder):
    """Identifiers of rows with an empty text."""
    return table(spark, folder, "messages").where(F.coalesce("content", F.lit("")) == "").select("message_id")


@query("""
select item_id from eval_items where (lang = 'en' and not (task = 'qa')) or (lang is distinct from 'en' and task = 'asr') or task = lang
""")
def q_constraint_filter(spark, folder):
    """A filter in the constraint language."""
    rows = table(spark, folder, "eval_items")
    return rows.where(O.constraint(".lang==en and not .task==qa or (.lang!='en' and .task==asr) or .task==.lang", rows.columns)).select("item_id")


@query("""
select count(*) as rows, round(avg(length(text)) filter (where lang = 'en'), 6) as english, round(avg(length(text)) filter (where task = 'asr' or task = 'qa'), 6) as heard,
  round(avg(length(text)) filter (where (lang = 'en') <> (task = 'qa')), 6) as either from eval_items
""")
def q_constraint_routing(spark, folder):
    """Metrics over the rows of their own constraints, in one pass."""
    n = F.length("text")
    out = O.routed(table(spark, folder, "eval_items"), {"english": (n, ".lang==en"), "heard": (n, ".task==asr or .task==qa"), "either": (n, ".lang==en xor .task==qa")})
    return out.select("rows", *[F.round(c, 6).alias(c) for c in ("english", "heard", "either")])


@query("select entry_id from manifest_entries where regexp_matches(text, '[a-z0-9]')")
def q_oov_drop(spark, folder):
    """Sentences that share a character with the vocabulary."""
    return table(spark, folder, "manifest_entries").where(F.col("text").rlike("[a-z0-9]")).select("entry_id")


@query("select entry_id, last_value(text ignore nulls) over (partition by source order by entry_id rows unbounded preceding) as text from manifest_entries")
def q_fallback(spark, folder):
    """A null text gives way to the last text before it in its source."""
    rows = table(spark, folder, "manifest_entries").select("entry_id", "source", "text")
    return O.last_seen(rows, ["source"], ["entry_id"], "text").select("entry_id", "text")


@query("select e.event_id, cast(regexp_extract(e.props, '\"k\": (\\d+)', 1) as bigint) as k from events e")
def q_dotted_path(spark, folder):
    """A nested field by its path."""
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


# Joins.


@query("""
select o.o_orderkey, l.l_linenumber, c.c_name, round(l.l_extendedprice - l.l_discount, 3) as duration, n.n_name
from orders o join lineitem l on l.l_orderkey = o.o_orderkey join customer c on c.c_custkey = o.o_custkey left join nation n on n.n_nationkey = c.c_nationkey and n.n_regionkey = 1
""")
def q_kaldi_inner_left(spark, folder):
    """Inner joins of segments with recordings and texts, left joins of optional tables."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    line = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    c = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, folder, "nation").where("n_regionkey = 1").select("n_nationkey", "n_name")
    out = line.join(o, line.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, n.n_nationkey == c.c_nationkey, "left")
    return out.select("o_orderkey", "l_linenumber", "c_name", F.bround(F.col("l_extendedprice") - F.col("l_discount"), 3).alias("duration"), "n_name")


@query("select s_suppkey, s_name, n_name from supplier join nation on s_nationkey = n_nationkey order by s_suppkey")
def q_inner_sorted(spark, folder):
    s, n = table(spark, folder, "supplier"), table(spark, folder, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", "s_name", "n_name").orderBy("s_suppkey")


@query(r"""
with m as (select entry_id, 'doc' || (entry_id % 1500) || case when entry_id % 3 = 0 then '-sub' || (entry_id % 7) else '' end || '.wav' as path from manifest_entries)
select entry_id, path, doc_id from m join documents on 'doc' || doc_id || '.wav' = regexp_replace(path, '-sub\d+(\.\w+)?$', '\1')
""")
def q_member_join(spark, folder):
    """Manifest rows with the payload of their name; several rows may share one."""
    e = F.col("entry_id")
    m = table(spark, folder, "manifest_entries").select("entry_id", F.concat(F.lit("doc"), (e % 1500).cast("string"), F.when(e % 3 == 0, F.concat(F.lit("-sub"), (e % 7).cast("string"))).otherwise(""), F.lit(".wav")).alias("path"))
    d = table(spark, folder, "documents").select("doc_id", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".wav")).alias("member"))
    return J.with_payload(m, d, "path", "member").select("entry_id", "path", "doc_id")


@query("""
with a as (select distinct lower(trim(source)) as source from manifest_entries), b as (select distinct source from mix_targets)
select source, 'left' as side from a where source is not null and source not in (select source from b) union all select source, 'right' from b where source not in (select source from a where source is not null)
""")
def q_set_equality(spark, folder):
    """Keys that only one of two sets has."""
    a = table(spark, folder, "manifest_entries").select(F.lower(F.trim("source")).alias("source")).where("source is not null")
    return J.set_difference_report(a, table(spark, folder, "mix_targets"), "source")


@query("""
with p as (select context_entry_id as entry_id, max_by(text, record_id) as pred from generation_records where context_entry_id is not null group by 1)
select m.entry_id, coalesce(p.pred, m.text) as text, case when p.entry_id is not null then m.text end as orig_text from manifest_entries m left join p using (entry_id)
""")
def q_pseudo_labels(spark, folder):
    """Rows take the text of their last prediction; the old text is kept beside it."""
    rows = table(spark, folder, "manifest_entries").select("entry_id", "text")
    p = table(spark, folder, "generation_records").where("context_entry_id is not null").select(F.col("context_entry_id").alias("entry_id"), F.col("text").alias("pred_text"), "record_id")
    return J.with_predictions(rows, p, ["entry_id"], "text", "pred_text", ["record_id"])


@query("""
with p as (select context_entry_id as entry_id, sample_idx % 2 as shard, max_by(text, record_id) as pred from generation_records where context_entry_id is not null group by 1, 2)
select m.entry_id, m.shard, coalesce(p.pred, m.text) as text, case when p.entry_id is not null then m.text end as orig_text
from (select entry_id, cast(entry_id % 2 as int) as shard, text from manifest_entries) m left join p using (entry_id, shard)
""")
def q_pseudo_labels_sharded(spark, folder):
    """As q_pseudo_labels, keyed by entry and shard."""
    rows = table(spark, folder, "manifest_entries").select("entry_id", (F.col("entry_id") % 2).cast("int").alias("shard"), "text")
    p = table(spark, folder, "generation_records").where("context_entry_id is not null").select(F.col("context_entry_id").alias("entry_id"), (F.col("sample_idx") % 2).alias("shard"), F.col("text").alias("pred_text"), "record_id")
    return J.with_predictions(rows, p, ["entry_id", "shard"], "text", "pred_text", ["record_id"])


@query("select d.doc_id, d.source, s.n from documents d join (select session_id, count(*) as n from segment group by 1) s on d.session_id = s.session_id")
def q_semi_update(spark, folder):
    """Rows whose key the other side has, with its attributes laid over theirs."""
    s = table(spark, folder, "segment").groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, folder, "documents").join(s, "session_id").select("doc_id", "source", "n")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)")
def q_anti_join(spark, folder):
    c, o = table(spark, folder, "customer"), table(spark, folder, "orders").where("o_totalprice > 300000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("select doc_id from documents where session_id in (select session_id from segment where speaker = 'A')")
def q_semi_join(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "segment").where("speaker = 'A'"), "session_id", "left_semi").select("doc_id")


@query("""
select o.o_orderkey, c.c_custkey, n.n_name, r.r_name, s.sup, p.parts from orders o
left join customer c on c.c_custkey = o.o_custkey left join nation n on n.n_nationkey = c.c_nationkey left join region r on r.r_regionkey = n.n_regionkey
left join (select l_orderkey, min(l_suppkey) as sup from lineitem group by 1) s on s.l_orderkey = o.o_orderkey
left join (select l_orderkey, count(distinct l_partkey) as parts from lineitem group by 1) p on p.l_orderkey = o.o_orderkey
""")
def q_many_left_joins(spark, folder):
    """A row per key with what several lists have on it."""
    o = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, folder, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    line = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("sup"), F.countDistinct("l_partkey").alias("parts"))
    out = o.join(c, "c_custkey", "left").join(n, "n_nationkey", "left").join(table(spark, folder, "region").select("r_regionkey", "r_name"), "r_regionkey", "left").join(line, "o_orderkey", "left")
    return out.select("o_orderkey", "c_custkey", "n_name", "r_name", "sup", "parts")


@query("""
with a as (select request_id, row_number() over (order by request_id) - 1 as ordinal from translate_requests), b as (select item_id, row_number() over (order by item_id) - 1 as ordinal from eval_items)
select ordinal, request_id, item_id from a join b using (ordinal)
""")
def q_zip_rows(spark, folder):
    """Two tables side by side by place; the longer is cut."""
    a, b = table(spark, folder, "translate_requests").select("request_id"), table(spark, folder, "eval_items").select("item_id")
    return J.zip_rows(a, ["request_id"], b, ["item_id"])


@query("""
with b as (select item_id, row_number() over (order by item_id) - 1 as place from eval_items), n as (select count(*) as n from b)
select doc_id, item_id from (select doc_id, cast('0x' || substr(md5(doc_id || ':7'), 1, 8) as bigint) % n as place from documents, n) join b using (place)
""")
def q_side_sample(spark, folder):
    """Each document with an item picked by the hash of its identifier."""
    return J.sample_side(table(spark, folder, "documents").select("doc_id"), "doc_id", table(spark, folder, "eval_items").select("item_id"), ["item_id"], 7)


@query("select e.entry_id, s.snr from manifest_entries e, (values (0), (10), (20)) s(snr)")
def q_noise_product(spark, folder):
    """Every row once per signal-to-noise ratio of a given list."""
    return table(spark, folder, "manifest_entries").select("entry_id", F.explode(F.array(*[F.lit(x) for x in (0, 10, 20)])).alias("snr"))


@query("""
with s as (select segment_id, session_id, speaker, start_time as s, end_time as e from segment where speaker is not null and start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time)
select a.segment_id as a_id, b.segment_id as b_id from s a join s b on a.session_id = b.session_id and a.speaker = 'A' and b.speaker = 'B' and a.s - 0.05 < b.e and b.s < a.e + 0.05
""")
def q_overlap_join(spark, folder):
    """Pairs of one speaker's and another's segments that overlap, to a tolerance."""
    s = table(spark, folder, "segment").where("start_time is not null and end_time > start_time and not isnan(start_time) and not isnan(end_time)")
    s = s.select("segment_id", "session_id", "speaker", F.col("start_time").alias("start"), F.col("end_time").alias("end"))
    out = J.overlapping(s.where("speaker = 'A'").drop("speaker"), s.where("speaker = 'B'").drop("speaker"), ["session_id"], 10.0, 0.05)
    return out.select(F.col("a_segment_id").alias("a_id"), F.col("b_segment_id").alias("b_id"))


@query("""
with s as (select session_id, speaker, cast(trunc(start_time * 10) as bigint) as f, cast(trunc(end_time * 10) as bigint) as t from segment
  where speaker is not null and start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time) and start_time >= 0 and end_time > start_time),
x as (select distinct session_id, speaker, unnest(range(f, t)) as frame from s)
select session_id, frame, count(*) as speakers from x group by 1, 2 having count(*) > 1
""")
def q_frame_mask(spark, folder):
    """Frames of a tenth of a second in which several speakers talk."""
    s = table(spark, folder, "segment").where("speaker is not null and start_time >= 0 and end_time > start_time and not isnan(start_time) and not isnan(end_time)")
    first, last = (F.col("start_time") * 10).cast("bigint"), (F.col("end_time") * 10).cast("bigint")
    frames = s.where(last > first).select("session_id", "speaker", F.explode(F.sequence(first, last - 1)).alias("frame")).distinct()
    return frames.groupBy("session_id", "frame").agg(F.count(F.lit(1)).alias("speakers")).where("speakers > 1")


@query("""
with f as (select session_id, speaker, min(start_time) as first from segment where speaker is not null and start_time is not null and not isnan(start_time) group by 1, 2)
select session_id, speaker, dense_rank() over (partition by session_id order by first, speaker) as place from f
""")
def q_speaker_arrival(spark, folder):
    """Speakers of a session in the order in which they first speak."""
    s = table(spark, folder, "segment").where("speaker is not null and start_time is not null and not isnan(start_time)")
    first = s.groupBy("session_id", "speaker").agg(F.min("start_time").alias("first"))
    return first.select("session_id", "speaker", F.dense_rank().over(Window.partitionBy("session_id").orderBy("first", "speaker")).alias("place"))


@query("""
with q as (select item_id, cast('0x' || substr(md5(item_id || ':' || k || ':3'), 1, 8) as bigint) % (select count(*) from documents) as place, k from eval_items, range(1, 5) t(k)),
d as (select doc_id, row_number() over (order by doc_id) - 1 as place from documents)
select item_id, k::int as k, doc_id from q join d using (place)
""")
def q_random_negatives(spark, folder):
    """Four documents per item, picked by hash."""
    d = with_position(table(spark, folder, "documents").select("doc_id"), ["doc_id"], "at")
    n = table(spark, folder, "documents").count()
    q = table(spark, folder, "eval_items").select("item_id", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("k"))
    return q.withColumn("at", J.bounded_hash(max(1, n), F.col("item_id"), F.col("k"), 3)).join(d, "at").select("item_id", "k", "doc_id")


@query("select request_id, texts[1] as positive, texts[2:4] as negatives from translate_requests where len(texts) >= 1")
def q_first_k_negatives(spark, folder):
    """The first text and up to three more of each request."""
    t = F.col("texts")
    return table(spark, folder, "translate_requests").where(F.size(t) >= 1).select("request_id", F.element_at(t, 1).alias("positive"), F.slice(t, 2, 3).alias("negatives"))


@query("""
with r as (select request_id, texts[1] as q, unnest(texts[2:3]) as p, unnest(range(1, least(2, len(texts) - 1) + 1)) as k from translate_requests where len(texts) >= 2)
select request_id, k::int as k, 'question:' || coalesce(q, '') || ' ' || chr(10) || ' ' || chr(10) || ' passage:' || coalesce(p, '') as text from r
""")
def q_reranker_rows(spark, folder):
    """Question and passage texts, a row per passage."""
    t = F.col("texts")
    rows = table(spark, folder, "translate_requests").where(F.size(t) >= 2).select("request_id", F.element_at(t, 1).alias("q"), F.posexplode(F.slice(t, 2, 2)).alias("k", "p"))
    return rows.select("request_id", (F.col("k") + 1).alias("k"), F.concat(F.lit("question:"), F.coalesce("q", F.lit("")), F.lit(" \n \n passage:"), F.coalesce("p", F.lit(""))).alias("text"))


# Set operations and sorts.


@query("select c_custkey as k from customer union all select s_suppkey from supplier")
def q_union_all(spark, folder):
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("k")).unionByName(table(spark, folder, "supplier").select(F.col("s_suppkey").alias("k")))


@query("select distinct source, lang from manifest_entries")
def q_distinct(spark, folder):
    return table(spark, folder, "manifest_entries").select("source", "lang").distinct()


@query("select min(doc_id) as doc_id, text from documents group by text")
def q_exact_dedup_keep_first(spark, folder):
    """Of equal texts the first; counted before the shuffle."""
    return table(spark, folder, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")


@query("select doc_id from (select doc_id, row_number() over (partition by text order by doc_id) as n from documents) where n > 1")
def q_duplicate_report(spark, folder):
    """Identifiers of later copies. Copies are told by the first identifier of their text."""
    d = table(spark, folder, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit("\0"))).alias("h"))
    first = d.groupBy("h").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return d.join(first, "h").where("doc_id > first").select("doc_id")


@query("select l_partkey as k from lineitem except select p_partkey from part where p_size > 25")
def q_except(spark, folder):
    return table(spark, folder, "lineitem").select(F.col("l_partkey").alias("k")).subtract(table(spark, folder, "part").where("p_size > 25").select(F.col("p_partkey").alias("k")))


@query("select o_custkey as k from orders intersect select c_custkey from customer where c_acctbal > 0")
def q_intersect(spark, folder):
    return table(spark, folder, "orders").select(F.col("o_custkey").alias("k")).intersect(table(spark, folder, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")))


@query("""
with n as (select o_orderkey, 'X' as o_orderstatus, o_totalprice from orders where o_totalprice > 200000)
select o_orderkey, o_orderstatus, o_totalprice from orders where not o_totalprice > 200000 union all select * from n
""")
def q_upsert_keep_last(spark, folder):
    """New rows in place of those of the same key."""
    old = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return J.upsert(old, old.where("o_totalprice > 200000").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"])


@query("select audio_filepath, max_by(entry_id, (ingested_at, entry_id)) as entry_id from manifest_entries group by 1")
def q_last_duplicate_wins(spark, folder):
    """Of rows with the same path the one that came last."""
    return J.last_by_key(table(spark, folder, "manifest_entries").select("audio_filepath", "entry_id", "ingested_at"), ["audio_filepath"], ["ingested_at", "entry_id"]).select("audio_filepath", "entry_id")


@query("select source, count(*) as n, count(distinct audio_filepath) as names from manifest_entries group by 1")
def q_source_cache(spark, folder):
    """Entries and names per source."""
    return table(spark, folder, "manifest_entries").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("audio_filepath").alias("names"))


@query("select doc_id, n_chars, row_number() over (order by n_chars desc, doc_id) - 1 as place from documents")
def q_sort_by_size(spark, folder):
    """Longest first, with the place; sorted over range partitions."""
    return with_position(table(spark, folder, "documents").select("doc_id", "n_chars"), [F.col("n_chars").desc(), F.col("doc_id")], "place")


@query("with s as (select doc_id, row_number() over (order by n_chars desc, doc_id) - 1 as place from documents) select doc_id, place, row_number() over (order by doc_id) - 1 as ordinal from s")
def q_restore_order(spark, folder):
    """The inverse of a sort: each row's place in both orders."""
    return with_position(q_sort_by_size(spark, folder).select("doc_id", "place"), ["doc_id"], "ordinal")


@query("select entry_id, duration from manifest_entries order by entry_id limit 100")
def q_first_n(spark, folder):
    return table(spark, folder, "manifest_entries").select("entry_id", "duration").orderBy("entry_id").limit(100)


@query("select content, count(*) as n from messages where content is not null group by 1 order by n desc, content limit 5")
def q_top_5(spark, folder):
    """The five commonest contents."""
    return table(spark, folder, "messages").where("content is not null").groupBy("content").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "content").limit(5)


@query("select record_id from (select record_id, prompt_id, pred_context_similarity as s, max(pred_context_similarity) over (partition by prompt_id) as m from generation_records where pred_context_similarity is not null and not isnan(pred_context_similarity)) where s > m - 0.1")
def q_beam_pruning(spark, folder):
    """Records of a prompt close to its best."""
    r = table(spark, folder, "generation_records").where("pred_context_similarity is not null and not isnan(pred_context_similarity)")
    best = r.groupBy("prompt_id").agg(F.max("pred_context_similarity").alias("m"))
    return r.join(best, "prompt_id").where(F.col("pred_context_similarity") > F.col("m") - 0.1).select("record_id")


@query("select prompt_id, arg_max(record_id, (s, -record_id)) as record_id from (select *, case when isnan(wer_gts) then null else -wer_gts end as s from generation_records) where s is not null group by 1")
def q_state_pruning(spark, folder):
    """The best record of each prompt, ties to the first."""
    r = table(spark, folder, "generation_records").where("wer_gts is not null and not isnan(wer_gts)")
    return r.groupBy("prompt_id").agg(F.max_by("record_id", F.struct(-F.col("wer_gts"), -F.col("record_id"))).alias("record_id"))


@query("select doc_id, row_number() over (order by md5('42' || doc_id), doc_id) - 1 as place from documents")
def q_shuffle(spark, folder):
    """A shuffle by hash: alike in every run, at every partitioning."""
    return with_position(table(spark, folder, "documents").select("doc_id"), [F.md5(F.concat(F.lit("42"), F.col("doc_id").cast("string"))), F.col("doc_id")], "place")


@query("select event_id, row_number() over (order by user_id, value, event_id) - 1 as place from events")
def q_co_sort(spark, folder):
    """Events in the order of two columns, with the place."""
    return with_position(table(spark, folder, "events").select("event_id", "user_id", "value"), ["user_id", "value", "event_id"], "place").select("event_id", "place")


@query("select doc_id, p // 50 as shard from (select doc_id, row_number() over (order by doc_id) - 1 as p from documents)")
def q_shard_assignment(spark, folder):
    """A new shard every fifty rows."""
    return with_position(table(spark, folder, "documents").select("doc_id"), ["doc_id"], "p").select("doc_id", F.floor(F.col("p") / 50).alias("shard"))
