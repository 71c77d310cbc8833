"""Queries over runs, sampling, buckets and packs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import buckets as B
from millrace.operators import islands as I
from millrace.operators import sampling as S
from millrace.operators.ordered import carry_last, running_sum, with_position
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


SEG = "(select * from segment where speaker is not null and start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time)"


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "segment").where("speaker is not null and start_time is not null and end_time > start_time and not isnan(start_time) and not isnan(end_time)")


TOK = f"(select item_id, unnest({_words('text')}) as w, generate_subscripts({_words('text')}, 1) as p from eval_items)"


@query(f"""
with t as (select item_id, p, w, case when regexp_matches(w, '^[aeiou]') and p > 1 then 0 else 1 end as s from {TOK}), i as (select *, sum(s) over (partition by item_id order by p) as word from t)
select item_id, word::bigint as word, string_agg(w, '' order by p) as text, min(p)::int as first, max(p)::int as last, round(avg(length(w)), 9) as score from i group by 1, 2
""")
def q_group_words(spark, folder):
    """Tokens joined into words, a new one at each token that starts a word."""
    t = table(spark, folder, "eval_items").select("item_id", F.posexplode(T.split_words("text")).alias("p", "w")).withColumn("p", F.col("p") + 1)
    t = t.withColumn("s", ~F.col("w").rlike("^[aeiou]") | (F.col("p") == 1))
    i = I.island_ids(t, ["item_id"], ["p"], "s", "word")
    g = i.groupBy("item_id", "word").agg(F.array_sort(F.collect_list(F.struct("p", "w"))).alias("x"), F.min("p").alias("first"), F.max("p").alias("last"), F.round(F.avg(F.length("w")), 9).alias("score"))
    return g.select("item_id", "word", F.array_join(F.transform("x", lambda x: x["w"]), "").alias("text"), "first", "last", "score")


@query(f"select item_id, string_agg(w, ' ' order by p) as text, min(p)::int as first, max(p)::int as last from {TOK} group by 1")
def q_group_segment(spark, folder):
    """All tokens of a row as one segment."""
    w = T.split_words("text")
    return table(spark, folder, "eval_items").where(F.size(w) > 0).select("item_id", F.array_join(w, " ").alias("text"), F.lit(1).alias("first"), F.size(w).alias("last"))


@query(f"""
with o as (select *, lag(end_time) over (partition by session_id order by start_time, segment_id) as b from {SEG}), f as (select *, sum(case when b is null or start_time - b >= 1.5 then 1 else 0 end) over (partition by session_id order by start_time, segment_id rows unbounded preceding) as s from o)
select session_id, s::bigint as session, count(*) as n, min(start_time) as start, arg_max(end_time, (start_time, segment_id)) as end from f group by 1, 2
""")
def q_gap_sessions(spark, folder):
    """Segments of a session cut where a gap lies before them."""
    s = I.gap_sessions(_segments(spark, folder), ["session_id"], ["start_time", "segment_id"], "start_time", "end_time", 1.5)
    return s.groupBy("session_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("start_time").alias("start"), F.max_by("end_time", F.struct("start_time", "segment_id")).alias("end"))


@query(rf"""select item_id, list_filter(list_transform(regexp_extract_all(array_to_string({_words('text')}, ' ') || ' ', '(.*?[.?!] |.+ $)', 1), lambda x: trim(x)), lambda x: x <> '') as segments from eval_items""")
def q_segment_offsets(spark, folder):
    """Words gathered into segments ended by a delimiter."""
    return table(spark, folder, "eval_items").select("item_id", I.delimited_segments(T.split_words("text"), ".?!").alias("segments"))


STEPS = f"(select session_id, speaker, list(cast(floor(start_time * 4) as int) order by start_time, segment_id) as t from {SEG} where start_time >= 0 group by 1, 2)"


def _steps(spark: SparkSession, folder: str) -> DataFrame:
    g = _segments(spark, folder).where("start_time >= 0").groupBy("session_id", "speaker").agg(F.array_sort(F.collect_list(F.struct("start_time", "segment_id", "end_time"))).alias("x"))
    return g.withColumn("t", F.transform("x", lambda r: F.floor(r["start_time"] * 4).cast("int")))


@query(f"""
with s as {STEPS}, g as (select session_id, speaker, t, len(t) as n, list_filter(range(1, len(t)), lambda i: t[i + 1] - t[i] - 1 > 20) as g from s)
select session_id, speaker, case when len(g) > 0 then t[g[len(g)]] + 11 end as at from g
""")
def q_eou_rightmost_gap(spark, folder):
    """The end of an utterance by the last long gap between its time steps."""
    return _steps(spark, folder).select("session_id", "speaker", I.end_by_timestamps(F.col("t"), F.element_at("t", -1) + 10, 20).alias("at"))


@query(f"""
with s as (select session_id, speaker, list({{'a': round(start_time, 4), 'b': round(end_time, 4)}} order by start_time, segment_id) as x, max(end_time) as m from {SEG} where start_time >= 0 group by 1, 2),
g as (select *, len(x) as n, list_filter(range(1, len(x)), lambda i: x[i + 1].a - x[i].b > 4) as g from s)
select session_id, speaker, cast(floor((case when len(g) > 0 then x[g[len(g)]].b end + 2) / 0.08) as int) as at from g
""")
def q_eou_vad(spark, folder):
    """The end of an utterance by the last long gap between stretches of speech."""
    x = F.transform("x", lambda r: F.struct(r["start_time"].alias("start"), r["end_time"].alias("end")))
    return _steps(spark, folder).select("session_id", "speaker", I.end_by_speech(x, -1.0, -1e9, 4.0, 0.08).alias("at"))


def q_eou_emissions(spark: SparkSession, folder: str) -> DataFrame:
    """The end of an utterance by a run of blanks before a pivot at three quarters of the text."""
    e = F.transform(F.split("text", ""), lambda c: F.when(c.between("a", "m"), 1).otherwise(0))
    d = table(spark, folder, "documents").select("doc_id", e.alias("e"))
    return d.select("doc_id", I.end_by_emissions(F.col("e"), 0, F.floor(F.size("e") * 3 / 4), 0, 3).alias("at"))


QUERIES["q_eou_emissions"] = q_eou_emissions
# The last run of more than three blanks that lies wholly from the lower end of the search on, or is cut by that end.
SQL["q_eou_emissions"] = """
with d as (select doc_id, list_filter(string_split(text, ''), lambda c: c <> '') as c from documents), e as (select doc_id, len(c) as n, unnest(list_transform(c, lambda x: x >= 'a' and x <= 'm')) as speech, generate_subscripts(c, 1) - 1 as i from d where len(c) > 0),
l as (select *, greatest(floor(n * 3 / 4) - 3, 0) as low from e), b as (select *, sum(speech::int) over (partition by doc_id order by i) as run from l where i >= low),
r as (select doc_id, run, min(i) as first, count(*) as k from b where not speech group by 1, 2 having count(*) > 3), f as (select doc_id, arg_max(first, first) as first from r group by 1)
select doc_id, (first + 1)::int as at from documents left join f using (doc_id)
"""


@query("""
with r as (select conv_id, turn, lower(trim(role)) as role, content from (select conv_id, turn, arg_min(role, message_id) as role, arg_min(content, message_id) as content from messages group by 1, 2)),
b as (select *, case when lag(role) over (partition by conv_id order by turn) is not distinct from role and row_number() over (partition by conv_id order by turn) > 1 then 0 else 1 end as n from r),
i as (select *, sum(n) over (partition by conv_id order by turn) as run from b)
select conv_id, run::bigint as run, any_value(role) as role, string_agg(coalesce(content, ''), ' ' order by turn) as content from i group by 1, 2
""")
def q_collapse_turns(spark, folder):
    """Turns of one role in a row as one turn."""
    r = table(spark, folder, "messages").groupBy("conv_id", "turn").agg(F.min_by(F.struct(F.lower(F.trim("role")).alias("role"), "content"), "message_id").alias("m")).select("conv_id", "turn", "m.*")
    i = I.runs_of_equal(r, ["conv_id"], ["turn"], "role")
    g = i.groupBy("conv_id", "run").agg(F.first("role").alias("role"), F.array_sort(F.collect_list(F.struct("turn", F.coalesce("content", F.lit("")).alias("c")))).alias("x"))
    return g.select("conv_id", "run", "role", F.array_join(F.transform("x", lambda x: x["c"]), " ").alias("content"))


@query("""
with o as (select entry_id, source, case when lag(source) over (order by entry_id) is not distinct from source and row_number() over (order by entry_id) > 1 then 0 else 1 end as n from manifest_entries), i as (select *, sum(n) over (order by entry_id) as run from o)
select run::bigint as run, count(*) as n, min(entry_id) as first from i group by 1
""")
def q_consecutive_groups(spark, folder):
    """Runs of one source in a row over the whole table."""
    i = I.runs_of_equal(table(spark, folder, "manifest_entries").select("entry_id", "source"), [], ["entry_id"], "source")
    return i.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("entry_id").alias("first"))


@query("select event_id, max(value) over w as most, round(sum(value) over w, 4) as total, round(sum(value) over w / row_number() over w, 8) as mean from events window w as (partition by user_id order by event_id rows unbounded preceding)")
def q_running_max(spark, folder):
    """Running sum, mean and maximum per user."""
    from pyspark.sql import Window

    e = table(spark, folder, "events").withColumn("_one", F.lit(1))
    e = running_sum(running_sum(e, ["user_id"], ["event_id"], "value", "s"), ["user_id"], ["event_id"], "_one", "n")
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.select("event_id", F.max("value").over(w).alias("most"), F.round("s", 4).alias("total"), F.round(F.col("s") / F.col("n"), 8).alias("mean"))


@query(f"""
with s as (select segment_id, start_time as a, round(end_time - start_time, 6) as d from {SEG}), n as (select *, greatest(cast(ceil(round((d - 1.5) / 0.75 + 1, 9)) as int), 1) as n from s), x as (select *, unnest(range(0, n)) as i from n)
select segment_id, i::int as i, round(a + i * 0.75, 3) as start, round(least(1.5, d - i * 0.75), 3) as duration from x
""")
def q_subsegments(spark, folder):
    """Sliding windows over segments."""
    s = _segments(spark, folder).select("segment_id", F.col("start_time").alias("a"), F.round(F.col("end_time") - F.col("start_time"), 6).alias("d"))
    n = F.greatest(F.ceil(F.round((F.col("d") - 1.5) / 0.75 + 1, 9)).cast("int"), F.lit(1))
    x = s.select("segment_id", "a", "d", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    return x.select("segment_id", "i", F.round(F.col("a") + F.col("i") * 0.75, 3).alias("start"), F.round(F.least(F.lit(1.5), F.col("d") - F.col("i") * 0.75), 3).alias("duration"))


@query(f"""
with s as (select session_id, speaker, row_number() over (partition by session_id order by start_time, segment_id) as p, end_time, start_time from {SEG}), g as (select *, lag(end_time) over (partition by session_id order by p) as b from s)
select session_id, p::bigint as p, round(start_time - b, 3) as gap from g where start_time - b > 0.5
""")
def q_gap_rows(spark, folder):
    """A row for each silence between neighbouring segments of a session."""
    s = _segments(spark, folder).select("session_id", "start_time", "segment_id", "end_time")
    b = carry_last(s, ["session_id"], ["start_time", "segment_id"], "end_time", "b")
    r = S.ranks_within(b, ["session_id"], ["start_time", "segment_id"], "p")
    return r.where(F.col("start_time") - F.col("b") > 0.5).select("session_id", "p", F.round(F.col("start_time") - F.col("b"), 3).alias("gap"))


def q_resetting_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of a speaker gathered until they are long enough; what is left over is dropped."""
    g = _segments(spark, folder).groupBy("session_id", "speaker").agg(F.array_sort(F.collect_list(F.struct("start_time", "segment_id", "end_time"))).alias("x"))
    d = F.transform("x", lambda r: r["end_time"] - r["start_time"])
    return g.select("session_id", "speaker", F.explode(F.arrays_zip(F.transform("x", lambda r: r["segment_id"]).alias("segment_id"), I.resetting_groups(d, 10.0).alias("part"))).alias("r")).select("session_id", "speaker", "r.segment_id", "r.part").where("part >= 0")


QUERIES["q_resetting_groups"] = q_resetting_groups
SQL["q_resetting_groups"] = f"""
with recursive o as (select session_id, speaker, segment_id, end_time - start_time as d, row_number() over (partition by session_id, speaker order by start_time, segment_id) as p from {SEG}),
f as (select session_id, speaker, segment_id, p, 0 as part, d as total, d >= 10 as full_ from o where p = 1
  union all select o.session_id, o.speaker, o.segment_id, o.p, case when f.full_ then f.part + 1 else f.part end, case when f.full_ then 0 else f.total end + o.d, case when f.full_ then 0 else f.total end + o.d >= 10 from f join o on o.session_id = f.session_id and o.speaker = f.speaker and o.p = f.p + 1),
k as (select session_id, speaker, part from f where full_)
select session_id, speaker, segment_id, part from f join k using (session_id, speaker, part)
"""


def q_equal_mass_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Edges of duration buckets of equal mass."""
    rows = table(spark, folder, "manifest_entries").where("duration > 0 and not isnan(duration)").select(F.round("duration", 3).alias("duration"))
    return spark.createDataFrame(list(enumerate(B.equal_mass_edges(rows, "duration", 8))), "place int, edge double")


QUERIES["q_equal_mass_bins"] = q_equal_mass_bins
# A cut falls on the first row before which, since the last cut, more than the limit stands.
SQL["q_equal_mass_bins"] = """
with recursive r as materialized (select v, row_number() over (order by v) as p, sum(v) over (order by v rows unbounded preceding) - v as lo from (select round(duration, 3) as v from manifest_entries where duration > 0 and not isnan(duration))),
z as materialized (select sum(v) / 8 as limit_ from r),
f as (select -1 as place, null::double as edge, 0.0::double as base union all
  select place + 1, c.v, c.lo from (select place, (select min((p, v, lo)) from r, z where lo - base > limit_) as m from f) q, lateral (select m[1] as p, m[2] as v, m[3] as lo) c where m is not null)
select place::int as place, round(edge, 3) as edge from f where place >= 0
"""


def q_bins_2d(spark: SparkSession, folder: str) -> DataFrame:
    """Within each duration bucket, edges of token buckets of equal mass, outliers left out."""
    rows = table(spark, folder, "manifest_entries").where("duration > 0 and not isnan(duration) and text is not null").select(F.round("duration", 3).alias("duration"), T.count_words("text").alias("tokens"))
    edges = B.equal_mass_edges(rows, "duration", 3) + [float("inf")]
    out, low = [], 0.0
    from millrace.operators.filters import without_outliers

    for edge in edges:  # a few buckets
        inside = without_outliers(rows.where((F.col("duration") > low) & (F.col("duration") <= edge)), "tokens", 3.0)
        out += [(edge, float(t)) for t in B.equal_mass_edges(inside, "tokens", 3)]
        low = edge
    return spark.createDataFrame(out, "seconds double, tokens double")


QUERIES["q_bins_2d"] = q_bins_2d


@query("""
with r as (select record_id, row_number() over (order by record_id) - 1 as p, cer_gts as c, pred_context_similarity as s from generation_records where cer_gts is not null and not isnan(cer_gts)),
g as (select p // 5 as g, arg_min(record_id, (c, record_id)) as chosen, arg_max(record_id, (c, record_id)) as rejected, count(*) as n from r group by 1)
select g::bigint as g, chosen, rejected from g where n = 5
""")
def q_preference_pairs(spark, folder):
    """The best and the worst of every five records in a row."""
    r = table(spark, folder, "generation_records").where("cer_gts is not null and not isnan(cer_gts)").select("record_id", "cer_gts")
    g = with_position(r, ["record_id"], "p").withColumn("g", F.floor(F.col("p") / 5)).groupBy("g")
    k = F.struct("cer_gts", "record_id")
    return g.agg(F.min_by("record_id", k).alias("chosen"), F.max_by("record_id", k).alias("rejected"), F.count(F.lit(1)).alias("n")).where("n = 5").drop("n")


# Sampling and blending.


@query("select doc_id, row_number() over (order by r, lang) - 1 as place from (select doc_id, lang, row_number() over (partition by lang order by doc_id) as r from documents where lang is not null)")
def q_round_robin_lang(spark, folder):
    """One document of each language in turn."""
    return S.round_robin(table(spark, folder, "documents").where("lang is not null").select("doc_id", "lang"), "lang", ["doc_id"]).select("doc_id", "place")


@query("""
with s as (select doc_id, lang, source, row_number() over (partition by lang, source order by doc_id) as s from documents where lang is not null and source is not null), r as (select *, row_number() over (partition by lang order by s, source) as r from s)
select doc_id, row_number() over (order by r, lang) - 1 as place from r
""")
def q_source_round_robin(spark, folder):
    """Languages in turn, and within a language its sources."""
    d = table(spark, folder, "documents").where("lang is not null and source is not null").select("doc_id", "lang", "source")
    return S.nested_round_robin(d, "lang", "source", ["doc_id"]).select("doc_id", "place")


@query("""
with s as (select lang, source, count(*) as size, row_number() over (partition by lang order by source) - 1 as p from documents where lang is not null and source is not null group by 1, 2), n as (select *, count(*) over (partition by lang) as n from s)
select lang, draw::int as draw, source, (draw // n) % size as index, (draw // n) // size as cycle from n, range(0, 60) t(draw) where draw % n = p
""")
def q_balanced_draws(spark, folder):
    """Sixty draws of each language, short sources starting again."""
    s = table(spark, folder, "documents").where("lang is not null and source is not null").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("size"))
    return S.balanced_draws(s, "lang", "source", "size", 60)


@query("""
with b as (select * from (values (0,0,0,5),(1,0,1,5),(2,0,2,5),(3,0,3,5),(4,0,4,5),(5,1,0,3),(6,1,1,3),(7,1,2,3),(8,2,0,2),(9,2,1,2)) b(bin, source, bias, held)), z as (select * from (values (0, 40), (1, 7), (2, 1000)) z(source, size))
select place, source, (bias + (place // 10) * held) % size as sample from range(0, 500) t(place) join b on b.bin = place % 10 join z using (source)
""")
def q_blend_index(spark, folder):
    """Places of a blend by the closed form."""
    return S.blend_by_bins(spark, [0.5, 0.3, 0.2], [40, 7, 1000], 500, 10)


def q_blend_by_deficit(spark: SparkSession, folder: str) -> DataFrame:
    """Places of a blend, each taking the source that lacks most."""
    return S.blend_by_deficit(spark, [0.5, 0.3, 0.2], 500)


QUERIES["q_blend_by_deficit"] = q_blend_by_deficit
SQL["q_blend_by_deficit"] = """
with recursive f as (select 0 as place, 0 as source, 0::bigint as sample, 1::bigint as a, 0::bigint as b, 0::bigint as c
  union all select p, s, case s when 0 then a when 1 then b else c end, a + case when s = 0 then 1 else 0 end, b + case when s = 1 then 1 else 0 end, c + case when s = 2 then 1 else 0 end from (
    select place + 1 as p, a, b, c, case when 0.5::double * (place + 1) - a >= 0.3::double * (place + 1) - b and 0.5::double * (place + 1) - a >= 0.2::double * (place + 1) - c then 0 when 0.3::double * (place + 1) - b >= 0.2::double * (place + 1) - c then 1 else 2 end as s from f where place < 499))
select place::bigint as place, source, sample from f
"""


@query("with s as (select source, count(*) as n from documents where source is not null group by 1), p as (select source, pow(n, 0.5) as p from s) select source, round(p / sum(p) over (), 9) as probability, round(p / sum(p) over () * 5000)::bigint as quota from p")
def q_temperature_quotas(spark, folder):
    """Quotas of sources at a temperature of two."""
    s = table(spark, folder, "documents").where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return S.temperature_quotas(s, "n", 2.0, 5000).select("source", F.round("probability", 9).alias("probability"), "quota")


@query("""
with u as (select id as draw, ('0x' || substr(md5('5:' || id), 1, 12))::bigint / 281474976710656.0::double * (select sum(n_chars) from documents) as u from range(0, 500) t(id)),
w as (select doc_id, sum(n_chars) over (order by doc_id) as hi, n_chars from documents where n_chars > 0)
select draw, doc_id from u join w on u.u >= hi - n_chars and u.u < hi
""")
def q_weighted_draws(spark, folder):
    """Draws with replacement in proportion to size."""
    return S.weighted_draws(table(spark, folder, "documents"), "doc_id", "n_chars", 500, 5)


@query("with r as (select doc_id, row_number() over (order by md5('42' || doc_id), doc_id) - 1 as p from documents), n as (select count(*) as n from documents) select doc_id, case when p < floor(0.8 * n) then 'train' when p < floor(0.8 * n) + floor(0.15 * n) then 'validation' else 'test' end as split from r, n")
def q_split_3way(spark, folder):
    """Splits of exact sizes by hash order."""
    return S.split_exactly(table(spark, folder, "documents").select("doc_id"), "doc_id", [("train", 0.8), ("validation", 0.15), ("test", 0.05)], 42)


@query("with r as (select message_id, row_number() over (order by md5('7' || message_id), message_id) - 1 as p from messages), n as (select count(*) as n from messages) select message_id, case when p < floor(0.1 * n) then 'validation' else 'train' end as split from r, n")
def q_split_val(spark, folder):
    return S.split_exactly(table(spark, folder, "messages").select("message_id"), "message_id", [("validation", 0.1), ("train", 0.9)], 7)


@query("with r as (select doc_id, source, row_number() over (partition by source order by md5('42' || doc_id), doc_id) as r, count(*) over (partition by source) as n from documents) select doc_id, source, case when r <= ceil(0.1 * n) then 'test' else 'train' end as split from r")
def q_stratified_split(spark, folder):
    return S.stratified_split(table(spark, folder, "documents").select("doc_id", "source"), "doc_id", "source", 0.1, 42)


@query("with r as (select doc_id, doc_kind, row_number() over (partition by doc_kind order by md5('1' || doc_id), doc_id) as r, count(*) over (partition by doc_kind) as n from documents), m as (select max(n) as m from r) select doc_id, doc_kind, (m // n + case when r <= m % n then 1 else 0 end)::bigint as copies from r, m")
def q_rebalance(spark, folder):
    """Copies that bring every kind to the size of the largest."""
    return S.rebalance(table(spark, folder, "documents").select("doc_id", "doc_kind"), "doc_id", "doc_kind", 1)


@query("with r as (select doc_id, row_number() over (order by doc_id) - 1 as p, count(*) over () as n from documents) select doc_id, (p - 64) // 32 as step, ((p - 64) % 32 // 8)::int as rank, ((p - 64) % 8)::int as slot from r where p >= 64 and (p - 64) // 32 < (n - 64) // 32")
def q_data_parallel(spark, folder):
    """Steps, ranks and slots of data-parallel batches, some rows being consumed already."""
    return S.data_parallel(table(spark, folder, "documents").select("doc_id"), ["doc_id"], 4, 8, 64)


@query("with r as (select doc_id, row_number() over (order by md5('3' || doc_id), doc_id) - 1 as p, count(*) over () as n from documents) select doc_id, p // 32 as step, (p % 32 // 8)::int as rank, (p % 8)::int as slot from r where p // 32 < n // 32")
def q_data_parallel_shuffled(spark, folder):
    """As q_data_parallel in an epoch's shuffled order."""
    return S.data_parallel(table(spark, folder, "documents").select("doc_id"), S.hash_order("doc_id", 3), 4, 8)


@query("with r as (select doc_id, row_number() over (order by n_chars + ('0x' || substr(md5(doc_id || ':9'), 1, 8))::bigint % 201 - 100, doc_id) - 1 as p from documents) select doc_id, p // 16 as batch from r")
def q_semi_sorted_batches(spark, folder):
    """Batches of rows sorted by size with noise."""
    from millrace.operators.joins import bounded_hash

    d = table(spark, folder, "documents").select("doc_id", (F.col("n_chars") + bounded_hash(201, F.col("doc_id"), 9) - 100).alias("k"))
    return with_position(d, ["k", "doc_id"], "p").select("doc_id", F.floor(F.col("p") / 16).alias("batch"))


@query("with r as (select entry_id, row_number() over (partition by entry_id % 8 order by entry_id) - 1 as p, count(*) over (partition by entry_id % 8) as n, entry_id % 8 as s from manifest_entries), o as (select *, ('0x' || substr(md5(s || ':11'), 1, 8))::bigint % greatest(n - 100, 1) as o from r) select entry_id, s as shard from o where p >= o and p < o + 100")
def q_shard_slices(spark, folder):
    """A slice of a hundred rows in a row of each shard, at a place picked by hash."""
    d = table(spark, folder, "manifest_entries").select("entry_id", (F.col("entry_id") % 8).alias("shard"))
    sizes = d.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    at = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("shard").cast("string"), F.lit("11"))), 1, 8), 16, 10).cast("bigint") % F.greatest(F.col("n") - 100, F.lit(1))
    r = S.ranks_within(d, ["shard"], ["entry_id"], "r").join(F.broadcast(sizes), "shard").withColumn("o", at)
    return r.where((F.col("r") - 1 >= F.col("o")) & (F.col("r") - 1 < F.col("o") + 100)).select("entry_id", "shard")


# Buckets, batches and packs.


@query("select entry_id, case when duration <= 3 then 0 when duration <= 6 then 1 when duration <= 12 then 2 when duration <= 24 then 3 end as bucket from manifest_entries where duration > 0 and not isnan(duration)")
def q_bucket_1d(spark, folder):
    return table(spark, folder, "manifest_entries").where("duration > 0 and not isnan(duration)").select("entry_id", B.bucket_1d(F.col("duration"), [3, 6, 12, 24]).alias("bucket"))


B2 = "(select entry_id, duration as a, len(" + _words("text") + ") as b from manifest_entries where duration > 0 and not isnan(duration) and text is not null)"


@query(f"select entry_id, case when a <= 5 then case when b <= 10 then 0 when b <= 20 then 1 end when a <= 10 then case when b <= 15 then 2 when b <= 30 then 3 end end as bucket from {B2}")
def q_bucket_2d_strict(spark, folder):
    d = table(spark, folder, "manifest_entries").where("duration > 0 and not isnan(duration) and text is not null")
    return d.select("entry_id", B.bucket_2d(F.col("duration"), T.count_words("text"), [(5, 10), (5, 20), (10, 15), (10, 30)]).alias("bucket"))


@query(f"select entry_id, case when a <= 5 and b <= 10 then 0 when a <= 5 and b <= 20 then 1 when a <= 10 and b <= 15 then 2 when a <= 10 and b <= 30 then 3 end as bucket from {B2} where (a <= 5 and b <= 20) or (a <= 10 and b <= 30)")
def q_bucket_2d_lenient(spark, folder):
    """Rows that fit a bucket, with the first that takes both lengths."""
    d = table(spark, folder, "manifest_entries").where("duration > 0 and not isnan(duration) and text is not null")
    return d.select("entry_id", B.bucket_2d(F.col("duration"), T.count_words("text"), [(5, 10), (5, 20), (10, 15), (10, 30)], strict=False).alias("bucket")).where("bucket is not null")


@query("select entry_id, cast(ceil(duration / 0.08) as bigint) as audio, cast(ceil(ceil(duration / 0.08) / 16) * 16 as bigint) as padded from manifest_entries where duration > 0 and not isnan(duration)")
def q_audio_tokens(spark, folder):
    """Seconds as tokens, and up to a multiple of sixteen."""
    n = B.audio_tokens(F.col("duration"), 0.08)
    return table(spark, folder, "manifest_entries").where("duration > 0 and not isnan(duration)").select("entry_id", n.alias("audio"), B.up_to_multiple(n, 16).alias("padded"))


@query(f"""
with m as (select conv_id, turn, arg_min(role, message_id) as role, arg_min(content, message_id) as content from messages group by 1, 2)
select conv_id, sum(case when lower(trim(role)) = 'tool' then ceil(length(coalesce(content, '')) / 8) - 1 else len({_words("coalesce(content, '')")}) end)::bigint as length from m group by 1
""")
def q_turn_lengths(spark, folder):
    """Lengths of conversations whose tool turns count by duration."""
    m = table(spark, folder, "messages").groupBy("conv_id", "turn").agg(F.min_by(F.struct(F.lower(F.trim("role")).alias("role"), F.coalesce("content", F.lit("")).alias("content")), "message_id").alias("m")).select("conv_id", "m.*")
    tool = F.coalesce(F.col("role") == "tool", F.lit(False))
    t = m.select("conv_id", F.struct(F.when(~tool, T.count_words("content")).alias("tokens"), F.when(tool, F.length("content").cast("double")).alias("seconds")).alias("t"))
    return t.groupBy("conv_id").agg(F.collect_list("t").alias("x")).select("conv_id", B.conversation_length(F.col("x"), 8.0).alias("length"))


def q_token_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of documents of a shard under a budget."""
    d = table(spark, folder, "documents").select("doc_id", "n_chars", (F.col("doc_id") % 16).alias("shard"))
    return B.token_batches(d, ["shard"], ["doc_id"], "n_chars", 8000).select("doc_id", "shard", "batch")


QUERIES["q_token_batches"] = q_token_batches
SQL["q_token_batches"] = """
with recursive o as (select doc_id, n_chars as n, doc_id % 16 as shard, row_number() over (partition by doc_id % 16 order by doc_id) as p from documents),
f as (select shard, doc_id, p, n as used, 0 as batch from o where p = 1
  union all select o.shard, o.doc_id, o.p, case when f.used > 0 and f.used + o.n > 8000 then o.n else f.used + o.n end, case when f.used > 0 and f.used + o.n > 8000 then f.batch + 1 else f.batch end from f join o on o.shard = f.shard and o.p = f.p + 1)
select doc_id, shard, batch from f
"""


PACK = 8192


def _lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by words; one with more than a pack holds is an error of the packing."""
    return table(spark, folder, "documents").where("text is not null").select("doc_id", T.count_words("text").alias("n")).where("n > 0")


def q_first_fit_decreasing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in packs of 8,192 words, the longest first, each in the first pack with room."""
    d = _lengths(spark, folder)
    return B.packed(d, ["doc_id"], "n", B.PACKERS["first_fit_decreasing"](B.histogram(d, "n"), PACK)).select("doc_id", "n", "pack", "slot")


def q_greedy_knapsack(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in packs of 8,192 words, each pack filled with the largest that fits."""
    d = _lengths(spark, folder)
    return B.packed(d, ["doc_id"], "n", B.PACKERS["greedy_knapsack"](B.histogram(d, "n"), PACK)).select("doc_id", "n", "pack", "slot")


def q_pack_report(spark: SparkSession, folder: str) -> DataFrame:
    """How well first-fit-decreasing packs are filled."""
    r = B.pack_report(B.first_fit_decreasing(B.histogram(_lengths(spark, folder), "n"), PACK), PACK)
    return spark.createDataFrame([(r["packs"], r["most_items"], r["factor"], r["percent"])], "packs long, most_items long, factor double, percent double")


def q_fill_packs(spark: SparkSession, folder: str) -> DataFrame:
    """Packs with their tokens, masks and starts."""
    ids = F.transform(T.split_words("text"), lambda w: F.length(w))
    d = table(spark, folder, "documents").where("text is not null").select("doc_id", ids.alias("ids")).withColumn("n", F.size("ids")).where("n > 0")
    packs = B.packed(d, ["doc_id"], "n", B.first_fit_decreasing(B.histogram(d, "n"), PACK))
    return B.filled_packs(packs, "ids")


_ITEMS = f"select doc_id, {_words('text')} as w, len({_words('text')}) as n from documents where text is not null and len({_words('text')}) > 0"
# Item by item, the longest first: the room of each pack is carried along.
FIRST_FIT = f"""
with recursive o as materialized (select doc_id as d, w, n, row_number() over (order by n desc, doc_id) as k from ({_ITEMS})),
f as (select 0::bigint as i, []::bigint[] as room, null::bigint as doc_id, 0::bigint as n, null::bigint as pack union all
  select k, case when p > len(room) then list_append(room, {PACK} - m) else list_transform(room, lambda r, j: case when j = p then r - m else r end) end, d, m, p - 1
  from (select room, k, o.n as m, d, coalesce(list_position(list_transform(room, lambda r: r >= o.n), true), len(room) + 1) as p from f join o on k = i + 1)),
a as (select doc_id, n, pack, row_number() over (partition by pack order by i) - 1 as slot from f where i > 0)
"""
QUERIES |= {"q_first_fit_decreasing": q_first_fit_decreasing, "q_greedy_knapsack": q_greedy_knapsack, "q_pack_report": q_pack_report, "q_fill_packs": q_fill_packs}
SQL |= {
    "q_first_fit_decreasing": f"{FIRST_FIT} select doc_id, n::int as n, pack, slot::int as slot from a",
    "q_pack_report": f"{FIRST_FIT}, p as (select pack, count(*) as items, sum(n) as used from a group by 1) select count(*) as packs, max(items) as most_items, round(sum(items) / count(*), 2) as factor, round(sum(used) / (count(*) * {PACK}) * 100, 2) as percent from p",
    "q_greedy_knapsack": f"""
with recursive o as materialized (select list(doc_id order by n desc, doc_id) as ds, list(n order by n desc, doc_id) as ns from ({_ITEMS})),
f as (select ds, ns, {PACK}::bigint as room, 0::bigint as pack, -1::bigint as slot, null::bigint as doc_id, null::bigint as n from o union all
  select case when x is null then ds else list_concat(ds[: x - 1], ds[x + 1 :]) end, case when x is null then ns else list_concat(ns[: x - 1], ns[x + 1 :]) end, case when x is null then {PACK} else room - ns[x] end,
    case when x is null then pack + 1 else pack end, case when x is null then -1 else slot + 1 end, case when x is not null then ds[x] end, case when x is not null then ns[x] end
  from (select *, list_position(list_transform(ns, lambda v: v <= room), true) as x from f where len(ns) > 0))
select doc_id, n::int as n, pack, slot::int as slot from f where doc_id is not null
""",
    "q_fill_packs": f"""{FIRST_FIT}, t as (select pack, slot, list_transform(o.w, lambda x: length(x)) as ids from a join o on o.d = a.doc_id),
g as (select pack, flatten(list(ids order by slot)) as input_ids, list(len(ids) order by slot) as z, flatten(list(list_transform(range(0, len(ids)), lambda i: i::int) order by slot)) as position_ids from t group by 1),
c as (select *, list_transform(range(0, len(z) + 1), lambda i: coalesce(list_sum(z[: i]), 0)::int) as cu from g)
select pack, input_ids, list_transform(input_ids, lambda x: true) as loss_mask, position_ids, cu[: len(cu) - 1] as seq_start_id, cu as cu_seqlens from c
""",
}


@query("""
with d as (select doc_id, n_chars as n, row_number() over (order by doc_id) - 1 as doc_place, sum(n_chars) over (order by doc_id) as hi from documents where n_chars > 0),
s as (select s as sample from range(0, (select cast((max(hi) - 1) // 512 as bigint) from d) + 1) t(s))
select sample, doc_place, (sample * 512 - (hi - n))::bigint as offset from s join d on sample * 512 >= hi - n and sample * 512 < hi
""")
def q_lm_sample_idx(spark, folder):
    """Where each sample of 512 tokens begins in all documents in a row."""
    return B.sample_starts(table(spark, folder, "documents"), ["doc_id"], "n_chars", 512)


def q_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of sentences of about sixty words."""
    sizes = F.transform(T.split_sentences("text"), lambda s: F.size(F.split(s, " ")))
    d = table(spark, folder, "documents").select("doc_id", B.sentence_spans(sizes, 60).alias("x"))
    return d.select("doc_id", F.posexplode("x").alias("block", "s")).select("doc_id", "block", "s.start", "s.end")


def q_block_spans(spark: SparkSession, folder: str) -> DataFrame:
    """As q_sentence_spans, two sentences at least being left after each span."""
    sizes = F.transform(T.split_sentences("text"), lambda s: F.size(F.split(s, " ")))
    d = table(spark, folder, "documents").select("doc_id", B.sentence_spans(sizes, 60, one_left=False).alias("x"))
    return d.select("doc_id", F.posexplode("x").alias("block", "s")).select("doc_id", "block", "s.start", "s.end")


QUERIES |= {"q_sentence_spans": q_sentence_spans, "q_block_spans": q_block_spans}


def _spans_sql(enough: str) -> str:
    """Sentence by sentence: where the open span began, its words so far, and the span that closed, if one did."""
    from millrace.plans.texts import SQL as TEXTS

    return f"""
with recursive t as (select doc_id, list_transform(value, lambda s: len(string_split(s, ' '))) as z from ({TEXTS["q_sentence_split"]}) where value is not null),
s as materialized (select doc_id, z, len(z) as n from t where len(z) >= 2 and list_max(z) <= 512),
f as (select doc_id, z, n, 0 as i, 0 as began, 0::bigint as total, -1 as block, null::int as start, null::int as end_ from s union all
  select doc_id, z, n, i + 1, case when c then i + 1 else began end, case when c then 0 else total + z[i + 1] end, case when c then block + 1 else block end, case when c then began end, case when c then i + 1 end
  from (select *, (total + z[i + 1] >= 60 and {enough} and i + 1 - began >= 2) or i + 1 = n as c from f where i < n))
select doc_id, block::int as block, start, end_ as "end" from f where start is not null
"""


SQL |= {"q_sentence_spans": _spans_sql("n - i - 1 > 1"), "q_block_spans": _spans_sql("n - i - 1 >= 2")}


@query(f"""
with t as (select item_id, unnest(list_transform({_words('text')}, lambda w: length(w))) as v, generate_subscripts({_words('text')}, 1) as p from eval_items), o as (select v, row_number() over (order by item_id, p) - 1 as i from t), g as (select i // 64 as pack, list(v order by i) as tokens from o group by 1)
select pack, list_resize(tokens, 64, 0) as tokens, len(tokens)::int as used from g
""")
def q_sequential_packs(spark, folder):
    """Tokens of all items end to end in packs of 64."""
    d = table(spark, folder, "eval_items").select("item_id", F.transform(T.split_words("text"), lambda w: F.length(w)).alias("ids"))
    return B.sequential_packs(d, ["item_id"], "ids", 64)


@query(f"with t as (select item_id, list_transform({_words('text')}, lambda w: length(w)) as v from eval_items), m as (select item_id % 10 as b, max(len(v)) as m from t group by 1) select item_id, list_resize(v, m, 0) as ids, list_transform(range(1, m + 1), lambda i: i <= len(v)) as mask from t join m on m.b = item_id % 10")
def q_padded_batches(spark, folder):
    """Arrays padded to their batch's longest, with masks."""
    d = table(spark, folder, "eval_items").select("item_id", (F.col("item_id") % 10).alias("b"), F.transform(T.split_words("text"), lambda w: F.length(w)).alias("v"))
    m = d.groupBy("b").agg(F.max(F.size("v")).alias("m"))
    mask = F.transform(F.sequence(F.lit(1), F.col("m")), lambda i: i <= F.size("v"))
    return d.join(m, "b").select("item_id", B.padded(F.col("v"), F.col("m")).alias("ids"), mask.alias("mask"))


@query(f"""
with g as (select session_id, speaker, list(words order by start_time, segment_id) as w, sum(end_time - start_time) as s, count(*) as n, 1 as f from {SEG} group by 1, 2)
select session_id, speaker, array_to_string(list_transform(w, lambda x: coalesce(x, '')), '|') as text, round(s + (n - 1) * 0.3, 4) as seconds from g where n > 1 and s + (n - 1) * 0.3 <= 60 and length(w[1]) % 2 = 0
""")
def q_merged_utterances(spark, folder):
    """A speaker's segments merged where they fit a minute; an even first length stands for a finished text."""
    s = _segments(spark, folder).withColumn("t", F.concat(F.coalesce("words", F.lit("")), F.when(F.length("words") % 2 == 0, ".").otherwise("")))
    m = B.merged_utterances(s.withColumn("d", F.col("end_time") - F.col("start_time")), ["session_id", "speaker"], ["start_time", "segment_id"], "d", "t", 60.0, 0.3)
    return m.select("session_id", "speaker", F.regexp_replace("text", r"\.(?=\||$)", "").alias("text"), F.round("seconds", 4).alias("seconds"))


def q_merge_buffer(spark: SparkSession, folder: str) -> DataFrame:
    """Segments of a session merged in order, up to four and under twenty seconds."""
    s = _segments(spark, folder).withColumn("d", F.col("end_time") - F.col("start_time")).select("session_id", "start_time", "segment_id", "d", "words")
    run = B.merge_stream(["session_id"], ["start_time", "segment_id"], "d", "words", 20.0, 4)
    return s.groupBy("session_id").applyInPandas(run, "session_id string, merged int, parts int, seconds double, text string").select("session_id", "merged", "parts", F.round("seconds", 6).alias("seconds"))


QUERIES["q_merge_buffer"] = q_merge_buffer
SQL["q_merge_buffer"] = f"""
with recursive o as materialized (select session_id as k, list(end_time - start_time order by start_time, segment_id) as d from {SEG} group by 1),
f as (select k, d, 0 as i, 0 as merged, 0 as parts, 0.0::double as used, null::int as done, null::int as n, null::double as seconds from o union all
  select k, d, i + 1, case when c then merged + 1 else merged end, case when c then 1 else parts + 1 end, case when c then 0 else used end + coalesce(d[i + 1], 0), case when c then merged end, case when c then parts end, case when c then used end
  from (select *, parts > 0 and (i >= len(d) or parts >= 4 or used + d[i + 1] > 20) as c from f where i < len(d) or (i = len(d) and parts > 0)))
select k as session_id, done as merged, n as parts, round(seconds, 6) as seconds from f where done is not null
"""


@query("select request_id, unnest(string_split(array_to_string(list_transform(texts, lambda x: replace(coalesce(x, ''), '|', '')), '|'), '|')) as part, generate_subscripts(texts, 1)::int - 1 as place from translate_requests where len(texts) > 0")
def q_merged_manifest(spark, folder):
    """Texts joined by a bar, taken apart again in order."""
    joined = F.array_join(F.transform("texts", lambda x: F.replace(F.coalesce(x, F.lit("")), F.lit("|"), F.lit(""))), "|")
    return table(spark, folder, "translate_requests").where(F.size("texts") > 0).select("request_id", F.posexplode(F.split(joined, r"\|")).alias("place", "part"))


# State of streams, as array functions.


@query(f"""
with s as {STEPS}, x as (select session_id, speaker, list_transform(t[1 : (len(t) + 1) // 2], lambda v: v - 3) as a, t[len(t) // 2 + 1 : len(t)] as b from s),
u as (select session_id, speaker, case when a[1] < 0 then list_transform(a, lambda v: v - a[1]) else a end as a, b from x)
select session_id, speaker, list_concat(a, case when b[1] - a[len(a)] <= 0 then list_transform(b, lambda v: v + abs(b[1] - a[len(a)]) + 1) else b end) as steps from u
""")
def q_merge_timesteps(spark, folder):
    """Time steps of two buffers, the halves of a speaker's steps (the middle one in both), as one rising array."""
    s = _steps(spark, folder)
    half = F.floor((F.size("t") + 1) / 2).cast("int")
    a, b = F.transform(F.slice("t", F.lit(1), half), lambda v: v - 3), F.slice("t", F.size("t") - half + 1, half)
    return s.select("session_id", "speaker", I.merged_steps(a, b).alias("steps"))


@query(f"""
with s as (select doc_id, list_transform({_words('text')}, lambda w: length(w)) as v from documents where text is not null), x as (select doc_id, v[1 : len(v) * 2 // 3] as a, v[len(v) // 3 + 1 : len(v)] as b from s)
select doc_id, coalesce(list_max(list_filter(range(1, 1 + least(8, len(a), len(b))), lambda k: a[len(a) - k + 1 : len(a)] = b[1 : k])), 0)::int as overlap from x
""")
def q_overlap_length(spark, folder):
    """The longest end, up to eight places, of a document's first two thirds with which its last two thirds begin."""
    s = table(spark, folder, "documents").where("text is not null").select("doc_id", F.transform(T.split_words("text"), lambda w: F.length(w)).alias("v"))
    a, b = F.slice("v", F.lit(1), F.floor(F.size("v") * 2 / 3).cast("int")), F.slice("v", F.floor(F.size("v") / 3).cast("int") + 1, F.size("v"))
    return s.select("doc_id", I.overlap_length(a, b, 8).alias("overlap"))


@query(f"""
with s as (select item_id, list_transform({_words('text')}, lambda w: length(w) % 3) as v from eval_items)
select item_id, list_filter(list_transform(list_filter(range(1, len(v) + 1), lambda i: i = 1 or v[i] <> v[i - 1]), lambda i: v[i]), lambda x: x <> 0) as labels from s
""")
def q_collapse_repeats(spark, folder):
    """Labels without blanks and with repeats taken once."""
    s = table(spark, folder, "eval_items").select("item_id", F.transform(T.split_words("text"), lambda w: F.length(w) % 3).alias("v"))
    return s.select("item_id", I.collapse_repeats(F.col("v"), 0).alias("labels"))


def q_clamped_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Offsets of two chunks in a row, the halves of a speaker's steps, each start held to the end before."""
    s = _steps(spark, folder).select("session_id", "speaker", "t")
    half = F.concat(F.array_repeat(F.lit(0), F.ceil(F.size("t") / 2).cast("int")), F.array_repeat(F.lit(1), F.floor(F.size("t") / 2).cast("int")))
    out = I.clamped_offsets(F.col("t"), F.transform("t", lambda x: x + 2), half, [0, 32], 8)
    return s.select("session_id", "speaker", out.alias("offsets"))


QUERIES["q_clamped_offsets"] = q_clamped_offsets
SQL["q_clamped_offsets"] = f"""
with s as {STEPS}, x as (select session_id, speaker, t, list_transform(range(1, len(t) + 1), lambda i: t[i] + case when i > ceil(len(t) / 2) then 4 else 0 end) as a from s)
select session_id, speaker, list_transform(range(1, len(a) + 1), lambda i: {{'s': case when i > 1 then greatest(a[i], a[i - 1] + 2) else a[i] end, 'e': a[i] + 2}}) as offsets from x
"""
