"""Queries that write tables in a format and read them back through the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.joins import with_payload
from millrace.plans.tables import table
from millrace.plans.texts import _words
from millrace.session import fresh_path
from millrace.sources import manifest as M
from millrace.sources import tables as S
from millrace.sources.tar import assign_shards, read_tar, write_tar

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _folder(spark: SparkSession) -> str:
    return fresh_path(spark, "files")


@query("select row_number() over (order by entry_id) - 1 as id, audio_filepath as audio_file, coalesce(text, '') as text, coalesce(duration, 0) as duration, lang from manifest_entries where not coalesce(isnan(duration), false)")
def q_manifest_scan(spark, folder):
    """The manifest as lines, scanned with ordinals and resolved aliases."""
    rows = table(spark, folder, "manifest_entries").where(~F.coalesce(F.isnan("duration"), F.lit(False))).select("entry_id", "audio_filepath", "text", F.coalesce("duration", F.lit(0.0)).alias("duration"), "lang")
    out = _folder(spark)
    M.write_manifest(rows.orderBy("entry_id").drop("entry_id"), out)
    return M.canonical(M.scan_lines(spark, out)).select("id", "audio_file", "text", "duration", "lang")


@query("select message_id, content from messages where content <> ''")
def q_bad_records(spark, folder):
    """Lines of which some aren't JSON; the others are read."""
    m = table(spark, folder, "messages").select("message_id", "content")
    line = F.when(F.coalesce("content", F.lit("")) == "", F.concat(F.lit("{broken "), F.col("message_id").cast("string"))).otherwise(F.to_json(F.struct("message_id", "content"), {"ignoreNullFields": "false"}))
    out = _folder(spark)
    m.select(line.alias("value")).write.text(out)
    return S.parsed(spark, out, "message_id bigint, content string", "drop").select("message_id", "content")


@query("select entry_id, case when length(p) < 255 and p[1:1] <> '/' then '/data/set/' || p else p end as path from (select entry_id, audio_filepath as p from manifest_entries)")
def q_full_paths(spark, folder):
    """Relative paths against the manifest's folder."""
    return table(spark, folder, "manifest_entries").select("entry_id", M.full_path("audio_filepath", F.lit("/data/set/manifest.json")).alias("path"))


@query("""
select segment_id, session_id || '.wav' || case when start_time > 0 then format('-{:06d}-{:06d}', cast(round_even(start_time * 100, 0) as bigint), cast(round_even(d * 100, 0) as bigint)) else '' end as cut_id
from (select *, end_time - start_time as d from segment where start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time) where coalesce(words, '') <> ''
""")
def q_cut_ids(spark, folder):
    """Identifiers of cuts by path, offset and duration; rows to be skipped fall away."""
    s = table(spark, folder, "segment").where("start_time is not null and end_time > start_time and not isnan(start_time) and not isnan(end_time)")
    rows = s.select("segment_id", F.concat("session_id", F.lit(".wav")).alias("audio_filepath"), F.col("start_time").alias("offset"), (F.col("end_time") - F.col("start_time")).alias("duration"), (F.coalesce("words", F.lit("")) == "").alias("_skipme"))
    return M.cuts(rows).select("segment_id", "cut_id")


@query("select item_id::varchar as item_id, coalesce(text, '') as text, coalesce(lang, '') as lang from eval_items")
def q_read_jsonl(spark, folder):
    """A file of objects with all columns as text."""
    out = _folder(spark) + ".jsonl"
    table(spark, folder, "eval_items").select("item_id", "text", "lang").write.json(out)
    return S.read_table(spark, out).select("item_id", "text", "lang")


@query("select o_orderkey::varchar as o_orderkey, o_orderstatus, o_orderpriority from (select o_orderkey, o_orderstatus, coalesce(o_orderstatus, '') as o_orderpriority from orders)")
def q_read_csv(spark, folder):
    """Comma- and tab-separated files with all columns as text."""
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.coalesce("o_orderstatus", F.lit("")).alias("o_orderpriority"))
    a, b = _folder(spark) + ".csv", _folder(spark) + ".tsv"
    rows.where("o_orderstatus = 'F'").write.option("header", "true").csv(a)
    rows.where("o_orderstatus <> 'F'").write.option("header", "true").option("sep", "\t").csv(b)
    return S.read_table(spark, a).unionByName(S.read_table(spark, b))


@query("select p as ordinal, a.text as source, b.name as target from (select row_number() over (order by item_id) - 1 as p, text from eval_items) a join (select row_number() over (order by n_nationkey) - 1 as p, n_name as name from nation) b using (p)")
def q_text_pairs(spark, folder):
    """Lines of two files side by side."""
    a, b = _folder(spark), _folder(spark)
    table(spark, folder, "eval_items").orderBy("item_id").select("text").write.text(a)
    table(spark, folder, "nation").orderBy("n_nationkey").select("n_name").write.text(b)
    return S.read_text_pairs(spark, a, b)


@query("""
select conv_id::varchar as id, count(*) + 1 as turns, 'system' as first, sum(length(coalesce(c, ''))) as chars from (select conv_id, turn, arg_min_null(content, message_id) as c from messages group by 1, 2) group by 1 having count(*) <= 6
""")
def q_conversations_jsonl(spark, folder):
    """Conversations as lines, read with a system turn first; those marked fall away."""
    m = table(spark, folder, "messages").groupBy("conv_id", "turn").agg(F.min_by("content", "message_id").alias("value"))
    t = F.array_sort(F.collect_list(F.struct("turn", "value")))
    rows = m.groupBy("conv_id").agg(t.alias("x")).select(
        F.col("conv_id").cast("string").alias("id"), F.transform("x", lambda r: F.struct(F.lit("User").alias("from"), F.coalesce(r["value"], F.lit("")).alias("value"))).alias("conversations"),
        F.create_map(F.lit("_skipme"), F.when(F.size("x") > 6, "true").otherwise("false")).alias("custom"),
    )
    out = _folder(spark)
    rows.write.json(out)
    c = S.read_conversations(spark, out, "Answer briefly.")
    chars = F.aggregate(F.slice("turns", F.lit(2), F.size("turns")), F.lit(0).cast("bigint"), lambda n, x: n + F.length(x["value"]))
    return c.select("id", F.size("turns").cast("bigint").alias("turns"), F.element_at("turns", 1)["role"].alias("first"), chars.alias("chars"))


@query("""
select 'u' || segment_id as label, '/wav/' || session_id || '.wav' as path, round(start_time, 3) as offset, round_even(round(end_time, 3) - round(start_time, 3), 3) as duration, words as text, case when speaker < 'C' then speaker end as speaker
from segment where speaker is not null and start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time and words is not null and words <> ''
""")
def q_kaldi_folder(spark, folder):
    """Recordings, segments, texts and speakers from a folder of word lists."""
    s = table(spark, folder, "segment").where("speaker is not null and start_time is not null and end_time > start_time and not isnan(start_time) and not isnan(end_time) and words <> ''")
    out = _folder(spark)
    label = F.concat(F.lit("u"), F.col("segment_id").cast("string"))
    s.select(F.concat_ws(" ", label, "session_id", F.round("start_time", 3).cast("string"), F.round("end_time", 3).cast("string"))).write.text(f"{out}/segments")
    s.select("session_id").distinct().select(F.concat(F.col("session_id"), F.lit(" /wav/"), F.col("session_id"), F.lit(".wav"))).write.text(f"{out}/wav.scp")
    s.select(F.concat_ws(" ", label, "words")).write.text(f"{out}/text")
    s.where("speaker < 'C'").select(F.concat_ws(" ", label, "speaker")).write.text(f"{out}/utt2spk")
    return S.read_kaldi(spark, out)


@query("select session_id, speaker, start_time as start, end_time as end, round(end_time - start_time, 6) as duration from segment where start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time)")
def q_seglst(spark, folder):
    """Segments of all sessions, from JSON arrays of whole sessions."""
    s = table(spark, folder, "segment").where("start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time)")
    out = _folder(spark)
    row = F.struct("session_id", "speaker", F.col("start_time").cast("string").alias("start_time"), F.col("end_time").cast("string").alias("end_time"), "words")
    files = s.count() // 20_000 + 1  # a file holds one array, of about so many rows
    s.groupBy(F.pmod(F.xxhash64("session_id"), F.lit(files)).alias("part")).agg(F.to_json(F.collect_list(row)).alias("value")).write.partitionBy("part").text(out)
    return S.read_seglst(spark, out).select("session_id", "speaker", "start", "end", F.round("duration", 6).alias("duration"))


@query(f"with x as (select session_id, list_sort({_words('words')}) as w, segment_id from segment where words is not null) select count(*) as n, sum(len(w))::bigint as words from x where len(w) > 0")
def q_lm_text(spark, folder):
    """Texts for a language model, none empty."""
    out = _folder(spark)
    table(spark, folder, "segment").select(F.col("words").alias("value")).where("value is not null").write.text(out)
    t = S.read_lm_text(spark, out)
    return t.agg(F.count(F.lit(1)).alias("n"), F.sum(T.count_words("text")).cast("bigint").alias("words"))


@query("select row_number() over (order by session_id, start_time, segment_id) - 1 as ordinal, format('{} 1 {:.3f} {:.3f} {} NA', session_id, start_time, end_time - start_time, speaker) as line from segment where speaker is not null and start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time")
def q_ctm_lines(spark, folder):
    """Segments as lines of the NIST format, in order."""
    s = table(spark, folder, "segment").where("speaker is not null and start_time is not null and end_time > start_time and not isnan(start_time) and not isnan(end_time)")
    out = _folder(spark)
    line = S.ctm_line(F.col("session_id"), "1", F.col("start_time"), F.col("end_time") - F.col("start_time"), F.col("speaker"))
    S.write_lines(s, line, ["session_id", "start_time", "segment_id"], out)
    return M.scan_lines(spark, out).select("ordinal", "line")


@query("with d as (select item_id, text, (row_number() over (order by item_id) - 1) // 64 as shard from eval_items) select item_id, 'audio_' || shard || '.tar' as shard, octet_length(encode(text)) as size, md5(text) as digest from d")
def q_tar_shards(spark, folder):
    """Texts written as members of tar shards and met again by their names."""
    d = assign_shards(table(spark, folder, "eval_items").select("item_id", "text"), ["item_id"], 64)
    d = d.withColumn("member", F.concat(F.lit("t"), F.col("item_id").cast("string"), F.lit(".txt")))
    out = _folder(spark)
    write_tar(d, "shard", "index", "member", "text", out).collect()
    t = read_tar(spark, f"{out}/*.tar").select(F.col("shard").alias("file"), F.col("member").alias("name"), "size", F.md5("payload").alias("digest"))
    return with_payload(d.select("item_id", "member"), t, "member", "name", strict=True).select("item_id", F.col("file").alias("shard"), "size", "digest")


@query("with d as (select item_id, (row_number() over (order by item_id) - 1) // 64 as shard from eval_items) select 'audio_2.tar' as shard, 't' || item_id || '.txt' as member from d where shard = 2")
def q_tar_pruned(spark, folder):
    """One shard's members without their payload; other shards aren't opened."""
    d = assign_shards(table(spark, folder, "eval_items").select("item_id", "text"), ["item_id"], 64)
    out = _folder(spark)
    write_tar(d.withColumn("member", F.concat(F.lit("t"), F.col("item_id").cast("string"), F.lit(".txt"))), "shard", "index", "member", "text", out).collect()
    return read_tar(spark, f"{out}/*.tar", payload=False).where("shard = 'audio_2.tar'").select("shard", "member")
