"""Queries over the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.answers import answered_questions, defective_answers, length_spikes, shortened_texts
from millrace.llm.leaks import leaked_items
from millrace.llm.mixing import mix_entries, without_superseded
from millrace.llm.packing import pack_documents, token_count
from millrace.llm.ranking import Score, borda_ranking
from millrace.llm.repetition import depleted_documents, repeated_share
from millrace.llm.skeleton import lookalike_pairs, with_skeleton
from millrace.llm.splitting import speaker_classes, speakers_together, split_entries
from millrace.plans.tables import table
from millrace.session import stage

SCORES = [Score("cer_gts", False), Score("wer_gts", False), Score("pred_context_similarity", True)]


def p1_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """All generation records in one ranking."""
    return borda_ranking(table(spark, folder, "generation_records"), "record_id", SCORES)


P1_SQL = """
with s as (
  select record_id, case when not isnan(cer_gts) then cer_gts end as a, case when not isnan(wer_gts) then wer_gts end as b,
    case when not isnan(pred_context_similarity) then -pred_context_similarity end as c
  from generation_records),
n as (select count(a) as na, count(b) as nb, count(c) as nc from s),
r as (
  select record_id, a, b, c, na, nb, nc,
    rank() over (order by a nulls last) + (count(*) over (partition by a) - 1) / 2.0 as ra,
    rank() over (order by b nulls last) + (count(*) over (partition by b) - 1) / 2.0 as rb,
    rank() over (order by c nulls last) + (count(*) over (partition by c) - 1) / 2.0 as rc
  from s, n),
p as (
  select record_id, case when a is null then 0.5 else (na - ra) / (na - 1) end as cer_gts_points,
    case when b is null then 0.5 else (nb - rb) / (nb - 1) end as wer_gts_points,
    case when c is null then 0.5 else (nc - rc) / (nc - 1) end as pred_context_similarity_points
  from r),
t as (select *, round(cer_gts_points + wer_gts_points + pred_context_similarity_points, 9) as points from p)
select *, row_number() over (order by points desc, record_id) as rank from t
"""


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Different stored speaker values whose entries must share a split."""
    return speakers_together(table(spark, folder, "manifest_entries"))


def p2_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Every stored speaker value with the class of values that must share a split."""
    return speaker_classes(table(spark, folder, "manifest_entries"))


_SAME = r"""
with recursive v as (select distinct speaker, lower(regexp_replace(speaker, '[^\p{L}\p{N}]', '', 'g')) as k from manifest_entries where speaker is not null),
n as (select distinct lower(regexp_replace(speaker, '[^\p{L}\p{N}]', '', 'g')) as k, regexp_extract(lower(audio_filepath), 'rec([0-9]{8})', 1) as r from manifest_entries where speaker is not null),
link as (select distinct a.k as x, b.k as y from n a join n b on a.r = b.r where a.r <> '' and a.k not in ('', 'unknown') and b.k not in ('', 'unknown')),
reach as (select x, y from link union select reach.x, link.y from reach join link on reach.y = link.x),
same as (select x, y from reach union select k, k from v where k not in ('', 'unknown'))
"""
P2_CLASSES_SQL = f"{_SAME} select a.speaker as speaker, min(b.speaker) as class_id, count(*) as members from same join v a on a.k = same.x join v b on b.k = same.y group by 1"
P2_SQL = f"""{_SAME}
select a.speaker as speaker_a, b.speaker as speaker_b from same join v a on a.k = same.x join v b on b.k = same.y where a.speaker < b.speaker
"""


def p2_split(spark: SparkSession, folder: str) -> DataFrame:
    """Every manifest entry with its component and split."""
    return split_entries(table(spark, folder, "manifest_entries"), table(spark, folder, "split_targets"))


def p2_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares of entries that the splits reach."""
    split = p2_split(spark, folder).groupBy("split_name").agg(F.count(F.lit(1)).alias("entries"), F.countDistinct("root").alias("components"))
    return split.withColumn("actual_share", F.col("entries") / F.sum("entries").over(Window.partitionBy()))  # one row a split


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    entries = table(spark, folder, "manifest_entries").select("entry_id", "audio_filepath", "source", "duration", "ingested_at")
    entries = without_superseded(entries, "entry_id", "audio_filepath", ["ingested_at"], "duration")
    return mix_entries(entries, table(spark, folder, "mix_targets"), "entry_id", "source", "duration", weight="duration")


def p3_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every manifest entry with the number of its copies in the mix; of one delivered again only the last counts."""
    return _mix(spark, folder)[0]


def p3_shares(spark: SparkSession, folder: str) -> DataFrame:
    """What each target source reaches in the mix."""
    return _mix(spark, folder)[1]


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    """Both text fields as field_name, id, pos, text."""
    manifest = table(spark, folder, "manifest_entries").select(F.lit("manifest").alias("field_name"), F.col("entry_id").alias("id"), F.lit(0).cast("bigint").alias("pos"), "text")
    translate = table(spark, folder, "translate_requests").select(F.lit("translate").alias("field_name"), F.col("request_id").alias("id"), F.posexplode("texts").alias("pos", "text"))
    return manifest.unionByName(translate.withColumn("pos", F.col("pos").cast("bigint")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of texts of one field that look the same but are stored in different characters."""
    pairs = lookalike_pairs(_texts(spark, folder), "field_name", "id", "pos", "text")
    return pairs.withColumns({"pos_a": F.col("pos_a").cast("int"), "pos_b": F.col("pos_b").cast("int")})


def p4_one_form(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of both fields in its one form."""
    return with_skeleton(_texts(spark, folder), "text").select("field_name", "id", "pos", "skeleton")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Answers with a defect, by conversation and turn."""
    return defective_answers(table(spark, folder, "messages"), "conv_id", "turn", "role", "content", "lang", ["ingested_at", "message_id"])


def p5_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Defective answers by kind."""
    return p5_found(spark, folder).groupBy("defect").agg(F.count(F.lit(1)).alias("answers"))


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    pairs = answered_questions(table(spark, folder, "messages"), "conv_id", "turn", "role", "content", "lang", ["ingested_at", "message_id"])
    return stage(pairs.select("conv_id", "turn", "answer"), "answers")


def p5_shortened(spark: SparkSession, folder: str) -> DataFrame:
    """Answers without an end that the next answer in sorted order continues."""
    answers = _answers(spark, folder)
    texts = shortened_texts(answers, "answer").select(F.md5("answer").alias("_h"))
    return answers.withColumn("_h", F.md5("answer")).join(texts, "_h", "left_semi").select("conv_id", "turn")


def p5_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Lengths at which answers without an end pile up."""
    return length_spikes(_answers(spark, folder), "answer")


def _packs(spark: SparkSession, folder: str, fit: str = "shortest") -> DataFrame:
    sizes = stage(table(spark, folder, "documents").select("doc_id", token_count("text").alias("tokens")), "tokens")
    capacities = [(r[0], r[1]) for r in table(spark, folder, "pack_sizes").select("pack_name", "capacity_tokens").orderBy("pack_name").collect()]  # a fixed table of 3 rows
    return pack_documents(sizes, "doc_id", "tokens", capacities, fit)


def p7_packs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document, by tokens, in packs of each capacity of pack_sizes."""
    return _packs(spark, folder)


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How well the packs of each capacity are filled."""
    packs = p7_packs(spark, folder).groupBy("pack_name", "pack").agg(F.sum("size").alias("used"), F.count(F.lit(1)).alias("pieces"))
    sizes = table(spark, folder, "pack_sizes").select("pack_name", "capacity_tokens")
    out = packs.groupBy("pack_name").agg(F.count(F.lit(1)).alias("packs"), F.sum("pieces").alias("pieces"), F.sum("used").alias("tokens"))
    return out.join(F.broadcast(sizes), "pack_name").select("pack_name", "packs", "pieces", "tokens", (F.col("tokens") / (F.col("packs") * F.col("capacity_tokens"))).alias("filled"))


def p8_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the evaluation items they hold, also with other numbers, names and units."""
    return leaked_items(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold at least half of an item's very words in one stretch."""
    return p8_leaks(spark, folder).where("2 * equal_words >= item_words").select("doc_id", "item_id")


def p9_share(spark: SparkSession, folder: str) -> DataFrame:
    """The share of repeated content of every document."""
    return repeated_share(table(spark, folder, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents a quarter or more of which repeats what they have said before."""
    return p9_share(spark, folder).where("repeated_share >= 0.25").select("doc_id")


P9_LINES_SQL = r"""
with l as (select doc_id, coalesce(source, '') as host, unnest(string_split(text, chr(10))) as line from documents),
k as (select doc_id, host, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[^\p{L}\p{N}]+', ' ', 'g')) as k from l where regexp_matches(line, '[\p{L}\p{N}]')),
e as (select doc_id, host, k, count(*) as n from k group by all), c as (select host, k from e group by all having count(*) > 5),
s as (select doc_id, sum(n)::bigint as lines, coalesce(sum(n) filter (where c.k is null), 0)::bigint as kept_lines from e left join c on c.host = e.host and c.k = e.k group by 1)
select d.doc_id, coalesce(lines, 0) as lines, coalesce(kept_lines, 0) as kept_lines, coalesce(kept_lines / lines, 0)::double as kept_share, coalesce(lines > 0 and kept_lines / lines < 0.5, false) as depleted from documents d left join s using (doc_id)
"""


def p9_recurring_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the lines that recur over its source's documents."""
    return depleted_documents(table(spark, folder, "documents"), "doc_id", "text", "source")


QUERIES = {
    "p1_ranking": p1_ranking, "p2_found": p2_found, "p2_classes": p2_classes, "p2_split": p2_split, "p2_shares": p2_shares, "p3_mix": p3_mix, "p3_shares": p3_shares,
    "p4_found": p4_found, "p4_one_form": p4_one_form, "p5_found": p5_found, "p5_counts": p5_counts, "p5_shortened": p5_shortened, "p5_limits": p5_limits, "p7_packs": p7_packs, "p7_fill": p7_fill, "p8_found": p8_found, "p8_leaks": p8_leaks,
    "p9_found": p9_found, "p9_share": p9_share, "p9_recurring_lines": p9_recurring_lines,
}
SQL = {"p1_ranking": P1_SQL, "p2_found": P2_SQL, "p2_classes": P2_CLASSES_SQL, "p9_recurring_lines": P9_LINES_SQL}
