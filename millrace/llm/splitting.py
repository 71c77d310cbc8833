"""Splits of manifest entries that keep one speaker's and one recording's entries together (problem 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components, split_plan
from millrace.operators.joins import hot_keys, join_skewed
from millrace.session import stage

NOBODY = ["", "unknown"]


def speaker_key(speaker: str) -> Column:
    """Letter case, blanks and punctuation carry no meaning; null for a value that names nobody."""
    key = F.lower(F.regexp_replace(F.col(speaker), r"[^\p{L}\p{N}]", ""))
    return F.when(~key.isin(NOBODY), key)


def recording_key(path: str) -> Column:
    """The digits of the recording code in the path, or null."""
    digits = F.regexp_extract(F.col(path), r"(?i)rec([0-9]{8})", 1)
    return F.when(digits != "", digits)


def _pairs(entries: DataFrame) -> DataFrame:
    """Distinct (speaker, recording) keys with their entries' number."""
    keys = entries.select(speaker_key("speaker").alias("s"), recording_key("audio_filepath").alias("r"))
    return keys.groupBy("s", "r").agg(F.count(F.lit(1)).alias("n"))


def _roots(pairs: DataFrame) -> DataFrame:
    return components(pairs.select(F.concat(F.lit("s:"), "s").alias("a"), F.concat(F.lit("r:"), "r").alias("b")), "a", "b")


def _named(entries: DataFrame) -> DataFrame:
    """Every stored speaker value that names somebody, with its component's root."""
    values = entries.where("speaker is not null").groupBy("speaker").agg(F.lit(1).alias("_")).select("speaker", speaker_key("speaker").alias("_k")).where("_k is not null")
    node = F.concat(F.lit("s:"), "_k")
    roots = _roots(_pairs(entries)).where("node like 's:%'")
    return stage(values.withColumn("node", node).join(roots.hint("merge"), "node", "left").select("speaker", F.coalesce("root", "node").alias("root")), "speakers")


def speaker_classes(entries: DataFrame) -> DataFrame:
    """Every stored speaker value that names somebody, once: columns speaker, class_id, members.

    Values of one class must share a split (see speakers_together); class_id is the first of them by code point.
    """
    named = _named(entries)
    classes = named.groupBy("root").agg(F.min("speaker").alias("class_id"), F.count(F.lit(1)).alias("members"))
    return join_skewed(named, classes, ["root"], hot_keys(named, ["root"])).select("speaker", "class_id", "members")


def speakers_together(entries: DataFrame, chunk: int = 2_000) -> DataFrame:
    """Pairs of different stored speaker values whose entries must share a split: columns speaker_a, speaker_b.

    Values that name nobody (null, blank, 'unknown' in any spelling) make no link and no row; an entry without a
    recording code links nothing. Compared and ordered by code point. All pairs of a class come out, as asked for; of a
    class over chunk values the left side is cut into chunks and the right side repeated, so that no task makes them all.
    speaker_classes gives the same in one row a value.
    """
    named = _named(entries)
    classes = named.groupBy("root").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("root", F.ceil(F.col("_n") / chunk).cast("int").alias("_cuts"))
    kept = join_skewed(named, classes, ["root"], hot_keys(named, ["root"]))
    a = kept.select("root", F.pmod(F.xxhash64("speaker"), F.col("_cuts")).cast("int").alias("_cut"), F.col("speaker").alias("speaker_a"))
    b = kept.select("root", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)).alias("_cut"), F.col("speaker").alias("speaker_b"))
    return a.join(b, ["root", "_cut"]).where("speaker_a < speaker_b").select("speaker_a", "speaker_b")


def split_entries(entries: DataFrame, targets: DataFrame) -> DataFrame:
    """Each entry's split: columns entry_id, root, split_name.

    targets: split_name, target_share (a small fixed table). An entry belongs to its recording's component, without a
    recording code to its speaker's, without either to one of its own. A component is never divided, so a component
    larger than a split's share shifts the shares.
    """
    pairs = stage(_pairs(entries), "pairs")
    roots = stage(_roots(pairs), "roots")
    key = F.coalesce(F.concat(F.lit("r:"), "r"), F.concat(F.lit("s:"), "s"))
    nodes = pairs.where("r is not null or s is not null").select(key.alias("node"), "n").groupBy("node").agg(F.sum("n").alias("n"))
    nodes = stage(nodes.join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root")), "nodes")
    rows = entries.select("entry_id", recording_key("audio_filepath").alias("r"), speaker_key("speaker").alias("s"))
    rows = rows.select("entry_id", F.coalesce(key, F.concat(F.lit("e:"), F.col("entry_id").cast("string"))).alias("node"))
    sizes = nodes.groupBy("root").agg(F.sum("n").alias("n"))
    alone = rows.where("node like 'e:%'").select(F.col("node").alias("root"), F.lit(1).cast("bigint").alias("n"))
    shares = [(r[0], float(r[1])) for r in targets.select("split_name", "target_share").where("split_name is not null and target_share > 0").orderBy("split_name").collect()]
    plan = stage(split_plan(sizes.unionByName(alone), "root", "n", sorted(shares, key=lambda x: (-x[1], x[0]))), "plan")
    where = join_skewed(nodes, plan, ["root"], hot_keys(nodes, ["root"])).select("node", "n", "root", "split_name")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    hot = where.where(F.col("n") * 500 > total).drop("n")  # fewer than 500 nodes
    cold = where.where(F.col("n") * 500 <= total).drop("n")
    done = rows.join(F.broadcast(hot.withColumnsRenamed({"root": "_root", "split_name": "_split"})), "node", "left")
    left = done.where("_root is null and node not like 'e:%'").select("entry_id", "node")
    single = done.where("node like 'e:%'").select("entry_id", "node").join(plan.withColumnRenamed("root", "node"), "node").select("entry_id", F.col("node").alias("root"), "split_name")
    return (
        done.where("_root is not null")
        .select("entry_id", F.col("_root").alias("root"), F.col("_split").alias("split_name"))
        .unionByName(left.join(cold, "node").select("entry_id", "root", "split_name"))
        .unionByName(single)
    )
