"""Tabular, annotation and text sources, and their sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import zip_rows
from millrace.sources.manifest import parse_lines, scan_lines


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A .jsonl, .json, .csv, .tsv, .parquet or .xlsx file with all columns as text and nulls as empty texts."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind in ("jsonl", "json"):
        df = spark.read.option("primitivesAsString", "true").option("multiLine", str(kind == "json").lower()).json(path)
    elif kind in ("csv", "tsv"):
        df = spark.read.option("header", "true").option("sep", "," if kind == "csv" else "\t").option("multiLine", "true").option("escape", '"').csv(path)
    elif kind == "parquet":
        df = spark.read.parquet(path)
    elif kind == "xlsx":
        import pandas as pd

        df = spark.createDataFrame(pd.read_excel(path, dtype=str).fillna(""))  # one workbook's sheet, by its format at most 1,048,576 rows
    else:
        raise ValueError(f"no reader for .{kind}")
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def read_text_pairs(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Lines of two files side by side: ordinal, source, target; the longer file is cut. Blank lines don't count."""
    a, b = scan_lines(spark, source), scan_lines(spark, target)
    return zip_rows(a.select(F.col("ordinal").alias("_a"), F.col("line").alias("source")), ["_a"], b.select(F.col("ordinal").alias("_b"), F.col("line").alias("target")), ["_b"]).select("ordinal", "source", "target")


def with_side_lines(df: DataFrame, order: Sequence[str], side: DataFrame, side_order: Sequence[str]) -> DataFrame:
    """Rows with the side table's row at the same place; a side shorter than df is an error."""
    if side.count() < df.count():
        raise ValueError("the side table is shorter")
    return zip_rows(df, order, side, side_order).drop("ordinal")


CONVERSATION = "id string, conversations array<struct<`from`:string,value:string,type:string,duration:double>>, custom map<string,string>, system string, mask string"


def read_conversations(spark: SparkSession, paths: str | Sequence[str], system: str | None = None, bad_records: str = "error_at_end") -> DataFrame:
    """Conversations: id, turns (role in lower case, kind, value, duration), custom; those marked to be skipped fall away.

    With a system text, conversations that don't begin with one get it as their first turn.
    """
    lines = scan_lines(spark, paths)
    rows = lines.withColumn("_r", F.from_json("line", CONVERSATION)).where(F.col("_r").isNotNull()) if bad_records == "drop" else lines.withColumn("_r", F.from_json("line", CONVERSATION))
    turn = lambda t: F.struct(F.lower(t["from"]).alias("role"), F.coalesce(t["type"], F.lit("text")).alias("kind"), t["value"].alias("value"), t["duration"].alias("duration"))
    out = rows.select("ordinal", F.col("_r.id").alias("id"), F.transform("_r.conversations", turn).alias("turns"), F.col("_r.custom").alias("custom"))
    out = out.where(F.coalesce(~F.lower(F.try_element_at("custom", F.lit("_skipme"))).isin("true", "1"), F.lit(True)))
    if system is None:
        return out
    first = F.array(F.struct(F.lit("system").alias("role"), F.lit("text").alias("kind"), F.lit(system).alias("value"), F.lit(None).cast("double").alias("duration")))
    return out.withColumn("turns", F.when(F.coalesce(F.element_at("turns", 1)["role"], F.lit("")) != "system", F.concat(first, F.col("turns"))).otherwise(F.col("turns")))


def read_kaldi(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of wav.scp, segments, text and, if there, utt2spk: label, path, offset, duration, text, speaker."""
    two = lambda name, a, b: spark.read.text(f"{folder}/{name}").select(F.regexp_extract("value", r"^(\S+)", 1).alias(a), F.regexp_extract("value", r"^\S+\s+(.*)$", 1).alias(b))
    seg = spark.read.text(f"{folder}/segments").select(F.split("value", r"\s+").alias("x"))
    seg = seg.select(F.col("x")[0].alias("label"), F.col("x")[1].alias("wav"), F.col("x")[2].cast("double").alias("offset"), F.col("x")[3].cast("double").alias("end"))
    out = seg.join(two("wav.scp", "wav", "path"), "wav").join(two("text", "label", "text"), "label")
    try:
        out = out.join(two("utt2spk", "label", "speaker"), "label", "left")
    except Exception:  # the file is optional
        out = out.withColumn("speaker", F.lit(None).cast("string"))
    return out.select("label", "path", "offset", F.bround(F.col("end") - F.col("offset"), 3).alias("duration"), "text", "speaker")


def read_seglst(spark: SparkSession, path: str, session: str | None = None) -> DataFrame:
    """JSON arrays of segments, of one session if given; numbers may be written as text: session_id, speaker, start, end, duration, words."""
    rows = spark.read.option("multiLine", "true").option("primitivesAsString", "true").schema("session_id string, speaker string, start_time string, end_time string, words string").json(path)
    rows = rows if session is None else rows.where(F.col("session_id") == session)
    s, e = F.col("start_time").cast("double"), F.col("end_time").cast("double")
    return rows.select("session_id", "speaker", s.alias("start"), e.alias("end"), (e - s).alias("duration"), "words")


def read_rttm(spark: SparkSession, path: str) -> DataFrame:
    """SPEAKER lines: recording, start, duration, speaker."""
    x = spark.read.text(path).where(F.col("value").startswith("SPEAKER")).select(F.split("value", r"\s+").alias("x"))
    return x.select(F.col("x")[1].alias("recording"), F.col("x")[3].cast("double").alias("start"), F.col("x")[4].cast("double").alias("duration"), F.col("x")[7].alias("speaker"))


def read_lm_text(spark: SparkSession, path: str, field: str = "text") -> DataFrame:
    """Texts for a language model from .json(l)(.gz) or plain lines: one text a row, line ends as blanks, none empty."""
    lines = scan_lines(spark, path)
    text = F.get_json_object("line", f"$.{field}") if ".json" in path.rsplit("/", 1)[-1] else F.col("line")
    return lines.select("ordinal", F.trim(F.regexp_replace(text, r"\s*\n\s*", " ")).alias("text")).where("text <> ''")


def ctm_line(recording: Column, channel: str, start: Column, duration: Column, word: Column, score: Column | None = None) -> Column:
    """A line of the NIST format; a negative time or an empty word is an error when it is met."""
    bad = (start < 0) | (duration < 0) | (F.coalesce(F.trim(word), F.lit("")) == "")
    shown = F.format_string("%s %s %.3f %.3f %s %s", recording, F.lit(channel), start, duration, word, F.lit("NA") if score is None else F.format_string("%.2f", score))
    return F.when(bad, F.raise_error(F.lit("a time is negative or a word is empty")).cast("string")).otherwise(shown)


def write_lines(df: DataFrame, line: Column, order: Sequence[str | Column], folder: str) -> None:
    """Lines as text files in order (file by file and line by line)."""
    df.select(line.alias("value"), *[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]).orderBy(*[f"_o{i}" for i in range(len(order))]).select("value").write.mode("errorifexists").text(folder)


def subtitle_time(seconds: Column) -> Column:
    """H:MM:SS.cc"""
    cs = F.floor(seconds * 100).cast("bigint")
    return F.format_string("%d:%02d:%02d.%02d", F.floor(cs / 360000), F.floor(cs / 6000) % 60, F.floor(cs / 100) % 60, cs % 100)


def subtitle_line(start: Column, end: Column, text: Column, style: str = "Default") -> Column:
    return F.concat(F.lit("Dialogue: 0,"), subtitle_time(start), F.lit(","), subtitle_time(end), F.lit(f",{style},,0,0,0,,"), F.regexp_replace(text, "\n", r"\\N"))


def parsed(spark: SparkSession, path: str, schema: str, bad_records: str = "error_at_end") -> DataFrame:
    return parse_lines(scan_lines(spark, path), schema, bad_records)
