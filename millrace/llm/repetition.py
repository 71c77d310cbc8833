"""Repetition inside a document, and lines that recur over documents (problem 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.wordstream import chunks, word_stream
from millrace.operators.joins import join_skewed
from millrace.session import stage

SHINGLE = 5


def repeated_positions(doc: np.ndarray, code: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Which words stand in a run of size words that the same document has had before."""
    n = len(code) - size + 1
    covered = np.zeros(len(code), bool)
    if n < 1:
        return covered
    with np.errstate(over="ignore"):
        mixed = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        run = np.zeros(n, np.uint64)
        for i in range(size):
            run = run * np.uint64(0xBF58476D1CE4E5B9) + mixed[i : i + n]
        run ^= (doc[:n].astype(np.uint64) + np.uint64(1)) * np.uint64(0x94D049BB133111EB)
        run ^= run >> np.uint64(31)
    whole = doc[:n] == doc[size - 1 :]
    at = np.flatnonzero(whole)
    order = at[np.argsort(run[at], kind="stable")]
    again = np.zeros(len(order), bool)
    again[1:] = run[order[1:]] == run[order[:-1]]
    marks = np.zeros(len(code) + 1, np.int32)
    np.add.at(marks, order[again], 1)
    np.add.at(marks, order[again] + size, -1)
    covered[:] = np.cumsum(marks[:-1]) > 0
    return covered


def _shares(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in chunks(batches, "_text"):
            n = len(pdf)
            w = word_stream(pdf["_text"].fillna("").tolist(), headings=False, numbers=False)
            words = np.bincount(w.doc, minlength=n)[:n]
            again = np.bincount(w.doc[repeated_positions(w.doc, w.code, size)], minlength=n)[:n]
            yield pd.DataFrame({"_id": pdf["_id"], "words": words, "repeated_words": again})

    return run


def repeated_share(df: DataFrame, ident: str, text: str, size: int = SHINGLE) -> DataFrame:
    """Per document: ident, words, repeated_words, repeated_share.

    A word (in Chinese and Japanese a character) is repeated if it stands in a run of size words that came before in the
    same document; runs may overlap, so a phrase said n times in a row counts n - 1 times. Case, punctuation, character
    forms and numbers make no difference; line openings (tags, times, bullets) and headings don't count. A document
    without words (null, empty) has share 0. Every row gives one row, repeated rows too; one pass, no shuffle.
    """
    kind = df.schema[ident].dataType.simpleString()
    rows = df.select(F.col(ident).alias("_id"), F.col(text).alias("_text"))
    out = rows.mapInPandas(_shares(size), f"_id {kind}, words long, repeated_words long")
    share = F.when(F.col("words") > 0, F.col("repeated_words") / F.col("words")).otherwise(0.0)
    return out.select(F.col("_id").alias(ident), "words", "repeated_words", share.alias("repeated_share"))


def _line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\d+", "0"), r"[^\p{L}\p{N}]+", " "))))


def depleted_documents(df: DataFrame, ident: str, text: str, host: str, limit: int = 5, least: float = 0.5) -> DataFrame:
    """Per document, what is left of it without the lines that recur over its host's documents.

    Columns: ident, lines, kept_lines, kept_share, depleted. A line (case, digits and punctuation aside) in more than limit
    distinct documents of a host is removed there; a document of which less than least of its lines stay is depleted.
    A null host is a host of its own; blank lines don't count; a document without lines has share 0 and isn't depleted.
    Lines are counted per document first, so a line said often in one document, or a host with most documents, weighs
    no more in the shuffle than its distinct lines; lines are told apart by 128 bits. A line that stands in over a
    thousandth of all (document, line) pairs meets them by broadcast, so that no task gets all documents with it.
    """
    lines = df.select(F.col(ident).alias("_id"), F.coalesce(F.col(host), F.lit("")).alias("_host"), F.explode_outer(F.split(text, "\n")).alias("_line"))
    lines = lines.where(F.col("_line").rlike(r"[\p{L}\p{N}]")).select("_id", "_host", _line_key(F.col("_line")).alias("_key"))
    each = stage(lines.groupBy("_host", "_key", "_id").agg(F.count(F.lit(1)).alias("_n")), "lines")
    common = stage(each.groupBy("_host", "_key").agg(F.count(F.lit(1)).alias("_docs")).where(F.col("_docs") > limit), "common")
    total = each.count()
    hot = common.where(F.col("_docs") > 0.001 * total).select("_host", "_key").collect()  # a thousand rows at most
    hot = df.sparkSession.createDataFrame(hot, common.select("_host", "_key").schema) if hot else None
    met = join_skewed(each, common.select("_host", "_key", F.lit(True).alias("_common")), ["_host", "_key"], hot, "left")
    seen = met.groupBy("_id").agg(F.sum("_n").alias("lines"), F.sum(F.when(F.col("_common"), 0).otherwise(F.col("_n"))).alias("kept_lines"))
    out = df.select(F.col(ident).alias("_id")).join(seen, "_id", "left").na.fill(0, ["lines", "kept_lines"])
    share = F.when(F.col("lines") > 0, F.col("kept_lines") / F.col("lines")).otherwise(0.0)
    return out.select(F.col("_id").alias(ident), "lines", "kept_lines", share.alias("kept_share"), ((F.col("lines") > 0) & (share < least)).alias("depleted"))
