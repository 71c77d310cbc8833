"""Line-delimited manifests: scanning, alias resolution, paths, cuts, and writing."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import bounded_hash, last_by_key
from millrace.operators.ordered import running_sum, with_position
from millrace.session import stage

# The keys under which a manifest may hold each field, first match first.
ALIASES = {
    "audio_file": ["audio_filename", "audio_filepath", "context"], "video_file": ["video_filename", "video_filepath"], "duration": ["duration", "context_duration"],
    "text": ["text", "normalized_text"], "text_file": ["text_filepath"], "rttm_file": ["rttm_file", "rttm_filename", "rttm_filepath"], "feature_file": ["feature_file", "feature_filename", "feature_filepath"],
}
PLAIN = {
    "offset": "double", "speaker": "string", "orig_sr": "int", "token_labels": "string", "lang": "string", "source_lang": "string", "target_lang": "string",
    "sampling_rate": "int", "uniq_id": "string", "label": "string",
}


def scan_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Non-blank lines with their file and a running ordinal over all files, in the order of the files' names and lines."""
    rows = spark.read.text(paths if isinstance(paths, str) else list(paths))
    rows = rows.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    rows = rows.where(F.trim("line") != "")
    return with_position(rows, ["file", "_block", "_at"], "ordinal").select("ordinal", "file", "line")


def parse_lines(lines: DataFrame, schema: str, bad_records: str = "error_at_end") -> DataFrame:
    """Lines as columns of a schema, with ordinal and file.

    bad_records: 'drop' leaves out lines that aren't JSON objects; 'keep' gives them null columns; 'error_at_end' raises
    where there are any, naming their number and the first.
    """
    if bad_records not in ("drop", "keep", "error_at_end"):
        raise ValueError("bad_records is 'drop', 'keep' or 'error_at_end'")
    parsed = lines.withColumn("_row", F.from_json("line", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})).withColumn("_bad", F.col("_row._bad").isNotNull() | F.col("_row").isNull())
    if bad_records == "error_at_end":
        found = parsed.where("_bad").agg(F.count(F.lit(1)).alias("n"), F.min_by("line", "ordinal").alias("line")).first()
        if found["n"]:
            raise ValueError(f"{found['n']} lines aren't JSON, the first: {found['line'][:200]!r}")
    if bad_records == "drop":
        parsed = parsed.where("not _bad")
    names = [f.split()[0] for f in schema.split(",")]
    return parsed.select("ordinal", "file", *[F.col(f"_row.{n}").alias(n) for n in names])


#: Line parsers by name: each makes a struct column of the line and the file it is in; register_parser adds to them.
PARSERS: dict[str, Callable[[Column, Column, str], Column]] = {"json": lambda line, file, schema: F.from_json(line, schema)}


def register_parser(name: str, parse: Callable[[Column, Column, str], Column]) -> None:
    """Make a parser known: a function of the line, its file and the schema that gives a struct, null for a bad line."""
    PARSERS[name] = parse


def python_parser(parse: Callable[[str, str], dict]) -> Callable[[Column, Column, str], Column]:
    """A parser from a Python function of a line and its file; a ValueError (as of bad JSON) marks a bad line."""

    def make(line: Column, file: Column, schema: str) -> Column:
        kind = T.StructType.fromDDL(schema)

        def run(lines: pd.Series, files: pd.Series) -> pd.Series:
            out = []
            for x, f in zip(lines, files, strict=True):
                try:
                    got = parse(x, f)
                    out.append(json.dumps({k: got.get(k) for k in kind.names}))
                except ValueError:
                    out.append(None)
            return pd.Series(out, dtype=object)

        return F.from_json(F.pandas_udf(run, T.StringType())(line, file), schema)

    return make


def items(spark: SparkSession, paths: str | Sequence[str], schema: str, parse: str | Callable[[Column, Column, str], Column] = "json", bad_records: str = "error_at_end") -> DataFrame:
    """Lines as rows of the schema by a parser, given or registered, with their running id over all lines.

    bad_records is 'drop', 'keep' (null columns) or 'error_at_end', which names the number of bad lines and the first.
    """
    made = PARSERS[parse] if isinstance(parse, str) else parse
    rows = stage(scan_lines(spark, paths).withColumn("_r", made(F.col("line"), F.col("file"), schema)), "items")  # parsed once
    bad = F.col("_r").isNull()
    if bad_records == "error_at_end":
        found = rows.where(bad).agg(F.count(F.lit(1)).alias("n"), F.min_by("line", "ordinal").alias("line")).first()
        if found["n"]:
            raise ValueError(f"{found['n']} lines can't be parsed, the first: {found['line'][:200]!r}")
    if bad_records == "drop":
        rows = rows.where(~bad)
    return rows.select(F.col("ordinal").alias("id"), *[F.col(f"_r.{n}").alias(n) for n in T.StructType.fromDDL(schema).names])


#: Kinds of extra fields: each attaches a column of a name to rows in order; register_extra_field adds to them.
EXTRA_FIELDS: dict[str, Callable[..., DataFrame]] = {}


def register_extra_field(kind: str) -> Callable:
    def add(attach: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        EXTRA_FIELDS[kind] = attach
        return attach

    return add


@register_extra_field("text_iter")
def _lines_in_turn(df: DataFrame, order: Sequence[str], name: str, path: str, seed: int | str | None = None) -> DataFrame:
    """Each row gets the line at its place; too few lines are an error."""
    side = scan_lines(df.sparkSession, path).select(F.col("ordinal").alias("_side"), F.trim("line").alias(name))
    placed = with_position(df, order, "_side")
    if side.count() < placed.count():
        raise ValueError(f"there aren't enough lines in {path} for the field {name}")
    return placed.join(side, "_side").drop("_side")


@register_extra_field("text_sample")
def _line_by_hash(df: DataFrame, order: Sequence[str], name: str, path: str, seed: int | str = 0) -> DataFrame:
    """Each row gets a line that the hash of its order and the seed picks."""
    side = stage(scan_lines(df.sparkSession, path).select(F.col("ordinal").alias("_side"), F.trim("line").alias(name)), "lines")
    n = side.count()
    if not n:
        raise ValueError(f"{path} has no lines for the field {name}")
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in order])
    return df.withColumn("_side", bounded_hash(n, key, str(seed))).join(side, "_side").drop("_side")


def with_extra_fields(df: DataFrame, order: Sequence[str], fields: Sequence[Mapping]) -> DataFrame:
    """df with extra fields, each given as a mapping of type, name and what the type asks for (path, seed)."""
    for f in fields:
        if f.get("type") not in EXTRA_FIELDS:
            raise ValueError(f"no such extra field: {f!r}; there are {sorted(EXTRA_FIELDS)}")
        if "name" not in f:
            raise ValueError(f"an extra field needs a name: {f!r}")
    for f in fields:
        df = EXTRA_FIELDS[f["type"]](df, order, **{k: v for k, v in f.items() if k != "type"})
    return df


def canonical(lines: DataFrame, bad_records: str = "error_at_end") -> DataFrame:
    """Manifest lines as rows of the canonical fields: id, file, those of ALIASES and PLAIN.

    A key counts as present where the line has it, even with a null value, so that 'text': null gives an empty text. A row
    with neither audio nor video, or without a duration, is an error when it is met.
    """
    if bad_records == "drop":
        lines = lines.where(F.get_json_object("line", "$").startswith("{"))
    elif bad_records == "error_at_end":
        bad = lines.where(~F.coalesce(F.get_json_object("line", "$").startswith("{"), F.lit(False))).agg(F.count(F.lit(1)).alias("n"), F.min_by("line", "ordinal").alias("line")).first()
        if bad["n"]:
            raise ValueError(f"{bad['n']} lines aren't JSON objects, the first: {bad['line'][:200]!r}")
    keys = F.json_object_keys("line")

    def pick(names: Sequence[str], kind: str = "string") -> Column:
        out = F.lit(None).cast(kind)
        for n in reversed(names):
            out = F.when(F.array_contains(keys, n), F.get_json_object("line", f"$.{n}").cast(kind)).otherwise(out)
        return out

    has = lambda names: F.arrays_overlap(keys, F.array(*map(F.lit, names)))
    audio = F.when(has(ALIASES["audio_file"] + ALIASES["video_file"]), pick(ALIASES["audio_file"])).otherwise(F.raise_error(F.concat(F.lit("no audio or video file in: "), F.col("line"))))
    seconds = F.when(has(ALIASES["duration"]), pick(ALIASES["duration"], "double")).otherwise(F.raise_error(F.concat(F.lit("no duration in: "), F.col("line"))).cast("double"))
    return lines.select(
        F.col("ordinal").alias("id"), "file", audio.alias("audio_file"), pick(ALIASES["video_file"]).alias("video_file"), seconds.alias("duration"),
        F.coalesce(pick(ALIASES["text"]), F.lit("")).alias("text"), pick(ALIASES["text_file"]).alias("text_file"), pick(ALIASES["rttm_file"]).alias("rttm_file"), pick(ALIASES["feature_file"]).alias("feature_file"),
        *[pick([n], kind).alias(n) for n, kind in PLAIN.items()],
    )


def full_path(path: str | Column, file: str | Column, limit: int = 255) -> Column:
    """A relative path of fewer than limit characters against the manifest's folder; any other path as it is."""
    p, f = (F.col(x) if isinstance(x, str) else x for x in (path, file))
    return F.when((F.length(p) < limit) & ~p.rlike(r"^(/|\w+:)"), F.concat(F.regexp_replace(f, "[^/]*$", ""), p)).otherwise(p)


def cuts(rows: DataFrame, path: str = "audio_filepath", offset: str = "offset", duration: str = "duration", skip: str | None = "_skipme") -> DataFrame:
    """Rows that aren't to be skipped and have a path and a duration, with cut_id: the path, and for an offset the
    hundredths of seconds at which the cut begins and how long it is."""
    kept = rows.where(F.col(path).isNotNull() & F.col(duration).isNotNull())
    if skip and skip in rows.columns:
        kept = kept.where(~F.coalesce(F.col(skip), F.lit(False)))
    cs = lambda c: F.bround(F.col(c) * 100).cast("bigint")
    ident = F.when(F.coalesce(F.col(offset), F.lit(0.0)) > 0, F.concat(F.col(path), F.format_string("-%06d-%06d", cs(offset), cs(duration)))).otherwise(F.col(path))
    return kept.withColumn("cut_id", ident)


def last_of_each(rows: DataFrame, key: str = "audio_filepath", order: Sequence[str] = ("ordinal",)) -> DataFrame:
    """One row per key, the last in order."""
    return last_by_key(rows, [key], list(order))


def shard_id(path: str | Column) -> Column:
    """The number before the extension of a shard's file name, or null."""
    c = F.col(path) if isinstance(path, str) else path
    digits = F.regexp_extract(c, r"(\d+)\.(?:json|jsonl|tar)$", 1)
    return F.when(digits != "", digits.cast("bigint"))


def write_manifest(df: DataFrame, folder: str, ascii_only: bool = False) -> None:
    """One JSON object per row, null fields written as null; ascii_only escapes other characters."""
    if not ascii_only:
        df.write.option("ignoreNullFields", "false").mode("errorifexists").json(folder)
        return
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    escaped = F.array_join(F.transform(F.split(line, ""), lambda c: F.when(c.rlike(r"^[\x00-\x7f]*$"), c).otherwise(F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1"))), "")
    df.select(escaped.alias("value")).write.mode("errorifexists").text(folder)


def free_name(spark: SparkSession, path: str) -> str:
    """path, or the first of path_prepared1, path_prepared2, ... that isn't there yet."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    stem, dot, ext = path.rpartition(".") if "." in path.rsplit("/", 1)[-1] else (path, "", "")
    name, n = path, 0
    while True:
        p = jvm.org.apache.hadoop.fs.Path(name)
        if not p.getFileSystem(conf).exists(p):
            return name
        n += 1
        name = f"{stem}_prepared{n}{dot}{ext}"


def source_streams(rows: DataFrame, lang: str, source: str, shard: str, order: Sequence[str], sources: dict[str, Sequence[str]], kept: Column, give_up: int = 2) -> DataFrame:
    """Each language's rows in the order in which its sources are read: columns of rows, place (from 0 in the language).

    sources names the sources of each language in order. A source's shards come by number and a shard's rows by order;
    rows that aren't kept fall away. A source of which give_up shards in a row keep nothing is left at the last of them.
    Only the shards' counts, a row a shard, are windowed; the places are running counts over range partitions.
    """
    named = [(k, s, i) for k, v in sources.items() for i, s in enumerate(v)]
    places = rows.sparkSession.createDataFrame(named, "_l string, _s string, _turn int")
    known = rows.join(F.broadcast(places), (F.col(lang) == F.col("_l")) & (F.col(source) == F.col("_s"))).drop("_l", "_s")
    known = known.withColumn("_kept", F.coalesce(kept, F.lit(False)))
    counts = known.groupBy(lang, source, shard).agg(F.count_if("_kept").alias("_n"))
    by = Window.partitionBy(lang, source).orderBy(shard)
    counts = counts.withColumn("_dry", F.max("_n").over(by.rowsBetween(1 - give_up, 0)) + F.when(F.count(F.lit(1)).over(by.rowsBetween(1 - give_up, 0)) < give_up, 1).otherwise(0))
    read = counts.withColumn("_left", F.coalesce(F.max((F.col("_dry") == 0).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("_left = 0").select(lang, source, shard)
    live = known.where("_kept").join(read, [lang, source, shard], "left_semi")
    ranked = running_sum(live.withColumn("_one", F.lit(1)), [lang], ["_turn", shard, *order], "_one", "_rank")
    return ranked.select(*rows.columns, (F.col("_rank") - 1).cast("bigint").alias("place"))
