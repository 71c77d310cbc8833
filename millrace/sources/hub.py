"""Tables of hub datasets (nested audio and text columns under dotted keys), read as rows and written as manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import squeeze
from millrace.sources.manifest import write_manifest


def dotted(df: DataFrame, key: str) -> Column:
    """The field under a dotted key; a part that isn't there is an error naming it."""
    kind = df.schema
    for part in key.split("."):
        fields = {f.name: f.dataType for f in getattr(kind, "fields", [])}
        if part not in fields:
            raise ValueError(f"no field {part!r} of the key {key!r}")
        kind = fields[part]
    return F.col(".".join(f"`{p}`" for p in key.split(".")))


def read_hub_table(spark: SparkSession, path: str, audio_key: str = "audio.array", sample_rate_key: str = "audio.sampling_rate", text_key: str = "text", normalize: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Parquet files of a dataset: samples, sample_rate, duration, text, and the columns of keep.

    Only the named nested fields are read. Texts are in one line; normalize also lowers case and squeezes blanks.
    """
    df = spark.read.parquet(path)
    samples, rate = dotted(df, audio_key), dotted(df, sample_rate_key)
    text = F.coalesce(dotted(df, text_key), F.lit(""))
    shown = squeeze(F.lower(text)) if normalize else F.trim(F.regexp_replace(text, r"\s*\n\s*", " "))
    return df.select(*(keep or []), samples.alias("samples"), rate.alias("sample_rate"), (F.size(samples) / rate).alias("duration"), shown.alias("text"))


def audio_path(path: Column, base: str) -> Column:
    """Where the sound of a row is kept: what stands before '::', without a 'zip://', under base, ending in .wav."""
    inner = F.regexp_replace(F.split_part(path, F.lit("::"), F.lit(1)), "zip://", "")
    name = F.regexp_replace(inner, r"^/+", "")
    whole = F.when(inner.startswith("/"), inner).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), name))
    return F.concat(F.regexp_replace(whole, r"([^/.])\.[^./]*$", "$1"), F.lit(".wav"))


def as_manifest(df: DataFrame, base: str, audio: str = "audio") -> DataFrame:
    """Rows of a dataset as manifest rows: all columns but the sound and file, audio_filepath and duration in seconds.

    df may be a stream; nothing is gathered.
    """
    a = lambda f: F.col(f"`{audio}`.`{f}`")
    rest = [c for c in df.columns if c not in (audio, "file", "audio_filepath", "duration")]
    return df.select(audio_path(a("path"), base).alias("audio_filepath"), *rest, (F.size(a("array")) / a("sampling_rate")).alias("duration"))


def convert(spark: SparkSession, path: str, base: str, out: str, audio: str = "audio", streaming: bool = False, checkpoint: str | None = None) -> None:
    """Write a dataset's table as a manifest: in one job, or as a stream that takes each file once."""
    if not streaming:
        write_manifest(as_manifest(spark.read.parquet(path), base, audio), out)
        return
    schema = spark.read.parquet(path).schema
    rows = as_manifest(spark.readStream.schema(schema).parquet(path), base, audio)
    rows.writeStream.format("json").option("ignoreNullFields", "false").option("checkpointLocation", checkpoint or f"{out}_state").trigger(availableNow=True).start(out).awaitTermination()
