"""Queries over streams; each runs a stream over what is there now and reads its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.plans.tables import table
from millrace.plans.texts import _words
from millrace.session import fresh_path
from millrace.streaming import frames as R
from millrace.streaming import utterances as U
from millrace.streaming import windows as W

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    static = table(spark, folder, name)
    rows = spark.readStream.schema(static.schema).parquet(f"{folder}/{name}.parque[t]")  # as a pattern, so that a table may be a file or a folder
    return rows.withColumns({c: F.col(c).cast("timestamp") for c, kind in rows.dtypes if kind == "timestamp_ntz"})


def _drained(spark: SparkSession, df: DataFrame, mode: str) -> DataFrame:
    out = fresh_path(spark, "stream")
    schema = df.schema
    U.drain(df, out, mode)
    got = spark.read.parquet(f"{out}/data") if mode == "complete" else spark.read.schema(schema).parquet(f"{out}/data")
    return got.select(*[F.col(c).cast("timestamp_ntz").alias(c) if kind == "timestamp" else F.col(c) for c, kind in got.select(*schema.names).dtypes])


@query("""
with o as (select *, lag(ts) over (partition by user_id order by ts) as b from events), i as (select *, sum(case when b is null or ts - b >= interval 2 hours then 1 else 0 end) over (partition by user_id order by ts rows unbounded preceding) as s from o)
select user_id, min(ts) as start, max(ts) + interval 2 hours as end, count(*) as n, round(sum(value), 4) as total from i group by user_id, s
""")
def q_stream_sessions(spark, folder):
    """Sessions of users by event time."""
    s = W.sessions(_stream(spark, folder, "events"), "user_id", "ts", "2 hours", "1 hour", [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")])
    return _drained(spark, s, "complete")


@query("select event_type, time_bucket(interval 6 hours, ts) as start, time_bucket(interval 6 hours, ts) + interval 6 hours as end, count(*) as n from events group by 1, 2")
def q_stream_windows(spark, folder):
    """Tumbling windows per type of event."""
    return _drained(spark, W.windows(_stream(spark, folder, "events"), ["event_type"], "ts", "6 hours", None, "1 hour", [F.count(F.lit(1)).alias("n")]), "complete")


@query("select distinct on (event_id) event_id, user_id from events")
def q_stream_once(spark, folder):
    """Events once each."""
    e = _stream(spark, folder, "events")
    return _drained(spark, W.once(e.unionByName(e), ["event_id"], "ts", "40 days").select("event_id", "user_id"), "append")


SEG = "(select * from segment where speaker is not null and start_time is not null and end_time is not null and not isnan(start_time) and not isnan(end_time) and end_time > start_time)"


@query(f"""
with d as (select distinct session_id, speaker, cast(floor(start_time * 10) as int) as t from {SEG}), o as (select *, lag(t) over (partition by session_id, speaker order by t) as b from d),
i as (select *, sum(case when t - b - 1 > 60 then 1 else 0 end) over (partition by session_id, speaker order by t rows unbounded preceding) as u from o)
select session_id || '/' || speaker as stream_id, u::int as utterance, list(t order by t) as tokens, min(t)::double as start, max(t)::double as end from i group by session_id, speaker, u
""")
def q_stream_utterances(spark, folder):
    """Utterances of keyed streams whose frames overlap by a token, closed at gaps and at the end."""
    s = table(spark, folder, "segment").where("speaker is not null and start_time is not null and end_time > start_time and not isnan(start_time) and not isnan(end_time)")
    g = s.select(F.concat("session_id", F.lit("/"), "speaker").alias("stream_id"), F.floor(F.col("start_time") * 10).cast("int").alias("t")).distinct()
    g = g.groupBy("stream_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    n = F.ceil(F.size("t") / 4).cast("int")
    rows = g.select("stream_id", "t", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("frame_no"))
    first = F.greatest(F.col("frame_no") * 4, F.lit(1))  # each frame but the first begins with the last token before it
    tokens = F.slice("t", first, F.when(F.col("frame_no") == 0, 4).otherwise(5))
    rows = rows.select("stream_id", "frame_no", tokens.alias("tokens"), F.transform(tokens, lambda x: x.cast("double")).alias("timesteps"), (F.col("frame_no") == F.col("n") - 1).alias("is_last"))
    out = fresh_path(spark, "frames")
    rows.write.parquet(out)
    u = U.utterances(spark.readStream.schema(rows.schema).parquet(out), silence=60.0, limit=1)
    return _drained(spark, u, "append").where("kind = 'final'").select("stream_id", "utterance", "tokens", "start", "end")


@query(f"""
with t as (select item_id, list_transform({_words('text')}, lambda w: length(w)) as v from eval_items), f as (select item_id, v, unnest(range(0, cast(ceil(len(v) / 8) as bigint))) as k from t where len(v) > 0)
select item_id, k::int as frame_no, list_resize(v[k * 8 + 1 : k * 8 + 8], 8, 0) as samples, len(v[k * 8 + 1 : k * 8 + 8])::int as length, k = 0 as is_first, k = ceil(len(v) / 8) - 1 as is_last from f
""")
def q_frames(spark, folder):
    """Count windows of a stream, the last one padded."""
    d = table(spark, folder, "eval_items").select("item_id", F.transform(T.split_words("text"), lambda w: F.length(w)).alias("v"))
    return R.framed(d, "item_id", "v", 8, pad=True)


@query(f"""
with t as (select item_id, list_transform({_words('text')}, lambda w: length(w)) as v from eval_items), f as (select item_id, v, unnest(range(0, cast(ceil(len(v) / 8) as bigint))) as k from t where len(v) > 0),
b as (select item_id, k, list_concat(list_transform(range(0, 20), lambda i: 0), v[1 : least(k * 8 + 8, len(v))]) as a, least(k * 8 + 8, len(v)) as n from f)
select item_id, k::int as frame_no, a[len(a) - 19 : len(a)] as buffer, greatest(20 - n, 0)::int as left_padding from b
""")
def q_buffers(spark, folder):
    """Sliding buffers of twenty samples."""
    d = table(spark, folder, "eval_items").select("item_id", F.transform(T.split_words("text"), lambda w: F.length(w)).alias("v"))
    return R.buffered(R.framed(d, "item_id", "v", 8), "item_id", 8, 20).select("item_id", "frame_no", "buffer", "left_padding")


def q_admission(spark: SparkSession, folder: str) -> DataFrame:
    """Frames in steps with eight streams at once."""
    d = table(spark, folder, "eval_items").select("item_id", F.transform(T.split_words("text"), lambda w: F.length(w)).alias("v"))
    return R.admitted(R.framed(d, "item_id", "v", 8), "item_id", 8).select("item_id", "frame_no", "step")


QUERIES["q_admission"] = q_admission
# Stream by stream: when each of the eight slots is free again.
SQL["q_admission"] = f"""
with recursive t as materialized (select item_id, ceil(len({_words('text')}) / 8)::int as n, row_number() over (order by item_id) as k from eval_items where len({_words('text')}) > 0),
f as (select 0::bigint as i, [0, 0, 0, 0, 0, 0, 0, 0] as free, null::bigint as item_id, 0 as n, 0 as begun union all
  select k, list_transform(free, lambda x, j: case when j = list_position(free, list_min(free)) then x + t.n else x end), t.item_id, t.n, list_min(free) from f join t on k = i + 1)
select item_id, frame_no::int as frame_no, (begun + frame_no)::int as step from (select item_id, begun, unnest(range(0, n)) as frame_no from f where i > 0)
"""


@query("select entry_id, (entry_id // 1000 > 0 or ('0x' || substr(md5(entry_id || ':5'), 1, 8))::bigint % 100 < 30) as augmented from manifest_entries")
def q_augment_flag(spark, folder):
    """Rows of later cycles always, others by hash."""
    from millrace.operators.joins import bounded_hash

    cycle = F.floor(F.col("entry_id") / 1000)
    return table(spark, folder, "manifest_entries").select("entry_id", ((cycle > 0) | (bounded_hash(100, F.col("entry_id"), 5) < 30)).alias("augmented"))
