"""Queries of the general (not text-bound) data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.intervals import periods_and_gaps, to_millis
from millrace.plans.tables import table


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Periods and gaps of every session and speaker of segment, in milliseconds."""
    rows = table(spark, folder, "segment").select("session_id", "speaker", to_millis("start_time").alias("s"), to_millis("end_time").alias("e"))
    rows = rows.where(F.trim("speaker") != "")
    return periods_and_gaps(rows, ["session_id", "speaker"], "s", "e").withColumnsRenamed({"start": "start_ms", "end": "end_ms"})


P6_SQL = """
with rows as (
  select distinct session_id, speaker, cast(round(start_time * 1000) as bigint) as s, cast(round(end_time * 1000) as bigint) as e
  from segment
  where session_id is not null and trim(speaker) <> '' and start_time is not null and end_time is not null
    and not isnan(start_time) and not isnan(end_time)),
good as (select * from rows where e > s),
marked as (
  select *, max(e) over (partition by session_id, speaker order by s, e rows between unbounded preceding and 1 preceding) as prior from good),
labelled as (
  select *, sum(case when prior is null or s > prior then 1 else 0 end) over (partition by session_id, speaker order by s, e rows unbounded preceding) as label from marked),
periods as (select session_id, speaker, label, min(s) as s, max(e) as e from labelled group by all)
select session_id, speaker, 'period' as kind, s as start_ms, e as end_ms from periods
union all
select session_id, speaker, 'gap' as kind, prior as start_ms, s as end_ms from labelled where s > prior
"""

QUERIES = {"p6_found": p6_found}
SQL = {"p6_found": P6_SQL}
