"""Queries of the general (core) training-data operators; the SQL beside them runs on the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.instants import message_instants
from threadloom.operators.sessions import cut_sessions, session_tree
from threadloom.session import cut_lineage, read_table

DAY_US = 86_400_000_000


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = message_instants(read_table(spark, sf_dir, "messages"), read_table(spark, sf_dir, "accounts"))
    return found.where("utc_us is not null and not all_canonical").select("message_id", "utc_us")


def _conversation_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_table(spark, sf_dir, "messages")
    instants = message_instants(messages, read_table(spark, sf_dir, "accounts"), keep=["conversation_id"])
    return instants.where("utc_us is not null and conversation_id is not null")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = session_tree(_conversation_times(spark, sf_dir), "conversation_id", "utc_us")
    return cut_sessions(tree, DAY_US).select(
        F.col("entity").alias("conversation_id"), "start_us", "end_us", F.col("n_events").alias("n_messages")
    )


def p6_gap_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of sessions of all users of ``events`` at several thresholds, from one tree."""
    events = read_table(spark, sf_dir, "events").select(
        F.col("user_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    )
    tree = cut_lineage(session_tree(events, "user_id", "us"))
    gaps = spark.createDataFrame([(h,) for h in (1, 6, 12, 24, 72)], "gap_hours long")
    hit = (F.col("height_us") <= F.col("gap_hours") * 3_600_000_000) & (
        F.col("parent_us").isNull() | (F.col("parent_us") > F.col("gap_hours") * 3_600_000_000)
    )
    return (
        tree.join(F.broadcast(gaps), hit)
        .groupBy("gap_hours")
        .agg(F.count("*").alias("n_sessions"), F.max("n_events").alias("max_events"), F.max(F.col("end_us") - F.col("start_us")).alias("max_duration_us"))
    )


QUERIES = {"p2_found": p2_found, "p6_found": p6_found, "p6_gap_settings": p6_gap_settings}

SQL = {
    "p6_gap_settings": """
        with g as (select unnest([1, 6, 12, 24, 72])::bigint as gap_hours),
        e as (select user_id, epoch_us(ts) as us, epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts) as d
              from events where user_id is not null and ts is not null),
        s as (select gap_hours, user_id, us, sum(case when d > gap_hours * 3600000000 then 1 else 0 end)
                     over (partition by gap_hours, user_id order by us) as k from e, g),
        t as (select gap_hours, user_id, k, count(*) as n, max(us) - min(us) as dur from s group by all)
        select gap_hours, count(*)::bigint as n_sessions, max(n)::bigint as max_events, max(dur)::bigint as max_duration_us
        from t group by gap_hours""",
}
