"""Conversations from canonical messages: grouping, ordering, sessions, validation, cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import textops as T
from threadloom.session import cut_lineage

ORDER = ("ts", "ordinal", "message_id")


def one_per_id(messages: DataFrame) -> DataFrame:
    """One row per message id (copies collapse to the smallest values), as a file per id would keep it."""
    return (
        messages.where("message_id is not null")
        .groupBy("message_id")
        .agg(*[F.min(c).alias(c) for c in ("conversation_id", "source", "ordinal", "speaker", "text")], F.min("loaded_at").alias("ts"))
    )


def rollup(messages: DataFrame) -> DataFrame:
    """Per conversation: source of the earliest message, start, end, number of messages; null ids are skipped."""
    first = F.min(F.struct(*ORDER, "source"))["source"]
    return (
        messages.where("conversation_id is not null and conversation_id <> ''")
        .groupBy("conversation_id")
        .agg(first.alias("source"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n_messages"))
    )


def nested(messages: DataFrame) -> DataFrame:
    """``conversation_id, messages ARRAY<STRUCT>`` in order, for the sinks that want documents.

    Memory of a row grows with its conversation, so analysis runs on the long form; nest only at a sink.
    """
    item = F.struct(*ORDER, "speaker", "text")
    return messages.where("conversation_id is not null").groupBy("conversation_id").agg(F.array_sort(F.collect_list(item)).alias("messages"))


def sessionize(events: DataFrame, entity: str, seconds: Column, threshold: int, *tie: str) -> DataFrame:
    """``events`` with ``session_index`` and ``session_id`` = ``<entity>_session_<index>``; a gap above the threshold parts."""
    w = Window.partitionBy(entity).orderBy("__s", *tie)
    gap = F.col("__s") - F.lag("__s").over(w)
    return (
        events.withColumn("__s", seconds)
        .withColumn("session_index", F.sum(F.when(gap > threshold, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("session_id", F.concat(F.col(entity).cast("string"), F.lit("_session_"), F.col("session_index").cast("string")))
        .drop("__s")
    )


def session_totals(sessions: DataFrame, entity: str) -> DataFrame:
    return sessions.groupBy(entity).agg((F.max("session_index") + 1).alias("total_sessions"))


def session_headers(sessions: DataFrame) -> DataFrame:
    """One row per session: ids, source, index, number of sessions of the original conversation, start, end, messages.

    ``sessions``: messages with ``conversation_id`` (of the session), ``original_conversation_id`` and ``session_index``.
    """
    each = sessions.groupBy("original_conversation_id", "conversation_id", "session_index").agg(
        F.min(F.struct(*ORDER, "source"))["source"].alias("source"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("total_messages")
    )
    total = each.groupBy("original_conversation_id").agg((F.max("session_index") + 1).alias("total_sessions"))
    return each.join(total, "original_conversation_id")


def empty_headers(conversations: DataFrame, messages: DataFrame) -> DataFrame:
    """Conversations without any message, passed on under their own id; null ids are none."""
    return conversations.where("conversation_id is not null").join(messages.select("conversation_id").distinct(), "conversation_id", "left_anti")


def order_violations(rows: DataFrame, entity: str, order: str, ts: str) -> DataFrame:
    """Rows whose time precedes the last valid time before them; null times neither count nor advance."""
    w = Window.partitionBy(entity).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("previous", F.last(ts, ignorenulls=True).over(w)).where(F.col(ts) < F.col("previous"))


def streaks(messages: DataFrame, longest: int = 3, valid: tuple[str, ...] = ("user", "assistant")) -> DataFrame:
    """Every message beyond the ``longest`` in a row by one speaker; messages of other speakers are passed over."""
    w = Window.partitionBy("conversation_id").orderBy(*ORDER)
    rows = messages.where(F.col("speaker").isin(*valid)).select("conversation_id", *ORDER, "speaker")  # texts stay out of the sort
    rows = rows.withColumn("change", F.when(F.col("speaker") == F.lag("speaker").over(w), 0).otherwise(1))
    rows = rows.withColumn("island", F.sum("change").over(w))
    inside = Window.partitionBy("conversation_id", "island").orderBy(*ORDER)
    return rows.withColumn("streak", F.row_number().over(inside)).where(F.col("streak") > longest).drop("change", "island")


def violations(messages: DataFrame) -> DataFrame:
    """One row per (conversation, rule, message): rules about ids, times, speakers and texts, with severity."""
    w = Window.partitionBy("conversation_id").orderBy("ordinal", "message_id").rowsBetween(Window.unboundedPreceding, -1)
    blank = F.coalesce(T.strip(F.col("text")), F.lit("")) == ""
    rules = F.array_compact(
        F.array(
            F.when(F.coalesce("message_id", F.lit("")) == "", F.struct(F.lit("message_id").alias("rule"), F.lit("error").alias("severity"))),
            F.when(F.col("ts").isNull(), F.struct(F.lit("timestamp").alias("rule"), F.lit("error").alias("severity"))),
            F.when(F.col("ts") < F.col("previous"), F.struct(F.lit("order").alias("rule"), F.lit("error").alias("severity"))),
            F.when(~F.coalesce(F.col("speaker").isin("user", "assistant"), F.lit(False)), F.struct(F.lit("speaker").alias("rule"), F.lit("error").alias("severity"))),
            F.when(F.col("blank"), F.struct(F.lit("text").alias("rule"), F.lit("error").alias("severity"))),
        )
    )
    timed = messages.select("conversation_id", "message_id", "ordinal", "ts", "speaker", blank.alias("blank")).withColumn("previous", F.last("ts", ignorenulls=True).over(w))
    rows = timed.select("conversation_id", "message_id", F.explode(rules).alias("r")).select("conversation_id", "message_id", "r.*")
    warned = streaks(messages).select("conversation_id", "message_id", F.lit("streak").alias("rule"), F.lit("warning").alias("severity"))
    return rows.unionByName(warned)


def validation_report(messages: DataFrame) -> DataFrame:
    """One row: conversations, errors, warnings and status (errors alone decide it)."""
    found = violations(messages).agg(
        F.count(F.when(F.col("severity") == "error", 1)).alias("errors"), F.count(F.when(F.col("severity") == "warning", 1)).alias("warnings")
    )
    total = messages.agg(F.countDistinct("conversation_id").alias("conversations"))
    return total.crossJoin(found).withColumn("status", F.when(F.col("errors") > 0, "FAIL").otherwise("PASS"))  # one row each


def clean(messages: DataFrame, drop_duplicates: bool = True) -> DataFrame:
    """Without auto-replies, one-word replies, emptied texts and repetitions by the same speaker; signatures stripped.

    Message ids are unique; null texts count as empty.
    """
    text = F.coalesce("text", F.lit(""))
    kept = messages.where(~T.is_autoreply(text)).withColumn("text", T.strip_signatures(text)).where(~T.is_low_quality(F.col("text")) & (F.col("text") != ""))
    if not drop_duplicates:
        return kept
    # Texts are compared by digest, so that the sort moves narrow rows only, and only dropped rows are joined back.
    kept = cut_lineage(kept)
    told = kept.select("conversation_id", *ORDER, F.md5("text").alias("digest"), "speaker")
    w = Window.partitionBy("conversation_id").orderBy(*ORDER)
    same = F.lag(F.struct("speaker", "digest")).over(w).eqNullSafe(F.struct("speaker", "digest"))
    repeated = told.withColumn("same", same).where("same").select("message_id")
    return kept.join(repeated, "message_id", "left_anti")


def cleaned_headers(messages: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Per conversation the messages kept and removed, and start and end anew (null where none is left)."""
    span = cleaned.groupBy("conversation_id").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))
    return clean_counts(messages, cleaned).join(span, "conversation_id", "left")


REQUIRED = ("conversation_id", "source", "start_timestamp", "end_timestamp", "messages")


def document_violations(documents: DataFrame) -> DataFrame:
    """``file, rule, value, severity``: documents that are no JSON objects, lack fields or hold no message.

    ``documents``: ``file, content``.  A document that is not parseable or lacks a field is not looked at further;
    its messages, where it has any, are the matter of ``violations``.
    """
    keys = F.json_object_keys("content")
    missing = F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), F.coalesce(keys, F.array().cast("array<string>")))
    valid = F.try_parse_json("content").isNotNull() & keys.isNotNull()
    n = F.coalesce(F.json_array_length(F.get_json_object("content", "$.messages")), F.lit(0))
    row = lambda rule, value, severity: F.struct(F.lit(rule).alias("rule"), value.alias("value"), F.lit(severity).alias("severity"))
    found = (
        F.when(~valid, F.array(row("json", F.lit(None).cast("string"), "error")))
        .when(F.size(missing) > 0, F.transform(missing, lambda k: row("field", k, "error")))
        .when(n == 0, F.array(row("no_messages", F.lit(None).cast("string"), "warning")))
    )
    return documents.select("file", F.explode(found).alias("v")).select("file", "v.*")


def sentences(violations: DataFrame) -> DataFrame:
    """Violations (of ``violations`` or ``document_violations``) with a readable ``text``."""
    told = F.create_map(
        *[F.lit(x) for x in (
            "json", "the file is no JSON object", "field", "a top-level field is missing", "no_messages", "the conversation holds no message", "message_id", "the message has no id",
            "timestamp", "the timestamp is missing or not ISO 8601", "order", "the timestamp precedes an earlier message's", "speaker", "the speaker is missing or neither user nor assistant",
            "text", "the text is missing or blank", "streak", "one speaker goes on without an answer",
        )]
    )
    where = [c for c in ("file", "conversation_id", "message_id", "value") if c in violations.columns]
    return violations.withColumn("text", F.concat_ws(": ", F.concat_ws(" ", *where), told[F.col("rule")]))


def clean_counts(messages: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Per conversation the messages before and after cleaning, emptied conversations included."""
    after = cleaned.groupBy("conversation_id").agg(F.count("*").alias("kept"))
    before = messages.groupBy("conversation_id").agg(F.count("*").alias("total"))
    return before.join(after, "conversation_id", "left").select(
        "conversation_id", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("total") - F.coalesce("kept", F.lit(0))).alias("removed")
    )
