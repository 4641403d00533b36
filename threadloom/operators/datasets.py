"""From clean conversations to datasets: gates, annotations, exports, statistics, chunks, comparisons."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import textops as T
from threadloom.session import whole_groups

DEFAULT_LANGUAGES = ("en - English", "hi - Hindi", "ta - Tamil")


def only(rows: DataFrame, ids: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Rows of the listed ids; rows without an id pass."""
    return rows.join(ids.select(key).distinct(), key, "left_semi").unionByName(rows.where(F.col(key).isNull()))


def without(rows: DataFrame, ids: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Rows of ids not listed; rows without an id pass."""
    return rows.join(ids.select(key).distinct(), key, "left_anti")


def conversation_languages(annotations: DataFrame) -> DataFrame:
    """``conversation_id, languages``: the sorted union of the labels of all messages."""
    label = annotations.select("conversation_id", F.explode("detected_languages").alias("d")).select("conversation_id", F.explode("d.languages").alias("l"))
    return label.groupBy("conversation_id").agg(F.array_sort(F.collect_set("l")).alias("languages"))


def language_gate(rows: DataFrame, annotations: DataFrame, allowed: tuple[str, ...] = DEFAULT_LANGUAGES) -> DataFrame:
    """Rows of conversations all of whose labels are allowed; those without annotation pass."""
    found = conversation_languages(annotations)
    bad = found.where(F.size(F.array_except("languages", F.array(*[F.lit(a) for a in allowed]))) > 0)
    return without(rows, bad)


def remap_language(annotations: DataFrame, old: str, new: str) -> DataFrame:
    swap = lambda d: d.withField("languages", F.transform(d["languages"], lambda x: F.when(x == old, new).otherwise(x)))
    return annotations.withColumn("detected_languages", F.transform("detected_languages", swap))


def annotate(messages: DataFrame) -> DataFrame:
    """Per message: ``label`` (intent), ``sentiment``, ``score``, ``languages`` by the offline rules."""
    text = F.coalesce("text", F.lit(""))
    mood = T.sentiment(text)
    return messages.withColumns(
        {"label": T.intent(F.coalesce("speaker", F.lit("user")), text), "sentiment": mood, "score": F.when(mood == "neutral", 0.5).otherwise(0.8), "languages": T.languages(text)}
    )


def summaries(annotated: DataFrame) -> DataFrame:
    """``conversation_id, issue, resolution`` from words anywhere in the conversation and from its labels."""
    low = F.lower(F.coalesce("text", F.lit("")))
    has = lambda *w: F.bool_or(T.any_of(low, list(w)))
    issue = resolution = None
    for words, told in reversed(T.ISSUES):
        issue = F.lit(told) if issue is None else F.when(has(*words), told).otherwise(issue)
    for label, told in reversed(T.RESOLUTIONS):
        resolution = F.lit(told) if resolution is None else F.when(F.bool_or(F.col("label") == label), told).otherwise(resolution)
    return annotated.groupBy("conversation_id").agg(issue.alias("issue"), resolution.alias("resolution"))


def incomplete(messages: DataFrame, annotated: DataFrame) -> DataFrame:
    """Conversations that lack the annotation of some message: what an incremental run has to do."""
    have = annotated.groupBy("conversation_id").agg(F.countDistinct("message_id").alias("have"))
    want = messages.groupBy("conversation_id").agg(F.count("*").alias("want"))
    return want.join(have, "conversation_id", "left").where(F.coalesce("have", F.lit(0)) < F.col("want")).select("conversation_id", "want", F.coalesce("have", F.lit(0)).alias("have"))


def incomplete_outputs(messages: DataFrame, intents: DataFrame, sentiments: DataFrame, summaries: DataFrame, languages: DataFrame) -> DataFrame:
    """``conversation_id`` of the conversations that an incremental run has to annotate.

    Complete is what is in all four outputs, with as many intents, sentiments and message languages as messages.
    ``languages``: a row for each message, like the first two; ``summaries`` one for each conversation.
    """
    out = messages.where("conversation_id is not null").groupBy("conversation_id").agg(F.count("*").alias("want"))
    for k, x in enumerate((intents, sentiments, languages)):
        out = out.join(x.groupBy("conversation_id").agg(F.count("*").alias(f"n{k}")), "conversation_id", "left")
    out = out.join(summaries.select("conversation_id", F.lit(True).alias("told")).distinct(), "conversation_id", "left")
    done = F.col("told") & (F.col("n0") == F.col("want")) & (F.col("n1") == F.col("want")) & (F.col("n2") == F.col("want"))
    return out.where(~F.coalesce(done, F.lit(False))).select("conversation_id")


def coverage(ids: DataFrame, **outputs: DataFrame) -> DataFrame:
    """``output, missing, total``: of the wanted ``conversation_id`` those that each output lacks."""
    want = ids.where("conversation_id is not null").select("conversation_id").distinct()
    rows = None
    for name, x in outputs.items():
        have = x.select("conversation_id").distinct().withColumn("has", F.lit(1))
        one = want.join(have, "conversation_id", "left").agg(F.lit(name).alias("output"), F.count(F.when(F.col("has").isNull(), 1)).alias("missing"), F.count("*").alias("total"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def message_languages(messages: DataFrame, annotations: DataFrame, default: str = T.ENGLISH_LABEL) -> DataFrame:
    """``message_id, languages`` of every message; those without annotation (or with an empty one) have the default."""
    found = annotations.select(F.explode("detected_languages").alias("d")).select("d.message_id", "d.languages").where("message_id is not null")
    found = found.groupBy("message_id").agg(F.max("languages").alias("languages"))
    own = F.when(F.size("languages") > 0, F.col("languages")).otherwise(F.array(F.lit(default)))
    return messages.select("message_id").join(found, "message_id", "left").select("message_id", own.alias("languages"))


def review_status(conversations: DataFrame, approved: DataFrame, annotations: DataFrame, allowed: tuple[str, ...] = DEFAULT_LANGUAGES) -> DataFrame:
    """``conversation_id, status, flags``: approved, else flagged for labels that are not allowed, else pending."""
    bad = F.array_except("languages", F.array(*[F.lit(a) for a in allowed]))
    flags = conversation_languages(annotations).select("conversation_id", bad.alias("flags"))
    yes = approved.select("conversation_id").distinct().withColumn("yes", F.lit(True))
    rows = conversations.select("conversation_id").distinct().join(flags, "conversation_id", "left").join(yes, "conversation_id", "left")
    none = F.array().cast("array<string>")
    status = F.when(F.col("yes"), "approved").when(F.size("flags") > 0, "flagged").otherwise("pending")
    return rows.select("conversation_id", status.alias("status"), F.coalesce("flags", none).alias("flags"))


def shares(rows: DataFrame, key: str, names: list[str]) -> DataFrame:
    """``key, n, percent`` of the given values; equal parts where there are no rows at all."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(x,) for x in names], f"{key} string")
    n = every.join(rows.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))  # one row
    percent = F.when(F.col("total") > 0, 100.0 * F.col("n") / F.col("total")).otherwise(100.0 / len(names))
    return n.crossJoin(F.broadcast(total)).select(key, "n", percent.alias("percent"))


def prompt_lines(messages: DataFrame) -> DataFrame:
    """``conversation_id, ts, ordinal, message_id, line``: every message as a model reads it."""
    line = F.concat(F.lit("["), F.coalesce("message_id", F.lit("")), F.lit("] "), F.upper(F.coalesce("speaker", F.lit("user"))), F.lit(": "), F.coalesce("text", F.lit("")))
    return messages.select("conversation_id", "ts", "ordinal", "message_id", line.alias("line"))


def chat_examples(messages: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """``conversation_id, messages ARRAY<STRUCT<role, content>>``; unknown roles are users, empty conversations absent."""
    role = F.when(F.col("speaker").isin("user", "assistant", "system"), F.col("speaker")).otherwise("user")
    rows = messages.where("conversation_id is not null").withColumn("role", role)
    item = F.struct("ts", "ordinal", "message_id", "role", F.coalesce("text", F.lit("")).alias("content"))
    turns = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    out = rows.groupBy("conversation_id").agg(turns.alias("messages"))
    if system_prompt:
        head = F.array(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")))
        out = out.withColumn("messages", F.concat(head, "messages"))
    return out


def statistics(messages: DataFrame) -> DataFrame:
    """One row: extremes and sums of turns, characters and words per conversation."""
    text = F.coalesce("text", F.lit(""))
    per = messages.groupBy("conversation_id").agg(
        F.count("*").alias("turns"), F.sum(F.length(text)).alias("chars"), F.sum(F.size(T.words(text))).alias("words")
    )
    return per.agg(
        F.count("*").alias("conversations"), F.sum("turns").alias("messages"),
        *[f(c).alias(f"{n}_{c}") for c in ("turns", "chars", "words") for n, f in (("min", F.min), ("max", F.max), ("sum", F.sum))],
        T.token_estimate(F.sum("words")).alias("estimated_tokens"),
    )


def vocabulary_size(texts: DataFrame, column: str = "text") -> DataFrame:
    return texts.select(F.explode(T.words(F.col(column))).alias("w")).agg(F.countDistinct("w").alias("vocabulary_size"), F.count("*").alias("n_words"))


def segments(messages: DataFrame, size: int = 4, overlap: int = 2) -> DataFrame:
    """Sliding windows of turns: ``chunk_id, conversation_id, first_turn, last_turn, start_message_id, end_message_id, content``.

    Every turn is sent to the at most ceil(size / step) windows that hold it, so a window never needs its whole
    conversation; ``size`` must exceed ``overlap``.
    """
    if size <= overlap:
        raise ValueError("size must exceed overlap")
    step = size - overlap
    w = Window.partitionBy("conversation_id").orderBy("ts", "ordinal", "message_id")
    keys = messages.where("conversation_id is not null").select("conversation_id", "ts", "ordinal", "message_id")  # texts stay out of the sort
    turns = keys.withColumn("turn", (F.row_number().over(w) - 1).cast("long")).select("message_id", "turn").join(messages, "message_id")
    first = F.greatest(F.lit(0), F.ceil((F.col("turn") - size + 1) / step)).cast("long")
    placed = turns.withColumn("chunk", F.explode(F.sequence(first, F.floor(F.col("turn") / step)))).where(F.col("turn") - F.col("chunk") * step < size)
    speaker = F.coalesce("speaker", F.lit("user"))
    line = F.concat(F.upper(F.substring(speaker, 1, 1)), F.lower(F.substr(speaker, F.lit(2))), F.lit(": "), F.coalesce("text", F.lit("")))
    held = F.array_sort(F.collect_list(F.struct("turn", "message_id", line.alias("line"))))
    return (
        placed.groupBy("conversation_id", "chunk")
        .agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), held.alias("h"))
        .select(
            F.concat("conversation_id", F.lit("_chunk_"), F.col("chunk").cast("string")).alias("chunk_id"), "conversation_id", "first_turn", "last_turn",
            F.element_at("h", 1)["message_id"].alias("start_message_id"), F.element_at("h", -1)["message_id"].alias("end_message_id"),
            F.array_join(F.transform("h", lambda x: x["line"]), "\n").alias("content"),
        )
    )


def knowledge_facts(messages: DataFrame) -> DataFrame:
    """``chunk_id, conversation_id, message_id, reference_type, value``, numbered within the conversation."""
    found = messages.where("conversation_id is not null").select("conversation_id", "ts", "ordinal", "message_id", F.posexplode(T.facts(F.col("text"))).alias("pos", "f"))
    w = Window.partitionBy("conversation_id").orderBy("ts", "ordinal", "message_id", "pos")
    return found.withColumn("k", F.row_number().over(w) - 1).select(
        F.concat("conversation_id", F.lit("_fact_"), F.col("k").cast("string")).alias("chunk_id"), "conversation_id", "message_id", F.col("f.kind").alias("reference_type"), F.col("f.value").alias("value")
    )


def translation_hash(messages: DataFrame) -> DataFrame:
    """``conversation_id, text_hash``: SHA-256 of the texts in order, joined by ``|``; null texts are empty.

    The texts of a conversation stream through one hash, so none of them is held whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, h = None, None
        for batch in batches:
            done = []
            for c, text in zip(batch["conversation_id"], batch["text"]):
                if c != key:
                    if h is not None:
                        done.append((key, h.hexdigest()))
                    key, h = c, hashlib.sha256()
                else:
                    h.update(b"|")
                h.update(text.encode("utf-8"))
            yield pd.DataFrame(done, columns=["conversation_id", "text_hash"], dtype=str)
        if h is not None:
            yield pd.DataFrame([(key, h.hexdigest())], columns=["conversation_id", "text_hash"])

    rows = messages.where("conversation_id is not null").select("conversation_id", "ts", "ordinal", "message_id", F.coalesce("text", F.lit("")).alias("text"))
    return whole_groups(rows, "conversation_id", "ts", "ordinal", "message_id").mapInPandas(run, "conversation_id string, text_hash string")


def regional(messages: DataFrame, languages: DataFrame) -> DataFrame:
    """Messages with a label other than English (``languages``: ``message_id, languages``)."""
    foreign = languages.where(F.exists("languages", lambda x: x != T.ENGLISH_LABEL)).select("message_id").distinct()
    return messages.join(foreign, "message_id", "left_semi")


def apply_texts(messages: DataFrame, new: DataFrame) -> DataFrame:
    """``messages`` with the texts of ``new`` (``message_id, text``; blank or null ones change nothing)."""
    told = new.where("text is not null and text <> ''").groupBy("message_id").agg(F.max("text").alias("__new"))
    return messages.join(told, "message_id", "left").withColumn("text", F.coalesce("__new", "text")).drop("__new")


def renewed_ledger(ledger: DataFrame, hashes: DataFrame) -> DataFrame:
    """The ledger with the new hashes in place of the old ones of the same conversations."""
    kept = ledger.select("conversation_id", "text_hash").join(hashes.select("conversation_id"), "conversation_id", "left_anti")
    return kept.unionByName(hashes.select("conversation_id", "text_hash"))


def changed(hashes: DataFrame, ledger: DataFrame) -> DataFrame:
    """Conversations whose hash is not the one in the ledger."""
    old = ledger.select("conversation_id", F.col("text_hash").alias("__old"))
    return hashes.join(old, "conversation_id", "left").where(~F.col("text_hash").eqNullSafe(F.col("__old"))).drop("__old")


def update_roles(messages: DataFrame, roles: DataFrame) -> DataFrame:
    """``messages`` with ``speaker`` replaced where ``roles`` (``message_id, speaker``) has another."""
    new = roles.groupBy("message_id").agg(F.min("speaker").alias("__new"))
    return messages.join(new, "message_id", "left").withColumn("speaker", F.coalesce("__new", "speaker")).drop("__new")


def metric_diff(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Full outer comparison of two ``metric, value`` tables; a missing metric counts 0."""
    a, b = v1.select("metric", F.col("value").alias("v1")), v2.select("metric", F.col("value").alias("v2"))
    z = F.lit(0)
    return a.join(b, "metric", "full").select("metric", F.coalesce("v1", z).alias("v1"), F.coalesce("v2", z).alias("v2"), (F.coalesce("v2", z) - F.coalesce("v1", z)).alias("delta"))


def participants(raw: Column) -> Column:
    """Name and address of an address header separately, else the value itself; no blanks, no repeats, sorted."""
    m = lambda k: T.strip(F.regexp_extract(raw, r"^(.*?)<([^<>]+)>\s*$", k))
    both = F.when(raw.rlike(r"<[^<>]+>\s*$"), F.array(F.regexp_replace(m(1), '^"|"$', ""), m(2))).otherwise(F.array(T.strip(raw)))
    return F.array_sort(F.array_distinct(F.filter(both, lambda x: x != "")))
