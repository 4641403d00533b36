"""Scrubbing of whole conversations: participants' names, patterns, decisions of a model, counts and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import textops as T

#: Kinds in the order in which they are scrubbed, which the results depend on, and those that only a model tells.
PATTERNS = {"emails": (T.EMAIL, T.scrub_email), "phones": (T.PHONE, T.scrub_phone), "addresses": (T.ADDRESS, T.scrub_address), "passwords": (T.CREDENTIAL, T.scrub_credentials)}
KINDS = (*PATTERNS, "names", "nsfw", "private")


def name_forms(raw: Column) -> Column:
    """A name and its words of at least three letters, without the address behind it; none for a bare number."""
    bare = T.strip(F.when(raw.contains("<") & raw.contains(">"), F.substring_index(raw, "<", 1)).otherwise(raw))
    words = F.filter(F.split(bare, r"[\s,]+"), lambda w: F.length(w) >= 3)
    usable = bare.isNotNull() & (bare != "") & ~bare.rlike(r"^\+?[\d\s\-()]+\z")
    return F.when(usable, F.array_distinct(F.concat(F.array(bare), words))).otherwise(F.array().cast("array<string>"))


def participants(messages: DataFrame, headers: DataFrame | None = None, source: str = "raw_name") -> DataFrame:
    """``conversation_id, names``: all that take part, by the headers' metadata and by every message's sender.

    ``source``: ``raw_name`` takes the sender's own name where there is one, else the role; ``speaker_compat`` only
    the role, which is what is left of it in unified conversations.
    """
    own = F.col("speaker") if source == "speaker_compat" else F.coalesce(F.nullif(F.col("metadata")["raw_speaker_name"], F.lit("")), F.col("speaker"))
    rows = messages.select("conversation_id", F.explode(name_forms(own)).alias("name"))
    if headers is not None:
        fields = headers.schema["metadata"].dataType
        known = [f for f in ("raw_speaker_name", "agent_name", "customer_name") if not hasattr(fields, "names") or f in fields.names]
        if known:
            told = F.explode(F.flatten(F.array(*[name_forms(F.col("metadata")[f]) for f in known]))).alias("name")
            rows = rows.unionByName(headers.select("conversation_id", told))
    return rows.where("conversation_id is not null").groupBy("conversation_id").agg(F.array_sort(F.collect_set("name")).alias("names"))


def scrubbed(messages: DataFrame, names: DataFrame) -> DataFrame:
    """``messages`` with scrubbed ``text`` and the number of replacements of every kind of pattern, and of names."""
    out = messages.join(names, "conversation_id", "left").withColumn("text", F.coalesce("text", F.lit("")))
    for kind, (pattern, replace) in PATTERNS.items():
        out = out.withColumn(kind, F.regexp_count("text", F.lit(pattern)).cast("long")).withColumn("text", replace(F.col("text")))
    marks = lambda c: F.regexp_count(c, F.lit(r"\[NAME\]")).cast("long")
    out = out.withColumn("__new", T.scrub_names(F.col("text"), F.coalesce("names", F.array().cast("array<string>"))))
    return out.withColumn("names", marks("__new") - marks("text")).withColumn("text", F.col("__new")).drop("__new")


def decided(messages: DataFrame, decisions: DataFrame) -> DataFrame:
    """A model's decisions (``message_id, is_nsfw, is_private, scrubbed_text``) over scrubbed messages; 0 or 1 per message and kind."""
    one = decisions.groupBy("message_id").agg(
        F.max(F.coalesce("is_nsfw", F.lit(False))).alias("__n"), F.max(F.coalesce("is_private", F.lit(False))).alias("__p"), F.max(F.nullif("scrubbed_text", F.lit(""))).alias("__t")
    )
    told = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long"))
    out = messages.join(one, "message_id", "left").withColumn("nsfw", told("__n")).withColumn("private", told("__p"))
    return out.withColumn("text", F.coalesce("__t", "text")).drop("__n", "__p", "__t")


def counts(messages: DataFrame) -> DataFrame:
    """Per conversation the replacements of every kind; kinds that were not looked for count 0."""
    have = [F.coalesce(F.sum(k), F.lit(0)).alias(k) if k in messages.columns else F.lit(0).cast("long").alias(k) for k in KINDS]
    return messages.groupBy("conversation_id").agg(*have)


def totals(counted: DataFrame) -> DataFrame:
    return counted.agg(F.count("*").alias("conversations"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in KINDS])


def details(counted: DataFrame) -> DataFrame:
    """The conversations in which anything was replaced."""
    return counted.where(F.greatest(*[F.col(k) for k in KINDS]) > 0)
