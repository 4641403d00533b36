"""Raw mail and chat rows to canonical messages: ids, thread keys, roles, times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import textops as T
from threadloom.functions import timestamps as TS
from threadloom.sources import chat_logs

DEFAULT_DOMAINS = ("shop.com",)


def thread_key(subject: Column, prefix: str = "email_thread_") -> Column:
    """Prefix and MD5 of the lower-case subject without one reply or forward mark; blank subjects share a key."""
    bare = T.strip(F.regexp_replace(F.lower(F.coalesce(subject, F.lit(""))), r"^(re|fwd|fw|reply|forward):\s*", ""))
    return F.concat(F.lit(prefix), F.md5(F.when(bare == "", "no-subject").otherwise(bare)))


def mail_role(sender: Column, agents: list[str], domains: tuple[str, ...] = DEFAULT_DOMAINS) -> Column:
    """Assistant if name or address is an agent's or the address is in a company domain (or below it), else user."""
    low = F.lower(F.coalesce(sender, F.lit("")))
    address = T.strip(F.when(low.contains("<"), F.regexp_extract(low, r"<([^<>]*)>", 1)).otherwise(low))
    name = T.strip(F.regexp_replace(F.regexp_replace(low, r"<[^<>]*>", ""), '^\\s*"|"\\s*$', ""))
    known = [a.lower().strip() for a in agents]
    out = address.isin(known) | name.isin(known) if known else F.lit(False)
    for d in domains:
        out = out | address.endswith(f"@{d.lower()}") | address.endswith(f".{d.lower()}")
    return F.when(out, "assistant").otherwise("user")


def mail_time(date: Column, now: Column) -> Column:
    """UTC instant of a mail's Date header; without a zone UTC; ``now`` where there is none."""
    us = TS.let(TS.parse_fields(date), lambda p: TS.instant_us(p, F.lit("UTC"), F.lit("dmy")))
    return F.coalesce(F.timestamp_micros(us), now)


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def normalize_mail(raw: DataFrame, now: Column, agents: list[str] = (), domains: tuple[str, ...] = DEFAULT_DOMAINS) -> DataFrame:
    """From ``raw_name, headers, body``; of mails with one id the last name wins."""
    h = F.col("headers")
    key = F.when(F.coalesce(h["Message-ID"], F.lit("")) != "", h["Message-ID"]).otherwise(F.col("raw_name"))
    ts = mail_time(h["Date"], now)
    rows = raw.select(
        F.concat(F.lit("gmail_msg_"), F.md5(key)).alias("message_id"), thread_key(h["Subject"]).alias("conversation_id"), F.lit("gmail").alias("source"),
        iso(ts).alias("timestamp"), mail_role(h["From"], list(agents), domains).alias("speaker"), F.col("body").alias("text"), F.lit(0).cast("long").alias("ordinal"),
        F.create_map(F.lit("raw_speaker_name"), h["From"], F.lit("subject"), h["Subject"], F.lit("email_message_id"), h["Message-ID"]).alias("metadata"), "raw_name",
    )
    return last_wins(rows)


def normalize_chat(parsed: DataFrame, now: Column, agents: list[str] = ()) -> DataFrame:
    """From ``file, ordinal, raw_date, raw_time, sender, text``."""
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    key = F.concat_ws("_", "sender", "raw_date", "raw_time", F.substring("text", 1, 100), F.col("ordinal").cast("string"))
    known = [a.lower().strip() for a in agents] or ["support agent"]
    rows = parsed.select(
        F.concat(F.lit("whatsapp_msg_"), F.md5(key)).alias("message_id"), F.concat(F.lit("whatsapp_chat_"), F.md5(F.concat(F.lit("whatsapp_"), stem, F.lit(".json")))).alias("conversation_id"),
        F.lit("whatsapp").alias("source"), iso(chat_logs.timestamp(F.col("raw_date"), F.col("raw_time"), now)).alias("timestamp"),
        F.when(F.lower(T.strip(F.col("sender"))).isin(known), "assistant").otherwise("user").alias("speaker"), "text", "ordinal",
        F.create_map(F.lit("raw_speaker_name"), F.col("sender")).alias("metadata"), F.col("file").alias("raw_name"),
    )
    return last_wins(rows)


def unified(messages: DataFrame) -> DataFrame:
    """The four fields (and the key) that unified conversations carry, without the metadata of the sources."""
    return messages.select("conversation_id", "message_id", "timestamp", "speaker", "text")


def last_wins(rows: DataFrame) -> DataFrame:
    cols = [c for c in rows.columns if c not in ("message_id", "metadata")]
    entries = F.map_entries("metadata").alias("metadata")
    best = F.max(F.struct("raw_name", "ordinal", *[c for c in cols if c not in ("raw_name", "ordinal")], entries)).alias("r")
    out = rows.groupBy("message_id").agg(best).select("message_id", "r.*")
    return out.withColumn("metadata", F.map_from_entries("metadata")).drop("raw_name")
