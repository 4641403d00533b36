"""Rebuilding conversations from message rows.

Method.  Messages that carry no conversation id are attached to the others as connected components over reply
and quote links, found by alternating large-star and small-star joins; then every conversation is ordered by
instant and validated.  An id that a message states is never overruled: a component gives its id only to those
of its messages that have none, and only if all stated ids of the component agree; one that states none is a
conversation under its smallest message id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.instants import message_instants
from threadloom.session import cut_lineage, small

# Spellings of the roles, lower case without outer blanks.
ROLE_WORDS = {
    "user": ["user", "customer", "client", "kunde", "kundin", "buyer", "guest"],
    "assistant": ["assistant", "agent", "support", "bot", "helpdesk", "operator", "representative"],
    "system": ["system"],
}


def large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest node of its neighbourhood (itself included)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return (
        linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node of the component) for every node of an edge ``u, v`` (strings).

    Alternates both stars until a round changes nothing, that is until every node points straight at its component;
    their number grows with the logarithm of the longest path.  Self links and repeated links are allowed, null ends
    are ignored; an empty table gives an empty result.  Rounds are cut by checkpoints; no task or driver gets a whole
    component.
    """
    nodes = edges.where("u is not null and v is not null").select(F.col("u").cast("string").alias("u"), F.col("v").cast("string").alias("v"))
    nodes = cut_lineage(nodes.distinct())
    now = nodes.where("u <> v")
    state, changed = None, not now.isEmpty()
    while changed:
        now = cut_lineage(small_star(large_star(now)))
        signature = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        changed, state = signature != state, signature
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    everyone = nodes.select(F.col("u").alias("node")).union(nodes.select(F.col("v").alias("node"))).distinct()
    return everyone.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def distinct_messages(messages: DataFrame) -> DataFrame:
    """What is needed of each distinct message, without its text; read several times, so materialised."""
    meta = F.col("metadata")
    blank = F.coalesce(F.regexp_replace("text", r"[\s\u00a0\u200b\ufeff]+", ""), F.lit("")) == ""
    return cut_lineage(
        messages.where("message_id is not null")
        .groupBy("message_id")
        .agg(
            F.first("conversation_id", True).alias("conversation_id"), F.min("ordinal").alias("ordinal"), F.first("speaker", True).alias("speaker"),
            F.first(meta["raw_speaker_name"], True).alias("raw_speaker_name"), F.max(~blank).alias("has_text"),
            F.first(meta["in_reply_to"], True).alias("in_reply_to"), F.first(F.when(meta["email_message_id"] != "", meta["email_message_id"]), True).alias("mail_id"),
        )
    )


def quote_links(messages: DataFrame, ids: DataFrame, min_words: int = 12) -> DataFrame:
    """Links between messages without an id and the messages they repeat or belong to: ``u, v``.

    Two messages of an account are linked through a long line (a quoted one, its marks removed) that both hold, or
    through a stated reply (``in_reply_to`` in the metadata naming an ``email_message_id``).  The links of a line go
    to its first holder only, so a line that thousands repeat gives as many links, not their square.  A line that messages
    of several stated conversations hold is boilerplate and links nothing.  Texts are cut to lines where they are read, and
    only lines that a message without an id holds are shuffled.
    """
    lines = messages.where("text is not null and message_id is not null").select(
        "message_id", "account_id", "conversation_id", F.explode(F.split("text", r"\r?\n")).alias("line")
    )
    norm = F.trim(F.regexp_replace(F.regexp_replace("line", r"^[>|\s]+", ""), r"\s+", " "))
    keyed = lines.where(F.length("line") > 2 * min_words).select("message_id", "conversation_id", F.xxhash64("account_id", norm).alias("h"), norm.alias("line"))
    keyed = keyed.where(F.size(F.split("line", " ")) >= min_words)
    sought = cut_lineage(keyed.where("conversation_id is null").select("h").distinct())
    keyed = keyed.join(small(sought), "h", "left_semi")
    keyed = cut_lineage(
        keyed.groupBy("h", "line", "message_id").agg(
            F.min("conversation_id").alias("least"), F.max("conversation_id").alias("most"), F.bool_or(F.col("conversation_id").isNull()).alias("lost")
        )
    )
    held = keyed.groupBy("h", "line").agg(F.min("message_id").alias("v"), F.bool_or("lost").alias("any_lost"), F.min("least").alias("least"), F.max("most").alias("most"))
    held = held.where("any_lost and (least is null or least = most)").select("h", "line", "v")
    by_line = keyed.join(held, ["h", "line"]).where("message_id <> v").select(F.col("message_id").alias("u"), "v")
    reply = ids.where("in_reply_to is not null").select(F.col("message_id").alias("u"), F.col("in_reply_to").alias("mail_id"))
    names = ids.where("mail_id is not null").select(F.col("message_id").alias("v"), "mail_id")
    return by_line.union(reply.join(names, "mail_id").select("u", "v")).distinct()


def recover_ids(messages: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``message_id, conversation_id`` of the messages whose missing id their component settles.

    A message's ``ordinal`` is its place in the source file of its conversation, so it can only belong where that
    place is still free.  ``ids``: the ``distinct_messages`` where they are at hand.
    """
    ids = distinct_messages(messages) if ids is None else ids
    if ids.where("conversation_id is null").isEmpty():
        return ids.where("false").select("message_id", "conversation_id")
    parts = cut_lineage(connected_components(quote_links(messages, ids)))
    joined = parts.join(ids.select(F.col("message_id").alias("node"), "conversation_id", "ordinal"), "node")
    settled = joined.groupBy("component").agg(
        F.coalesce(F.min("conversation_id"), F.min("node")).alias("id"), F.max("conversation_id").alias("other"), F.max(F.col("conversation_id").isNull()).alias("lost")
    )
    settled = settled.where("lost and (other is null or id = other)")
    found = joined.where("conversation_id is null").join(settled, "component").select(F.col("node").alias("message_id"), F.col("id").alias("conversation_id"), "ordinal")
    places = ids.where("conversation_id is not null").select("conversation_id", "ordinal")
    return found.join(places, ["conversation_id", "ordinal"], "left_anti").select("message_id", "conversation_id")


def stated_role(speaker: Column) -> Column:
    s = F.lower(F.trim(F.regexp_replace(speaker, r"^\s+|\s+$", "")))
    out = F.lit(None).cast("string")
    for role, words in ROLE_WORDS.items():
        out = F.when(s.isin(words), role).otherwise(out)
    return out


def _name_key(x: Column) -> Column:
    """A raw name as a key: without address, decoration, case and doubled blanks; "Last, First" turned round."""
    bare = F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", " "), r"[^\p{L}\p{M}\s,.'’-]", " ")
    turned = F.regexp_replace(bare, r"^\s*([^,]+),\s*([^,]+?)\s*$", "$2 $1")
    return F.lower(F.trim(F.regexp_replace(turned, r"\s+", " ")))


def _address(x: Column) -> Column:
    return F.lower(F.regexp_extract(x, r"([^\s<>\[\]\"]+@[^\s<>\[\]\"]+)", 1))


def with_roles(messages: DataFrame, agents: DataFrame) -> DataFrame:
    """``messages`` with ``role``: from ``speaker``, else from the raw name; null where neither tells."""
    names = agents.where("agent_name is not null").select(_name_key(F.col("agent_name")).alias("__name"), F.lit(True).alias("__by_name")).distinct()
    mails = agents.where("mail_address is not null").select(F.lower(F.trim("mail_address")).alias("__mail"), F.lit(True).alias("__by_mail")).distinct()
    raw = F.col("raw_speaker_name")
    return (
        messages.withColumn("__name", _name_key(raw))
        .withColumn("__mail", _address(raw))
        .join(small(names), "__name", "left")
        .join(small(mails), "__mail", "left")
        .withColumn(
            "role",
            F.coalesce(
                stated_role(F.col("speaker")),
                F.when(F.coalesce("__by_name", "__by_mail").isNotNull(), "assistant").when(F.length(F.trim(raw)) > 0, "user"),
            ),
        )
        .drop("__name", "__mail", "__by_name", "__by_mail")
    )


def numbered(turns: DataFrame, sizes: DataFrame, split: int) -> DataFrame:
    """``turns`` with ``turn_no`` from 0 in the order of instant, ``ordinal`` and id.

    ``sizes``: ``conversation_id, n``.  Conversations of more than ``split`` turns are sorted by ranges, each range
    numbered on its own and moved by the number of turns before it; so no task gets a whole one.
    """
    place = ["utc_us", F.coalesce("ordinal", F.lit(2**62)), "message_id"]
    long = cut_lineage(sizes.where(F.col("n") > split).select("conversation_id"))
    of = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*place)) - 1
    if long.isEmpty():
        return turns.withColumn("turn_no", of("conversation_id"))
    short = turns.join(long, "conversation_id", "left_anti").withColumn("turn_no", of("conversation_id"))
    ranged = turns.join(long, "conversation_id", "left_semi").repartitionByRange("conversation_id", *place).withColumn("__part", F.spark_partition_id())
    ranged = cut_lineage(ranged)  # the ranges must not be drawn twice
    counts = ranged.groupBy("conversation_id", "__part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conversation_id").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranged = ranged.join(counts.select("conversation_id", "__part", before.alias("__before")), ["conversation_id", "__part"])
    ranged = ranged.withColumn("turn_no", (of("conversation_id", "__part") + F.col("__before")).cast("int"))
    return short.unionByName(ranged.drop("__part", "__before"))


def rebuild(messages: DataFrame, headers: DataFrame, accounts: DataFrame, agents: DataFrame, recover: bool = True, split: int = 1_000_000) -> DataFrame:
    """The turns of the conversations kept: ``conversation_id, turn_no, message_id, role, utc_us``.

    Kept: with a header; the number of distinct messages equals ``total_messages`` unless that is null; every
    message has an instant and a role; an assistant turn follows a user turn.  Turns are the messages whose text
    is not blank, by instant, ``ordinal`` and id.  Of repeated header rows one is used (the largest
    ``total_messages``).  Null ids are recovered from links or left out; other columns are ignored.
    """
    distinct = distinct_messages(messages)
    timed = distinct.drop("in_reply_to", "mail_id").join(message_instants(messages, accounts).select("message_id", "utc_us"), "message_id", "left")
    if recover:
        found = cut_lineage(recover_ids(messages, distinct))
        timed = timed.join(found.withColumnRenamed("conversation_id", "__id"), "message_id", "left").withColumn("conversation_id", F.coalesce("conversation_id", "__id")).drop("__id")
    rows = cut_lineage(with_roles(timed.where("conversation_id is not null"), agents).select("conversation_id", "message_id", "ordinal", "has_text", "role", "utc_us"))
    turn = F.when(F.col("has_text"), F.struct("utc_us", F.coalesce("ordinal", F.lit(2**62)), "message_id"))
    whole = rows.groupBy("conversation_id").agg(
        F.count("*").alias("n"),
        F.bool_and(F.col("utc_us").isNotNull() & F.col("role").isNotNull()).alias("sound"),
        F.min(F.when(F.col("role") == "user", turn)).alias("first_user"),
        F.max(F.when(F.col("role") == "assistant", turn)).alias("last_assistant"),
    )
    head = headers.where("conversation_id is not null").groupBy("conversation_id").agg(F.max("metadata.total_messages").alias("total"))
    kept = whole.join(head, "conversation_id").where(
        F.col("sound") & (F.col("total").isNull() | (F.col("total") == F.col("n"))) & (F.col("last_assistant") > F.col("first_user"))
    )
    kept = cut_lineage(kept.select("conversation_id", "n"))
    turns = rows.where("has_text").join(kept.select("conversation_id"), "conversation_id", "left_semi")
    return numbered(turns, kept, split).select("conversation_id", "turn_no", "message_id", "role", "utc_us")
