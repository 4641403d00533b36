"""Queries of the operators for language-model training data, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import conversations, encoding, entities, language, mail, packing, pii, subjects
from threadloom.session import cut_lineage, read_table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = entities.prepare(read_table(spark, sf_dir, "crm_profiles"), 0, "profile_id", F.col("metadata.customer_name"))
    contacts = entities.prepare(read_table(spark, sf_dir, "contacts"), 1, "contact_id", F.col("metadata.raw_speaker_name"))
    return entities.match(profiles, contacts).select(F.col("a").alias("profile_id"), F.col("b").alias("contact_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mail.newly_written(read_table(spark, sf_dir, "messages"))
    return found.select("message_id", F.explode("line_nos").alias("line_no"))


def _judged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``message_id, text``: of mails the newly written lines, of chat messages the whole text."""
    messages = read_table(spark, sf_dir, "messages")
    mails = mail.newly_written(messages).select("message_id", F.array_join("lines", "\n").alias("text"))
    chats = (
        messages.where((F.col("source") != "gmail") & F.col("text").isNotNull() & F.col("message_id").isNotNull())
        .groupBy("message_id")
        .agg(F.first("text", ignorenulls=True).alias("text"))
    )
    return mails.unionByName(chats)


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_table(spark, sf_dir, "messages")
    labels = language.label_codes(read_table(spark, sf_dir, "language_annotations"))
    single = labels.where(F.size("codes") == 1).select("message_id", F.col("codes")[0].alias("lang"))
    chats = messages.where(F.col("source") != "gmail").select("message_id", "text")
    model = language.fit_model(chats, single)
    return language.detect(_judged_texts(spark, sf_dir).join(labels, "message_id", "left"), model)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _languages(spark, sf_dir)
    enough = F.size(F.filter(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " "), lambda w: w.rlike(r"[\p{L}\p{N}]"))) >= 4
    codes = F.array_sort(F.array_distinct(F.transform("segments", lambda s: s["lang"])))
    wrong = F.col("codes").isNull() | (F.col("codes") != codes)
    return (
        found.where((F.size("segments") > 0) & enough & wrong)
        .select("message_id", F.explode("segments").alias("s"))
        .select("message_id", "s.seg_no", "s.lang")
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [read_table(spark, sf_dir, t) for t in ("messages", "conversation", "accounts", "agents")]
    return conversations.rebuild(*tables).select("conversation_id", "turn_no", "message_id", "role")


def _name_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [
        ("agents", F.col("agent_name")), ("contacts", F.col("metadata.raw_speaker_name")), ("crm_profiles", F.col("metadata.customer_name")),
        ("conversation", F.col("metadata.customer_name")), ("messages", F.col("metadata")["raw_speaker_name"]),
    ]
    frames = [read_table(spark, sf_dir, t).select(c.alias("name")) for t, c in fields]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_table(spark, sf_dir, "messages").where(F.col("text").isNotNull())
    rows = messages.select("message_id", "text", F.col("metadata")["raw_speaker_name"].alias("speaker_name"))
    firms = pii.firm_words(read_table(spark, sf_dir, "agents").select(F.col("mail_address").alias("address")))
    found = pii.find_pii(rows, *pii.learn_all_names(_name_fields(spark, sf_dir), firms=firms))
    return (
        found.select("message_id", F.explode("spans").alias("s"))
        .select("message_id", "s.kind", "s.pii_text")
        .where(F.col("kind").isin("email", "phone", "id_number", "address", "name"))
        .distinct()
    )


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode(read_table(spark, sf_dir, "documents"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The round trip: every text again (null as the empty text)."""
    return encoding.decode(encoding.encode(read_table(spark, sf_dir, "documents")))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = encoding.encode(read_table(spark, sf_dir, "documents")).select("doc_id", F.size("ids").alias("n_tokens"))
    return packing.fill_containers(cut_lineage(sizes), read_table(spark, sf_dir, "container_sizes"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = [r[0] for r in read_table(spark, sf_dir, "subject_areas").select("subject").distinct().orderBy("subject").collect()]
    found = subjects.propagate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "subject_labels"), areas)
    return found.select("doc_id", "subject")


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p7_found": p7_found, "p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_containers": p9_containers, "p10_found": p10_found}
SQL: dict[str, str] = {"p8_decoded": "select doc_id, coalesce(text, '') as text from documents"}
