"""The whole pipeline as Spark stages with Parquet between them, and its command line.

Stages: ingest, normalize, merge, reconstruct (sessions and validation), clean, anonymize, annotate, translate, export,
rag.  Every stage reads the tables of those before and writes its own, so any of them can be run again alone.  All
tables, lists and reports are reached through the Hadoop file system, so the work folder may lie on any store.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import datasets as D
from threadloom.operators import enrich as E
from threadloom.operators import normalize as N
from threadloom.operators import privacy as P
from threadloom.operators import threads as H
from threadloom.session import get_spark
from threadloom.sources import chat_logs, mail_files, tables

log = logging.getLogger("threadloom")
STAGES = ("ingest", "normalize", "merge", "reconstruct", "clean", "anonymize", "annotate", "translate", "export", "rag")
DEFAULTS = {
    "mail_dir": None, "mbox": None, "chat_dir": None, "work_dir": "work", "version": "1.0.0", "agents": [], "agents_path": None, "company_domains": ["shop.com"],
    "gap_threshold_seconds": 86400, "chunk_size_turns": 4, "chunk_overlap_turns": 2, "system_prompt": None, "approved_path": None, "excluded_path": None,
    "allowed_languages_path": None, "name_source": "speaker_compat", "now": None,
}
LEDGER = "conversation_id string, text_hash string"
SUMMARY = "conversation_id string, issue string, resolution string"
ANNOTATION = "conversation_id string, message_id string, label string, sentiment string, score double, languages array<string>"


class Pipeline:
    """``models``: functions that make a model in a worker, by stage (``annotate``, ``anonymize``, ``translate``)."""

    def __init__(self, spark: SparkSession, models: dict[str, Callable[[], object]] | None = None, **config: object) -> None:
        self.spark, self.models = spark, models or {}
        self.c = {**DEFAULTS, **config}
        self.now = F.lit(self.c["now"] or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")

    def path(self, name: str) -> str:
        return os.path.join(str(self.c["work_dir"]), name)

    def has(self, name: str) -> bool:
        return tables.exists(self.spark, self.path(name))

    def table(self, name: str, schema: str | None = None) -> DataFrame:
        """A stage's table; with a schema an empty one where it does not exist yet."""
        return self.spark.createDataFrame([], schema) if schema and not self.has(name) else self.spark.read.parquet(self.path(name))

    def save(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(self.path(name))

    def report(self, content: dict, path: str) -> None:
        tables.write_text(self.spark, json.dumps(content, ensure_ascii=False, indent=2, default=str), path)

    @property
    def out(self) -> str:
        return tables.version_dir(self.path("datasets"), str(self.c["version"]))

    def agents(self) -> list[str]:
        """The configured agents, unless a list of its own replaces them."""
        own = tables.gate_list(self.spark, str(self.c["agents_path"] or self.path("agents.json")))
        return list(self.c["agents"]) if own is None else own

    def run(self, step: str | None = None) -> None:
        for stage in [step] if step else STAGES:
            log.info("stage %s", stage)
            getattr(self, stage)()

    def ingest(self) -> None:
        mails = []
        if self.c["mail_dir"]:
            mails.append(mail_files.read_eml(self.spark, str(self.c["mail_dir"])))
        if self.c["mbox"]:
            mails.append(mail_files.read_mbox(self.spark, str(self.c["mbox"])))
        if mails:
            self.save(mail_files.last_per_name(mails[0] if len(mails) == 1 else mails[0].unionByName(mails[1])), "raw_mail")
        if self.c["chat_dir"]:
            self.save(chat_logs.parse(chat_logs.read_logs(self.spark, str(self.c["chat_dir"]))), "raw_chat")

    def normalize(self) -> None:
        parts = []
        if self.has("raw_mail"):
            parts.append(N.normalize_mail(self.table("raw_mail"), self.now, self.agents(), tuple(self.c["company_domains"])))
        if self.has("raw_chat"):
            parts.append(N.normalize_chat(self.table("raw_chat"), self.now, self.agents()))
        if not parts:
            raise FileNotFoundError(f"no raw table under {self.c['work_dir']}: run ingest first")
        self.save(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True), "messages")

    def merge(self) -> None:
        m = self.table("messages").where("conversation_id is not null and conversation_id <> ''")
        self.save(m.withColumn("ts", F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))), "unified")

    def reconstruct(self) -> None:
        m = self.table("unified").withColumn("original_conversation_id", F.col("conversation_id"))
        s = H.sessionize(m, "conversation_id", F.unix_timestamp("ts"), int(self.c["gap_threshold_seconds"]), "ordinal", "message_id")
        self.save(s.withColumn("conversation_id", F.col("session_id")).drop("session_id"), "sessions")
        self.save(H.session_headers(self.table("sessions")), "session_headers")
        found = H.sentences(H.violations(self.table("sessions")))
        self.save(found.orderBy("conversation_id", "message_id", "rule"), "violations")
        self.report(H.validation_report(self.table("sessions")).first().asDict(), self.path("validation_report.json"))

    def clean(self) -> None:
        self.save(H.clean(self.table("sessions")), "cleaned")
        self.save(H.cleaned_headers(self.table("sessions"), self.table("cleaned")), "cleaned_headers")

    def anonymize(self) -> None:
        m = self.table("cleaned")
        after = P.scrubbed(m, P.participants(m, source=str(self.c["name_source"])))
        if make := self.models.get("anonymize"):
            after = P.decided(after, E.decisions(after, make))
        else:
            after = after.withColumn("nsfw", F.lit(0).cast("long")).withColumn("private", F.lit(0).cast("long"))
        self.save(after, "anonymized")
        counted = P.counts(self.table("anonymized")).join(self.table("cleaned_headers").select("conversation_id"), "conversation_id", "right")
        self.save(counted.na.fill(0, list(P.KINDS)), "privacy_counts")
        counted = self.table("privacy_counts")
        self.save(P.details(counted).orderBy("conversation_id"), "privacy_details")
        self.report({"stats": P.totals(counted).first().asDict(), "details": self.path("privacy_details")}, self.path("privacy_report.json"))

    def gated(self, table: str = "anonymized") -> DataFrame:
        """The approved and not excluded rows; a list that exists but cannot be read lets nothing pass."""
        m = self.table(table)
        for key, gate in (("approved_path", D.only), ("excluded_path", D.without)):
            ids = tables.gate_list(self.spark, str(self.c[key])) if self.c[key] else None
            if ids is None:
                continue
            if not ids and key == "excluded_path" and tables.read_text(self.spark, str(self.c[key])).strip() not in ("[]", "[ ]"):
                raise ValueError(f"{self.c[key]} is no list of ids")
            m = gate(m, tables.ids_frame(self.spark, ids))
        return m

    def allowed(self) -> list[str]:
        ids = tables.gate_list(self.spark, str(self.c["allowed_languages_path"])) if self.c["allowed_languages_path"] else None
        return list(D.DEFAULT_LANGUAGES) if ids is None else ids

    def annotate(self) -> None:
        """Only conversations that some output lacks are annotated; what is there already is kept."""
        cached, told = self.table("annotations", ANNOTATION), self.table("summaries", SUMMARY)
        rows, summaries, counters = E.annotate_incremental(self.gated(), cached, told, self.models.get("annotate"))
        tables.write_replacing(rows, self.path("annotations"))
        tables.write_replacing(summaries, self.path("summaries"))
        rows, summaries = self.table("annotations"), self.table("summaries")
        for name, cols in (("intents", ("label",)), ("sentiments", ("sentiment", "score"))):
            tables.write_json_lines(rows.select("conversation_id", "message_id", *cols).orderBy("conversation_id", "message_id"), os.path.join(self.out, name))
        tables.write_json_lines(summaries.select("conversation_id", F.struct("issue", "resolution").alias("summary")).orderBy("conversation_id"), os.path.join(self.out, "summaries"))
        tables.write_json_lines(self.detected().orderBy("conversation_id"), os.path.join(self.out, "languages"))
        n = rows.agg(F.count("label").alias("intent_labels"), F.count("sentiment").alias("sentiment_labels"), F.countDistinct("conversation_id").alias("languages")).first().asDict()
        self.report({**counters, **n, "summaries": summaries.count()}, os.path.join(self.out, "annotation_run.json"))

    def detected(self) -> DataFrame:
        return self.table("annotations").groupBy("conversation_id").agg(F.array_sort(F.collect_list(F.struct("message_id", "languages"))).alias("detected_languages"))

    def translate(self) -> None:
        make = self.models.get("translate", E.Offline)
        done, ledger = E.translate(self.table("anonymized"), self.table("annotations", ANNOTATION).select("message_id", "languages"), self.table("translation_ledger", LEDGER), make)
        tables.write_replacing(done, self.path("anonymized"))
        tables.write_replacing(ledger.orderBy("conversation_id"), self.path("translation_ledger"))

    def export(self) -> None:
        m = self.gated()
        if self.has("annotations"):
            m = D.language_gate(m, self.detected(), tuple(self.allowed()))
        m = m.persist()
        examples = D.chat_examples(m, self.c["system_prompt"])
        tables.write_json_lines(examples.orderBy("conversation_id"), os.path.join(self.out, "train"))
        stats = {**D.statistics(m).first().asDict(), **D.vocabulary_size(m).first().asDict()}
        n = max(stats["conversations"] or 0, 1)
        stats |= {f"avg_{k}": round((stats[f"sum_{k}"] or 0) / n, 2) for k in ("turns", "chars", "words")}
        self.report({k: v or 0 for k, v in stats.items()}, os.path.join(self.out, "statistics.json"))
        sums = P.totals(P.counts(m)).first().asDict()
        sources = {r[0]: r[1] for r in m.groupBy("source").agg(F.countDistinct("conversation_id")).collect()}  # a handful of sources
        meta = {"version": self.c["version"], "total_conversations": sums.pop("conversations"), "total_messages": m.count(), "source_distribution": sources, "anonymization_summary": sums}
        self.report(meta, os.path.join(self.out, "metadata.json"))
        m.unpersist()

    def rag(self) -> None:
        m = self.gated()
        chunks = D.segments(m, int(self.c["chunk_size_turns"]), int(self.c["chunk_overlap_turns"]))
        tables.write_json_lines(chunks.withColumn("type", F.lit("conversation_segment")).orderBy("chunk_id"), os.path.join(self.out, "rag_segments"))
        tables.write_json_lines(D.knowledge_facts(m).withColumn("type", F.lit("knowledge_fact")).orderBy("chunk_id"), os.path.join(self.out, "rag_facts"))
        n = {k: self.spark.read.text(os.path.join(self.out, k)).count() for k in ("rag_segments", "rag_facts")}
        self.report({"conversations": m.select("conversation_id").distinct().count(), **n, "chunks": sum(n.values())}, os.path.join(self.out, "rag_run.json"))


def diff(base: str, v1: str, v2: str) -> dict:
    """Metrics of two dataset versions side by side; a missing report counts as zeros, a missing version raises."""
    reports = []
    for v in (v1, v2):
        d = tables.version_dir(base, v)
        if not os.path.isdir(d):
            raise FileNotFoundError(d)
        metrics: dict[str, float] = {}
        for name in ("statistics.json", "metadata.json"):
            try:
                with open(os.path.join(d, name), encoding="utf-8") as f:
                    x = json.load(f)
            except (OSError, ValueError):
                x = {}
            metrics |= {k: y for k, y in {**x, **x.get("anonymization_summary", {})}.items() if isinstance(y, (int, float))}
        reports.append(metrics)
    a, b = reports
    return {k: {"v1": a.get(k, 0), "v2": b.get(k, 0), "delta": b.get(k, 0) - a.get(k, 0)} for k in sorted({*a, *b})}


def as_table(found: dict) -> str:
    lines = ["| metric | v1 | v2 | delta |", "|-|-|-|-|"]
    return "\n".join([*lines, *(f"| {k} | {x['v1']} | {x['v2']} | {x['delta']:+} |" for k, x in found.items())])


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="threadloom")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run")
    r.add_argument("--config", required=True)
    r.add_argument("--step", choices=STAGES)
    r.add_argument("--verbose", action="store_true")
    d = sub.add_parser("diff")
    d.add_argument("--base", default="work/datasets")
    d.add_argument("--v1", required=True)
    d.add_argument("--v2", required=True)
    d.add_argument("--format", choices=("text", "json"), default="text")
    a = p.parse_args(args)
    if a.command == "diff":
        found = diff(a.base, a.v1, a.v2)
        print(json.dumps(found, indent=2) if a.format == "json" else as_table(found))
        return
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    with open(a.config, encoding="utf-8") as f:
        try:
            import yaml

            config = yaml.safe_load(f)
        except ImportError:
            config = json.load(f)
    tables.load_env()
    Pipeline(get_spark(), **(config or {})).run(a.step)


if __name__ == "__main__":
    main()
