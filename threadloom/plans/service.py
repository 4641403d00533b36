"""What a front end asks of the pipeline, as plain methods; each one composes operators and control lists."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators import datasets as D
from threadloom.operators import threads as H
from threadloom.plans.pipeline import Pipeline, diff
from threadloom.sources import tables

TABLES = (
    "raw_mail", "raw_chat", "messages", "unified", "sessions", "session_headers", "violations", "cleaned", "cleaned_headers", "anonymized", "privacy_counts", "privacy_details",
    "annotations", "summaries", "translation_ledger",
)
LISTS = ("approved.json", "excluded.json", "allowed_languages.json", "agents.json", "validation_report.json", "privacy_report.json")


class Service(Pipeline):
    def status(self) -> dict:
        """Configuration, rows of each stage's table, dataset versions."""
        rows = {t: self.table(t).count() for t in TABLES if self.has(t)}
        return {"config": dict(self.c), "rows": rows, "versions": [v for v in tables.children(self.spark, self.path("datasets")) if v.startswith("v")]}

    def _change(self, key: str, add: list[str] = (), remove: list[str] = (), start: list[str] = ()) -> None:
        """Add to and remove from a control list, which is made where it is missing."""
        self.c[key] = self._list(key)
        now = tables.gate_list(self.spark, self.c[key])
        now = [x for x in (list(start) if now is None else now) if x not in set(remove)]
        now += [x for x in dict.fromkeys(add) if x not in now]
        tables.write_text(self.spark, json.dumps(now, ensure_ascii=False, indent=2), self.c[key])

    def _list(self, key: str) -> str:
        return str(self.c[key] or self.path(f"{key.removesuffix('_path')}.json"))

    def approve(self, ids: list[str]) -> None:
        self._change("approved_path", add=ids)
        self._change("excluded_path", remove=ids)

    def approve_all(self) -> None:
        """Every conversation there is, and those approved before; none of them stays excluded."""
        known = [r[0] for r in self.table("anonymized").where("conversation_id is not null").select("conversation_id").distinct().orderBy("conversation_id").collect()]  # the list is a file of ids
        self.approve(known)

    def exclude(self, ids: list[str]) -> None:
        self._change("excluded_path", add=ids)

    def needs_annotation(self) -> bool:
        """Whether a gated conversation lacks some annotation of some message, or its summary."""
        a = self.table("annotations")
        return not D.incomplete_outputs(self.gated(), a, a, self.table("summaries"), a).isEmpty()

    def refresh(self) -> None:
        """After a change of the lists: annotation where something lacks it, then translation and the exports."""
        for stage in [*(["annotate"] if self.needs_annotation() else []), "translate", "export", "rag"]:
            self.run(stage)

    def allow_language(self, language: str, replace_with: str | None = None) -> None:
        """Allow a label in exports, or rewrite it to another in the stored annotations."""
        if replace_with is None:
            self._change("allowed_languages_path", add=[language], start=D.DEFAULT_LANGUAGES)
            return
        swap = F.transform("languages", lambda x: F.when(x == language, replace_with).otherwise(x))
        tables.write_replacing(self.table("annotations").withColumn("languages", swap), self.path("annotations"))

    def assign_roles(self, agents: list[str]) -> None:
        """New agents: roles are read again from the raw senders and replaced in every later table, without re-annotation."""
        tables.write_text(self.spark, json.dumps(agents, ensure_ascii=False, indent=2), str(self.c["agents_path"] or self.path("agents.json")))
        self.normalize()
        roles = self.table("messages").select("message_id", "speaker")
        for t in ("unified", "sessions", "cleaned", "anonymized"):
            if self.has(t):
                tables.write_replacing(D.update_roles(self.table(t), roles), self.path(t))

    def participants(self) -> DataFrame:
        """Names and addresses of all senders, and whether each is an agent."""
        who = self.table("messages").select(F.explode(D.participants(F.col("metadata")["raw_speaker_name"])).alias("participant")).distinct()
        return who.withColumn("is_agent", F.lower(F.trim("participant")).isin([a.lower().strip() for a in self.agents()] or [""]))

    def preview(self, rows: int = 50) -> list[str]:
        """The first lines of the exported examples, in the order of their ids."""
        lines = self.spark.read.text(f"{self.out}/train").withColumn("id", F.get_json_object("value", "$.conversation_id"))
        return [r["value"] for r in lines.orderBy("id").limit(rows).collect()]

    def dataset_details(self, preview: int = 50, first: int = 5) -> dict:
        """Counts by source, language and status, senders, and the first messages of conversations that await approval."""
        m, everything = self.gated(), self.table("anonymized")
        approved = tables.ids_frame(self.spark, tables.gate_list(self.spark, self._list("approved_path")) or [])
        pending = D.without(everything, approved).where("conversation_id is not null")
        w = Window.partitionBy("conversation_id").orderBy(*H.ORDER)
        heads = pending.withColumn("k", F.row_number().over(w)).where(F.col("k") <= first)
        heads = H.nested(heads)
        langs = self.table("annotations").select("conversation_id", F.explode("languages").alias("language")).groupBy("language").agg(F.countDistinct("conversation_id").alias("n"))
        status = D.review_status(everything.where("conversation_id is not null"), approved, self.detected(), tuple(self.allowed()))
        return {
            "conversations": m.select("conversation_id").distinct().count(),
            "sources": {r[0]: r[1] for r in m.groupBy("source").count().collect()},
            "source_percent": {r["source"]: r["percent"] for r in D.shares(m, "source", ["gmail", "whatsapp"]).collect()},
            "languages": {r[0]: r[1] for r in langs.collect()},
            "status": {r[0]: r[1] for r in status.groupBy("status").count().collect()},
            "agents": self.agents(),
            "participants": [r.asDict() for r in self.participants().orderBy("participant").limit(preview).collect()],
            "pending": [r.asDict(recursive=True) for r in heads.orderBy("conversation_id").limit(preview).collect()],
        }

    def diff(self, v1: str, v2: str) -> dict:
        return diff(self.path("datasets"), v1, v2)

    def clean_slate(self, approved: list[str] = ()) -> None:
        """Remove every output, list and report under the work folder; ``approved`` is what the new list starts with."""
        for p in [*TABLES, "datasets", *LISTS]:
            tables.remove(self.spark, self.path(p))
        if approved:
            self._change("approved_path", add=list(approved))
