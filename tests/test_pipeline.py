import json
import os

import pytest

from threadloom.operators.enrich import packed, rewrite
from threadloom.plans.pipeline import Pipeline, diff
from threadloom.sources import chat_logs, mail_files, tables

MAIL = """Message-ID: <a{n}@x.test>
From: "Jane Doe" <jane@client.test>
To: help@shop.com
Subject: {subject}
Date: Fri, 14 Nov 2025 22:3{n}:09 +0100
Content-Type: text/plain; charset=utf-8

{body}
"""
LOG = """header without date
[19/06/2026, 12:30:00] Ann: Where is order #123?
second line

[19/06/2026, 12:31:00] Support Agent: Please mail a@b.org
19/06/26, 9:15 pm - Ann: thanks a lot for the help
"""


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    d = tmp_path_factory.mktemp("in")
    (d / "mail").mkdir(), (d / "chat").mkdir()
    (d / "mail" / "1.eml").write_text(MAIL.format(n=1, subject="Re: Bill", body="My bill 2 is wrong, call +1 555 019 9234"))
    (d / "mail" / "2.eml").write_text(MAIL.format(n=2, subject="bill", body="I will pay it.\n\nBest regards,\nJane"))
    (d / "mail" / "skip.txt").write_text("no mail")
    (d / "chat" / "c.txt").write_text(LOG)
    (d / "box.mbox").write_text("".join(f"From x\n{MAIL.format(n=n, subject='s', body='b')}\n" for n in (1, 2)))
    return d


def test_sources(spark, inputs):
    assert {r["raw_name"] for r in mail_files.read_eml(spark, str(inputs / "mail")).collect()} == {"a1_x_test", "a2_x_test"}
    assert [r["body"] for r in mail_files.read_mbox(spark, str(inputs / "box.mbox")).collect()] == ["b", "b"]
    rows = chat_logs.parse(chat_logs.read_logs(spark, str(inputs / "chat"))).orderBy("ordinal").collect()
    assert [(r["sender"], r["text"]) for r in rows] == [("Ann", "Where is order #123?\nsecond line\n"), ("Support Agent", "Please mail a@b.org"), ("Ann", "thanks a lot for the help")]


def test_end_to_end(spark, inputs, tmp_path):
    for v in ("1", "2"):
        Pipeline(spark, mail_dir=str(inputs / "mail"), chat_dir=str(inputs / "chat"), work_dir=str(tmp_path), version=v, now="2026-01-01 00:00:00").run()
    m = {(r["text"], r["speaker"]) for r in spark.read.parquet(str(tmp_path / "anonymized")).collect()}
    assert ("My bill 2 is wrong, call [PHONE]", "user") in m and ("I will pay it.", "user") in m and ("Please mail [EMAIL]", "assistant") in m
    ts = {r["timestamp"] for r in spark.read.parquet(str(tmp_path / "messages")).collect()}
    assert {"2025-11-14T21:31:09Z", "2026-06-19T12:30:00Z", "2026-06-19T21:15:00Z"} <= ts
    stats = json.loads((tmp_path / "datasets" / "v1" / "statistics.json").read_text())
    assert stats["conversations"] == 2 and stats["messages"] == 5
    assert spark.read.json(str(tmp_path / "datasets" / "v1" / "rag_facts")).count() >= 3
    assert all(x["delta"] == 0 for x in diff(str(tmp_path / "datasets"), "v1", "2").values())
    with pytest.raises(FileNotFoundError):
        diff(str(tmp_path / "datasets"), "1", "9")


def test_json_and_lists(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"message_id": "m", "text": "x"}'), (tmp_path / "j" / "b.json").write_text("{broken")
    assert [r["message_id"] for r in tables.read_json(spark, [str(tmp_path / "j"), str(tmp_path / "none")], tables.MESSAGE).collect()] == ["m"]
    p = str(tmp_path / "l.json")
    assert tables.control_list(p, ["d"]) == ["d"] and tables.update_control_list(p, ["a", "b", "a"]) == ["a", "b"] and tables.update_control_list(p, ["c"], ["a"]) == ["b", "c"]
    t = str(tmp_path / "t")
    spark.range(3).write.parquet(t)
    tables.write_replacing(spark.read.parquet(t).where("id > 0"), t)
    assert spark.read.parquet(t).count() == 2 and not os.path.exists(t + ".old")


def test_enrichers(spark):
    class Upper:
        def rewrite(self, batch):
            return {k: v.upper() for k, v in batch.items() if k != "b"}

    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "message_id string, text string")
    assert {tuple(r) for r in rewrite(rows, Upper, 2).collect()} == {("a", "X"), ("b", "y"), ("c", "")}
    assert packed([("a", 4), ("b", 2), ("c", 9), ("d", 1)]) == [["a", "b"], ["c"], ["d"]]


def test_service(spark, inputs, tmp_path):
    from threadloom.plans.service import Service

    s = Service(spark, mail_dir=str(inputs / "mail"), chat_dir=str(inputs / "chat"), work_dir=str(tmp_path), version="1", now="2026-01-01 00:00:00")
    s.run()
    assert s.status()["rows"]["messages"] == 5 and s.status()["versions"] == ["v1"] and not s.needs_annotation()
    d = s.dataset_details()
    assert d["conversations"] == 2 and d["sources"] == {"gmail": 2, "whatsapp": 3} and len(d["pending"]) == 2
    ids = [p["conversation_id"] for p in d["pending"]]
    s.approve(ids[:1])
    assert s.gated().select("conversation_id").distinct().count() == 1 and len(s.dataset_details()["pending"]) == 1
    s.exclude(ids[:1])
    assert s.gated().count() == 0
    s.approve(ids)
    s.assign_roles(["Ann"])
    assert {r[0] for r in s.table("anonymized").where("source = 'whatsapp'").select("speaker", "text").collect()} == {"assistant", "user"}
    s.allow_language("en - English", "xx - Other")
    assert "xx - Other" in s.dataset_details()["languages"]
    s.export()
    assert s.diff("1", "1")["conversations"]["v1"] == 0
    s.clean_slate()
    assert s.status()["rows"] == {}
