"""Models, cache, ledger, privacy counts, validation of documents, session headers: against small sequential rules."""

import hashlib
import json
import random
from datetime import datetime, timedelta

import pytest

from threadloom.operators import datasets as D
from threadloom.operators import enrich as E
from threadloom.operators import normalize as N
from threadloom.operators import privacy as P
from threadloom.operators import threads as H
from threadloom.sources import mail_files, tables

MSG = "conversation_id string, message_id string, ts timestamp, ordinal long, speaker string, text string, source string, metadata map<string,string>"
T0 = datetime(2024, 1, 1)


def row(c, k, text="hello there", speaker="user", name=None, hours=0):
    return (c, f"{c}-{k}", T0 + timedelta(minutes=k, hours=hours), k, speaker, text, "gmail", {"raw_speaker_name": name} if name else None)


def test_annotation_asks_for_what_is_missing_and_falls_back(spark):
    class Answers:
        """Annotates conversations of even size completely, others only in part; fails where a text says so."""

        def annotate(self, conversations):
            assert sum(len(c["messages"]) for c in conversations) <= 6 or len(conversations) == 1
            if any("boom" in m["text"] for c in conversations for m in c["messages"]):
                raise ValueError("boom")
            out = []
            for c in conversations:
                ids = [m["message_id"] for m in c["messages"]]
                told = ids if len(ids) % 2 == 0 else ids[1:]
                out.append({
                    "conversation_id": c["conversation_id"], "intents": [{"message_id": i, "label": "x"} for i in told], "sentiments": [{"message_id": i, "label": "good"} for i in told],
                    "detected_languages": [{"message_id": i, "languages": ["en - English"]} for i in told], "summary": {"issue": "i", "resolution": "r"},
                })
            return out

    rows = [row(c, k, "boom" if c == "c" else "hello") for c, n in (("a", 2), ("b", 3), ("c", 2), ("d", 8), ("k", 2)) for k in range(n)]
    m = spark.createDataFrame(rows, MSG)
    cols = "conversation_id string, message_id string, label string, sentiment string, score double, languages array<string>"
    cached = spark.createDataFrame([(c, f"{c}-{k}", "old", "old", 1.0, ["old"]) for c in ("k", "gone") for k in range(2)], cols)
    told = spark.createDataFrame([("k", "old", "old"), ("gone", "old", "old")], "conversation_id string, issue string, resolution string")
    got, summaries, counters = E.annotate_incremental(m, cached, told, Answers)
    labels = {r["message_id"]: r["label"] for r in got.collect()}
    assert labels["k-0"] == "old" and labels["d-7"] == "x" and labels["b-0"] not in ("x", "old") and labels["c-0"] not in ("x", "old") and len(labels) == len(rows)
    issues = {r["conversation_id"]: r["issue"] for r in summaries.collect()}
    assert issues["k"] == "old" and issues["d"] == "i" and (labels["a-0"] == labels["a-1"] == "x") == (issues["a"] == "i") and set(issues) == set("abcdk")
    assert counters["conversations_pending"] == 4 and counters["fallbacks_executed"] == 4 - counters["answered_by_model"]
    assert E.annotate_incremental(m, got, summaries, Answers)[2] == {"conversations_pending": 0, "answered_by_model": 0, "fallbacks_executed": 0}
    assert E.annotate_incremental(m, cached, told)[2]["fallbacks_executed"] == 4


def test_translation_and_ledger_against_a_loop(spark):
    r = random.Random(1)
    langs = {}
    rows = []
    for c in "abcdef":
        for k in range(r.randrange(1, 6)):
            rows.append(row(c, k, r.choice(["hola", "bonjour", None, "", "fail"])))
            langs[f"{c}-{k}"] = r.choice([["en - English"], ["es - Spanish"], [], ["en - English", "fr - French"]])

    class Upper:
        def rewrite(self, texts):
            if "fail" in texts.values():
                raise E.Busy
            return {k: t.upper() for k, t in texts.items()}

    m = spark.createDataFrame(rows, MSG)
    languages = spark.createDataFrame(list(langs.items()), "message_id string, languages array<string>")
    own = lambda c, texts: [texts[x[1]] or "" for x in rows if x[0] == c and any(v != "en - English" for v in langs[x[1]])]
    sha = lambda xs: hashlib.sha256("|".join(xs).encode()).hexdigest()
    before = {x[1]: x[5] for x in rows}
    ledger = spark.createDataFrame([("a", sha(own("a", before))), ("b", "other"), ("gone", "g")], "conversation_id string, text_hash string")
    done, after = E.translate(m, languages, ledger, Upper, batch=1)
    texts = {x["message_id"]: x["text"] for x in done.collect()}
    assert len(texts) == len(rows)
    for x in rows:
        foreign = any(v != "en - English" for v in langs[x[1]])
        assert (texts[x[1]] or "") == (x[5].upper() if foreign and x[0] != "a" and x[5] and x[5] != "fail" else x[5] or "")
    assert {x[0]: x[1] for x in after.collect()} == {"gone": "g", "a": sha(own("a", before)), "b": "other"} | {c: sha(own(c, texts)) for c in "abcdef" if own(c, texts)}
    again, _ = E.translate(done, languages, after, Upper, batch=1)
    assert {x["message_id"]: x["text"] for x in again.collect()} == texts


def test_pacing_repeats_only_what_asks_for_it():
    slept, calls = [], []

    class Model:
        def rewrite(self, texts):
            calls.append(texts)
            if len(calls) < 3:
                raise E.Busy
            return {k: "x" * 4000 for k in texts}

    assert E.Paced(Model(), sleep=slept.append).rewrite({"a": "b"}) == {"a": "x" * 4000} and len(calls) == 3 and slept[0] == 2.2 and slept[-1] > 9
    with pytest.raises(E.Busy):
        calls.clear()
        E.Paced(Model(), attempts=2, sleep=slept.append).rewrite({})

    class Broken:
        def rewrite(self, texts):
            calls.append(1)
            raise ValueError

    calls.clear()
    with pytest.raises(ValueError):
        E.Paced(Broken(), sleep=slept.append).rewrite({})
    assert len(calls) == 1


def test_keys(tmp_path, monkeypatch):
    f = tmp_path / ".env"
    f.write_text("# x\nA_KEY='v'\n")
    monkeypatch.delenv("ETL_TESTING", raising=False)
    assert E.api_key("A_KEY", str(f)) == "v" and E.api_key("B_KEY", str(f)) is None
    monkeypatch.setenv("A_KEY", "w")
    assert E.api_key("A_KEY", str(f)) == "w"
    monkeypatch.setenv("ETL_TESTING", "true")
    assert E.api_key("A_KEY", str(f)) is None


def test_privacy_counts_and_decisions(spark):
    rows = [
        row("a", 0, "I am Jane, mail jane@x.org or call 555-019-9234", name="Jane Doe <j@x.org>"), row("a", 1, "Hello Jane Doe, your pin: x4711. Come to 12 Main Street", "assistant"),
        row("b", 0, "nothing here"), row("b", 1, None), row("c", 0, "ask Kim Lee", name="+1 555 0199"),
    ]
    m = spark.createDataFrame(rows, MSG)
    heads = spark.createDataFrame([("c", ("Kim Lee",))], "conversation_id string, metadata struct<customer_name:string>")
    names = P.participants(m, heads)
    assert {r[0]: set(r[1]) for r in names.collect()} == {"a": {"Jane Doe", "Jane", "Doe", "assistant"}, "b": {"user"}, "c": {"Kim Lee", "Kim", "Lee"}}
    out = P.scrubbed(m, names)
    assert {r["message_id"]: r["text"] for r in out.collect()}["a-1"] == "Hello [NAME], your pin: [PASSWORD]. Come to [ADDRESS]"

    class Model:
        def scrub(self, messages):
            return [{"message_id": x["message_id"], "is_nsfw": True, "scrubbed_text": "[NSFW]"} for x in messages if x["text"] == "nothing here"] + [{"message_id": "unasked", "is_private": True}]

    out = P.decided(out, E.decisions(out, Model))
    counted = P.counts(out)
    got = {r["conversation_id"]: tuple(r[k] for k in P.KINDS) for r in counted.collect()}
    assert got == {"a": (1, 1, 1, 1, 2, 0, 0), "b": (0, 0, 0, 0, 0, 1, 0), "c": (0, 0, 0, 0, 1, 0, 0)}
    assert P.details(counted).count() == 3 and P.totals(counted).first().asDict() == {"conversations": 3, "emails": 1, "phones": 1, "addresses": 1, "passwords": 1, "names": 3, "nsfw": 1, "private": 0}
    assert P.totals(P.counts(out.where("false"))).first()["conversations"] == 0


def test_documents_are_validated(spark):
    ok = {"conversation_id": "a", "source": "s", "start_timestamp": None, "end_timestamp": "", "messages": [{"text": "x"}]}
    docs = [("ok", json.dumps(ok)), ("broken", "{"), ("list", "[1]"), ("none", None), ("empty", json.dumps(ok | {"messages": []})), ("less", json.dumps({k: v for k, v in ok.items() if k not in ("source", "messages")}))]
    got = sorted(tuple(r) for r in H.document_violations(spark.createDataFrame(docs, "file string, content string")).fillna("").collect())
    assert got == [("broken", "json", "", "error"), ("empty", "no_messages", "", "warning"), ("less", "field", "messages", "error"), ("less", "field", "source", "error"), ("list", "json", "", "error"), ("none", "json", "", "error")]
    told = H.sentences(H.document_violations(spark.createDataFrame(docs, "file string, content string")))
    assert {r["file"]: r["text"] for r in told.collect()}["broken"] == "broken: the file is no JSON object"


def test_session_headers_and_empty_conversations(spark):
    rows = [row("a", 0), row("a", 1), row("a", 2, hours=30), row("b", 0)]
    m = spark.createDataFrame(rows, MSG)
    s = H.sessionize(m, "conversation_id", m["ts"].cast("long"), 86400, "ordinal", "message_id")
    from pyspark.sql import functions as F

    s = s.withColumn("original_conversation_id", F.col("conversation_id")).withColumn("conversation_id", F.col("session_id"))
    got = {r["conversation_id"]: (r["session_index"], r["total_sessions"], r["total_messages"]) for r in H.session_headers(s).collect()}
    assert got == {"a_session_0": (0, 2, 2), "a_session_1": (1, 2, 1), "b_session_0": (0, 1, 1)}
    heads = spark.createDataFrame([("a",), ("z",), (None,)], "conversation_id string")
    assert [r[0] for r in H.empty_headers(heads, m).collect()] == ["z"]


def test_gates_status_and_shares(spark):
    heads = spark.createDataFrame([("a",), ("b",), ("c",)], "conversation_id string")
    ann = spark.createDataFrame([("a", [("m1", ["xx - X"])]), ("b", [("m2", ["xx - X", "en - English"]), ("m3", [])])], "conversation_id string, detected_languages array<struct<message_id:string,languages:array<string>>>")
    got = {r[0]: (r[1], r[2]) for r in D.review_status(heads, heads.where("conversation_id = 'a'"), ann).collect()}
    assert got == {"a": ("approved", ["xx - X"]), "b": ("flagged", ["xx - X"]), "c": ("pending", [])}
    m = spark.createDataFrame([("m1",), ("m3",), ("m9",)], "message_id string")
    assert {r[0]: r[1] for r in D.message_languages(m, ann).collect()} == {"m1": ["xx - X"], "m3": ["en - English"], "m9": ["en - English"]}
    assert {r[0]: r[2] for r in D.shares(heads.where("false").withColumnRenamed("conversation_id", "source"), "source", ["x", "y"]).collect()} == {"x": 50.0, "y": 50.0}
    none = spark.createDataFrame([("x", None), ("y", "a")], "k string, conversation_id string")
    assert {r[0] for r in D.only(none, heads.where("false")).select("k").collect()} == {"x"} and D.without(none, heads).select("k").first()[0] == "x"


def test_last_file_of_a_name_wins_and_stores(spark, tmp_path):
    mail = "Message-ID: <same@x>\nFrom: a@x\nSubject: s\nDate: {}\n\n{}"
    (tmp_path / "1.eml").write_text(mail.format("Wed, 01 Jan 2025 10:00:00 +0000", "first"))
    (tmp_path / "2.eml").write_text(mail.format("Mon, 06 Jan 2025 10:00:00 +0000", "second"))
    raw = mail_files.last_per_name(mail_files.read_eml(spark, str(tmp_path)))
    assert [r["body"] for r in raw.collect()] == ["second"]
    from pyspark.sql import functions as F

    unified = N.unified(N.normalize_mail(raw, F.lit("2025-01-01").cast("timestamp")))
    assert unified.columns == ["conversation_id", "message_id", "timestamp", "speaker", "text"] and unified.count() == 1
    p = tables.save_raw(spark, str(tmp_path), "gmail", "x.json", {"a": "é"})
    assert json.loads(tables.read_text(spark, p)) == {"a": "é"} and tables.exists(spark, p) and tables.children(spark, str(tmp_path / "gmail"))[-1] == "x.json"
    assert tables.gate_list(spark, str(tmp_path / "none.json")) is None
    tables.write_text(spark, "{broken", p)
    assert tables.gate_list(spark, p) == []
    with pytest.raises(OSError, match="raw record"):
        tables.save_raw(spark, "nosuchscheme://x", "gmail", "y", "z")


def test_hashes_hold_after_a_join_on_the_same_key(spark):
    """Adaptive execution must not tear the groups that the hash streams over."""
    rows = [row(f"c{i % 700:03d}", i // 700, f"text {i}") for i in range(7000)]
    m = spark.createDataFrame(rows, MSG)
    keys = spark.createDataFrame([(f"c{i:03d}",) for i in range(600)], "conversation_id string").distinct()
    got = {x[0]: x[1] for x in D.translation_hash(m.join(keys, "conversation_id", "left_semi")).collect()}
    assert got == {f"c{c:03d}": hashlib.sha256("|".join(f"text {c + 700 * k}" for k in range(10)).encode()).hexdigest() for c in range(600)}
    assert D.translation_hash(m.join(keys, "conversation_id", "left_semi")).count() == 600
