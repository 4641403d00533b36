"""External models behind narrow interfaces, called in batches on the executors; offline rules are the default.

A model object is made in each worker by a function (``make``), so that it need not travel.  It has some of

* ``rewrite(texts)``: from texts by message id to new texts by message id (translation),
* ``annotate(conversations)``: a list of ``{"conversation_id", "messages": [{"message_id", "speaker", "text"}]}`` to a
  list of ``{"conversation_id", "intents", "sentiments", "detected_languages", "summary"}``,
* ``scrub(messages)``: from ``{"message_id", "text"}`` to ``{"message_id", "is_nsfw", "is_private", "scrubbed_text"}``.

A call that raises leaves its batch to the offline rules, or as it was.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators import datasets as D
from threadloom.session import cut_lineage, whole_groups

Make = Callable[[], object]


class Busy(Exception):
    """Raised by a model that asks to be called later."""


class Offline:
    """No model at hand: changes nothing and answers nothing."""

    def rewrite(self, texts: dict[str, str]) -> dict[str, str]:
        return {}

    def annotate(self, conversations: list[dict]) -> list[dict]:
        return []

    def scrub(self, messages: list[dict]) -> list[dict]:
        return []


class Paced:
    """A model called at most so often: a pause before each call, one in proportion to its tokens after it.

    Only ``Busy`` is tried again, up to ``attempts`` calls; any other error goes to the caller at once.
    """

    def __init__(self, inner: object, pause_s: float = 2.2, attempts: int = 5, tokens_per_minute: int = 6000, sleep: Callable[[float], None] = time.sleep) -> None:
        self.inner, self.pause_s, self.attempts, self.rate, self.sleep = inner, pause_s, attempts, tokens_per_minute, sleep

    def __getattr__(self, name: str) -> Callable:
        call = getattr(self.inner, name)

        def run(batch: object) -> object:
            for k in range(self.attempts):
                self.sleep(self.pause_s)
                try:
                    answer = call(batch)
                except Busy:
                    if k + 1 == self.attempts:
                        raise
                    self.sleep(max(self.pause_s, self._cost(batch, "")))
                    continue
                self.sleep(max(self.pause_s, self._cost(batch, answer)))
                return answer
            return None

        return run

    def _cost(self, batch: object, answer: object) -> float:
        return (len(str(batch)) + len(str(answer))) / 4 / self.rate * 60  # about four characters a token


def api_key(name: str, env_file: str = ".env", disabled: str = "ETL_TESTING") -> str | None:
    """A key from the environment, else from a ``KEY=value`` file; none where tests forbid calls."""
    if os.environ.get(disabled, "").lower() == "true":
        return None
    if os.environ.get(name):
        return os.environ[name]
    if os.path.exists(env_file):
        with open(env_file, encoding="utf-8") as f:
            for line in f:
                key, eq, value = line.strip().partition("=")
                if eq and key.strip() == name:
                    return value.strip().strip("'\"") or None
    return None


def packed(sizes: list[tuple[str, int]], most: int = 6) -> list[list[str]]:
    """Conversations in order, joined to batches of at most ``most`` messages; a longer one goes alone."""
    out: list[list[str]] = []
    room = 0
    for name, n in sizes:
        if n > room or not out:
            out.append([])
            room = most
        out[-1].append(name)
        room -= n
    return out


def rewrite(messages: DataFrame, make: Make, batch: int = 10) -> DataFrame:
    """``message_id, text``: new texts of ``messages``, ``batch`` at a time; unanswered ones and failed batches stay as they are."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            for a in range(0, len(frame), batch):
                part = frame.iloc[a : a + batch]
                try:
                    new = model.rewrite(dict(zip(part["message_id"], part["text"]))) or {}
                except Exception:  # noqa: BLE001
                    new = {}
                yield pd.DataFrame({"message_id": part["message_id"], "text": [new.get(i) or t for i, t in zip(part["message_id"], part["text"])]})

    return messages.select("message_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "message_id string, text string")


def decisions(messages: DataFrame, make: Make, batch: int = 10) -> DataFrame:
    """``message_id, is_nsfw, is_private, scrubbed_text`` of the messages that a model has decided on."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            rows = []
            for a in range(0, len(frame), batch):
                part = frame.iloc[a : a + batch]
                try:
                    told = model.scrub([{"message_id": i, "text": t} for i, t in zip(part["message_id"], part["text"])]) or []
                except Exception:  # noqa: BLE001
                    told = []
                asked = set(part["message_id"])
                rows += [(d["message_id"], bool(d.get("is_nsfw")), bool(d.get("is_private")), d.get("scrubbed_text")) for d in told if d.get("message_id") in asked]
            yield pd.DataFrame(rows, columns=["message_id", "is_nsfw", "is_private", "scrubbed_text"])

    return messages.select("message_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "message_id string, is_nsfw boolean, is_private boolean, scrubbed_text string")


ANSWER = "conversation_id string, message_id string, label string, sentiment string, score double, languages array<string>, issue string, resolution string"


def model_answers(messages: DataFrame, make: Make, most: int = 6, longest: int = 1000) -> DataFrame:
    """A model's complete annotations: a row for each message (``label`` ...), one for each summary (``message_id`` null).

    Conversations are packed in order to batches of at most ``most`` messages.  An answer counts only if its intents
    and languages cover every message of the conversation.  Conversations of more than ``longest`` messages, which no
    model takes at once, are not asked for.
    """
    sizes = messages.groupBy("conversation_id").agg(F.count("*").alias("__n")).where(F.col("__n") <= longest)
    rows = messages.where("conversation_id is not null").join(sizes.select("conversation_id"), "conversation_id", "left_semi")
    rows = rows.select("conversation_id", "ts", "ordinal", "message_id", F.coalesce("speaker", F.lit("user")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list[dict]]]:
        key, held = None, []
        for frame in frames:
            for c, m, s, t in zip(frame["conversation_id"], frame["message_id"], frame["speaker"], frame["text"]):
                if c != key and held:
                    yield key, held
                    held = []
                key = c
                held.append({"message_id": m, "speaker": s, "text": t})
        if held:
            yield key, held

    def asked(model: object, batch: list[tuple[str, list[dict]]]) -> pd.DataFrame:
        try:
            answers = model.annotate([{"conversation_id": c, "messages": ms} for c, ms in batch]) or []
        except Exception:  # noqa: BLE001
            answers = []
        by = {a.get("conversation_id"): a for a in answers if isinstance(a, dict)}
        out = []
        for c, ms in batch:
            a, ids = by.get(c) or {}, [m["message_id"] for m in ms]
            of = lambda key: {x["message_id"]: x for x in a.get(key) or [] if isinstance(x, dict) and x.get("message_id")}  # noqa: B023, E731
            intents, moods, langs = of("intents"), of("sentiments"), of("detected_languages")
            if not a or not set(ids) <= set(intents) or not set(ids) <= set(langs):
                continue
            for i in ids:
                mood = moods.get(i, {})
                out.append((c, i, intents[i].get("label"), mood.get("label"), float(mood.get("score", 1.0)) if mood else None, list(langs[i].get("languages") or []), None, None))
            told = a.get("summary") or {}
            out.append((c, None, None, None, None, None, told.get("issue", ""), told.get("resolution", "")))
        return pd.DataFrame(out, columns=[x.split()[0] for x in ANSWER.split(", ")])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        batch, room = [], most
        for c, ms in whole(frames):
            if len(ms) > room and batch:
                yield asked(model, batch)
                batch, room = [], most
            batch.append((c, ms))
            room -= len(ms)
        if batch:
            yield asked(model, batch)

    return whole_groups(rows, "conversation_id", "ts", "ordinal", "message_id").mapInPandas(run, ANSWER)


def annotate_incremental(messages: DataFrame, cached: DataFrame, cached_summaries: DataFrame, make: Make | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(annotations by message, summaries by conversation, counters): only what the cache lacks is annotated.

    ``cached``: ``conversation_id, message_id, label, sentiment, score, languages``; ``cached_summaries``:
    ``conversation_id, issue, resolution``.  Cached rows of conversations that are no longer there are given up.
    What a model does not answer completely the offline rules do.
    """
    cols = ["conversation_id", "message_id", "label", "sentiment", "score", "languages"]
    have = lambda c: cached.where(F.col(c).isNotNull())
    pending = cut_lineage(D.incomplete_outputs(messages, have("label"), have("sentiment"), cached_summaries, have("languages")))
    todo = messages.join(pending, "conversation_id", "left_semi")
    answers = cut_lineage(model_answers(todo, make)) if make else messages.sparkSession.createDataFrame([], ANSWER)
    answered = answers.where("message_id is null").select("conversation_id", "issue", "resolution")
    rules = D.annotate(todo.join(answered.select("conversation_id"), "conversation_id", "left_anti"))
    kept = cached.join(messages.select("conversation_id").distinct(), "conversation_id", "left_semi").join(pending, "conversation_id", "left_anti")
    rows = kept.select(*cols).unionByName(answers.where("message_id is not null").select(*cols)).unionByName(rules.select(*cols))
    told = cached_summaries.join(messages.select("conversation_id").distinct(), "conversation_id", "left_semi").join(pending, "conversation_id", "left_anti")
    told = told.select("conversation_id", "issue", "resolution").unionByName(answered).unionByName(D.summaries(rules))
    n = answered.count()
    counters = {"conversations_pending": pending.count(), "answered_by_model": n}
    counters["fallbacks_executed"] = counters["conversations_pending"] - n
    return rows, told, counters


def translate(messages: DataFrame, languages: DataFrame, ledger: DataFrame, make: Make, batch: int = 10) -> tuple[DataFrame, DataFrame]:
    """(messages with translated texts, the renewed ledger).

    ``languages``: ``message_id, languages``; ``ledger``: ``conversation_id, text_hash``.  Messages with a label other
    than English are translated unless the ledger has the hash of their conversation's such texts as they stand.  The
    ledger keeps the hash after translation of all that was tried, whether or not a text changed.
    """
    foreign = D.regional(messages, languages)
    todo = cut_lineage(D.changed(D.translation_hash(foreign), ledger).select("conversation_id"))
    asked = foreign.join(todo, "conversation_id", "left_semi")
    done = D.apply_texts(messages, cut_lineage(rewrite(asked, make, batch)))
    after = D.translation_hash(D.regional(done, languages).join(todo, "conversation_id", "left_semi"))
    return done, D.renewed_ledger(ledger, after)
