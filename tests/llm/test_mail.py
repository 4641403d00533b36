import random

import pytest

from threadloom.llm import mail as M

SCHEMA = "message_id string, conversation_id string, source string, ordinal long, text string, metadata map<string,string>"
A = "The parcel with order 4711 has not arrived at my door yet.\nI have been waiting for it since the second of March and nobody answers the phone."
CASES = {
    "plain": ("Hello,\n\nWhere is it?", [1, 3]),
    "quoted below": (f"Yes.\n\nOn Mon, 1 May 2024 at 10:00, Jo Doe <jo@x.test> wrote:\n> {A.splitlines()[0]}\n> {A.splitlines()[1]}", [1]),
    "quoted above": (f"On Mon, 1 May 2024 at 10:00, Jo Doe\n<jo@x.test> wrote:\n> {A.splitlines()[0]}\n\nNew text here.", [5]),
    "interleaved": ("Am 01.05.2024 um 10:00 schrieb Jo <jo@x.test>:\n> eins\nAntwort eins.\n> zwei\nAntwort zwei.", [3, 5]),
    "header block": ("See below.\n\n________________________________\nFrom: Jo [mailto:jo@x.test]\nSent: 1 May 2024\nTo: Us\n\nOld text that is not marked.\nMore of it.", [1]),
    "original message": ("Yes.\r\n\r\n-----Original Message-----\r\nVon: Jo <jo@x.test>\r\nGesendet: gestern\r\n\r\nAlt.", [1]),
    "closing": ("It works.\n\nBest regards,\nJo Doe\nMobile +1 555 0100\n\nSent from my phone", [1]),
    "separator": ("It works.\n-- \nJo\nwww.x.test", [1]),
    "not a closing": ("Give my best regards to the warehouse people anyway.", [1]),
    "not a header": ("From: my point of view this is simply too slow.", [1]),
    "postscript": ("It works.\n\nThanks,\nJo\n\nPS: one more thing.", [1, 6]),
    "blank": (" \n\n", []),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", CASES)
def test_lines(name):
    text, want = CASES[name]
    assert next(M.new_lines([("m", text, "Jo Doe <jo@x.test>")], [], frozenset(), 20))[1] == want


def test_unmarked_history_is_found_whatever_the_wrapping():
    wrapped = " ".join(A.split()).replace(" has ", "\nhas ").replace(" since ", "\nsince ").replace(" nobody", "\nnobody")
    got = dict((i, n) for i, n, _ in M.new_lines([("a", A, None), ("b", f"I agree with this.\n{wrapped}", None)], [], frozenset(), 20))
    assert got["a"] == [1, 2] and got["b"] == [1]


def test_an_unmarked_match_goes_whether_on_one_line_or_more():
    one = " ".join(A.split())
    for text in (f"I agree with this.\n{one}", f"I agree with this.\n{one.replace(' since ', chr(10) + 'since ')}"):
        assert dict((i, n) for i, n, _ in M.new_lines([("a", A, None), ("b", text, None)], [], frozenset(), 20))["b"] == [1]


def test_automaton_cover_equals_brute_force():
    r = random.Random(2)
    for _ in range(60):
        texts = [[r.randrange(4) for _ in range(r.randrange(0, 25))] for _ in range(3)]
        s = M.SuffixAutomaton()
        for t in texts:
            s.add(t)
        q = [r.randrange(4) for _ in range(30)]
        known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        for least in (1, 3, 6):
            want = bytearray(30)
            for i in range(30):
                for j in range(i + least, 31):
                    if tuple(q[i:j]) in known:
                        want[i:j] = b"\x01" * (j - i)
            assert s.cover(q, least) == want


def test_spark_blocks_give_what_one_block_gives(spark):
    """A hot thread in blocks of 8 mails equals the same thread in one block."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows, bodies = [], []
    for i in range(60):
        body = f"New words of mail {i}: " + " ".join(r.choice(words) for _ in range(12)) + ".\n" + " ".join(r.choice(words) for _ in range(15)) + "."
        text = body
        if bodies and r.random() < 0.6:
            text += "\n" + " ".join(r.choice(bodies).split()).replace(" ", "\n", 1)
        bodies.append(body)
        rows.append((f"m{i:03d}", "hot", "gmail", i, text, {"raw_speaker_name": f"P{i % 5}"}))
    rows += [(f"x{i}", f"t{i}", "gmail", 0, "Hello,\n\nshort mail.", None) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    show = lambda x: {(a["message_id"], tuple(a["line_nos"])) for a in x.collect()}
    one, many = show(M.newly_written(df, least=20)), show(M.newly_written(df, least=20, block=8))
    assert len(one) == 90 and sum(a[0].startswith("m") and len(a[1]) == 2 for a in one) == 60
    assert {a for a in many if a[0].startswith("x")} == {a for a in one if a[0].startswith("x")}
    assert many == one


def test_blocks_keep_order_and_find_pieced_runs(spark):
    """Blocks of two mails equal one block: later holders lend nothing, and runs whose short grams stand elsewhere first are found."""
    r = random.Random(7)
    rows, bodies = [], []
    for i in range(40):
        w = [[f"v{r.randrange(10**6)}" for _ in range(14)] for _ in range(2)]
        for k in range(2):  # pieces of ten words of earlier mails, in a run that is new as a whole
            if bodies and r.random() < 0.5:
                w[k][2:12] = r.choice(bodies)[k][2:12]
        text = "\n".join(" ".join(x) for x in w)
        if bodies and r.random() < 0.6:  # repeats an earlier mail whole, without marks
            text += "\n" + "\n".join(" ".join(x) for x in r.choice(bodies))
        bodies.append(w)
        rows.append((f"m{r.randrange(10**6):06d}", "hot", "gmail", i if i % 9 else None, text, {"raw_speaker_name": f"P{i % 5}"}))
    df = spark.createDataFrame(rows, SCHEMA)
    show = lambda x: {(a["message_id"], tuple(a["line_nos"])) for a in x.collect()}
    one = show(M.newly_written(df))
    assert one == show(M.newly_written(df, block=2)) == show(M.newly_written(df, block=5)) and sum(a[1] == (1, 2) for a in one) > 20


def test_rare_and_long_footers_go_with_their_threads(spark):
    """Footers of any length that few of many mails have are found; lines that may stand anywhere are none."""
    r = random.Random(5)
    legal = "This message and what is attached to it are meant for the person named above only. " * 4
    rows = []
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(9))
    for i in range(2600):
        body = f"Hello,\n\nthis is {word()} about {word()} and it is new."
        tail = f"\n\n{legal}" if i % 130 == 0 else ""
        rows.append((f"m{i:05d}", f"t{i // 2}", "gmail", i, body + tail, {"raw_speaker_name": f"Person {i % 300}"}))
    rows += [(f"h{i:05d}", "hot", "gmail", i, f"Well, line {word()} is new here." + (f"\n\n{legal}" if i == 5 else ""), {"raw_speaker_name": f"Person {i}"}) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    for block, parts in ((400, 2000), (400, 50), (10, 50)):
        got = {a["message_id"]: a["line_nos"] for a in M.newly_written(df, block=block, parts=parts).collect()}
        assert len(got) == len(rows) and all(v == ([1] if k[0] == "h" else [1, 3]) for k, v in got.items())


def test_nulls_repeats_and_empty(spark):
    rows = [("a", None, "gmail", None, "Hello there.", None), ("a", None, "gmail", None, "Hello there.", None), ("b", "c", "gmail", 1, None, None), (None, "c", "gmail", 1, "x", None), ("w", "c", "whatsapp", 1, "x", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [(r["message_id"], r["line_nos"]) for r in M.newly_written(df).collect()] == [("a", [1])]
    assert M.newly_written(df.where("false")).count() == 0
    long = spark.createDataFrame([("l", "c", "gmail", 1, "A sentence of text. " * 20000, None)], SCHEMA)
    assert M.newly_written(long).first()["line_nos"] == [1]
