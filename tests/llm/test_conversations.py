import random
from datetime import datetime

from threadloom.llm import conversations as C

MSG = "message_id string, conversation_id string, source string, account_id string, ordinal long, timestamp string, speaker string, text string, metadata map<string,string>, loaded_at timestamp"
AGENTS = [(1, "Ann Lee", "ann@x.test")]


def m(i, c, o, t, s, text="hello", name=None, **meta):
    return (i, c, "chat", "acc", o, t, s, text, {"raw_speaker_name": name, **meta} if name or meta else None, datetime(2024, 1, 1))


def run(spark, rows, heads, recover=True, **more):
    messages = spark.createDataFrame(rows, MSG)
    headers = spark.createDataFrame([(c, "chat", "acc", (n,)) for c, n in heads], "conversation_id string, source string, account_id string, metadata struct<total_messages:int>")
    accounts = spark.createDataFrame([("acc", "chat", "UTC", "dmy", "en")], "account_id string, source string, zone string, date_order string, locale string")
    agents = spark.createDataFrame(AGENTS, "agent_id long, agent_name string, mail_address string")
    return C.rebuild(messages, headers, accounts, agents, recover, **more)


def test_validation(spark):
    t = "2024-01-01T10:00:0{}Z"
    ok = [m("a1", "a", 0, t.format(0), "user"), m("a2", "a", 1, t.format(2), "???", name="ANN LEE <x@y.z>"), m("a3", "a", 2, t.format(2), None, name="Bob"), m("a4", "a", 3, t.format(1), "system", text=" ")]
    bad = [
        *[m(f"n{k}", "nohead", k, t.format(k), s) for k, s in enumerate(("user", "assistant"))],
        *[m(f"c{k}", "count", k, t.format(k), s) for k, s in enumerate(("user", "assistant"))],
        *[m(f"t{k}", "time", k, x, s) for k, (x, s) in enumerate(((t.format(1), "user"), ("soon", "assistant")))],
        *[m(f"r{k}", "role", k, t.format(k), s) for k, s in enumerate(("user", "assistant", None))],
        *[m(f"u{k}", "unanswered", k, t.format(k), s) for k, s in enumerate(("assistant", "user"))],
        m("e0", "empty", 0, t.format(0), "user", text=None),
    ]
    heads = [("a", 4), ("a", None), ("count", 3), ("time", 2), ("role", None), ("unanswered", None), ("empty", 1), ("ghost", None)]
    got = [tuple(r) for r in run(spark, ok + ok[:1] + bad, heads).orderBy("turn_no").select("conversation_id", "turn_no", "message_id", "role").collect()]
    assert got == [("a", 0, "a1", "user"), ("a", 1, "a2", "assistant"), ("a", 2, "a3", "user")]
    assert run(spark, ok, []).count() == 0
    assert run(spark, [m("z", None, 0, None, None)], [("a", 1)]).count() == 0


def test_lost_message_is_attached_through_a_reply_link_only_where_its_place_is_free(spark):
    t = "2024-01-01T10:00:0{}Z"
    rows = [m("a1", "a", 0, t.format(0), "user", email_message_id="<1>"), m("a2", None, 1, t.format(1), "assistant", email_message_id="<2>", in_reply_to="<1>"), m("a3", None, 0, t.format(2), "user", in_reply_to="<1>")]
    got = [r["message_id"] for r in run(spark, rows, [("a", 2)]).orderBy("turn_no").collect()]
    assert got == ["a1", "a2"]
    assert run(spark, rows, [("a", 2)], recover=False).count() == 0


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(str(r.randrange(300)), str(r.randrange(300))) for _ in range(220)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(120)] + [("s", "s"), (None, "q")]
    edges += [("hub", f"h{i}") for i in range(200)]
    par: dict[str, str] = {}

    def root(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x

    for a, b in edges:
        if a and b:
            a, b = root(a), root(b)
            par[max(a, b)] = min(a, b)
    got = dict(tuple(x) for x in C.connected_components(spark.createDataFrame(edges, "u string, v string")).collect())
    assert got == {x: root(x) for x in list(par)}
    assert C.connected_components(spark.createDataFrame([], "u string, v string")).count() == 0


def test_lines_quoted_often_link_and_components_without_ids_are_conversations(spark):
    long = "we waited the whole day for the van that was to bring number {} to us"
    quote = long.format("one")
    rows = [m("q0", None, 0, None, None, text=quote), *[m(f"q{k}", "a", k, None, None, text=f"> {quote}\nyes {k}") for k in range(1, 8)]]
    rows += [m("k0", None, 0, None, None, text=long.format("two")), *[m(f"k{k}", None, k, None, None, text=f"> {long.format('two')}") for k in range(1, 3)]]
    boiler = long.format("nine")  # stands in two stated conversations: links nothing
    rows += [m("b0", None, 0, None, None, text=boiler), m("b1", "b", 1, None, None, text=boiler), m("b2", "c", 1, None, None, text=boiler)]
    got = {tuple(r) for r in C.recover_ids(spark.createDataFrame(rows, MSG)).collect()}
    assert got == {("q0", "a"), ("k0", "k0"), ("k1", "k0"), ("k2", "k0")}


def test_long_conversations_are_numbered_by_ranges_alike(spark):
    r = random.Random(2)
    rows = [m(f"l{i:04d}", "long", r.choice([i, None]), f"2024-01-01T1{r.randrange(10)}:{r.randrange(60):02d}:00Z", r.choice(["user", "assistant"])) for i in range(700)]
    rows += [m(f"s{i}", "short", i, f"2024-01-01T10:00:0{i}Z", "user" if i % 2 else "assistant") for i in range(6)]
    heads = [("long", None), ("short", None)]
    one, many = ({tuple(x) for x in run(spark, rows, heads, split=n).collect()} for n in (1000, 50))
    assert one == many and len(one) == 706 and sorted(x[1] for x in many if x[0] == "long") == list(range(700))


def test_planted_losses_come_back(spark):
    """Of whole conversations single messages lose their id; replies, quotes and lines in many messages bring them back."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    rows, lost = [], {}
    for c in range(12):
        first = " ".join(word() for _ in range(14))
        for k in range(8):
            own = " ".join(word() for _ in range(14))
            text = first if k == 0 else f"{own}\n> {first}"
            meta = {"email_message_id": f"<{c}.{k}>"} | ({"in_reply_to": f"<{c}.{k - 1}>"} if k else {})
            gone = k in (c % 8, (c + 3) % 8)
            if gone:
                lost[f"{c}-{k}"] = f"c{c}"
            rows.append(m(f"{c}-{k}", None if gone else f"c{c}", k, f"2024-01-01T10:00:0{k}Z", "assistant" if k % 2 else "user", text=text, **meta))
    assert dict(tuple(x) for x in C.recover_ids(spark.createDataFrame(rows, MSG)).collect()) == lost
    got = run(spark, rows, [(f"c{c}", 8) for c in range(12)])
    assert got.count() == 96 and run(spark, rows, [(f"c{c}", 8) for c in range(12)], recover=False).count() == 0
