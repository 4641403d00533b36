import random

from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.llm import encoding as E
from threadloom.llm import packing as K

TEXTS = ["hello world", "", None, " \n\t  ", "<|endoftext|> don't  stop", "नमस्ते दुनिया é ßa", "a" * 5000 + " x" * 20000, "\x00\x01 zero", "👩🏽‍🔧 emoji", "hello world", "don't don't don't"]


def test_ids_equal_the_tokenizer_and_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(E.vocabulary("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], 2, "y"), (None, "null id", 3, "z")], "doc_id long, text string, ids int, word string")
    for hot in (1000, 3):
        got = {r["doc_id"]: r["ids"] for r in E.encode(docs, hot_parts=hot).collect()}
        assert got == {**{i: tok.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(TEXTS)}, None: tok.encode("null id").ids}
    back = {r["doc_id"]: r["text"] for r in E.decode(E.encode(docs)).collect()}
    assert back == {**{i: t or "" for i, t in enumerate(TEXTS)}, None: "null id"}
    assert E.encode(docs.where("false")).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 4)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(1, 60))
def test_fullest_is_optimal(lengths, room):
    sums = {0}
    for x, n in lengths:
        sums = {s + x * k for s in sums for k in range(n + 1)}
    got = K.fullest(sorted(lengths, reverse=True), room)
    assert all(n <= dict(lengths)[x] for x, n in got) and sum(x * n for x, n in got) == max(s for s in sums if s <= room)


def test_containers(spark):
    r = random.Random(0)
    sizes = [(i, r.choice([0, 1, 5, 17, 60, 64, 65, 128, 300, r.randrange(1, 80)])) for i in range(700)] + [(700, None), (701, 10)]
    items = spark.createDataFrame(sizes, "doc_id long, n_tokens int").selectExpr("*", "1 as capacity")
    kinds = spark.createDataFrame([("s", 64), ("l", 500), ("none", 0), (None, 5)], "container_kind string, capacity_tokens long")
    p = K.fill_containers(items, kinds, group_items=200).toPandas()
    for kind, cap in (("s", 64), ("l", 500)):
        g = p[p.container_kind == kind]
        whole = g.groupby("doc_id").n_tokens.sum().to_dict()
        assert whole == {i: n or 0 for i, n in sizes}
        full = g.dropna(subset=["container_no"]).groupby("container_no").n_tokens.sum()
        assert full.max() <= cap and full.sum() / (len(full) * cap) > 0.9
        split = g.groupby("doc_id").size()
        assert all(k == max(1, -(-(dict(sizes)[i] or 0) // cap)) for i, k in split.items())
        assert not g.duplicated(["doc_id", "piece_no"]).any() and (g[g.n_tokens > 0].container_no.notna()).all()
    assert set(p.container_kind) == {"s", "l"} and K.fill_containers(items.where("false"), kinds).count() == 0
