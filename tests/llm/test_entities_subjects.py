import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import entities as E
from threadloom.llm import subjects as S

COLS = "id long, name string, email string, phone string, town string, postcode string, birth_year int"


def frame(spark, rows, side):
    return E.prepare(spark.createDataFrame(rows, COLS), side, "id", F.col("name"))


def test_normal_forms():
    assert E.name_parts('"Größdorf, Rebecca" <r@x.test>') == E.name_parts("~Rebecca Groessdorf 🎉") == ("rebecca", "grossdorf")
    assert E.name_parts("+49 (921) 555 6137") == ("", "") and E.name_parts("O. Kramez")[0] == "o."
    assert E.phone_digits("0033 773 5558523") == E.phone_digits("+33 77355-58523") == "7735558523" and E.phone_digits("12") == ""
    assert E.given_level("kate", "katherine") == 1.0 and E.given_level("farid", "faird") == 0.9 and E.one_edit("abc", "abd") and not E.one_edit("abc", "cba")


def slip(r, x, letters):
    i = r.randrange(len(x))
    return r.choice([x[:i] + r.choice(letters) + x[i + 1 :], x[:i] + r.choice(letters) + x[i:], x[:i] + x[i + 1 :], x[:i] + x[i : i + 2][::-1] + x[i + 2 :]])


def test_lookup_finds_all_close_values(spark):
    """Multi-index lookup against brute force over all pairs: every pair that one slip parts, and none that is not close."""
    r = random.Random(0)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(3, 12)))
    base = {k: [word() for _ in range(60)] for k in ("given", "family")}
    base["email"] = [f"{word()}{r.randrange(5)}" for _ in range(60)]
    base["phone"] = ["".join(r.choice("0123456789") for _ in range(10)) for _ in range(60)]
    near = lambda k, x: "".join(c if i != 4 else r.choice("0123456789") for i, c in enumerate(x)) if k == "phone" else slip(r, x, "abcdefgh")
    rows = {(0, k, v) for k in base for v in base[k]} | {(1, k, near(k, v)) for k in base for v in base[k]} | {(1, k, v) for k in base for v in base[k][:9]}
    count = {x[1:]: 1 + sum(y[1:] == x[1:] for y in rows) for x in rows}
    pairs = [tuple(x) for x in E.close_values(spark.createDataFrame([(*x, n) for x, n in sorted(count.items())], "kind string, value string, n long")).collect()]
    assert all(E.is_close(*x) and (count[x[0], x[1]], x[1]) < (count[x[0], x[2]], x[2]) for x in pairs) and len(set(pairs)) == len(pairs)
    got = {(k, *x) for k, a, b in pairs for x in ((a, b), (b, a))} | {(k, a, a) for k, a in count}

    def slipped(k, a, b):
        if k == "phone":
            return sum(x != y for x, y in zip(a, b)) <= 1
        if k == "email":
            return a == b or (E.email_parts(a)[0] == E.email_parts(b)[0] and E.one_edit(E.email_parts(a)[1], E.email_parts(b)[1]))
        return a == b or E.one_edit(a, b)

    want = {(k, a, b) for s, k, a in rows for t, q, b in rows if s == 0 and t == 1 and k == q and slipped(k, a, b) and E.is_close(k, a, b) and min(len(a), len(b)) > 1}
    assert want <= got and len(want) > 200


def test_index_grows_with_its_values(spark):
    """Ten times the values give at most twelve times the joined rows, and no key holds many."""

    def joined(n):
        r = random.Random(n)
        value = lambda: "".join(r.choice(("an", "be", "lo", "ti", "ma", "ru", "ske", "dorf", "hoff")) for _ in range(r.randrange(2, 5))) + str(r.randrange(4000))
        rows = [("email", v, 1) for v in sorted({value() for _ in range(n)})]
        i = E.value_index(spark.createDataFrame(rows, "kind string, value string, n long"))
        return i.groupBy("key").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") ** 2), F.max(F.col("n") ** 2)).first()

    small, large = joined(300), joined(3000)
    assert large[1] < 1000 and large[0] <= 12 * small[0], (small, large)


def test_names_the_scorer_accepts_meet_with_support(spark):
    """Pairs rated 0.9 or more in both names against brute force over all pairs; then short forms and initials end to end."""
    left = ["liz|smith", "robert|smith", "e.|smith", "farid|kramez", "bill|s.", "anna|holt", "emma|smith"]
    right = ["elizabeth|smith", "bob|smith", "faird|krames", "w.|stone", "william|stone", "anna|holt", "emily|smith", "b.|smith"]
    rows = [(0, v, v.split("|"), "1") for v in left] + [(1, v, v.split("|"), "1") for v in right] + [(1, "other", ["elizabeth", "smith"], "2")]
    classes = spark.createDataFrame([(s, c, n[0], n[1], "", "", "", p, "") for s, c, n, p in rows], "side int, cls string, given string, family string, email string, phone string, town string, postcode string, year string")
    rated = lambda a, b: all(f(x, y) >= 0.9 for f, x, y in zip((E.given_level, E.family_level), a.split("|"), b.split("|")))
    got = {tuple(r)[:2] for r in E.blocked_pairs(E.evidence(classes)).collect()}
    want = {(a, b) for a in left for b in right if rated(a, b)}
    assert want <= got and len(want) == 8 and all(b != "other" for _, b in got)
    p = [(i, n, None, None, None, f"9104{i}", 1946) for i, n in enumerate(["Liz Smith", "Robert Smith", "Margaret Smith", "Elizabeth Smith", "K. Smith"])]
    c = [(i, n, None, None, None, f"9104{i}", 1946) for i, n in enumerate(["Elizabeth Smith", "Bob Smith", "Peggy Smith", "E. Smith", "Katherine Smith"])]
    assert {(i, i) for i in range(5)} <= {(r["a"], r["b"]) for r in E.match(frame(spark, p, 0), frame(spark, c, 1)).collect()}


def test_shared_blocks_meet_in_their_parts(spark):
    """Whatever the size from which a block counts as shared, pairs with enough rarer agreements are the same."""
    r = random.Random(3)
    person = lambda i: (f"name{i % 40}", "lastly", "", "8005550000", r.choice(["", "aa", "bb"]), str(i % 30), str(1950 + i % 7))
    rows = [(s, f"{s}-{i}", *person(i)) for s in (0, 1) for i in range(60)]
    classes = spark.createDataFrame(rows, "side int, cls string, given string, family string, email string, phone string, town string, postcode string, year string")
    proof = E.evidence(classes)
    whole, parts = ({tuple(x)[:2] for x in E.blocked_pairs(proof, n).collect()} for n in (1000, 3))
    assert len(whole) == 3600 and len(parts) < 1200
    assert {(f"0-{i}", f"1-{i}") for i in range(60)} <= parts


def test_matches_and_a_hot_number(spark):
    p = [
        (1, "Linnea Dunhoff", "linnea291@x.test", "576.555.1907", "Brickhaven", "91049", 1946),
        (2, "Oskar Kramez", None, "+1 516 555 8540", "Juncalito", "69564", 1975),
        (3, "Vera Holz", "vera3@x.test", "0999 555 0000", "Ribamar", "11111", 1980),
        (4, None, None, None, None, None, None),
        *[(100 + i, f"Name{chr(97 + i % 26)}{chr(97 + i // 26)} Last{chr(97 + i % 26)}", None, "800 555 0000", None, None, None) for i in range(60)],
    ]
    c = [
        (11, "Dunhoff, Liinnea", "LINNEA291@x.test ", None, None, None, None),
        (12, '"O. Kramez"', None, "(516) 555-8540", None, None, None),
        (13, "Jan Holz", None, "0999 555 0000", "Ribamar", "11111", None),  # household
        (14, None, None, None, None, None, None),
        *[(200 + i, f"Name{chr(97 + i % 26)}{chr(97 + i // 26)} Last{chr(97 + i % 26)}", None, "800 555 0000", None, None, None) for i in range(60)],
    ]
    got = {(r["a"], r["b"]): r["confidence"] for r in E.match(frame(spark, p + p[:1], 0), frame(spark, c, 1)).collect()}
    assert (1, 11) in got and (2, 12) in got and (3, 13) not in got and not any(4 in k or 14 in k for k in got)
    assert {k for k in got if k[0] >= 100} == {(100 + i, 200 + i) for i in range(60)} and all(0.5 <= v <= 1 for v in got.values())
    assert E.match(frame(spark, p, 0).where("false"), frame(spark, c, 1)).count() == 0


def test_pairs_with_only_common_agreements_are_compared(spark):
    """Blocks of any size against brute force over all pairs; then 50 entries of one person, who all have all in common."""
    r = random.Random(5)
    given = ["anna", "bernd", "bernt", "carla", "", "a."]
    person = lambda i: (r.choice(given), "lastly", r.choice(["", "x@y.test", "z@y.test"]), r.choice(["8005550000", ""]), str(i), "", "")
    rows = [(s, f"{s}-{i}", *person(i)) for s in (0, 1) for i in range(70)]
    classes = spark.createDataFrame(rows, "side int, cls string, given string, family string, email string, phone string, town string, postcode string, year string")
    proof = E.evidence(classes).localCheckpoint()
    all_pairs = {tuple(x)[:2] for x in E.blocked_pairs(proof, 10_000).collect()}
    found = E.blocked_pairs(proof, 3).localCheckpoint()
    rare = {tuple(x)[:2] for x in found.collect()}
    common = lambda keep: [tuple(x)[:2] for x in E.common_pairs(proof, classes, found, keep, 3).collect()]
    whole, likely = common(0.0), common(0.5)
    assert len(whole) == len(set(whole)) > 500 and not set(whole) & rare and set(whole) | rare == all_pairs
    of = {x[1]: x[2:] for x in rows}
    far = {(a, b) for a, b in whole if E.compare(of[a], of[b])[0] == 0 and E.compare(of[a], of[b])[2] < 2}
    assert len(far) > 50 and set(likely) == set(whole) - far and len(likely) == len(set(likely))
    p = [(1, "Linnea Dunhoff", "linnea291@x.test", "576.555.1907", "Brickhaven", None, None)]
    c = [(10 + i, "Linnea Dunhoff", "linnea291@x.test", "576.555.1907", f"Town{i}", None, None) for i in range(50)]
    got = {(x["a"], x["b"]) for x in E.match(frame(spark, p, 0), frame(spark, c, 1)).collect()}
    assert got == {(1, 10 + i) for i in range(50)}


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(0)
    nouns = {"sport": "team match coach serve goal race", "law": "court judge clause lease appeal deed"}
    verbs = {"sport": ["the {} trained hard for the final round", "our {} won the league after a long season"], "law": ["the {} was declared void before a witness", "nobody may contest the {} in open session"]}
    shop = ["my order has not arrived yet at home", "please send the receipt for it again", "the box was crushed and the lamp is broken"]
    docs, truth = [], {}
    for i in range(400):
        kinds = r.choice([[], ["sport"], ["law"], ["sport", "law"]])
        s = [r.choice(shop) for _ in range(3)]
        for k in kinds:
            s += [r.choice(verbs[k]).format(r.choice(nouns[k].split())) for _ in range(3)]
        r.shuffle(s)
        docs.append((i, ". ".join(s) + "."))
        truth[i] = set(kinds)
    return docs, truth


def test_subjects_held_out(spark, corpus):
    docs, truth = corpus
    labels = [(i, s) for i in range(0, 400, 8) for s in (truth[i] or {None})] + [(8, None), (9999, "law"), (None, "law"), (16, "unknown area")]
    d = spark.createDataFrame(docs + [(1000, None), (1001, ""), (1002, "x " * 30000), (None, "text")], "doc_id long, text string").selectExpr("*", "'n' as subject")
    rows = S.propagate(d, spark.createDataFrame(labels, "doc_id long, subject string"), ["law", "sport"]).collect()
    got: dict[int, set] = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    held = [i for i in truth if i % 8]
    assert sum(got.get(i, set()) == truth[i] for i in held) / len(held) > 0.95
    assert not {1000, 1001, 1002, None} & set(got)


def test_subjects_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert S.propagate(d, spark.createDataFrame([], "doc_id long, subject string"), ["law", "sport"]).count() == 0


def test_links_are_verified_and_few(spark):
    """Every link's similarity against brute force; no sentence has more links than twice its pairs and itself."""
    r = random.Random(8)
    texts = [f"the {r.choice('abcdefgh')}{k % 40} trained hard for round {r.choice('uvwxyz')} and {r.choice(['won', 'lost', 'left early'])}" for k in range(150)] + ["a wholly other sentence", "a wholly other sentence here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = S.sentences(docs).groupBy("sent").agg(F.first("words").alias("words")).select("sent", S._pairs(F.col("words")).alias("pairs"))
    pairs = {x["sent"]: set(x["pairs"]) for x in nodes.collect()}
    links = [tuple(x) for x in S.similarity_links(nodes).collect()]
    sim = lambda a, b: len(pairs[a] & pairs[b]) / min(len(pairs[a]), len(pairs[b]))
    assert all(abs(x - sim(a, b)) < 1e-9 and x >= 0.5 for a, b, x in links) and len({(a, b) for a, b, _ in links}) == len(links)
    for a in pairs:
        assert (a, a) in {(x, y) for x, y, _ in links if x == a} and sum(x == a for x, _, _ in links) <= 2 * len(pairs[a]) + 1
    assert any(a != b for a, b, _ in links)
    assert S.similarity_links(nodes.where("false")).count() == 0


def test_all_links_are_found(spark):
    """The links, and the weights gathered over them, against brute force over all pairs, in one block and in several."""
    r = random.Random(4)
    words = [f"{a}{b}" for a in "bdfgk" for b in ("an", "el", "or")]
    texts = [f"the {r.choice(words)} trained hard for the {r.choice(words)} and then {r.choice(words)} {r.choice(['won', 'lost', 'left early'])}" for _ in range(300)] + ["a wholly other sentence"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = S.sentences(docs).groupBy("sent").agg(F.first("words").alias("words")).select("sent", S._pairs(F.col("words")).alias("pairs")).localCheckpoint()
    pairs = {x["sent"]: set(x["pairs"]) for x in nodes.collect()}
    sim = lambda a, b: len(pairs[a] & pairs[b]) / min(len(pairs[a]), len(pairs[b]))
    want = {(a, b): sim(a, b) for a in pairs for b in pairs if sim(a, b) >= 0.5}
    assert max(sum(a == x for a, _ in want) for x in pairs) > 2 * 20 + 1  # more than the exemplars of its pairs
    for size in (32_768, 60):
        got = [tuple(x) for x in S.similarity_links(nodes, 0.5, size).collect()]
        assert len(got) == len(want) and all(abs(want[a, b] - x) < 1e-9 for a, b, x in got)
    blocks, n = S.sentence_blocks(nodes, 60)
    mass = {a: float(k % 7) for k, a in enumerate(sorted(pairs)) if k % 3}
    rows = spark.createDataFrame([(a, v, 1.0) for a, v in mass.items()], "sent long, whole double, w0 double")
    summed = {x["sent"]: (x["whole"], x["w0"]) for x in S.gathered(rows, blocks, S.linked_cells(blocks, n), n).collect()}
    for a in pairs:
        assert abs(summed[a][0] - sum(v * want.get((a, b), 0) for b, v in mass.items())) < 1e-6 and abs(summed[a][1] - sum(want.get((a, b), 0) for b in mass)) < 1e-6
    few = [list(S._alike(*[np.array(y) for y in ([2, 2, 2], [1, 2, 1, 3, 2, 3], [2, 2], [1, 2, 4, 5])], 0.5, False, most)) for most in (1, 100)]
    assert [x[0] for x in few[0]] == [0, 1, 2] and np.concatenate([x[2] for x in few[0]]).tolist() == few[1][0][2].tolist() == [0, 0, 0]


def test_links_stay_where_they_are_dealt(spark):
    """Gathering shuffles the weights but not the links, gives the same sums, and the shuffle files of finished steps go."""
    r = random.Random(6)
    nodes = spark.createDataFrame([(k, [r.randrange(12) for _ in range(4)]) for k in range(40)], "sent long, pairs array<int>").selectExpr("sent", "array_distinct(pairs) as pairs")
    blocks, n = S.sentence_blocks(nodes, 20)
    cells = S.linked_cells(blocks, n)
    mass = spark.range(0, 40, 3).selectExpr("id as sent", "id + 0.5d as whole")
    plain, kept = S.cut_lineage(cells), S.kept_cells(cells, n)
    loose, fixed = (S.gathered(mass, blocks, x, n) for x in (plain, kept))
    exchanges = [x._jdf.queryExecution().sparkPlan().toString().count("Exchange") + x._jdf.queryExecution().executedPlan().toString().count("Exchange") for x in (loose, fixed)]
    assert n == 2 and exchanges[1] == exchanges[0] - 1
    sums = [dict(map(tuple, x.collect())) for x in (loose, fixed)]
    assert sums[0].keys() == sums[1].keys() == set(range(40)) and all(abs(sums[0][k] - sums[1][k]) < 1e-9 for k in sums[0])
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: set(re.findall(r"shuffle_\d+_\d+_0\.data", disk.getAllFiles().mkString(" ")))
    before = shuffled()
    S.cut_lineage(spark.range(100).repartition(3))
    left = shuffled() - before
    end = time.monotonic() + 20
    while shuffled() & left and time.monotonic() < end:
        S.settled(spark.range(1))
    assert left and not shuffled() & left
