import pytest

from threadloom.llm import pii as P

TABLE = P.NameTable(first=frozenset("viktor will mark rose dean hanna oskar".split()), last=frozenset("kessman dunhoff galquist".split()))
CASES = [
    ("write to jo.doe@x.test, please", [("email", "jo.doe@x.test")]),
    ("jo9 (at) mail (dot) test!", [("email", "jo9 (at) mail (dot) test")]),
    ("call me on +33 839 555 5256.", [("phone", "+33 839 555 5256")]),
    ("Tel. (844) 555-8242", [("phone", "(844) 555-8242")]),
    ("T: 0049 333 5550263", [("phone", "0049 333 5550263")]),
    ("barcode 501-361-6388 is printed twice", []),
    ("Parcel 264613146127 and order #12345678", []),
    ("my ID number is 0624 2715 2862 if needed", [("id_number", "0624 2715 2862")]),
    ("barcode 2646 9208 6423 is wrong", []),
    ("Meine Steuernummer ist 00 239 418 122.", [("id_number", "00 239 418 122")]),
    ("Send it to 14B Old Beacon Close, 52791 Westerholt instead", [("address", "14B Old Beacon Close")]),
    ("merci de livrer au 27 bis avenue Tilleuls, 27857 Devpura", [("address", "27 bis avenue Tilleuls")]),
    ("Bitte liefern Sie an Harrowstr. 103, 45128 Pradofino", [("address", "Harrowstr. 103")]),
    ("we sold 9 more, by the way", []),
    ("Hi Dean,\nall fine", [("name", "Dean")]),
    ("Please speak to Viktor Kessman about it", [("name", "Viktor Kessman")]),
    ("bitte fragen Sie Herrn Dunhoff danach", [("name", "Dunhoff")]),
    ("Mark the box, will it fit a dean's office, maybe rose", []),
    ("the damaged Oskar lamp", []),
    ("Thanks,\nHanna", [("name", "Hanna")]),
    ("IBAN DE89 3704 0044 0532 0130 00 please", [("iban", "DE89 3704 0044 0532 0130 00")]),
    ("card 4111 1111 1111 1111 expires", [("card", "4111 1111 1111 1111")]),
    ("My passport number is AB123456", [("id_number", "AB123456")]),
    ("identity card number is C12345", [("id_number", "C12345")]),
    ("passport number AB12345", [("id_number", "AB12345")]),
    ("please deliver to 12 old mill court on friday", [("address", "12 old mill court")]),
    ("PLEASE SEND IT TO 12 OLD MILL TERRACE TODAY", [("address", "12 OLD MILL TERRACE")]),
    ("merci de livrer au 12 chemin des lilas", [("address", "12 chemin des lilas")]),
    ("we waited 2 weeks in a row for 3 boxes", []),
    ("my number on the order is odd, the back of the phone reads 401-361-6388", []),
    ("we took 3 @ 12.50 each", []),
    ("write to " + "a" * 80 + "@x.test now", [("email", "a" * 80 + "@x.test")]),
    ("", []),
]


@pytest.mark.parametrize("text,want", CASES)
def test_spans(text, want):
    got = [(k, text[a:b]) for a, b, k, _ in P.find_spans(text, TABLE)]
    assert got == want


def test_lines_passed_over_hold_nothing():
    """What is skipped (lines without digits or with few) changes no result: against every pattern over the whole text."""
    texts = [c[0] for c in CASES] + ["\n".join(c[0] for c in CASES), " \n".join(c[0] for c in reversed(CASES))]
    texts += [f"{t}\n1 a 2 b 3\n{t.upper()}" for t in texts]
    for t in texts:
        everything = P.email_spans(t) + list(P.number_spans(t)) + list(P.address_spans(t))
        assert P._best(everything) == [s for s in P.find_spans(t, P.NameTable()) if s[2] != "name"]


def test_long_texts_take_time_in_proportion():
    import time

    def took(n):
        text = "Hanna Kessman lives at 12 Old Mill Court, tel. +33 839 555 5256 or jo.doe@x.test, order 4711 " * n
        began = time.process_time()
        assert len(P.find_spans(text, TABLE)) == 4 * n
        return time.process_time() - began

    took(50)
    assert took(3200) < 24 * took(400) + 0.5


def test_checksums():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")
    assert P.mod97("DE89370400440532013000") and not P.mod97("DE89370400440532013001")
    assert P.check_letter("12345678Z") and not P.check_letter("12345678A")


def test_spark(spark):
    rows = [("a", "Hi Dean, mail jo@x.test", None), ("b", None, None), ("c", "", "x"), ("d", "jo@x.test " * 5000, None), ("a", "Hi Dean, mail jo@x.test", None)]
    df = spark.createDataFrame(rows, "message_id string, text string, speaker_name string").selectExpr("*", "1 as spans")
    got = {r["message_id"]: r for r in P.find_pii(df, TABLE).collect()}
    assert got["a"]["scrubbed"] == "Hi [NAME], mail [EMAIL]" and got["b"]["scrubbed"] is None and got["c"]["spans"] == [] and len(got["d"]["spans"]) == 5000
    assert P.find_pii(df.where("false"), TABLE).count() == 0
    names = spark.createDataFrame([(f"{f} {n}",) for f in ("Ann", "Bo", "Cy") for n in ("Kessman", "Dunhoff", "Hall")] + [(None,), ("+1 555",)], "name string")
    t = P.learn_names(names)
    assert {"ann", "bo", "cy"} <= t.first and {"kessman", "hall"} <= t.last


def test_rare_names_are_found(spark):
    """A name part borne once is found, whatever the size of the table of frequent parts and of the buckets."""
    names = spark.createDataFrame([(f"{f} {n}",) for f in ("Ann", "Bo", "Cy") for n in ("Kessman", "Dunhoff", "Hall")] + [("Zofka Quirr",)], "name string")
    table, rare = P.learn_all_names(names)
    assert "quirr" not in table.last and {tuple(r) for r in rare.collect()} == {("zofka", True, False), ("quirr", False, True)}
    rows = [("a", "The parcel was taken by Quirr yesterday.", None), ("b", "please speak to zofka quirr about it", None), ("c", "I met Ann Hall and zofka there", None), ("d", None, None)]
    df = spark.createDataFrame(rows * 2, "message_id string, text string, speaker_name string")
    for size in (5000, 1):
        got = [(r["message_id"], [s["pii_text"] for s in r["spans"] or []]) for r in P.find_pii(df, table, rare, size).collect()]
        assert sorted(got) == sorted([("a", ["Quirr"]), ("b", ["zofka quirr"]), ("c", ["Ann Hall"]), ("d", [])] * 2)
