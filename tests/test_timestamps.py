import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from threadloom.operators.instants import accounts_frame, estimate_histories, message_instants, row_instants

ACCOUNTS = [("b", "mail", "Europe/Berlin", "dmy", "de"), ("n", "chat", "America/New_York", "mdy", "en"), ("k", "chat", "Asia/Kolkata", "dmy", "hi"), ("i", "mail", "Europe/Dublin", "dmy", "en"), ("c", "mail", "Asia/Shanghai", "dmy", "en")]
ROWS = "message_id string, account_id string, timestamp string, loaded_at timestamp"


def us(*a, zone="UTC"):
    return int(datetime(*a, tzinfo=ZoneInfo(zone)).timestamp() * 1_000_000)


CASES = [
    ("b", "2025-07-13T18:34:31Z", us(2025, 7, 13, 18, 34, 31)),
    ("b", "2025-07-13t18:34:31z ", us(2025, 7, 13, 18, 34, 31)),
    ("b", "‎[13.07.25, 18:34:31]", us(2025, 7, 13, 18, 34, 31, zone="Europe/Berlin")),
    ("n", "07/13/2025, 6:34 pm", us(2025, 7, 13, 18, 34, zone="America/New_York")),
    ("n", "7/1/25, 12:05 a.m.", us(2025, 7, 1, 0, 5, zone="America/New_York")),
    ("b", "Sun, 13 Jul 2025 18:34:31 +0530 (IST)", us(2025, 7, 13, 13, 4, 31)),
    ("b", "Sun, 10 Nov 2024 19:03:12 -0000", us(2024, 11, 10, 19, 3, 12)),
    ("b", "13 de julho de 2025, 18:34:31", us(2025, 7, 13, 18, 34, 31, zone="Europe/Berlin")),
    ("b", "24. März 2024, 03:53 Uhr", us(2024, 3, 24, 3, 53, zone="Europe/Berlin")),
    ("n", "January 14, 2024 at 11:50 AM", us(2024, 1, 14, 11, 50, zone="America/New_York")),
    ("b", "2023-07-03T08:05:31.314258559Z", us(2023, 7, 3, 8, 5, 31, 314258)),
    ("b", "2024-02-03 21:27:16,913", us(2024, 2, 3, 21, 27, 16, 913000, zone="Europe/Berlin")),
    ("b", "2025-12-21 10:40:44 +01:00 Europe/Berlin", us(2025, 12, 21, 9, 40, 44)),
    ("b", "2023-11-02T19:20:57+01:00[Europe/Paris]", us(2023, 11, 2, 18, 20, 57)),
    ("b", "2023-11-02 06:26:25 UTC+5:30", us(2023, 11, 2, 0, 56, 25)),
    ("b", "2024-09-14T20:28:09+01", us(2024, 9, 14, 19, 28, 9)),
    ("b", "20250413T031346Z", us(2025, 4, 13, 3, 13, 46)),
    ("b", "1738610213", 1738610213 * 1_000_000),
    ("b", "1743908454645", 1743908454645 * 1000),
    ("b", "2024/01/28 23:45", us(2024, 1, 28, 23, 45, zone="Europe/Berlin")),
    ("b", "2024-10-27 02:30:00", us(2024, 10, 27, 0, 30)),  # occurs twice: the first
    ("b", "2024-03-31 02:30:00", None),  # never occurs
    ("b", "31/02/2024 10:15", None),
    ("b", "2024-13-41T25:61:00Z", None),
    ("b", "13/07/25, 14:05 pm", None),
    ("b", "yesterday", None),
    ("b", "  ", None),
    ("b", None, None),
    ("zz", "2024-01-01 10:00:00", None),  # unknown account, no zone in the text
    ("zz", "2024-01-01 10:00:00 GMT", us(2024, 1, 1, 10)),
    (None, "2024-01-01T10:00:00Z", us(2024, 1, 1, 10)),
    ("i", "2024-07-01 10:00:00 IST", us(2024, 7, 1, 9)),  # the account's zone tells whose abbreviation it is
    ("c", "2024-07-01 10:00:00 CST", us(2024, 7, 1, 2)),
    ("n", "2024-01-01 10:00:00 CST", us(2024, 1, 1, 16)),
    ("k", "2024-07-01 10:00:00 IST", us(2024, 7, 1, 4, 30)),
    ("zz", "2024-07-01 10:00:00 IST", us(2024, 7, 1, 4, 30)),
]


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame(ACCOUNTS, "account_id string, source string, zone string, date_order string, locale string")


def test_notations(spark, accounts):
    rows = spark.createDataFrame([(str(i), a, t, None) for i, (a, t, _) in enumerate(CASES)], ROWS)
    got = {r["message_id"]: r["utc_us"] for r in row_instants(rows, accounts, estimate=False).collect()}
    assert {i: got[str(i)] for i in range(len(CASES))} == {i: c[2] for i, c in enumerate(CASES)}


def _local_rows(zone, n=400, seed=1, late=0.2):
    r = random.Random(seed)
    out = []
    for i in range(n):
        t = datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=r.randrange(2 * 365 * 86400))
        local = t.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S")
        lag = r.randrange(86400, 30 * 86400) if r.random() < late else r.randrange(1, 800)
        out.append((f"{zone}{i}", "x", local, t + timedelta(seconds=lag)))
    return out


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York", "Europe/London"])
def test_missing_zone_is_estimated(spark, zone):
    rows = spark.createDataFrame(_local_rows(zone), ROWS)
    accounts = spark.createDataFrame([("x", "s", None, None, "en")], "account_id string, source string, zone string, date_order string, locale string")
    got = row_instants(rows, accounts).collect()
    right = sum(abs(r["utc_us"] - us(*datetime.strptime(r["timestamp"], "%Y-%m-%d %H:%M:%S").timetuple()[:6], zone=zone)) == 0 for r in got if r["utc_us"] is not None)
    assert right >= 0.99 * len(got)


def test_wrong_declaration_is_repaired_and_right_one_kept(spark):
    from threadloom.functions import timestamps as T

    for declared, real in (("Europe/Paris", "Asia/Tokyo"), ("Europe/Madrid", "Europe/Madrid")):
        rows = spark.createDataFrame(_local_rows(real), ROWS)
        known = accounts_frame(spark.createDataFrame([("x", "s", declared, "dmy", "en")], "account_id string, source string, zone string, date_order string, locale string"))
        found = estimate_histories(rows.select("account_id", "loaded_at", T.parse_fields(F.col("timestamp")).alias("p")), known).first()
        assert found["zone"] == real


def test_copies_empty_and_extra_columns(spark, accounts):
    rows = spark.createDataFrame(
        [("m", "b", "2024-01-01 11:00", None, 1), ("m", "b", "2024-01-01T10:00:30Z", None, 2), ("c", "b", "2024-01-01T10:00:00Z", None, 3), (None, "b", "x", None, 4)], ROWS + ", zone int"
    )
    got = {r["message_id"]: r for r in message_instants(rows, accounts, estimate=False).collect()}
    assert set(got) == {"m", "c"} and got["m"]["utc_us"] == us(2024, 1, 1, 10, 0, 30) and not got["m"]["all_canonical"] and got["c"]["all_canonical"]
    assert message_instants(rows.where("false"), accounts).count() == 0
    assert message_instants(rows, accounts.where("false"), estimate=False).where("utc_us is not null").count() == 2


def test_only_the_exact_form_is_canonical(spark, accounts):
    texts = ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00Z\n", " 2024-01-01T10:00:00Z", "2024-01-01t10:00:00z", "2024-01-01T10:00:00.0Z"]
    rows = spark.createDataFrame([(str(i), "b", t, None) for i, t in enumerate(texts)], ROWS)
    got = {r["message_id"]: (r["utc_us"], r["all_canonical"]) for r in message_instants(rows, accounts, estimate=False).collect()}
    assert got == {str(i): (us(2024, 1, 1, 10), i == 0) for i in range(len(texts))}
