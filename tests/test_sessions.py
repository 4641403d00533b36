import numpy as np
import pandas as pd
import pytest

from threadloom.operators.sessions import cut_sessions, session_tree
from threadloom.streaming.sessions import session_stream, start


def brute(df, gap):
    df = df.dropna().sort_values(["u", "t"])
    k = (df.groupby("u").t.diff() > gap).groupby(df.u).cumsum().rename("k")
    b = df.groupby(["u", k]).t.agg(["min", "max", "count"]).reset_index()
    return set(map(tuple, b[["u", "min", "max", "count"]].values))


@pytest.mark.parametrize("fan_in,partitions,span", [(2, 9, 20000), (64, 3, 300), (3, 7, 10**12)])
def test_tree_cuts_equal_sessions_at_every_gap(spark, fan_in, partitions, span):
    rng = np.random.default_rng(span % 97)
    df = pd.DataFrame({"u": rng.choice(list("abc"), 1500, p=[0.9, 0.05, 0.05]), "t": rng.integers(0, span, 1500)})
    tree = session_tree(spark.createDataFrame(df), "u", "t", fan_in=fan_in, partitions=partitions).toPandas()
    for gap in (0, 1, 3, span // 1000, span // 200, span // 50, span):
        q = tree[(tree.height_us <= gap) & (tree.parent_us.isna() | (tree.parent_us > gap))]
        assert len(q) == len(set(zip(q.entity, q.start_us)))
        assert set(map(tuple, q[["entity", "start_us", "end_us", "n_events"]].values)) == brute(df, gap)


def test_monotone_gaps_keep_long_spines(spark):
    t = np.cumsum(np.r_[np.arange(1, 400), np.arange(400, 0, -1)])
    df = pd.DataFrame({"u": "a", "t": t})
    tree = session_tree(spark.createDataFrame(df), "u", "t", fan_in=2, partitions=6)
    for gap in (0, 50, 399, 400):
        got = {tuple(r) for r in cut_sessions(tree, gap).select("entity", "start_us", "end_us", "n_events").collect()}
        assert got == brute(df, gap)


def test_nulls_ties_empty_and_clashing_columns(spark):
    rows = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), (None, 5, 3), ("b", None, 4), ("b", 7, 5)], "u string, t long, entity int")
    got = {tuple(r) for r in cut_sessions(session_tree(rows, "u", "t"), 10).collect()}
    assert got == {("a", 5, 5, 0, 2), ("b", 7, 7, 0, 1)}
    assert session_tree(rows.where("false"), "u", "t").count() == 0


def test_stream_gives_closed_sessions(spark, tmp_path):
    day = "2024-01-0{} 00:00:00"
    rows = [("a", day.format(1)), ("a", day.format(2)), ("b", day.format(1)), ("z", "2024-03-01 00:00:00")]
    spark.createDataFrame(rows, "u string, s string").selectExpr("u", "timestamp(s) as ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("u string, ts timestamp").parquet(str(tmp_path / "in"))
    start(session_stream(stream, "u", "ts"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = session_stream(spark.read.parquet(str(tmp_path / "in")), "u", "ts")
    closed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert closed == {tuple(r) for r in batch.where("u <> 'z'").collect()} and len(closed) == 2
