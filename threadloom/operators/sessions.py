"""Sessions by inactivity as cuts of a Cartesian tree over the gaps between an entity's events.

The Cartesian tree of an entity's gap sequence (root: the longest gap, left and right of it the trees of the
gaps before and after) is a dendrogram of its events: every subtree is a run of events whose inner gaps are at
most its root's gap.  ``session_tree`` stores each subtree as one row with its own height (longest inner gap)
and the height of its parent, so the sessions for *any* threshold T are ``height <= T < parent height``: a
filter without a window or a shuffle, reusable for as many gap settings as wanted.

Construction: events are counted by entity and instant, range-partitioned and sorted by both (so an entity with
a third of all events is spread over many tasks), and one linear pass with a stack builds the tree of each
chunk (the part of an entity in one task).  Subtrees that touch neither end of a chunk are final and leave at
once.  What is left, the alternating gaps and finished runs on a chunk's two spines, is all that a neighbour
can change; those are merged in rounds of ``fan_in`` neighbouring chunks by the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import cut_lineage

#: A run of events, and the gap before it (null at the start of a chunk).
ITEM = "start_us long, end_us long, n_events long, height_us long"


class _Spine:
    """The still open part of one chunk: runs ``[start, end, n, height]`` in order.

    Invariant: the gaps between neighbouring runs first rise strictly to the greatest, then fall weakly.  A gap
    that is smaller than the one before it and not greater than the one after it joins its two sides into a
    subtree, since no neighbour of the chunk can come between.
    """

    def __init__(self) -> None:
        self.runs: list[tuple[int, int, int, int]] = []
        self.final: list[tuple[int, int, int, int, int]] = []

    def add(self, run: tuple[int, int, int, int]) -> None:
        runs = self.runs
        # Every gap that is exceeded on both sides is closed now; ties close to the left.
        while len(runs) >= 3:
            a, b, c = runs[-3], runs[-2], runs[-1]
            before, mid, after = b[0] - a[1], c[0] - b[1], run[0] - c[1]
            if mid <= before and mid <= after:
                self._join(b, c, mid)
            else:
                break
        runs.append(run)

    def _join(self, b: tuple, c: tuple, gap: int) -> None:
        for x in (b, c):
            if x[3] < gap:  # a run as high as the gap is the same node of the (multi-way) tree
                self.final.append((*x, gap))
        self.runs[-2:] = [(b[0], c[1], b[2] + c[2], gap)]

    def close(self) -> None:
        """No neighbour will come: join everything, smallest gaps first."""
        runs = self.runs
        stack: list[tuple[int, int, int, int]] = []
        for run in [*runs, None]:
            while len(stack) >= 2:
                gap = stack[-1][0] - stack[-2][1]
                after = None if run is None else run[0] - stack[-1][1]
                before = stack[-2][0] - stack[-3][1] if len(stack) >= 3 else None
                if (after is None or gap <= after) and (before is None or gap <= before):
                    b, c = stack[-2], stack[-1]
                    for x in (b, c):
                        if x[3] < gap:
                            self.final.append((*x, gap))
                    stack[-2:] = [(b[0], c[1], b[2] + c[2], gap)]
                else:
                    break
            if run is not None:
                stack.append(run)
        self.final += [(*x, None) for x in stack]
        self.runs = []


_OUT = "entity string, chunk long, start_us long, end_us long, n_events long, height_us long, parent_us long, open boolean"


def _frame(entity: list, chunk: list, rows: list, opened: list) -> pd.DataFrame:
    s, e, n, h, p = zip(*rows) if rows else ((),) * 5
    as_long = lambda x: pd.array(x, dtype="Int64")
    return pd.DataFrame(
        {"entity": entity, "chunk": as_long(chunk), "start_us": as_long(s), "end_us": as_long(e), "n_events": as_long(n), "height_us": as_long(h), "parent_us": as_long(p), "open": opened}
    )


def _pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by entity, group and time; one spine at a time, flushed in bounded blocks."""
    key, spine = None, _Spine()
    entity: list = []
    chunk: list = []
    rows: list = []
    opened: list = []

    def flush(done: bool) -> None:
        if key is None:
            return
        for x in spine.final:
            entity.append(key[0]), chunk.append(key[1]), rows.append(x), opened.append(False)
        spine.final = []
        if done:
            if key[2]:
                spine.close()
                return flush(False)
            for x in spine.runs:
                entity.append(key[0]), chunk.append(key[1]), rows.append((*x, None)), opened.append(True)

    for batch in batches:
        for e, c, last, *run in batch[["entity", "chunk", "last", "start_us", "end_us", "n_events", "height_us"]].itertuples(index=False):
            if key is None or key[0] != e or key[1] != c:
                flush(True)
                key, spine = (e, c, last), _Spine()
            spine.add(tuple(run))
            if len(rows) + len(spine.final) >= 50_000:
                flush(False)
                yield _frame(entity, chunk, rows, opened)
                entity, chunk, rows, opened = [], [], [], []
    flush(True)
    if rows:
        yield _frame(entity, chunk, rows, opened)


def session_tree(events: DataFrame, entity: str, time_us: str, fan_in: int = 64, partitions: int | None = None) -> DataFrame:
    """All subtrees: ``entity, start_us, end_us, n_events, height_us, parent_us``.

    ``height_us`` is the longest gap inside (0 for a single instant), ``parent_us`` the gap that ends the run on
    its nearer side (null: none, the run is all of the entity).  Rows with a null entity or time are no events;
    repeated rows and ties count each; other columns are ignored, whatever their names; an empty table gives an
    empty tree.
    """
    spark = events.sparkSession
    points = (
        events.select(F.col(entity).cast("string").alias("entity"), F.col(time_us).cast("long").alias("start_us"))
        .where("entity is not null and start_us is not null")
        .groupBy("entity", "start_us")
        .agg(F.count("*").alias("n_events"))
    )
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = points.repartitionByRange(n, "entity", "start_us").sortWithinPartitions("entity", "start_us")
    items = ordered.select(
        "entity", F.spark_partition_id().cast("long").alias("chunk"), F.lit(False).alias("last"),
        "start_us", F.col("start_us").alias("end_us"), "n_events", F.lit(0).cast("long").alias("height_us"),
    )
    done = cut_lineage(items.mapInPandas(_pass, _OUT))
    parts = [done.where("not open")]
    while True:
        rest = done.where("open")
        chunks = rest.groupBy("entity").agg(F.countDistinct("chunk").alias("k"))
        widest = chunks.agg(F.max("k")).first()[0]
        if widest is None:
            break
        # Chunks of one entity have consecutive numbers, so neighbours meet in the same group.
        low = rest.groupBy("entity").agg(F.min("chunk").alias("low"), F.countDistinct("chunk").alias("k"))
        merged = (
            rest.join(low, "entity")
            .select(
                "entity", F.floor((F.col("chunk") - F.col("low")) / fan_in).cast("long").alias("chunk"),
                (F.col("k") <= fan_in).alias("last"), "start_us", "end_us", "n_events", "height_us",
            )
            .repartition(n, "entity", "chunk")
            .sortWithinPartitions("entity", "chunk", "start_us")
        )
        done = merged.mapInPandas(_pass, _OUT)
        if widest <= fan_in:
            parts.append(done)
            break
        done = cut_lineage(done)
        parts.append(done.where("not open"))
    tree = parts[0]
    for p in parts[1:]:
        tree = tree.unionByName(p)
    return tree.select("entity", "start_us", "end_us", "n_events", "height_us", "parent_us")


def cut_sessions(tree: DataFrame, gap_us: int) -> DataFrame:
    """The sessions at one threshold: a new one begins where more than ``gap_us`` lie between events."""
    keep = (F.col("height_us") <= gap_us) & (F.col("parent_us").isNull() | (F.col("parent_us") > gap_us))
    return tree.where(keep).select("entity", "start_us", "end_us", (F.col("end_us") - F.col("start_us")).alias("duration_us"), "n_events")
