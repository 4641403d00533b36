"""Filling containers of fixed capacity with items of varying length, nearly without unused space.

Method: minimum bin slack.  For every container the largest item left is taken, and a subset-sum dynamic programme
over the lengths still available, held as one bit per reachable sum, finds the fullest feasible combination with
it; those items are removed.  Only items longer than the capacity are split, into full pieces and a rest.

Scale: items are dealt at random (by a hash of their id) to groups of about ``group_items``, each packed on its
own, so every task is bounded; a group leaves at most its last containers partly empty, a share that falls with
the group's size.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fullest(lengths: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """Of ``(length, available)`` the combination with the greatest sum within ``room``: (length, taken)."""
    reach = 1
    mask = (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # length, copies, sums reachable before
    for length, n in lengths:
        n = min(n, room // length)
        k = 1
        while n > 0:
            take = min(k, n)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            n -= take
            k <<= 1
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    for length, copies, before in reversed(steps):
        if not before >> best & 1:
            taken[length] += copies
            best -= length * copies
    return list(taken.items())


def pack(sizes: dict[int, list], capacity: int) -> list[list[tuple[int, object]]]:
    """Containers of one group: lists of (length, item).  ``sizes``: the items of each length; it is used up."""
    out = []
    order = sorted(sizes, reverse=True)
    while order:
        while order and not sizes[order[0]]:
            order.pop(0)
        if not order:
            break
        top = order[0]
        content = [(top, sizes[top].pop())]
        room = capacity - top
        if room > 0:
            available = [(x, len(sizes[x])) for x in order if x <= room and sizes[x]]
            if available:
                for length, n in fullest(available, room):
                    content += [(length, sizes[length].pop()) for _ in range(n)]
        out.append(content)
    return out


def fill_containers(items: DataFrame, containers: DataFrame, group_items: int = 4096) -> DataFrame:
    """``container_kind, container_no, doc_id, piece_no, start_token, n_tokens`` for every piece of every item.

    ``items``: ``doc_id, n_tokens``; ``containers``: ``container_kind, capacity_tokens`` (a short table).  Items
    without tokens (null counts as 0) take no room and have container null.  Containers without a positive
    capacity are left out; equal items, ties and empty tables are no special cases.  ``container_no`` is unique
    within its kind.
    """
    kinds = containers.where("capacity_tokens > 0 and container_kind is not null").groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity"))
    # Every item goes into a container of every kind; the kinds are a fixed table.
    wanted = items.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")).crossJoin(F.broadcast(kinds))
    cap = F.col("capacity")
    pieces = wanted.where("n_tokens > 0").select(
        "container_kind", "capacity", "doc_id", "n_tokens",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / cap))).alias("piece_no"),
    )
    pieces = pieces.select(
        "container_kind", "capacity", "doc_id", "piece_no", (F.col("piece_no") * cap).alias("start_token"),
        F.least(cap, F.col("n_tokens") - F.col("piece_no") * cap).alias("n_tokens"),
    )
    # Groups of about the same number of items for every kind.
    rest = pieces.where("n_tokens < capacity")
    groups = rest.groupBy("container_kind").agg(F.ceil(F.count("*") / group_items).alias("groups"))
    dealt = rest.join(groups, "container_kind").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece_no"), F.col("groups"))).drop("groups")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        kind, capacity, part = group["container_kind"].iloc[0], int(group["capacity"].iloc[0]), int(group["part"].iloc[0])
        group = group.sort_values(["n_tokens", "doc_id", "piece_no"])
        sizes: dict[int, list] = defaultdict(list)
        for row in group[["n_tokens", "doc_id", "piece_no", "start_token"]].itertuples(index=False):
            sizes[int(row[0])].append(row)
        rows = [(kind, f"{part}-{i}", *row) for i, content in enumerate(pack(sizes, capacity)) for _, row in content]
        return pd.DataFrame(rows, columns=["container_kind", "container_no", "n_tokens", "doc_id", "piece_no", "start_token"])

    out = ["container_kind", "container_no", "doc_id", "piece_no", "start_token", "n_tokens"]
    packed = dealt.groupBy("container_kind", "part").applyInPandas(run, "container_kind string, container_no string, n_tokens long, doc_id long, piece_no long, start_token long")
    full = pieces.where("n_tokens = capacity").withColumn("container_no", F.concat_ws("-", F.lit("full"), "doc_id", "piece_no"))
    nothing = wanted.where("n_tokens = 0").select(
        "container_kind", F.lit(None).cast("string").alias("container_no"), "doc_id", F.lit(0).cast("long").alias("piece_no"),
        F.lit(0).cast("long").alias("start_token"), "n_tokens",
    )
    return packed.select(*out).unionByName(full.select(*out)).unionByName(nothing.select(*out))
