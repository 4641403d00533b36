"""Encoding of a whole corpus with a public byte-level BPE tokenizer, and decoding.

Method: global distinct-word shuffle.  A byte-level BPE never merges across pre-tokens, so a text's ids are the
concatenation of its pre-tokens' ids.  Texts are exploded into pre-tokens with their positions (repeats within a
text collapse to one row), each distinct pre-token of the corpus is encoded once, the ids are joined back and the
texts reassembled by position.

Skew: words such as " the" stand in nearly every text.  Words in more than 1 / ``hot_parts`` of all rows are at
most ``hot_parts`` by counting, so their ids are broadcast; all others are joined by shuffle.
"""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.session import cut_lineage

# Fixed value: the pre-token pattern of the byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT = "byte_bpe_50k.tiktoken"


def vocabulary(name: str = DEFAULT) -> str:
    return os.path.join(os.environ.get("THREADLOOM_TOKENIZERS", "/opt/tokenizers"), name)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoder(path: str):  # noqa: ANN201
    import tiktoken

    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file to every executor, new ones included; its name there (see ``shipped``)."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped(name: str) -> str:
    return SparkFiles.get(name)


def pre_tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key, word, positions``: a row for each distinct pre-token of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(PATTERN).findall
        for batch in batches:
            keys = batch.column(0)
            owners, words, flat, ends = [], [], array("i"), array("i", [0])

            def block() -> pa.RecordBatch:
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                return pa.RecordBatch.from_arrays([keys.take(pa.array(owners)), pa.array(words, pa.string()), lists], ["key", "word", "positions"])

            for row, text in enumerate(batch.column(1)):
                at: dict[str, list[int]] = {}
                for i, w in enumerate(find(text.as_py())):
                    at.setdefault(w, []).append(i)
                owners += [row] * len(at)
                words += at
                for p in at.values():
                    flat.extend(p)
                    ends.append(len(flat))
                if len(words) > 50_000:
                    yield block()
                    owners, words, flat, ends = [], [], array("i"), array("i", [0])
            if words:
                yield block()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.where(F.col(text_col).isNotNull() & (F.col(text_col) != "")).select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, word string, positions array<int>")


def encode_words(words: DataFrame, path: str) -> DataFrame:
    name = ship_file(words.sparkSession, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(shipped(name))
        for batch in batches:
            batch["ids"] = enc.encode_ordinary_batch(list(batch["word"]), num_threads=1)
            yield batch

    return words.mapInPandas(run, "word string, n long, ids array<int>")


def in_order(parts: pa.ListArray) -> pa.ListArray:
    """Per text the ids of its pre-tokens by position, from lists of (positions, ids); no Python object per token."""
    starts = np.asarray(parts.offsets)
    inner = parts.values.slice(starts[0], starts[-1] - starts[0]) if len(parts) else parts.values
    positions, ids = inner.field("positions"), inner.field("ids")
    pos_ends, id_ends = np.asarray(positions.offsets).astype(np.int64), np.asarray(ids.offsets).astype(np.int64)
    pos, tokens = np.asarray(positions.values)[pos_ends[0] : pos_ends[-1]], np.asarray(ids.values)[id_ends[0] : id_ends[-1]]
    n_pos, n_ids = np.diff(pos_ends), np.diff(id_ends)
    part_of_pos = np.repeat(np.arange(len(n_pos)), n_pos)
    per_text = np.add.reduceat(np.append(n_pos, 0), starts[:-1] - starts[0]) if len(parts) else np.zeros(0, np.int64)
    per_text = np.where(np.diff(starts) > 0, per_text, 0)
    first = np.concatenate([[0], np.cumsum(per_text)])
    text_of_part = np.repeat(np.arange(len(parts)), np.diff(starts))
    slot = np.empty(len(pos), np.int64)
    slot[first[text_of_part[part_of_pos]] + pos] = part_of_pos
    length = n_ids[slot]
    begin = (id_ends[:-1] - id_ends[0])[slot]
    ends = np.concatenate([[0], np.cumsum(length)])
    out = tokens[np.repeat(begin - ends[:-1], length) + np.arange(ends[-1])]
    return pa.ListArray.from_arrays(pa.array(ends[first].astype(np.int32)), pa.array(out.astype(np.int32)))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, hot_parts: int = 1000) -> DataFrame:
    """``<id>, ids ARRAY<INT>``: one row per id of ``docs``.

    Null and empty texts (and blank ones as the vocabulary has it) keep their row; of null and empty ones the ids
    are an empty list.  Strings that look like control tokens are ordinary text.  Rows repeated with one id must
    agree in their text and give one row; a null id is an id of its own.  Texts are encoded whole.
    """
    words = cut_lineage(pre_tokens(docs.dropDuplicates([id_col]), id_col, text_col))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    table = cut_lineage(encode_words(counts, path or vocabulary()))
    total = words.count()
    hot = table.where(F.col("n") > total / hot_parts).select("word", F.col("ids").alias("hot_ids"))
    rare = table.where(F.col("n") <= total / hot_parts).select("word", F.col("ids").alias("rare_ids"))
    marked = words.join(F.broadcast(hot), "word", "left")
    common = marked.where("hot_ids is not null").select("key", "positions", F.col("hot_ids").alias("ids"))
    others = marked.where("hot_ids is null").join(rare, "word").select("key", "positions", F.col("rare_ids").alias("ids"))
    placed = common.unionByName(others).groupBy("key").agg(F.collect_list(F.struct("positions", "ids")).alias("parts"))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), in_order(parts)], ["key", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    ordered = placed.mapInArrow(order, f"key {kind}, ids array<int>")
    everyone = docs.select(F.col(id_col).alias("key")).distinct()
    return everyone.join(ordered, everyone["key"].eqNullSafe(ordered["key"]), "left").select(
        everyone["key"].alias(id_col), F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    )


def decode(encoded: DataFrame, id_col: str = "doc_id", path: str | None = None) -> DataFrame:
    """``<id>, text``: the inverse, by a join with the token-byte table (the vocabulary's size bounds it)."""
    spark = encoded.sparkSession
    table = spark.createDataFrame([(i, bytearray(b)) for b, i in load_ranks(path or vocabulary()).items()], "token int, bytes binary")
    tokens = encoded.select(F.col(id_col).alias("key"), F.posexplode("ids").alias("pos", "token"))
    parts = tokens.join(F.broadcast(table), "token").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "bytes"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(bytearray()), lambda acc, p: F.concat(acc, p["bytes"]))
    texts = parts.select("key", F.decode(joined, "UTF-8").alias("text"))
    everyone = encoded.select(F.col(id_col).alias("key")).distinct()
    return everyone.join(texts, everyone["key"].eqNullSafe(texts["key"]), "left").select(everyone["key"].alias(id_col), F.coalesce("text", F.lit("")).alias("text"))
