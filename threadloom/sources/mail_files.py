"""E-mail sources: ``eml`` directories and ``mbox`` files as Spark data sources (one row per message)."""

from __future__ import annotations

import email
import glob
import os
from collections.abc import Iterator
from email.message import Message

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEADERS = ("Message-ID", "From", "To", "Cc", "Bcc", "Subject", "Date")
SCHEMA = "raw_name string, source string, headers map<string,string>, body string, origin string"


def body_of(message: Message) -> str:
    """All text/plain parts that are no attachment, or the payload of a mail without parts; decoded, stripped."""

    def decoded(part: Message) -> str:
        data = part.get_payload(decode=True) or b""
        try:
            return data.decode(part.get_content_charset() or "utf-8", errors="replace")
        except LookupError:
            return data.decode("utf-8", errors="replace")

    if not message.is_multipart():
        return decoded(message).strip()
    parts = [p for p in message.walk() if p.get_content_type() == "text/plain" and "attachment" not in str(p.get("Content-Disposition", ""))]
    return "".join(map(decoded, parts)).strip()


def row_of(message: Message, fallback: str, origin: str) -> tuple[str, str, dict[str, str], str, str]:
    headers = {h: str(message.get(h, "") or "") for h in HEADERS}
    name = "".join(c if c.isalnum() else "_" for c in headers["Message-ID"]).strip("_")
    return name or fallback, "gmail", headers, body_of(message), origin


def read_eml(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``*.eml`` file under ``path``; Spark lists and splits the files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").load(path).select("path", "content")

    def parse(batches):  # noqa: ANN001, ANN202
        import pandas as pd

        for batch in batches:
            rows = [row_of(email.message_from_bytes(c), os.path.splitext(os.path.basename(p))[0], p) for p, c in zip(batch["path"], batch["content"])]
            yield pd.DataFrame(rows, columns=["raw_name", "source", "headers", "body", "origin"])

    return files.mapInPandas(parse, SCHEMA)


class _MboxReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]

    def partitions(self) -> list[InputPartition]:
        files = sorted(glob.glob(os.path.join(self.path, "*.mbox"))) if os.path.isdir(self.path) else [self.path]
        return [InputPartition(f) for f in files]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """Streams one file: a message is held at a time."""
        lines: list[bytes] = []
        n = 0
        with open(partition.value, "rb") as f:
            for line in f:
                if line.startswith(b"From ") and lines:
                    yield row_of(email.message_from_bytes(b"".join(lines)), f"email_mbox_{n}", f"{partition.value}#{n:09d}")
                    n, lines = n + 1, []
                elif not line.startswith(b"From "):
                    lines.append(line[1:] if line.startswith(b">From ") else line)
        if lines:
            yield row_of(email.message_from_bytes(b"".join(lines)), f"email_mbox_{n}", f"{partition.value}#{n:09d}")


class MboxDataSource(DataSource):
    """``spark.read.format("mbox").load(path)``: a partition per file of a folder, or one for a file."""

    @classmethod
    def name(cls) -> str:
        return "mbox"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _MboxReader(dict(self.options))


def read_mbox(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(MboxDataSource)
    return spark.read.format("mbox").load(path)


def last_per_name(raw: DataFrame) -> DataFrame:
    """Of messages stored under one name the one read last (by file name, then place in the file), as overwriting would leave it."""
    kept = F.max_by(F.struct("source", "headers", "body", "origin"), F.struct("origin", "body")).alias("r")
    return raw.groupBy("raw_name").agg(kept).select("raw_name", "r.*")
