"""Chat exports: text logs to one row per message, with window functions instead of a line loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.functions import textops as T

# The two header forms of exports (bracketless and bracketed).
DATE, CLOCK = r"(\d{1,2}[/\.-]\d{1,2}[/\.-]\d{2,4})", r"(\d{1,2}:\d{2}(?::\d{2})?(?:\s*[aApP][mM])?)"
PLAIN_HEADER = rf"^{DATE},\s+{CLOCK}\s+-\s+([^:]+):\s*(.*)$"
BRACKET_HEADER = rf"^\[{DATE},\s+{CLOCK}\]\s+([^:]+):\s*(.*)$"


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """``file, content`` of every ``*.txt`` under ``path``."""
    files = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("content"))


def parse(logs: DataFrame) -> DataFrame:
    """``file, ordinal, raw_date, raw_time, sender, text`` from ``file, content``.

    A header line opens a message; other lines continue it, blank ones as an empty line; lines before the first
    header are dropped; empty logs give nothing.
    """
    rows = logs.select("file", F.posexplode(T.lines(F.col("content"))).alias("line_no", "line"))
    blank = T.strip(F.col("line")) == ""
    plain, bracket = F.col("line").rlike(PLAIN_HEADER), F.col("line").rlike(BRACKET_HEADER)
    get = lambda k: F.when(plain, F.regexp_extract("line", PLAIN_HEADER, k)).otherwise(F.regexp_extract("line", BRACKET_HEADER, k))
    is_header = (plain | bracket) & ~blank
    number = F.sum(F.when(is_header, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("line_no"))
    rows = rows.withColumn("n", number).where("n > 0").withColumn("head", is_header).withColumn("blank", blank)
    piece = F.when(F.col("head"), get(4)).when(F.col("blank"), "").otherwise(F.col("line"))
    return (
        rows.groupBy("file", "n")
        .agg(
            F.max(F.when(F.col("head"), get(1))).alias("raw_date"), F.max(F.when(F.col("head"), get(2))).alias("raw_time"),
            F.max(F.when(F.col("head"), T.strip(get(3)))).alias("sender"), F.array_sort(F.collect_list(F.struct("line_no", piece.alias("t")))).alias("p"),
        )
        .select("file", (F.col("n") - 1).alias("ordinal"), "raw_date", "raw_time", "sender", F.array_join(F.transform("p", lambda x: x["t"]), "\n").alias("text"))
    )


# Notations tried in this order, day before month first.
_PATTERNS = [
    "d/M/yyyy H:mm:ss", "d/M/yy H:mm:ss", "d/M/yyyy H:mm", "d/M/yy H:mm", "d/M/yyyy h:mm:ss a", "d/M/yy h:mm:ss a", "d/M/yyyy h:mm a", "d/M/yy h:mm a",
    "M/d/yyyy H:mm:ss", "M/d/yy H:mm:ss", "M/d/yyyy h:mm a", "M/d/yy h:mm a",
]


def timestamp(date: Column, clock: Column, now: Column) -> Column:
    """UTC instant of an export's date and clock; ``now`` where no notation fits (two-digit years pivot at 69)."""
    x = F.upper(T.strip(F.concat_ws(" ", date, clock)))
    tries = []
    for p in _PATTERNS:
        t = F.try_to_timestamp(x, F.lit(p))
        tries.append(F.when((F.lit("yyyy" not in p)) & (F.year(t) >= 2069), F.add_months(t, -1200).cast("timestamp")).otherwise(t) if "yyyy" not in p else t)
    return F.coalesce(*tries, now)
