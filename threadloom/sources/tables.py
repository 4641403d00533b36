"""JSON sources and sinks of the pipeline, control lists and configuration."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MESSAGE = (
    "message_id string, conversation_id string, source string, timestamp string, speaker string, text string, ordinal bigint, metadata map<string,string>"
)
CONVERSATION = (
    "conversation_id string, source string, start_timestamp string, end_timestamp string, "
    "messages array<struct<message_id:string,conversation_id:string,timestamp:string,speaker:string,text:string>>, metadata map<string,string>"
)


def read_json(spark: SparkSession, paths: str | list[str], schema: str, multi_line: bool = True, strict: bool = False) -> DataFrame:
    """JSON documents with a fixed schema; corrupt ones are skipped, or raise if ``strict``; missing folders are skipped."""
    found = [p for p in ([paths] if isinstance(paths, str) else paths) if "://" in p or os.path.exists(p)]
    if not found:
        return spark.createDataFrame([], schema)
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(found, multiLine=multi_line)
    full = StructType.fromDDL(f"{schema}, _corrupt string")
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(found, multiLine=multi_line)
    return rows.where(F.col("_corrupt").isNull()).drop("_corrupt")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    """(Hadoop file system of a path, function from text to its path object); local and shared stores alike."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    return at(path).getFileSystem(conf), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at(path))


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at(path), True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where it is missing."""
    fs, at = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at(path))) if fs.exists(at(path)) else []


def read_text(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path, wholetext=True).first()
    return row[0] if row else ""


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """One small file, replaced as a whole."""
    fs, at = _file_system(spark, path)
    out = fs.create(at(path), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_replacing(df: DataFrame, path: str) -> None:
    """Replace a table that ``df`` may itself read: a new version beside it, then a swap."""
    fresh, old = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").parquet(fresh)
    fs, at = _file_system(df.sparkSession, path)
    fs.delete(at(old), True)
    if fs.exists(at(path)):
        fs.rename(at(path), at(old))
    fs.rename(at(fresh), at(path))
    fs.delete(at(old), True)


def save_raw(spark: SparkSession, base: str, source: str, name: str, content: str | dict) -> str:
    """Keep one raw record as it came: JSON of a dictionary, else the text; an error says which record it was."""
    path = f"{base}/{source}/{name}"
    try:
        write_text(spark, json.dumps(content, ensure_ascii=False, indent=2) if isinstance(content, dict) else content, path)
    except Exception as e:
        raise OSError(f"raw record {name} of {source} could not be written to {path}") from e
    return path


def control_list(path: str, default: list[str] | None = None) -> list[str]:
    """A JSON array of strings; the default (or none) where the file is missing or broken."""
    try:
        with open(path, encoding="utf-8") as f:
            x = json.load(f)
        return [str(v) for v in x] if isinstance(x, list) else list(default or [])
    except (OSError, ValueError):
        return list(default or [])


def update_control_list(path: str, add: list[str] = (), remove: list[str] = ()) -> list[str]:
    now = [x for x in control_list(path) if x not in set(remove)]
    now += [x for x in dict.fromkeys(add) if x not in now]
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(now, f, ensure_ascii=False, indent=2)
    return now


def gate_list(spark: SparkSession, path: str) -> list[str] | None:
    """The ids of a control list on any store; null where there is no such file, none where it cannot be read."""
    if not exists(spark, path):
        return None
    try:
        x = json.loads(read_text(spark, path))
    except ValueError:
        return []
    return [str(v) for v in x] if isinstance(x, list) else []


def ids_frame(spark: SparkSession, ids: list[str]) -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], "conversation_id string")


def write_report(report: dict, path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(report, f, ensure_ascii=False, indent=2, default=str)


def version_dir(base: str, version: str | None) -> str:
    return os.path.join(base, f"v{str(version).lstrip('v')}") if version else base


def load_env(path: str = ".env") -> None:
    """``KEY=value`` lines into the environment; set variables win."""
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                key, eq, value = line.strip().partition("=")
                if eq and key and not key.startswith("#"):
                    os.environ.setdefault(key.strip(), value.strip().strip("'\""))
