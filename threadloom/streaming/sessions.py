"""Sessions over a stream of events: the same rule as the batch operator, with a watermark for late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_stream(events: DataFrame, entity: str, ts: str, gap: str = "24 hours", late: str = "7 days") -> DataFrame:
    """``entity, start_ts, end_ts, n_events`` per session; works on streams and tables alike.

    On a stream a session leaves (append mode) once the watermark has passed its end, so the newest stays open;
    events later than ``late`` are dropped by the watermark, which also bounds the state.
    """
    marked = events.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
    if events.isStreaming:
        marked = marked.withWatermark(ts, late)
    found = marked.groupBy(entity, F.session_window(ts, gap)).agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count("*").alias("n_events"))
    return found.drop("session_window")


def start(stream: DataFrame, out: str, checkpoint: str, once: bool = True):  # noqa: ANN201
    """Write a session stream to Parquet; ``once`` works off what is there and stops."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(out)
