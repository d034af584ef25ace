"""A stream of names matched against the dimension tables: a stateless stream-static join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.operators.sizes import BROADCAST_ROWS


def match_stream(stream: DataFrame, index: DataFrame, on: str = "norm", at: str = "year", start: str = "start", end: str = "end") -> DataFrame:
    """Each event with the spans of its name that contain its year; the spans are a static table.

    index: on, entity_id, start, end. It is broadcast if it is small; Spark keeps no state for it.
    """
    side = F.broadcast(index) if index.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else index
    test = (F.col(f"s.{on}") == F.col(f"i.{on}")) & F.col(f"s.{at}").between(F.col(f"i.{start}"), F.col(f"i.{end}"))
    out = stream.alias("s").join(side.alias("i"), test, "left")
    return out.select("s.*", "i.entity_id", F.when(F.col("i.entity_id").isNotNull(), "auto_matched").otherwise("unmatched").alias("match_status"))


def status_by_window(matched: DataFrame, time: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by status and event-time window; rows later than the watermark are left out of closed windows."""
    return matched.withWatermark(time, late).groupBy(F.window(time, window), "match_status").count()


def run(stream: DataFrame, target: str, checkpoint: str, by: list[str] | None = None):
    """Append a stream as Parquet with exactly-once output by its checkpoint folder."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.partitionBy(*by) if by else writer).start(target)
