"""Streaming forms of the id clusters and of counts by window: an extension, the batch operators define the results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, time: str, by: str, size: str = "10 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Rows and distinct readers are counted by event-time window; what comes later than ``late`` behind the newest does not count."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return events.withWatermark(time, late).groupBy(window, by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), by, "n")


def sessions(events: DataFrame, time: str, by: str, gap: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """W8 on event time: a session of one key ends where nothing follows within ``gap``."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def run_into(stream: DataFrame, name: str, mode: str = "append") -> None:
    """Runs a stream over all that is there into an in-memory table."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()


def run_into_folder(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream over all that is there; each batch's whole result replaces the Parquet table at ``path``.

    State and progress lie in ``checkpoint``, a shared folder, so a restarted run goes on where it was.
    """

    def replaced(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    query = stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(replaced).trigger(availableNow=True).start()
    query.awaitTermination()
