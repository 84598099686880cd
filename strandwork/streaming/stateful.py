"""Streams with state across batches: strand-insensitive dedupe (A1) and id clusters (W8), equal to their batch forms whatever the batches are.

State lies in the checkpoint folder, a shared one, so a stopped run goes on where it was.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandwork.functions.dna import strand_key


def deduped(reads: DataFrame, order: str, time: str | None = None, late: str = "1 hour") -> DataFrame:
    """A1. The first read by ``order`` of each sequence or its reverse complement, with ``dupes``, so far: a stream in complete or update mode.

    Minimum and count are state of fixed size for each different sequence. With ``time`` sequences are told apart by hour windows of that column, and
    the state of a window goes once the stream is ``late`` behind it.
    """
    keyed = reads.withColumn("__strand", strand_key(F.col("seq")))
    keys = ["__strand"]
    if time:
        keyed, keys = keyed.withWatermark(time, late), ["__strand", F.window(time, "1 hour")]
    first = F.min_by(F.struct(*reads.columns), F.col(order)).alias("__row")
    return keyed.groupBy(*keys).agg(first, (F.count("*") - 1).alias("dupes")).select("__row.*", "dupes")


def joined(ranges: list[tuple[int, int, int]], ids: list[int], gap: int) -> list[tuple[int, int, int]]:
    """(first, last, n) of clusters with more ids: what lies at most ``gap`` apart is one cluster. ``ranges`` is sorted and stays so."""
    for i in sorted(ids):
        at = bisect_left(ranges, (i, i, 0))
        lo, hi, first, last, n = at, at, i, i, 1
        while lo > 0 and first - ranges[lo - 1][1] <= gap:
            lo -= 1
            first, last, n = min(first, ranges[lo][0]), max(last, ranges[lo][1]), n + ranges[lo][2]
        while hi < len(ranges) and ranges[hi][0] - last <= gap:
            first, last, n = min(first, ranges[hi][0]), max(last, ranges[hi][1]), n + ranges[hi][2]
            hi += 1
        ranges[lo:hi] = [(first, last, n)]
    return ranges


CLUSTERS = "version long, first long, last long, n long"


def id_clusters(rows: DataFrame, key: str, number: str, gap: int, idle_ms: int = 0) -> DataFrame:
    """W8. The clusters of ``number`` in each ``key``: key, version, first, last, n. A stream in update mode: a key that gets rows gives all its
    clusters anew, under its next version, so the latest version of a key is what the batch form gives for all rows so far. Rows without a number
    don't count.

    The state is the clusters' ends, not their ids, in any order of arrival. With ``idle_ms`` a key that gets nothing for so long is
    forgotten: later rows begin new clusters, in version 1 again.
    """
    kind = rows.schema[key].dataType.simpleString()

    def run(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        version, firsts, lasts, counts = state.get if state.exists else (0, [], [], [])
        ranges = list(zip(firsts, lasts, counts, strict=True))
        for part in parts:
            joined(ranges, [int(i) for i in part[number].dropna()], gap)
        state.update((version + 1, *[[int(r[k]) for r in ranges] for k in range(3)]))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        if ranges:
            yield pd.DataFrame([(keys[0], version + 1, *r) for r in ranges], columns=[key, "version", "first", "last", "n"])

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return rows.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, {CLUSTERS}", "version long, firsts array<long>, lasts array<long>, counts array<long>", "update", timeout)


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream in update mode over all that is there; each batch's rows are added to the Parquet table at ``path``, with ``batch``. A batch that
    runs again after a failure replaces what it wrote before."""

    def added(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(added).trigger(availableNow=True).start()
    query.awaitTermination()


def latest(updates: DataFrame, key: str) -> DataFrame:
    """The rows of each key's latest version, of what run_updates() wrote."""
    last = updates.groupBy(F.col(key).alias("__k")).agg(F.max("version").alias("__v"))
    return updates.join(last, updates[key].eqNullSafe(F.col("__k")) & (F.col("version") == F.col("__v"))).drop("__k", "__v", "batch", "version")
