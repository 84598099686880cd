"""Sharding by fixed virtual slots.

Every record hashes into one of ``n_slots`` virtual slots for ever, by its doc_id, its text's checksum and, where rows are repeated,
the number of its copy: so neither null ids nor one record that makes up much of the table crowd a slot. Bytes are summed
per slot, and a small versioned map says which shard holds each slot. Rebalancing edits the map: records never hash anew, only
whole slots move.

* The first version deals slots by size, largest first, to the shard that is lightest so far, so shards get near equal bytes.
* ``grow`` makes the next version for more shards: slots move only into the new shards.

The map is a table of ``n_slots`` rows (a fixed number, so it may be broadcast and held by the driver).
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.llm.common import new_path, written

N_SLOTS = 4096
#: Bytes that each record adds besides its text.
ROW_BYTES = 8


def slot_of(n_slots: int = N_SLOTS) -> Column:
    """The virtual slot of a record, from doc_id, text_crc32 and copy (0 but for repeated rows)."""
    return F.pmod(F.xxhash64("doc_id", "text_crc32", "copy"), F.lit(n_slots)).cast("int")


@dataclass(frozen=True)
class SlotMap:
    """One version of the slot-to-shard map."""

    version: int
    shards: int
    shard: tuple[int, ...]

    @classmethod
    def by_bytes(cls, size: list[int], shards: int) -> SlotMap:
        """Largest slot first, to the lightest shard (ties: the lower number). Empty slots are dealt in turn."""
        load = [(0, k) for k in range(shards)]
        out = [k % shards for k in range(len(size))]
        for k in sorted(range(len(size)), key=lambda k: (-size[k], k)):
            if size[k]:
                have, to = heapq.heappop(load)
                out[k] = to
                heapq.heappush(load, (have + size[k], to))
        return cls(1, shards, tuple(out))

    def grow(self, size: list[int], shards: int) -> SlotMap:
        """The next version, for more shards: slots go from the heaviest old shards into the new ones and nowhere else."""
        if shards <= self.shards:
            raise ValueError("grow() adds shards")
        aim = sum(size) / shards
        load = [0] * shards
        own: list[list[int]] = [[] for _ in range(shards)]
        out = list(self.shard)
        for k, to in enumerate(out):
            load[to] += size[k]
            own[to].append(k)
        for slots in own:
            slots.sort(key=lambda k: (size[k], k))
        heap = [(-load[k], k) for k in range(self.shards)]
        heapq.heapify(heap)
        for new in range(self.shards, shards):
            while heap:
                have, old = heapq.heappop(heap)
                fit = next((k for k in reversed(own[old]) if size[k] and load[new] + size[k] <= aim), None)
                if fit is None:
                    if -have > aim:
                        continue
                    heapq.heappush(heap, (have, old))
                    break
                own[old].remove(fit)
                out[fit] = new
                load[new] += size[fit]
                heapq.heappush(heap, (have + size[fit], old))
        return SlotMap(self.version + 1, shards, tuple(out))

    def rows(self, spark: SparkSession) -> DataFrame:
        rows = [(self.version, self.shards, k, to) for k, to in enumerate(self.shard)]
        return spark.createDataFrame(rows, "version int, shards int, slot int, shard int").coalesce(1)

    def save(self, spark: SparkSession, path: str) -> None:
        """Adds this version to the stored map; older versions stay readable."""
        self.rows(spark).write.mode("append").partitionBy("version").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """The given version, or the latest."""
        stored = spark.read.schema("shards int, slot int, shard int, version int").parquet(path)
        if version is None:
            version = stored.agg(F.max("version")).first()[0]
        rows = stored.where(F.col("version") == version).orderBy("slot").collect()
        return cls(version, rows[0]["shards"], tuple(r["shard"] for r in rows))


def slot_sizes(rows: DataFrame, n_slots: int = N_SLOTS) -> tuple[list[int], list[int]]:
    """(bytes, rows) of each slot from columns ``virtual_slot`` and ``size``: n_slots rows at most reach the driver."""
    size, count = [0] * n_slots, [0] * n_slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect():
        size[r["virtual_slot"]], count[r["virtual_slot"]] = r["b"], r["n"]
    return size, count


def shard(docs: DataFrame, shards: int = 24, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Puts every row of ``docs`` (doc_id, text, any more columns) into a shard, by bytes.

    Returns doc_id, size (UTF-8 bytes of the text, null: none, plus 8), text_crc32, virtual_slot, map_version, shard and
    ``slot``, the row's place in its shard: 0 and on without gaps, by virtual slot, then doc_id. Rows that agree in doc_id, size
    and text_crc32 are interchangeable: they are counted, and their copies hash each by its own number. A null doc_id hashes as any
    other value; no rows in, no rows out. The map is stored under ``map_path`` (else a new folder in the shared one) and read back
    before it is applied.

    Two shuffles of some 40 bytes a row, by record (repeated rows combine before it) and by virtual slot: thousands of slots, each
    with its share of all rows. Texts are read once and not moved.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    records = docs.select("doc_id", (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    records = records.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    copies = records.select("doc_id", "size", "text_crc32", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    rows = written(copies.select("doc_id", "size", "text_crc32", slot_of(n_slots).alias("virtual_slot")), "records")
    size, count = slot_sizes(rows, n_slots)
    path = map_path or new_path(spark, "slot-map")
    SlotMap.by_bytes(size, shards).save(spark, path)
    held = SlotMap.load(spark, path)
    before, base = [0] * shards, []
    for k, to in enumerate(held.shard):
        base.append((held.version, k, to, before[to]))
        before[to] += count[k]
    placed = F.broadcast(spark.createDataFrame(base, "map_version int, virtual_slot int, shard int, base long"))
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    return (
        rows.withColumn("within", within)
        .join(placed, "virtual_slot")
        .select("doc_id", "size", "text_crc32", "virtual_slot", "map_version", "shard", (F.col("base") + F.col("within")).alias("slot"))
    )
