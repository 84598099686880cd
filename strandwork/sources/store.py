"""S6, K3 and J3. A store of rows by key: bucketed and sorted, so lookups read few files and joins don't shuffle what is stored.

Rows lie under ``root``/rows as one table, split by batch and, in each batch, into buckets by the key's hash, a sorted file each. A batch counts once
a manifest names it: ``root``/manifest/v<n>.json lists the batches of version n, and is written after the batch, never over another one. So a
failed or concurrent writer leaves earlier versions as they were, and any version can still be read.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ReadStore:
    def __init__(self, spark: SparkSession, root: str, key: str = "node", buckets: int = 64):
        """buckets: of a new store; one that is there keeps its own key and buckets."""
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.table = "read_store_" + hashlib.md5(self.root.encode()).hexdigest()
        if found := self.versions():
            self._register(self.manifest(found[-1]))

    def _path(self, name: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def versions(self) -> list[int]:
        fs, where = self._path("manifest")
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return sorted(int(n[1:-5]) for n in names if n.endswith(".json"))

    def manifest(self, version: int) -> dict:
        return json.loads(self.spark.read.option("wholetext", True).text(f"{self.root}/manifest/v{version}.json").first()[0])

    def _register(self, manifest: dict) -> None:
        """The table by which this session knows the files; data are found by their folders."""
        self.key, self.buckets = manifest["key"], manifest["buckets"]
        if not self.spark.catalog.tableExists(self.table):
            self.spark.sql(
                f"CREATE TABLE {self.table} ({manifest['schema']}, `batch` BIGINT) USING parquet PARTITIONED BY (`batch`) "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.root}/rows'"
            )

    def add(self, rows: DataFrame) -> int:
        """Adds a batch and returns the version that has it. Columns are those of the first batch; null and repeated keys are rows like others."""
        found = self.versions()
        last = self.manifest(found[-1]) if found else {"key": self.key, "buckets": self.buckets, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "batches": []}
        self._register(last)
        batch = uuid.uuid4().int >> 66
        stored = [c for c in self.spark.table(self.table).columns if c != "batch"]
        dealt = rows.select(*stored, F.lit(batch).cast("bigint").alias("batch")).repartition(self.buckets, self.key)
        dealt.write.mode("append").format("parquet").option("compression", "zstd").partitionBy("batch").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.table)
        version = (found[-1] if found else 0) + 1
        fs, where = self._path(f"manifest/v{version}.json")
        out = fs.create(where, False)  # fails where another writer was first
        out.write(json.dumps(last | {"batches": [*last["batches"], batch]}).encode())
        out.close()
        self.spark.catalog.refreshTable(self.table)
        return version

    def rows(self, version: int | None = None) -> DataFrame:
        """All rows of a version (default: the latest). Only its batches' folders are read."""
        found = self.versions()
        if not found:
            raise FileNotFoundError(f"no batch under {self.root}")
        batches = self.manifest(found[-1] if version is None else version)["batches"]
        return self.spark.table(self.table).where(F.col("batch").isin(batches)).drop("batch")

    def reads_of(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows whose key is in ``keys``: these are shuffled into the store's buckets (or broadcast), the stored rows are not moved."""
        return self.rows(version).join(keys.select(F.col(self.key)).distinct(), self.key, "left_semi")

    def lookup(self, keys: list, version: int | None = None) -> DataFrame:
        """Rows of a few keys: only the buckets that they hash to are opened."""
        return self.rows(version).where(F.col(self.key).isin(keys))

    def compacted(self) -> int:
        """All batches of the latest version as one, in a new version; the older files stay for older versions."""
        rows = self.rows()
        found = self.versions()
        before = self.manifest(found[-1])["batches"]
        version = self.add(rows)
        batch = [b for b in self.manifest(version)["batches"] if b not in before]
        fs, where = self._path(f"manifest/v{version + 1}.json")
        out = fs.create(where, False)
        out.write(json.dumps(self.manifest(version) | {"batches": batch}).encode())
        out.close()
        return version + 1
