"""The keyed store: versions, plans without a shuffle of the stored rows, few buckets for few keys."""

import pytest
from pyspark.sql import functions as F

from strandwork.sources.store import ReadStore

ROWS = "node long, seq string, batch_name string"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_batches_and_versions(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    store = ReadStore(spark, root, buckets=4)
    with pytest.raises(FileNotFoundError):
        store.rows()
    first = [(k, f"s{k}", "a") for k in range(50)] + [(None, "none", "a"), (7, "again", "a")]
    assert store.add(spark.createDataFrame(first, ROWS)) == 1
    assert store.add(spark.createDataFrame([(7, "seven", "b"), (99, None, "b")], ROWS).select("batch_name", "seq", "node")) == 2
    assert sorted(map(str, store.rows(1).collect())) == sorted(map(str, spark.createDataFrame(first, ROWS).collect()))
    wanted = spark.createDataFrame([(7,), (7,), (99,), (1000,), (None,)], "node long")
    assert sorted((r["node"], str(r["seq"])) for r in store.reads_of(wanted).collect()) == [(7, "again"), (7, "s7"), (7, "seven"), (99, "None")]
    assert sorted(r["seq"] for r in store.reads_of(wanted, 1).collect()) == ["again", "s7"]
    assert store.compacted() == 4 and store.versions() == [1, 2, 3, 4] and len(store.manifest(4)["batches"]) == 1
    again = ReadStore(spark, root, key="ignored", buckets=99)
    assert (again.key, again.buckets, again.rows().count(), again.rows(1).count()) == ("node", 4, 54, 52)
    assert again.add(spark.createDataFrame([], ROWS)) == 5 and again.rows().count() == 54


def test_a_batch_that_no_manifest_names_is_not_there(spark, tmp_path):
    store = ReadStore(spark, f"file://{tmp_path}/store", buckets=2)
    store.add(spark.range(10).select(F.col("id").alias("node")))
    before = store.manifest(1)
    other = ReadStore(spark, f"file://{tmp_path}/store")
    other.add(spark.range(10, 20).select(F.col("id").alias("node")))
    (tmp_path / "store/manifest/v2.json").unlink()
    assert store.versions() == [1] and store.rows().count() == 10 and store.manifest(1) == before


def test_stored_rows_are_not_shuffled_and_buckets_are_pruned(spark, tmp_path):
    store = ReadStore(spark, f"file://{tmp_path}/store", buckets=8)
    store.add(spark.range(2000).select(F.col("id").alias("node"), F.lit("ACGT").alias("seq")))
    store.add(spark.range(2000, 4000).select(F.col("id").alias("node"), F.lit("ACGT").alias("seq")))
    wanted = spark.range(0, 4000, 3).select(F.col("id").alias("node"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(store.reads_of(wanted))
        assert text.count("Bucketed: true") == 1 and text.count("Exchange\nInput") == 1 and "SortMergeJoin" in text
        exchange = text[text.index("Exchange\nInput") :]
        assert "hashpartitioning(node" in exchange[:200] and "seq" not in exchange[:200]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert store.lookup([5, 3001]).count() == 2
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan doesn't say which buckets are read
    try:
        assert any(f"SelectedBucketsCount: {n} out of 8" in plan(store.lookup([5, 3001])) for n in (1, 2))
    finally:
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
