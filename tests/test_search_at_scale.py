"""F32: the search stage reads its hits once, and no gene is one task."""

import random

import pytest
from pyspark.sql import functions as F

from strandwork.operators import islands
from strandwork.plans import stages

RAW = "header long, target string, frame int, evalue double, score double, qstart int, qend int"
TARGETS = "gene string, taxon string, target string, aa_len int"


@pytest.mark.parametrize("kind", ["long", "double"])
def test_clusters_in_ranges(spark, kind):
    """Ranges of any size give the clusters of one window: null ids and groups, negative ids, ties, empty ranges and tables."""
    r = random.Random(6)
    rows = [(g, r.choice([None, r.randint(-300, 300), r.randint(-30, 30)]), k) for k in range(400) for g in (r.choice(["a", "b", "c", None]),)]
    if kind == "double":
        rows = [(g, None if n is None else n / 2, k) for g, n, k in rows] + [("a", float("nan"), 900), ("a", float("nan"), 901), ("d", float("inf"), 902), ("d", 1.0, 903)]
    df = spark.createDataFrame(rows, f"g string, n {kind}, k long").repartition(5)
    for gap in (0, 3, 35):
        want = {x["k"]: x["cluster"] for x in islands.id_clusters(df, ["g"], "n", gap, ["k"]).collect()}
        for size in (1, 7, 64, 1 << 16):
            found = islands.id_clusters_in_ranges(df, ["g"], "n", gap, ["k"], size)
            assert {x["k"]: x["cluster"] for x in found.collect()} == want and found.columns == ["g", "n", "k", "cluster"]
    assert islands.id_clusters_in_ranges(df.limit(0), ["g"], "n", 3).count() == 0


def test_hits_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    r = random.Random(7)
    targets = spark.createDataFrame([(f"g{k % 3}", f"T{k % 4}", f"t{k}", 90) for k in range(12)], TARGETS)
    rows = [(k * 40, f"t{r.randrange(14)}", r.choice([1, -1, 2]), 1e-9, float(r.randint(50, 99)), s, s + 60) for k in range(500) for s in r.sample(range(200), 3)]
    raw = spark.createDataFrame(rows, RAW)
    want = stages.search(raw, targets)["hits"].collect()
    got = stages.search(raw.mapInArrow(passing, RAW), targets)["hits"].collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 400
    assert seen.value == len(rows)


def test_one_gene_is_many_tasks(spark):
    targets = spark.createDataFrame([("g", "T", "t", 90)], TARGETS)
    raw = spark.range(300).select((F.col("id") * 50_000).alias("header"), F.lit("t").alias("target"), F.lit(1).alias("frame"), F.lit(1e-9).alias("evalue"), F.lit(9.0).alias("score"), F.lit(1).alias("qstart"), F.lit(90).alias("qend"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = stages.search(raw, targets)["hits"].select("header", "cluster", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((x["header"], x["cluster"]) for x in found) == [(50_000 * k, k + 1) for k in range(300)]
    assert len({x["task"] for x in found}) > 1
