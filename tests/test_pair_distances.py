"""Distances of all pairs of a key, in blocks, against DuckDB's SQL and plain sums."""

import random
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandwork.operators import pairs
from strandwork.plans.queries import QUERIES, SQL

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed, n, labels=2, width=64):
    r = random.Random(seed)
    return [(k, [r.gauss(0, 0.125) for _ in range(width)], k % labels) for k in range(n)]


def test_one_label_is_many_tasks(spark, monkeypatch):
    """a label's pairs are dealt in blocks, and are those of a plain double loop."""
    monkeypatch.setattr(pairs, "PAIR_ROWS", 25)
    monkeypatch.setattr(pairs, "PAIR_STEP", 64)
    rows = vectors(1, 200, 1) + [(7, [0.5] * 64, 0), (7, [0.5] * 64, 0), (None, [0.5] * 64, 0), (900, [0.5] * 64, None)]
    found = pairs.pair_distances(spark.createDataFrame(rows, SCHEMA).repartition(5), "label", "vec_id", "embedding", 64, 4)
    got = found.withColumn("task", F.spark_partition_id()).toPandas()
    assert got["task"].nunique() > 1
    known = [(k, np.array(v, np.float32).astype(float)) for k, v, g in rows if k is not None and g == 0]
    want = sorted((a, b, round(sum((x - y) ** 2), 4)) for a, x in known for b, y in known if a < b)
    assert sorted(zip(got["a"], got["b"], got["distance"], strict=True)) == want


@pytest.mark.parametrize("size", [3, 2048])
def test_odd_vectors_as_sql(spark, monkeypatch, tmp_path, size):
    """null, short and long vectors, null components, infinities and very large numbers as the query's SQL has them."""
    monkeypatch.setattr(pairs, "PAIR_ROWS", size)
    rows = vectors(2, 40) + vectors(3, 6, width=70) + vectors(4, 4, width=5)
    rows += [(50, None, 0), (51, [], 0), (52, [None] * 64, 1), (53, [None, *[0.25] * 63], 1), (54, [1e18] * 64, 0), (55, [-3e38] * 64, 0), (56, [float("inf")] * 64, 1), (57, [123456.5] * 64, 1), (58, [0.0] * 64, None)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    key = lambda r: (r[0], r[1], str(r[2]))
    plain = lambda t: sorted(((int(a), int(b), None if pd.isna(d) else float(f"{d:.12g}")) for a, b, d in t), key=key)
    got = QUERIES["pairwise_distance"](spark, str(tmp_path)).collect()
    assert plain(got) == plain(con.execute(SQL["pairwise_distance"]).fetchall())


def test_rounding_at_the_half():
    """Where the matrix product's error could change the last digit, the plain sum decides."""
    r = np.random.default_rng(5)
    x = r.integers(-400, 400, (300, 4)) * 0.005
    there = np.ones(x.shape, bool)
    block = (np.arange(300), x, there)
    a, b, d = (np.concatenate(c) for c in zip(*((a, b, d.to_numpy()) for a, b, d in pairs._block_distances(block, None, 4)), strict=True))
    plain = np.zeros(len(a))
    for k in range(4):
        plain += (x[a, k] - x[b, k]) ** 2
    assert len(a) == 300 * 299 // 2
    assert d.tolist() == [float(Decimal(repr(float(v))).quantize(Decimal("0.0001"), ROUND_HALF_UP)) for v in plain]
