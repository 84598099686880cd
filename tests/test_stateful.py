"""Streams with state: any batches, in any order and over restarts, give what the batch form gives."""

import random

import pytest
from pyspark.sql import functions as F

from strandwork.operators import islands, reads
from strandwork.streaming import stateful as S
from strandwork.streaming import windows

ROWS = "user string, id long"


def batch(df, gap):
    found = islands.id_clusters(df.where("id is not null"), ["user"], "id", gap).groupBy("user", "cluster").agg(F.min("id"), F.max("id"), F.count("*"))
    return sorted((str(x[0]), *x[2:]) for x in found.collect())


def test_ranges_join_in_any_order():
    r = random.Random(1)
    for _ in range(200):
        ids, gap = [r.randint(0, 60) for _ in range(r.randint(1, 30))], r.randint(0, 5)
        wanted = []
        for i in sorted(ids):
            if wanted and i - wanted[-1][1] <= gap:
                wanted[-1] = (wanted[-1][0], i, wanted[-1][2] + 1)
            else:
                wanted.append((i, i, 1))
        got, rest = [], ids[:]
        while rest:
            k = r.randint(1, len(rest))
            S.joined(got, rest[:k], gap)
            rest = rest[k:]
        assert got == wanted


def test_clusters_over_restarts(spark, tmp_path):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.choice([*range(300), None])) for _ in range(240)]
    source, out, state = f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/state"
    stream = lambda: spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(source)
    for part in (rows[:60], rows[60:100], rows[100:]):
        spark.createDataFrame(part, ROWS).coalesce(1).write.mode("append").parquet(source)
        if part is not rows[60:100]:
            S.run_updates(S.id_clusters(stream(), "user", "id", 3), out, state)
    got = S.latest(spark.read.parquet(out), "user").select("user", "first", "last", "n").collect()
    assert sorted((str(x[0]), *x[1:]) for x in got) == batch(spark.createDataFrame(rows, ROWS), 3)
    assert spark.read.parquet(out).select("batch").distinct().count() >= 2


@pytest.mark.parametrize("order", [1, -1])
def test_dedupe_over_batches(spark, tmp_path, order):
    r = random.Random(3)
    flip = lambda s: s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))
    texts = ["".join(r.choice("ACGTN") for _ in range(6)) for _ in range(12)]
    rows = [(k, r.choice([s, flip(s)])) for k, s in enumerate(r.choice(texts) for _ in range(90))][::order]
    schema = "k long, seq string"
    for k in range(3):
        spark.createDataFrame(rows[k * 30 : k * 30 + 30], schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        if k != 1:
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
            windows.run_into_folder(S.deduped(stream, "k"), f"file://{tmp_path}/out", f"file://{tmp_path}/state")
    got = sorted(map(tuple, spark.read.parquet(f"file://{tmp_path}/out").collect()))
    assert got == sorted(map(tuple, reads.strand_dedupe(spark.createDataFrame(rows, schema), "k").collect()))
