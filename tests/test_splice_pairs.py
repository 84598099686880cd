"""every pair is formed, in batches of bounded size, and the query counts those."""

import random

from pyspark.sql import functions as F

from strandwork.operators.grouped import trimming
from strandwork.plans import row_queries

SF = "/root/testdata/sf0.001"


def test_pairs_as_rows(spark, monkeypatch):
    r = random.Random(4)
    texts = ["".join(r.choice("GTA") for _ in range(r.randint(0, 400))) for _ in range(50)] + ["", "G", None, "GT" + "C" * 28 + "AG", "GT" + "C" * 26 + "AG", "GT" * 200 + "AG" * 200]
    want = sorted((k, *p) for k, t in enumerate(texts) for p in (trimming.splice_candidates(t) if t else []))
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, seq string").repartition(3)
    for size in (1, 50, 1 << 19):
        monkeypatch.setattr(trimming, "PAIR_ROWS", size)
        sizes = [len(a) for t in texts if t for a, _ in trimming._pair_parts(t, 30)]
        assert sum(sizes) == len(want) and max(sizes) <= max(size, 200)
        assert sorted(map(tuple, trimming.splice_pair_rows(rows).collect())) == want


def test_the_query_counts_pairs(spark, monkeypatch):
    whole, seen = trimming.splice_pair_rows, []

    def watched(rows, *more):
        seen.append(whole(rows, *more))
        return seen[-1]

    monkeypatch.setattr(trimming, "splice_pair_rows", watched)
    found = row_queries.splice_candidates(spark, SF)
    assert found.agg(F.sum("n")).first()[0] == seen[0].count() > 1000
