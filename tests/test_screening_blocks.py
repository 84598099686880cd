"""references count spans in blocks, meet two by two, and no gene is one task; the grades are those of the plain form."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandwork.functions.blosum import blosum62_distance
from strandwork.operators import pairs
from strandwork.operators.grouped import screening
from strandwork.operators.grouped.columns import Row

ROWS = "gene string, name string, seq string"


def _seqs(seed, n, gap, letters="ACDEX", least=0, most=40):
    r = random.Random(seed)
    return ["".join("-" if r.random() < gap else r.choice(letters) for _ in range(r.randint(least, most))) for _ in range(n)]


def test_block_distances():
    texts = [*_seqs(1, 30, 0.5), *_seqs(2, 5, 0.1, "XZ"), "", *_seqs(3, 9, 0.2, "WYV")]
    m = screening._places(texts, 40)
    found = screening.block_distances(m[:20], m)
    assert np.array_equal(found, [[blosum62_distance(a, b) for b in texts] for a in texts[:20]], equal_nan=True)


def test_counted_midpoint():
    r = random.Random(2)
    for n in range(1, 40):
        values = [r.randint(0, 6) / 7 for _ in range(n)]
        kinds, count = np.unique(values, return_counts=True)
        assert all(screening.counted_midpoint(kinds, count, p) == screening.midpoint(values, p) for p in (0.25, 0.5, 0.75))


@pytest.mark.parametrize("size", [3, 1024])
def test_screened_in_blocks(spark, monkeypatch, size):
    for name in ("SCREEN_REFERENCES", "SCREEN_ROWS", "SCREEN_SPANS"):
        monkeypatch.setattr(screening, name, size)
    rows = [(g, f"n{k}", ("-" * (k % 3) + t)) for g, seed, least in (("g", 4, 0), ("h", 5, 30), (None, 6, 30), ("alone", 7, 20)) for k, t in enumerate(_seqs(seed, 25, 0.2, least=least, most=32))]
    rows += [("g", f"whole{k}", "A" * 16) for k in range(5)] + [("g", "gaps", "----")]
    refs = [(g, name % k, t) for g, seed, name in (("g", 8, "r%d"), ("h", 9, "longer_%08d"), (None, 10, "r%d")) for k, t in enumerate(_seqs(seed, 14, 0.35, least=15))]
    refs += [("h", f"longer_{k:08d}x", t) for k, t in enumerate(_seqs(11, 4, 0.1, least=25))]
    want = {}
    for g in ("g", "h", None, "alone"):
        own, known = ([Row(n, s) for gene, n, s in table if gene == g] for table in (rows, sorted(refs, key=lambda x: x[1])))
        want |= {(g, n): (v["statistic"], v["bound"], v["grade"]) for n, v in screening.distance_outliers(own, known).items()}
    found = screening.screened(spark.createDataFrame(rows, ROWS).repartition(3), spark.createDataFrame(refs, ROWS).repartition(2)).collect()
    assert len(found) == len(rows) and {(x["gene"], x["name"]): (x["statistic"], x["bound"], x["grade"]) for x in found} == want
    assert {v[2] for v in want.values()} >= {"pass", "unscored"}


def test_no_span_is_looked_up_in_python(spark):
    """2,000 spans and 2,000 references were four million sums of letters."""
    rows = spark.range(2000).select(F.lit("g").alias("gene"), F.col("id").cast("string").alias("name"), F.concat(F.repeat(F.lit("A-"), 20), F.repeat(F.lit("-"), F.col("id").cast("int")), F.lit("A")).alias("seq"))
    refs = spark.range(2000).select(F.lit("g").alias("gene"), F.col("id").cast("string").alias("name"), F.repeat(F.lit("A---"), 500).alias("seq"))
    calls = spark.sparkContext.accumulator(0)

    def distance(a, b):
        calls.add(1)
        return blosum62_distance(a, b)

    assert screening.screened(rows, refs, distance=distance).where("grade = 'unscored'").count() == 2000 and calls.value == 0


def test_cluster_of_a_whole_gene(spark):
    r = random.Random(3)
    rows = [(g, k * r.choice([1, 1, 90]), t, r.random() < 0.5) for g in ("g", "h\x1fi") for k, t in enumerate(_seqs(r.randint(0, 99), 60, 0.9))]
    columns = {"g": [1, 3, 20, 39], "h\x1fi": list(range(30))}
    found = pairs.cluster_majority(spark.createDataFrame(rows, "gene string, node long, seq string, passed boolean"), spark.createDataFrame(list(columns.items()), "gene string, columns array<int>"), 3, -1.0)
    want = set()
    for g, known in columns.items():
        own, groups = sorted((x for x in rows if x[0] == g), key=lambda x: (x[1], x[3])), []
        for x in own:
            if not groups or x[1] - groups[-1][-1][1] > 3:
                groups.append([])
            groups[-1].append(x)
        for c in groups:
            places = {k for x in c for k, ch in enumerate(x[2]) if ch != "-"} & set(known)
            want.add((g, c[0][1], c[-1][1], len(c), len(places) / len(known), sum(x[3] for x in c) / len(c)))
    assert {tuple(x) for x in found.collect()} == want and len(want) > 4
