"""Streamed range filters against plain loops."""

import random

import pytest

from strandwork.operators import hits, sweeps

RANGES = "gene string, k long, qstart int, qend int, score double"


def ranges(r, n, width):
    rows = []
    for _ in range(n):
        s = r.randint(-5, width)
        rows.append((s, s + r.choice([0, 1, 3, r.randint(1, width)])))
    return rows


def internal(rows, share):
    kept, out = [], []
    for s, e in rows:
        out.append(not any(min(e, b) > max(s, a) and (min(e, b) - max(s, a)) / (max(e, b) - min(s, a)) >= share for a, b in kept))
        kept += [(s, e)] if out[-1] else []
    return out


def dominance(rows, share, ratio):
    kept, out = [], []
    for s, e, c in rows:
        out.append(not any(min(e, b) - max(s, a) >= max(1, share * (e - s)) and k > 0 and c > 0 and k / c >= ratio for a, b, k in kept))
        kept += [(s, e, c)] if out[-1] else []
    return out


@pytest.mark.parametrize("block", [4, 512])
def test_folds(monkeypatch, block):
    monkeypatch.setattr(sweeps, "BLOCK", block)
    r = random.Random(block)
    for _ in range(500):
        rows, share, ratio = ranges(r, r.randint(1, 80), r.choice([20, 100, 1000])), r.choice([0.1, 0.3, 0.6, 1.0]), r.choice([1.0, 1.1, 2.0])
        fold = sweeps.Internal(share)
        assert [fold.keeps(*x) for x in rows] == internal(rows, share)
        scored = sorted(((s, e, r.choice([0.0, 1.0, 2.0, 5.0, r.random() * 10])) for s, e in rows), key=lambda x: -x[2])
        fold = sweeps.Dominance(share, ratio)
        assert [fold.keeps(*x) for x in scored] == dominance(scored, share, ratio)


def test_one_hot_group_and_nulls(spark):
    r = random.Random(3)
    rows = [("hot", k, s, e, r.random()) for k, (s, e) in enumerate(ranges(r, 3000, 20_000))] + [("cold", 1, 5, 9, 1.0), ("cold", 2, 5, None, 1.0), ("cold", 3, 5, 9, 0.5), (None, 4, 5, 9, 1.0), (None, 5, 5, 9, 1.0)]
    df = spark.createDataFrame(rows, RANGES).repartition(7)
    hot = [x for x in rows if x[0] == "hot"]
    got = {(x["gene"], x["k"]) for x in hits.internal_filter(df, ["gene"], ["k"]).collect()}
    assert got == {("hot", x[1]) for x, ok in zip(hot, internal([x[2:4] for x in hot], 0.3), strict=True) if ok} | {("cold", 1), ("cold", 2), (None, 4)}
    hot.sort(key=lambda x: (-x[4], x[1]))
    got = {(x["gene"], x["k"]) for x in hits.dominance_filter(df, ["gene"], ["k"]).collect()}
    assert got == {("hot", x[1]) for x, ok in zip(hot, dominance([x[2:] for x in hot], 0.6, 1.1), strict=True) if ok} | {("cold", 1), ("cold", 2), (None, 4), (None, 5)}
    assert hits.internal_filter(df.limit(0), ["gene"], ["k"]).count() == 0


def test_a_long_group_takes_short_steps():
    r, n = random.Random(4), 100_000
    one, two = sweeps.Internal(0.3), sweeps.Dominance(0.6, 1.1)
    scores = sorted((r.random() for _ in range(n)), reverse=True)
    for k, (s, e) in enumerate((s := r.randint(0, 10**6), s + r.randint(1, 500)) for _ in range(n)):
        one.keeps(s, e)
        two.keeps(s, e, scores[k])
    held = sum(map(len, one.cells.values()))
    assert held < 40_000 and max(map(len, one.cells.values())) < 12 and len(two.starts) > 20
