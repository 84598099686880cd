"""rows of a large gene deviate as deviating_rows() says, though no task holds all their distances."""

import random

import pytest

from strandwork.operators.grouped import deviation, frames, screening
from strandwork.operators.grouped.columns import Row


def _table(seed, n):
    r = random.Random(seed)
    base = [r.choice("ACDEGKLST") for _ in range(60)]
    out = []
    for k in range(n):
        far = r.choice([0.05, 0.1, 0.1, 0.2, 0.2, 0.9 if k % 9 == 0 else 0.1])
        seq = "".join(r.choice("ACDEGKLSTX") if r.random() < far else "-" if r.random() < 0.3 else c for c in base[: r.randint(20, 60)])
        out.append((f"n{k}", "-" * r.choice([0, 0, 5]) + seq[5:] if k % 5 == 0 else seq))
    return [*out, ("none", "-----"), ("empty", ""), ("x", "XXX")]


@pytest.mark.parametrize(("beside", "pilot"), [(0.03, 40), (0.2, 30), (0.0, 5)])
def test_as_all_distances_at_once(spark, monkeypatch, beside, pilot):
    for name, value in (("BLOCK_ROWS", 17), ("STEP_ROWS", 5), ("PILOT_ROWS", pilot), ("BESIDE", beside)):
        monkeypatch.setattr(deviation, name, value)
    monkeypatch.setattr(frames, "WHOLE_ROWS", 20)
    tables = {"g": _table(1, 70), None: _table(2, 45), "small": _table(3, 12)}
    df = spark.createDataFrame([(g, *x) for g, t in tables.items() for x in t], "gene string, name string, seq string").repartition(3)
    own = {g: [Row(*x) for x in t] for g, t in tables.items()}
    want = {(g, n, "whole") for g, rows in own.items() for n in screening.deviating_rows(rows, rounds=2)}
    found = frames.deviating(df, rounds=2).collect()
    assert {tuple(x) for x in found} == want and len(found) == len(want) > 6
    if pilot == 40:
        want = {(g, n, part) for g, rows in own.items() for n, part in screening.deviating_halves(rows, floor=0.03, times=1.0, rounds=2).items()}
        found = frames.deviating(df, rounds=2, halves=True).collect()
        assert {tuple(x) for x in found} == want and len(found) == len(want) and {x[2] for x in want} == {"first", "second"}
