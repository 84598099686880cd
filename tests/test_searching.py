"""Seed-and-extend search: the band against plain Smith-Waterman, the whole search against all pairs."""

import math
import os
import random

import numpy as np
import pytest

from strandwork.functions.blosum import LETTERS
from strandwork.operators import searching as se
from strandwork.plans.gene_queries import _SEEDING, _search_texts

NONE, UNIT, HALF = -(1 << 62), 1 << 42, 21
READS, TARGETS = "node long, frame int, aa string", "target string, seq string"


def plain(q, t):
    """Smith-Waterman with affine gaps cell by cell: (score, start, end, start, end), ties as banded() says."""
    m = se._MATRIX
    h, e, f = ([[NONE] * (len(t) + 1) for _ in range(len(q) + 1)] for _ in range(3))
    best, key = (0, 0, 0, 0, 0), 0
    for i in range(1, len(q) + 1):
        for j in range(1, len(t) + 1):
            d = max(h[i - 1][j - 1], ((i - 1) << HALF) | (j - 1)) + int(m[q[i - 1], t[j - 1]]) * UNIT
            f[i][j] = max(h[i - 1][j] - 12 * UNIT, f[i - 1][j] - UNIT)
            e[i][j] = max(h[i][j - 1] - 12 * UNIT, e[i][j - 1] - UNIT)
            v = max(d, f[i][j], e[i][j])
            h[i][j] = v if v >= UNIT else NONE
            if h[i][j] > key:
                key, best = v, (v >> 42, v >> HALF & (2**HALF - 1), i, v & (2**HALF - 1), j)
    return best


def changed(r, seq, n):
    seq = list(seq)
    for _ in range(n):
        p, x = r.randrange(len(seq) + 1), r.random()
        if x < 0.3:
            del seq[p : p + r.randint(1, 3)]
        elif x < 0.6:
            seq[p:p] = [r.choice(LETTERS + "XZ") for _ in range(r.randint(1, 3))]
        elif p < len(seq):
            seq[p] = r.choice(LETTERS)
    return "".join(seq)


def random_protein(r, n):
    return "".join(r.choice(LETTERS) for _ in range(n))


def test_band_of_all_diagonals_is_smith_waterman():
    r = random.Random(3)
    reads, targets, wanted = [], [], []
    for _ in range(60):
        base = random_protein(r, r.randint(5, 40))
        q, t = random_protein(r, r.randint(0, 12)) + changed(r, base, 4) or "A", random_protein(r, r.randint(0, 15)) + base
        reads.append(se._numbers(q.encode()))
        targets.append(se._numbers(t.encode()))
        wanted.append(plain(reads[-1].tolist(), targets[-1].tolist()))
    low = [-len(q) for q in reads]
    got = se.banded(reads, targets, low, max(len(q) + len(t) for q, t in zip(reads, targets, strict=True)) + 1)
    assert [g if g[0] else 0 for g in got] == [w if w[0] else 0 for w in wanted]


def test_seeds_are_packed_masked_and_placed():
    at, seed = se.packed_seeds(b"AAAAARNDCXARNDC", 5, 3)
    assert at.tolist() == [2, 3, 4, 10] and seed[2] == seed[3] == int("".join(f"{LETTERS.index(c):05b}" for c in "ARNDC"), 2)
    assert len(se.packed_seeds(b"ARND", 5, 1)[0]) == 0 and len(se.packed_seeds(b"", 5, 1)[0]) == 0


def test_ungapped_extension_stops_where_it_drops():
    n = lambda s: se._numbers(s.encode())
    assert se.ungapped(n("WWWWW"), n("WWWWW"), 2, 0, 16) == 55
    assert se.ungapped(n("WWPPPPPWWWW"), n("WWGGGGGWWWW"), 0, 0, 5) == 22  # five pairs at -2 fall by more than 5
    assert se.ungapped(n("WWPPPPPWWWW"), n("WWGGGGGWWWW"), 0, 0, 16) == 22 - 10 + 44


def by_brute_force(reads, targets, extension):
    """Every pair by a band of all diagonals."""
    letters, out = sum(len(t or "") for _, t in targets), {}
    pairs = sorted({(r, t) for r in reads for t in targets if r[2] and t[1]}, key=lambda x: (len(x[0][2]), len(x[1][1])))
    for k in range(0, len(pairs), 48):
        group = [(r, t, se._numbers(r[2].encode()), se._numbers(t[1].encode())) for r, t in pairs[k : k + 48]]
        width = max(len(q) + len(t) for _, _, q, t in group) + 1
        for (r, t, q, _), (score, *place) in zip(group, se.banded([g[2] for g in group], [g[3] for g in group], [-len(g[2]) for g in group], width), strict=True):
            bits = (se.LAMBDA * score - math.log(se.KAPPA)) / math.log(2)
            if len(q) * letters * 2.0**-bits <= extension.most_evalue:
                out[r[0], r[1], t[0]] = score, *place
    return out


def test_planted_hits_with_gaps_repeats_and_hot_seeds(spark):
    r = random.Random(8)
    targets = [(f"t{k}", random_protein(r, r.randint(60, 300))) for k in range(25)] + [("null", None), ("empty", ""), ("low", "Q" * 80)]
    reads = [(k, k % 3, random_protein(r, 20) + changed(r, t[20:200], r.randint(0, 10)) + random_protein(r, 15)) for k, (_, t) in enumerate(targets[:25])]
    reads += [(900, 0, None), (901, 0, ""), (902, 1, "Q" * 90), (903, 1, targets[0][1] * 3), (903, 1, targets[0][1] * 3), (904, 0, random_protein(r, 500) + targets[3][1])]
    a = spark.createDataFrame([(*x, "extra") for x in reads], READS + ", seed string").repartition(4)
    b = spark.createDataFrame(targets, TARGETS)
    extension = se.Extension(most_evalue=1e-6)
    for part in (1 << 18, 3):
        got = se.extended_hits(a, b, se.Seeding(part_pairs=part), extension).collect()
        wanted = by_brute_force(reads, targets, extension)
        assert {(x["node"], x["frame"], x["target"]): (x["score"], x["qstart"], x["qend"], x["sstart"], x["send"]) for x in got} == {k: v for k, v in wanted.items() if k[0] != 902}
        assert len(got) == len(wanted) - 1  # the masked repeat has no seeds
    assert se.extended_hits(a.limit(0), b).count() == 0 and se.extended_hits(a, b.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_search_finds_what_all_pairs_have_above_a_score(spark):
    reads, targets = _search_texts(spark, "/root/testdata/sf0.001")
    reads, extension = reads.where("node < 3"), se.Extension(trigger=20, pad=64)
    q, t = ([tuple(x) for x in df.collect()] for df in (reads, targets))
    wanted = by_brute_force(q, t, extension)
    for seeding, score in ((se.Seeding(near=64, least_seeds=1), 160), (_SEEDING, 400)):
        found = se.extended_hits(reads, targets, seeding, extension).collect()
        got = {(x["node"], x["frame"], x["target"]): (x["score"], x["qstart"], x["qend"], x["sstart"], x["send"]) for x in found}
        high = {k: v for k, v in wanted.items() if v[0] >= score}
        assert (high or score > 160) and {k: got.get(k) for k in high} == high
        assert got and all(got[k][0] <= wanted[k][0] for k in got)


def test_banded_alignment_cell_by_cell():
    """Scores of the band against a plain table of cells: bands beyond both ends, other letters, reads of unlike lengths side by side."""
    r = random.Random(11)
    reads = [np.array([r.randrange(21) for _ in range(r.randrange(1, 40))]) for _ in range(40)]
    targets = [np.array([r.randrange(21) for _ in range(r.randrange(8))] + [*x[r.randrange(len(x)) :]] + [r.randrange(21) for _ in range(12)]) for x in reads]
    low, width = [r.randrange(-30, 20) for _ in reads], 17
    for (score, *_), x, y, first in zip(se.banded(reads, targets, low, width), reads, targets, low, strict=True):
        h, e, f, best = {}, {}, {}, 0
        for i in range(len(x)):
            for j in range(max(0, i + first), min(len(y), i + first + width)):
                e[i, j] = max(h.get((i, j - 1), -999) - 12, e.get((i, j - 1), -999) - 1)
                f[i, j] = max(h.get((i - 1, j), -999) - 12, f.get((i - 1, j), -999) - 1)
                h[i, j] = max(0, h.get((i - 1, j - 1), 0) + int(se._MATRIX[x[i], y[j]]), e[i, j], f[i, j])
                best = max(best, h[i, j])
        assert score == best
