"""Signature clusters: families fall apart, sizes are bounded, partitioning changes nothing."""

import random
from collections import Counter

import numpy as np

from strandwork.functions.blosum import LETTERS
from strandwork.operators import signatures as S

ROWS = "gene string, name string, seq string"


def random_protein(r, n):
    return "".join(r.choice(LETTERS) for _ in range(n))


def test_signatures_tell_how_alike_texts_are():
    r = random.Random(1)
    base = random_protein(r, 200)
    far = lambda a, b: (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    near = base[:100] + "W" + base[101:]
    assert far(S.signature(base.encode()), S.signature(near.encode())) < 40 < 90 < far(S.signature(base.encode()), S.signature(random_protein(r, 200).encode()))
    assert S.signature(b"") == bytes(32) and len(S.signature(b"MK")) == 32 and S.signature(b"MKVLSMKVLS", 5) == S.signature(b"MKVLSMKVLSMKVLS", 5)


def test_clusters(spark):
    r = random.Random(2)
    families = [random_protein(r, 150) for _ in range(3)]
    vary = lambda s: "".join(c if r.random() > 0.03 else r.choice(LETTERS) for c in s)
    rows = [("g", f"f{f}:{k}", vary(s)) for f, s in enumerate(families) for k in range(24)]
    rows += [("alike", f"a{k}", families[0]) for k in range(70)] + [("few", "x", "MKV"), ("few", "y", None), (None, "z", "MKV"), (None, "z2", "")]
    found = []
    for parts in (1, 5):
        df = spark.createDataFrame(rows, ROWS).repartition(parts)
        found.append({(x["gene"], x["name"]): x["cluster"] for x in S.signature_clusters(df, most=30).collect()})
    assert found[0] == found[1] and set(found[0]) == {x[:2] for x in rows}
    sizes = Counter((g, c) for (g, _), c in found[0].items())
    assert all(n <= 30 for (g, _), n in sizes.items() if g != "alike") and all(n < 50 for n in sizes.values())
    for c in {c for (g, _), c in found[0].items() if g == "g"}:
        kinds = Counter(name[:2] for (g, name), own in found[0].items() if g == "g" and own == c)
        assert kinds.most_common(1)[0][1] >= 0.9 * sum(kinds.values())
    assert {c for (g, _), c in found[0].items() if g == "few"} == {0} and found[0][None, "z"] == 0
    assert S.signature_clusters(spark.createDataFrame([], ROWS)).count() == 0


def test_nodes_split_where_they_are_equal_the_levels(spark, monkeypatch):
    """Small nodes are finished by one task; all levels over the whole table give the same clusters, alike rows and null genes included."""
    r = np.random.default_rng(5)
    texts = ["".join(r.choice(list("ACDEFGHIKL"), 60)) for _ in range(9)]
    rows = [("a" if k % 3 else None, f"n{k}", texts[k % 9][: 30 + k % 31]) for k in range(300)] + [("b", f"m{k}", texts[0]) for k in range(90)]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    found = {}
    for local in (S.LOCAL, 0):
        monkeypatch.setattr(S, "LOCAL", local)
        found[local] = {(x["gene"], x["name"]): x["cluster"] for x in S.signature_clusters(df, most=25).collect()}
    assert found[0] == found[1 << 15] and len(found[0]) == 390 and len(set(found[0].items())) == 390
    assert max(v for (g, _), v in found[0].items() if g == "b") == 3
