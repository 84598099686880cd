import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa

from strandwork.llm import decontaminate as D

from .conftest import DOCS, doc, prose

ITEMS = [(k, prose(500 + k, 30)) for k in range(20)] + [(50, None), (51, ""), (52, "two words"), (53, prose(500, 30))]


def slow_tiles(a, b, least):
    """Greedy string tiling by looking at every pair of places again for each tile."""
    used_a, used_b, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return sum(t[2] for t in out)
        n, i, j = best
        out.append((i, j, n))
        used_a |= set(range(i, i + n))
        used_b |= set(range(j, j + n))


def test_tiles_cover_as_much_as_the_plain_algorithm():
    r = random.Random(4)
    for _ in range(60):
        a, b = ([r.randrange(5) for _ in range(r.randint(3, 14))] for _ in range(2))
        a, b = np.array(a, np.uint64), np.array(b, np.uint64)
        pairs = [(i, j) for i in range(len(a) - 2) for j in range(len(b) - 2) if (a[i : i + 3] == b[j : j + 3]).all()]
        if pairs:
            i, j = map(np.array, zip(*pairs))
            found = D.tiles(a, b, i, j)
            assert sum(t[2] for t in found) == slow_tiles(a.tolist(), b.tolist(), 3)
            assert len({x + k for x, _, n in found for k in range(n)}) == sum(t[2] for t in found)


def test_planted_leaks(spark, monkeypatch):
    items = dict(ITEMS[:20])
    parts = [" ".join(items[3].split()[k : k + 6]) for k in (24, 6, 0, 18, 12)]
    rows = [doc(k, prose(k, 200)) for k in range(30)]
    rows += [
        doc(100, prose(900, 50) + " " + items[1] + " " + prose(901, 50)), doc(101, prose(902, 30) + " " + " ".join(parts)), doc(102, prose(903, 30) + " " + items[2].upper().replace(" ", ", ") + "."),
        doc(103, prose(904, 30) + " " + " ".join(items[4].split()[:8])), doc(104, items[5] + " " + prose(905, 9) + " " + items[6]),
    ]
    docs, bench = spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(ITEMS, "item_id long, text string")
    rows += [doc(106, "Has TWO words, whole"), doc(107, "words two")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = {(r["doc_id"], r["item_id"]) for r in D.contamination(docs, bench).collect()}
    assert (106, 52) in got
    got.discard((106, 52))
    assert got == {(100, 1), (101, 3), (102, 2), (104, 5), (104, 6)}
    monkeypatch.setattr(D.benchmark_blocks, "__defaults__", (500,))
    assert len(list(D.benchmark_blocks(bench))) > 1
    assert {(r["doc_id"], r["item_id"]) for r in D.contamination(docs, bench).collect()} == got | {(106, 52)}
    assert {r["doc_id"] for r in D.clean_documents(docs, bench).collect()} == {r[0] for r in rows} - {100, 101, 102, 104, 106}


def plain_leaks(items, text):
    """Every stretch of the text, tiled by the plain algorithm."""
    word = lambda t: re.sub(r"[!-/:-@\[-`{-~]", " ", t.lower()).split()
    words, out = word(text), {}
    for k, item in items:
        a = word(item or "")
        if not a:
            continue
        if len(a) < 3:
            if any(words[i : i + len(a)] == a for i in range(len(words))):
                out[k] = len(a)
            continue
        half = D.SPREAD * len(a) // 2
        best = max((slow_tiles(a, words[i * half : (i + 2) * half + 2], 3) for i in range(-(-len(words) // half))), default=0)
        if best >= D.COVERAGE * len(a):
            out[k] = best
    return out


def test_leaks_against_the_plain_form():
    """Few different words, so that seeds repeat; parts of items in any order, near each other or far apart."""
    r = random.Random(8)
    for _ in range(40):
        pool = [prose(k, 1) for k in range(r.choice((6, 12, 40)))]
        items = [(k, " ".join(r.choice(pool) for _ in range(r.choice((1, 2, 5, 9, 14))))) for k in range(5)]
        text = []
        for _ in range(r.randint(1, 5)):
            part = r.choice(items)[1].split()
            i = r.randrange(len(part))
            text += part[i : i + r.randint(1, 9)] + [prose(r.random(), 1) for _ in range(r.choice((0, 1, 30)))]
        bench = D.Benchmark.of([k for k, _ in items], [t for _, t in items])
        got = {bench.ids[k]: n for _, k, n, _ in D.leaks(pa.array([" ".join(text)]), bench)}
        wanted = plain_leaks(items, " ".join(text))
        assert got.keys() == wanted.keys() and all(got[k] <= wanted[k] for k in got), (items, text)


def test_very_long_repetitive_texts_need_little():
    tracemalloc.start()
    bench = D.Benchmark.of([0, 1], [" ".join(["a b c d"] * 30), " ".join(["a a b"] * 30)])
    text = pa.array([" ".join(["a b c d"] * 60_000 + ["a"] * 60_000)])
    base = tracemalloc.get_traced_memory()[1]
    began = time.perf_counter()
    assert [(k, n) for _, k, n, _ in D.leaks(text, bench)] == [(0, 120)]
    assert time.perf_counter() - began < 30 and tracemalloc.get_traced_memory()[1] - base < 120 << 20
    tracemalloc.stop()


def test_edge_cases(edge, nothing, spark):
    bench = spark.createDataFrame([*ITEMS, (60, prose(3, 60)), (None, prose(2, 60))], "item_id long, text string")
    got = sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in D.contamination(edge, bench).collect())
    assert got == [(0, 0), (1, 0), (2, 0), (3, 60), (3, 60)]
    clean = D.clean_documents(edge, bench)
    assert clean.columns == edge.columns and clean.count() == edge.count() - 5
    assert D.contamination(nothing, bench).count() == 0 and D.contamination(edge, bench.limit(0)).count() == 0 and D.clean_documents(edge, bench.limit(0)).count() == edge.count()
