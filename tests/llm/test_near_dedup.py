import random

import numpy as np
import pyarrow as pa

from strandwork.llm import near_dedup as N

from .conftest import DOCS, doc, prose


def brute(texts):
    """Classes by comparing all texts, with document frequencies counted plainly."""
    found = [dict(zip(v.tolist(), c.tolist())) for t in texts for _, v, c in N.shingles(pa.array([t]))]
    df = {}
    for f in found:
        for g in f:
            df[g] = df.get(g, 0) + 1
    n = len(found)
    floor = max(2.0, n * N.COMMON_SHARE)
    idf = {g: np.log1p(n / max(k, floor)) for g, k in df.items()}
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            x, y = found[i], found[j]
            low = sum(min(x[g], y[g]) * idf[g] for g in x.keys() & y.keys())
            high = sum(c * idf[g] for g, c in x.items()) + sum(c * idf[g] for g, c in y.items()) - low
            if low / high >= 0.8:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(n)]


def changed(text, share, seed):
    r = random.Random(seed)
    return " ".join(prose(r.random(), 1) if r.random() < share else w for w in text.split())


def test_classes_equal_brute_force(spark):
    texts = []
    for k in range(12):
        base = prose(k, 150)
        texts += [base, base, changed(base, 0.005, k), changed(base, 0.015, k + 50), changed(base, 0.05, k + 99), base + " " + prose(k + 200, 15)]
    hot = prose(777, 120)  # a large group of near copies, and a passage that very many texts share
    texts += [changed(hot, 0.01, 1000 + k) for k in range(60)]
    texts += [prose(3000 + k, 40) + " " + hot[:200] + " " + prose(4000 + k, 40) for k in range(40)]
    docs = spark.createDataFrame([doc(k, t) for k, t in enumerate(texts)], DOCS).repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts)


def test_samples_estimate_similarity():
    r = np.random.default_rng(0)
    w = N.Weights(1000, np.arange(1, 200, dtype=np.uint64), np.full(199, 500.0))
    pool = r.integers(200, 1 << 62, 400).astype(np.uint64)
    a = (np.sort(np.concatenate([np.arange(1, 100, dtype=np.uint64), pool[:300]])), None)
    b = (np.sort(np.concatenate([np.arange(50, 150, dtype=np.uint64), pool[50:350]])), None)
    a, b = ((v, r.integers(1, 4, len(v))) for v, _ in (a, b))
    true = N.similarity(w, a, b)
    s = N.samples(w, [a, b])
    assert abs(N.agreeing(s[0], s[1]) - true) < 4 * (true * (1 - true) / N.SAMPLES) ** 0.5
    assert abs(N.similarities(w, [a], [b, a]) - [true, 1.0]).max() < 1e-12


def test_ids_that_are_null_or_repeated(spark):
    """Rows are compared by text: a doc_id of two texts, nameless near copies, against all pairs."""
    a, b, c = prose(1, 100), prose(2, 100), prose(3, 100)
    rows = [doc(1, a), doc(1, b), doc(2, b + " three more words"), doc(None, c), doc(None, c + " and these"), doc(None, c), doc(5, a), doc(1, b), doc(None, prose(4, 50))]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = N.classes(docs).collect()
    by_class = {}
    for r in got:
        by_class.setdefault((r["class_id"], bytes(r["first_key"])), []).append(r["doc_id"])
    assert sorted(map(str, (sorted(v, key=str) for v in by_class.values()))) == sorted(map(str, ([1, 5], [1, 1, 2], [None] * 3, [None])))
    texts = [r[1] for r in rows]
    same = brute(texts)
    assert len(set(same)) == len(by_class) == 4
    kept = N.kept_documents(docs).collect()
    assert len(kept) == 4 and {same[texts.index(r["text"])] for r in kept} == set(same)


def test_links_of_a_whole_table_against_all_pairs(spark):
    """Every pair of texts of similarity 0.8 or more on a table of planted copies is in one class, and nothing else."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r for r in docs.select("doc_id", "text").orderBy("doc_id").collect() if r["text"]]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs).collect()}
    wanted = brute([r["text"] for r in rows])
    assert [got[r["doc_id"]] for r in rows] == [rows[k]["doc_id"] for k in wanted]


def test_edge_cases(edge, nothing):
    got = sorted((r["doc_id"] is None, r["doc_id"], r["class_id"], r["kept"]) for r in N.near_duplicates(edge).collect() if r["doc_id"] is not None)
    got = {d: (c, k) for _, d, c, k in got}
    assert got[1] == (1, True) and got[2] == (1, False) and got[3] == (3, True) and got[8] == (7, False)
    assert all(got[k] == (k, True) for k in (4, 5, 6, 9, 10, 11, 12, 13))
    nameless = sorted((r["class_id"] or 0, r["kept"]) for r in N.near_duplicates(edge).where("doc_id is null").collect())
    assert nameless == [(0, True), (1, False)]  # a class of no doc_id, and a copy of document 1
    kept = N.kept_documents(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 1, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13]
    assert N.near_duplicates(nothing).count() == 0 and N.kept_documents(nothing).count() == 0
