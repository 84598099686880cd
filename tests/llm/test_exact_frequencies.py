"""Document frequencies of op1 count exactly, however few documents hold a shingle."""

import numpy as np

from strandwork.llm import near_dedup as N

from .conftest import DOCS, doc, prose


def frequencies(texts):
    out = {}
    for text in texts:
        words = text.split()
        for gram in {tuple(words[k : k + 5]) for k in range(len(words) - 4)}:
            out[gram] = out.get(gram, 0) + 1
    return out


def alike(a, b, df, n, floor):
    x, y = (t.split() for t in (a, b))
    x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (x, y))
    weight = lambda grams: sum(np.log1p(n / max(df[g], floor)) for g in grams)
    return weight(x & y) / weight(x | y)


def test_shingles_of_few_documents_weigh_less(spark):
    """A passage that 12 of 1,200 documents hold, which is below a 64th: what two of them share beside it decides."""
    passage = prose(1, 100)
    texts = [passage + " " + prose(10 + k, 10) for k in range(12)] + [prose(100 + k, 20) for k in range(1188)]
    df, n = frequencies(texts), len(texts)
    flat, exact = (alike(texts[0], texts[1], df, n, floor) for floor in (n / 64, 2))
    assert exact < 0.8 < flat
    texts[1] = texts[0] + " " + prose(9000, 5)
    df = frequencies(texts)
    assert alike(texts[0], texts[2], df, n, 2) < 0.8 < alike(texts[0], texts[1], df, n, 2)
    chunks = N.chunked(spark.createDataFrame([doc(k, t) for k, t in enumerate(texts)], DOCS).repartition(7)).localCheckpoint()
    got = {}
    for row in N.common_shingles(chunks).collect():
        got |= dict(zip(np.frombuffer(row["shingles"], "<u8").tolist(), np.frombuffer(row["df"], "<u4").tolist(), strict=True))
    assert sorted(got.values()) == sorted(k for k in df.values() if k > 2)
    rows = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(spark.createDataFrame([doc(k, t) for k, t in enumerate(texts)], DOCS).repartition(4)).collect()}
    assert rows[1] == rows[0] == 0 and rows[2] == 2
