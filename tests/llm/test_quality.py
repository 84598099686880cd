import math
import zlib

import numpy as np
import pytest
import zstandard

from strandwork.llm import quality as Q

from .conftest import DOCS, doc, prose


@pytest.fixture(scope="module")
def labelled(spark):
    good = [doc(k, prose(k, 80)) for k in range(240)]
    bad = [doc(1000 + k, " ".join(w.upper() + "!!" + "*&%"[i % 3] for i, w in enumerate(prose(k, 25).split())) * 3) for k in range(120)]
    labels = [(d[0], int(d[0] < 1000), 0) for d in good + bad] + [(5, 0, 0), (None, 1, 0), (77777, 1, 1)]
    return spark.createDataFrame(good + bad, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(labelled):
    rows = Q.score(*labelled).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 360 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["predicted"] == (r["doc_id"] < 1000) for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)


def test_held_out_rows_teach_nothing(labelled, spark):
    docs, labels = labelled
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end as quality", "toxic")
    a = {r["doc_id"]: r["score"] for r in Q.score(docs, labels).collect()}
    assert a == {r["doc_id"]: r["score"] for r in Q.score(docs, flipped).collect()}


def test_scores_against_a_plain_form(labelled, monkeypatch):
    """Evidence, prior, curve and score of whole texts, worked out one by one with zstandard itself."""
    docs, labels = labelled
    held = []
    monkeypatch.setattr(Q, "_calibrated", lambda good, bad, y, saved, size, share, f=Q._calibrated: held.append((y, saved, size, share)) or f(good, bad, y, saved, size, share))
    model = Q.fit(docs, labels)
    y, saved, size, share = held[0]
    assert 0 < len(y) <= 2 * Q.SAMPLE_DOCS // Q.CALIBRATE_EVERY and model.prior in Q.PRIORS

    def packed(dictionary, text):
        options = dict(level=Q.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), **options)
        return sum(len(c.compress(text[i : i + 1024])) for i in range(0, len(text), 1024))

    each = saved / np.maximum(1, size)
    assert model.mean == pytest.approx(share * np.median(each[y == 1]) + (1 - share) * np.median(each[y == 0]))
    losses = {}
    for prior in Q.PRIORS:
        x = (saved + prior * model.mean) / np.maximum(size + prior, 1)
        losses[prior] = Q._curve(x, y, share)[2]
    assert losses[model.prior] == pytest.approx(min(losses.values()), abs=1e-9)
    got = {r["doc_id"]: r["score"] for r in Q.score(docs, labels).collect()}
    for r in docs.select("doc_id", "text").limit(40).collect():
        text = r["text"].encode()
        e = (packed(model.bad, text) - packed(model.good, text) + model.prior * model.mean) / (len(text) + model.prior)
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-max(-50, min(50, model.slope * e + model.offset)))), abs=1e-9)


def test_edge_cases(edge, nothing, labelled, spark):
    rows = Q.score(edge, labelled[1]).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (4, 5, 13)}) == 1
    kept = Q.kept_documents(edge, labelled[1])
    assert kept.columns == edge.columns and kept.count() == sum(r["predicted"] for r in rows)
    assert Q.score(nothing, labelled[1]).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {round(r["score"], 6) for r in Q.score(edge, none).collect()} == {0.5}
