import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from strandwork.llm import lm_score as L

from .conftest import DOCS, doc, prose

LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def test_counts_and_base_score(spark, edge, edge_rows, nothing):
    rows = [*edge_rows, *[doc(100 + k, prose(k % 9, 40)) for k in range(60)]]
    count = Counter()
    for r in rows:
        if not held(r[0]):
            count.update(tokens(r[1]))
    n, v = sum(count.values()), len(count)
    wanted = Counter()
    for r in rows:
        t = tokens(r[1])
        wanted[(r[0], held(r[0]), len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 3))] += 1
    got = L.score(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in got) == wanted
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert L.score(nothing).count() == 0


def test_beats_word_counts_on_held_out_texts(spark):
    """Two languages of their own words: the words before tell which."""
    rows = []
    for k in range(300):
        words = [f"{'ab'[k % 2]}{(k * 31 + i * i * 7) % 40}" for i in range(60)]
        rows.append(doc(k, " ".join(words)))
    got = [r for r in L.score(spark.createDataFrame(rows, DOCS)).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) + 0.1 * sum(r["n_tokens"] for r in got)


def small(n=300, seed=1):
    """A vocabulary of several groups, rare classes of which one is empty, and parameters that are no longer at their start."""
    r = np.random.default_rng(seed)
    rare, kinds = r.integers(1, 90, L.RARE), r.integers(1, 9, L.RARE)
    rare[3] = kinds[3] = 0
    v = L.Vocabulary(r.integers(1, 1 << 62, n).astype(np.uint64), np.sort(r.integers(1, 5000, n))[::-1], rare, kinds)
    p = L.Parameters.start(v)
    for x in p.parts():
        x += r.normal(size=x.shape).astype(np.float32) * 0.3
    return v, L.for_scoring(p, v)


def plain_probability(p, v, before, word):
    """P(word | before), output by output."""
    h = [sum(float(p.context[c, s]) * float(p.place[k, s]) for k, c in enumerate(before)) for s in range(L.SIZE)] + [1.0]
    score = lambda x: sum(float(a) * b for a, b in zip(x, h))
    classes = [math.exp(score(x)) for x in p.klass]
    out = classes[v.class_of[word]] / sum(classes)
    if word < v.size:
        group = range(word % v.groups, v.size, v.groups)
        out *= math.exp(score(p.word[word])) / sum(math.exp(score(p.word[w])) for w in group)
    return out


def test_probabilities_against_the_plain_form_and_sum_to_one():
    v, p = small()
    assert v.groups == 3
    r = np.random.default_rng(2)
    before = np.repeat(r.integers(0, v.nothing + 1, (1, L.CONTEXT)), v.size + L.RARE, 0)
    got = np.exp(L.Scorer(p, v).log_probabilities(before, np.arange(v.size + L.RARE)))
    for w in (0, 1, 2, 150, 299, 300, 303, 331):
        assert got[w] == pytest.approx(plain_probability(p, v, before[0], w), rel=1e-4)
    # Of a rare class, the known words' shares and one share for unseen ones.
    total = v.rare_tokens + 0.5 * (v.rare_kinds + 1)
    within = [(n + 0.5 * k) / t + 0.5 / t for n, k, t in zip(v.rare_tokens, v.rare_kinds, total)]
    assert within == pytest.approx([1] * L.RARE) and got[: v.size].sum() + (got[v.size :] * within).sum() == pytest.approx(1, abs=1e-5)


def test_scores_against_the_plain_form(spark, monkeypatch):
    """score() of documents from the fitted parameters, token by token; some words are rare, some unseen."""
    monkeypatch.setattr(L, "MODEL_WORDS", 150)
    made = {}
    monkeypatch.setattr(L, "fit", lambda blocks, v, f=L.fit: made.setdefault("fit", (v, f(blocks, v)))[1])
    rows = [doc(k, prose(k % 40, 30) + f" only{k} " + prose(k % 7, 12)) for k in range(120)]
    got = {r["doc_id"]: r for r in L.score(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    v, flat = made["fit"]
    p = L.for_scoring(L.Parameters.of(flat, v), v)
    count = Counter(t for r in rows if not held(r[0]) for t in tokens(r[1]))
    hashes = lambda t: L.END if t is None else L.words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0][0]
    rank = {int(h): int(n) for h, n in zip(v.hashes, v.number)}
    assert v.size == 150 and sorted(v.counts, reverse=True) == sorted(count.values(), reverse=True)[:150]

    def number(t):
        if int(hashes(t)) in rank:
            return rank[int(hashes(t))]
        raw = np.frombuffer(t.encode(), np.uint8)
        return v.size + int(L._classes(raw, np.array([0]), np.array([len(raw)]))[0])

    for r in [x for x in rows if held(x[0])][:6] + rows[:3]:
        ids = [number(t) for t in tokens(r[1])]
        want = 0.0
        for k, (t, w) in enumerate(zip(tokens(r[1]), ids)):
            before = [ids[k - 1 - j] if k - 1 - j >= 0 else v.nothing for j in range(L.CONTEXT)]
            want += math.log10(plain_probability(p, v, before, w))
            if w >= v.size:
                c = w - v.size
                want += math.log10((count[t] + 0.5) / (v.rare_tokens[c] + 0.5 * (v.rare_kinds[c] + 1)))
        assert got[r[0]]["score"] == pytest.approx(want, rel=1e-4)


def test_rounds_take_every_training_position_once():
    for n in (0, 1, 2, 5, 520_000):
        usable = np.arange(n) * 2 + 1
        shares = [L.share_of(usable, turn) for turn in range(L.ROUNDS)]
        assert np.array_equal(np.sort(np.concatenate(shares)), usable)
    v, p = small()
    descent = L.Descent(p, v)
    r = np.random.default_rng(4)
    ids = r.integers(0, v.size + L.RARE, 5000).astype(np.int32)
    for turn in range(L.ROUNDS):
        at = L.share_of(np.arange(5000), turn)
        descent.learn(L.contexts(ids, at, np.zeros(len(at), np.int64), v.nothing), ids[at], turn)
    assert (descent.used[3] == 5000).all() and descent.used[0].sum() == 5000 * L.CONTEXT
    assert descent.used[2].sum() >= 5000 and descent.used[1].sum() == (ids < v.size).sum() * (1 + L.GROUP_NOISE)


def test_without_training_documents(spark):
    ids = [k for k in range(200) if held(k)][:5]
    got = L.score(spark.createDataFrame([doc(k, prose(k, 20)) for k in ids], DOCS)).collect()
    assert len(got) == 5 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in got)
