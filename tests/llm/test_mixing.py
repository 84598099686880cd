import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandwork.llm import mixing as M
from strandwork.llm.queries import OP2_SQL

from .conftest import DOCS, doc, prose


def shared(sizes):
    """Targets by repeating: give by weight, cap at three times the size, share the rest anew."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(sizes), sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("counts", [(40, 5, 60, 3, 80), (3, 90, 2, 1, 1, 2), (30,), (1, 200, 200)])
def test_targets_and_takes(spark, counts):
    rows = [doc(1000 * s + k, prose(1000 * s + k, 5 + (k * 7) % 30), None if s == 4 else f"s{s}") for s, n in enumerate(counts) for k in range(n)]
    got = M.mix(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    sizes, taken, largest = Counter(), Counter(), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert r["size"] == len(next(x[1] for x in rows if x[0] == r["doc_id"]).split()) and r["taken"] in [k * r["size"] for k in range(4)]
    target = shared(sizes)
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-12) and r["source_size"] == sizes[r["source"]]
    # Served in order of finish: no source is a document behind the common time, and the budget holds for all together.
    most = max(largest.values())
    assert all(abs(taken[s] - target[s]) <= largest[s] + target[s] / sum(target.values()) * sum(largest.values()) for s in sizes)
    assert abs(sum(taken.values()) - sum(target.values())) <= most / 2 + 1e-9
    assert all(taken[s] <= 3 * sizes[s] for s in sizes)
    finish = [r["virtual_finish"] for r in got]
    assert finish == sorted(finish)
    again = M.mix(spark.createDataFrame(rows[::-1], DOCS).repartition(2)).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in got}


def queue_sort(rows, weights=(5, 2, 1)):
    """Every sending in one list, sorted by virtual finish time and truncated at the budget."""
    distinct = Counter((r[3], r[0], r[1]) for r in rows)
    at = lambda k: hashlib.md5(f"{'' if k[1] is None else k[1]}\x1f{k[2] or ''}".encode()).hexdigest()
    size = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[2] or ""))
    sizes = Counter()
    for k, n in distinct.items():
        sizes[k[0]] += n * size(k)
    target, sent = shared(sizes), []
    for s in sizes:
        end = 0
        for k in sorted((k for k in distinct if k[0] == s), key=at):
            end += size(k) * distinct[k]
            sent += [((turn * sizes[s] + end) / target[s], k) for turn in range(3) if size(k) and target[s]]
    times, total = Counter(), 0
    for finish in sorted({f for f, _ in sent}):
        group = [k for f, k in sent if f == finish]
        words = sum(size(k) * distinct[k] for k in group)
        if total + words / 2 > sum(target.values()):
            break
        total += words
        times.update(group)
    return {k: times[k] * size(k) for k in distinct}


def test_takes_are_those_of_the_sorted_and_truncated_queue(spark, edge_rows):
    rows = [doc(100 + k, prose(k, 3 + k % 50), f"s{k % 7 % 4}") for k in range(300)] + [doc(1, prose(9, 4000), "s1")] * 3 + [doc(None, prose(k, 20), "s2") for k in range(40)] + list(edge_rows)
    wanted = queue_sort(rows)
    want = Counter((k[1], k[0], size) for (k, size), n in zip(wanted.items(), Counter((r[3], r[0], r[1]) for r in rows).values()) for _ in range(n))
    got = Counter((r["doc_id"], r["source"], r["taken"]) for r in M.mix(spark.createDataFrame(rows, DOCS).repartition(4)).collect())
    assert got == want


def test_the_order_of_the_queue_decides(spark, monkeypatch):
    rows = spark.createDataFrame([doc(k, prose(k, 5 + k % 30), f"s{k % 3}") for k in range(200)], DOCS)
    before = {r["doc_id"]: r["taken"] for r in M.mix(rows).collect()}
    monkeypatch.setattr(M, "_finish", lambda turn: F.when(F.col("target") > 0, turn + F.col("size").cast("double")))
    assert {r["doc_id"]: r["taken"] for r in M.mix(rows).collect()} != before


def test_against_sql(spark, edge, edge_rows):
    documents = pd.DataFrame([r[:4] for r in edge_rows], columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", documents)
    wanted = sorted(map(str, con.execute(f"SELECT coalesce(doc_id, -1), size, source_size, target, taken FROM ({OP2_SQL})").fetchall()))
    got = sorted(str((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"])) for r in M.mix(edge).collect())
    assert got == wanted


def test_mixed_documents(edge, nothing):
    plan = Counter()
    for r in M.mix(edge).collect():
        if r["size"]:
            plan[r["doc_id"]] += r["taken"] // r["size"]
    mixed = M.mixed_documents(edge)
    assert mixed.columns == edge.columns
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == +plan
    assert M.mix(nothing).count() == 0 and M.mixed_documents(nothing).count() == 0
