"""Findings of round 3: genes of very many rows, and ties."""

import random

import pytest
from pyspark.sql import functions as F

from strandwork.plans import exchange_queries

ROWS = "gene string, name string, seq string"


def test_lines_of_a_record_stay_together(spark, tmp_path):
    """records of one id, and records at the border of two files."""
    docs = [(k // 2, "s", "en", "ACGT" * (k % 5 + 1) + "CA" * k) for k in range(60)]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    with_parts = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in with_parts}
    try:
        for k, v in with_parts.items():
            spark.conf.set(k, v)
        got = sorted(map(tuple, exchange_queries.fasta_lines(spark, f"file://{tmp_path}").collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    import hashlib

    assert got == sorted((str(i), hashlib.md5(t.encode()).hexdigest()) for i, _, _, t in docs)


def _gene_rows(n, width=40, letters="MKVL-", seed=1):
    r = random.Random(seed)
    return [("g", f"n{k:04d}", "".join(r.choice(letters) for _ in range(r.randint(width // 2, width)))) for k in range(n)]


def test_fragments_in_blocks(spark, monkeypatch):
    """a gene's components are dealt into many blocks, each beside the counts of its references."""
    from strandwork.operators.grouped import frames, merging
    from strandwork.operators.grouped.columns import Row

    monkeypatch.setattr(frames, "BLOCK_ROWS", 8)
    rows, refs = _gene_rows(60), [s for _, _, s in _gene_rows(9, seed=2)]
    left = spark.createDataFrame(rows, ROWS).withColumn("component", F.substring("name", 1, 4))
    right = spark.createDataFrame([("g", f"r{k}", s) for k, s in enumerate(refs)] + [("h", "r", "MKVL")], ROWS)
    got = {(x["component"], x["names"], x["seq"]) for x in frames.fragments_spliced(left, right).collect()}
    parts = {}
    for _, n, s in rows:
        parts.setdefault(n[:4], []).append(Row(n, s))
    assert got == {(c, n, s) for c, part in parts.items() for n, s in merging.spliced(part, refs)}


def test_gaps_against_every_place(spark, monkeypatch):
    """the scan of all places as arrays gives what letter by letter gives; references are counted once."""
    from strandwork.functions.dna import CODONS
    from strandwork.operators.grouped import columns, frames, trimming

    def plain(genomic, refs, first, last, share, least=10):
        counts = columns.reference_counts(refs)[first:last]
        n, top, best = len(counts), sum(min(100, max(c.values(), default=0)) for c in counts), None
        if not 5 <= n <= 60 or not top:
            return None
        for at in range(len(genomic) - 3 * n + 1):
            aa = "".join(CODONS.get(genomic[at + 3 * k : at + 3 * k + 3], "X") for k in range(n))
            score = sum(-5 if c == "*" else min(100, counts[k].get(c, 0)) for k, c in enumerate(aa))
            if best is None or score > best[0]:
                best = (score, at, aa)
        return (best[1], best[2]) if best and best[0] >= (share if n >= least else 0.85) * top else None

    r = random.Random(4)
    refs = ["".join(r.choice("MKVLSTX*-") for _ in range(r.randint(8, 20))) for _ in range(30)]
    gaps = [("g", f"n{k}", "".join(r.choice("ACGT-N") if r.random() < 0.1 else r.choice("ACGT") for _ in range(r.randint(0, 80))), r.randint(0, 6), r.randint(8, 25)) for k in range(60)]
    want = {n: found for _, n, t, s, e in gaps if (found := plain(t, refs, s, e, 0.2))}
    assert want and {n: found for _, n, t, s, e in gaps if (found := trimming.filled_gap(t, refs, (s, e), 0.2))} == want
    monkeypatch.setattr(frames, "BLOCK_ROWS", 8)
    right = spark.createDataFrame([("g", f"r{k}", s) for k, s in enumerate(refs)], ROWS)
    got = frames.gaps_filled(spark.createDataFrame(gaps, "gene string, name string, genomic string, first int, last int"), right, 0.2).collect()
    assert {x["name"]: (x["at"], x["aa"]) for x in got} == want


def test_matches_in_blocks(spark, monkeypatch):
    """scores by counts of references, of rows wider than them, of empty texts and genes without references."""
    from strandwork.operators.grouped import frames

    def plain(seq, refs):
        body = seq.strip("-")
        start = len(seq) - len(seq.lstrip("-"))
        scores = []
        for k in range(start, start + len(body)):
            here = [x[k] for x in refs if k < len(x) and x[k] != "-"]
            if refs and 1 - len(here) / len(refs) <= 0.5:
                scores.append(-1.0 if seq[k] == "-" else here.count(seq[k]) / len(here))
        return sum(scores) / len(scores) if scores else 0.0

    monkeypatch.setattr(frames, "BLOCK_ROWS", 8)
    refs = [s for _, _, s in _gene_rows(9, seed=2)]
    rows = [*_gene_rows(50, 60), ("g", "empty", ""), ("g", "gaps", "---"), ("h", "alone", "MKVL")]
    right = spark.createDataFrame([("g", f"r{k}", s) for k, s in enumerate(refs)], ROWS)
    got = {(x["gene"], x["name"]): x["score"] for x in frames.match_scores(spark.createDataFrame(rows, ROWS), right).collect()}
    assert got == {(g, n): pytest.approx(plain(s, refs if g == "g" else [])) for g, n, s in rows}


def _plain_consensus(rows, threshold, least=1):
    out = []
    for k in range(max((len(r.seq) for r in rows), default=0)):
        votes = {}
        for r in rows:
            if r.start <= k < r.end:
                votes[r.seq[k]] = votes.get(r.seq[k], 0) + r.weight
        if not votes or sum(votes.values()) < least:
            out.append("-")
            continue
        best, data = max(votes, key=lambda c: (votes[c], c)), [c for c in votes if c != "-"]
        out.append(best if votes[best] > threshold * sum(votes.values()) else data[0] if len(data) == 1 else "X")
    return "".join(out)


def test_consensus_in_parts(monkeypatch):
    """The votes of rows, counted a few at a time, against letter by letter."""
    from strandwork.operators.grouped import columns

    monkeypatch.setattr(columns, "STEP", 100)
    r = random.Random(6)
    for k in range(30):
        rows = [columns.Row(n, s, r.randint(1, 3)) for _, n, s in _gene_rows(r.randint(0, 12), 20, "MK--", k)] + [columns.Row("wide", "-" * 25), columns.Row("none", "")]
        for threshold, least in ((0.5, 1), (0.3, 4), (0.65, 2)):
            assert columns.consensus(rows, threshold, least) == _plain_consensus(rows, threshold, least)


@pytest.fixture()
def many(spark):
    from strandwork.operators.grouped.columns import Row

    rows = [(g, n, s) for g, seed in (("g", 1), ("h", 2)) for _, n, s in _gene_rows(40, 30, "MMMK--", seed)] + [("h", "odd", "WWWWWWWWWWWW")]
    return spark.createDataFrame(rows, ROWS), {g: [Row(n, s) for h, n, s in sorted(rows) if h == g] for g in ("g", "h")}


def _no_group_holds_texts(frame):
    plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
    assert "FlatMapGroupsInPandas" not in plan


def test_shallow_regions_from_counts(many):
    """F16: no task holds the rows of a gene."""
    from strandwork.operators.grouped import assembly, frames

    found = frames.shallow_regions(many[0], 0.3, 40)
    _no_group_holds_texts(found)
    want = {(g, *x) for g, rows in many[1].items() for x in assembly.shallow_regions(rows, 0.3, 40)}
    assert want and set(map(tuple, found.collect())) == want


def test_ambiguous_regions_from_counts(many):
    """F25."""
    from strandwork.operators.grouped import columns, frames

    for join in (0, 3):
        found = frames.x_regions(many[0], 0.5, join)
        _no_group_holds_texts(found)
        want = {(g, *x) for g, rows in many[1].items() for x in columns.runs_of(columns.consensus(rows, 0.5), "X", join)}
        assert want and set(map(tuple, found.collect())) == want


def test_gap_regions_from_counts(many):
    """F28."""
    from strandwork.operators.grouped import frames, screening

    for join in (0, 2):
        found = frames.gap_regions(many[0], 0.35, join)
        _no_group_holds_texts(found)
        want = {(g, *x) for g, rows in many[1].items() for x in screening.ambiguous_regions(rows, 0.35, join)}
        assert want and set(map(tuple, found.collect())) == want


def test_severe_rows_from_counts(many):
    """F18."""
    from strandwork.operators.grouped import frames, screening

    found = frames.severe(many[0], 0.4, 0.1, 1.0)
    _no_group_holds_texts(found)
    want = {(g, n) for g, rows in many[1].items() for n in screening.severe_rows(rows, 0.4, 0.1, 1.0)}
    assert ("h", "odd") in want and set(map(tuple, found.collect())) == want


def test_consensus_match_from_counts(many):
    """the share of letters that equal the consensus of the rows that passed."""
    from strandwork.operators.grouped import frames

    marked = many[0].withColumn("passed", F.col("name") < "n0030")
    want = {}
    for g, rows in many[1].items():
        agreed = _plain_consensus([r for r in rows if r.name < "n0030"], 0.65)
        for r in rows:
            pairs = [(a, b) for a, b in zip(r.seq, agreed) if a not in "-X" and b not in "-X"]
            want[g, r.name] = pytest.approx(sum(a == b for a, b in pairs) / len(pairs)) if pairs else None
    assert {(x["gene"], x["name"]): x["match"] for x in frames.consensus_match(marked).collect()} == want


def test_profile_filter_keeps_its_order(spark, monkeypatch):
    """F8: rows against the widest of the kept ones only, as against all kept ones."""
    from strandwork.operators.grouped import frames, screening, trimming
    from strandwork.operators.grouped.columns import span

    def plain(rows, refs, least):
        gone, kept = [], []
        for r in sorted(rows, key=lambda r: (-r["score"], r["name"])):
            s, e = span(r["seq"])
            bad = trimming.average_match(r["seq"], refs) < least
            for k in kept:
                a, b = span(k["seq"])
                common = (min(e, b) - max(s, a)) / max(1, e - s)
                bad |= k["read"] == r["read"] and common >= 0.8
                bad |= common >= 0.6 and r["score"] > 0 and k["score"] / r["score"] >= 1.15
            (gone if bad else kept).append(r)
        return sorted(r["name"] for r in gone)

    r = random.Random(9)
    monkeypatch.setattr(frames, "BLOCK_ROWS", 16)
    for _ in range(3):
        rows = []
        for k in range(80):
            s, n = r.randint(0, 50), r.randint(0, 15)
            rows.append(("g", f"n{k:03d}", "-" * s + "".join(r.choice("MMMK") for _ in range(n)) + "-" * (66 - s - n), r.randint(0, 30), float(r.randint(-1, 60))))
        refs = ["M" * 66, "MK" * 33, "M" * 50]
        want = plain([dict(zip(("gene", "name", "seq", "read", "score"), x)) for x in rows], refs, 0.4)
        assert 5 < len(want) < 75 and screening.profile_filter([dict(zip(("gene", "name", "seq", "read", "score"), x)) for x in rows], refs, 0.4) == want
    right = spark.createDataFrame([("g", f"r{k}", s) for k, s in enumerate(refs)], ROWS)
    got = frames.profile_filtered(spark.createDataFrame(rows, ROWS + ", read long, score double"), right, 0.4).collect()
    assert sorted(x["name"] for x in got) == want


def test_many_clusters_of_one_gene():
    """a walk of very many candidates, whose ids are one run, and the clusters that it gives against each other."""
    import time

    import pandas as pd

    from strandwork.operators.grouped import clusters

    r = random.Random(12)
    n, width = 6000, 60
    rows = []
    for k in range(n):
        s = r.randint(0, 20)
        rows.append((f"n{k:05d}", [k], "+-"[k // 2 % 2], "-" * s + "".join(r.choice("MK") for _ in range(width - 2 * s)) + "-" * s))
    begun = time.monotonic()
    gone = clusters.filtered_clusters(pd.DataFrame(rows, columns=["name", "ids", "strand", "seq"]), ["MK" * 30], 100, 0.3)
    assert gone and time.monotonic() - begun < 30  # by pairs of sets of columns it took minutes
    one = [clusters.Member(f"n{k:05d}", [k], "+", k // 100, k // 100 + 50, frozenset()) for k in range(20000)]
    begun = time.monotonic()
    found = clusters.directional_clusters(one, 100, 0.3, 300, 0.0)
    assert [len(c.members) for c in found] == [20000] and time.monotonic() - begun < 10


def test_excision_beside_counts(spark):
    """references are counted where they are, and meet their gene's rows as counts."""
    from strandwork.operators.grouped import frames, trimming
    from strandwork.operators.grouped.columns import Row, reference_letters

    rows, refs = _gene_rows(25, 40, "MKV-", 3), _gene_rows(6, 40, "MKV-", 4)
    want, gone = trimming.excised([Row(n, s) for _, n, s in rows], [s for _, _, s in refs], 0.5, 6, 3)
    assert gone or any(w.seq != s for w, (_, _, s) in zip(want, rows))
    found = frames.excised(spark.createDataFrame(rows, ROWS), spark.createDataFrame(refs, ROWS), 0.5, least=3)
    assert {x["name"]: x["seq"] for x in found.collect()} == {w.name: w.seq for w in want} | dict.fromkeys(gone)
    a, b = trimming.excised([Row(n, s) for _, n, s in rows], reference_letters([s for _, _, s in refs]), 0.5, 6, 3)
    assert ([r.seq for r in a], b) == ([r.seq for r in want], gone)


def test_hits_of_reads_in_one_walk(spark):
    """reads next to each other, one over many batches, null keys; no call for each read."""
    from strandwork.operators.grouped import assembly

    r = random.Random(15)
    rows = [(r.choice(["g", "h", None]), r.choice([1, 2, None]), k, "".join(r.choice("AC") for _ in range(r.randint(1, 6))), r.choice("MKVLST") * r.randint(1, 3)) for k in range(400)]
    want = set()
    for key in {(g, n) for g, n, *_ in rows}:
        own = [x for x in rows if x[:2] == key]
        want |= {(*x[:3], s) for x, s in zip(own, assembly.contained_duplicates([x[3:] for x in own])) if s is not None}
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = assembly.deduped_hits(spark.createDataFrame(rows, "gene string, node long, k int, nt string, aa string"), "gene", "node", ["k"])
        _no_group_holds_texts(found)
        assert {(x["gene"], x["node"], x["k"], x["suffix"]) for x in found.collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)


def test_deviating_rows_of_many():
    """all distances of a gene as matrix products give what pair by pair gives, in seconds for a thousand rows."""
    import time

    from strandwork.functions.blosum import blosum62_distance
    from strandwork.operators.grouped import screening
    from strandwork.operators.grouped.columns import Row

    r = random.Random(18)
    pair_by_pair = lambda a, b: blosum62_distance(a, b)
    some = 0
    for _ in range(40):
        width = r.randint(1, 40)
        base = "".join(r.choice("MKVLST") for _ in range(width))
        rows = []
        for k in range(r.randint(0, 12)):
            s = r.randint(0, width)
            e, share = r.randint(s, width), r.choice([0.1, 0.1, 0.8])
            rows.append(Row(f"n{k:02d}", "-" * s + "".join(r.choice("MKVLST-XB") if r.random() < share else c for c in base[s:e]) + "-" * r.choice([0, width - e])))
        want = screening.deviating_rows(rows, rounds=2, distance=pair_by_pair), screening.deviating_halves(rows, rounds=2, distance=pair_by_pair)
        assert (screening.deviating_rows(rows, rounds=2), screening.deviating_halves(rows, rounds=2)) == want
        some += bool(want[0])
    assert some
    rows = [Row(f"n{k:04d}", "".join(r.choice("MKVLSTAR") for _ in range(400))) for k in range(1200)]
    begun = time.monotonic()
    screening.deviating_rows(rows, rounds=2)
    assert time.monotonic() - begun < 20
