"""The order-dependent algorithms on small cases worked out by hand."""

import random

import pytest

from strandwork.operators.grouped import assembly as A
from strandwork.operators.grouped import clusters as C
from strandwork.operators.grouped import merging as M
from strandwork.operators.grouped import trimming as T
from strandwork.operators.grouped.columns import Row, best_split, consensus, excised_split, last_split, reference_counts, reference_letters, runs_of, span


def test_spans_and_consensus():
    assert span("--AB-C--") == (2, 6) and span("---") == (0, 0)
    assert consensus([Row("a", "-AC-G"), Row("b", "-AG-G", 2), Row("c", "--G--")], 0.5) == "-AG-G"
    assert consensus([Row("a", "AC"), Row("b", "AG")], 0.5) == "AX"
    assert consensus([Row("a", "AC", 3), Row("b", "AG")], 0.5, 5) == "--"
    assert runs_of("..XX.X...X", "X") == [(2, 4), (5, 6), (9, 10)] and runs_of("..XX.X...X", "X", 1) == [(2, 6), (9, 10)]
    assert best_split("AAAAAA", "CCCCCC", 0, 6, reference_counts(["AAACCC", "AAACCC"])) == 3


def test_split_rules_by_trying_every_place():
    r = random.Random(12)
    text = lambda n: "".join(r.choice("ACG-") for _ in range(n))
    for _ in range(400):
        a, b, refs = text(12), text(12), [text(12) for _ in range(r.randint(0, 3))]
        start, end = sorted(r.sample(range(13), 2))
        inside = [[x[k] for x in refs if x.strip("-") and len(x) - len(x.lstrip("-")) <= k < len(x.rstrip("-"))] for k in range(12)]
        value = lambda c, k: (inside[k].count(c) or -1) - (c == "-")
        scores = {i: sum(value(a[k] if k < i else b[k], k) for k in range(start, end)) for i in range(start, end + 1)}
        best = max([-1, *scores.values()])
        assert excised_split(a, b, start, end, reference_letters(refs)) == max((i for i, v in scores.items() if v == best), default=start)
        data = lambda c, k: sum(x[k] == c != "-" for x in refs)
        gains = {i: sum(data(a[k], k) - data(b[k], k) for k in range(start, i + 1)) for i in range(start, end)}
        best = max([0, *gains.values()])
        assert last_split(a, b, start, end, reference_counts(refs)) == max((i for i, v in gains.items() if v == best), default=0)
        joined = {i: sum(data(a[k] if k < i else b[k], k) for k in range(start, end)) for i in range(start, end + 1)}
        assert best_split(a, b, start, end, reference_counts(refs)) == min(i for i, v in joined.items() if v == max(joined.values()))


def member(name, ids, start, end, strand="+"):
    return C.Member(name, ids, strand, start, end, frozenset(range(start, end)))


def test_directional_clusters():
    run = lambda m, **k: [[x.name for x in c.members] for c in C.directional_clusters(m, k.get("distance", 100), 0.3, 100, k.get("single", 0.5))]
    a, b, c = member("a", [1], 0, 30), member("b", [50], 20, 60), member("c", [150], 55, 100)
    assert run([c, a, b]) == [["a", "b", "c"]]
    assert run([a, b, member("c", [151], 55, 100)]) == [["a", "b"]]  # 101 away, and c alone covers less than half
    assert run([a, b, member("c", [100], 0, 10)]) == [["a", "b"]]  # turns round
    assert run([a, member("b", [50], 20, 60, "-")]) == []
    assert run([member("a", [1], 0, 60)]) == [["a"]] and run([member("a", [1], 0, 40)]) == []


def test_directional_clusters_follow_the_rule():
    run = lambda m, **k: [[x.name for x in c.members] for c in C.directional_clusters(m, k.get("distance", 100), 0.3, 100, k.get("single", 0.5), k.get("reference"))]
    a, b = member("a", [1], 0, 30), member("b", [101], 20, 60)
    assert run([a, b]) == [["a", "b"]]  # exactly 100 apart
    assert run([a, member("b", [102], 20, 60)]) == []  # 101, and neither covers more than half
    # A lone row at exactly half of the columns goes; of the reference's columns it may cover more.
    assert run([member("a", [1], 0, 50)]) == [] and run([member("a", [1], 0, 51)]) == [["a"]]
    assert run([member("a", [1], 0, 50)], reference=frozenset(range(60))) == [["a"]]
    # Direction: equal spans keep it, a turn ends the cluster.
    up = [member("a", [1], 0, 30), member("b", [5], 25, 55), member("c", [9], 25, 55), member("d", [12], 0, 20)]
    assert run(up) == [["a", "b", "c"]]
    # A member whose follower runs the other way, nearer by id and by the ends of the spans, is left to the follower.
    left = [member("a", [1], 0, 30), member("b", [60], 40, 70), member("c", [70], 35, 68)]
    assert run(left) == [["b", "c"]]
    # A strand change; the shared id takes along who shares it, again until none does, and the whole cluster if all share it.
    shared = [member("a", [1, 7], 0, 30), member("b", [7], 10, 40), member("c", [7, 9], 5, 35, "-")]
    assert run(shared) == [["c", "a", "b"]]
    far = [member("a", [1], 0, 30), member("b", [2, 7], 10, 40), member("c", [7], 5, 35, "-"), member("d", [8], 6, 36, "-")]
    assert run(far) == [["c", "b"], ["d"]][:1]


def test_duplicates_and_assembly():
    assert A.contained_duplicates([("AAACCC", "KP"), ("AAACCC", "KP"), ("AACC", "NN"), ("GGGAAA", "KP"), ("TTTGGG", "FG")]) == ["", None, None, None, "_1"]
    r = random.Random(1)
    whole = "".join(r.choice("ACGT") for _ in range(200))
    reads = [Row(f"r{k}", "-" * k + whole[k : k + 60] + "-" * (140 - k)) for k in range(0, 141, 20)]
    odd = Row("odd", "-" * 30 + "A" * 60 + "-" * 110)
    assert A.assembled([*reads, odd]) == [(whole, sorted(x.name for x in reads))]
    assert A.assembled(reads[:3]) == []


def test_recovery_and_chunks():
    whole = "ACGTTGCAAGCTTACGATCGATCGGATCCAAGT" * 2
    kept = [Row("a", whole[:40] + "-" * 26), Row("b", whole[:40] + "-" * 26), Row("c", "-" * 28 + whole[28:])]
    fits, differs = Row("x", "-" * 25 + whole[25:60] + "-" * 6), Row("y", "-" * 25 + "T" * 35 + "-" * 6)
    assert A.recovered(kept, [fits, differs]) == ["x"]
    seq = "ACGTGCATCGATTACGGATCCTTAGCAATCGATCGGCTAAGCTTCGATCGATTAGC"
    hits = [{"name": "a", "strand": "+", "start": 0, "end": 45, "ids": [1], "seq": seq[:45]}, {"name": "b", "strand": "+", "start": 12, "end": 56, "ids": [2], "seq": seq[12:56]}]
    assert A.chunks_merged(hits) == [hits[0] | {"end": 56, "seq": seq[:56], "ids": [1, 2]}]
    assert len(A.chunks_merged([hits[0], hits[1] | {"ids": [9]}])) == 2


def test_merging():
    rows = [Row("a", "MKV---"), Row("b", "--VLS-"), Row("c", "-----T")]
    assert [[r.name for r in g] for g in M.overlap_groups(rows)] == [["a", "b", "c"]]
    assert [[r.name for r in g] for g in M.overlap_groups(rows, 1)] == [["a", "b"], ["c"]]
    assert [[r.name for r in g] for g in M.apart_groups(rows)] == [["a"], ["b", "c"]]
    nt = {"a": "ATGAAAGTT" + "-" * 9, "b": "-" * 6 + "GTGCTTTCT---"}
    assert M.split_merge(rows[:2], nt, ["MKVLS"]) == ("MKVLS-", "ATGAAAGTGCTTTCT---")
    votes = [Row(f"v{k}", "MA") for k in range(4)] + [Row("w", "MC")]
    codons = {**{f"v{k}": "ATGGCT" for k in range(4)}, "w": "ATGTGT"}
    assert M.split_merge([votes[4], *votes[:4]], codons, []) == ("MA", "ATGGCT")
    assert M.codon_consensus([Row("a", "ATGAAA"), Row("b", "ATGAAG")], 0.5) == "ATGAAR"


def test_trimming():
    assert T.back_translate("M-K", "ATGAAA") == "ATG---AAA" and T.back_translate("MK", "ATG") == "ATG---"
    ref = "MKVLSTARQWERTYPLKHGFD"
    bad = "WWW" + ref[3:]
    assert T.trimmed(bad, [ref]) == "---" + ref[3:] and T.trimmed("W" * 21, [ref]) is None and T.trimmed(ref[:10], [ref]) is None
    assert T.splice_candidates("GT" + "C" * 26 + "AGAG") == [(0, 30)]
    left, right = "ATGGCC", "GCCAAATTT"
    assert T.best_splice(left, right, "GTAAGTCCCCAG") == (0, 0, 0)
    gene = "CCCC" + "ATGAAAGTTCTTTCTACTGCTCGTCAATGG" + "TTTT"
    assert T.filled_gap(gene, ["MKVLSTARQW"], (0, 10)) == (4, "MKVLSTARQW")
    assert T.filled_gap("A" * 40, ["MKVLSTARQW"], (0, 10)) is None
    assert T.average_match("MK-L", ["MKVL", "MRVL"]) == pytest.approx((1 + 0.5 - 1 + 1) / 4)
    a, b = Row("a", "AAAAAAAAAATTTTTTTTTT" + "-" * 10), Row("b", "-" * 10 + "GGGGGGGGGG" + "CCCCCCCCCC")
    rows, gone = T.excised([a, b], ["AAAAAAAAAATTTTTTTTTTCCCCCCCCCC"], least=5)
    assert gone == [] and [r.seq for r in rows] == [a.seq, "-" * 20 + "C" * 10]


def test_clusters_and_merges_in_spark(spark):
    rows = spark.createDataFrame([("g", "a", [1], "+", "MKVL------"), ("g", "b", [2], "+", "---LSTAR--"), ("g", "c", [900], "+", "--------QW")], "gene string, name string, ids array<long>, strand string, seq string")
    got = C.clustered(rows, "gene").collect()
    assert [(r["id_min"], r["id_max"], r["names"]) for r in got] == [(1, 2, ["a", "b"])]
    rows = spark.createDataFrame([("g", "t", "a", "R", 1, "MK-", "ATGAAA---"), ("g", "t", "b", "R", 2, "-KV", "---AAGGTT"), ("g", "u", "c", "S", 1, "M--", "ATG------")], "gene string, taxa string, name string, ref string, weight int, aa string, nt string")
    refs = spark.createDataFrame([("g", "MKV")], "gene string, seq string")
    got = {r["taxa"]: r for r in M.merged(rows, refs).collect()}
    assert (got["t"]["names"], got["t"]["aa"], got["t"]["nt"], got["t"]["total"]) == ("a&&b", "MKV", "ATGAAGGTT", 3) and got["u"]["aa"] == "M--"
    assert {r["aa"] for r in M.merged(rows, refs, "split").collect()} == {"MKV", "M--"}


def test_screening(spark):
    from strandwork.operators.grouped import screening as S

    refs = [Row("ref_one", "MKVLSTARQWER"), Row("ref_two", "MKVLSTARQWEK"), Row("ref_six", "MKVISTARQWEK")]
    rows = [Row("good", "MKVLSTARQWEK"), Row("bad", "WWWWWWWWWWWW"), Row("short", "MKV---------")]
    got = S.distance_outliers(rows, refs)
    assert {n: v["grade"] for n, v in got.items()} == {"good": "pass", "bad": "fail", "short": "unscored"}
    frame = lambda rs: spark.createDataFrame([("g", r.name, r.seq) for r in rs], "gene string, name string, seq string")
    assert {r["name"]: r["grade"] for r in S.screened(frame(rows), frame(refs)).collect()} == {"good": "pass", "bad": "fail", "short": "unscored"}
    hits = [{"name": "a", "read": 1, "seq": "MKVLST", "score": 9.0}, {"name": "b", "read": 1, "seq": "MKVLS-", "score": 8.5}, {"name": "c", "read": 2, "seq": "MKVL--", "score": 5.0}, {"name": "d", "read": 3, "seq": "WWWWWW", "score": 9.5}]
    assert S.profile_filter(hits, ["MKVLST", "MKVLST"]) == ["b", "c", "d"]
    two = [{"gene": "g", "score": 10.0, "uid": "1"}, {"gene": "h", "score": 9.5, "uid": "2"}]
    assert S.ambiguous_nodes(two, {"h"}) == ["1"] and S.ambiguous_nodes([two[0], two[1] | {"score": 5.0}], {"h"}) == ["2"] and S.ambiguous_nodes(two[:1], set()) == []
    assert S.ambiguous_regions([Row("a", "A--A"), Row("b", "AC-A"), Row("c", "AC-A")], 0.3) == [(1, 2)]
    assert S.severe_rows([Row(f"r{k}", "MKVLSTARQW") for k in range(5)] + [Row("x", "WWWWWWWWWW")]) == ["x"]
    alike = [Row(f"r{k:02}", "MKVLSTARQW" * 4) for k in range(12)]
    assert S.deviating_rows([*alike, Row("x", "W" * 40), Row("y", "MK")], least=3) == ["x"]
    half = [Row("x", "MKVLSTARQW" * 2 + "W" * 20), Row("z", "W" * 20 + "MKVLSTARQW" * 2)]
    assert S.deviating_halves([*alike, *half]) == {"x": "second", "z": "first"}
    assert S.best_isoform([Row("i1", "MKWW"), Row("i2", "MKVL")], ["MKVL", "MKVI"]) == "i2"


def test_aligning(spark):
    from strandwork.operators.grouped import aligning as G

    assert G.global_alignment("ACGT", "AGT") == ("ACGT", "A-GT") and G.global_alignment("", "AC") == ("--", "AC")
    r = random.Random(8)
    exon = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    a, b = exon(60), exon(60)
    intron = "GT" + "".join(r.choice("CT") for _ in range(56)) + "AG"
    assert G.introns_removed(a + intron + b, a + b) == (a + b, [(60, 120)]) and G.introns_removed(a + b, a + b) == (a + b, [])
    rows = spark.createDataFrame([("g", 1, a + intron + b, a + b)], "gene string, node long, seq string, reference string")
    assert G.intron_free(rows).first()["introns"][0]["e"] == 120
    reads = spark.createDataFrame([(1, 1, "MKVLSTARQWERTY"), (2, 1, "WWWWWWW")], "node long, frame int, aa string")
    targets = spark.createDataFrame([("t", "AAMKVLSTARQGG"), ("u", "PPPPPPP")], "target string, seq string")
    assert [tuple(x) for x in G.seeded_hits(reads, targets).collect()] == [(1, 1, "t", 5, 0, 9)]


def test_rows_resume_around_a_stop_where_they_agree():
    ref = "MKVLSTARQWERTYPLKHGFDNCIMKVLSTARQWERTYPL"
    seq = ref[:18] + "*" + ref[19:]
    assert T.trimmed(seq, [ref]) == ref[:18] + "-" + ref[19:]
    worse = ref[:16] + "PP*PPP" + ref[22:]  # two mismatches are allowed on either side, of which the first goes with the stop
    assert T.trimmed(worse, [ref]) == ref[:16] + "P----P" + ref[22:]
    at = T.Columns.of([ref])
    wide = T.Columns(*[list(getattr(at, f)) for f in ("letters", "similar", "filled", "empty", "poor")])
    assert T._resumed(seq, wide, 6, 2, 18, len(ref)) == 19 and T._resumed(seq, wide, 6, 0, 18, len(ref)) == 19
    assert T._resumed("P" * 40, wide, 6, 2, 18, len(ref)) == len(ref)
    gap = seq[:22] + "-" + seq[23:]
    assert T._resumed(gap, wide, 6, 2, 18, len(ref)) == 23  # the gap in a full column ends tries that reach over it
