"""The DataFrame forms of the grouped algorithms, the stage drivers and the command line."""

import random

import pytest
from pyspark.sql import functions as F

from strandwork.functions import blosum, registered
from strandwork.functions.dna import CODONS
from strandwork.operators.grouped import aligning, assembly, frames, merging, trimming
from strandwork.operators.grouped.columns import Row
from strandwork.plans import stages

ROWS = "gene string, name string, seq string"
LETTERS = "MKVLSTARQWEDNGHFYCIP"


def protein(r, n):
    return "".join(r.choice(LETTERS) for _ in range(n))


def test_blosum():
    assert all(blosum.SCORES[ord(a), ord(b)] == blosum.SCORES[ord(b), ord(a)] for a in blosum.LETTERS for b in blosum.LETTERS)
    assert blosum.similar_letters("strict")["I"] == "ILMV" and blosum.similar_letters("exact")["W"] == ""
    assert blosum.blosum62_distance("MKVL", "MKVL") == 0 and blosum.blosum62_distance("M-", "-K") != blosum.blosum62_distance("M-", "-K")
    assert blosum.blosum62_distance("WW", "WC") == pytest.approx(1 - 2 * (11 - 2) / (22 + 20))


def test_star_alignment_keeps_every_letter():
    r = random.Random(1)
    for _ in range(30):
        base = protein(r, 40)
        rows = []
        for k in range(5):
            seq = list(base)
            for _ in range(r.randint(0, 5)):
                at = r.randrange(len(seq))
                seq[at : at + r.randint(0, 2)] = list(protein(r, r.randint(0, 3)))
            rows.append((f"r{k}", "".join(seq)))
        done = aligning.star_alignment(rows)
        assert {n: s.replace("-", "") for n, s in done} == dict(rows) and len({len(s) for _, s in done}) == 1
    assert aligning.star_alignment([("a", "MKVL"), ("b", "MVL"), ("c", "MKWVL")]) == [("a", "MK-VL"), ("b", "M--VL"), ("c", "MKWVL")]
    whole = aligning.clusterwise_alignment([("x", "MKV"), ("y", "MKV"), ("z", "MV")], [("ref", "MKV")])
    assert sorted(whole) == [("ref", "MKV"), ("x", "MKV"), ("y", "MKV"), ("z", "M-V")]
    assert aligning.signature_clusters([("a", "MKVLSTARQW"), ("b", "MKVLSTARQA"), ("c", "PPPPPPPPPP")], 3) == [["a", "b"], ["c"]]


def test_alignment_score_against_all_paths():
    """Needleman-Wunsch gives the best score of any alignment of short texts."""
    r = random.Random(2)

    def best(a, b):
        if not a or not b:
            return -2 * (len(a) + len(b))
        return max(best(a[1:], b[1:]) + (2 if a[0] == b[0] else -1), best(a[1:], b) - 2, best(a, b[1:]) - 2)

    for _ in range(40):
        a, b = ("".join(r.choice("ACG") for _ in range(r.randint(0, 6))) for _ in range(2))
        top, bottom = aligning.global_alignment(a, b)
        score = sum(-2 if "-" in (x, y) else 2 if x == y else -1 for x, y in zip(top, bottom))
        assert score == best(a, b) and top.replace("-", "") == a and bottom.replace("-", "") == b


def test_end_trimming():
    ref = "MKVLSTARQWERTYPLKHGFDNCIMKVLSTARQWERTY"
    at = trimming.Columns.of([ref, ref.replace("Q", "E")])
    assert trimming.trimmed(ref, at) == ref
    assert trimming.trimmed("PPP" + ref[3:], at) == "---" + ref[3:] and trimming.trimmed(ref[:-4] + "PGPG", at) == ref[:-4] + "----"
    # A window may hold two letters that differ, the third makes it begin later; a letter that is only similar counts, but not for too many.
    assert trimming.trimmed("MKPLSGARQW" + ref[10:], at).startswith("MK")
    many = "".join(dict(I="V", L="I", K="R", R="K", D="E", Y="F", S="A").get(c, c) for c in ref[:12]) + ref[12:]
    assert trimming.trimmed(many, at, most_similar=1.0, strictness="lax") == many
    assert trimming.trimmed(many, at, most_similar=0.1) != many
    # A stop inside: gaps around it up to the nearest agreement.
    stop = ref[:18] + "*" + ref[19:]
    out = trimming.trimmed(stop, at)
    assert "*" not in out and out[:12] == ref[:12] and out[26:] == ref[26:]
    assert trimming.trimmed("P" * len(ref), at) is None and trimming.trimmed("", at) is None
    poor = trimming.Columns.of([ref, "-" * 5 + ref[5:]], cull=1.0)
    assert trimming.nt_mirrored("MK-L", "-K-L", "ATGAAA---TTG") == "---AAA---TTG" and not any(poor.poor)


def test_frames_against_the_plain_functions(spark):
    r = random.Random(5)
    base = {g: protein(r, 40) for g in ("g1", "g2", "g3")}
    edit = lambda s: "".join(c if r.random() > 0.1 else r.choice(LETTERS + "---") for c in s)
    rows = [(g, f"n{k}", edit(s)) for g, s in base.items() for k in range(6)]
    refs = [(g, f"ref{k}", edit(s)) for g, s in base.items() for k in range(4) if g != "g3"] + [("g9", "ref0", base["g1"])]
    left, right = spark.createDataFrame(rows, ROWS), spark.createDataFrame(refs, ROWS)
    of = lambda rows_, g: [x for x in rows_ if x[0] == g]
    known = lambda g: [s for _, _, s in sorted(of(refs, g))]
    got = {(x["gene"], x["name"]): x["score"] for x in frames.match_scores(left, right).collect()}
    assert got == {(g, n): trimming.average_match(s, known(g)) for g, n, s in rows}
    with_nt = left.withColumn("nt", F.regexp_replace("seq", "(.)", "$1$1$1"))
    for x in frames.end_trimmed(with_nt, right, least=3).collect():
        seq = dict((n, s) for _, n, s in of(rows, x["gene"]))[x["name"]]
        want = trimming.trimmed(seq, known(x["gene"]), least=3)
        assert (x["seq"], x["nt"]) == (want, trimming.nt_mirrored(seq, want, "".join(c * 3 for c in seq)) if want else None)
    stay = {(x["gene"], x["name"]): x["seq"] for x in frames.excised(left, right, 0.5, least=3).collect()}
    for g in base:
        want, gone = trimming.excised([Row(n, s) for _, n, s in of(rows, g)], known(g), 0.5, 6, 3)
        assert {n: s for (h, n), s in stay.items() if h == g} == {w.name: w.seq for w in want} | dict.fromkeys(gone)
    both = {(x["gene"], x["component"], x["names"], x["seq"]) for x in frames.fragments_spliced(left.withColumn("component", F.substring("name", 1, 1)), right).collect()}
    assert both == {(g, "n", n, s) for g in base for n, s in merging.spliced([Row(n, s) for _, n, s in of(rows, g)], known(g))}
    kicked = left.withColumn("kicked", F.col("name").isin("n4", "n5"))
    back = {(x["gene"], x["name"]) for x in frames.recovered(kicked, 0.5, 5).collect()}
    assert back == {(g, n) for g in base for n in assembly.recovered([Row(n, s) for _, n, s in of(rows, g)[:4]], [Row(n, s) for _, n, s in of(rows, g)[4:]], 0.5, 5)}
    assert {x["name"] for x in frames.isoforms(left, right).where("gene = 'g1'").collect()} == {frames.screening.best_isoform([Row(n, s) for _, n, s in of(refs, "g1")], [s for _, _, s in of(rows, "g1")])}


def test_fragments_and_chunks():
    a, b = Row("a", "MKVLST----"), Row("b", "----WTARQW")
    assert merging.spliced([a, b], ["MKVLSTARQW"]) == [("a&&b", "MKVLSTARQW")]
    assert merging.spliced([Row("a", "MKV-------"), Row("b", "---LSTARQW")], []) == [("a&&b", "MKVLSTARQW")]
    assert len(merging.spliced([Row("a", "MKVLST----"), Row("b", "-PPPPP----")], [])) == 2  # more than half in common
    r = random.Random(3)
    whole = "".join(r.choice("ACGT") for _ in range(300))
    hit = lambda n, s, e, strand="+": {"name": f"NODE_{n}", "ids": [n], "strand": strand, "start": s, "end": e, "seq": whole[s:e] if strand == "+" else whole[s:e][::-1].translate(str.maketrans("ACGT", "TGCA"))}
    done = assembly.chunks_merged([hit(1, 0, 90), hit(2, 30, 150), hit(3, 90, 240)])
    assert [(h["start"], h["end"], h["seq"], h["ids"]) for h in done] == [(0, 240, whole[:240], [1, 2, 3])]
    minus = assembly.chunks_merged([hit(1, 0, 90, "-"), hit(2, 30, 150, "-")])
    assert [(h["start"], h["end"], h["seq"]) for h in minus] == [(0, 150, hit(9, 0, 150, "-")["seq"])]
    assert len(assembly.chunks_merged([hit(1, 0, 90), hit(2, 31, 150)])) == 2 and len(assembly.chunks_merged([hit(1, 0, 90), hit(2, 66, 150)])) == 2 and len(assembly.chunks_merged([hit(1, 0, 90), hit(400, 30, 150)])) == 2
    silent = hit(2, 30, 150)
    other = next(c for c, a in CODONS.items() if a == CODONS[silent["seq"][:3]] and c != silent["seq"][:3]) if sum(a == CODONS[silent["seq"][:3]] for a in CODONS.values()) > 1 else silent["seq"][:3]
    assert len(assembly.chunks_merged([hit(1, 0, 90), silent | {"seq": other + silent["seq"][3:]}])) == 1  # equal proteins suffice


def test_reporter_finish_and_references(spark):
    seq = "ATGAAAGTTCTTTCTACTGCTCGTCAATGGGAACGTACTTATCCTCTTAAACATGGT"
    hits = spark.createDataFrame([("g", 1, "t1", 1, 9.0, 1, 57, "+"), ("g", 1, "t1", 2, 5.0, 4, 57, "+"), ("g", 2, "t1", 1, 8.0, 1, 20, "+")], "gene string, header long, target string, frame int, score double, qstart int, qend int, strand string")
    reads = spark.createDataFrame([(1, seq), (2, seq)], "node long, seq string")
    dupes = spark.createDataFrame([(1, 3)], "node long, dupes long")
    targets = spark.createDataFrame([("g", "t1", "Tax")], "gene string, target string, taxon string")
    got = stages.report_genes(hits, reads, dupes, targets, "s").collect()
    assert [(r["name"], r["nt"], r["copies"]) for r in got] == [("g|t1|Tax|NODE_1|1|4", seq, 4)]  # the second hit lies in the first, the third is short
    rows = spark.createDataFrame([("g", "A", "MK*-VL"), ("g", "B", "MK----"), ("h", "A", "MKVVVL")], "gene string, taxon string, seq string")
    out = stages.finish(rows, targets=spark.createDataFrame([("g",)], "gene string"), params=stages.Finish(least_letters=3, coverage=0.5))
    assert sorted(tuple(r) for r in out["rows"].select("gene", "taxon", "seq", "route").collect()) == [("g", "A", "MKX?VL", "target"), ("h", "A", "MKVVVL", "off_target")]
    matrix = {(r["gene"], r["taxon"]): (r["n"], r["stops"], r["kicked"]) for r in out["matrix"].collect()}
    assert matrix["g", "A"] == (1, 1, 0) and matrix["g", "B"] == (0, 0, 1) and matrix[None, None] == (2, 1, 1)
    r = random.Random(8)
    base = protein(r, 60)
    rows = [("g", f"n{k}", f"T{k}", f"c{k}", base[: 60 - k % 3]) for k in range(10)] + [("g", "odd", "T99", "c99", protein(r, 60)), ("g", "short", "T98", "c98", base[:9])]
    built = stages.build_references(spark.createDataFrame(rows, "gene string, name string, taxon string, component string, seq string")).collect()
    assert {x["name"] for x in built} == {f"n{k}" for k in range(10)} and len({len(x["seq"]) for x in built}) == 1


def test_registered_functions(spark):
    assert len(registered.register(spark, "sw_")) == 5
    row = spark.sql("SELECT sw_reverse_complement('AACGN') a, sw_translate_codons('ATGTAA---NN') b, sw_blosum_distance('MK', 'MK') c").first()
    assert tuple(row) == ("NCGTT", "M*-", 0.0)
    assert [tuple(r) for r in spark.sql("SELECT * FROM sw_split_at_n('NNACGTNAC', 3)").collect()] == [(2, "ACGT")]
    assert [r["start"] for r in spark.sql("SELECT * FROM sw_chunks(repeat('A', 1300), 750, 500, 90)").collect()] == [0, 500, 1000]


def test_command_line(spark, tmp_path):
    from strandwork.__main__ import main, run_stage

    (tmp_path / "Gen_sp.fa").write_text(">a x\n" + "ACGTTGCA" * 15 + "\n>b\n" + "ACGTTGCA" * 15 + "\n")
    done = run_stage(spark, "Prepare", {"records": [f"file://{tmp_path}/Gen_sp.fa"]}, {"least": "60"}, f"file://{tmp_path}/out", fasta=True)
    assert sorted(done) == ["coords", "dupes", "flags", "reads"] and spark.read.parquet(done["dupes"]).first()["dupes"] == 1
    spark.createDataFrame([("g", "A", "MKV"), ("g", "B", "MK-")], "gene string, taxon string, seq string").write.parquet(f"file://{tmp_path}/rows")
    made = main(["finish", "--table", f"rows=file://{tmp_path}/rows", "--set", "coverage=90", "--set", "least_letters=1", "--out", f"file://{tmp_path}/done"])
    assert spark.read.parquet(made["rows"]).count() == 1
    with pytest.raises(SystemExit):
        run_stage(spark, "finish", {"nothing": ["x"]}, {}, "y")


def test_profiles_against_all_placements():
    from strandwork.operators.grouped import profiles

    r = random.Random(11)
    for _ in range(20):
        refs = [protein(r, 12) for _ in range(3)]
        odds, seq = profiles.profile(refs), protein(r, 15) + "X" + protein(r, 4)
        best = 0.0
        for i in range(len(seq)):
            for j in range(len(odds)):
                total = 0.0
                for k in range(min(len(seq) - i, len(odds) - j)):
                    total += odds[j + k, blosum.LETTERS.index(seq[i + k])] if seq[i + k] in blosum.LETTERS else -1.0
                    best = max(best, total)
        got = profiles.best_placement(seq, odds)
        assert got[0] == pytest.approx(best) and 0 <= got[1] < got[2] <= len(seq)
    assert profiles.best_placement("MKV", profiles.profile([])) == (0.0, 0, 0)
    assert len(profiles.profile(["MK-L", "M--L"])) == 3 and len(profiles.profile(["MK-L", "M--L"], 0.0)) == 2


def test_search_and_outlier_stages(spark):
    back = {a: c for c, a in CODONS.items()}
    r = random.Random(21)
    base = protein(r, 50)
    nt = "".join(back[a] for a in base)
    other = "".join(r.choice("ACGT") for _ in range(150))
    flip = nt[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = spark.createDataFrame([(1, nt), (5, flip), (7, other), (40, nt), (900, nt)], "node long, seq string")
    refs = spark.createDataFrame([("g", f"r{k}", base) for k in range(4)], ROWS)
    found = {x["node"]: (x["frame"], x["passed"], x["start"], x["end"]) for x in stages.profile_search(spark.createDataFrame([("g", 1), ("g", 7)], "gene string, node long"), reads, refs, margin=40).collect()}
    assert found[1] == (1, True, 0, 50) and found[5] == (-1, True, 0, 50) and found[40][1] and 900 not in found
    assert 7 not in found or not found[7][1]  # below the limit, and only there because others passed near it
    edit = lambda s, share: "".join(c if r.random() > share else r.choice(LETTERS) for c in s)
    refs = [("g", f"ref{k}", edit(base, 0.04)) for k in range(6)]
    rows = [("g", f"n{k}", k, base) for k in range(5)] + [("g", "near", 6, base[:30] + protein(r, 20)), ("g", "far", 5000, protein(r, 50))]
    left, right = spark.createDataFrame(rows, "gene string, name string, node long, seq string"), spark.createDataFrame(refs, ROWS)
    plain = {x["name"]: x["grade"] for x in stages.outliers(left, right).collect()}
    saved = {x["name"]: x["grade"] for x in stages.outliers(left, right, is_genome=True, least_match=0.6).collect()}
    assert plain["near"] == plain["far"] == saved["far"] == "fail" and saved["near"] == "rescued" and saved["n0"] == plain["n0"] == "pass"


def test_top_references_and_paired_kicks(spark):
    base = "MKVLSTARQWERTYPLKHGFDNCI"
    rows = [("g", "a", "A", base), ("g", "b", "B", base[:10] + "WWWWWWWW" + base[10:]), ("g", "c", "C", base), ("g", "d", "D", "P" * 30), ("h", "e", "D", base)]
    refs = spark.createDataFrame(rows, "gene string, name string, taxon string, seq string")
    ranked = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3), ("D", 4)], "taxon string, rank int")
    got = {(x["gene"], x["name"]): x["seq"] for x in stages.top_references(refs, ranked, 3).collect()}
    assert got == {("g", n): base for n in "abc"} | {("h", "e"): base}  # the insertion of one is a run of poor columns
    from strandwork.operators.outliers import consensus_distance_pair

    aa = spark.createDataFrame([("g", "x", "MKVL"), ("g", "y", "MKVL"), ("g", "z", "WWWW")], ROWS)
    nt = spark.createDataFrame([("g", "x", "ATGAAA"), ("g", "y", "TTTTTT"), ("g", "z", "ATGAAA")], ROWS)
    agreed = lambda s: spark.createDataFrame([("g", s)], "gene string, consensus string")
    a, n = consensus_distance_pair(aa, nt, agreed("MKVL"), agreed("ATGAAA"), "gene", 0.5, 0.5)
    assert [x["name"] for x in a.collect()] == ["x"] == [x["name"] for x in n.collect()]


def test_introns_and_stops():
    exon = "ATGAAAGTTCTTTCTACTGCTCGTCAATGGGAACGTACTTATCCT"
    intron = "GTAAGT" + "CCCTTT" * 5 + "TTTCAG"
    gene = exon[:21] + intron + exon[21:]
    assert aligning.introns_removed(gene, exon) == (exon, [(21, 21 + len(intron))])
    assert aligning.introns_removed(exon, exon) == (exon, [])
