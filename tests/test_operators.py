"""Operators, functions and sources on small tables."""

import gzip
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandwork.functions import dna, headers, intervals, msa
from strandwork.operators import columns, combining, hits, islands, outliers, reads, selecting
from strandwork.plans import stages
from strandwork.sources import fasta, tables
from strandwork.streaming import windows


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


def test_dna_functions(spark):
    f = lambda c, **v: one(spark, c, **v)
    assert f(dna.reverse_complement(F.col("s")), s="AACGN") == "NCGTT"
    assert f(dna.translated(F.col("s")), s="ATGTAA---NNNAC") == "M*-X" and f(dna.translated(F.col("s")), s="AT") == ""
    assert f(dna.framed(F.col("s"), F.lit(-2)), s="AACG") == "GTT"
    assert [f(dna.iupac(F.array(*map(F.lit, x)))) for x in ("AG", "A-", "ACGT", "AX")] == ["R", "A", "N", "N"]
    assert f(dna.stops_masked(F.col("s")), s="ATGTAGCC") == "ATGNNNCC"
    assert f(dna.codon_positions(F.col("s"), (1, 3)), s="ABCDEFG") == "ACDFG"
    assert f(dna.entropy(F.col("s")), s="ACGT") == 1.0 and f(dna.entropy(F.col("s")), s="AAAA") == 0.0 and f(dna.entropy(F.col("s")), s="NN") is None
    assert f(dna.homopolymer_trimmed(F.col("s")), s="A" * 10 + "CCGT" + "TG" * 5) == "ACCGTT"
    assert f(dna.homopolymer_trimmed(F.col("s")), s="AAAACCGT") == "AAAACCGT"


def test_text_functions(spark):
    f = lambda c, **v: one(spark, c, **v)
    assert f(msa.inner_gaps(F.col("s")), s="--A-B-") == "--A?B-" and f(msa.inner_gaps(F.col("s")), s="---") == "---"
    assert (f(msa.data_start(F.col("s")), s="--AB-"), f(msa.data_end(F.col("s")), s="--AB-")) == (2, 4)
    assert f(msa.masked(F.col("s"), F.array(F.lit(1))), s="ABC") == "A-C"
    assert f(headers.nodes(F.lit("NODE_3&&NODE_12"))) == [3, 12] and f(headers.field(F.lit("a|b"), 2)) is None
    assert [f(headers.short_name(F.lit(x))) for x in ("a b|c", "a b", "a")] == ["a b", "a", "a"]
    assert [f(headers.sample_name(F.lit(x))) for x in ("/d/Gen_sp_R1_001.fastq.gz", "Gen_sp_part2.fa", "Gen_sp_1.fq", "Gen.fasta")] == ["Gen_sp", "Gen_sp", "Gen_sp", "Gen"]
    assert f(headers.json_field(F.lit("id {'a': 'x'}"), "a")) == "x"
    assert f(intervals.set_distance(F.array(F.lit(1), F.lit(9)), F.array(F.lit(12)))) == 3


def test_top_fraction(spark):
    r = random.Random(3)
    rows = [(k, float(r.choice([1, 2, 3, r.random() * 9]))) for k in range(3000)] + [(9999, None)]
    df = spark.createDataFrame(rows, "k long, score double")
    wanted = sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    for left in (10, 100_000):
        selecting.LEFT = left
        for share in (0.0, 0.1, 0.25, 1.0):
            got = {x["k"] for x in selecting.top_fraction(df, "score", ["k"], share).collect()}
            assert got == {k for k, _ in wanted[: int(share * len(rows))]}
    selecting.LEFT = 100_000
    assert selecting.top_fraction(df.limit(0), "score", ["k"], 0.5).count() == 0


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 60), st.integers(1, 20)), min_size=1, max_size=12))
@settings(max_examples=5, deadline=None)
def test_internal_filter_against_a_loop(spark, rows):
    df = spark.createDataFrame([(1, k, float(s), a, a + n) for k, (s, a, n) in enumerate(rows)], "header long, line int, score double, qstart int, qend int")
    kept = []
    for k, (_, a, n) in enumerate(rows):
        if not any(min(a + n, b + m) > max(a, b) and (min(a + n, b + m) - max(a, b)) / (max(a + n, b + m) - min(a, b)) >= 0.3 for b, m in (rows[j][1:] for j in kept)):
            kept.append(k)
    assert sorted(r["line"] for r in hits.internal_filter(df, ["header"], ["line"]).collect()) == kept


def test_reads(spark):
    rows = spark.createDataFrame([(1, "AACC"), (2, "GGTT"), (3, "AACC"), (4, "ACGT"), (5, "NNACNGTTN"), (6, "")], "id long, seq string")
    assert {(r["id"], r["dupes"]) for r in reads.strand_dedupe(rows.where("id < 5"), "id").collect()} == {(1, 2), (4, 0)}
    assert sorted((r["id"], r["offset"], r["seq"]) for r in reads.split_at_n(rows.where("id > 4"), 2).collect()) == [(5, 2, "AC"), (5, 5, "GTT")]
    long = spark.createDataFrame([(1, "A" * 1200)], "id long, seq string")
    assert [(r["start"], r["end"], r["last"], len(r["seq"])) for r in reads.chunked(long).orderBy("start").collect()] == [(0, 749, 749, 750), (500, 1249, 699, 700), (1000, 1749, 199, 200)]


def test_islands_and_columns(spark):
    df = spark.createDataFrame([("g", 1), ("g", 5), ("g", 41), ("g", 42)], "g string, n int")
    assert [r["cluster"] for r in islands.id_clusters(df, ["g"], "n", 35).orderBy("n").collect()] == [1, 1, 2, 2]
    df = spark.createDataFrame([("g", 0, 5), ("g", 5, 9), ("g", 10, 12)], "g string, s int, e int")
    assert [r["group"] for r in islands.interval_union(df, ["g"], "s", "e").orderBy("s").collect()] == [1, 1, 2]
    rows = spark.createDataFrame([("g", "A-C-"), ("g", "A-G-"), ("h", "----"), ("h", "--T-")], "g string, seq string")
    assert sorted(r["seq"] for r in columns.without_empty_columns(rows, "g").collect()) == ["-", "AC", "AG", "T"]
    assert {r["g"]: r["consensus"] for r in columns.consensus(rows, "g", 0.5).collect()} == {"g": "A-X", "h": "--T"}


def test_outliers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4, 100)] + [("g", None), ("g", math.nan)], "g string, v double")
    assert sorted(r["v"] for r in outliers.midpoint_bound(df, "g", "v").where("outlier").collect() if not math.isnan(r["v"])) == [100.0]
    rows = spark.createDataFrame([("g", n, s) for n, s in (("a", "MKVLSTAR"), ("b", "MKVLSTAR"), ("c", "MKVLSTAQ"), ("d", "MKVISTAR"), ("e", "WWWWWWWW"))], "g string, name string, seq string")
    assert sorted(r["name"] for r in outliers.reference_cull(rows, "g").collect()) == ["a", "b", "c", "d"]
    agreed = spark.createDataFrame([("g", "MKVLSTXR")], "g string, consensus string")
    assert sorted(r["name"] for r in outliers.consensus_distance_kick(rows, agreed, "g", 0.2).collect()) == ["a", "b", "c", "d"]


def test_combining(spark):
    rows = spark.createDataFrame([("g1", "A", "MK"), ("g1", "b", "MKV"), ("g2", "A", "LL")], "gene string, taxon string, seq string")
    assert {r["taxon"]: r["seq"] for r in combining.concatenated(rows).collect()} == {"A": "MK-LL", "b": "MKV--"}
    assert [(r["gene"], r["first"], r["last"]) for r in combining.charsets(rows).orderBy("gene").collect()] == [("g1", 1, 3), ("g2", 4, 5)]
    assert {r["gene"] for r in combining.kick_genes(rows, 0.5).collect()} == {"g1"}
    names = spark.createDataFrame([("a",), ("zz",)], "name string")
    assert {r["taxon"] for r in combining.kick_names(rows, names, "taxon").collect()} == {"b"}
    out = stages.finish(rows, params=stages.Finish(least_letters=2))
    assert out["presence"].count() == 2 and out["matrix"].where("gene is null and taxon is null").first()["n"] == 3


def test_files(spark, tmp_path):
    (tmp_path / "G_sp_R1.fa").write_text(">a x\nACGT\nAC\n>b\nGG\n")
    with gzip.open(tmp_path / "G_sp_R2.fq.gz", "wt") as f:
        f.write("@r1\nACGT\n+\n!!!!\n@r2\nGG\n+\n!!\n")
    got = fasta.samples(fasta.read_fasta(spark, f"file://{tmp_path}/G_sp_R1.fa")).orderBy("idx").collect()
    assert [(r["sample"], r["header"], r["seq"]) for r in got] == [("G_sp", "a x", "ACGTAC"), ("G_sp", "b", "GG")]
    assert [(r["header"], r["seq"]) for r in fasta.read_fastq(spark, f"file://{tmp_path}/G_sp_R2.fq.gz").orderBy("idx").collect()] == [("r1", "ACGT"), ("r2", "GG")]
    rows = spark.createDataFrame([("g", "h1", "AC"), ("g", "h2", "GT")], "gene string, header string, seq string")
    fasta.write_fasta(rows, f"file://{tmp_path}/out", ["gene"], compress=True)
    assert sorted((r["header"], r["seq"]) for r in fasta.read_fasta(spark, f"file://{tmp_path}/out/gene=g/*").collect()) == [("h1", "AC"), ("h2", "GT")]
    (tmp_path / "hits.tsv").write_text("7\tt\t-1\t1e-9\t50.5\t1\t30\t5\t9\t0.5\n")
    hit = tables.read_hits(spark, f"file://{tmp_path}/hits.tsv").first()
    assert (hit["header"], hit["frame"], hit["coverage"]) == (7, -1, 0.5)
    (tmp_path / "none.tsv").write_text("nothing\n")
    assert tables.read_hits(spark, f"file://{tmp_path}/none.tsv").count() == 0
    feature = spark.createDataFrame([("p", "s", "exon", 5, 9, ".", "+", "0", "ID=x;Name=y"), ("p", "s", "exon", 1, 3, ".", "+", "0", "ID=w")], "parent string, source string, type string, start long, end long, score string, strand string, phase string, attributes string")
    tables.write_gff(feature, spark.createDataFrame([("p", 99)], "parent string, length long"), f"file://{tmp_path}/gff")
    back = tables.read_gff(spark, f"file://{tmp_path}/gff").orderBy("start").collect()
    assert [(r["start"], r["attribute"]["ID"]) for r in back] == [(1, "w"), (5, "x")]
    ref = spark.createDataFrame([("f/G7.fa", 1, "G1|Tax|T1", "MK"), ("f/G7.fa", 2, "T2 {'pub_og_id': 'G2', 'organism_name': 'Org'}", "ML"), ("f/G7.fa", 3, "free text", "MM"), ("f/G7.fa", 4, "G1|Tax|T1", "MN")], "file string, idx int, header string, seq string")
    assert [tuple(r)[:3] for r in tables.references(ref).orderBy("seq").collect()] == [("G1", "Tax", "T1"), ("G2", "Org", "T2"), ("G7", "free", "free text"), ("G1", "Tax", "T1_1")]


def test_stages(spark):
    r = random.Random(5)
    seq = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    a, genome = seq(300), seq(60_000)
    flip = a[::-1].translate(str.maketrans("ACGT", "TGCA"))
    records = spark.createDataFrame([("s", 1, "r1 x", a), ("s", 2, "r2", flip), ("s", 3, "r3", seq(100) + "NN" + seq(95)), ("s", 4, "low", "A" * 200), ("g", 1, "chr1", genome)], "taxa string, idx int, header string, seq string")
    out = stages.prepare(records)
    assert [(r["node"], r["dupes"]) for r in out["dupes"].collect()] == [(1, 1)]
    assert out["reads"].where("taxa = 's'").count() == 3 and out["reads"].where("taxa = 'g'").count() == 120
    assert out["coords"].where("node = 2").first()["chunk_start"] == 500
    targets = spark.createDataFrame([("g1", "T", "t1", 90), ("g1", "U", "t2", 90), ("g2", "T", "t3", 90)], "gene string, taxon string, target string, aa_len int")
    raw = spark.createDataFrame([(1, "t1", 1, 1e-9, 100.0, 1, 90), (1, "t2", 1, 1e-9, 95.0, 2, 90), (1, "t3", 1, 1e-9, 92.0, 30, 120), (2, "t1", 1, 1e-3, 99.0, 1, 90)], "header long, target string, frame int, evalue double, score double, qstart int, qend int")
    found = stages.search(raw, targets, stages.Search(top_share=1.0))
    assert [(r["header"], r["target"]) for r in found["hits"].collect()] == [(1, "t1"), (1, "t3")]
    rows = stages.report(found["hits"], out["reads"].where("taxa = 's'"), out["dupes"])
    first = rows.where("gene = 'g1'").first()
    assert first["nt"] == a[:90] and first["dupes"] == 1 and len(first["aa"]) == 30


def test_streaming(spark, tmp_path):
    rows = spark.createDataFrame([(f"2024-01-01 00:{m:02d}:00", "u") for m in (0, 1, 2, 20, 21, 59)], "t string, u string").select(F.to_timestamp("t").alias("t"), "u")
    rows.write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/in")
    windows.run_into(windows.sessions(stream, "t", "u"), "sessions_out")
    assert sorted(r["n"] for r in spark.table("sessions_out").collect())[:2] == [2, 3]
    windows.run_into(windows.windowed_counts(stream, "t", "u", "30 minutes"), "windows_out", "complete")
    assert sorted(r["n"] for r in spark.table("windows_out").collect()) == [1, 5]


def test_distances_and_greedy_groups(spark):
    r = random.Random(4)
    seqs = ["".join(r.choice("ACG-X") for _ in range(r.randint(0, 30))) for _ in range(12)]
    got = outliers.all_distances(seqs)
    for i, a in enumerate(seqs):
        for j, b in enumerate(seqs):
            want = outliers.gap_free_distance(a, b)
            assert got[i, j] == want or (math.isnan(got[i, j]) and math.isnan(want))
    rows = [(r.choice(["a", "b", None]), k, r.randrange(60), "x" * k) for k in range(120)]
    df = spark.createDataFrame([(g, k, s, s + 9, x) for g, k, s, x in rows], "gene string, k int, qstart int, qend int, other string")
    kept = {}
    for g, k, s, _ in rows:
        if all(not (min(s, t) + 9 > max(s, t) and (min(s, t) + 9 - max(s, t)) / (max(s, t) + 9 - min(s, t)) >= 0.3) for t in kept.get(g, {}).values()):
            kept.setdefault(g, {})[k] = s
    assert {(x["gene"], x["k"]) for x in hits.internal_filter(df, ["gene"], ["k"]).collect()} == {(g, k) for g, v in kept.items() for k in v}


def test_flagged_places(spark):
    rows = spark.createDataFrame([("ACGTAC", [4, 1, 1, -2, 9]), ("AC", []), ("ÀÉX", [2]), ("", [0]), ("AC", None), (None, [1])], "seq string, places array<bigint>")
    seq, places = F.col("seq"), F.col("places")
    got = rows.select(msa.masked(seq, places).alias("m"), msa.marked_consensus(seq, places).alias("c"), msa.masked_codons(seq, places).alias("k"), msa.selected_codons(seq, F.lit([1, 0])).alias("s")).collect()
    assert [r["m"] for r in got] == ["A-GT-C", "AC", "ÀÉ-", "", "AC", None]
    assert [r["c"] for r in got] == ["?C??A?", "??", "??X", "", "??", None]
    assert [r["k"] for r in got] == ["ACG---", "AC", "ÀÉX", "", "AC", None]
    assert [r["s"] for r in got] == ["TACACG", "AC", "ÀÉX", "", "AC", None]
    assert rows.select(msa.inner_gap_places(F.lit("--A-B--C-"))).first()[0] == [3, 5, 6]


def test_flagged_places_of_long_text(spark):
    n = 60_000
    got = spark.range(1).select(F.repeat(F.lit("A"), F.lit(n)).alias("s"), F.sequence(F.lit(0), F.lit(n - 1), F.lit(2)).alias("p")).select(msa.masked(F.col("s"), F.col("p"))).first()[0]
    assert got == "-A" * (n // 2)
