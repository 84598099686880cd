"""Findings of round 3 on time, memory and shuffles: what is done side by side or in parts is what one by one gives."""

import random

import pytest

from strandwork.operators.grouped import aligning

ROWS = "gene string, name string, seq string"


def _texts(seed, n, letters="ACGT", least=0, most=60):
    r = random.Random(seed)
    return ["".join(r.choice(letters) for _ in range(r.randint(least, most))) for _ in range(n)]


@pytest.mark.parametrize("costs", [(2, -1, -2), (2, -3, -1)])
def test_alignments_side_by_side(monkeypatch, costs):
    """texts aligned to one other together, in batches of bounded size, are aligned as each by itself, ties included."""
    for seed, letters in enumerate(("ACGT", "AC", "A")):
        texts, other = [*_texts(seed, 40, letters), ""], _texts(seed + 9, 1, letters, 30)[0]
        want = [aligning.global_alignment(t, other, *costs) for t in texts]
        for cells in (1, 5000, 1 << 25):
            monkeypatch.setattr(aligning, "CELLS", cells)
            assert aligning.global_alignments(texts, other, *costs) == want
        assert aligning.global_alignments(texts, "", *costs) == [(t, "-" * len(t)) for t in texts]


def test_introns_without_single_alignments(monkeypatch):
    """no text is aligned by itself."""
    monkeypatch.setattr(aligning, "global_alignment", None)
    exon, intron = "ATGAAACCCGGGAAATTTCCC", "GTAAGTCCCCCCCCCCCCCCCCCCCCCCCCCCAGAG"[:36]
    assert aligning.all_introns_removed([exon, exon[:9] + intron + exon[9:]], exon)[0] == (exon, [])


def test_alignment_in_blocks(spark, monkeypatch):
    """rows of a gene are aligned in many blocks as all of it at once: equal rows, ties of the centre, genes without references, rows or name."""
    from strandwork.operators.grouped import frames

    monkeypatch.setattr(frames, "ALIGNED_ROWS", 4)
    r = random.Random(5)
    rows = [("g", f"n{k}", t) for k, t in enumerate(_texts(1, 30, "MKVL", 1, 12))] + [("h", f"n{k}", t) for k, t in enumerate(_texts(2, 12, "MK", 5, 6))] + [(None, "x", "MKV"), (None, "y", "MV")]
    rows += [(g, f"{n}0", t) for g, n, t in r.sample(rows, 9)]
    refs = [("g", f"r{k}", t) for k, t in enumerate(_texts(3, 9, "MKVL", 8, 10))] + [("i", "r", "MKVL")]
    left, right = spark.createDataFrame(rows, ROWS).repartition(3), spark.createDataFrame(refs, ROWS)
    of = lambda table, gene: [(n, s) for g, n, s in table if g == gene]
    want = sorted((str(g), *x) for g in ("g", "h", None) for x in aligning.clusterwise_alignment(of(rows, g), of(refs, g)))
    assert sorted((str(x["gene"]), x["name"], x["seq"]) for x in frames.aligned(left, right).collect()) == want
    want = sorted((str(g), *x) for g in ("g", "h", None) for x in aligning.star_alignment(of(rows, g)))
    assert sorted((str(x["gene"]), x["name"], x["seq"]) for x in frames.aligned(left).collect()) == want


def test_splice_summaries(spark):
    """number, last start and first end of the pairs, without forming them."""
    from pyspark.sql import functions as F

    from strandwork.operators.grouped import trimming

    texts = [*_texts(4, 60, "GTA", 0, 150), "", "G", "GT" + "C" * 28 + "AG", "GT" + "C" * 26 + "AG"]
    pairs = [trimming.splice_candidates(t) for t in texts]
    want = [(len(p), max(x for x, _ in p), min(y for _, y in p)) if p else None for p in pairs]
    assert [trimming.splice_summary(t) for t in texts] == want
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None])], "k int, seq string")
    got = rows.select(trimming.splice_summaries(F.col("seq")).alias("s"), trimming.splice_pairs(F.col("seq")).alias("p")).collect()
    assert [x["s"] and tuple(x["s"]) for x in got] == [*want, None] and [[tuple(y) for y in x["p"]] for x in got] == [*pairs, []]


def test_seeds_in_blocks(spark, monkeypatch):
    """blocks of reads and targets give what all pairs give; several texts of one read or target count as one."""
    monkeypatch.setattr(aligning, "BLOCK_LETTERS", 200)
    r = random.Random(8)
    reads = [(r.choice([1, 2, 3, None]) if k < 8 else k, k % 2, t) for k, t in enumerate(_texts(6, 40, "MKV", 0, 20))] + [(99, 1, None)]
    targets = [(f"t{k % 20}", t) for k, t in enumerate(_texts(7, 30, "MKV", 0, 20))] + [(None, "MKVMKVMKV"), ("n", None)]
    want = {}
    for node, frame, text in reads:
        for name, other in targets:
            for i in range(len(text or "") - 3):
                if text[i : i + 4] in (other or ""):
                    want.setdefault((node, frame, name), {}).setdefault(text[i : i + 4], []).append(i)
    want = {k: (len(v), min(map(min, v.values())), max(map(max, v.values())) + 4) for k, v in want.items() if len(v) >= 2}
    found = aligning.seeded_hits(spark.createDataFrame(reads, "node long, frame int, aa string"), spark.createDataFrame(targets, "target string, seq string"), 4, 2)
    got = found.collect()
    assert want and len(got) == len(want) and {tuple(x)[:3]: tuple(x)[3:] for x in got} == want and "Exchange" in found._jdf.queryExecution().toString() and "kmer" not in found._jdf.queryExecution().toString()


def test_chunks_of_many_genes(spark):
    """one walk over all genes' hits, without a call a gene; nodes far apart, genes without name and both strands."""
    from strandwork.operators.grouped import assembly, frames

    r = random.Random(2)
    hits = []
    for g in ("a", "b", None, "c"):
        text = _texts(len(hits), 1, "ACGT", 400, 400)[0]
        for node in range(1, 12):
            start = (node * 30 + r.choice([0, 0, 0, 1])) % 300
            hits.append((g, f"n{node}", node if node < 8 else node + 400, r.choice("++-"), start, start + 90, text[start : start + 90]))
    rows = spark.createDataFrame(hits, "gene string, name string, node long, strand string, start long, end long, seq string").repartition(5)
    want = []
    for g in ("a", "b", None, "c"):
        own = [{"name": n, "ids": [k], "strand": s, "start": b, "end": e, "seq": t} for x, n, k, s, b, e, t in hits if x == g]
        want += [(str(g), h["name"], h["ids"], h["strand"], h["start"], h["end"], h["seq"]) for h in assembly.chunks_merged(own)]
    merged = frames.chunks_merged(rows)
    assert sorted((str(x["gene"]), *tuple(x)[1:]) for x in merged.collect()) == sorted(want)
    assert "FlatMapGroupsInPandas" not in merged._jdf.queryExecution().toString()


def test_few_letters_at_once():
    """the votes of what a step counts fit a worker's memory: below 200 MB for any batch."""
    import tracemalloc

    import numpy as np

    from strandwork.operators import tallies

    texts = ["ACDE-" * 200] * (tallies.STEP // 1000)
    tracemalloc.start()
    tallies._counted(texts, np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.ones(len(texts)), 1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 200 << 20


def test_stream_of_small_files(spark, monkeypatch):
    """the files of a stream hold a bounded number of rows, the batches stay as many."""
    from pyspark.sql import functions as F

    from strandwork.plans import exchange_queries

    monkeypatch.setattr(exchange_queries, "FILE_ROWS", 50)
    stream = exchange_queries._in_files(spark.range(1000).repartition(7), "small")
    seen = []
    stream.writeStream.foreachBatch(lambda df, k: seen.append((df.count(), df.select(F.input_file_name()).distinct().count()))).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 3 and sum(n for n, _ in seen) == 1000 and all(files == 7 for _, files in seen)


def test_profiles_and_scores_at_once():
    """references are counted together, and scores without places are those with places."""
    from strandwork.operators import profiling as P

    r = random.Random(3)
    for k in range(6):
        refs = ["".join(r.choice("MKVLAC-X" + "-" * k) for _ in range(r.randint(0, 30))) for _ in range(20)]
        p = P.profile_of(refs, 0.5)
        few, P.STEP_ROWS = P.STEP_ROWS, 3
        q = P.profile_of(refs, 0.5)
        P.STEP_ROWS = few
        assert all((p.steps[s] == q.steps[s]).all() for s in P.STEPS)
        seqs = [*_texts(k, 50, "MKVLAC*", 0, 40), *[x.replace("-", "") for x in refs]]
        assert [max(0, int(x)) for x in P.best_scores(seqs, p)] == [v[0] for v in P.viterbi(seqs, p)]


def test_only_the_best_reading_is_placed(spark):
    """of several readings the best one's row is that of a search of all."""
    from pyspark.sql import functions as F

    from strandwork.operators import profiling as P

    texts = [*_texts(5, 60, "MKVLAC", 0, 30)]
    made = P.profiles(spark.createDataFrame([("g", f"r{k}", t) for k, t in enumerate(_texts(6, 8, "MKVLAC", 20, 25))], ROWS))
    rows = spark.createDataFrame([("g", f"{k // 6}:{k % 6}", t) for k, t in enumerate(texts)], ROWS)
    every = sorted(P.profile_matches(rows, made, float("inf")).collect(), key=lambda x: (-x["score"], x["name"]))
    want = {}
    for x in every:
        want.setdefault(x["name"].split(":")[0], tuple(x))
    some = rows.withColumns({"of": F.substring_index("name", ":", 1), "rank": F.substring_index("name", ":", -1).cast("int")})
    assert want and sorted(map(tuple, P.profile_matches(some, made, float("inf")).collect())) == sorted(want.values())


def test_merged_rows_without_whole_genes(spark):
    """groups, their consensus and codons are those of all rows of a gene at once; ties, gaps at the ends, codons cut short, null samples."""
    from collections import Counter

    from strandwork.operators.grouped import merging
    from strandwork.operators.grouped.columns import Row, consensus

    r = random.Random(11)
    rows = []
    for k in range(60):
        at = r.choice([0, 0, 3, 20, 24, 45])
        aa = "-" * at + "".join(r.choice("MKV-X") for _ in range(r.randint(1, 14))) + "-" * r.randint(0, 3)
        nt = "".join("---" if c == "-" else "".join(r.choice("ACG") for _ in range(3)) for c in aa)
        rows.append((r.choice(["g", "h", None]), r.choice(["a", "b", None]), f"n{k}", r.choice("xy"), r.randint(1, 3), aa, nt[: len(nt) - r.choice([0, 0, 1, 2])]))
    want = []
    for key in {x[:2] for x in rows}:
        own = {x[2]: x for x in rows if x[:2] == key}
        every = [Row(x[2], x[5], x[4]) for x in own.values()]
        for group in merging.overlap_groups([x for x in every if x.end > x.start]):
            names = sorted(x.name for x in group)
            common = Counter(own[n][3] for n in names)
            codons = merging.codon_consensus([Row(x.name, own[x.name][6], x.weight) for x in group], 0.5)
            want.append((*key, "&&".join(names), min(common, key=lambda c: (-common[c], c)), sum(x.weight for x in group), consensus(group, 0.5), codons))
    left = spark.createDataFrame(rows, "gene string, taxa string, name string, ref string, weight int, aa string, nt string").repartition(3)
    made = merging.merged(left, spark.createDataFrame([("g", "MKV")], "gene string, seq string"))
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, want))
    assert "FlatMapCoGroups" not in made._jdf.queryExecution().toString()
