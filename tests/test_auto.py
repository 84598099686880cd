"""The whole chain on a small made-up sample, and its resuming."""

import random
from pathlib import Path

import pytest

from strandwork.functions.blosum import LETTERS
from strandwork.functions.dna import CODONS
from strandwork.plans import auto as A


def flip(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_chain_and_resume(spark, tmp_path, monkeypatch):
    r = random.Random(3)
    codon = {}
    for c, a in CODONS.items():
        codon.setdefault(a, []).append(c)
    proteins = {f"g{k}": "".join(r.choice(LETTERS) for _ in range(90)) for k in range(3)}
    vary = lambda s, share: "".join(c if r.random() > share else r.choice(LETTERS) for c in s)
    targets = [(g, f"T{k}", f"{g}t{k}", vary(p, 0.04)) for g, p in proteins.items() for k in range(3)]
    genes = {g: "".join(r.choice(codon[a]) for a in p) for g, p in proteins.items()}
    reads = []
    for g, s in genes.items():
        for k in range(0, len(s) - 149, 30):
            reads.append((f"{g}_{k}", s[k : k + 150] if k % 60 else flip(s[k : k + 150])))
    reads += [("again", reads[0][1]), ("noise", "".join(r.choice("ACGT") for _ in range(150)))]
    records = spark.createDataFrame([("smp", k, n, s) for k, (n, s) in enumerate(reads)] + [("other", 0, "x", genes["g0"])], "taxa string, idx long, header string, seq string")
    known = spark.createDataFrame(targets, "gene string, taxon string, target string, seq string")
    root = f"file://{tmp_path}/run"
    params = A.Auto(search=A.stages.Search(top_share=1.0))
    got = {x["gene"]: x for x in A.auto(spark, root, records, known, "smp", params).collect()}
    assert set(got) == set(genes)
    for g, p in proteins.items():
        aa, nt = got[g]["aa"].replace("-", ""), got[g]["nt"].replace("-", "")
        assert len(aa) >= 80 and aa in p and nt in genes[g] and len(nt) == 3 * len(aa)
    assert got["g0"]["total"] == sum(x[0].startswith("g0") for x in reads) + 1
    ran = []
    for name in ("prepare", "search", "report_genes", "outliers", "merge"):
        real = getattr(A.stages, name)
        monkeypatch.setattr(A.stages, name, lambda *a, real=real, name=name, **k: ran.append(name) or real(*a, **k))
    assert A.auto(spark, root, records, known, "smp", params).count() == 3 and ran == []
    (tmp_path / "run/outlier").rename(tmp_path / "gone")
    assert A.auto(spark, root, records, known, "smp", params).count() == 3 and ran == ["outliers", "merge"]
    assert A.auto(spark, root, records, known, "smp", params, start="merge").count() == 3 and ran[2:] == ["merge"]
    assert Path(tmp_path / "run/align").is_dir()
    with pytest.raises(ValueError, match="stages are"):
        A.auto(spark, root, records, known, "smp", params, start="nothing")


def test_command_line_has_every_stage(spark, tmp_path):
    from strandwork.__main__ import STAGES, run_stage

    at = lambda name: f"file://{tmp_path}/{name}"
    aligned = [("g", "a", "MK-V"), ("g", "b", "MKLV"), ("h", "c", "M")]
    spark.createDataFrame(aligned, "gene string, name string, seq string").write.parquet(at("rows"))
    spark.createDataFrame([("g", "a", "ATGAAAGTG"), ("g", "b", "ATGAAACTGGTG")], "gene string, name string, nt string").write.parquet(at("nt"))
    done = run_stage(spark, "pal2nal", {"rows": [at("rows")], "nt": [at("nt")]}, {}, at("out"))
    assert sorted(x["nt"] for x in spark.read.parquet(done["pal2nal"]).collect()) == ["ATGAAA---GTG", "ATGAAACTGGTG"]
    done = run_stage(spark, "align", {"rows": [at("rows")]}, {}, at("out2"))
    assert spark.read.parquet(done["align"]).count() == 3
    done = run_stage(spark, "internal", {"rows": [at("rows")]}, {"threshold": "0.2"}, at("out3"))
    assert spark.read.parquet(done["internal"]).count() == 3
    spark.createDataFrame([("A1", None)], "id string, order string").write.parquet(at("some"))
    spark.createDataFrame([("A1", "Odonata")], "id string, order string").write.parquet(at("known"))
    done = run_stage(spark, "Taxonomy_Filler", {"rows": [at("some")], "known": [at("known")]}, {"key": "id"}, at("out4"))
    assert spark.read.parquet(done["taxonomy_filler"]).first()["order"] == "Odonata"
    assert {"auto", "flexcull", "motif", "isoform", "excise"} <= set(STAGES)
