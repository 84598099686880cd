"""C. One sample from sequence records to merged genes: the stages as one chain, each written as tables that the next one reads.

A stage whose tables are there is not run again, so a stopped run goes on where it was; ``start`` names a stage from which on all run anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwork.functions.dna import FRAMES, six_frames
from strandwork.operators import searching
from strandwork.operators.grouped import frames
from strandwork.operators.grouped.trimming import back_translated
from strandwork.plans import stages
from strandwork.sources.catalog import Catalog


@dataclass(frozen=True)
class Auto:
    seeding: searching.Seeding = field(default_factory=searching.Seeding)
    extension: searching.Extension = field(default_factory=searching.Extension)
    prepare: stages.Prepare = field(default_factory=stages.Prepare)
    search: stages.Search = field(default_factory=stages.Search)
    #: Letters that a hit, and a row after trimming, has at least.
    least: int = 30
    least_trimmed: int = 15
    merge_threshold: float = 0.5


def raw_hits(reads: DataFrame, targets: DataFrame, seeding: searching.Seeding, extension: searching.Extension) -> DataFrame:
    """Hits of reads (node, seq) in six frames on targets (target, seq), with places in the read's letters from 1, those of the other strand from high to
    low: header, target, frame, evalue, score, qstart, qend."""
    both = F.arrays_zip(F.array(*map(F.lit, FRAMES)).alias("frame"), six_frames(F.col("seq")).alias("aa"))
    translated = reads.select("node", F.inline(both)).where("aa != ''")
    found = searching.extended_hits(translated, targets.select("target", "seq"), seeding, extension)
    rows = found.join(reads.select("node", F.length("seq").alias("n")), "node")
    shift = F.abs("frame") - 1
    low, high = shift + 3 * F.col("qstart"), shift + 3 * F.col("qend")
    start = F.when(F.col("frame") < 0, F.col("n") - low).otherwise(low + 1)
    end = F.when(F.col("frame") < 0, F.col("n") - high + 1).otherwise(high)
    return rows.select(F.col("node").alias("header"), "target", "frame", "evalue", F.col("score").cast("double").alias("score"), start.cast("int").alias("qstart"), end.cast("int").alias("qend"))


def auto(spark: SparkSession, root: str, records: DataFrame, targets: DataFrame, sample: str, params: Auto = Auto(), start: str | None = None) -> DataFrame:
    """The merged rows of one sample's records (taxa, idx, header, seq) by the references targets (gene, taxon, target, seq).

    Tables under ``root``: those of prepare and search, report, align, pal2nal, flexcull, outlier and merge. Rows are kept by outlier unless their grade
    is fail. Genes without hits have no rows.
    """
    tables, anew = Catalog(spark, root), False

    def stage(name: str, made: list[str], run: Callable[[], dict[str, DataFrame]]) -> None:
        nonlocal anew
        anew = anew or start == name or not all(tables.has(t) for t in made)
        if anew:
            done = run()
            for t in made:
                tables.put(t, done[t])

    if start is not None and start not in STAGES:
        raise ValueError(f"stages are {', '.join(STAGES)}")
    get = tables.get
    known = targets.select("gene", "taxon", "target", F.length("seq").alias("aa_len"))
    named = targets.select("gene", F.concat_ws("|", "gene", "taxon", "target", F.lit(".")).alias("name"), "seq")
    reads = lambda: get("reads").where(F.col("taxa") == sample)
    references = lambda t: get(t).where("name like '%|.'").select("gene", "name", "seq")
    stage("prepare", ["reads", "dupes", "coords", "flags"], lambda: stages.prepare(records.where(F.col("taxa") == sample), params.prepare))
    stage("search", ["raw"], lambda: {"raw": raw_hits(reads(), targets, params.seeding, params.extension)})
    stage("select", ["hits", "top_taxa", "valid_targets"], lambda: stages.search(get("raw"), known, params.search))
    stage("report", ["report"], lambda: {"report": stages.report_genes(get("hits"), reads().select("node", "seq"), get("dupes").where(F.col("taxa") == sample), known, sample, least=params.least)})
    own = lambda: get("report").select("gene", "name", F.col("aa").alias("seq"))
    stage("align", ["align"], lambda: {"align": frames.aligned(own(), named)})
    nt = lambda: get("align").join(get("report").select("gene", "name", F.col("nt").alias("__nt"), "copies"), ["gene", "name"])
    stage("pal2nal", ["pal2nal"], lambda: {"pal2nal": nt().select("gene", "name", "seq", back_translated(F.col("seq"), F.col("__nt")).alias("nt"), "copies")})
    copies = lambda: get("pal2nal").select("gene", "name", "copies")
    trim = lambda: frames.end_trimmed(get("pal2nal").select("gene", "name", "seq", "nt"), references("align"), least=params.least_trimmed).where("seq is not null")
    stage("flexcull", ["flexcull"], lambda: {"flexcull": trim().join(copies(), ["gene", "name"])})
    node = F.regexp_extract("name", "NODE_([0-9]+)", 1).cast("long")
    grade = lambda: stages.outliers(get("flexcull").select("gene", "name", node.alias("node"), "seq"), references("align"))
    stage("outlier", ["outlier"], lambda: {"outlier": get("flexcull").join(grade().where("grade != 'fail'").select("gene", "name"), ["gene", "name"], "left_semi")})
    rows = lambda: get("outlier").select("gene", F.lit(sample).alias("taxa"), "name", F.get(F.split("name", r"\|"), F.lit(2)).alias("ref"), F.col("copies").cast("int").alias("weight"), F.col("seq").alias("aa"), "nt")
    stage("merge", ["merge"], lambda: {"merge": stages.merge(rows(), references("align").select("gene", "seq"), "consensus", params.merge_threshold)})
    return get("merge")


STAGES = ("prepare", "search", "select", "report", "align", "pal2nal", "flexcull", "outlier", "merge")
