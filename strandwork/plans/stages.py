"""Stages of the whole run as functions from tables to tables; parameters have the usual defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.functions.dna import FRAMES, entropy, framed, homopolymer_trimmed, reverse_complement, six_frames, stop_to_x, translated_long
from strandwork.functions.headers import merge_header, short_name, tagged
from strandwork.functions.intervals import chunk_coordinates, swapped
from strandwork.functions.msa import at, data_length, flags, inner_gaps, letters
from strandwork.operators import columns, combining, hits as H, islands, pairs, profiling, reads as R
from strandwork.operators.grouped import frames
from strandwork.operators.grouped.assembly import deduped_hits
from strandwork.operators.grouped.clusters import clustered
from strandwork.operators.grouped.frames import chunks_merged
from strandwork.operators.grouped.trimming import back_translated
from strandwork.operators.outliers import consensus_distance_kick
from strandwork.operators.selecting import best_rows
from strandwork.operators.grouped.merging import merged
from strandwork.scratch import written


@dataclass(frozen=True)
class Prepare:
    least: int = 90
    low_complexity: float = 0.7
    chunk: int = 750
    overlap: int = 250


@dataclass(frozen=True)
class Search:
    evalue_power: int = 6
    top_taxa: int = 10
    top_share: float = 0.25
    pooled: float = 0.9
    multi_share: float = 0.3
    multi_ratio: float = 1.1
    internal: float = 0.3
    cluster_gap: int = 35


@dataclass(frozen=True)
class Finish:
    coverage: float = 0.0
    gene_share: float = 0.0
    column_share: float = 0.0
    least_letters: int = 30
    gap: str = "-"
    inner_gap: str = "?"


@dataclass(frozen=True)
class References:
    adjacency: int = 3
    most_overlap: float = 0.5
    median_share: float = 0.5
    edge_share: float = 0.5
    column_share: float = 0.0
    gene_share: float = 0.0


def prepare(records: DataFrame, params: Prepare = Prepare()) -> dict[str, DataFrame]:
    """Reads of samples (taxa, idx, header, seq), ready for searching.

    flags: taxa, longest, is_assembly, is_genome. reads: taxa, node, seq: parts between runs of N, long enough, of enough
    entropy, each strand-insensitive sequence once; of genomes overlapping chunks instead, none removed. dupes: further copies of a
    node. coords: where a genome's chunk lies. Nodes count from 1 in the order of the records within each sample.
    """
    rows = records.select("taxa", "idx", short_name(F.col("header")).alias("parent"), F.upper("seq").alias("seq"))
    flags = R.dataset_flags(rows, "taxa")
    kind = rows.join(flags.select("taxa", "is_genome"), "taxa")
    parts = R.split_at_n(R.long_enough(kind.where(~F.col("is_genome")), params.least), params.least).where(entropy(F.col("seq")) >= params.low_complexity)
    order = F.struct("idx", "offset")
    once = R.strand_dedupe(parts.withColumn("order", order), "order", ["taxa"]).select("taxa", "idx", "order", "seq", "dupes")
    number = lambda df: R.numbered_in_ranges(df, "taxa", "idx", ["order"], "node")
    plain = number(once)
    whole = kind.where("is_genome").withColumn("parent_len", F.length("seq"))
    cut = number(R.chunked(whole, params.chunk, params.chunk - params.overlap, params.least).withColumn("order", F.struct("idx", "start")))
    return {
        "flags": flags,
        "reads": plain.select("taxa", "node", "seq").unionByName(cut.select("taxa", "node", "seq")),
        "dupes": plain.where("dupes > 0").select("taxa", "node", "dupes"),
        "coords": cut.select("taxa", "node", "parent", F.col("start").alias("chunk_start"), F.col("end").alias("chunk_end"), "parent_len", F.col("last").alias("chunk_last")),
    }


def search(raw: DataFrame, targets: DataFrame, params: Search = Search(), gene_refs: DataFrame | None = None) -> dict[str, DataFrame]:
    """From raw hits (header, target, frame, evalue, score, qstart, qend) and targets (gene, taxon, target, aa_len).

    top_taxa, valid_targets, and hits: rows of good e-value and top taxa that stay after pooling, the multi-gene filter, one row a
    gene and signed frame, and the internal filter of each (gene, read); with ``cluster`` of neighbouring reads of a gene. Hits without
    target count in the top share of rows, and nowhere else. ``gene_refs`` (gene, taxon), if given, are the references of each gene that count.

    Hits with their targets and the rows that stay are written once each, as several steps read them; between, rows are dealt by read once.
    """
    rows = written(raw.join(targets, "target", "left"), "search-rows")
    order = ["header", "target", "qstart", "frame"]
    top = H.top_taxa(H.count_taxa(rows, order, share=params.top_share), params.top_taxa)
    good = H.evalue_filter(rows, params.evalue_power).join(top.select("taxon"), "taxon", "left_semi")
    if gene_refs is not None:
        good = good.join(gene_refs.select("gene", "taxon").distinct(), ["gene", "taxon"], "left_semi")
    pooled = H.pooled_filter(good.repartition("header"), params.pooled).drop("pooled").withColumn("strand", F.when(F.col("frame") < 0, "-").otherwise("+"))
    single = H.best_per_group(H.multi_gene_filter(pooled, [F.col(c) for c in order], params.multi_share, params.multi_ratio), [F.col(c) for c in order])
    s, e = swapped(F.col("frame"), F.col("qstart"), F.col("qend"))
    single = single.withColumns({"qstart": s, "qend": e})  # coordinates are in ascending order from here on; the frame keeps its sign
    kept = H.internal_filter(single.withColumn("__neg", -F.col("score")), ["gene", "header"], ["__neg", *order], params.internal, ["header"]).drop("__neg")
    kept = written(kept, "search-kept")
    return {"top_taxa": top, "valid_targets": H.valid_targets(kept, targets), "hits": islands.id_clusters_in_ranges(kept, ["gene"], "header", params.cluster_gap, ["target", "qstart", "frame"])}


def report(hits: DataFrame, reads: DataFrame, dupes: DataFrame, coords: DataFrame | None = None, least: int = 30) -> DataFrame:
    """gene, node, frame, nt, aa, dupes of hits with their reads: the matched part on its strand, translated, at least ``least``
    letters long; with ``coords`` also parent, parent_start and parent_end."""
    part = F.substring(F.col("seq"), F.col("qstart"), F.col("qend") - F.col("qstart") + 1)
    rows = hits.withColumn("node", F.col("header")).join(reads, "node").withColumn("nt", F.when(F.col("strand") == "-", reverse_complement(part)).otherwise(part))
    rows = rows.where(F.length("nt") >= least).withColumn("aa", translated_long(framed(F.col("nt"), F.lit(1)))).join(dupes.select("node", "dupes"), "node", "left")
    own = ["gene", "node", "frame", "strand", "score", "qstart", "qend", "nt", "aa", F.coalesce("dupes", F.lit(0)).alias("dupes")]
    if coords is None:
        return rows.select(*own)
    s, e = chunk_coordinates(F.col("strand"), F.col("qstart"), F.col("qend"), F.col("chunk_start"), F.col("chunk_last"))
    return rows.join(coords.drop("taxa"), "node", "left").select(*own, "parent", s.alias("parent_start"), e.alias("parent_end"))


def report_genes(hits: DataFrame, reads: DataFrame, dupes: DataFrame, targets: DataFrame, sample: str, coords: DataFrame | None = None, least: int = 30, repeats: int = 9, overlap: int = 30) -> DataFrame:
    """G7. The rows of all genes as they are written: matched parts (report()), runs of repeats cut from their ends (W15), long enough
    (F10), copies and contained parts of a read removed (A3), chunks of a genome merged (G5, with ``coords``), and named
    gene|target|taxon|NODE_n|frame|copies (A10).

    gene, name, nt, aa and copies; of genomes also parent, parent_start and parent_end.
    """
    rows = report(hits, reads, dupes, coords, least).withColumn("nt", homopolymer_trimmed(F.col("nt"), repeats)).where(F.length("nt") >= least)
    rows = rows.withColumn("aa", translated_long(framed(F.col("nt"), F.lit(1))))
    target = hits.select("gene", F.col("header").alias("node"), "frame", "target").groupBy("gene", "node", "frame").agg(F.min("target").alias("target"))
    rows = deduped_hits(rows, "gene", "node", ["qstart", "frame"]).join(target, ["gene", "node", "frame"]).join(targets.select("gene", "target", "taxon").distinct(), ["gene", "target"])
    node = F.concat(F.lit("NODE_"), F.col("node").cast("string"), "suffix")
    if coords is not None:
        parts = rows.select("gene", node.alias("name"), "node", "strand", F.col("parent_start").alias("start"), F.col("parent_end").alias("end"), F.col("nt").alias("seq"), "parent", "target", "taxon", "frame", "dupes")
        keyed = parts.withColumn("gene", F.concat_ws("\x1f", "gene", "parent"))
        merged_ = chunks_merged(keyed, overlap=overlap).withColumn("parent", F.substring_index("gene", "\x1f", -1)).withColumn("gene", F.substring_index("gene", "\x1f", 1))
        own = parts.select("gene", "parent", "name", "target", "taxon", "frame")
        copies = parts.groupBy("gene", "parent", F.col("node").alias("id")).agg(F.max("dupes").alias("dupes"))
        counted = merged_.select("gene", "parent", "name", F.explode("ids").alias("id")).join(copies, ["gene", "parent", "id"]).groupBy("gene", "parent", "name").agg(F.sum("dupes").alias("dupes"))
        rows = merged_.join(own, ["gene", "parent", "name"]).join(counted, ["gene", "parent", "name"]).withColumn("nt", F.col("seq")).withColumn("aa", translated_long(framed(F.col("nt"), F.lit(1))))
        label = merge_header(F.transform("ids", lambda i: i.cast("string")))
        more = ["parent", F.col("start").alias("parent_start"), F.col("end").alias("parent_end")]
    else:
        label, more = node, []
    header = tagged(F.concat_ws("|", "gene", "target", "taxon", label, F.col("frame").cast("string")), F.col("dupes"))
    return rows.select("gene", header.alias("name"), "nt", "aa", (F.col("dupes") + 1).alias("copies"), *more).withColumn("sample", F.lit(sample))


def top_references(references: DataFrame, ranked: DataFrame, k: int = 10, least_share: float = 0.5, least_run: int = 5) -> DataFrame:
    """G3. Of each gene the references (gene, name, taxon, seq without gaps) of its first k taxa in rank order (O2, ``ranked``: taxon, rank), aligned
    by themselves, without runs of at least ``least_run`` columns that fewer than ``least_share`` of them fill (A16)."""
    top = H.top_taxa_by_gene(references, ranked, k)
    rows = frames.aligned(references.join(top.select("gene", "taxon"), ["gene", "taxon"], "left_semi").select("gene", "name", "seq"))
    poor = islands.runs(columns.occupancy(rows, "gene").where(F.col("share") < least_share), ["gene"], "place", least_run)
    cut = poor.groupBy("gene").agg(F.flatten(F.collect_list(F.sequence("first", "last"))).alias("__cut"))
    cut = cut.select("gene", flags(F.col("__cut")).alias("__cut"))
    kept = F.array_join(F.filter(letters(F.col("seq")), lambda c, i: ~at(F.col("__cut"), i)), "")
    return rows.join(cut, "gene", "left").withColumn("seq", F.when(F.col("__cut").isNull(), F.col("seq")).otherwise(kept)).drop("__cut")


def build_references(rows: DataFrame, params: References = References()) -> DataFrame:
    """G24. The reference alignment of every gene from rows (gene, name, taxon, component, seq without gaps): aligned (G8), one row
    for a component and text (A4), fragments of a component spliced (G23), rows short against the median (F21), edges (A17) and poor
    columns (A18) cut, rows far from the consensus (A29) and from the others (A28) removed, genes of too few taxa dropped (A31)."""
    aligned_ = frames.aligned(rows.select("gene", "name", "seq"))
    known = rows.select("gene", "name", "taxon", "component")
    once = pairs.component_distinct(aligned_.join(known, ["gene", "name"]), F.concat_ws("\x1f", "gene", "component"))
    spliced = frames.fragments_spliced(once.select("gene", "component", "name", "seq"), aligned_, params.adjacency, params.most_overlap)
    named = spliced.select("gene", F.col("names").alias("name"), "seq", F.substring_index("names", "&&", 1).alias("__first"))
    long = pairs.against_median(named, "gene", params.median_share)
    cut = columns.edges(columns.occupancy(long, "gene"), "gene", params.edge_share)
    trimmed = long.join(cut, "gene").withColumn("seq", F.substring(F.col("seq"), F.col("first") + 1, F.col("last") - F.col("first") + 1)).drop("first", "last")
    trimmed = trimmed.where(data_length(F.col("seq")) > 0)
    trimmed = trimmed.join(frames.severe(trimmed.select("gene", "name", "seq")), ["gene", "name"], "left_anti")
    if params.column_share > 0:
        kept, _ = pairs.internal_cull(trimmed.select("gene", "name", F.col("seq").alias("aa")), trimmed.select("gene", "name", F.lit("").alias("nt")), "gene", params.column_share)
        trimmed = trimmed.drop("seq").join(kept.withColumnRenamed("aa", "seq"), ["gene", "name"])
    stay = trimmed.join(frames.deviating(trimmed.select("gene", "name", "seq")).select("gene", "name"), ["gene", "name"], "left_anti")
    full = stay.join(known.select("gene", F.col("name").alias("__first"), "taxon"), ["gene", "__first"]).select("gene", "name", "taxon", "seq")
    return combining.kick_genes(full, params.gene_share) if params.gene_share > 0 else full


def profile_search(hits: DataFrame, reads: DataFrame, references: DataFrame, least: float = 10.0, distance: int = 100, margin: int = 50) -> DataFrame:
    """G4. Reads of each gene that fit the profile of its references (gene, name, seq): gene, node, frame, score, start, end and passed.

    Searched are the reads that ``hits`` (gene, node) names and those up to ``margin`` numbers beyond the ends of their clusters (J13), in six
    frames; of each the best frame counts. A read below ``least`` bits stays if one that passed is at most ``distance`` away (J12)."""
    grouped = islands.id_clusters(hits.select("gene", "node").distinct(), ["gene"], "node", distance)
    ends = grouped.groupBy("gene", "cluster").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    searched = H.range_expanded(ends, "low", "high", margin).select("gene", "node").distinct().join(reads.select("node", "seq"), "node")
    # Dealt into a fixed number of partitions: reads are small to shuffle, and their six readings are long to make.
    searched = searched.repartition(int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions")), "gene", "node")
    frames_ = F.arrays_zip(F.array(*map(F.lit, FRAMES)).alias("frame"), six_frames(F.col("seq")).alias("aa"))
    rows = searched.select("gene", "node", F.inline(frames_))
    named = rows.select("gene", F.concat_ws(":", F.col("node").cast("string"), F.col("frame").cast("string")).alias("name"), F.col("aa").alias("seq"), F.col("node").alias("of"), F.col("frame").alias("rank"))
    found = profiling.profile_matches(named, profiling.profiles(references), float("inf")).withColumn("node", F.substring_index("name", ":", 1).cast("long")).withColumn("frame", F.substring_index("name", ":", -1).cast("int"))
    best = best_rows(found.where("score > 0"), ["gene", "node"], [F.desc("score"), F.col("frame")]).withColumn("passed", F.col("score") >= least)
    return H.rescued(best, ["gene"], "node", "passed", distance).select("gene", "node", "frame", "score", "start", "end", "passed")


def outliers(rows: DataFrame, references: DataFrame, times: float = 1.75, is_genome: bool = False, distance: int = 100, least_passed: float = 0.5, least_match: float = 0.8) -> DataFrame:
    """G11. Rows (gene, name, node, seq) with their grade against the references of their gene: gene, name, statistic, bound, grade.

    Of genomes, a failed row is rescued (grade "rescued") where more than ``least_passed`` of its cluster of nodes passed (A30) and at least
    ``least_match`` of its letters equal the consensus of the rows that passed."""
    graded = frames.screening.screened(rows.select("gene", "name", "seq"), references, times)
    if not is_genome:
        return graded
    marked = rows.join(graded.select("gene", "name", (F.col("grade") == "pass").alias("passed")), ["gene", "name"])
    majority = pairs.cluster_majority(marked.select("gene", "node", "seq", "passed"), pairs.reference_columns(references), distance)
    good = majority.where(F.col("passed") > least_passed).select("gene", "first", "last")
    inside = marked.where("not passed").join(good, "gene").where("node between first and last").select("gene", "name").distinct()
    match = frames.consensus_match(marked.select("gene", "name", "seq", "passed")).where(F.col("match") >= least_match).select("gene", "name")
    saved = inside.join(match, ["gene", "name"]).withColumn("__saved", F.lit(True))
    return graded.join(saved, ["gene", "name"], "left").withColumn("grade", F.when(F.coalesce("__saved", F.lit(False)) & (F.col("grade") == "fail"), "rescued").otherwise(F.col("grade"))).drop("__saved")


def internal(rows: DataFrame, agree: float = 0.5, threshold: float = 0.075, least_depth: int = 1, least_length: int = 0, least_overlap: int = 1) -> DataFrame:
    """G16. Rows (gene, name, seq) that differ from the consensus of their gene, where it has ``least_depth`` votes, at less than ``threshold`` of the
    compared places; rows shorter than ``least_length`` or with fewer than ``least_overlap`` compared places are not judged."""
    return consensus_distance_kick(rows, columns.consensus(rows, "gene", agree, least=least_depth), "gene", threshold, least_length, least_overlap)


def pal2nal(rows: DataFrame, nt: DataFrame) -> DataFrame:
    """G9. Aligned proteins (gene, name, seq) with the codons of their nucleotides (gene, name, nt) along them; rows without are left out."""
    return rows.select("gene", "name", "seq").join(nt.select("gene", "name", F.col("nt").alias("__nt")), ["gene", "name"]).select("gene", "name", "seq", back_translated(F.col("seq"), F.col("__nt")).alias("nt"))


def combine(samples: list[DataFrame]) -> DataFrame:
    """Rows of all samples (gene, taxon, target, is_ref, seq), references once for each gene and target."""
    return combining.union_references_once(samples, ["gene", "target"])


def merge(rows: DataFrame, references: DataFrame, mode: str = "consensus", threshold: float = 0.5) -> DataFrame:
    return merged(rows, references, mode, threshold)


def cluster(rows: DataFrame, distance: int = 100, gap: float = 0.3, single: float = 0.5, references: DataFrame | None = None) -> DataFrame:
    return clustered(rows, "gene", distance, gap, single, references)


def finish(rows: DataFrame, kick: DataFrame | None = None, names: DataFrame | None = None, targets: DataFrame | None = None, params: Finish = Finish()) -> dict[str, DataFrame]:
    """G26. The final data set of rows (gene, taxon, seq): stops as X (X10), renamed (J14), kicked (F12), poor columns cut (A14), rows with
    too little data (F13) and genes of too few taxa (F14) dropped, gaps inside marked (X9), routed by target genes (K8), concatenated, counted.

    rows (with route), concatenation, charsets, matrix (A20, with the stops and the rows kicked of each gene and taxon), diversity and presence.
    """
    stops = F.length("seq") - F.length(F.replace("seq", F.lit("*"), F.lit("")))
    rows = rows.withColumn("stops", stops.cast("long")).withColumn("seq", stop_to_x(F.col("seq")))
    if names is not None:
        rows = combining.renamed(rows, names, "taxon", names.columns[1])
    every = rows.select("gene", "taxon", "stops")
    if kick is not None:
        rows = combining.kick_names(rows, kick, "taxon")
    if params.column_share > 0:
        kept = columns.occupancy(rows, "gene").where(F.col("share") >= params.column_share).groupBy("gene").agg(F.array_sort(F.collect_list("place")).alias("__keep"))
        rows = rows.join(kept, "gene").withColumn("seq", F.array_join(F.transform("__keep", lambda k: F.substring(F.col("seq"), k + 1, F.lit(1))), "")).drop("__keep")
    rows = rows.where(F.length(F.translate("seq", "-", "")) >= params.least_letters)
    rows = combining.coverage_kick(rows, params.coverage) if params.coverage > 0 else rows
    rows = combining.kick_genes(rows, params.gene_share) if params.gene_share > 0 else rows
    matrix = combining.gene_by_taxon(rows, "gene", "taxon")
    before = every.cube("gene", "taxon").agg(F.count("*").alias("all"), F.sum("stops").alias("stops"))
    matrix = before.alias("b").join(matrix.alias("m"), F.expr("b.gene <=> m.gene and b.taxon <=> m.taxon"), "left").select("b.gene", "b.taxon", F.coalesce("m.n", F.lit(0)).alias("n"), "b.stops", (F.col("b.all") - F.coalesce("m.n", F.lit(0))).alias("kicked"))
    counted = {
        "concatenation": combining.concatenated(rows, fill=params.gap),
        "charsets": combining.charsets(rows),
        "matrix": matrix,
        "diversity": columns.diversity(rows, "gene"),
        "presence": combining.taxon_presence(rows),
    }
    rows = rows.withColumn("seq", inner_gaps(F.col("seq"), mark=params.inner_gap)).drop("stops")
    rows = combining.routed(rows, targets, "gene") if targets is not None else rows.withColumn("route", F.lit("target"))
    return {"rows": rows, **counted}
