"""The grouped algorithms as DataFrame operators: rows of a gene meet the references of that gene in one grouped map.

Inputs are rows (gene, name, seq, more) and references (gene, name, seq); a gene's rows and references are one alignment, some thousand
rows by nature. References are co-grouped, not copied to every row; genes without rows give none.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions.msa import compared, data_end, data_start
from strandwork.operators.columns import consensus
from strandwork.operators.grouped import aligning, assembly, clusters, columns, deviation, merging, profiles, screening, trimming
from strandwork.operators.grouped.columns import GAP, Row
from strandwork.operators.tallies import tallied
from strandwork.scratch import written


def _references(references: DataFrame) -> DataFrame:
    """References under columns of their own: they may come from the same table as the rows."""
    return references.select(*[F.col(c).alias(c) for c in ("gene", "name", "seq")])


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def by_gene(rows: DataFrame, fn: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """fn of each gene's rows, in order of name; it gives tuples without the gene."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(pdf["gene"].iloc[0], *r) for r in fn(pdf.sort_values("name", kind="stable"))], columns=["gene", *_names(schema)])

    # Into a fixed number of partitions: genes are small to shuffle and long to work on.
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "gene").groupBy("gene").applyInPandas(run, f"gene string, {schema}")


def with_references(rows: DataFrame, references: DataFrame, fn: Callable[[pd.DataFrame, list[str]], list[tuple]], schema: str) -> DataFrame:
    """fn of each gene's rows and its references' texts, both in order of name."""

    def run(pdf: pd.DataFrame, refs: pd.DataFrame) -> pd.DataFrame:
        known = refs.sort_values("name", kind="stable")["seq"].tolist() if len(refs) else []
        done = fn(pdf.sort_values("name", kind="stable"), known) if len(pdf) else []
        return pd.DataFrame([(pdf["gene"].iloc[0], *r) for r in done], columns=["gene", *_names(schema)])

    return rows.groupBy("gene").cogroup(_references(references).groupBy("gene")).applyInPandas(run, f"gene string, {schema}")


#: Rows of a block: what one call holds beside the counts of its gene; of aligned texts, which may be far longer, fewer.
BLOCK_ROWS = 1024
ALIGNED_ROWS = 256
#: Rows of a gene whose distances one task holds.
WHOLE_ROWS = 3072
#: Letters of hits that are merged before what they gave is sent on.
MERGED_LETTERS = 1 << 22


def counted(references: DataFrame, span_only: bool = False) -> DataFrame:
    """One row for each gene of references: gene, how many they are, their width, and how many have which letter in which place
    (gaps too inside their spans if ``span_only``, else none). Texts are counted where they are; only counts are shuffled."""
    known = _references(references).where("gene is not null")
    votes = tallied(known, "gene", span_only=span_only)
    votes = votes if span_only else votes.where(F.col("ch") != GAP)
    held = votes.groupBy("gene").agg(F.collect_list("place").alias("places"), F.collect_list("ch").alias("letters"), F.collect_list("n").alias("votes"))
    sizes = known.groupBy("gene").agg(F.count("*").alias("n_references"), F.max(F.length("seq")).alias("width"))
    return sizes.join(held, "gene", "left")


def _counts(own: pd.DataFrame) -> columns.Counts:
    if not len(own):
        return columns.Counts([], [], [], 0, 0)
    r = own.iloc[0]
    some = r["places"] is not None
    return columns.Counts(r["places"] if some else [], list(r["letters"]) if some else [], r["votes"] if some else [], int(r["n_references"]), int(r["width"] or 0))


def in_blocks(rows: DataFrame, references: DataFrame, fn: Callable[[pd.DataFrame, columns.Counts], list[tuple]], schema: str, key: list[str]) -> DataFrame:
    """fn of blocks of a gene's rows, in order of name, beside the counts of its references: for work on rows that do not depend on each other.

    Rows are dealt by ``key`` into blocks of about BLOCK_ROWS, so a gene of very many rows is many tasks; rows of one key stay together."""
    sizes = rows.groupBy(F.col("gene").alias("__gene")).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("__blocks"))
    parts = rows.join(sizes, F.col("gene").eqNullSafe(F.col("__gene"))).withColumn("__block", F.pmod(F.xxhash64(*key), F.col("__blocks")).cast("int")).drop("__gene", "__blocks")
    known = counted(references).join(sizes, F.col("gene") == F.col("__gene")).withColumn("__block", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))).drop("__gene", "__blocks")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = ["gene", "__block"]

    def run(pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        done = fn(pdf.sort_values("name", kind="stable"), _counts(own)) if len(pdf) else []
        return pd.DataFrame([(pdf["gene"].iloc[0], *r) for r in done], columns=["gene", *_names(schema)])

    # Dealt into a fixed number of partitions: blocks are small to shuffle and long to work on.
    return parts.repartition(n, *at).groupBy(*at).cogroup(known.repartition(n, *at).groupBy(*at)).applyInPandas(run, f"gene string, {schema}")


def whole_genes(rows: DataFrame, references: DataFrame, fn: Callable[[pd.DataFrame, columns.Counts], list[tuple]], schema: str, span_only: bool = False) -> DataFrame:
    """fn of all of a gene's rows, in order of name, beside the counts of its references: for rows that depend on one another in their order."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        done = fn(pdf.sort_values("name", kind="stable"), _counts(own)) if len(pdf) else []
        return pd.DataFrame([(pdf["gene"].iloc[0], *r) for r in done], columns=["gene", *_names(schema)])

    known = counted(references, span_only)
    return rows.repartition(n, "gene").groupBy("gene").cogroup(known.repartition(n, "gene").groupBy("gene")).applyInPandas(run, f"gene string, {schema}")


def _rows(pdf: pd.DataFrame) -> list[Row]:
    weights = pdf["weight"] if "weight" in pdf else [1] * len(pdf)
    return [Row(n, s, int(w)) for n, s, w in zip(pdf["name"], pdf["seq"], weights, strict=True)]


# --- windows -----------------------------------------------------------------------------------------------------------


def ambiguous_nodes(hits: DataFrame, clusters_of: DataFrame, ratio: float = 1.1) -> DataFrame:
    """W7. Hits (node, gene, uid, score) of nodes with several genes, that go: all but the best gene's if its score is ``ratio`` times the
    next one's, else all but those of genes with clusters (gene) of their own. Best scores by gene; ties by name."""
    best = hits.groupBy("node", "gene").agg(F.max("score").alias("score"))
    w = Window.partitionBy("node").orderBy(F.desc("score"), "gene")
    ranked = best.withColumn("rank", F.row_number().over(w)).withColumn("next", F.lead("score").over(w))
    first = ranked.where("rank = 1 and next is not null").select("node", F.col("gene").alias("best"), ((F.col("next") <= 0) | (F.col("score") / F.col("next") >= ratio)).alias("clear"))
    owned = clusters_of.select("gene").distinct().withColumn("owned", F.lit(True))
    rows = hits.join(first, "node").join(owned, "gene", "left")
    stays = F.when(F.col("clear"), F.col("gene") == F.col("best")).otherwise(F.coalesce("owned", F.lit(False)))
    return rows.where(~stays).select("node", "gene", "uid")


def span_groups(rows: DataFrame) -> DataFrame:
    """W14. Rows of a gene by first and last place of data: gene, start, end, n and names."""
    s, e = data_start(F.col("seq")), data_end(F.col("seq"))
    return rows.where(e > s).groupBy("gene", s.alias("start"), e.alias("end")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("name")).alias("names"))


def apart_groups(rows: DataFrame) -> DataFrame:
    """W10, rows by start: gene, name, run from 1."""

    def run(pdf: pd.DataFrame) -> list[tuple]:
        order = sorted((r for r in _rows(pdf) if r.end > r.start), key=lambda r: (r.start, r.end, r.name))
        return [(r.name, k) for k, group in enumerate(merging.apart_groups(order), 1) for r in group]

    return by_gene(rows, run, "name string, run int")


def _runs(places: DataFrame, join: int = 0) -> DataFrame:
    """gene, start, end of runs of places (gene, place); runs at most ``join`` apart count as one. A gene has as many places as columns."""
    w = Window.partitionBy("gene").orderBy("place")
    marked = places.withColumn("__new", (F.col("place") - F.lag("place").over(w) > join + 1).cast("int"))
    run = marked.withColumn("__run", F.sum(F.coalesce("__new", F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return run.groupBy("gene", "__run").agg(F.min("place").cast("int").alias("start"), (F.max("place") + 1).cast("int").alias("end")).drop("__run")


def _columns(rows: DataFrame) -> DataFrame:
    """gene, place, total, gaps, most, kinds: the votes of a gene's columns inside spans, counted where the rows are."""
    votes = tallied(rows, "gene", "weight" if "weight" in rows.columns else None, span_only=True)
    gap = F.col("ch") == GAP
    return votes.groupBy("gene", "place").agg(F.sum("n").alias("total"), F.sum(F.when(gap, F.col("n")).otherwise(0)).alias("gaps"), F.max("n").alias("most"), F.max(F.struct("n", "ch"))["ch"].alias("top"), F.count(F.when(~gap, 1)).alias("kinds"), F.max(F.when(~gap, F.col("ch"))).alias("only"))


def _letter(threshold: float):
    """The consensus's letter of a row of _columns()."""
    return F.when(F.col("most") > threshold * F.col("total"), F.col("top")).when(F.col("kinds") == 1, F.col("only")).otherwise("X")


def x_regions(rows: DataFrame, threshold: float = 0.65, join: int = 0) -> DataFrame:
    """W11. Runs of ambiguous columns of a gene's consensus: gene, start, end."""
    return _runs(_columns(rows).where(_letter(threshold) == "X"), join)


def shallow_regions(rows: DataFrame, threshold: float = 0.65, least: int = 2) -> DataFrame:
    """W11. Runs of columns where fewer than ``least`` rows agree: gene, start, end."""
    return _runs(_columns(rows).where((F.col("total") < least) & ~_letter(threshold).isin(GAP, "X")))


def gap_regions(rows: DataFrame, share: float = 0.25, join: int = 0) -> DataFrame:
    """W12. Runs of columns where gaps inside spans hold part of the votes: gene, start, end."""
    part = F.col("gaps") / F.col("total")
    return _runs(_columns(rows).where((part >= share) & (part < 1)), join)


# --- screening ---------------------------------------------------------------------------------------------------------


def severe(rows: DataFrame, threshold: float = 0.5, floor: float = 0.2, times: float = 1.5) -> DataFrame:
    """A29. Rows too far from their consensus: gene, name. Distances are shares of few letters, so a gene's quartiles come from the
    counts of the different ones."""
    weight = "weight" if "weight" in rows.columns else None
    agreed = consensus(rows, "gene", threshold, weight).withColumnRenamed("gene", "__gene")
    c = compared(F.col("seq"), F.col("consensus"))
    known = rows.join(agreed, F.col("gene").eqNullSafe(F.col("__gene"))).select("gene", "name", c.alias("c")).where("c.compared > 0").select("gene", "name", (F.col("c.different") / F.col("c.compared")).alias("d"))
    q = known.groupBy(F.col("gene").alias("__gene")).agg(F.percentile("d", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    bound = F.greatest(F.col("q")[1] + times * (F.col("q")[1] - F.col("q")[0]), F.lit(floor))
    return known.join(q, F.col("gene").eqNullSafe(F.col("__gene"))).where(F.col("d") > bound).select("gene", "name")


def deviating(rows: DataFrame, floor: float = 0.03, times: float = 1.0, rounds: int = 3, halves: bool = False) -> DataFrame:
    """A28. Rows too far from the others: gene, name, part (whole, first or second). A gene of up to WHOLE_ROWS rows is one task, larger
    ones meet in blocks."""
    rows = rows.select("gene", "name", "seq")
    large = rows.groupBy(F.col("gene").alias("__gene")).agg(F.count("*").alias("n")).where(F.col("n") > WHOLE_ROWS).select("__gene")
    of = lambda df, other, how: df.join(other, F.col("gene").eqNullSafe(F.col("__gene")), how)
    some = not large.isEmpty()

    def run(pdf: pd.DataFrame) -> list[tuple]:
        if halves:
            return sorted(screening.deviating_halves(_rows(pdf), floor=floor, times=times, rounds=rounds).items())
        return [(n, "whole") for n in screening.deviating_rows(_rows(pdf), floor, times, rounds)]

    found = by_gene(of(rows, large, "left_anti") if some else rows, run, "name string, part string")
    if not some:
        return found
    own = of(rows, large, "left_semi")
    far = lambda text: deviation.deviating_in_blocks(text, floor, times, rounds)
    if not halves:
        return found.unionByName(far(own).withColumn("part", F.lit("whole")))
    parts = written(deviation.parts_of(own), "deviation-parts")
    first = far(parts.select("gene", "name", F.col("first").alias("seq")))
    gone = first.select(F.col("gene").alias("__gene"), F.col("name").alias("__name"))
    stay = parts.join(gone, F.col("gene").eqNullSafe(F.col("__gene")) & (F.col("name") == F.col("__name")), "left_anti")
    second = far(stay.select("gene", "name", F.col("second").alias("seq")))
    return found.unionByName(first.withColumn("part", F.lit("first"))).unionByName(second.withColumn("part", F.lit("second")))


def profile_filtered(rows: DataFrame, references: DataFrame, least: float = 0.3) -> DataFrame:
    """G18 for (gene, name, read, seq, score): rows that go. Rows are matched with the references in blocks; what is left of a gene is put in
    order without its texts."""

    def matched(pdf: pd.DataFrame, counts: columns.Counts) -> list[tuple]:
        return [(n, r, *columns.span(s), score, trimming.average_match(s, counts) < least) for n, r, s, score in zip(pdf["name"], pdf["read"], pdf["seq"], pdf["score"], strict=True)]

    kind = rows.schema["read"].dataType.simpleString()
    graded = in_blocks(rows, references, matched, f"name string, read {kind}, start int, end int, score double, bad boolean", ["name"])
    graded = written(graded, "graded")  # read twice, made once
    pick = lambda pdf: list(zip(*[pdf[c] for c in ("name", "read", "start", "end", "score")], strict=True))
    beaten = by_gene(graded.where("not bad").drop("bad"), lambda pdf: [(n,) for n in screening.beaten_rows(pick(pdf))], "name string")
    return graded.where("bad").select("gene", "name").unionByName(beaten)


def match_scores(rows: DataFrame, references: DataFrame) -> DataFrame:
    """X19. gene, name and the average match with the references."""
    score = lambda pdf, counts: [(n, trimming.average_match(s, counts)) for n, s in zip(pdf["name"], pdf["seq"], strict=True)]
    return in_blocks(rows, references, score, "name string, score double", ["name"])


def cluster_filtered(rows: DataFrame, references: DataFrame, distance: int = 100, gap: float = 0.3) -> DataFrame:
    """G12 for (gene, name, ids, strand, seq): rows of clusters that go."""
    return whole_genes(rows, references, lambda pdf, counts: [(n,) for n in clusters.filtered_clusters(pdf, counts, distance, gap)], "name string")


def isoforms(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """G25. Of each gene the candidate (gene, name, seq) that its rows agree with most: gene, name."""

    def run(pdf: pd.DataFrame, group: list[str]) -> list[tuple]:
        return [(screening.best_isoform(_rows(pdf), group),)]

    return with_references(candidates, rows, run, "name string")


def profile_hits(rows: DataFrame, references: DataFrame) -> DataFrame:
    """G4 for (gene, name, seq without gaps): gene, name, score, start and end of the best part of each row by its gene's profile."""

    def run(pdf: pd.DataFrame, refs: list[str]) -> list[tuple]:
        odds = profiles.profile(refs)
        return [(n, *profiles.best_placement(s, odds)) for n, s in zip(pdf["name"], pdf["seq"], strict=True)]

    return with_references(rows, references, run, "name string, score double, start int, end int")


def consensus_match(rows: DataFrame, threshold: float = 0.65) -> DataFrame:
    """G11. gene, name and the share of a row's letters of data, in columns where the consensus of the passed rows of its gene is clear,
    that are equal to it, for (gene, name, seq, passed); null without any."""
    weight = "weight" if "weight" in rows.columns else None
    agreed = consensus(rows.where("passed"), "gene", threshold, weight).withColumnRenamed("gene", "__gene")
    c = compared(F.col("seq"), F.coalesce("consensus", F.lit("")))
    found = rows.join(agreed, F.col("gene").eqNullSafe(F.col("__gene")), "left").select("gene", "name", c.alias("c"))
    return found.select("gene", "name", F.when(F.col("c.compared") > 0, (F.col("c.compared") - F.col("c.different")) / F.col("c.compared")).alias("match"))


# --- trimming and splicing ---------------------------------------------------------------------------------------------


def end_trimmed(rows: DataFrame, references: DataFrame, window: int = 6, mismatches: int = 2, most_similar: float = 0.4, least: int = 15, share: float = 0.5, cull: float = 0.0, strictness: str = "strict") -> DataFrame:
    """G10 for (gene, name, seq, nt): gene, name, seq and nt trimmed alike; rows that have too little left have null texts."""

    def run(pdf: pd.DataFrame, refs: list[str]) -> list[tuple]:
        at = trimming.Columns.of(refs, share, cull, strictness)
        out = []
        for name, seq, nt in zip(pdf["name"], pdf["seq"], pdf["nt"], strict=True):
            done = trimming.trimmed(seq, at, window, mismatches, most_similar, least)
            out.append((name, done, trimming.nt_mirrored(seq, done, nt) if done else None))
        return out

    return with_references(rows, references, run, "name string, seq string, nt string")


def excised(rows: DataFrame, references: DataFrame, threshold: float = 0.85, join: int = 6, least: int = 15) -> DataFrame:
    """G14. gene, name, seq: rows cut where their consensus is ambiguous; null for rows with too little left."""

    def run(pdf: pd.DataFrame, counts: columns.Counts) -> list[tuple]:
        stay, gone = trimming.excised(_rows(pdf), counts.dicts(), threshold, join, least)
        return [(r.name, r.seq) for r in stay] + [(n, None) for n in gone]

    return whole_genes(rows, references, run, "name string, seq string", span_only=True)


def splice_sites(rows: DataFrame, window: int = 45) -> DataFrame:
    """G19 for (gene, name, left, between, right): gene, name, cut_left, cut_right and score of the best joins; rows without one have none."""

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                best = trimming.best_splice(r.left, r.right, r.between, window)
                if best:
                    out.append((r.gene, r.name, *best))
            yield pd.DataFrame(out, columns=["gene", "name", "cut_left", "cut_right", "score"])

    return rows.select("gene", "name", "left", "between", "right").mapInPandas(run, "gene string, name string, cut_left int, cut_right int, score int")


def gaps_filled(gaps: DataFrame, references: DataFrame, share: float = 0.5, least: int = 10) -> DataFrame:
    """G20 for (gene, name, genomic, first, last): gene, name, at and aa of the stretch of the genomic text that fits the columns best."""

    def run(pdf: pd.DataFrame, counts: columns.Counts) -> list[tuple]:
        out = []
        for name, genomic, first, last in zip(pdf["name"], pdf["genomic"], pdf["first"], pdf["last"], strict=True):
            found = trimming.filled_gap(genomic, counts, (int(first), int(last)), share, least)
            out += [(name, *found)] if found else []
        return out

    return in_blocks(gaps, references, run, "name string, at int, aa string", ["name"])


def fragments_spliced(rows: DataFrame, references: DataFrame, adjacency: int = 3, most: float = 0.5) -> DataFrame:
    """G23 for (gene, component, name, seq): gene, component, names and seq."""

    def run(pdf: pd.DataFrame, counts: columns.Counts) -> list[tuple]:
        known = counts.dicts()
        return [(c, n, s) for c, part in pdf.groupby("component", sort=True) for n, s in merging.spliced(_rows(part), known, adjacency, most)]

    return in_blocks(rows, references, run, "component string, names string, seq string", ["component"])


# --- assembling --------------------------------------------------------------------------------------------------------


def chunks_merged(hits: DataFrame, gap: int = 300, overlap: int = 30) -> DataFrame:
    """G5 for (gene, name, node, strand, start, end, seq): gene, name, ids, strand, start, end, seq of merged hits."""

    made = ("name", "ids", "strand", "start", "end", "seq")

    def run(batches):
        """Hits come sorted by gene: a task walks them and holds one gene's."""
        gene, held, out, letters = None, [], [], 0

        def merged() -> int:
            for h in assembly.chunks_merged(held, gap, overlap):
                out.append({"gene": gene, **{c: h[c] for c in made}})
            return sum(len(h["seq"]) for h in held)

        def given() -> pa.RecordBatch:
            table = pa.RecordBatch.from_pylist(out, schema)
            out.clear()
            return table

        for batch in batches:
            for g, name, node, strand, start, end, seq in zip(*[batch.column(c).to_pylist() for c in ("gene", "name", "node", "strand", "start", "end", "seq")], strict=True):
                if held and g != gene:
                    letters += merged()
                    held = []
                    if letters > MERGED_LETTERS:
                        yield given()
                        letters = 0
                gene = g
                held.append({"name": name, "ids": [node], "strand": strand, "start": start, "end": end, "seq": seq})
        if held:
            merged()
        yield given()

    schema = pa.schema([("gene", pa.string()), ("name", pa.string()), ("ids", pa.list_(pa.int64())), ("strand", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("seq", pa.string())])
    n = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    longs = [F.col(c).cast("long").alias(c) for c in ("node", "start", "end")]
    ordered = hits.select("gene", "name", "strand", "seq", *longs).repartition(n, "gene").sortWithinPartitions("gene", "node", "start", "end", "name")
    return ordered.mapInArrow(run, "gene string, name string, ids array<long>, strand string, start long, end long, seq string")


def contigs(rows: DataFrame, references: DataFrame, children: int = 4, length: int = 100, cap: int = 8, per_child: float = 0.001) -> DataFrame:
    """G15. gene, name (of the contig), seq, names and score: how many references (at most ``cap``) have its letter, summed over columns,
    and ``per_child`` more of it for each read."""

    def run(pdf: pd.DataFrame, refs: list[str]) -> list[tuple]:
        counts = columns.reference_counts(refs)
        out = []
        for k, (seq, names) in enumerate(assembly.assembled(_rows(pdf), children=children, length=length), 1):
            score = sum(min(cap, counts[i].get(c, 0)) for i, c in enumerate(seq) if i < len(counts) and c != GAP)
            out.append((f"contig_{k}", seq, names, float(score * (1 + per_child * len(names)))))
        return out

    return with_references(rows, references, run, "name string, seq string, names array<string>, score double")


def recovered(rows: DataFrame, threshold: float = 0.65, overlap: int = 12, least: int = 2) -> DataFrame:
    """G17 for (gene, name, seq, kicked): kicked rows that come back."""

    def run(pdf: pd.DataFrame) -> list[tuple]:
        kept, gone = _rows(pdf[~pdf["kicked"]]), _rows(pdf[pdf["kicked"]])
        return [(n,) for n in sorted(assembly.recovered(kept, gone, threshold, overlap, least))]

    return by_gene(rows, run, "name string")


# --- aligning ----------------------------------------------------------------------------------------------------------


def _order_of_name(name: str) -> Column:
    """By letters from the first on; of names that begin alike the longer one is less."""
    return F.concat(F.transform(F.filter(F.split(name, ""), lambda c: c != ""), lambda c: F.ascii(c)), F.array(F.lit(0x7FFFFFFF)))


def _centres(rows: DataFrame) -> DataFrame:
    """gene and __centre: the longest text of each gene, ties by name."""
    return rows.groupBy(F.col("gene").alias("__gene")).agg(F.min_by("seq", F.struct(-F.length("seq"), _order_of_name("name"), "seq")).alias("__centre"))


def aligned(rows: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """G8 (with references) or G3's alignment of references alone, for (gene, name, seq without gaps): gene, name, seq.

    As star_alignment() and clusterwise_alignment(), but each different text of a gene is aligned to its centre where it is, and all a gene's
    rows share is how wide its columns are: the most that any row has between two letters of the centre."""
    rows = rows.select("gene", "name", "seq")
    same = lambda own: F.col("gene").eqNullSafe(F.col(own))
    if references is None:
        texts, centres = rows.select("gene", "seq").distinct(), _centres(rows)
    else:
        known = _references(references)
        genes = rows.select(F.col("gene").alias("__own")).distinct()
        known = known.join(genes, same("__own"), "left_semi")
        texts = rows.select("gene", "seq").unionByName(known.select("gene", "seq")).distinct()
        first = _centres(known).withColumn("__rank", F.lit(0)).unionByName(_centres(rows.groupBy("gene", "seq").agg(F.min("name").alias("name"))).withColumn("__rank", F.lit(1)))
        centres = first.groupBy("__gene").agg(F.min_by("__centre", "__rank").alias("__centre"))
        rows = rows.unionByName(known)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def align(batches):
        for pdf in batches:
            for (gene, centre), own in pdf.groupby(["gene", "__centre"], sort=False, dropna=False):
                every = own["seq"].tolist()
                done = [aligning.inserted_letters(*pair) for pair in aligning.global_alignments(every, centre)]
                yield pd.DataFrame({"gene": [gene if isinstance(gene, str) else None] * len(every), "seq": every, "inserted": [[{"k": k, "text": t} for k, t in d[0]] for d in done], "own": [d[1] for d in done]})

    # Dealt into all partitions: texts are small to shuffle and long to align.
    work = texts.join(centres, same("__gene")).select("gene", "seq", "__centre").repartition(n, "gene", "seq")
    done = written(work.mapInPandas(align, "gene string, seq string, inserted array<struct<k:int,text:string>>, own string"), "to_centres")
    wide = done.select("gene", F.explode("inserted").alias("x")).groupBy("gene", "x.k").agg(F.max(F.length("x.text")).alias("n"))
    # One row a gene, as long as its centre; blocks of its texts meet it.
    sizes = done.groupBy(F.col("gene").alias("__gene")).agg(F.ceil(F.count("*") / ALIGNED_ROWS).cast("int").alias("__blocks"))
    widths = wide.groupBy("gene").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("wide"))
    widths = widths.join(sizes, same("__gene")).select("gene", "wide", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__block"))
    parts = done.join(sizes, same("__gene")).withColumn("__block", F.pmod(F.xxhash64("seq"), F.col("__blocks")).cast("int")).drop("__gene", "__blocks")

    def widen(pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["__of", "__plain", "seq"])
        held = dict(own["wide"].iloc[0]) if len(own) else {}
        made = [aligning.widened([(x["k"], x["text"]) for x in i], o, held) for i, o in zip(pdf["inserted"], pdf["own"], strict=True)]
        return pd.DataFrame({"__of": pdf["gene"], "__plain": pdf["seq"], "seq": made})

    widths = widths.select(*[F.col(c).alias(c) for c in widths.columns])  # columns of its own: both sides come from the same table
    at = ["gene", "__block"]
    made = parts.repartition(n, *at).groupBy(*at).cogroup(widths.repartition(n, *at).groupBy(*at)).applyInPandas(widen, "__of string, __plain string, seq string")
    named = rows.select("gene", "name", F.col("seq").alias("__own"))
    return named.join(made, same("__of") & (F.col("__own") == F.col("__plain"))).select("gene", "name", "seq")
