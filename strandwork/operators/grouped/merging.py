"""Merging overlapping rows of a gene."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions.dna import CODONS, IUPAC
from strandwork.functions.msa import data_end, data_start
from strandwork.operators.columns import agreed_codons
from strandwork.operators.columns import consensus as consensus_of_rows
from strandwork.operators.grouped.columns import GAP, Row, best_split, consensus, last_split, reference_counts
from strandwork.operators.tallies import tallied
from strandwork.scratch import written


def overlap_groups(rows: list[Row], least: int = 0) -> list[list[Row]]:
    """W9. Runs of rows by start whose spans meet; touching ones join."""
    out: list[list[Row]] = []
    end = 0
    for r in sorted(rows, key=lambda r: (r.start, r.end, r.name)):
        if out and r.start <= end - least:
            out[-1].append(r)
            end = max(end, r.end)
        else:
            out.append([r])
            end = r.end
    return out


def apart_groups(rows: list[Row]) -> list[list[Row]]:
    """W10. Runs of rows in the given order: a new one begins where a row has a place in common with the run so far, from its least start to its
    greatest end."""
    out: list[list[Row]] = []
    start = end = 0
    for r in rows:
        if not out or min(end, r.end) - max(start, r.start) >= 1:
            out.append([r])
            start, end = r.start, r.end
        else:
            out[-1].append(r)
            start, end = min(start, r.start), max(end, r.end)
    return out


def spliced(rows: list[Row], references: list[str] | list[dict[str, int]], adjacency: int = 3, most: float = 0.5) -> list[tuple[str, str]]:
    """G23. (names joined by &&, seq) of the fragments of one component: two of them, by start, become one where they overlap by at most
    ``most`` of the shorter and differ there, at the split that agrees with most references, or where they lie less than ``adjacency``
    apart; again until none do. References are texts, or what reference_counts() tells of them."""
    counts = references if references and isinstance(references[0], dict) else reference_counts(references)
    now = sorted(rows, key=lambda r: (r.start, r.end, r.name))
    changed = True
    while changed:
        changed = False
        for i in range(len(now)):
            for j in range(i + 1, len(now)):
                a, b = now[i], now[j]
                lo, hi = max(a.start, b.start), min(a.end, b.end)
                if hi - lo < 1 - adjacency or (hi - lo) / max(1, min(a.end - a.start, b.end - b.start)) > most:
                    continue
                if hi > lo and a.seq[lo:hi] == b.seq[lo:hi]:
                    continue
                at = best_split(a.seq, b.seq, lo, hi, counts) if hi > lo else a.end
                now[i] = Row(f"{a.name}&&{b.name}", a.seq[:at] + b.seq[at:], a.weight + b.weight)
                del now[j]
                changed = True
                break
            if changed:
                break
    return [(r.name, r.seq) for r in now]


def codon_consensus(rows: list[Row], threshold: float) -> str:
    """A13 for one group: by codon, else the only codon that is no gap, else base by base."""
    width = max((len(r.seq) for r in rows), default=0) // 3
    out = []
    for k in range(width):
        votes: Counter[str] = Counter()
        for r in rows:
            if r.start <= k * 3 < r.end:
                votes[r.seq[k * 3 : k * 3 + 3].ljust(3, GAP)] += r.weight
        if not votes:
            out.append(GAP * 3)
            continue
        best = max(votes, key=lambda c: (votes[c], c))
        data = [c for c in votes if c != GAP * 3]
        if votes[best] > threshold * sum(votes.values()):
            out.append(best)
        elif len(data) == 1:
            out.append(data[0])
        else:
            for b in range(3):
                bases = "".join(sorted({c[b] for c in votes} - {GAP}))
                out.append(bases if len(bases) == 1 else IUPAC.get(bases, "N"))
    return "".join(out)


def split_merge(aa: list[Row], nt: dict[str, str], references: list[str], share: float = 0.55, least: int = 4) -> tuple[str, str]:
    """G22. One row from an overlap group. Where neighbours (by start) overlap, the row goes over from the first to the second at the
    split that agrees with most references (last_split()); a letter that ``share`` of at least ``least`` covering rows have replaces the row's
    own. Codons follow: the covering row's own, or the commonest codon of the amino acid that won."""
    order = sorted(aa, key=lambda r: (r.start, r.end, r.name))
    counts = reference_counts(references)
    splits = []
    for a, b in zip(order, order[1:], strict=False):
        lo, hi = b.start, min(a.end, b.end)
        splits.append((last_split(a.seq, b.seq, lo, hi, counts) if hi > lo else b.start, b))
    width = max(len(r.seq) for r in order)
    out_aa, out_nt = [], []
    for k in range(width):
        pick = next((b for at, b in reversed(splits) if at <= k), order[0])
        covering = [r for r in order if r.start <= k < r.end]
        if not (pick.start <= k < pick.end):
            pick = covering[0] if covering else pick
        letter = pick.seq[k] if k < len(pick.seq) else GAP
        codon = nt.get(pick.name, "")[k * 3 : k * 3 + 3].ljust(3, GAP)
        votes = Counter(r.seq[k] for r in covering)
        if sum(votes.values()) >= least:
            best = max(votes, key=lambda c: (votes[c], c))
            if votes[best] / sum(votes.values()) >= share and best != letter:
                letter = best
                codons = Counter(nt.get(r.name, "")[k * 3 : k * 3 + 3] for r in covering)
                fits = [c for c in codons if CODONS.get(c, "X") == best]
                codon = max(fits, key=lambda c: (codons[c], c)) if fits else codon
        out_aa.append(letter)
        out_nt.append(codon)
    return "".join(out_aa), "".join(out_nt)


_SCHEMA = "gene string, taxa string, names string, reference string, total int, aa string, nt string"


#: What stands in for codons outside a row's span: no vote.
_OUTSIDE = "\x01"


def _agreed(rows: DataFrame, threshold: float) -> DataFrame:
    """G21. Columns are counted where the rows are; overlap groups come from the different spans of a gene and sample, without its texts."""
    own = F.col("gene").eqNullSafe(F.col("__gene")) & F.col("taxa").eqNullSafe(F.col("__taxa")) & (F.col("__s") == F.col("__start")) & (F.col("__e") == F.col("__end"))
    rows = rows.withColumns({"__s": data_start(F.col("aa")), "__e": data_end(F.col("aa"))}).where("__e > __s")
    w = Window.partitionBy("__gene", "__taxa").orderBy("__start", "__end")
    spans = rows.select(F.col("gene").alias("__gene"), F.col("taxa").alias("__taxa"), F.col("__s").alias("__start"), F.col("__e").alias("__end")).distinct()
    ends = F.max("__end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("__new", (F.col("__start") > F.coalesce(ends, F.lit(-1))).cast("long")).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = runs.groupBy("__gene", "__taxa", "__run").agg(F.collect_list(F.struct("__start", "__end")).alias("x")).withColumn("id", F.monotonically_increasing_id())
    groups = written(first.select("__gene", "__taxa", "id", F.inline("x")), "groups")
    held = rows.join(groups, own).select("id", "gene", "taxa", "name", "ref", "weight", "aa", "nt")
    named = held.groupBy("id").agg(F.first("gene").alias("gene"), F.first("taxa").alias("taxa"), F.array_join(F.array_sort(F.collect_list("name")), "&&").alias("names"), F.sum("weight").cast("int").alias("total"), F.max(F.length("aa")).alias("wide"), F.max(F.floor(F.length("nt") / 3)).alias("codons"))
    common = held.groupBy("id", "ref").agg(F.count("*").alias("n")).groupBy("id").agg(F.min_by("ref", F.struct(-F.col("n"), "ref")).alias("reference"))
    aa = consensus_of_rows(held.select("id", "weight", F.col("aa").alias("seq")), "id", threshold, "weight").withColumnRenamed("consensus", "aa")
    s, e = F.ceil(data_start(F.col("nt")) / 3).cast("int"), F.ceil(data_end(F.col("nt")) / 3).cast("int")
    inside = F.concat(F.repeat(F.lit(_OUTSIDE), 3 * F.col("s")), F.rpad(F.substring(F.col("nt"), 3 * F.col("s") + 1, 3 * (F.col("e") - F.col("s"))), 3 * (F.col("e") - F.col("s")), GAP))
    votes = tallied(held.select("id", "weight", "nt", s.alias("s"), e.alias("e")).where("e > s").select("id", "weight", inside.alias("seq")), "id", "weight", width=3).where(F.col("ch") != _OUTSIDE * 3)
    nt = agreed_codons(votes.join(named.select("id", "codons"), "id").where("place < codons").drop("codons"), "id", threshold).withColumnRenamed("consensus", "nt")
    padded = lambda c, n: F.rpad(F.coalesce(c, F.lit("")), n, GAP).alias(c)
    out = named.join(common, "id").join(aa, "id", "left").join(nt, "id", "left")
    return out.select("gene", "taxa", "names", "reference", "total", padded("aa", F.col("wide")), padded("nt", (3 * F.col("codons")).cast("int")))


def merged(rows: DataFrame, references: DataFrame, mode: str = "consensus", threshold: float = 0.5) -> DataFrame:
    """G21 and G22 for rows (gene, taxa, name, ref, weight, aa, nt), references (gene, seq): one row for each overlap group of a
    gene and sample, ``mode`` consensus (A12 and A13) or split (G22). names are joined by && in order, reference is the commonest."""
    if mode != "split":
        return _agreed(rows, threshold)

    def every_sample(pdf: pd.DataFrame, refs: pd.DataFrame) -> pd.DataFrame:
        known = sorted(refs["seq"].dropna()) if len(refs) else []
        parts = [run(part, known) for _, part in pdf.groupby("taxa", sort=True, dropna=False)] if len(pdf) else []
        return pd.concat(parts) if parts else pd.DataFrame(columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    def run(pdf: pd.DataFrame, known: list[str]) -> pd.DataFrame:
        aa = [Row(r.name, r.aa, int(r.weight)) for r in pdf[["name", "aa", "weight"]].itertuples(index=False)]
        nt = dict(zip(pdf["name"], pdf["nt"], strict=True))
        ref = dict(zip(pdf["name"], pdf["ref"], strict=True))
        out = []
        for group in overlap_groups([r for r in aa if r.end > r.start]):
            names = sorted(r.name for r in group)
            common = Counter(ref[n] for n in names)
            a, n = split_merge(group, nt, known)
            out.append((pdf["gene"].iloc[0], pdf["taxa"].iloc[0], "&&".join(names), min(common, key=lambda c: (-common[c], c)), sum(r.weight for r in group), a, n))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    return rows.groupBy("gene").cogroup(references.groupBy("gene")).applyInPandas(every_sample, _SCHEMA)
