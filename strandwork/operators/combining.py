"""Combining samples and finishing data sets: (gene, taxon, target, seq) and more columns."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from strandwork.functions.msa import coverage
from strandwork.operators.selecting import best_rows


def union_references_once(samples: list[DataFrame], keys: list[str], gaps: str = "-") -> DataFrame:
    """U1. All samples' rows without gaps; of references (is_ref) with equal keys the first sample's only."""
    rows = None
    for k, s in enumerate(samples):
        s = s.withColumn("sample", F.lit(k))
        rows = s if rows is None else rows.unionByName(s, allowMissingColumns=True)
    rows = rows.withColumn("seq", F.translate("seq", gaps, ""))
    return rows.where(~F.col("is_ref")).unionByName(best_rows(rows.where("is_ref"), keys, ["sample", "seq"]))


def kick_names(rows: DataFrame, names: DataFrame, *columns: str) -> DataFrame:
    """F12. Rows none of whose ``columns`` is in ``names`` (one column), upper and lower case alike."""
    kicked = names.select(F.lower(F.col(names.columns[0])).alias("__kick")).distinct()
    for c in columns:
        rows = rows.join(kicked, F.lower(F.col(c)) == F.col("__kick"), "left_anti")
    return rows


def coverage_kick(rows: DataFrame, required: float) -> DataFrame:
    """F13. Rows with at least the required share of data."""
    return rows.where(coverage(F.col("seq")) >= required)


def kick_genes(rows: DataFrame, share: float, gene: str = "gene", taxon: str = "taxon") -> DataFrame:
    """F14. Genes found in more than ``share`` of all taxa; a gene exactly at the limit goes."""
    total = rows.agg(F.countDistinct(taxon).alias("all"))
    some = rows.groupBy(gene).agg(F.countDistinct(taxon).alias("has")).join(F.broadcast(total)).where(F.col("has") / F.col("all") > share)
    return rows.join(some.select(gene), gene, "left_semi")


def renamed(rows: DataFrame, names: DataFrame, key: str, new: str) -> DataFrame:
    """J14. ``key`` replaced by ``new`` of ``names`` where it is there; a key that ``names`` repeats has its smallest name."""
    one = names.groupBy(F.col(key).alias("__key")).agg(F.min(new).alias("__new"))
    return rows.join(one, F.col(key) == F.col("__key"), "left").withColumn(key, F.coalesce("__new", key)).drop("__key", "__new")


def concatenated(rows: DataFrame, gene: str = "gene", taxon: str = "taxon", fill: str = "-") -> DataFrame:
    """A19. Every taxon with its genes in order of name, missing ones filled to the gene's length (its longest row).

    The output has every taxon and gene by its nature; no product of taxa and genes is formed. Of several rows of a taxon in a gene the greatest counts.
    """
    one = rows.groupBy(gene, taxon).agg(F.max("seq").alias("seq"))
    n = F.coalesce(F.max(F.length("seq")), F.lit(0)).cast("long").alias("n")
    # A gene's place: one row a gene. Between two genes of a taxon lie as many fillers as their places are apart.
    places = one.groupBy(gene).agg(n).select(gene, "n", (F.sum("n").over(_before(gene)) - F.col("n")).alias("begin"), F.sum("n").over(Window.partitionBy(F.lit(0))).alias("all"))
    text = F.rpad(F.coalesce("seq", F.lit("")), F.col("n").cast("int"), F.lit(fill))
    own = one.join(places, gene).groupBy(taxon).agg(F.max("all").alias("all"), F.array_sort(F.collect_list(F.struct("begin", (F.col("begin") + F.col("n")).alias("end"), text.alias("s")))).alias("p"))
    fillers = lambda count: F.repeat(F.lit(fill), count.cast("int"))
    parts = F.transform("p", lambda x, i: F.concat(fillers(x["begin"] - F.coalesce(F.get("p", i - 1)["end"], F.lit(0))), x["s"]))
    return own.select(taxon, F.concat(F.array_join(parts, ""), fillers(F.col("all") - F.element_at("p", -1)["end"])).alias("seq"))


def _before(gene: str) -> WindowSpec:
    return Window.orderBy(gene).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def charsets(rows: DataFrame, gene: str = "gene") -> DataFrame:
    """A19. First and last place (from 1) of each gene in the concatenation."""
    length = rows.groupBy(gene).agg(F.max(F.length("seq")).alias("n"))
    last = F.sum("n").over(_before(gene))
    return length.select(gene, (last - F.col("n") + 1).alias("first"), last.alias("last"))


def gene_by_taxon(rows: DataFrame, gene: str, taxon: str) -> DataFrame:
    """A20. Counts for each gene and taxon, with totals of rows and columns (null gene or taxon)."""
    return rows.cube(gene, taxon).agg(F.count("*").alias("n"))


def taxon_presence(rows: DataFrame, taxon: str = "taxon", gene: str = "gene") -> DataFrame:
    """A22 and A24. Genes, rows and letters of data of each taxon."""
    return rows.groupBy(taxon).agg(F.countDistinct(gene).alias("genes"), F.count("*").alias("n_rows"), F.sum(F.length(F.translate("seq", "-", ""))).alias("letters"))


def routed(rows: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """K8. ``route``: target or off_target."""
    marked = targets.select(F.col(targets.columns[0]).alias("__t")).distinct().withColumn("__on", F.lit(True))
    return rows.join(marked, F.col(key) == F.col("__t"), "left").withColumn("route", F.when(F.col("__on"), "target").otherwise("off_target")).drop("__t", "__on")


def merged_name(rows: DataFrame, by: list[str], reference: str, node: str) -> DataFrame:
    """A32. The commonest reference of each group (ties: the first by name) and its nodes in order, joined by &&."""
    counted = rows.groupBy(*by, reference).agg(F.count("*").alias("n"))
    best = counted.groupBy(*by).agg(F.min_by(reference, F.struct(-F.col("n"), F.col(reference))).alias("reference"))
    nodes = rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_set(node)), lambda x: x.cast("string")), "&&").alias("nodes"))
    return best.join(nodes, by)


def kmer_similarity(a: Column, b: Column, k: int) -> Column:
    """A34. Shared different k-mers over those of the text with fewer; null if a text is too short or null."""

    def grams(text: str) -> np.ndarray | set[str]:
        """Different k-mers: packed into numbers where they fit, so that a text is cut and compared as arrays."""
        if k <= 8 and text.isascii():
            raw = np.frombuffer(text.encode(), np.uint8).astype(np.uint64)
            out = np.zeros(len(raw) - k + 1, np.uint64)
            for j in range(k):
                out = out << np.uint64(8) | raw[j : j + len(out)]
            out.sort()
            return out[np.append(True, out[1:] != out[:-1])]
        return {text[i : i + k] for i in range(len(text) - k + 1)}

    def shared(p: np.ndarray | set[str], q: np.ndarray | set[str]) -> int:
        if isinstance(p, np.ndarray) and isinstance(q, np.ndarray):
            return len(np.intersect1d(p, q, assume_unique=True))
        return len(_texts(p) & _texts(q))

    def _texts(p: np.ndarray | set[str]) -> set[str]:
        return p if isinstance(p, set) else {int(v).to_bytes(k, "big").decode() for v in p}

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        def one(s: str | None, t: str | None) -> float | None:
            if s is None or t is None or min(len(s), len(t)) < k:
                return None
            p, q = grams(s), grams(t)
            return shared(p, q) / min(len(p), len(q))

        return pd.Series([one(s, t) for s, t in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)
