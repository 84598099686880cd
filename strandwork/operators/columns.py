"""Columns of alignments: rows (by, seq). Votes are counted in batches and combine before they are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.functions.dna import iupac
from strandwork.operators.tallies import tallied


def consensus(msa: DataFrame, by: str, threshold: float, weight: str | None = None, least: int = 1) -> DataFrame:
    """A12 and H3. ``by`` and consensus: the letter with more than ``threshold`` of a place's votes, else the only letter that is no gap,
    else X; gaps inside a row's span vote; places of fewer than ``least`` votes are '-', those without any before the last one with votes too."""
    votes = tallied(msa, by, weight, span_only=True)
    place = votes.groupBy(by, "place").agg(F.sum("n").alias("total"), F.max(F.struct("n", "ch")).alias("top"), F.count(F.when(F.col("ch") != "-", 1)).alias("kinds"), F.max(F.when(F.col("ch") != "-", F.col("ch"))).alias("only"))
    letter = F.when(F.col("total") < least, "-").when(F.col("top.n") > threshold * F.col("total"), F.col("top.ch")).when(F.col("kinds") == 1, F.col("only")).otherwise("X")
    return _joined(place.select(by, "place", letter.alias("ch")), by, "-")


def _joined(letters: DataFrame, by: str, fill: str) -> DataFrame:
    """Letters by place as one text for each group: alignments are at most some thousand columns wide."""
    text = letters.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("place", "ch"))).alias("m"))
    missing = lambda x, i: F.repeat(F.lit(fill), x["place"] - F.coalesce(F.get("m", i - 1)["place"], F.lit(-1)) - 1)
    return text.select(by, F.array_join(F.transform("m", lambda x, i: F.concat(missing(x, i), x["ch"])), "").alias("consensus"))


def codon_consensus(msa: DataFrame, by: str, threshold: float, weight: str | None = None) -> DataFrame:
    """A13. The codon with more than ``threshold`` of the votes, else the only one that is no gap, else base by base the IUPAC letter."""
    return agreed_codons(tallied(msa, by, weight, width=3), by, threshold)


def agreed_codons(votes: DataFrame, by: str, threshold: float) -> DataFrame:
    """codon_consensus() of votes (by, place, ch, n)."""
    votes = votes.withColumnRenamed("ch", "codon")
    place = votes.groupBy(by, "place").agg(
        F.sum("n").alias("total"), F.max(F.struct("n", "codon")).alias("top"), F.count(F.when(F.col("codon") != "---", 1)).alias("kinds"), F.max(F.when(F.col("codon") != "---", F.col("codon"))).alias("only"), F.collect_set("codon").alias("all")
    )
    base = lambda k: F.transform("all", lambda c: F.substring(c, k, 1))
    mixed = F.concat(*[iupac(base(k)) for k in (1, 2, 3)])
    letter = F.when(F.col("top.n") > threshold * F.col("total"), F.col("top.codon")).when(F.col("kinds") == 1, F.col("only")).otherwise(mixed)
    return _joined(place.select(by, "place", letter.alias("ch")), by, "---")


def occupancy(msa: DataFrame, by: str, gap: str = "-") -> DataFrame:
    """A14. Of each (by, place) the rows and the share that is no gap."""
    data = F.sum(F.when(F.col("ch") != gap, F.col("n")).otherwise(0))
    return tallied(msa, by).groupBy(by, "place").agg(F.sum("n").alias("n_rows"), (data / F.sum("n")).alias("share"))


def without_empty_columns(msa: DataFrame, by: str, gap: str = "-") -> DataFrame:
    """A15. Every row of ``msa`` with the places removed that are gaps throughout its group; ``seq`` keeps its order.

    The kept places of a group are one small array, joined back to its rows.
    """
    full = tallied(msa, by).where(F.col("ch") != gap).select(by, "place").distinct()
    keep = full.groupBy(by).agg(F.array_sort(F.collect_list("place")).alias("__keep"))
    letters = F.filter(F.split("seq", ""), lambda c: c != "")
    cut = F.array_join(F.transform(F.coalesce("__keep", F.array().cast("array<int>")), lambda k: F.coalesce(F.get("__letters", k), F.lit(""))), "")
    return msa.withColumn("__letters", letters).join(keep, by, "left").withColumn("seq", cut).drop("__keep", "__letters")


def edges(occupied: DataFrame, by: str, least: float) -> DataFrame:
    """A17. First and last place whose share of data is at least ``least``."""
    return occupied.where(F.col("share") >= least).groupBy(by).agg(F.min("place").alias("first"), F.max("place").alias("last"))


def diversity(msa: DataFrame, by: str, gaps: str = "-X?") -> DataFrame:
    """A21. Of each group its places that are lax (any data), lax informative, strict (data in as many rows as any place has) and
    strict informative."""
    data = tallied(msa, by).where(~F.col("ch").isin(*gaps))
    place = data.groupBy(by, "place").agg(F.sum("n").alias("data"), F.max("n").alias("most"))
    every = place.join(F.broadcast(place.agg(F.max("data").alias("full"))))  # one row
    count = lambda c: F.sum(c.cast("long"))
    strict = F.col("data") >= F.col("full")
    return every.groupBy(by).agg(
        count(F.col("data") > 0).alias("lax"), count((F.col("data") >= 4) & (F.col("most") < F.col("data") - 2)).alias("lax_informative"),
        count(strict).alias("strict"), count(strict & (F.col("most") < F.col("full") - 2)).alias("strict_informative"),
    )
