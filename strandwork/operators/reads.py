"""Preparing reads: cutting, chunking, classifying, de-duplicating."""

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions.dna import strand_key


def long_enough(reads: DataFrame, least: int = 90) -> DataFrame:
    """F1."""
    return reads.where(F.length("seq") >= least)


def split_at_n(reads: DataFrame, least: int = 90) -> DataFrame:
    """X11. The parts between runs of N with at least ``least`` letters: part (from 0), offset in the read, seq."""
    pattern = re.compile(f"[^N]{{{max(least, 1)},}}")

    @F.pandas_udf("array<struct<offset:int,seq:string>>")
    def parts(seq: pd.Series) -> pd.Series:
        return seq.map(lambda s: [(m.start(), m[0]) for m in pattern.finditer(s)] if s else [])

    rest = [c for c in reads.columns if c != "seq"]
    cut = reads.select(*rest, F.explode(parts("seq")).alias("p"))
    return cut.select(*rest, F.col("p.offset").alias("offset"), F.col("p.seq").alias("seq"))


def chunked(reads: DataFrame, size: int = 750, step: int = 500, least: int = 90) -> DataFrame:
    """X12. Overlapping chunks: start, stored end (start + size - 1), last (length - 1), seq. Short trailing chunks go."""
    rest = [c for c in reads.columns if c != "seq"]
    starts = reads.where(F.length("seq") > 0).withColumn("start", F.explode(F.sequence(F.lit(0), F.length("seq") - 1, F.lit(step))))
    cut = starts.withColumn("chunk", F.substring(F.col("seq"), F.col("start") + 1, F.lit(size))).where(F.length("chunk") >= least)
    return cut.select(*rest, "start", (F.col("start") + size - 1).alias("end"), (F.length("chunk") - 1).alias("last"), F.col("chunk").alias("seq"))


def dataset_flags(reads: DataFrame, key: str, assembly: int = 1250, genome: int = 50_000) -> DataFrame:
    """X13. Of each sample whether it is an assembly (any read of ``assembly`` letters) or a genome (any above ``genome``)."""
    longest = reads.groupBy(key).agg(F.max(F.length("seq")).alias("longest"))
    return longest.select(key, "longest", (F.col("longest") >= assembly).alias("is_assembly"), (F.col("longest") > genome).alias("is_genome"))


def exact_dedupe(rows: DataFrame, key: str, order: str, by: list[str] | None = None) -> DataFrame:
    """A1. The first row by ``order`` of each value of ``key``, with ``dupes``, the number of further ones.

    Minimum and count combine before the shuffle, so a text that a third of the rows hold is no hot task.
    """
    first = F.min_by(F.struct(*rows.columns), F.col(order)).alias("__row")
    return rows.groupBy(*(by or []), F.col(key).alias("__key")).agg(first, (F.count("*") - 1).alias("dupes")).select("__row.*", "dupes")


def strand_dedupe(reads: DataFrame, order: str, by: list[str] | None = None) -> DataFrame:
    """A1. As exact_dedupe(), where a sequence and its reverse complement are the same."""
    return exact_dedupe(reads.withColumn("__strand", strand_key(F.col("seq"))), "__strand", order, by).drop("__strand")


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """W16."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def numbered_in_ranges(rows: DataFrame, by: str, number: str, order: list[str], name: str, size: int = 1 << 16) -> DataFrame:
    """W16 for large groups: running numbers from 1 within ``by`` in the given order, which rises with the whole number ``number``.

    Rows meet in ranges of ``size`` numbers only; how many rows lie before a range is summed over the counts of ranges.
    """
    ranged = rows.withColumn("__r", F.floor(F.col(number) / size))
    before = F.sum("__n").over(Window.partitionBy(by).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1))
    counts = ranged.groupBy(by, "__r").agg(F.count("*").alias("__n")).select(by, "__r", F.coalesce(before, F.lit(0)).alias("__before"))
    here = F.row_number().over(Window.partitionBy(by, "__r").orderBy(*order))
    return ranged.withColumn("__here", here).join(counts, [by, "__r"]).withColumn(name, (F.col("__here") + F.col("__before")).cast("long")).drop("__r", "__here", "__before")
