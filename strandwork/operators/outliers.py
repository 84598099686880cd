"""Robust bounds and distances."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions import msa as msa_text


def midpoint_quartiles(df: DataFrame, by: str, value: str) -> DataFrame:
    """A26. q1 and q3 by the midpoint rule: the mean of the elements at the floor and the ceiling of (n - 1) p. Nulls and NaN do not count."""
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(by, F.col(value).cast("double").alias("v"))
    w = Window.partitionBy(by)
    ranked = rows.withColumn("k", F.row_number().over(w.orderBy("v")) - 1).withColumn("n", F.count("*").over(w))
    pick = lambda p: (F.avg(F.when(F.col("k") == F.floor((F.col("n") - 1) * p), F.col("v"))) + F.avg(F.when(F.col("k") == F.ceil((F.col("n") - 1) * p), F.col("v")))) / 2
    return ranked.groupBy(by).agg(F.count("*").alias("n"), pick(0.25).alias("q1"), pick(0.75).alias("q3"))


def midpoint_bound(df: DataFrame, by: str, value: str, times: float = 1.75, floor: float = 0.02) -> DataFrame:
    """A26. Each row with the upper bound q3 + times * max(q3 - q1, floor) of its group and whether it lies above."""
    q = midpoint_quartiles(df, by, value).select(by, (F.col("q3") + times * F.greatest(F.col("q3") - F.col("q1"), F.lit(floor))).alias("upper"))
    return df.join(q, by, "left").withColumn("outlier", F.coalesce(F.col(value).cast("double") > F.col("upper"), F.lit(False)))


def linear_bound(df: DataFrame, by: str, value: str, times: float = 1.5, floor: float = 0.0) -> DataFrame:
    """A29. As midpoint_bound() with linear quartiles, and the bound at least ``floor``."""
    q = df.groupBy(by).agg(F.expr(f"percentile({value}, 0.25)").alias("q1"), F.expr(f"percentile({value}, 0.75)").alias("q3"))
    q = q.select(by, F.greatest(F.col("q3") + times * (F.col("q3") - F.col("q1")), F.lit(floor)).alias("upper"))
    return df.join(q, by, "left").withColumn("outlier", F.coalesce(F.col(value) > F.col("upper"), F.lit(False)))


def gap_free_distance(a: str, b: str, gaps: str = "-X") -> float:
    """The share of differing letters over places where both have data; NaN without any."""
    x, y = np.frombuffer(a.encode("latin-1", "replace"), np.uint8), np.frombuffer(b.encode("latin-1", "replace"), np.uint8)
    n = min(len(x), len(y))
    x, y = x[:n], y[:n]
    ok = ~(np.isin(x, list(gaps.encode())) | np.isin(y, list(gaps.encode())))
    return float((x[ok] != y[ok]).mean()) if ok.any() else float("nan")


def all_distances(seqs: list[str], gaps: str = "-X") -> np.ndarray:
    """gap_free_distance() of every two rows, one row at a time against all; NaN where two can't be compared."""
    width = max(map(len, seqs), default=0)
    m = np.stack([np.frombuffer(s.ljust(width, gaps[0]).encode("latin-1", "replace"), np.uint8) for s in seqs]) if seqs else np.zeros((0, 0), np.uint8)
    data = ~np.isin(m, list(gaps.encode()))
    out = np.full((len(seqs), len(seqs)), np.nan)
    for i in range(len(seqs)):
        both = data[i] & data
        n = both.sum(1)
        some = n > 0
        out[i, some] = ((m[i] != m) & both).sum(1)[some] / n[some]
    return out


def reference_cull(msa: DataFrame, by: str, times: float = 1.5) -> DataFrame:
    """A27. Rows of each alignment that stay when the row of the largest mean distance is taken out again and again while it lies
    above the bound q3 + times * (q3 - q1) of all means (linear quartiles, ties by name). Needs (by, name, seq); groups are the
    references of one gene."""

    def cull(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("name", kind="stable").reset_index(drop=True)
        d = all_distances(pdf["seq"].tolist())
        np.fill_diagonal(d, np.nan)
        left = list(range(len(pdf)))
        while len(left) > 2:
            part = d[np.ix_(left, left)]
            seen = ~np.isnan(part)
            mean = np.where(seen.any(1), np.nansum(part, 1) / np.maximum(seen.sum(1), 1), 0)
            q1, q3 = np.percentile(mean, [25, 75])
            worst = int(mean.argmax())
            if mean[worst] <= q3 + times * (q3 - q1):
                break
            del left[worst]
        return pdf.iloc[left]

    return msa.groupBy(by).applyInPandas(cull, msa.schema)


def consensus_distance_kick(msa: DataFrame, agreed: DataFrame, by: str, threshold: float, least_length: int = 0, least_overlap: int = 1) -> DataFrame:
    """G16 and H7. Rows whose letters differ from their group's consensus (by, consensus) at less than ``threshold`` of the compared places.

    Compared are places where both have data and the consensus is no X. Rows that span fewer than ``least_length`` places or of which fewer than
    ``least_overlap`` are compared are not judged and stay.
    """
    letters = msa.join(agreed, by).select(*msa.columns, F.arrays_zip(F.split("seq", "").alias("a"), F.split("consensus", "").alias("b")).alias("z"))
    ok = F.filter("z", lambda p: p["a"].isNotNull() & p["b"].isNotNull() & ~p["a"].isin("-", "") & ~p["b"].isin("-", "X", ""))
    counted = letters.withColumn("__n", F.size(ok)).withColumn("__d", F.size(F.filter(ok, lambda p: p["a"] != p["b"])))
    length = msa_text.data_end(F.col("seq")) - msa_text.data_start(F.col("seq"))
    spared = (F.col("__n") < max(1, least_overlap)) | (length < least_length)
    return counted.where(spared | (F.col("__d") / F.col("__n") < threshold)).select(*msa.columns)


def consensus_distance_pair(aa: DataFrame, nt: DataFrame, agreed_aa: DataFrame, agreed_nt: DataFrame, by: str, most_aa: float, most_nt: float, least_length: int = 0, least_overlap: int = 1) -> tuple[DataFrame, DataFrame]:
    """G16 on proteins (by, name, seq) and nucleotides of the same names: proteins are judged first, nucleotides among the rows that passed, and
    rows that fail there go from the proteins as well. Least numbers are of letters of proteins, three times as many bases."""
    first = consensus_distance_kick(aa, agreed_aa, by, most_aa, least_length, least_overlap)
    second = consensus_distance_kick(nt.join(first.select(by, "name"), [by, "name"], "left_semi"), agreed_nt, by, most_nt, 3 * least_length, 3 * least_overlap)
    return first.join(second.select(by, "name"), [by, "name"], "left_semi"), second
