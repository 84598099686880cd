"""Connected components of an edge table, by alternating large and small stars; nothing is collected."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.llm.common import dropped, written


def _marks(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to another node; component is its smallest node.

    ``edges`` has two columns of one integer type, in either direction, repeats allowed. Each round joins neighbours to the
    minimum of a node; minima combine before the shuffle, and a node with very many edges is split by the skew join.
    """
    a, b = edges.columns
    now = written(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = _marks(now)
    while before[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = large.join(_least(large), "u")
        old, now = now, written(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        dropped(old)
        after = _marks(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) pairs that span the same components as the true entries of a matrix."""
    open_rows, open_cols = linked.any(1), linked.any(0)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for start in np.flatnonzero(open_rows):
        if not open_rows[start]:
            continue
        rows = np.array([start])
        open_rows[start] = False
        while len(rows):
            cols = np.flatnonzero(linked[rows].any(0) & open_cols)
            if not len(cols):
                break
            open_cols[cols] = False
            out.append((rows[linked[np.ix_(rows, cols)].argmax(0)], cols))
            rows = np.flatnonzero(linked[:, cols].any(1) & open_rows)
            open_rows[rows] = False
            out.append((rows, cols[linked[np.ix_(rows, cols)].argmax(1)]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z
    return np.concatenate([r for r, _ in out]), np.concatenate([c for _, c in out])
