"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut in halves, and each half has a codebook of its own (k-means on a bounded sample), so that K + K centroids
name K * K cells. Every vector lies in the cell of its nearest centroids. It visits cells in the order of the multi-sequence
traversal, nearest first, and meets there the vectors of its own label; candidates are verified by cosine in double precision.
How many cells are visited is set by recall: sampled vectors are displaced to exactly the threshold cosine, and the number of
visits that finds TARGET_RECALL of those from one side is taken, however large (a pair can be found from either side).

K grows with the square root of the table, so that a cell holds CELL_VECTORS on average; the sample that fits the codebooks is
bounded, and gives at most SAMPLE / VECTORS_PER_CENTROID centroids. Beyond CELL_VECTORS times the square of that (4 * 10**9 vectors)
cells grow with the table.

Exactly equal vectors fold into one first. Crowded cells are cut into blocks of vectors and of visitors before any vector is
sent, and blocks meet as matrix products: a task holds one pair of blocks and returns counts and a spanning forest, never the
pairs. Vectors travel in the precision of the table and are compared in doubles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.llm.common import dropped, written
from strandwork.llm.components import components, forest

COSINE = 0.98
TARGET_RECALL = 0.995
#: The bound of the sample that fits the codebooks, how many of it each centroid takes at least, and the cells' mean size that sets K.
SAMPLE = 65_536
VECTORS_PER_CENTROID = 16
CELL_VECTORS = 256
HOME_BLOCK, VISIT_BLOCK = 512, 1024
#: Into how many parts the rows of one cell are dealt where they learn its size.
SALTS = 16
#: Numbers that a step of work on many vectors makes at most.
STEP = 1 << 22


@dataclass(frozen=True)
class MultiIndex:
    """Two codebooks and the number of cells that a vector visits."""

    left: np.ndarray
    right: np.ndarray
    visits: int

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.left.shape[1]
        return tuple(np.maximum((h**2).sum(1)[:, None] - 2 * h @ c.T + (c**2).sum(1), 0) for h, c in ((unit[:, :cut], self.left), (unit[:, cut:], self.right)))

    def cells(self, unit: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The nearest cells of each row, nearest first (ties: lower number).

        The t-th cell of the traversal has ranks (i, j) with (i + 1) (j + 1) <= t in the two sorted lists: only those are added up.
        """
        k, m = len(self.left), len(self.right)
        visits = min(visits or self.visits, k * m)
        wide = [min(m, visits // (x + 1)) for x in range(min(k, visits))]
        i, j = np.repeat(np.arange(len(wide)), wide), np.concatenate([np.arange(w) for w in wide])
        out = np.empty((len(unit), visits), np.int64)
        step = max(1, STEP // max(len(i), k + m))
        for at in range(0, len(unit), step):
            a, b = self.distances(unit[at : at + step])
            oa, ob = np.argsort(a, 1, kind="stable"), np.argsort(b, 1, kind="stable")
            sa, sb = np.take_along_axis(a, oa, 1), np.take_along_axis(b, ob, 1)
            cell = oa[:, i] * m + ob[:, j]
            order = np.lexsort((cell, sa[:, i] + sb[:, j]), axis=1)[:, :visits]
            out[at : at + step] = np.take_along_axis(cell, order, 1)
        return out


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    step = max(1, STEP // len(c))
    for _ in range(rounds):
        near = np.concatenate([((c**2).sum(1) - 2 * x[i : i + step] @ c.T).argmin(1) for i in range(0, len(x), step)])
        n = np.bincount(near, minlength=len(c))
        total = np.stack([np.bincount(near, x[:, d], len(c)) for d in range(x.shape[1])], 1)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def displaced(unit: np.ndarray, cosine: float = COSINE, seed: int = 6) -> np.ndarray:
    """Unit vectors at exactly this cosine from those given, in random directions."""
    away = np.random.default_rng(seed).normal(size=unit.shape)
    away -= (away * unit).sum(1, keepdims=True) * unit
    away /= np.linalg.norm(away, axis=1, keepdims=True) + 1e-300
    return cosine * unit + (1 - cosine**2) ** 0.5 * away


def fitted(unit: np.ndarray, rows: int, recall: float = TARGET_RECALL, cosine: float = COSINE) -> MultiIndex:
    """Codebooks and visits from a sample of unit vectors, for a table of so many rows."""
    k = int(min(max(2, round((rows / CELL_VECTORS) ** 0.5)), max(2, len(unit) // VECTORS_PER_CENTROID), len(unit)))
    cut = (unit.shape[1] + 1) // 2
    index = MultiIndex(kmeans(unit[:, :cut], k), kmeans(unit[:, cut:], k), 1)
    probe = unit[:4000]
    home = index.cells(displaced(probe, cosine), 1)[:, 0]
    visits, all_ = 16, len(index.left) * len(index.right)
    while True:  # all cells hold every vector, so this ends
        visits = min(visits, all_)
        seen = index.cells(probe, visits) == home[:, None]
        if seen.any(1).mean() >= recall:
            rank = np.where(seen.any(1), seen.argmax(1), visits - 1)
            return MultiIndex(index.left, index.right, int(np.quantile(rank, recall, method="higher")) + 1)
        visits *= 4


def vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(valid, matrix padded with zeros to ``width``): null, zero, and null or non-finite components are not valid."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros((len(column), width))
    for n in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == n)
        out[rows, :n] = flat[at[rows][:, None] + np.arange(n)]
    with np.errstate(invalid="ignore"):
        valid = np.isfinite(out).all(1) & (out != 0).any(1)
    return valid, out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _stacked(column, size: int) -> np.ndarray:
    """Unit vectors of ``size`` components in doubles from their stored bytes, which are floats or doubles."""
    rows = list(column)
    kind = "<f4" if len(rows[0]) == 4 * size else "<f8"
    return unit(np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64))


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block of a cell's vectors and one of its visitors: (a, null, links) sums and (a, b, 0) forest edges."""
    home, guest = pdf[pdf["home"]], pdf[~pdf["home"]]
    none = pd.DataFrame({"a": pd.Series([], dtype="int64"), "b": pd.Series([], dtype="Int64"), "links": pd.Series([], dtype="int64")})
    if not len(home) or not len(guest):
        return none
    hid, gid = home["node"].to_numpy(), guest["node"].to_numpy()
    wide = int(home["wide"].iloc[0])
    linked = (_stacked(guest["vector"], wide) @ _stacked(home["vector"], wide).T >= COSINE) & (gid[:, None] != hid)
    if not linked.any():
        return none
    r, c = forest(linked)
    # A pair that is seen from both sides counts where the smaller id visits.
    visited = np.array(home["cells"].tolist())
    guest_home = guest["own"].to_numpy()
    back = np.zeros_like(linked)
    for cell in np.unique(guest_home):
        back[np.ix_(guest_home == cell, (visited == cell).any(1))] = True
    counted = linked & (~back | (gid[:, None] < hid))
    to_guest, to_home = counted @ home["copies"].to_numpy(), counted.T @ guest["copies"].to_numpy()
    ids, sums = np.concatenate([gid, hid]), np.concatenate([to_guest, to_home])
    keep = sums > 0
    return pd.DataFrame({"a": np.concatenate([ids[keep], gid[r]]), "b": pd.array([None] * int(keep.sum()) + hid[c].tolist(), dtype="Int64"), "links": np.concatenate([sums[keep], np.zeros(len(r), np.int64)])})


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``embeddings`` (vec_id, embedding, label, any more columns).

    Only vectors of equal non-null label and equal length are compared. Vectors that are null, empty, zero or hold null or
    non-finite components, and those of a null label, link with nothing: n_links 0, component_id their own id. A vec_id names
    one vector: rows that repeat it with the same label and vector count once, and each is returned. A null vec_id links with
    nothing, has no component and is not kept. An empty table gives an empty one.
    """
    spark = embeddings.sparkSession
    width = embeddings.agg(F.max(F.size("embedding"))).first()[0] or 0
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))

    kind = "<f4" if embeddings.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"

    def packed(batches):
        for batch in batches:
            ok, x = vectors(batch.column("embedding"), width)
            ok &= batch.column("label").is_valid().to_numpy(zero_copy_only=False) & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            size = batch.column("embedding").value_lengths().fill_null(0)
            raw = [v.tobytes() if o else None for v, o in zip(x.astype(kind) + np.zeros(1, kind), ok, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), size.cast(pa.int32()), pa.array(raw, pa.binary())], ["vec_id", "label", "size", "vector"])

    loaded = rows.mapInArrow(packed, "vec_id long, label string, size int, vector binary").withColumn("key", F.md5("vector"))
    loaded = written(loaded, "vectors")
    once = loaded.where("vector is not null").groupBy("label", "size", "key", "vec_id").agg(F.first("vector").alias("vector"))
    groups = once.groupBy("label", "size", "key").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    nodes = written(groups.withColumn("group", F.monotonically_increasing_id()), "vector-groups")
    n = nodes.count()
    sample = [bytes(r[0]) for r in nodes.orderBy(F.xxhash64("key", "label"), "node").select("vector").limit(SAMPLE).collect()]
    alone = loaded.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if not sample or width < 2:
        return alone if width != 1 else _same_sign(loaded, nodes, np.dtype(kind).itemsize)
    held = spark.sparkContext.broadcast(fitted(_stacked(sample, width), n))

    def visiting(batches):
        index = held.value
        for batch in batches:
            if len(batch):
                x = _stacked(batch.column("vector").to_pylist(), width)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(index.cells(x)), pa.list_(pa.int64()))], [*batch.schema.names, "cells"])

    placed = nodes.select("label", "size", "group", "node", "copies", "vector").mapInArrow(visiting, "label string, size int, group long, node long, copies long, vector binary, cells array<long>")
    placed = written(placed.withColumn("own", F.element_at("cells", 1)), "placed")
    place = ["label", "size", "cell"]
    homes = placed.groupBy("label", "size", F.col("own").alias("cell")).agg(F.count("*").alias("n_home"))
    guests = placed.select("label", "size", "group", "own", F.explode("cells").alias("cell"))
    blocks = homes.join(guests.groupBy(*place).agg(F.count("*").alias("n_guest")), place)
    blocks = blocks.select(*place, F.ceil(F.col("n_home") / HOME_BLOCK).cast("int").alias("hs"), F.ceil(F.col("n_guest") / VISIT_BLOCK).cast("int").alias("gs"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # Ids learn the blocks of their cells, a crowded cell in many parts; then vectors meet their lists, once each.
    salted = guests.withColumn("salt", F.pmod(F.xxhash64("group", F.lit(3)), F.lit(SALTS)).cast("int"))
    lists = salted.join(blocks, [*place, "salt"]).groupBy("group").agg(F.collect_list(F.struct("cell", "hs", "gs", (F.col("cell") == F.col("own")).alias("at_home"))).alias("visits"))
    sent = placed.join(lists, "group").select("label", "size", "group", "node", "copies", "vector", "cells", "own", F.explode("visits").alias("v")).select("*", "v.cell", "v.hs", "v.gs", "v.at_home")
    part = lambda c, seed: F.pmod(F.xxhash64("group", F.lit(seed)), F.col(c)).cast("int")
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    as_guest = F.transform(every("hs"), lambda h: F.struct(F.lit(False).alias("home"), h.alias("h"), part("gs", 2).alias("g")))
    as_home = F.transform(every("gs"), lambda g: F.struct(F.lit(True).alias("home"), part("hs", 1).alias("h"), g.alias("g")))
    rows = sent.select(*place, "node", "copies", "vector", "cells", "own", F.explode(F.when(F.col("at_home"), F.concat(as_guest, as_home)).otherwise(as_guest)).alias("r"))
    rows = rows.select(*place, "r.*", "node", "copies", "vector", "own", F.when(F.col("r.home"), F.col("cells")).alias("cells"), F.lit(width).alias("wide"))
    met = written(rows.groupBy(*place, "h", "g").applyInPandas(_meet, "a long, b long, links long"), "met")
    dropped(placed)
    links = met.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    edges = met.where("b is not null").select("a", "b")
    # A vec_id that several vectors bear ties their groups together.
    ties = once.join(nodes.select("label", "size", "key", "node"), ["label", "size", "key"]).where("vec_id != node").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    shared = ties.join(nodes.select(F.col("node").alias("a")), "a", "left_semi").select("a", "b")
    return _joined(loaded, nodes, links, components(edges.unionAll(shared)))


def _joined(loaded: DataFrame, nodes: DataFrame, links: DataFrame, found: DataFrame) -> DataFrame:
    by_group = nodes.select("label", "size", "key", "node", "copies").join(links, "node", "left").join(found, "node", "left")
    by_group = by_group.select("label", "size", "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = loaded.select("vec_id", "label", "size", "key").join(by_group, ["label", "size", "key"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _same_sign(loaded: DataFrame, nodes: DataFrame, item: int) -> DataFrame:
    """Vectors of one component of so many bytes: the cosine is the product of their signs."""
    sign = nodes.withColumn("sign", F.substring(F.hex("vector"), 2 * item - 1, 1).isin(list("89ABCDEF")))
    total = sign.groupBy("label", "sign").agg(F.sum("copies").alias("all"), F.min("node").alias("component"))
    every = sign.join(total, ["label", "sign"])
    links = every.select("node", (F.col("all") - F.col("copies")).alias("links"))
    return _joined(loaded, nodes, links, every.select("node", "component"))
