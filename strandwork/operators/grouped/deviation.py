"""A28 for genes of very many rows: blocks of rows meet two by two, and no task holds all distances of a gene.

Of each round the quartiles of all pairs are exact: a pilot of some rows says in which ranges of values they should lie, all pairs are counted below and
inside those, and a gene whose quartiles lie elsewhere is counted again with ranges that hold everything. A row's median is held against the bound by how
many of its distances lie below and above all that the bound can be; rows that this leaves open are compared with all others again, with the bound known."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.operators.grouped.columns import GAP, span
from strandwork.operators.grouped.screening import block_distances
from strandwork.scratch import dropped, written

#: Rows of a block, rows that are compared with a block at once, rows of the pilot, and the part of all pairs on each side of a quartile that is counted by value.
BLOCK_ROWS, STEP_ROWS, PILOT_ROWS, BESIDE = 2048, 256, 1024, 0.03
QUARTILES = (0.25, 0.5, 0.75)
WINDOWS = [f"{side}{k}" for k in range(3) for side in ("lo", "hi")]
POWER = 2.0


def parts_of(rows: DataFrame) -> DataFrame:
    """gene, name and the texts whole, first and second: all of a row's data, and that before and from its middle letter on; else gaps."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            first, second = [], []
            for seq in pdf["seq"]:
                s, e = span(seq)
                places = [k for k in range(s, e) if seq[k] != GAP]
                middle = places[len(places) // 2] if places else s
                first.append(seq[:middle])
                second.append(GAP * middle + seq[middle:])
            yield pd.DataFrame({"gene": pdf["gene"], "name": pdf["name"], "whole": pdf["seq"], "first": first, "second": second})

    return rows.select("gene", "name", "seq").mapInPandas(run, "gene string, name string, whole string, first string, second string")


def _text(texts: list[str]) -> np.ndarray:
    width = max(map(len, texts), default=0)
    raw = "".join(t.ljust(width, GAP) for t in texts).encode("latin-1", "replace")
    return np.frombuffer(raw, np.uint8).reshape(len(texts), width)


def _steps(a: np.ndarray, b: np.ndarray, same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, powered distances) of rows of ``a`` with all of ``b``; if both are ``same``, NaN for a row and itself."""
    for i in range(0, len(a), STEP_ROWS):
        width = min(a.shape[1], b.shape[1])
        d = block_distances(a[i : i + STEP_ROWS, :width], b[:, :width])
        if same:
            d[np.arange(len(d)), i + np.arange(len(d))] = np.nan
        yield i, np.power(d, POWER, out=d)


def _bounds(lo: list[float], hi: list[float], floor: float, times: float) -> tuple[float, float]:
    """What the bound can be at least and at most where the quartiles lie in [lo, hi]."""
    least = max(lo[1] + times * max(0.0, lo[2] - hi[0]), floor) if all(map(math.isfinite, (*lo, *hi))) else -1.0
    most = max(hi[1] + times * (hi[2] - lo[0]), floor)
    # A little wider than both, as sums of the exact bound may round otherwise.
    return least - abs(least) * 1e-9, most + abs(most) * 1e-9


def _pilot(pdf: pd.DataFrame) -> pd.DataFrame:
    text = _text(pdf["seq"].tolist())
    d = np.concatenate([x[~np.isnan(x)] for _, x in _steps(text, text, True)])
    d.sort()
    out = []
    for p in QUARTILES:
        at = [math.floor((len(d) - 1) * (p - BESIDE)), math.ceil((len(d) - 1) * (p + BESIDE))]
        out += [float(d[k]) for k in at] if len(d) else [-1.0, float("inf")]
    return pd.DataFrame([(pdf["gene"].iloc[0], *out)], columns=["gene", *WINDOWS])


def _counting(floor: float, times: float):
    """Of two blocks that meet: kind 0, values inside the ranges; kind 1, how many lie below each range (uid 0 to 2), and all (3); kind 2, for each
    row how many of its distances lie below and above what the bound can be, and all."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        a, b = (pdf[pdf["block"] == k] for k in (i, j))
        lo, hi = ([float(pdf[f"{side}{k}"].iloc[0]) for k in range(3)] for side in ("lo", "hi"))
        least, most = _bounds(lo, hi, floor, times)
        x = _text(a["seq"].tolist())
        y = x if i == j else _text(b["seq"].tolist())
        own, other = np.zeros((len(a), 3), np.int64), np.zeros((len(b), 3), np.int64)
        below, values, counts = np.zeros(4, np.int64), [], []
        for k, d in _steps(x, y, i == j):
            some, under, over = ~np.isnan(d), d <= least, d > most
            for c, m in enumerate((under, over, some)):
                own[k : k + len(d), c] += m.sum(1)
                other[:, c] += m.sum(0)
            if i == j:  # each pair once
                d[np.arange(len(y)) <= (k + np.arange(len(d)))[:, None]] = np.nan
            inside = np.zeros(d.shape, bool)
            for c in range(3):
                below[c] += (d < lo[c]).sum()
                inside |= (d >= lo[c]) & (d <= hi[c])
            below[3] += (~np.isnan(d)).sum()
            v, n = np.unique(d[inside], return_counts=True)
            values.append(v)
            counts.append(n)
        v, at = np.unique(np.concatenate(values), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts), len(v)).astype(np.int64)
        ids, mine = (a["uid"].to_numpy(), own) if i == j else (np.concatenate([a["uid"], b["uid"]]), np.concatenate([own, other]))
        made = [(0, np.zeros(len(v), np.int64), v, n, 0, 0), (1, np.arange(4), 0.0, below, 0, 0), (2, ids, 0.0, mine[:, 2], mine[:, 0], mine[:, 1])]
        out = pd.concat([pd.DataFrame({"kind": k, "uid": u, "value": w, "n": c, "under": s, "over": g}) for k, u, w, c, s, g in made])
        out.insert(0, "gene", pdf["gene"].iloc[0])
        return out

    return run


def _quartile(values: np.ndarray, upto: np.ndarray, below: int, total: int, lo: float, hi: float, p: float) -> float:
    """As np.percentile() gives it, from values inside [lo, hi] and how many lie below; NaN where it lies elsewhere."""
    at = (total - 1) * p
    first = np.searchsorted(values, lo)
    before = upto[first - 1] if first else 0
    end = np.searchsorted(values, hi, "right")
    inside = (upto[end - 1] if end else 0) - before
    pair = []
    for k in (math.floor(at), math.floor(at) + (at > math.floor(at))):
        if not below <= k < below + inside:
            return float("nan")
        pair.append(float(values[np.searchsorted(upto, before + k - below, "right")]))
    t, (a, b) = at - math.floor(at), pair
    return b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t


def _bound(floor: float, times: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = ([float(pdf[f"{side}{k}"].iloc[0]) for k in range(3)] for side in ("lo", "hi"))
        inside = pdf[pdf["kind"] == 0].sort_values("value")
        values, upto = inside["value"].to_numpy(), np.cumsum(inside["n"].to_numpy())
        count = pdf[pdf["kind"] == 1].set_index("uid")["n"]
        total = int(count[3])
        q = [_quartile(values, upto, int(count[k]), total, lo[k], hi[k], p) for k, p in enumerate(QUARTILES)] if total else []
        bound = max(q[1] + times * (q[2] - q[0]), floor) if total and not any(map(math.isnan, q)) else None
        least, most = _bounds(lo, hi, floor, times)
        return pd.DataFrame([(pdf["gene"].iloc[0], bound, least, most, total)], columns=["gene", "bound", "least", "most", "total"])

    return run


def _settled(pdf: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Open rows with a block of rows: how many distances lie at the bound or below and above it, the highest of those and the lowest of these."""
    if not len(pdf) or not len(rows):
        return pd.DataFrame(columns=["uid", "under", "over", "top", "low"])
    bound = float(pdf["bound"].iloc[0])
    out = []
    x, y = _text(pdf["seq"].tolist()), _text(rows["seq"].tolist())
    ids, others = pdf["uid"].to_numpy(), rows["uid"].to_numpy()
    for k, d in _steps(x, y, False):
        d[ids[k : k + len(d), None] == others] = np.nan
        for uid, own in zip(ids[k : k + len(d)].tolist(), d, strict=True):
            under, over = own[own <= bound], own[own > bound]
            out.append((uid, len(under), len(over), float(under.max()) if len(under) else None, float(over.min()) if len(over) else None))
    return pd.DataFrame(out, columns=["uid", "under", "over", "top", "low"])


def deviating_in_blocks(rows: DataFrame, floor: float, times: float, rounds: int) -> DataFrame:
    """deviating_rows() for rows (gene, name, seq), genes of any size: uid-free gene and name of the rows that go in one of the rounds."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same = lambda own: F.col("gene").eqNullSafe(F.col(own))
    data = rows.where(F.translate("seq", GAP, "") != "").select("gene", "name", F.rtrim(F.col("seq"), F.lit(GAP)).alias("seq"))
    left = written(data.withColumn("uid", F.monotonically_increasing_id()), "deviation-rows")
    gone = None
    for _ in range(rounds):
        # Blocks are of rows of like length, so that short ones don't wait for long ones; only numbers are sorted by gene.
        sizes = left.groupBy(F.col("gene").alias("__gene")).agg(F.count("*").alias("__rows"))
        place = F.row_number().over(Window.partitionBy("gene").orderBy(F.length("seq"), "uid")) - 1
        places = left.select("gene", "uid", F.floor(place / BLOCK_ROWS).cast("int").alias("block")).select(F.col("uid").alias("__uid"), "block")
        blocks = F.ceil(F.col("__rows") / BLOCK_ROWS).cast("int")
        known = written(left.join(places, F.col("uid") == F.col("__uid")).join(sizes, same("__gene")).select("gene", "uid", "name", "seq", "block", blocks.alias("blocks")), "deviation-blocks")
        pilot = known.withColumn("__k", F.row_number().over(Window.partitionBy("gene").orderBy(F.xxhash64("uid"), "uid"))).where(F.col("__k") <= PILOT_ROWS).select("gene", "seq")
        windows = written(pilot.repartition(n, "gene").groupBy("gene").applyInPandas(_pilot, "gene string, " + ", ".join(f"{w} double" for w in WINDOWS)), "deviation-pilot")

        def counted(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
            own = windows.select(F.col("gene").alias("__gene"), *WINDOWS)
            met = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
            pairs = known.join(own, same("__gene")).select("gene", "uid", "seq", "block", *WINDOWS, F.inline(met))
            # As many partitions as pairs of blocks need: they are long to work on.
            found = pairs.repartition(max(n, 256), "gene", "i", "j").groupBy("gene", "i", "j").applyInPandas(_counting(floor, times), "gene string, kind int, uid long, value double, n long, under long, over long")
            found = written(found, "deviation-counts")
            total = found.where("kind < 2").groupBy("gene", "kind", "uid", "value").agg(F.sum("n").alias("n")).join(own, same("__gene")).drop("__gene")
            bounds = total.repartition(n, "gene").groupBy("gene").applyInPandas(_bound(floor, times), "gene string, bound double, least double, most double, total long")
            return found, written(bounds, "deviation-bounds")

        found, bounds = counted(windows)
        missed = bounds.where("bound is null and total > 0").select("gene")
        if not missed.isEmpty():
            whole = windows.join(missed.select(F.col("gene").alias("__gene")), same("__gene"), "left_semi").select("gene", *[F.lit(-1.0 if w[:2] == "lo" else float("inf")).alias(w) for w in WINDOWS])
            again, more = counted(whole)
            found = found.join(more.select(F.col("gene").alias("__gene")), same("__gene"), "left_anti").unionByName(again)
            bounds = bounds.where("bound is not null").unionByName(more)
        half = F.floor(F.col("n") / 2)
        votes = found.where("kind = 2").groupBy("uid").agg(*[F.sum(c).alias(c) for c in ("n", "under", "over")]).where("n > 0")
        judged = known.join(votes.withColumnRenamed("uid", "__uid"), F.col("uid") == F.col("__uid")).join(bounds.where("bound is not null").select(F.col("gene").alias("__gene"), "bound"), same("__gene"))
        judged = written(judged.select("gene", "uid", "name", "seq", "blocks", "bound", F.when(F.col("over") > half, True).when(F.col("under") > half, False).alias("bad")), "deviation-judged")
        open_ = judged.where("bad is null")
        parts = open_.select("gene", "uid", "seq", "bound", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).select(*[F.col(c).alias(c) for c in ("gene", "uid", "seq", "bound", "block")])
        keyed = lambda df: df.repartition(n, "gene", "block").groupBy("gene", "block")
        told = keyed(parts).cogroup(keyed(known.select("gene", "uid", "seq", "block"))).applyInPandas(_settled, "uid long, under long, over long, top double, low double")
        told = told.groupBy("uid").agg(F.sum("under").alias("under"), F.sum("over").alias("over"), F.max("top").alias("top"), F.min("low").alias("low"))
        # The middle two may lie on both sides of the bound.
        met = told.join(open_.select(F.col("uid").alias("__uid"), "bound"), F.col("uid") == F.col("__uid")).where((F.col("over") > F.col("under")) | ((F.col("over") == F.col("under")) & ((F.col("top") + F.col("low")) / 2 > F.col("bound")))).select("uid")
        bad = written(judged.where("bad").select("uid").unionByName(met), "deviation-gone")
        out = left.join(bad, "uid", "left_semi").select("gene", "name")
        gone = out if gone is None else gone.unionByName(out)
        if bad.isEmpty():
            break
        left = written(left.join(bad, "uid", "left_anti"), "deviation-left")
        dropped(known, windows)
    return gone
