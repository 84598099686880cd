"""Screening the rows of a gene against its references."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.functions.blosum import SCORES, UNKNOWN, blosum62_distance, codes
from strandwork.functions.msa import data_end, data_start
from strandwork.operators.grouped.columns import GAP, Counts, Row, consensus, letters, reference_counts, span
from strandwork.operators.grouped.trimming import average_match
from strandwork.operators.outliers import gap_free_distance
from strandwork.scratch import written

Distance = Callable[[str, str], float]


def midpoint(values: list[float], p: float) -> float:
    """The mean of the elements at the floor and the ceiling of (n - 1) p."""
    v = sorted(values)
    at = (len(v) - 1) * p
    return (v[math.floor(at)] + v[math.ceil(at)]) / 2


def distance_outliers(rows: list[Row], references: list[Row], times: float = 1.75, floor: float = 0.02, least_columns: int = 10, least_share: float = 0.33, data: float = 0.5, distance: Distance = blosum62_distance) -> dict[str, dict]:
    """G11 and A26. Of each row its statistic, bound and grade ("pass", "fail" or "unscored").

    Rows of one span are judged together, over that span. References need ``data`` of it filled, and max(2, ``least_share`` of all) must
    be left; the bound is q3 + times * max(q3 - q1, floor) of their distances to each other (midpoint quartiles). A row's
    statistic is the median of its distances to them and one 0. Spans of fewer than ``least_columns`` columns are not scored.
    """
    out: dict[str, dict] = {}
    spans: dict[tuple[int, int], list[Row]] = {}
    for r in sorted(rows, key=lambda r: (r.start, r.end, r.name)):
        spans.setdefault((r.start, r.end), []).append(r)
    for (s, e), group in spans.items():
        known = [r for r in references if e > s and sum(c != GAP for c in r.seq[s:e]) >= data * (e - s)]
        if e - s < least_columns or len(known) < max(2, least_share * len(references)):
            out |= {r.name: {"statistic": None, "bound": None, "grade": "unscored"} for r in group}
            continue
        pairs = [distance(a.seq[s:e], b.seq[s:e]) for i, a in enumerate(known) for b in known[i + 1 :] if a.name[:-8] != b.name[:-8] or len(a.name) <= 8]
        pairs = [d for d in pairs if d == d]
        bound = None
        if pairs:
            q1, q3 = midpoint(pairs, 0.25), midpoint(pairs, 0.75)
            bound = q3 + times * max(q3 - q1, floor)
        for r in group:
            own = [d for d in (distance(r.seq[s:e], k.seq[s:e]) for k in known) if d == d]
            value = float(np.median([*own, 0.0])) if own else None
            grade = "unscored" if bound is None or value is None else "pass" if value <= bound else "fail"
            out[r.name] = {"statistic": value, "bound": bound, "grade": grade}
    return out


def profile_filter(rows: list[dict], references: list[str], least: float = 0.3, same_read: float = 0.8, ratio: float = 1.15, overlap: float = 0.6) -> list[str]:
    """G18. Names of rows (name, read, seq, score) that go: below ``least`` of average match; of one read, overlapping a better
    one by ``same_read``; beaten ``ratio`` times by a kept row that covers ``overlap`` of them. In order of score, ties by name."""
    counts = Counts.of(references)
    bad = [average_match(r["seq"], counts) < least for r in rows]
    left = [(r["name"], r["read"], *span(r["seq"]), r["score"]) for r, b in zip(rows, bad, strict=True) if not b]
    return sorted([r["name"] for r, b in zip(rows, bad, strict=True) if b] + beaten_rows(left, same_read, ratio, overlap))


class _Widest:
    """Spans, less those that lie inside another one: none of these overlaps any range more than the others do."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []  # both ascend

    def add(self, s: int, e: int) -> None:
        at = bisect_right(self.starts, s)
        if at and self.ends[at - 1] >= e:
            return
        lo = bisect_left(self.starts, s)
        hi = bisect_right(self.ends, e, lo)
        self.starts[lo:hi], self.ends[lo:hi] = [s], [e]

    def most(self, s: int, e: int) -> float:
        """The largest of the overlaps with [s, e), negative where all lie apart; the places between if so."""
        return max((min(e, b) - max(s, a) for a, b in zip(self.starts, self.ends, strict=True)), default=float("-inf"))


def beaten_rows(rows: list[tuple], same_read: float = 0.8, ratio: float = 1.15, overlap: float = 0.6) -> list[str]:
    """G18 for (name, read, start, end, score): names of the rows that a better one of their read or a much better one at their place beats."""
    gone: list[str] = []
    reads: dict = {}
    better, waiting = _Widest(), deque()  # of kept rows, those that beat the next ones' scores, and those that may beat later ones
    for name, read, s, e, score in sorted(rows, key=lambda r: (-r[4], r[0])):
        while waiting and score > 0 and waiting[0][2] / score >= ratio:
            better.add(*waiting.popleft()[:2])
        size = max(1, e - s)
        own = reads.get(read)
        if (own is not None and own.most(s, e) / size >= same_read) or (score > 0 and better.most(s, e) / size >= overlap):
            gone.append(name)
            continue
        reads.setdefault(read, _Widest()).add(s, e)
        waiting.append((s, e, score))
    return sorted(gone)


def ambiguous_nodes(hits: list[dict], cluster_genes: set[str], ratio: float = 1.1) -> list[str]:
    """W7. Of one node's hits (gene, score, uid) of several genes the uids that go: all but the best gene's if its score is
    ``ratio`` times the next gene's; else all but those of genes with clusters of their own."""
    best: dict[str, float] = {}
    for h in hits:
        best[h["gene"]] = max(best.get(h["gene"], 0.0), h["score"])
    if len(best) < 2:
        return []
    order = sorted(best, key=lambda g: (-best[g], g))
    keep = {order[0]} if best[order[1]] <= 0 or best[order[0]] / best[order[1]] >= ratio else cluster_genes & set(best)
    return sorted(h["uid"] for h in hits if h["gene"] not in keep)


def ambiguous_regions(rows: list[Row], share: float, join: int = 0) -> list[tuple[int, int]]:
    """W12. Runs of columns where gaps inside spans hold at least ``share`` of the votes, but not all of them."""
    m = letters(rows)
    flags = []
    for k in range(m.shape[1]):
        votes = [(chr(c), r.weight) for r, c in zip(rows, m[:, k], strict=True) if r.start <= k < r.end]
        total = sum(w for _, w in votes)
        gaps = sum(w for c, w in votes if c == GAP)
        flags.append(bool(total) and share <= gaps / total < 1)
    out: list[tuple[int, int]] = []
    for k, f in enumerate(flags):
        if f:
            if out and k - out[-1][1] <= join:
                out[-1] = (out[-1][0], k + 1)
            else:
                out.append((k, k + 1))
    return out


def severe_rows(rows: list[Row], threshold: float = 0.5, floor: float = 0.2, times: float = 1.5) -> list[str]:
    """A29. Names of rows whose distance to the consensus lies above max(q3 + times * (q3 - q1), floor), linear quartiles."""
    agreed = consensus(rows, threshold)
    d = {r.name: gap_free_distance(r.seq, agreed) for r in rows}
    known = [x for x in d.values() if x == x]
    if not known:
        return []
    q1, q3 = np.percentile(known, [25, 75])
    return sorted(n for n, x in d.items() if x == x and x > max(q3 + times * (q3 - q1), floor))


#: Rows of a block that are compared with all others at once.
BLOCK = 256


def _all_distances(text: np.ndarray) -> np.ndarray:
    """blosum62_distance() of every two rows [row, column] of code points, NaN where nothing is common: sums of scores as matrix products of whole
    numbers, one block of rows against all. Single precision holds them exactly up to 2^24 / 11 columns."""
    n, width = text.shape
    kinds = [c for c in np.unique(text).tolist() if SCORES[c, c] > UNKNOWN]
    out = np.full((n, n), np.nan)
    if not kinds:
        return out
    number = np.full(256, len(kinds), np.int64)
    number[kinds] = np.arange(len(kinds))
    code = number[text]
    table = np.zeros((len(kinds) + 1, len(kinds) + 1), np.float32)
    table[:-1, :-1] = SCORES[np.ix_(kinds, kinds)]
    data = (code < len(kinds)).astype(np.float32)
    own = table[code, code]  # the score of each letter with itself
    for i in range(0, n, BLOCK):
        part = code[i : i + BLOCK]
        both = sum((table[part, c] @ (code == c).astype(np.float32).T for c in range(len(kinds))), np.zeros((len(part), n), np.float32))
        whole = own[i : i + BLOCK] @ data.T + data[i : i + BLOCK] @ own.T
        with np.errstate(invalid="ignore", divide="ignore"):
            # Letters score above 0 with themselves, so the sum is 0 only where nothing is common.
            out[i : i + BLOCK] = np.where(whole > 0, np.maximum(0.0, 1 - 2 * both.astype(np.float64) / whole), np.nan)
    return out


def deviating_rows(rows: list[Row], floor: float = 0.03, times: float = 1.0, rounds: int = 3, least: int = 0, power: float = 2.0, distance: Distance = blosum62_distance, part: dict[str, tuple[int, int]] | None = None) -> list[str]:
    """A28. In up to ``rounds`` rounds, names of rows whose median distance to the others, to the given power, lies above
    max(median + times * (q3 - q1), floor) of all pairs' (linear quartiles). Pairs are compared where both have data spans; rows of
    fewer than ``least`` letters, and rows that meet no other, are not judged. ``part`` limits each row to a range of its columns."""
    spans = {r.name: part[r.name] if part else (r.start, r.end) for r in rows}
    data = lambda r: (lambda t: len(t) - t.count(GAP))(r.seq[slice(*spans[r.name])])
    left = sorted((r for r in rows if data(r) >= max(1, least)), key=lambda r: r.name)
    if not left:
        return []
    if distance is blosum62_distance:
        width = max(len(r.seq) for r in left)
        text = np.full((len(left), width), ord(GAP), np.uint8)
        for k, r in enumerate(left):
            s, e = spans[r.name]
            text[k, s:e] = codes(r.seq[s:e])
        d = _all_distances(text)
    else:
        d = np.full((len(left), len(left)), np.nan)
        text_of = [codes(r.seq) for r in left]
        for i, a in enumerate(left):
            for j in range(i + 1, len(left)):
                s, e = max(spans[a.name][0], spans[left[j].name][0]), min(spans[a.name][1], spans[left[j].name][1])
                d[i, j] = d[j, i] = distance(text_of[i][s:e], text_of[j][s:e]) if e > s else np.nan
    np.fill_diagonal(d, np.nan)
    np.power(d, power, out=d)
    gone: list[str] = []
    names = np.array([r.name for r in left], object)
    for _ in range(rounds):
        values = np.concatenate([own[i + 1 :] for i, own in enumerate(d)]) if len(d) else np.zeros(0)
        values = values[~np.isnan(values)]
        if not len(values):
            break
        q1, middle, q3 = np.percentile(values, [25, 50, 75])
        del values
        bound = max(middle + times * (q3 - q1), floor)
        bad = np.array([bool(len(own)) and np.median(own) > bound for own in (x[~np.isnan(x)] for x in d)])
        if not bad.any():
            break
        gone += names[bad].tolist()
        names, d = names[~bad], d[np.ix_(~bad, ~bad)]
    return sorted(gone)


def deviating_halves(rows: list[Row], **options) -> dict[str, str]:
    """A28. The half ("first" or "second" of its data, by letters) in which a row deviates: the second is judged among rows that pass the first."""
    halves = {}
    for r in rows:
        places = [k for k in range(r.start, r.end) if r.seq[k] != GAP]
        middle = places[len(places) // 2] if places else r.start
        halves[r.name] = ((r.start, middle), (middle, r.end))
    out = {n: "first" for n in deviating_rows(rows, part={n: h[0] for n, h in halves.items()}, **options)}
    stay = [r for r in rows if r.name not in out]
    return out | {n: "second" for n in deviating_rows(stay, part={n: h[1] for n, h in halves.items()}, **options)}


def best_isoform(isoforms: list[Row], group: list[str]) -> str | None:
    """G25. The isoform that most rows of the alignment agree with, column by column; ties: more letters, then the name."""
    counts = reference_counts(group)
    score = lambda r: sum(counts[k].get(c, 0) for k, c in enumerate(r.seq) if c != GAP and k < len(counts))
    return min(isoforms, key=lambda r: (-score(r), -r.data(), r.name)).name if isoforms else None


def _places(texts: list[str], width: int) -> np.ndarray:
    """[row, place] code points of texts, padded with gaps."""
    out = np.full((len(texts), width), ord(GAP), np.uint8)
    for k, t in enumerate(texts):
        own = codes(t)[:width]
        out[k, : len(own)] = own
    return out


def block_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """blosum62_distance() of every row of ``a`` with every row of ``b`` (code points, of one width): the sums of _all_distances()."""
    out = np.full((len(a), len(b)), np.nan)
    kinds = [c for c in np.union1d(a, b).tolist() if SCORES[c, c] > UNKNOWN]
    if not kinds:
        return out
    number = np.full(256, len(kinds), np.int64)
    number[kinds] = np.arange(len(kinds))
    table = np.zeros((len(kinds) + 1, len(kinds) + 1), np.float32)
    table[:-1, :-1] = SCORES[np.ix_(kinds, kinds)]
    x, y = number[a], number[b]
    both, whole = np.zeros(out.shape, np.float32), np.zeros(out.shape, np.float32)
    for c in range(len(kinds)):
        both += table[x, c] @ (y == c).astype(np.float32).T
    whole += table[x, x] @ (y < len(kinds)).astype(np.float32).T + (x < len(kinds)).astype(np.float32) @ table[y, y].T
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(whole > 0, np.maximum(0.0, 1 - 2 * both.astype(np.float64) / whole), out)


#: References, and rows, of a block of screened(), and spans that are looked up at once.
SCREEN_REFERENCES, SCREEN_ROWS, SCREEN_SPANS = 1024, 256, 4096


def counted_midpoint(values: np.ndarray, count: np.ndarray, p: float) -> float:
    """midpoint() of ascending values that occur so often."""
    upto = np.cumsum(count)
    at = (int(upto[-1]) - 1) * p
    pick = lambda k: float(values[np.searchsorted(upto, k, "right")])
    return (pick(math.floor(at)) + pick(math.ceil(at))) / 2


def screened(rows: DataFrame, references: DataFrame, times: float = 1.75, distance: Distance = blosum62_distance, floor: float = 0.02, least_columns: int = 10, least_share: float = 0.33, data: float = 0.5) -> DataFrame:
    """distance_outliers() for rows and references (gene, name, seq): gene, name, statistic, bound, grade.

    Blocks of references count for which spans of their gene's rows they have enough data. Only spans that enough of them fill are scored: blocks of those
    references meet two by two and tell how often each distance occurs, from which the quartiles come, and blocks of rows meet them all."""
    kind = rows.schema["gene"].dataType.simpleString()
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same = lambda own: F.col("gene").eqNullSafe(F.col(own))
    known = references.select(F.col("gene").alias("gene"), F.col("name").alias("name"), F.col("seq").alias("seq"))
    s, e = data_start(F.col("seq")), data_end(F.col("seq"))
    own = rows.select("gene", "name", "seq", *[F.when(e > s, x).otherwise(0).cast("int").alias(c) for c, x in (("start", s), ("end", e))])

    # How many references have enough data on each span, by blocks of references.
    sizes = known.groupBy(F.col("gene").alias("__gene")).agg(F.count("*").alias("__all"), F.ceil(F.count("*") / SCREEN_REFERENCES).cast("int").alias("__blocks"))
    spans = own.where(F.col("end") - F.col("start") >= least_columns).groupBy("gene").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    dealt = spans.join(sizes, same("__gene")).select("gene", "spans", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("block"))
    dealt = dealt.select(*[F.col(c).alias(c) for c in dealt.columns])  # columns of its own: both sides may come from the same table
    parts = known.join(sizes, same("__gene")).select("gene", "seq", F.pmod(F.xxhash64("name", "seq"), F.col("__blocks")).cast("int").alias("block"))

    def fill(refs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(refs) or not len(asked):
            return pd.DataFrame(columns=["gene", "start", "end", "n"])
        at = np.array([(x["start"], x["end"]) for x in asked["spans"].iloc[0]], np.int64).reshape(-1, 2)
        m = _places(refs["seq"].tolist(), int(at[:, 1].max())) != ord(GAP)
        upto = np.concatenate([np.zeros((len(m), 1), np.int32), np.cumsum(m, 1, dtype=np.int32)], 1)
        count = np.concatenate([(upto[:, x[:, 1]] - upto[:, x[:, 0]] >= data * (x[:, 1] - x[:, 0])).sum(0) for x in (at[i : i + SCREEN_SPANS] for i in range(0, len(at), SCREEN_SPANS))])
        some = count > 0
        if not some.any():
            return pd.DataFrame(columns=["gene", "start", "end", "n"])
        return pd.DataFrame({"gene": [asked["gene"].iloc[0]] * int(some.sum()), "start": at[some, 0], "end": at[some, 1], "n": count[some]})

    found = parts.repartition(n, "gene", "block").groupBy("gene", "block").cogroup(dealt.repartition(n, "gene", "block").groupBy("gene", "block")).applyInPandas(fill, f"gene {kind}, start int, end int, n long")
    filled = found.groupBy("gene", "start", "end").agg(F.sum("n").alias("n"))
    enough = filled.join(sizes, same("__gene")).where(F.col("n") >= F.greatest(F.lit(2.0), least_share * F.col("__all")))
    scored = written(enough.select("gene", "start", "end", F.ceil(F.col("n") / SCREEN_REFERENCES).cast("int").alias("blocks")), "scored-spans")

    # The references of each such span, cut to it.
    at = [F.col(c).alias(f"__{c}") for c in ("gene", "start", "end", "blocks")]
    text = F.substring(F.col("seq"), F.col("__start") + 1, F.col("__end") - F.col("__start"))
    cut = known.join(scored.select(*at), same("__gene")).withColumn("text", text).where(F.length(F.translate("text", GAP, "")) >= data * (F.col("__end") - F.col("__start")))
    cut = written(cut.select("gene", F.col("__start").alias("start"), F.col("__end").alias("end"), "name", "text", "__blocks", F.pmod(F.xxhash64("name", "seq"), F.col("__blocks")).cast("int").alias("block")), "scored-references")

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        a, b = (pdf[pdf["block"] == k] for k in (i, j))
        size = int(pdf["end"].iloc[0] - pdf["start"].iloc[0])
        if distance is blosum62_distance:
            d = block_distances(_places(a["text"].tolist(), size), _places(b["text"].tolist(), size))
        else:
            d = np.array([[distance(x, y) for y in b["text"]] for x in a["text"]], float).reshape(len(a), len(b))
        root = lambda own: np.unique([x[:-8] for x in [*a["name"], *b["name"]]], return_inverse=True)[1][own]
        long = lambda own: (own["name"].str.len() > 8).to_numpy()
        d[(root(slice(0, len(a)))[:, None] == root(slice(len(a), None))) & long(a)[:, None] & long(b)] = np.nan
        d = d[np.triu_indices(len(a), 1)] if i == j else d.ravel()
        values, count = np.unique(d[~np.isnan(d)], return_counts=True)
        if not len(values):
            return pd.DataFrame(columns=["gene", "start", "end", "value", "n"])
        return pd.DataFrame({"gene": [pdf["gene"].iloc[0]] * len(values), "start": int(pdf["start"].iloc[0]), "end": int(pdf["end"].iloc[0]), "value": values, "n": count})

    # Block b meets itself and all others: (i, j) with i <= j.
    met = F.transform(F.sequence(F.lit(0), F.col("__blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    pair = cut.select("gene", "start", "end", "name", "text", "block", F.inline(met))
    keys = ["gene", "start", "end"]
    counts = pair.repartition(n, *keys, "i", "j").groupBy(*keys, "i", "j").applyInPandas(pairs, f"gene {kind}, start int, end int, value double, n long").groupBy(*keys, "value").agg(F.sum("n").alias("n"))

    def bound_of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("value")
        q1, q3 = (counted_midpoint(pdf["value"].to_numpy(), pdf["n"].to_numpy(), p) for p in (0.25, 0.75))
        return pd.DataFrame([(pdf["gene"].iloc[0], int(pdf["start"].iloc[0]), int(pdf["end"].iloc[0]), q3 + times * max(q3 - q1, floor))], columns=[*keys, "bound"])

    bounds = counts.groupBy(*keys).applyInPandas(bound_of, f"gene {kind}, start int, end int, bound double")

    # Rows of those spans, in blocks, with all references of their span.
    on = lambda: same("__gene") & (F.col("start") == F.col("__start")) & (F.col("end") == F.col("__end"))
    judged = own.join(scored.select(*at), on(), "left_semi")
    many = judged.groupBy(*[F.col(c).alias(f"__{c}") for c in keys]).agg(F.ceil(F.count("*") / SCREEN_ROWS).cast("int").alias("__rows"))
    mine = judged.join(many, on()).withColumn("block", F.pmod(F.xxhash64("name", "seq"), F.col("__rows")).cast("int")).select(*keys, "block", "name", F.substring(F.col("seq"), F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))
    others = cut.join(many, on()).select(*keys, "text", F.explode(F.sequence(F.lit(0), F.col("__rows") - 1)).alias("block"))
    others = others.select(*[F.col(c).alias(c) for c in others.columns])

    def judge(pdf: pd.DataFrame, refs: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["gene", "start", "end", "name", "statistic"])
        size = int(pdf["end"].iloc[0] - pdf["start"].iloc[0])
        if distance is blosum62_distance:
            d = block_distances(_places(pdf["text"].tolist(), size), _places(refs["text"].tolist(), size))
        else:
            d = np.array([[distance(x, y) for y in refs["text"]] for x in pdf["text"]], float).reshape(len(pdf), len(refs))
        value = [float(np.median(np.append(x, 0.0))) if len(x) else None for x in (x[~np.isnan(x)] for x in d)]
        return pd.DataFrame({"gene": pdf["gene"], "start": pdf["start"], "end": pdf["end"], "name": pdf["name"], "statistic": value})

    keyed = lambda df: df.repartition(n, *keys, "block").groupBy(*keys, "block")
    statistic = keyed(mine).cogroup(keyed(others)).applyInPandas(judge, f"gene {kind}, start int, end int, name string, statistic double")
    ends = [F.col(c).alias(f"__{c}") for c in keys]
    result = statistic.join(bounds.select(*ends, "bound"), on(), "left")
    grade = F.when(F.col("bound").isNull() | F.col("statistic").isNull(), "unscored").when(F.col("statistic") <= F.col("bound"), "pass").otherwise("fail")
    none = own.join(scored.select(*at), on(), "left_anti").select("gene", "name", F.lit(None).cast("double").alias("statistic"), F.lit(None).cast("double").alias("bound"), F.lit("unscored").alias("grade"))
    return none.unionByName(result.select("gene", "name", "statistic", "bound", grade.alias("grade")))
