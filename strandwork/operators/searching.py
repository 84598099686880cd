"""E. Search of proteins against references: shared seeds, grouped by diagonal, extended by BLOSUM62, with bit scores and E-values.

1. Seeds are runs of k of the twenty letters, packed into numbers by Arrow batches; those of few different letters are masked, that is, they
   start no hit (extensions still pass over them).
2. Reads and targets meet by seed. A seed whose pairs are many is dealt into parts, the reads' side by node, so no key is a task's worth by itself.
3. Pairs are counted by diagonal in the JVM; diagonals of a read and target that lie near one another are one candidate.
4. Candidates with their letters come to Arrow batches: ungapped X-drop extension from the first seed of the richest diagonal; what reaches the
   trigger is aligned in a band around its diagonals with affine gaps. Only the stretch of a read that the band can reach is sent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions.blosum import LETTERS, SCORES, UNKNOWN
from strandwork.scratch import written

# Published statistics of gapped alignments under BLOSUM62 with gaps of 11 to open and 1 for each letter.
LAMBDA, KAPPA = 0.267, 0.041
GAP_OPEN, GAP_LETTER = 11, 1
#: Score of a letter that is none of the twenty, with any.
OTHER = -4
#: Hot seeds up to this number are broadcast; more are joined like any table.
MOST_BROADCAST = 100_000


@dataclass(frozen=True)
class Seeding:
    k: int = 5
    #: Different letters that a seed has at least.
    least_letters: int = 3
    #: Pairs of one seed that stay in one part.
    part_pairs: int = 1 << 18
    #: Diagonals so near are one candidate, which needs so many seeds.
    near: int = 16
    least_seeds: int = 2


@dataclass(frozen=True)
class Extension:
    #: An ungapped extension ends where its score falls so far below its best; from the trigger on gaps are tried.
    drop: int = 16
    trigger: int = 30
    #: Diagonals of the band beyond those of the candidate.
    pad: int = 24
    most_evalue: float = 1e-3
    #: Candidates aligned side by side.
    batch: int = 256


_CODE = np.full(256, len(LETTERS), np.int64)
_CODE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def _numbers(text: bytes) -> np.ndarray:
    return _CODE[np.frombuffer(text, np.uint8)]


def packed_seeds(text: bytes, k: int, least_letters: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, seeds) of a text: k letters as a number to the base 32, without those that hold another letter or are masked."""
    code = _numbers(text)
    n = len(code) - k + 1
    if n <= 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    packed, letters, good = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(k):
        own = code[j : j + n]
        packed = packed << 5 | own
        letters |= np.int64(1) << own
        good &= own < len(LETTERS)
    good &= np.bitwise_count(letters) >= least_letters
    at = np.flatnonzero(good)
    return at.astype(np.int32), packed[at]


def seeds(rows: DataFrame, text: str, params: Seeding = Seeding()) -> DataFrame:
    """Rows' other columns with ``at`` and ``seed`` of each seed of their text."""
    keys = [c for c in rows.columns if c != text]
    k, least = params.k, params.least_letters
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys) + ", at int, seed long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                found = [packed_seeds(t or b"", k, least) for t in part.column("__t").to_pylist()]
                which = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                again = part.select(keys).take(pa.array(which)) if keys else None
                at, seed = (np.concatenate([f[j] for f in found]) for j in (0, 1))
                yield pa.RecordBatch.from_arrays([*again.columns, pa.array(at), pa.array(seed)], [*keys, "at", "seed"])

    return rows.select(*keys, F.col(text).cast("binary").alias("__t")).mapInArrow(run, schema)


def seed_pairs(reads: DataFrame, targets: DataFrame, params: Seeding = Seeding()) -> DataFrame:
    """(node, frame, target, at, diagonal): each seed that a read (node, frame, aa) and a target (target, seq) share; diagonal = place
    in the target - place in the read."""
    a = written(seeds(reads.select("node", "frame", "aa"), "aa", params), "read-seeds")
    b = written(seeds(targets.select("target", "seq"), "seq", params), "target-seeds")
    # Pairs of a seed: the product of what both sides count. Few seeds are hot: each has part_pairs pairs at least.
    counts = a.groupBy("seed").agg(F.count("*").alias("n")).join(b.groupBy("seed").agg(F.count("*").alias("m")), "seed")
    hot = written(counts.where(F.col("n") * F.col("m") > params.part_pairs).select("seed", F.least(F.lit(4096), F.ceil(F.col("n") * F.col("m") / params.part_pairs)).cast("int").alias("parts")), "hot-seeds")
    small = F.broadcast(hot) if hot.count() <= MOST_BROADCAST else hot
    parts = F.coalesce("parts", F.lit(1))
    left = a.join(small, "seed", "left").withColumn("__part", F.pmod(F.xxhash64("node", "frame", "at"), parts).cast("int")).drop("parts")
    right = b.withColumnRenamed("at", "__to").join(small, "seed", "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    both = left.join(right, ["seed", "__part"])
    return both.select("node", "frame", "target", "at", (F.col("__to") - F.col("at")).alias("diagonal"))


def candidates(pairs: DataFrame, params: Seeding = Seeding()) -> DataFrame:
    """(node, frame, target, low, high, n_seeds, diagonal, at): runs of diagonals of a read and target that lie at most ``near`` apart, with
    their richest diagonal (ties: the lowest) and its first seed's place."""
    by = ["node", "frame", "target"]
    lines = pairs.groupBy(*by, "diagonal").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    w = Window.partitionBy(*by).orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(w) > params.near).cast("int"), F.lit(0))
    runs = lines.withColumn("__new", new).withColumn("run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    best = F.max_by(F.struct("diagonal", "at"), F.struct("n", -F.col("diagonal"))).alias("best")
    out = runs.groupBy(*by, "run").agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("n").alias("n_seeds"), best)
    return out.where(F.col("n_seeds") >= params.least_seeds).select(*by, "low", "high", "n_seeds", "best.diagonal", "best.at")


# --- extension -------------------------------------------------------------------------------------------------------

_SHIFT = 42
_HALF = 21  # places below 2^21 in read and target
_NONE = -(1 << 62)
_MATRIX = np.full((22, 22), OTHER, np.int64)
_MATRIX[:20, :20] = SCORES[np.ix_([ord(c) for c in LETTERS], [ord(c) for c in LETTERS])]
_MATRIX[21, :] = _MATRIX[:, 21] = -(1 << 15)  # beyond a text's ends
assert _MATRIX[:20, :20].min() > UNKNOWN


def ungapped(read: np.ndarray, target: np.ndarray, at: int, diagonal: int, drop: int) -> int:
    """Best score of a stretch on a diagonal that holds a place, extended both ways until it falls ``drop`` below its best."""
    def reach(x: np.ndarray, y: np.ndarray) -> int:
        n = min(len(x), len(y))
        total = np.cumsum(_MATRIX[x[:n], y[:n]])
        best = np.maximum.accumulate(np.maximum(total, 0))
        stop = np.flatnonzero(best - total > drop)
        return int(best[stop[0] if len(stop) else -1]) if n else 0

    return reach(read[at:], target[at + diagonal :]) + reach(read[:at][::-1], target[: at + diagonal][::-1])


def banded(reads: list[np.ndarray], targets: list[np.ndarray], low: list[int], width: int) -> list[tuple[int, int, int, int, int]]:
    """(score, start, end in the read, start, end in the target) of the best local alignment of each pair within ``width`` diagonals from
    ``low`` on, gaps affine; of equal scores that with the latest start in the read, then in the target, then the earliest end.

    All pairs go side by side, a step for each letter of the reads. A cell's number holds its score above the start of its alignment, so the
    larger of two numbers is the better alignment; gaps along a step are a running maximum. Cells without a score need no mending: the
    start of a new alignment is larger than any of them, and gaps only make them less.
    """
    n, rows = len(reads), max(map(len, reads))
    size = len(_MATRIX)
    q = np.full((rows, n, 1), 21 * size)
    t = np.full((n, rows + width), 21)
    for c in range(n):
        q[: len(reads[c]), c, 0] = reads[c] * size
        s = max(0, low[c])
        own = targets[c][s : max(s, low[c] + rows + width)]
        t[c, s - low[c] : s - low[c] + len(own)] = own
    shifted = (_MATRIX << _SHIFT).ravel()
    step, first = np.int64(GAP_LETTER << _SHIFT), np.int64((GAP_OPEN + GAP_LETTER) << _SHIFT)
    ramp = step * np.arange(width)
    back = ramp + first
    lowest = np.array(low, np.int64)[:, None] + np.arange(width)
    least = np.int64(1) << _SHIFT
    h, f = np.full((n, width + 1), _NONE), np.full((n, width + 1), _NONE)  # one more: the band's edge
    best, place = np.full(n, least - 1), np.zeros((n, 2), np.int64)
    here, start, down, cell = (np.empty((n, width), np.int64) for _ in range(4))
    inside = 1 - lowest.min()  # from here on all places of the band lie behind the target's begin
    for i in range(rows):
        if i and i >= inside:
            start += (1 << _HALF) + 1
        else:
            np.maximum(np.add(lowest, i, out=start), 0, out=start)
            start += i << _HALF
        np.subtract(h[:, 1:], first, out=down)
        np.subtract(f[:, 1:], step, out=f[:, :-1])
        np.maximum(down, f[:, :-1], out=f[:, :-1])
        np.maximum(h[:, :-1], start, out=here)
        np.add(t[:, i : i + width], q[i], out=cell)
        here += shifted.take(cell, out=down, mode="clip")
        np.maximum(here, f[:, :-1], out=here)
        np.maximum.accumulate(np.add(here, ramp, out=cell), axis=1, out=down)
        down -= back
        np.maximum(here[:, 1:], down[:, :-1], out=here[:, 1:])
        h[:, :-1] = here
        top = here.argmax(1)
        value = here[np.arange(n), top]
        better = np.flatnonzero(value > best)
        best[better] = value[better]
        place[better, 0], place[better, 1] = i + 1, lowest[better, top[better]] + i + 1
    best[best < least] = 0
    mask = (1 << _HALF) - 1
    return [(int(v >> _SHIFT), int(v >> _HALF & mask), int(e), int(v & mask), int(g)) for v, (e, g) in zip(best, place, strict=True)]


FOUND = "node long, frame int, target string, offset int, score int, qstart int, qend int, sstart int, send int, n_seeds long"


def _extended(batches: Iterator[pa.RecordBatch], params: Extension) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FOUND.split(", ")]
    for batch in batches:
        rows = batch.to_pylist()
        kept = []
        for r in rows:
            read, target = _numbers(r["read"]), _numbers(r["seq"])
            if ungapped(read, target, r["at"] - r["offset"], r["diagonal"] + r["offset"], params.drop) >= params.trigger:
                kept.append((len(read), r["high"] - r["low"], r, read, target))
        kept.sort(key=lambda x: x[:2])
        out = []
        for first in range(0, len(kept), params.batch):
            group = kept[first : first + params.batch]
            width = max(g[1] for g in group) + 2 * params.pad + 1
            low = [g[2]["low"] + g[2]["offset"] - params.pad for g in group]
            for g, (score, qs, qe, ss, se) in zip(group, banded([g[3] for g in group], [g[4] for g in group], low, width), strict=True):
                r = g[2]
                out.append((r["node"], r["frame"], r["target"], r["offset"], score, qs + r["offset"], qe + r["offset"], ss, se, r["n_seeds"]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), pa.string(), *[pa.int32()] * 6, pa.int64()], strict=True)], names)


def bit_score(score: Column) -> Column:
    return (F.lit(LAMBDA) * score - F.lit(math.log(KAPPA))) / F.lit(math.log(2))


def extended_hits(reads: DataFrame, targets: DataFrame, seeding: Seeding = Seeding(), extension: Extension = Extension()) -> DataFrame:
    """E. Hits of reads (node, frame, aa) on targets (target, seq): score, bits, evalue, qstart, qend, sstart, send (half-open, in letters), n_seeds.

    One row for each read, frame and target whose best alignment has an E-value of at most ``most_evalue``, for a search space of the read's
    length times all targets' letters. Null texts have no hits; letters other than the twenty score -4. A hit needs a candidate with
    enough seeds whose ungapped score reaches the trigger, and lies within ``pad`` diagonals of it; below the trigger's score nothing is promised.
    """
    letters = targets.agg(F.sum(F.length("seq"))).first()[0] or 0
    near = candidates(seed_pairs(reads, targets, seeding), seeding)
    pad = extension.pad
    # The read's stretch that the band can reach: from where its top leaves the target's begin to where its foot leaves the target's end.
    first = F.greatest(F.lit(0), -F.col("high") - pad)
    last = F.least(F.length("aa"), F.length("seq") - F.col("low") + pad)
    rows = near.join(targets.select("target", "seq"), "target").join(reads.select("node", "frame", "aa"), ["node", "frame"])
    rows = rows.withColumns({"offset": first.cast("int"), "__last": last, "__n": F.length("aa")})
    stretch = F.substring(F.col("aa"), F.col("offset") + 1, F.col("__last") - F.col("offset"))
    rows = rows.select("node", "frame", "target", "low", "high", "n_seeds", "diagonal", "at", "offset", stretch.cast("binary").alias("read"), F.col("seq").cast("binary").alias("seq"))
    found = rows.select(F.col("node").cast("long").alias("node"), F.col("frame").cast("int").alias("frame"), F.col("target").cast("string").alias("target"), *rows.columns[3:])
    hits = found.mapInArrow(lambda batches: _extended(batches, extension), FOUND)
    order = Window.partitionBy("node", "frame", "target").orderBy(F.desc("score"), F.desc("qstart"), F.desc("sstart"), "qend", "send", F.desc("n_seeds"))
    best = hits.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k", "offset")
    size = reads.select(F.col("node").cast("long").alias("node"), F.col("frame").cast("int").alias("frame"), F.length("aa").alias("__n")).groupBy("node", "frame").agg(F.max("__n").alias("__n"))
    bits = bit_score(F.col("score"))
    scored = best.join(size, ["node", "frame"]).withColumns({"bits": bits, "evalue": F.col("__n") * F.lit(float(letters)) * F.pow(F.lit(2.0), -bits)})
    return scored.where(F.col("evalue") <= extension.most_evalue).select("node", "frame", "target", "score", "bits", "evalue", "qstart", "qend", "sstart", "send", "n_seeds")
