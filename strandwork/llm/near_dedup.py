"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

Shingles are runs of five words (a text of one to four words is one shingle); a shingle weighs its count in the text times
its inverse document frequency ln(1 + N / max(df, 2)). Documents link if the weighted Jaccard similarity (sum of minima /
sum of maxima) is 0.8 or more, and classes are the connected components of links.

1.  Document frequencies of all shingles are counted exactly. Texts lie in chunks; a chunk's sorted shingles are cut into ranges, each range
    is summed over all chunks in one place, and what more than two documents hold goes back to its chunks with its count. Each chunk then
    meets its own counts: no table of shingles is held whole anywhere.
2.  Each text gives BANDS * ROWS samples. A sample of a shingle of the usual weight is one table look-up.
3.  Exact copies fold into one row before any bucket is formed. Rows in one bucket of a band are candidates.
4.  Verified first: each bucket's members against its leader, the member that shares most bucket places with others (near
    copies of one text are mostly closest to the least changed of them). A leader's members are dealt in blocks.
5.  In buckets whose members are still in several classes, every member outside the leader's class meets every member of
    another class, in blocks: so no candidate pair across classes stays unseen. Blocks where some samples agree by
    LEAST_AGREEING (at similarity 0.8 fewer do in less than 1 of 10**5 pairs) are verified as one matrix product over their
    shared shingles, and give a spanning forest of their links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwork.llm.common import WORD, dropped, grams, mix, release, salted_join, shuffle_parts, text_buffer, text_slices, words, written
from strandwork.llm.components import components, forest

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 5
SAMPLES = BANDS * ROWS
#: Share of the documents up to which frequencies are not told apart: none, but that of one counts as of two.
COMMON_SHARE = 0.0
COUNTERS = 1 << 18
#: Bytes of the texts that are counted and signed side by side.
CHUNK = 1 << 20
LEAST_AGREEING = 48 / 80
BLOCK = 256
FEATURES = 4096
#: For sums of doubles in another order.
ROUNDING = 1e-9


# --- weights ---------------------------------------------------------------------------------------------------------


def shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, sorted different shingles, their counts) of each text that has words."""
    buf, starts = text_buffer(column)
    h, _, _, doc = words(buf, starts)
    n = np.bincount(doc, minlength=len(starts) - 1)
    g, at = grams(h, doc, WORDS)
    owner = np.searchsorted(doc[at], np.arange(len(n) + 1))
    first = np.concatenate([[0], np.cumsum(n)])
    for k in np.flatnonzero(n):
        if n[k] >= WORDS:
            values, counts = np.unique(g[owner[k] : owner[k + 1]], return_counts=True)
        else:
            short, _ = grams(h[first[k] : first[k + 1]], doc[first[k] : first[k + 1]], int(n[k]))
            values, counts = short, np.ones(1, np.int64)
        yield int(k), values, counts


class Weights:
    """Inverse document frequencies: a table of the common shingles and one value for all others."""

    def __init__(self, documents: int, common: np.ndarray, df: np.ndarray):
        self.floor = max(2.0, documents * COMMON_SHARE)
        order = np.argsort(common)
        self.common = common[order].astype(np.uint64)
        self.value = np.log1p(documents / np.maximum(df[order], self.floor))
        self.usual = float(np.log1p(documents / self.floor)) if documents else 1.0
        self.flag = np.zeros(COUNTERS, bool)
        self.flag[_counter(self.common)] = True

        self.df = df[order]

    @classmethod
    def told(cls, documents: int, values: list[np.ndarray], df: list[np.ndarray]) -> Weights:
        """Of the shingles of some texts, each with its document frequency; repeats allowed."""
        every, first = np.unique(np.concatenate([np.zeros(0, np.uint64), *values]), return_index=True)
        own = np.concatenate([np.zeros(0, np.uint32), *df])[first]
        return cls(documents, every[own > 2], own[own > 2].astype(float))

    def _common(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values are common shingles, and their places in the table."""
        if not len(self.common):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        near = np.flatnonzero(self.flag[_counter(values)])
        place = np.minimum(np.searchsorted(self.common, values[near]), len(self.common) - 1)
        hit = self.common[place] == values[near]
        return near[hit], place[hit]

    def of(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = counts * self.usual
        at, place = self._common(values)
        w[at] = counts[at] * self.value[place]
        return w

    def frequencies(self, values: np.ndarray) -> np.ndarray:
        """Document frequencies (uint32), 0 for the usual ones."""
        out = np.zeros(len(values), np.uint32)
        at, place = self._common(values)
        out[at] = self.df[place]
        return out


def _counter(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(46)).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Numbers as all their first bytes, then all second ones and so on: those that are mostly equal compress."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _of_planes(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def chunked(docs: DataFrame) -> DataFrame:
    """chunk, doc_id, key (of the exact text) and text: chunks are runs of rows of about CHUNK bytes, or one longer text."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j in text_slices(batch.column("text"), CHUNK):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(j - i, number)), *part.columns], ["chunk", "doc_id", "key", "text"])
                number += 1
            release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "chunk long, doc_id long, key binary, text string")


def common_shingles(chunks: DataFrame) -> DataFrame:
    """(chunk, shingles, df): of each chunk's shingles those that more than two documents of all chunks hold, in several rows; packed numbers."""
    pieces = 4 * shuffle_parts(chunks.sparkSession)  # several for each task, so that tasks get about as much
    bounds = np.array([(k << 64) // pieces for k in range(pieces)], np.uint64)

    def ranges(batches):
        """A chunk's different shingles, sorted and cut by ``bounds``, as their differences, and in how many of its texts they are."""
        for group in _groups(batches, ["chunk"]):
            found = [v for _, v, _ in shingles(group.column("text"))]
            if not found:
                continue
            values, n = np.unique(np.concatenate(found), return_counts=True)
            cut = np.append(np.searchsorted(values, bounds), len(values))
            some = np.flatnonzero(np.diff(cut))
            own = [slice(cut[k], cut[k + 1]) for k in some]
            chunk = pa.array(np.full(len(some), group.column("chunk")[0].as_py()))
            packed = [pa.array([_planes(np.diff(values[x], prepend=np.uint64(0))) for x in own], pa.binary()), pa.array([_planes(n[x].astype("<u4")) for x in own], pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), chunk, *packed], ["piece", "chunk", "shingles", "n"])
            release()

    def told(batches):
        for group in _groups(batches, ["piece"]):
            values = [np.cumsum(_of_planes(x.as_py(), "<u8"), dtype=np.uint64) for x in group.column("shingles")]
            every, which = np.unique(np.concatenate(values), return_inverse=True)
            df = np.bincount(which, np.concatenate([_of_planes(x.as_py(), "<u4") for x in group.column("n")])).astype("<u4")[which]
            out, first = [], 0
            for chunk, v in zip(group.column("chunk").to_pylist(), values, strict=True):
                own = df[first : first + len(v)]
                first += len(v)
                if (own > 2).any():
                    out.append((chunk, v[own > 2].tobytes(), own[own > 2].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["chunk", "shingles", "df"])
            release()

    cut = chunks.select("chunk", "text").mapInArrow(ranges, "piece int, chunk long, shingles binary, n binary")
    return _dealt(cut, ["piece"]).mapInArrow(told, "chunk long, shingles binary, df binary")


def similarity(w: Weights, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (shingles, counts)."""
    return _like(a[0], w.of(*a), b[0], w.of(*b))


def _like(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = float(np.minimum(x[i], y[j]).sum())
    return shared / (float(x.sum()) + float(y.sum()) - shared)


def similarities(w: Weights, rows: list[tuple[np.ndarray, np.ndarray]], columns: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """similarity() of every row with every column. Minima become products of features, one for each step of a count."""

    # Counts matter only up to the next one that any text has: min(x, y) is the sum of the steps that both reach.
    levels = np.unique(np.concatenate([c for _, c in rows] + [c for _, c in columns]))
    steps = np.diff(levels, prepend=0)

    def features(found):
        key, weight, owner = [], [], []
        for k, (values, counts) in enumerate(found):
            value, base = w.of(values, np.ones(len(values))), mix(values)
            for level, step in zip(levels[levels <= counts.max()], steps, strict=False):
                some = counts >= level
                key.append(mix(base[some] + np.uint64(int(level) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)))
                weight.append(value[some] * step)
                owner.append(np.full(int(some.sum()), k))
        return np.concatenate(key), np.concatenate(weight), np.concatenate(owner)

    (ka, wa, oa), (kb, wb, ob) = features(rows), features(columns)
    total = np.bincount(oa, wa, len(rows))[:, None] + np.bincount(ob, wb, len(columns))
    common = np.intersect1d(ka, kb)
    shared = np.zeros((len(rows), len(columns)))
    if len(common):
        places = []
        for key, weight, owner in ((ka, wa, oa), (kb, wb, ob)):
            at = np.minimum(np.searchsorted(common, key), len(common) - 1)
            hit = common[at] == key
            order = np.argsort(at[hit], kind="stable")
            places.append((at[hit][order], weight[hit][order], owner[hit][order]))
        for c in range(0, len(common), FEATURES):
            n = min(FEATURES, len(common) - c)
            dense = []
            for (at, weight, owner), size, weighted in zip(places, (len(rows), len(columns)), (True, False), strict=True):
                some = slice(*np.searchsorted(at, [c, c + n]))
                m = np.zeros((size, n))
                m[owner[some], at[some] - c] = weight[some] if weighted else 1
                dense.append(m)
            shared += dense[0] @ dense[1].T
    return shared / (total - shared)


# --- samples ---------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2,1) r, ln of Gamma(2,1) c and uniform beta for 65,536 places, and a multiplier for each sample."""
    rng = np.random.default_rng(20240229)
    r = rng.gamma(2.0, 1.0, 1 << 16)
    c = rng.gamma(2.0, 1.0, 1 << 16)
    return r, np.log(c), rng.random(1 << 16), rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _ordered(x: np.ndarray) -> np.ndarray:
    """float32 as uint32 of the same order, in the upper half of uint64."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32)
    bits = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))
    return bits.astype(np.uint64) << np.uint64(32)


def _ln_a(ln_w: np.ndarray | float, r: np.ndarray, ln_c: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """ln a of improved consistent weighted sampling: a = c / (y e^r), ln y = r (floor(ln w / r + beta) - beta)."""
    return ln_c - r * (np.floor(ln_w / r + beta) - beta) - r


@lru_cache(maxsize=4)
def _usual(ln_w: float) -> np.ndarray:
    r, ln_c, beta, _ = _draws()
    return _ordered(_ln_a(ln_w, r, ln_c, beta))


def samples(w: Weights, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """SAMPLES values (uint64) of each (shingles, counts): equal with the probability of the weighted Jaccard similarity."""
    r, ln_c, beta, many = _draws()
    g = np.concatenate([v for v, _ in found])
    weight = np.concatenate([w.of(v, c) for v, c in found])
    first = np.concatenate([[0], np.cumsum([len(v) for v, _ in found])[:-1]])
    low = g & np.uint64(0xFFFFFFFF)
    odd = np.flatnonzero(weight != w.usual)
    ln_odd = np.log(weight[odd])
    table = _usual(float(np.log(w.usual)))
    out = np.empty((len(found), SAMPLES), np.uint64)
    for k in range(SAMPLES):
        place = (g * many[k]) >> np.uint64(48)
        value = table[place]
        if len(odd):
            p = place[odd]
            value[odd] = _ordered(_ln_a(ln_odd, r[p], ln_c[p], beta[p]))
        value |= low
        out[:, k] = np.minimum.reduceat(value, first)
    return mix(out)


def _banded(values: np.ndarray) -> np.ndarray:
    out = np.empty((len(values), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(values), b + 1, np.uint64)
        for k in range(ROWS):
            h = mix(h * np.uint64(0x9FB21C651E98DF25) + values[:, b * ROWS + k])
        out[:, b] = h
    return out


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples of each row."""
    return (a == b).mean(-1)


# --- the operator ----------------------------------------------------------------------------------------------------


def text_key() -> Column:
    """What stands for a whole text: equal for equal texts, null and empty ones alike."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def signed_documents(chunks: DataFrame, documents: int) -> DataFrame:
    """doc_id, key, bands, sample and df (of the text's sorted shingles, packed); the last three are null for texts without words."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for group in _groups(batches, ["chunk"]):
            texts = pc.is_null(group.column("df"))
            told, group = group.filter(pc.invert(texts)), group.filter(texts)
            values, own = (np.frombuffer(b"".join(told.column(c).to_pylist()), t) for c, t in (("shingles", "<u8"), ("df", "<u4")))
            w = Weights.told(documents, [values], [own])
            part = group.column("text")
            rows, bands, sample, df = [], [None] * len(part), [None] * len(part), [None] * len(part)
            found = []
            for k, v, c in shingles(part):
                rows.append(k)
                found.append((v, c))
                df[k] = pack.compress(w.frequencies(v).tobytes())
            if rows:
                drawn = samples(w, found)
                for k, b, s in zip(rows, _banded(drawn).view(np.int64), (drawn & np.uint64(0xFFFF)).astype("<u2"), strict=True):
                    bands[k], sample[k] = b, s.tobytes()
            columns = [group.column(c).combine_chunks() for c in ("doc_id", "key")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bands, pa.list_(pa.int64())), pa.array(sample, pa.binary()), pa.array(df, pa.binary())], ["doc_id", "key", "bands", "sample", "df"])
            release()

    rows = chunks.unionByName(common_shingles(chunks), allowMissingColumns=True)
    return _dealt(rows, ["chunk"]).mapInArrow(run, "doc_id long, key binary, bands array<long>, sample binary, df binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, also across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        column = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cut = np.flatnonzero(np.logical_or.reduce([np.diff(c) != 0 for c in column])) + 1
        for i, j in zip(np.append(0, cut), np.append(cut, len(batch)), strict=True):
            key = tuple(c[i] for c in column)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _dealt(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return df.repartition(shuffle_parts(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)


def _vectors(table: pa.Table | pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(shingles, counts, document frequencies) of rows (text, df) that all have words."""
    out = []
    text, df = table.column("text"), table.column("df")
    texts = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
    for i, j in text_slices(texts):
        out += [(v, c, np.frombuffer(zstandard.decompress(df[i + k].as_py()), "<u4")) for k, v, c in shingles(texts.slice(i, j - i))]
    return out


def _stars(members: DataFrame, texts: DataFrame, documents: int) -> DataFrame:
    """The links (a, b) between leaders and members of their buckets."""
    pairs = written(members.where("node != leader").select("leader", "node").distinct(), "pairs")
    many = written(pairs.groupBy("leader").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "leaders")
    # Blocks are dealt before any text is sent: a leader of very many members is many keys.
    dealt = salted_join(pairs, many, "leader", "node").select("leader", "node", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"))
    text = lambda name: texts.select(F.col("node").alias(name), "text", "df")
    spokes = dealt.hint("merge").join(text("node"), "node").select("leader", "part", "node", "text", "df")
    hubs = many.hint("merge").join(text("leader"), "leader").select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("leader").alias("node"), "text", "df")

    def verify(batches):
        floor = Weights(documents, np.zeros(0, np.uint64), np.zeros(0)).floor
        centre, own = None, None
        for batch in batches:
            leader, node, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leader", "node", "part"))
            keep = []
            for k, (values, counts, df) in enumerate(_vectors(batch)):
                vector = values, counts * np.log1p(documents / np.maximum(df, floor))
                if leader[k] == node[k]:
                    centre, own = vector, (leader[k], part[k])
                elif own == (leader[k], part[k]) and _like(*centre, *vector) >= SIMILARITY - ROUNDING:
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(leader[keep], pa.int64()), pa.array(node[keep], pa.int64())], ["a", "b"])
            release()

    rows = spokes.unionByName(hubs).withColumn("spoke", F.col("leader") != F.col("node"))
    return _dealt(rows, ["leader", "part"], "spoke").select("leader", "part", "node", "text", "df").mapInArrow(verify, "a long, b long")


def _across(members: DataFrame, texts: DataFrame, documents: int) -> DataFrame:
    """Links (a, b) that span what candidates of different classes link to, from (bucket, node, label, outside).

    Blocks of members outside the leader's class meet blocks of all members; a bucket of any size spreads over many groups.
    """
    sizes = members.groupBy("bucket").agg(F.max("n").alias("n"), F.count(F.when(F.col("outside"), 1)).alias("n_out")).where("n_out > 0")
    rows = salted_join(members, sizes, "bucket", "node", F.ceil(F.col("n") / BLOCK)).hint("merge").join(texts, "node")
    part = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    place = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), part(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), part(n) - 1))
    own = ["bucket", "node", "label", "sample", "text", "df"]
    left = rows.where("outside").select(*own, F.lit(True).alias("left"), place("n_out", 1).alias("p"), every("n").alias("q"))
    right = rows.select(*own, F.lit(False).alias("left"), every("n_out").alias("p"), place("n", 2).alias("q"))

    def meet(batches):
        for group in _groups(batches, ["bucket", "p", "q"]):
            side = group.column("left").to_numpy()
            x, y = group.filter(pa.array(side)), group.filter(pa.array(~side))
            if not len(x) or not len(y):
                continue
            sx, sy = (np.frombuffer(b"".join(t.column("sample").to_pylist()), "<u2").reshape(-1, SAMPLES) for t in (x, y))
            other = x.column("label").to_numpy()[:, None] != y.column("label").to_numpy()
            near = np.stack([agreeing(sy, s) >= LEAST_AGREEING for s in sx]) & other
            i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if not len(i):
                continue
            left, right = _vectors(x.take(pa.array(i))), _vectors(y.take(pa.array(j)))
            w = Weights.told(documents, [v for v, _, _ in left + right], [df for _, _, df in left + right])
            like = similarities(w, [v[:2] for v in left], [v[:2] for v in right])
            r, c = forest((like >= SIMILARITY - ROUNDING) & near[np.ix_(i, j)])
            yield pa.RecordBatch.from_arrays([pa.array(x.column("node").to_numpy()[i[r]]), pa.array(y.column("node").to_numpy()[j[c]])], ["a", "b"])

    rows = left.unionByName(right).select("bucket", "p", "q", "left", "node", "label", "sample", "text", "df")
    return _dealt(rows, ["bucket", "p", "q"]).mapInArrow(meet, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), class_id, first_key and wordless of every row of ``docs`` (doc_id, text, more columns).

    Rows are compared by their texts: exact copies share a class, whatever their doc_ids, and a doc_id that bears several
    texts has each in its own class. class_id is the smallest doc_id of the class, null where no row of it has one; first_key is the key
    of that row's text (the smallest of several), so that classes of one class_id can be told apart. Null, empty and wordless texts
    link with nothing: each row is a class of its own, with its doc_id. An empty table gives an empty one.
    """
    chunks = written(chunked(docs), "chunks")
    documents = chunks.where(F.col("text").rlike(WORD)).count()
    signed = written(signed_documents(chunks, documents), "signed")
    dropped(chunks)
    one = signed.where("bands is not null").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("sample").alias("sample"), F.first("df").alias("df"))
    reps = written(one.withColumn("node", F.monotonically_increasing_id()), "representatives")
    spread = reps.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    placed = written(salted_join(spread, shared, "bucket", "node", 8), "placed")
    # Joins that bring texts are merge joins at every size: both sides grow with the corpus, so neither is ever broadcast.
    degree = placed.groupBy("node").agg(F.sum("n").alias("degree"))
    lead = placed.join(degree, "node").groupBy("bucket").agg(F.max("n").alias("n"), F.max(F.struct("degree", -F.col("node"), "node")).alias("l"))
    members = written(salted_join(placed, lead.select("bucket", "n", F.col("l.node").alias("leader")), "bucket", "node", F.ceil(F.col("n") / BLOCK)), "members")
    texts = written(_texts(docs, reps.join(degree.select("node").hint("merge"), "node")), "texts")
    links = written(_stars(members, texts, documents), "links")
    found = components(links)
    named = lambda df, key, name: df.join(found.select(F.col("node").alias(key), F.col("component").alias(f"{name}_")), key, "left").withColumn(name, F.coalesce(f"{name}_", key)).drop(f"{name}_")
    labelled = written(named(named(members, "node", "label"), "leader", "main").withColumn("outside", F.col("label") != F.col("main")), "labelled")
    more = written(_across(labelled, texts, documents), "links")
    dropped(placed, members, labelled, texts)
    found = written(components(links.unionAll(more)), "components")
    # The first row of each class, to which its members are led by a join that a very large class doesn't crowd.
    rank = F.struct(F.col("first_id").isNull(), "first_id", "key")
    of_node = reps.select("key", "first_id", "node").join(found, "node", "left")
    first = of_node.where("component is not null").groupBy("component").agg(F.min(rank).alias("f"))
    linked = salted_join(of_node.where("component is not null"), first, "component", "node").select("key", F.col("f.first_id").alias("class_id"), F.col("f.key").alias("first_key"))
    by_key = linked.unionByName(of_node.where("component is null").select("key", F.col("first_id").alias("class_id"), F.col("key").alias("first_key")))
    out = signed.select("doc_id", "key", F.col("bands").isNull().alias("wordless")).join(by_key, "key", "left")
    return out.select("doc_id", "key", F.when(F.col("wordless"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("first_key", "key").alias("first_key"), "wordless")


def _rows_of(docs: DataFrame, ids: DataFrame, *columns) -> DataFrame:
    """Columns of the rows of docs that bear a listed doc_id (column first_id, null as well) and key; grouped by both, one row each."""
    least = F.lit(-(1 << 63)).cast("long")  # no doc_id is compared with it alone: the key must agree too
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), least).alias("id_"), text_key().alias("key_"), *columns)
    return rows.join(ids.withColumn("id_", F.coalesce("first_id", least)).withColumnRenamed("key", "key_").hint("merge"), ["id_", "key_"]).groupBy("id_", "key_")


def _texts(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """node, text, sample and df of representatives: of one row that bears the text, so copies are not sent."""
    found = _rows_of(docs, reps.select("first_id", "key", "node", "sample", "df"), "text")
    return found.agg(F.first("node").alias("node"), F.first("text").alias("text"), F.first("sample").alias("sample"), F.first("df").alias("df")).select("node", "text", "sample", "df")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and kept of every row: classes(), and whether the row stands for its class.

    That is the row of the smallest doc_id (null last), then of the smallest key; where rows of one doc_id and text are repeated, all are marked.
    """
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("first_key"))
    return classes(docs).select("doc_id", "class_id", (F.col("wordless") | first).alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of each class (repeated rows once), all columns of ``docs``; rows without words all stay."""
    own = docs.columns
    found = classes(docs).where("not wordless").select(F.col("class_id").alias("first_id"), F.col("first_key").alias("key")).distinct()
    named = _rows_of(docs, found, F.struct(*own).alias("row")).agg(F.min("row").alias("row")).select("row.*")
    return named.unionByName(docs.where(F.col("text").isNull() | ~F.col("text").rlike(WORD)))
