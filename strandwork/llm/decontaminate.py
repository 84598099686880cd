"""Benchmark decontamination by greedy string tiling.

Words are compared in lower case, with ASCII punctuation read as white space. Karp-Rabin values of every window of MIN_MATCH
words find the seeds that a document shares with a benchmark item; seeds in a row on one diagonal are a maximal match.
The longest match is marked as a tile again and again; what is left of matches that a tile cuts competes on. So no word
belongs to two tiles, and passages whose parts were reordered are still covered. An item leaks if the tiles of one stretch of the
document cover COVERAGE of it. Stretches are SPREAD times as long as the item, overlap by half and cover the whole text, so a
passage of up to half that length lies in one; common runs of words from all over a long text don't add up, and work and
memory for a document and an item don't grow with the product of their lengths. An item of fewer than MIN_MATCH words leaks
where it occurs as a whole.

The benchmark is a stated query set: it is read in blocks of at most BLOCK_BYTES of text, each broadcast in turn, and every
block meets all documents.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.llm.common import ASCII_LOWER, grams, release, text_buffer, text_slices, words

MIN_MATCH = 3
COVERAGE = 0.5
SPREAD = 8
BLOCK_BYTES = 16 << 20

_PLAIN = ASCII_LOWER.copy()
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _PLAIN[_c] = 32


def plain_bytes(buf: np.ndarray) -> np.ndarray:
    """Lower case, ASCII punctuation as white space."""
    return _PLAIN[buf]


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each word."""
    buf, starts = text_buffer(column)
    h, _, _, doc = words(_PLAIN[buf], starts)
    return h, doc


@dataclass(frozen=True)
class Benchmark:
    """One block of items: their words in a row, and where each Karp-Rabin value occurs."""

    ids: list
    words: np.ndarray
    item: np.ndarray
    first: np.ndarray  # of each item
    length: np.ndarray
    seeds: np.ndarray  # sorted, different
    seed_from: np.ndarray
    places: np.ndarray  # word positions by seed
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # (Karp-Rabin value, item) of items of so few words, by value

    @classmethod
    def of(cls, ids: list, texts: list[str | None]) -> Benchmark:
        h, item = tokens(pa.array(texts, pa.string()))
        g, at = grams(h, item, MIN_MATCH)
        order = np.argsort(g, kind="stable")
        seeds, begin = np.unique(g[order], return_index=True)
        first = np.searchsorted(item, np.arange(len(ids)))
        length = np.bincount(item, minlength=len(ids))
        short = {}
        for n in range(1, MIN_MATCH):
            value, place = grams(h, item, n)
            own = length[item[place]] == n
            rank = np.argsort(value[own], kind="stable")
            if len(rank):
                short[n] = (value[own][rank], item[place][own][rank])
        return cls(list(ids), h, item, first, length, seeds, np.append(begin, len(g)), at[order], short)


def tiles(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of words a and b from the seeds (i, j): (place in a, place in b, length), longest first.

    Ties go to the earlier place in a, then in b.
    """
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    cut = np.flatnonzero((np.diff(j - i) != 0) | (np.diff(i) != 1)) + 1
    runs = []
    for s, e in zip(np.append(0, cut), np.append(cut, len(i)), strict=True):
        n = int(e - s) + least - 1
        x, y = int(i[s]), int(j[s])
        if (a[x : x + n] == b[y : y + n]).all():
            runs.append((-n, x, y))
    heapq.heapify(runs)
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    out = []
    while runs:
        n, x, y = heapq.heappop(runs)
        n = -n
        used = in_a[x : x + n] | in_b[y : y + n]
        if not used.any():
            out.append((x, y, n))
            in_a[x : x + n] = in_b[y : y + n] = True
            if in_a.all():
                break
            continue
        # What is left of it competes on.
        edge = np.flatnonzero(np.diff(np.concatenate([[True], used, [True]])))
        for k, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - k >= least:
                heapq.heappush(runs, (-(e - k), x + k, y + k))
    return out


def stretches(where: np.ndarray, words: int, least: float) -> Iterator[slice]:
    """The seeds (of sorted document places ``where``) of each stretch for an item of so many words, but for those that can't cover ``least``."""
    half = max(1, SPREAD * words // 2)
    cell, first, n = np.unique(where // half, return_index=True, return_counts=True)
    next_to = np.append(np.diff(cell) == 1, False)
    alone = ~next_to & ~np.append(False, next_to[:-1])
    n = n + np.where(next_to, np.append(n[1:], 0), 0)
    for k in np.flatnonzero((next_to | alone) & (n * MIN_MATCH >= least)):
        yield slice(int(first[k]), int(first[k] + n[k]))


def leaks(column: pa.Array, bench: Benchmark, coverage: float = COVERAGE) -> Iterator[tuple[int, int, int, list[tuple[int, int, int]]]]:
    """(document, item, words covered, tiles) where tiles cover enough of the item."""
    h, doc = tokens(column)
    yield from _short_leaks(h, doc, bench)
    g, at = grams(h, doc, MIN_MATCH)
    if not len(g) or not len(bench.seeds):
        return
    place = np.minimum(np.searchsorted(bench.seeds, g), len(bench.seeds) - 1)
    hit = np.flatnonzero(bench.seeds[place] == g)
    place, at = place[hit], at[hit]
    for d in np.unique(doc[at]):
        own = slice(*np.searchsorted(doc[at], [d, d + 1]))
        where, seed = at[own], place[own]
        # What seeds cover bounds what tiles can: items below the threshold go before any pair of places is made.
        different = np.unique(seed)
        many = bench.seed_from[different + 1] - bench.seed_from[different]
        spots = bench.places[np.repeat(bench.seed_from[different] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
        bound = np.bincount(bench.item[np.unique((spots[:, None] + np.arange(MIN_MATCH)).ravel())], minlength=len(bench.ids))
        base = int(np.searchsorted(doc, d))
        owner, of = bench.item[spots], np.repeat(different, many)
        for k in np.flatnonzero((bound > 0) & (bound >= coverage * bench.length)):
            lo, n = int(bench.first[k]), int(bench.length[k])
            mine = owner == k
            spot, by = spots[mine] - lo, of[mine]  # places in the item, and their seeds in ascending order
            some = np.isin(seed, by)
            q, s = where[some], seed[some]
            best: tuple[int, list] = (0, [])
            for part in stretches(q - base, n, coverage * n):
                found = _tiled(bench.words[lo : lo + n], h, spot, by, q[part], s[part], coverage * n)
                total = sum(t[2] for t in found)
                if total > best[0]:
                    best = (total, [(x, y - base, m) for x, y, m in found])
                if total == n:
                    break
            if best[0] >= coverage * n:
                yield int(d), int(k), best[0], best[1]


def _tiled(item: np.ndarray, h: np.ndarray, spot: np.ndarray, by: np.ndarray, where: np.ndarray, seed: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """Tiles of an item (seeds ``by`` at its places ``spot``) in one stretch of words h (seeds at ``where``); none if they can't cover ``least``."""
    here = np.isin(by, seed)
    if len(np.unique((spot[here][:, None] + np.arange(MIN_MATCH)).ravel())) < least:
        return []
    first, last = np.searchsorted(by, seed), np.searchsorted(by, seed, "right")
    many = last - first
    i = spot[np.repeat(first - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
    begin, end = int(where[0]), int(where[-1]) + MIN_MATCH
    return [(x, y + begin, n) for x, y, n in tiles(item, h[begin:end], i, np.repeat(where, many) - begin)]


def _short_leaks(h: np.ndarray, doc: np.ndarray, bench: Benchmark) -> Iterator[tuple[int, int, int, list[tuple[int, int, int]]]]:
    for n, (value, item) in bench.short.items():
        g, at = grams(h, doc, n)
        first, last = np.searchsorted(value, g), np.searchsorted(value, g, "right")
        seen: set[tuple[int, int]] = set()
        for k in np.flatnonzero(last > first):
            d = int(doc[at[k]])
            for i in item[first[k] : last[k]].tolist():
                if (d, i) not in seen:
                    seen.add((d, i))
                    yield d, i, n, [(0, int(at[k] - np.searchsorted(doc, d)), n)]


def benchmark_blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[Benchmark]:
    """The items (item_id, text) by blocks of bounded text; null texts and items without words match nothing."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // most)
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = sorted(part.collect(), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        if rows:
            yield Benchmark.of([r["item_id"] for r in rows], [r["text"] for r in rows])


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row for each document and item that it leaks: doc_id, item_id, item_words, covered_words, coverage and tiles.

    A tile is (item_start, doc_start, n_words), counted in words. Documents that leak nothing, and null, empty or short
    texts, give no row; repeated rows of a document or item each give their own. Other columns are not read.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, item_words int, covered_words int, coverage double, tiles array<struct<item_start:int,doc_start:int,n_words:int>>"
    kind = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())]))
    out = None
    for block in benchmark_blocks(benchmark):
        held = spark.sparkContext.broadcast(block)

        def run(batches, held=held):
            bench = held.value
            for batch in batches:
                text, key = batch.column("text"), batch.column("doc_id").to_pylist()
                for a, b in text_slices(text):
                    rows = [(key[a + d], bench.ids[k], int(bench.length[k]), n, t) for d, k, n, t in leaks(text.slice(a, b - a), bench, coverage)]
                    if rows:
                        cols = list(zip(*rows, strict=True))
                        share = [n / m for n, m in zip(cols[3], cols[2], strict=True)]
                        made = [[{"item_start": x, "doc_start": y, "n_words": n} for x, y, n in t] for t in cols[4]]
                        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32()), pa.array(share, pa.float64()), pa.array(made, kind)], ["doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles"])

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
        out = found if out is None else out.unionAll(found)
    return out if out is not None else spark.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no item."""
    for block in benchmark_blocks(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, held=held):
            for batch in batches:
                text = batch.column("text")
                keep = np.ones(len(text), bool)
                for a, b in text_slices(text):
                    keep[[a + d for d, *_ in leaks(text.slice(a, b - a), held.value, coverage)]] = False
                yield batch.filter(pa.array(keep))
                release()

        docs = docs.mapInArrow(run, docs.schema)
    return docs
