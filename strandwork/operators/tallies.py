"""Votes of alignment columns, counted by batches: a task sends one row for each letter of a place, not for each letter of each row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters that one step counts at most, and counters that it holds for each letter.
STEP = 1 << 21
SPREAD = 8


def _units(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit numbers in a row, how many each text has, the different units as code points); units are runs of ``width`` letters."""
    size = np.array([len(t) // width for t in texts], np.int64)
    raw = np.frombuffer("".join(t[: len(t) // width * width] for t in texts).encode("utf-32-le"), np.uint32).reshape(-1, width)
    if width == 1 and len(raw) and raw.max() < 256:
        letters = raw[:, 0].astype(np.uint8)
        kinds = np.flatnonzero(np.bincount(letters, minlength=256))
        number = np.zeros(256, np.int64)
        number[kinds] = np.arange(len(kinds))
        return number[letters], size, kinds[:, None].astype(np.uint32)
    code = raw[:, 0].astype(np.uint64)
    for k in range(1, width):
        code = code << np.uint64(21) | raw[:, k]
    _, first, number = np.unique(code, return_index=True, return_inverse=True)
    return number, size, raw[first]


def _counted(texts: list[str], begin: np.ndarray, group: np.ndarray, weight: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(group, place, letters, votes) of what the texts hold; ``begin``: the place of each text's first unit."""
    number, size, kinds = _units(texts, width)
    names = ["".join(map(chr, row)) for row in kinds.tolist()]
    row = np.repeat(np.arange(len(texts)), size)
    place = np.arange(len(number)) - np.repeat(np.cumsum(size) - size, size) + begin[row]
    wide = np.zeros(int(group.max()) + 1 if len(group) else 0, np.int64)
    np.maximum.at(wide, group, begin + size)
    first = np.cumsum(wide) - wide
    cell = (first[group[row]] + place) * max(1, len(kinds)) + number
    cells = int(wide.sum()) * max(1, len(kinds))
    if cells <= SPREAD * len(number) + (1 << 16):
        total = np.bincount(cell, weight[row], cells)
        some = np.flatnonzero(total)
        votes = total[some]
    else:
        some, at = np.unique(cell, return_inverse=True)
        votes = np.bincount(at, weight[row], len(some))
    where, unit = np.divmod(some, max(1, len(kinds)))
    owner = np.searchsorted(first, where, "right") - 1
    while len(owner) and (wide[owner] == 0).any():  # groups without places share their start with the next one
        owner = np.where(wide[owner] == 0, owner + 1, owner)
    return owner, where - first[owner] if len(owner) else where, [names[u] for u in unit], votes.astype(np.int64)


def tallied(msa: DataFrame, by: str, weight: str | None = None, span_only: bool = False, width: int = 1, gap: str = "-") -> DataFrame:
    """(by, place from 0, ch, n): how many rows, or what weight of rows, have a letter (or ``width`` letters) at a place.

    span_only: only places between a row's first and last letter that is no gap. Null and empty texts hold nothing.
    """

    def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
        at = total = 0
        for k, t in enumerate(texts):
            if total and total + len(t) > STEP:
                yield at, k
                at, total = k, 0
            total += len(t)
        if at < len(texts):
            yield at, len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [t or "" for t in batch.column("seq").to_pylist()]
            keys = batch.column(by).dictionary_encode(null_encoding="encode")
            code = keys.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            w = batch.column("w").to_numpy(zero_copy_only=False).astype(np.float64)
            for i, j in slices(every):
                texts, begin = every[i:j], np.zeros(j - i, np.int64)
                if span_only:
                    begin = np.array([len(t) - len(t.lstrip(gap)) for t in texts], np.int64)
                    texts = [t.strip(gap) for t in texts]
                some = [k for k, t in enumerate(texts) if len(t) >= width]
                if not some:
                    continue
                used, group = np.unique(code[i:j][some], return_inverse=True)
                owner, place, letters, votes = _counted([texts[k] for k in some], begin[some], group, w[i:j][some], width)
                yield pa.RecordBatch.from_arrays([keys.dictionary.take(pa.array(used[owner])), pa.array(place.astype(np.int32)), pa.array(letters, pa.string()), pa.array(votes)], [by, "place", "ch", "n"])

    kind = msa.schema[by].dataType.simpleString()
    rows = msa.select(by, (F.col(weight) if weight else F.lit(1)).cast("long").alias("w"), F.col("seq").cast("string").alias("seq"))
    return rows.mapInArrow(run, f"{by} {kind}, place int, ch string, n long").groupBy(by, "place", "ch").agg(F.sum("n").alias("n"))
