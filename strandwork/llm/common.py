"""What the operators share: tables in the shared folder, text columns, and words read as numpy arrays."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwork.scratch import drop_path, dropped, new_path, shared_dir, ship, written  # noqa: F401  the operators take them from here

#: White space between words: ASCII only, the same in every engine.
WORD = r"[^\x20\x09-\x0D]+"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str | Column, by: int) -> Column:
    """crc32(id as text) mod by; null for a null id."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(c.cast("string").cast("binary")) % by


def salted_join(rows: DataFrame, small: DataFrame, on: str | list[str], spread: str, parts: int | Column = 16, how: str = "inner") -> DataFrame:
    """A merge join (inner or left) on keys that may make up much of ``rows``: a key's rows are dealt by ``spread`` into ``parts`` parts.

    ``small`` has one row a key, which is repeated for each part. parts: a number, or a column that both sides have in
    common by a rule (the small side's is dropped).
    """
    on = [on] if isinstance(on, str) else on
    many = F.lit(parts) if isinstance(parts, int) else parts
    left = rows.withColumn("salt_", F.pmod(F.xxhash64(spread, F.lit(17)), many).cast("int"))
    right = small.withColumn("salt_", F.explode(F.sequence(F.lit(0), (many - 1).cast("int"))))
    if not isinstance(parts, int):
        right = right.drop(*[c for c in small.columns if c not in on and c in rows.columns])
    return left.hint("merge").join(right, [*on, "salt_"], how).drop("salt_")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- words as arrays -------------------------------------------------------------------------------------------------

_PIECE = 1 << 20
_B = 0x9E3779B97F4A7C15 | 1
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Lower-cases A-Z, leaves other bytes (and so UTF-8) alone.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        with np.errstate(over="ignore"):
            for b in (_B, pow(_B, -1, 1 << 64)):
                p = np.full(_PIECE + 1, b, np.uint64)
                p[0] = 1
                _POWERS.append(np.cumprod(p))
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads its bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def release() -> None:
    """Gives memory that Arrow holds in reserve back to the system: idle workers stay in memory between tasks."""
    pa.default_memory_pool().release_unused()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more entry for the end); null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    starts = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def text_slices(column: pa.Array, most: int = 2 << 20):
    """(first row, last row + 1) of runs of texts with at most so many bytes, or one longer text alone."""
    _, starts = text_buffer(column)
    i, n = 0, len(starts) - 1
    while i < n:
        j = int(np.searchsorted(starts, starts[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def words(buf: np.ndarray, starts: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash, begin, end, document) of each word of the texts, in order; bounded pieces, no Python per word.

    cuts: bytes before which a word is cut as well.
    """
    power, inverse = _powers()
    n = len(buf)
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    if cuts is not None:
        edge[:n] |= cuts
    hashes, begins, ends = [], [], []
    at = 0
    while at < n:
        to = min(at + _PIECE, n)
        if to < n and not edge[to]:
            cut = np.flatnonzero(_IS_SPACE[buf[at:to]] | edge[at:to])
            if len(cut) and cut[-1] > 0:
                to = at + int(cut[-1])
            else:  # one word longer than a piece: hashed alone
                while to < n and not (_IS_SPACE[buf[to]] or edge[to]):
                    to += 1
                lead = at + (1 if _IS_SPACE[buf[at]] else 0)
                value = np.uint64(int.from_bytes(hashlib.blake2b(buf[lead:to].tobytes(), digest_size=8).digest(), "little"))
                hashes.append(np.array([value], np.uint64))
                begins.append(np.array([lead], np.int64))
                ends.append(np.array([to], np.int64))
                at = to
                continue
        part = buf[at:to]
        word = ~_IS_SPACE[part]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | edge[at + 1 : to]
        last[:-1] &= ~word[1:] | edge[at + 1 : to]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        with np.errstate(over="ignore"):
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=total[1:])
            h = (total[e] - total[s]) * inverse[s]
            h = mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        hashes.append(h)
        begins.append(s + at)
        ends.append(e + at)
        at = to
    if not hashes:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    h, s, e = map(np.concatenate, (hashes, begins, ends))
    return h, s, e, np.searchsorted(starts, s, "right") - 1


def grams(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of each run of ``size`` words within one document."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for k in range(1, size):
            out = out * np.uint64(0x9FB21C651E98DF25) + h[k : k + n]
        out = mix(out)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    return out[at], at
