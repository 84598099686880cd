"""Order-dependent filters of ranges as a fold over sorted runs: what a task holds is the ranges that were kept, in an index, and no row.

A row is compared with the kept ranges that can meet it, found in an index, so a group of a million rows takes a million short steps.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

#: Kept ranges that are compared one by one before they are indexed, and entries of a block of the index.
FEW, BLOCK = 12, 512
NOWHERE = -(1 << 62)


class Internal:
    """W5. A range goes if a kept one overlaps it by at least ``share`` of their union's span.

    Kept ranges lie in cells by length class (powers of two) and start. Only classes within ``share`` of the new range's length can meet
    it, in the cells that it touches, and a cell holds few ranges, as those kept hardly overlap one another.
    """

    def __init__(self, share: float):
        self.share, self.few, self.cells = share, [], None

    def _meets(self, s: int, e: int, others: list[tuple[int, int]]) -> bool:
        for a, b in others:
            common = (e if e < b else b) - (s if s > a else a)
            if common > 0 and common / ((e if e > b else b) - (s if s < a else a)) >= self.share:
                return True
        return False

    def _put(self, s: int, e: int) -> None:
        c = (e - s).bit_length()
        self.cells.setdefault((c, s >> c), []).append((s, e))

    def keeps(self, s: int, e: int) -> bool:
        n = e - s
        if n <= 0:
            return True
        if self.cells is None:
            if self._meets(s, e, self.few):
                return False
            self.few.append((s, e))
            if len(self.few) > FEW and self.share > 0:
                self.cells = {}
                for r in self.few:
                    self._put(*r)
            return True
        for c in range(int(self.share * n).bit_length(), int(n / self.share + 1).bit_length() + 1):
            for cell in range((s - (1 << c)) >> c, ((e - 1) >> c) + 1):
                if self._meets(s, e, self.cells.get((c, cell), ())):
                    return False
        self._put(s, e)
        return True


class Dominance:
    """W6. From the highest score down, a range goes if a kept one of ``ratio`` times its score at least overlaps ``share`` of it.

    Kept ranges enter the index once scores have fallen far enough below theirs. It has them in blocks by start, with each block's
    furthest end and longest range: one that begins before the new range must reach far enough into it, one that begins inside must be long enough.
    """

    def __init__(self, share: float, ratio: float):
        self.share, self.ratio, self.waiting, self.next = share, ratio, [], 0
        self.starts: list[list[int]] = [[]]
        self.ends: list[list[int]] = [[]]
        self.first, self.furthest, self.longest = [NOWHERE], [NOWHERE], [-1]

    def _put(self, s: int, e: int) -> None:
        k = max(0, bisect_right(self.first, s) - 1)
        starts, ends = self.starts[k], self.ends[k]
        at = bisect_right(starts, s)
        starts.insert(at, s)
        ends.insert(at, e)
        self.first[k] = starts[0]
        self.furthest[k], self.longest[k] = max(self.furthest[k], e), max(self.longest[k], e - s)
        if len(starts) > BLOCK:
            half = BLOCK // 2
            for own in (self.starts, self.ends):
                own[k : k + 1] = [own[k][:half], own[k][half:]]
            self.first[k : k + 1] = [self.starts[j][0] for j in (k, k + 1)]
            self.furthest[k : k + 1] = [max(self.ends[j]) for j in (k, k + 1)]
            self.longest[k : k + 1] = [max(b - a for a, b in zip(self.starts[j], self.ends[j], strict=True)) for j in (k, k + 1)]

    def _reached(self, s: int, most: int) -> bool:
        """Does a range that begins at s or before end at ``most`` or after?"""
        k = bisect_right(self.first, s) - 1
        if k < 0:
            return False
        return max(self.furthest[:k], default=NOWHERE) >= most or max(self.ends[k][: bisect_right(self.starts[k], s)], default=NOWHERE) >= most

    def _long_inside(self, low: int, high: int, least: int) -> bool:
        """Has a range that begins above low, at high at most, ``least`` places?"""
        for k in range(max(0, bisect_right(self.first, low) - 1), bisect_right(self.first, high)):
            if self.longest[k] >= least:
                starts, ends = self.starts[k], self.ends[k]
                for j in range(bisect_right(starts, low), bisect_right(starts, high)):
                    if ends[j] - starts[j] >= least:
                        return True
        return False

    def keeps(self, s: int, e: int, score: float) -> bool:
        n = e - s
        if n > 0 and score > 0:
            while self.next < len(self.waiting) and self.waiting[self.next][2] / score >= self.ratio:
                self._put(*self.waiting[self.next][:2])
                self.next += 1
            if self.next > BLOCK:
                del self.waiting[: self.next]
                self.next = 0
            least = max(1, int(self.share * n))
            while least < self.share * n:
                least += 1
            if least <= n and (self._reached(s, s + least) or self._long_inside(s, e - least, least)):
                return False
            self.waiting.append((s, e, score))
        return True


def streamed_keep(df: DataFrame, keys: list[str], order: list, compared: list[str], fold: Callable[[], object], dealt: list[str] | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """The rows of each group that fold() keeps when it sees their ``compared`` columns in ``order``; rows with a null among those stay.

    Rows are sorted in the partition of their group and pass as a stream of Arrow batches. ``order`` should be total. Rows are dealt by
    their group or, to lie where the steps before put them, by some of its columns (``dealt``). Rows that ``order`` leaves equal come in the
    order of the columns ``ties``, which are not given on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, none = None, None, True
        for batch in batches:
            groups = batch.column(keys[0]).to_pylist() if len(keys) == 1 else zip(*(batch.column(k).to_pylist() for k in keys), strict=True)
            mask = []
            for key, values in zip(groups, zip(*(batch.column(c).to_pylist() for c in compared), strict=True), strict=True):
                if none or key != now:
                    now, own, none = key, fold(), False
                mask.append(None in values or own.keeps(*values))
            yield batch.filter(pa.array(mask))

    rows = df.repartition(*(dealt or keys)).sortWithinPartitions(*keys, *order, *ties).drop(*ties)
    return rows.mapInArrow(run, rows.schema)
