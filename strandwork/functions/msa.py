"""Column functions on aligned text, gaps as '-'."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from strandwork.functions.dna import let


def data_start(seq: Column, gap: str = "-") -> Column:
    """X4. The place (from 0) of the first letter that is no gap."""
    return F.length(seq) - F.length(F.ltrim(seq, F.lit(gap)))


def data_end(seq: Column, gap: str = "-") -> Column:
    """X4. One past the last letter that is no gap."""
    return F.length(F.rtrim(seq, F.lit(gap)))


def data_length(seq: Column, gaps: str = "-") -> Column:
    """Letters that are no gaps."""
    return F.length(F.translate(seq, gaps, ""))


def coverage(seq: Column, gaps: str = "-?X") -> Column:
    """F13. The share of letters that are data; null for an empty text."""
    return F.when(F.length(seq) > 0, data_length(seq, gaps) / F.length(seq))


def inner_gaps(seq: Column, gap: str = "-", mark: str = "?") -> Column:
    """X9. Gaps between the first and the last letter of data become ``mark``."""

    def of(x: Column) -> Column:
        s, e = data_start(x, gap), data_end(x, gap)
        return F.when(e > s, F.concat(F.substring(x, F.lit(1), s), F.replace(F.substring(x, s + 1, e - s), F.lit(gap), F.lit(mark)), F.substring(x, e + 1, F.length(x)))).otherwise(x)

    return let(seq, of)


def letters(seq: Column) -> Column:
    return F.filter(F.split(seq, ""), lambda c: c != "")


def flags(places: Column) -> Column:
    """For each place up to the last of ``places`` (from 0, in any order) whether it is one of them: looked up by at(), not searched."""

    def of(p: Column) -> Column:
        before = lambda k: F.coalesce(F.get(p, k - 1), F.lit(-1))
        return F.flatten(F.transform(p, lambda x, k: F.concat(F.array_repeat(F.lit(False), x - before(k) - 1), F.array(F.lit(True)))))

    return let(F.array_sort(F.array_distinct(F.filter(F.transform(places, lambda x: x.cast("int")), lambda x: x >= 0))), of)


def at(flags: Column, i: Column) -> Column:
    """Whether place ``i`` is flagged; places past the end, and all of a null, are not."""
    return F.coalesce(F.get(flags, i), F.lit(False))


def masked(seq: Column, places: Column, mark: str = "-") -> Column:
    """X7. The letters at the given places (from 0) replaced."""
    return let(flags(places), lambda f: F.array_join(F.transform(letters(seq), lambda c, i: F.when(at(f, i), F.lit(mark)).otherwise(c)), ""))


def minimum_data(seq: Column, least: int, rejected: Column | None = None, gap: str = "-") -> Column:
    """F15 and F16. Whether at least ``least`` letters of data lie outside the rejected places (from 0)."""
    data = letters(seq) if rejected is None else let(flags(rejected), lambda f: F.filter(letters(seq), lambda c, i: ~at(f, i)))
    return F.size(F.filter(data, lambda c: ~F.lit(gap).contains(c))) >= least


def same_variant(a: Column, b: Column) -> Column:
    """F18. Names that agree but for their last eight characters."""
    return F.substring(a, F.lit(1), F.length(a) - 8) == F.substring(b, F.lit(1), F.length(b) - 8)


def gaps_inserted(seq: Column, places: Column, gap: str = "-") -> Column:
    """X6. Gaps put in so that they stand at the given places (from 0, ascending) of the new text."""
    return F.aggregate(places, seq, lambda s, k: F.concat(F.substring(s, F.lit(1), k), F.lit(gap), F.substring(s, k + 1, F.length(s))))


def inner_gap_places(seq: Column, gap: str = "-") -> Column:
    """X6. The places (from 0) of gaps between the first and the last letter of data."""
    ends = F.struct(data_start(seq, gap).alias("s"), data_end(seq, gap).alias("e"))
    return let(ends, lambda x: F.filter(F.transform(letters(seq), lambda c, i: F.when((c == gap) & (i >= x["s"]) & (i < x["e"]), i)), lambda i: i.isNotNull()))


def codon_at(letters: Column, k: Column) -> Column:
    """The codon of protein place ``k`` of nucleotide letters, shorter or empty past their end."""
    return F.concat(*[F.coalesce(F.get(letters, k * 3 + j), F.lit("")) for j in range(3)])


def masked_codons(nt: Column, places: Column, mark: str = "---") -> Column:
    """X7 and H11. The codons at the given protein places (from 0) replaced."""
    every = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(nt) / 3).cast("int") - 1, F.lit(0)))
    made = lambda x, f: F.array_join(F.transform(every, lambda k: F.when(at(f, k), F.lit(mark)).otherwise(codon_at(x, k))), "")
    return F.when(F.length(nt) > 0, let(F.struct(letters(nt).alias("x"), flags(places).alias("f")), lambda v: made(v["x"], v["f"]))).otherwise(nt)


def selected_codons(nt: Column, places: Column) -> Column:
    """H11. The codons at the given protein places (from 0, in their order), joined."""
    return F.when(nt.isNotNull(), let(letters(nt), lambda x: F.array_join(F.transform(places, lambda k: codon_at(x, k)), "")))


def codon_place(i: Column) -> Column:
    """X8. Where the codon of a protein place begins in the nucleotides, both from 0."""
    return i * 3


def as_share(percent: float) -> float:
    """X17. A share given as a percentage (above 1) or as a share."""
    return percent / 100 if percent > 1 else float(percent)


def marked_consensus(agreed: Column, covered: Column) -> Column:
    """H4. A consensus where columns without any data are ? and ambiguous ones stay X; ``covered``: places with data."""
    return let(flags(covered), lambda f: F.array_join(F.transform(letters(agreed), lambda c, i: F.when(at(f, i), c).otherwise(F.lit("?"))), ""))


def same_letters(a: Column, b: Column, start: Column, end: Column) -> Column:
    """H5. Whether two aligned rows are equal on [start, end); gaps count as letters."""
    return F.substring(a, start + 1, end - start) == F.substring(b, start + 1, end - start)


def compared(a: Column, b: Column, gaps: str = "-X") -> Column:
    """H6 and H7. (different, compared) of two aligned rows: places where both have data, and those of them that differ; null for a null."""

    @F.pandas_udf("struct<different:int,compared:int>")
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        out = []
        for s, t in zip(x, y, strict=True):
            if s is None or t is None:
                out.append((None, None))
                continue
            n = min(len(s), len(t))
            p, q = (np.frombuffer(z[:n].encode("utf-32-le"), np.uint32) for z in (s, t))
            data = ~np.isin(p, [ord(c) for c in gaps]) & ~np.isin(q, [ord(c) for c in gaps])
            out.append((int((p != q)[data].sum()), int(data.sum())))
        return pd.DataFrame(out, columns=["different", "compared"]).astype("Int32")

    return run(a, b)
