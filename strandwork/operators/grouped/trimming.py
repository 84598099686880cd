"""Trimming ends, back-translation, splice sites and gap filling."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandwork.functions.blosum import similar_letters
from strandwork.functions.dna import CODONS, acids_at
from strandwork.operators.grouped.columns import GAP, Counts, Row, consensus, excised_split, reference_letters, runs_of, span


def back_translate(aligned: str, nt: str) -> str:
    """G9. The codons of ``nt`` along an aligned protein, three gaps for each gap; letters left over are dropped, missing ones gaps."""
    out, at = [], 0
    for c in aligned:
        if c == GAP:
            out.append(GAP * 3)
        else:
            out.append(nt[at : at + 3].ljust(3, GAP))
            at += 3
    return "".join(out)


def back_translated(aligned: Column, nt: Column) -> Column:
    """G9 for columns."""

    @F.pandas_udf("string")
    def run(a: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else back_translate(x, y) for x, y in zip(a, n, strict=True)])

    return run(aligned, nt)


@dataclass(frozen=True)
class Columns:
    """What the references of a gene have in each column."""

    letters: list[frozenset[str]]  # and the letters similar to them
    similar: list[frozenset[str]]  # only similar to them
    filled: list[bool]  # enough of the references that span the column have data there
    empty: list[bool]  # nearly all references have none
    poor: list[bool]  # less data than a column must have

    @classmethod
    def of(cls, references: list[str], share: float = 0.5, cull: float = 0.0, strictness: str = "strict", nearly_all: float = 0.85) -> Columns:
        near = similar_letters(strictness)
        width = max(map(len, references), default=0)
        spans = [span(r) for r in references]
        letters, similar, filled, empty, poor = [], [], [], [], []
        for k in range(width):
            inside = [r[k].replace("*", GAP) for r, (s, e) in zip(references, spans, strict=True) if s <= k < e]
            data = frozenset(inside) - {GAP}
            more = frozenset(c for a in data for c in near.get(a, "")) - data
            here = sum(c != GAP for c in inside)
            filled.append(bool(inside) and here / len(inside) >= share)
            poor.append((here / len(inside) if inside else 0.0) < cull)
            empty.append(1 - here / max(1, len(references)) >= nearly_all)
            letters.append(data | more)
            similar.append(more)
        return cls(letters, similar, filled, empty, poor)

    def has(self, k: int, c: str) -> bool:
        return k < len(self.letters) and c in self.letters[k]

    def backwards(self, width: int) -> Columns:
        """The same columns of rows of so many letters, from the last one to the first."""
        turn = lambda x, none: [*x, *[none] * (width - len(x))][:width][::-1]
        return Columns(turn(self.letters, frozenset()), turn(self.similar, frozenset()), turn(self.filled, False), turn(self.empty, True), turn(self.poor, True))


def _edge(seq: str, at: Columns, window: int, mismatches: int, most_similar: float, start: int = 0) -> int | None:
    """The first place from which ``window`` letters agree with the references in all but ``mismatches``.

    The first letter must agree, in a column that is not empty. Gaps don't count, but one in a column that references fill, with the next one, ends
    the try, and so does a stop that doesn't agree. Of the letters passed at most ``most_similar`` may agree by similarity alone."""
    for i in range(start, len(seq) - window - 1):
        if seq[i] == GAP or at.empty[i] or not at.has(i, seq[i]):
            continue
        left, alike, k, todo = mismatches, int(seq[i] in at.similar[i]), i + 1, window - 1
        while todo and k + 1 < len(seq):
            if seq[k] == GAP:
                if at.filled[k] and at.filled[k + 1]:
                    break
            else:
                if at.has(k, seq[k]):
                    alike += seq[k] in at.similar[k]
                else:
                    left -= 1
                    if left < 0 or seq[k] == "*":
                        break
                todo -= 1
            k += 1
        if not todo and alike / (k - i) <= most_similar:
            return i
    return None


def _resumed(seq: str, at: Columns, window: int, mismatches: int, start: int, limit: int) -> int:
    """Where a row is good again behind a stop: the first place from which ``window`` letters before ``limit`` agree in all but ``mismatches``, or the next
    one where that place itself is one of those; else ``limit``. A gap in a column that references fill ends the try."""
    for i in range(start, limit - window - 1):
        if seq[i] == GAP or at.empty[i]:
            continue
        first = int(not at.has(i, seq[i]))
        left, k, todo = mismatches - first, i + 1, window - 1
        while left >= 0 and todo and k < limit:
            if seq[k] == GAP:
                if at.filled[k]:
                    break
            else:
                left -= not at.has(k, seq[k])
                todo -= 1
            k += 1
        if left >= 0 and not todo:
            return i + first
    return limit


def trimmed(seq: str, references: list[str] | Columns, window: int = 6, mismatches: int = 2, most_similar: float = 0.4, least: int = 15, strictness: str = "strict") -> str | None:
    """G10. Gaps outside the first and the last place where the references agree (see _edge), gaps around stops inside, from the
    nearest agreement on either side (see _resumed), and no columns that are poor in references. None if fewer than ``least`` letters are left."""
    at = references if isinstance(references, Columns) else Columns.of(references, strictness=strictness)
    n = len(seq)
    wide = Columns(*[x + [none] * (n - len(x)) for x, none in ((at.letters, frozenset()), (at.similar, frozenset()), (at.filled, False), (at.empty, True), (at.poor, False))])
    turned = wide.backwards(n)
    start = _edge(seq, wide, window, mismatches, most_similar)
    end = _edge(seq[::-1], turned, window, mismatches, most_similar)
    if start is None or end is None or n - end <= start + window:
        return None
    keep = [start <= k < n - end for k in range(n)]
    for k in range(start, n - end):
        if seq[k] == "*" and not wide.has(k, "*"):
            right = _resumed(seq, wide, window, mismatches, k, n - end)
            left = n - _resumed(seq[::-1], turned, window, mismatches, n - k, n - start)
            for j in range(left, right):
                keep[j] = False
    out = "".join(c if kept and not poor else GAP for c, kept, poor in zip(seq, keep, wide.poor, strict=False))
    return out if sum(c != GAP for c in out) >= least else None


def nt_mirrored(aa: str, trimmed_aa: str, nt: str) -> str:
    """G10 and F20. The codons of letters that trimming took become gaps; nt is aligned as aa is."""
    return "".join(GAP * 3 if t == GAP and c != GAP else nt[3 * k : 3 * k + 3].ljust(3, GAP) for k, (c, t) in enumerate(zip(aa, trimmed_aa, strict=True)))


def splice_candidates(seq: str, least: int = 30) -> list[tuple[int, int]]:
    """J10. [start, end) of introns from a GT to an AG: a multiple of three letters, at least ``least``; the last GT first, then the
    first AG."""
    raw = np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)
    pair = lambda a, b: np.flatnonzero((raw[:-1] == ord(a)) & (raw[1:] == ord(b))) if len(raw) else np.zeros(0, np.int64)
    gt, ag = pair("G", "T")[::-1], pair("A", "G") + 2
    out: list[tuple[int, int]] = []
    for g in gt.tolist():
        far = ag[np.searchsorted(ag, g + least) :]
        out += [(g, a) for a in far[(far - g) % 3 == 0].tolist()]
    return out


def splice_pairs(seq: Column, least: int = 30) -> Column:
    """J10 for a column: (start, end) structs in the same order."""

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def run(texts: pa.Array) -> pa.Array:
        found = [np.array(splice_candidates(t, least) if t else [], np.int32).reshape(-1, 2) for t in texts.to_pylist()]
        every = np.concatenate([np.zeros((0, 2), np.int32), *found])
        ends = pa.StructArray.from_arrays([pa.array(every[:, 0]), pa.array(every[:, 1])], ["start", "end"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), ends)

    return run(seq)


#: Pairs that one batch holds at most, but for those of one start.
PAIR_ROWS = 1 << 19


def _pair_parts(seq: str, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, ends) of all splice_candidates(), by frame, in parts of bounded size."""
    raw = np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)
    gt, ag = np.flatnonzero((raw[:-1] == ord("G")) & (raw[1:] == ord("T"))), np.flatnonzero((raw[:-1] == ord("A")) & (raw[1:] == ord("G"))) + 2
    for k in range(3):
        g, a = gt[gt % 3 == k], ag[ag % 3 == k]
        first = np.searchsorted(a, g + least)
        many = len(a) - first
        done = np.cumsum(many)
        at = 0
        while at < len(g) and many[at]:  # the later a start, the fewer ends
            to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIR_ROWS, "right")))
            n = many[at:to]
            skip = np.repeat(first[at:to] - (np.cumsum(n) - n), n)
            yield np.repeat(g[at:to], n), a[np.arange(len(skip)) + skip]
            at = to


def splice_pair_rows(rows: DataFrame, least: int = 30) -> DataFrame:
    """J10 for rows with a column seq: one row for each of its splice_candidates(), with the other columns, start and end. What a task holds
    is one batch of pairs, however many a text has."""
    keys = [c for c in rows.columns if c != "seq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, own, total = [], [], 0

            def given() -> pa.RecordBatch:
                index = pa.array(np.repeat([k for k, _ in own], [n for _, n in own]).astype(np.int64))
                ends = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*held, strict=True)]
                return pa.RecordBatch.from_arrays([*(batch.column(c).take(index) for c in keys), *ends], [*keys, "start", "end"])

            for k, text in enumerate(batch.column("seq").to_pylist()):
                for part in _pair_parts(text, least) if text else ():
                    held.append(part)
                    own.append((k, len(part[0])))
                    total += len(part[0])
                    if total >= PAIR_ROWS:
                        yield given()
                        held, own, total = [], [], 0
            if held:
                yield given()

    return rows.mapInArrow(run, ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys), "start long, end long"]))


def splice_summary(seq: str, least: int = 30) -> tuple[int, int, int] | None:
    """J10. How many splice_candidates() there are, their last start and their first end, without forming them; None without any."""
    raw = np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)
    if not len(raw):
        return None
    gt, ag = np.flatnonzero((raw[:-1] == ord("G")) & (raw[1:] == ord("T"))), np.flatnonzero((raw[:-1] == ord("A")) & (raw[1:] == ord("G"))) + 2
    n, last, first = 0, -1, len(seq) + 1
    for k in range(3):
        g, a = gt[gt % 3 == k], ag[ag % 3 == k]
        far = len(a) - np.searchsorted(a, g + least)
        if far.any():
            n += int(far.sum())
            last = max(last, int(g[far > 0][-1]))
            first = min(first, int(a[len(a) - far[0]]))
    return (n, last, first) if n else None


def splice_summaries(seq: Column, least: int = 30) -> Column:
    """J10 for a column: (n, last_gt, first_ag), null where there is none. A batch holds three numbers a text, however many pairs it has."""

    @F.arrow_udf("struct<n:bigint,last_gt:bigint,first_ag:bigint>")
    def run(texts: pa.Array) -> pa.Array:
        found = [splice_summary(t, least) if t else None for t in texts.to_pylist()]
        kind = pa.struct([(c, pa.int64()) for c in ("n", "last_gt", "first_ag")])
        return pa.array([x and dict(zip(("n", "last_gt", "first_ag"), x, strict=True)) for x in found], kind)

    return run(seq)


def best_splice(left: str, right: str, between: str, window: int = 45, gc_penalty: int = 1, penalty: int = 20) -> tuple[int, int, int] | None:
    """G19. Where two exons meet over a genomic stretch: (letters cut from the left exon's end, letters cut from the right one's start,
    score). Donors GT or GC (less ``gc_penalty``) and acceptors AG within ``window`` of the ends; a join that breaks a codon costs
    ``penalty``, one that makes a stop is out. The best score wins, then the smallest change."""
    whole = left + between + right
    a0, b0 = len(left), len(left) + len(between)
    best = None
    for d in range(max(0, a0 - window), min(len(whole) - 1, a0 + window)):
        donor = whole[d : d + 2]
        if donor not in ("GT", "GC"):
            continue
        for a in range(max(d + 4, b0 - window), min(len(whole), b0 + window) + 1):
            if whole[a - 2 : a] != "AG":
                continue
            part = d % 3
            joined = whole[d - part : d] + whole[a : a + 3 - part] if part else whole[a : a + 3]
            if CODONS.get(joined) == "*":
                continue
            score = -gc_penalty * (donor == "GC") - penalty * ((d + len(whole) - a) % 3 != 0)
            key = (-score, abs(d - a0) + abs(a - b0), d, a)
            if best is None or key < best[0]:
                best = (key, (a0 - d, a - b0, score))
    return best[1] if best else None


def filled_gap(genomic: str, references: list[str] | Counts, columns: tuple[int, int], share: float = 0.5, least: int = 10, stop: int = -5, cap: int = 100, short_share: float = 0.85, shortest: int = 5, longest: int = 60) -> tuple[int, str] | None:
    """G20. The place in a genomic stretch whose translation fits the references best in the given columns: (place, amino acids).

    Every frame is scanned; a letter scores the references that have it (at most ``cap``), a stop ``stop``. It counts from
    ``share`` of the best possible score on, of fewer than ``least`` columns from ``short_share``; gaps of ``shortest`` to ``longest`` columns
    are filled."""
    at = references if isinstance(references, Counts) else Counts.of(references)
    here = np.minimum(at.votes[columns[0] : columns[1]], cap)
    n = len(here)
    if not shortest <= n <= longest:
        return None
    top = int(here.max(1).sum())
    if not top:
        return None
    acids = acids_at(genomic)
    places = len(genomic) - 3 * n + 1
    if places < 1:
        return None
    value = np.zeros((n, 256), np.int64)
    for j, c in enumerate(at.kinds.tolist()):
        if c < 256:
            value[:, c] = here[:, j]
    value[:, ord("*")] = stop
    score = sum(value[k][acids[3 * k : 3 * k + places]] for k in range(n))
    best = int(score.argmax())  # ties: the first
    aa = acids[best : best + 3 * n : 3].tobytes().decode()
    return (best, aa) if score[best] >= (share if n >= least else short_share) * top else None


def excised(rows: list[Row], references: list[str] | list[dict[str, int]], threshold: float = 0.85, join: int = 6, least: int = 15) -> tuple[list[Row], list[str]]:
    """G14. Where the consensus of rows is ambiguous (runs of X), overlapping pairs are cut at the split that agrees with most
    references (excised_split()), the first row's end and the second one's start becoming gaps. Returns the rows, and the names of those that are left
    with fewer than ``least`` letters. References are texts, or what reference_letters() tells of them."""
    letters = references if references and isinstance(references[0], dict) else reference_letters(references)
    now = {r.name: r for r in rows}
    for s, e in runs_of(consensus(rows, threshold), "X", join):
        touched = sorted((r for r in now.values() if r.start < e and r.end > s), key=lambda r: (r.start, r.end, r.name))
        for a, b in zip(touched, touched[1:], strict=False):
            a, b = now[a.name], now[b.name]
            lo, hi = max(a.start, b.start), min(a.end, b.end)
            if hi <= lo or a.seq[lo:hi] == b.seq[lo:hi]:
                continue
            at = excised_split(a.seq, b.seq, lo, hi, letters)
            now[a.name] = Row(a.name, a.seq[:at] + GAP * (len(a.seq) - at), a.weight)
            now[b.name] = Row(b.name, GAP * at + b.seq[at:], b.weight)
    few = {r.name for r in now.values() if r.data() < least}
    return [now[r.name] for r in rows if r.name not in few], sorted(few)


def average_match(seq: str, references: list[str] | Counts, most_gaps: float = 0.5) -> float:
    """X19. The mean over columns, inside the row's data, of the share of references that have its letter; gaps of the row count -1,
    columns where more than ``most_gaps`` of references are gaps do not count."""
    at = references if isinstance(references, Counts) else Counts.of(references)
    if not at.references:
        return 0.0
    start, end = span(seq)
    end = min(end, at.width)
    if end <= start:
        return 0.0
    here = at.votes[start:end]
    data = here.sum(1)
    ok = (1 - data / at.references <= most_gaps) & (data > 0)
    own = here[np.arange(end - start), at.numbers(seq[start:end])]
    gap = np.frombuffer(seq[start:end].encode("utf-32-le"), np.uint32) == ord(GAP)
    scores = np.where(gap, -1.0, own / np.maximum(data, 1))[ok]
    return float(np.mean(scores)) if len(scores) else 0.0
