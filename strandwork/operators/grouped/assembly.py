"""Greedy assembly, recovery and duplicate containment."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strandwork.functions.dna import CODONS
from strandwork.operators.grouped.columns import GAP, Row, consensus, runs_of


class _Kept:
    """A3. The hits of one read that stay, so far."""

    def __init__(self) -> None:
        self.nt: set[str] = set()
        self.aa: set[str] = set()
        self.first: str | None = None
        self.n = 0

    def suffix(self, nt: str, aa: str) -> str | None:
        if nt in self.nt or aa in self.aa or (self.first is not None and nt in self.first):
            return None
        self.nt.add(nt)
        self.aa.add(aa)
        if self.first is None:
            self.first = nt
            return ""
        self.n += 1
        return f"_{self.n}"


def contained_duplicates(hits: list[tuple[str, str]]) -> list[str | None]:
    """A3 for one read's hits (nt, aa) in order: the name suffix of each, None for those that go. Equal nt, equal aa, and text inside
    the first one's nt go; later survivors get _1, _2 and on."""
    kept = _Kept()
    return [kept.suffix(nt, aa) for nt, aa in hits]


def deduped_hits(rows: DataFrame, gene: str, node: str, order: list[str]) -> DataFrame:
    """A3 for (gene, node, nt, aa, more): survivors with ``suffix``. Hits are sorted by read, and a task walks them, holding one read's texts."""

    def run(batches):
        key, kept = None, _Kept()
        for batch in batches:
            out = []
            for g, k, nt, aa in zip(*[batch.column(c).to_pylist() for c in (gene, node, "nt", "aa")], strict=True):
                if key != (g, k):
                    key, kept = (g, k), _Kept()
                out.append(kept.suffix(nt, aa))
            marked = pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "suffix"])
            yield marked.filter(pa.array([s is not None for s in out], pa.bool_()))

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(n, gene, node).sortWithinPartitions(gene, node, *[F.col(c).asc_nulls_last() for c in order], "nt", "aa")
    return ordered.mapInArrow(run, StructType([*rows.schema.fields, StructField("suffix", StringType())]))


def assembled(reads: list[Row], share: float = 0.15, least: int = 10, children: int = 4, length: int = 100, rounds: int = 6) -> list[tuple[str, list[str]]]:
    """G15. Contigs (seq, names) of rows in one alignment: by weight, a contig takes every read that overlaps it by at least
    max(least, share of the read) and is equal there, and grows until nothing fits. Contigs of fewer than ``children`` reads, of fewer
    than ``length`` letters or that never grew beyond their first read do not count."""
    left = sorted((r for r in reads if r.end > r.start), key=lambda r: (-r.weight, r.start, r.end, r.name))
    out = []
    while left:
        seed = left.pop(0)
        seq, start, end, names = list(seed.seq), seed.start, seed.end, [seed.name]
        for _ in range(rounds):
            grown = False
            for r in list(left):
                lo, hi = max(start, r.start), min(end, r.end)
                if hi - lo < max(least, share * (r.end - r.start)) or "".join(seq[lo:hi]) != r.seq[lo:hi]:
                    continue
                left.remove(r)
                names.append(r.name)
                grown = True
                for k in (*range(r.start, start), *range(end, r.end)):
                    seq[k] = r.seq[k]
                start, end = min(start, r.start), max(end, r.end)
            if not grown:
                break
        if len(names) >= children and end - start >= length and (start, end) != (seed.start, seed.end):
            out.append(("".join(seq), sorted(names)))
    return out


def shallow_regions(rows: list[Row], threshold: float, least: int) -> list[tuple[int, int]]:
    """W11. Runs of columns inside the data where fewer than ``least`` rows agree on a letter."""
    agreed = consensus(rows, threshold)
    deep = consensus(rows, threshold, least)
    body = "".join("#" if a not in (GAP, "X") and b == GAP else "." for a, b in zip(agreed, deep, strict=True))
    return runs_of(body, "#")


def recovered(kept: list[Row], kicked: list[Row], threshold: float = 0.65, overlap: int = 12, least: int = 2) -> list[str]:
    """G17. Names of kicked rows that come back: such as overlap the edge of a shallow region by ``overlap`` letters and equal the
    consensus there; again until none does."""
    kept, kicked = list(kept), sorted(kicked, key=lambda r: (r.start, r.end, r.name))
    out: list[str] = []
    while kept:
        agreed = consensus(kept, threshold)
        edges = [(s, e) for s, e in shallow_regions(kept, threshold, least)]
        back = []
        for r in kicked:
            for s, e in edges:
                lo, hi = max(r.start, s - overlap), min(r.end, e + overlap)
                inside = [k for k in range(lo, hi) if agreed[k] not in (GAP, "X")]
                if hi - lo >= overlap and len(inside) >= overlap and all(r.seq[k] == agreed[k] for k in inside):
                    back.append(r)
                    break
        if not back:
            return out
        out += [r.name for r in back]
        kept += back
        kicked = [r for r in kicked if r not in back]
    return out


def _translated(nt: str) -> str:
    return "".join(CODONS.get(nt[k : k + 3], "X") for k in range(0, len(nt) - 2, 3))


def _joined_chunks(a: dict, b: dict, overlap: int) -> dict | None:
    """One hit of two on a parent, or None: same strand and codon phase, ``overlap`` places in common, neighbouring nodes (any node of b is at
    most one above any of a), and the same protein where they overlap. Letters are the first one's where both have some."""
    if a["strand"] != b["strand"] or min(a["end"], b["end"]) - max(a["start"], b["start"]) < overlap or (a["start"] - b["start"]) % 3:
        return None
    if min(b["ids"]) - max(a["ids"]) > 1:
        return None
    # Texts run along their own strand: from the start of a plus hit, from the end of a minus one.
    lead = b["end"] - a["end"] if a["strand"] == "-" else a["start"] - b["start"]
    at_a, at_b = max(lead, 0), max(-lead, 0)
    lo, hi = max(at_a, at_b), min(at_a + len(a["seq"]), at_b + len(b["seq"]))
    if hi <= lo or _translated(a["seq"][lo - at_a : hi - at_a]) != _translated(b["seq"][lo - at_b : hi - at_b]):
        return None
    seq = a["seq"] if at_a <= at_b else b["seq"][: at_a - at_b] + a["seq"]
    seq += b["seq"][max(0, at_a + len(a["seq"]) - at_b) :]
    return a | {"start": min(a["start"], b["start"]), "end": max(a["end"], b["end"]), "seq": seq, "ids": sorted({*a["ids"], *b["ids"]})}


def chunks_merged(hits: list[dict], gap: int = 300, overlap: int = 30, rounds: int = 15) -> list[dict]:
    """G5. Hits on a parent (name, strand, start, end, ids, seq) by node: within runs of nodes less than ``gap`` apart, a later hit joins an
    earlier one where it can, in up to ``rounds`` rounds until none does."""
    now = sorted(hits, key=lambda h: (min(h["ids"]), h["start"], h["end"], h["name"]))
    for _ in range(rounds):
        changed = False
        runs: list[list[dict]] = []
        for h in now:
            if runs and min(h["ids"]) - min(runs[-1][-1]["ids"]) < gap:
                runs[-1].append(h)
            else:
                runs.append([h])
        out = []
        for run in runs:
            k = 0
            while k < len(run):
                m = k + 1
                while m < len(run):
                    both = _joined_chunks(run[k], run[m], overlap)
                    if both is None:
                        m += 1
                        continue
                    run[k] = both
                    del run[m]
                    changed = True
                k += 1
            out += run
        now = out
        if not changed:
            break
    return now
