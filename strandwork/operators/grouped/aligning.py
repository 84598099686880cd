"""Alignment by dynamic programming, in numpy: what intron removal and seeded search need of an aligner (G4, G6, E)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandwork.functions.dna import CODONS
from strandwork.operators.grouped.columns import GAP
from strandwork.operators.grouped.trimming import splice_candidates


def global_alignment(a: str, b: str, match: int = 2, mismatch: int = -1, gap: int = -2) -> tuple[str, str]:
    """Needleman-Wunsch with linear gaps. Rows are vectors: gaps along a row are a running maximum. Ties: diagonal, up, left."""
    x, y = np.frombuffer(a.encode("latin-1"), np.uint8), np.frombuffer(b.encode("latin-1"), np.uint8)
    n, m = len(x), len(y)
    score = np.zeros((n + 1, m + 1), np.int32)
    score[0] = gap * np.arange(m + 1)
    step = gap * np.arange(m + 1)
    for i in range(1, n + 1):
        here = np.empty(m + 1, np.int32)
        here[0] = gap * i
        here[1:] = np.maximum(score[i - 1, :-1] + np.where(y == x[i - 1], match, mismatch), score[i - 1, 1:] + gap)
        score[i] = np.maximum.accumulate(here - step) + step
    i, j, p, q = n, m, [], []
    while i or j:
        if i and j and score[i, j] == score[i - 1, j - 1] + (match if x[i - 1] == y[j - 1] else mismatch):
            i, j = i - 1, j - 1
            p.append(a[i])
            q.append(b[j])
        elif i and score[i, j] == score[i - 1, j] + gap:
            i -= 1
            p.append(a[i])
            q.append(GAP)
        else:
            j -= 1
            p.append(GAP)
            q.append(b[j])
    return "".join(reversed(p)), "".join(reversed(q))


#: Letters of reads, and of targets, of a block of the seeded search.
BLOCK_LETTERS = 1 << 22
#: Cells of a batch of alignments that go side by side; a batch's steps take a byte for each cell.
CELLS = 1 << 25


def global_alignments(texts: list[str], b: str, match: int = 2, mismatch: int = -1, gap: int = -2) -> list[tuple[str, str]]:
    """global_alignment() of each text with one other: texts of like length go side by side, a step for each letter."""
    out: list[tuple[str, str]] = [("", "")] * len(texts)
    order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
    at = 0
    while at < len(order):
        # The longest of a batch counts: take as many as fit with it.
        size = 1
        while at + size < len(order) and (size + 1) * (len(texts[order[at + size]]) + 1) * (len(b) + 1) <= CELLS:
            size += 1
        part = order[at : at + size]
        for k, pair in zip(part, _side_by_side([texts[k] for k in part], b, match, mismatch, gap), strict=True):
            out[k] = pair
        at += size
    return out


def _side_by_side(texts: list[str], b: str, match: int, mismatch: int, gap: int) -> list[tuple[str, str]]:
    """All cells of as many letters from both begins at once, of all texts: no cell waits for another of its step."""
    n, rows, m = len(texts), max(map(len, texts)), len(b)
    y = np.frombuffer(b.encode("latin-1"), np.uint8)[::-1, None]
    x = np.zeros((rows, n), np.uint8)
    for k, t in enumerate(texts):
        x[: len(t), k] = np.frombuffer(t.encode("latin-1"), np.uint8)
    # Scores less the gaps that as many letters would cost: so gaps cost nothing, and the borders are zero.
    equal, other = match - 2 * gap, mismatch - 2 * gap
    kind = np.int16 if max(abs(equal), abs(other)) * (min(rows, m) + 1) < 32000 else np.int32
    held = np.zeros((3, rows + 1, n), kind)
    step, first = np.empty(((rows + 1) * (m + 1), n), np.uint8), np.empty(rows + m + 1, np.int64)
    at = 0
    for d in range(rows + m + 1):
        lo, hi = max(0, d - m), min(d, rows)
        first[d] = at - lo
        at += hi - lo + 1
        now, last, older = held[d % 3], held[(d - 1) % 3], held[(d - 2) % 3]
        if lo == 0:
            now[0], step[first[d]] = 0, 2
        if hi == d:
            now[d], step[first[d] + d] = 0, 1
        s, e = max(1, lo), min(rows, d - 1) + 1
        if s < e:
            met = np.multiply(x[s - 1 : e - 1] == y[m - d + s : m - d + e], kind(equal - other), dtype=kind)
            met += kind(other)
            met += older[s - 1 : e - 1]
            best = np.maximum(last[s - 1 : e - 1], last[s:e], out=now[s:e])
            np.maximum(best, met, out=best)
            far = best != met
            np.add(far, far & (best != last[s - 1 : e - 1]), out=step[first[d] + s : first[d] + e], dtype=np.uint8)
    step[0] = 3  # the begin of both
    # Back along all paths together: 0 both go, 1 the text goes, 2 the other goes, 3 at the begin.
    i, j, each, path = np.array([len(t) for t in texts]), np.full(n, m), np.arange(n), np.empty((rows + m, n), np.uint8)
    flat = step.reshape(-1)
    for k in range(rows + m):
        path[k] = own = flat[(first[i + j] + i) * n + each]
        i -= own < 2
        j -= (own & 1) == 0
    other_text, out = np.frombuffer(b.encode("latin-1"), np.uint8), []
    for k, t in enumerate(texts):
        own = path[:, k]
        own = own[own < 3][::-1]
        pair = []
        for text, has in ((np.frombuffer(t.encode("latin-1"), np.uint8), own < 2), (other_text, own != 1)):
            line = np.full(len(own), ord(GAP), np.uint8)
            line[has] = text
            pair.append(line.tobytes().decode("latin-1"))
        out.append((pair[0], pair[1]))
    return out


def inserted_letters(top: str, bottom: str) -> tuple[list[tuple[int, str]], str]:
    """Of a text aligned to a centre: the letters between two of the centre's, with their places, and its letters under the centre's."""
    inserted: dict[int, list[str]] = {}
    own: list[str] = []
    for a, c in zip(top, bottom, strict=True):
        if c == GAP:
            inserted.setdefault(len(own), []).append(a)
        else:
            own.append(a)
    return [(k, "".join(v)) for k, v in inserted.items()], "".join(own)


def widened(inserted: list[tuple[int, str]], own: str, wide: dict[int, int]) -> str:
    """The text of inserted_letters() where each place between two letters of the centre is as wide as given, 0 if not."""
    held, out, at = dict(inserted), [], 0
    for k in sorted(wide):
        out += [own[at:k], held.get(k, "").ljust(wide[k], GAP)]
        at = k
    return "".join([*out, own[at:]])


def star_alignment(rows: list[tuple[str, str]], centre: str | None = None) -> list[tuple[str, str]]:
    """G3, G8 and E. (name, aligned seq) of rows (name, seq without gaps), all as wide: each is aligned to one centre (that of the given
    name, else the longest, ties by name), and letters between two of the centre's share columns, as many as the most that any row has there."""
    rows = sorted(rows)
    if not rows:
        return []
    middle = dict(rows)[centre] if centre else max(rows, key=lambda r: (len(r[1]), [-ord(c) for c in r[0]]))[1]
    parts = []
    for name, seq in rows:
        parts.append((name, *inserted_letters(*(global_alignment(seq, middle) if seq != middle else (seq, middle)))))
    wide: dict[int, int] = {}
    for _, inserted, _ in parts:
        for k, text in inserted:
            wide[k] = max(wide.get(k, 0), len(text))
    return [(name, widened(inserted, own, wide)) for name, inserted, own in parts]


def signature_clusters(rows: list[tuple[str, str]], k: int = 5, most: int = 500, share: float = 0.3) -> list[list[str]]:
    """H10 and G8. Names of rows (name, seq) in groups of similar k-mers: from the longest row on, each joins the first group whose
    leader shares ``share`` of the k-mers of the row that has fewer, and that has room."""
    groups: list[tuple[set[str], list[str]]] = []
    for name, seq in sorted(rows, key=lambda r: (-len(r[1]), r[0])):
        own = {seq[i : i + k] for i in range(max(1, len(seq) - k + 1))}
        for leader, names in groups:
            if len(names) < most and len(own & leader) >= share * min(len(own), len(leader)):
                names.append(name)
                break
        else:
            groups.append((own, [name]))
    return [names for _, names in groups]


def clusterwise_alignment(rows: list[tuple[str, str]], references: list[tuple[str, str]], k: int = 5, most: int = 500) -> list[tuple[str, str]]:
    """G8. Rows aligned with the references of their gene: each group of similar rows, of at most ``most``, takes the frame of the
    longest reference; equal rows are aligned once and inserted again (A2)."""
    once: dict[str, list[str]] = {}
    for name, seq in sorted(rows):
        once.setdefault(seq, []).append(name)
    distinct = [(names[0], seq) for seq, names in once.items()]
    ordered = [(n, dict(distinct)[n]) for group in signature_clusters(distinct, k, most) for n in group]
    if not references:
        done = star_alignment(ordered)
    else:
        centre = max(references, key=lambda r: (len(r[1]), [-ord(c) for c in r[0]]))[0]
        done = star_alignment([*references, *[(f"\x00{n}", s) for n, s in ordered]], centre)
    out = []
    for name, seq in done:
        plain = name.lstrip("\x00")
        out += [(other, seq) for other in (once[dict(distinct)[plain]] if name != plain or not references else [plain])]
    return out


def introns_removed(seq: str, reference: str, least_group: int = 10, join: int = 10, least: int = 30, reach: int = 10) -> tuple[str, list[tuple[int, int]]]:
    """G6. introns_of() by the usual alignment and, if stops are left in the sequence's frame, by one with cheaper gaps: the one that
    leaves fewer stops."""
    return all_introns_removed([seq], reference, least_group, join, least, reach)[0]


def _stops(text: str) -> int:
    """Stops in the sequence's frame; the last codon may be one."""
    return sum(CODONS.get(text[k : k + 3]) == "*" for k in range(0, len(text) - 5, 3))


def all_introns_removed(seqs: list[str], reference: str, least_group: int = 10, join: int = 10, least: int = 30, reach: int = 10) -> list[tuple[str, list[tuple[int, int]]]]:
    """introns_removed() of each of several sequences of one reference, aligned side by side."""
    out = [introns_of(*pair, least_group, join, least, reach) for pair in global_alignments(seqs, reference)]
    again = [k for k, found in enumerate(out) if _stops(found[0])]
    for k, pair in zip(again, global_alignments([seqs[k] for k in again], reference, 2, -3, -1), strict=True):
        second = introns_of(*pair, least_group, join, least, reach)
        if _stops(second[0]) < _stops(out[k][0]):
            out[k] = second
    return out


def introns_of(top: str, bottom: str, least_group: int, join: int, least: int, reach: int) -> tuple[str, list[tuple[int, int]]]:
    """G6. The sequence without introns, and their [start, end): where its alignment to a reference leaves at least ``least_group``
    letters of the sequence without partner (groups at most ``join`` apart are one), the GT..AG nearest to the group, within
    ``reach`` of it, is taken out if it has at least ``least`` letters, a multiple of three, and meets none taken before."""
    seq = top.replace(GAP, "")
    at, groups = 0, []
    for c, r in zip(top, bottom, strict=True):
        if c != GAP:
            if r == GAP:
                if groups and at - groups[-1][1] <= join:
                    groups[-1][1] = at + 1
                else:
                    groups.append([at, at + 1])
            at += 1
    out: list[tuple[int, int]] = []
    for s, e in groups:
        if e - s < least_group:
            continue
        lo, hi = max(0, s - reach), min(len(seq), e + reach)
        found = [(g + lo, a + lo) for g, a in splice_candidates(seq[lo:hi], least)]
        found = [(g, a) for g, a in found if all(a <= x or g >= y for x, y in out)]
        if found:
            out.append(min(found, key=lambda x: (abs(x[0] - s) + abs(x[1] - e), x)))
    out.sort()
    kept, last = [], 0
    for s, e in out:
        kept.append(seq[last:s])
        last = e
    return "".join([*kept, seq[last:]]), out


def seeded_hits(reads: DataFrame, targets: DataFrame, k: int = 5, least: int = 2) -> DataFrame:
    """E. A k-mer seeded search in place of an external one: of reads (node, frame, aa) and targets (target, seq), the pairs that share
    at least ``least`` different k-mers, with their number as score and the span of shared k-mers in the read.

    Blocks of reads meet blocks of targets, so only texts are shuffled; a block of targets is its k-mers, each with who bears it, and of a read only
    the pairs that stay are formed.
    """
    spark = reads.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    letters = lambda df, c: df.agg(F.ceil(F.sum(F.length(c)) / BLOCK_LETTERS)).first()[0] or 1
    n_parts, n_blocks = max(n, letters(reads, "aa")), letters(targets, "seq")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    own = reads.select("node", "frame", "aa", F.pmod(F.xxhash64("node", "frame"), F.lit(n_parts)).cast("int").alias("part")).withColumn("block", every(n_blocks))
    known = targets.where("seq is not null").select("target", "seq", F.pmod(F.xxhash64("target"), F.lit(n_blocks)).cast("int").alias("block")).withColumn("part", every(n_parts))
    known = known.select(*[F.col(c).alias(c) for c in known.columns])  # columns of its own: both sides may come from the same table
    kinds = [(reads, "node"), (reads, "frame"), (targets, "target")]
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for df, c in kinds) + ", score long, qstart int, qend int"
    at = ["part", "block"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        bears, names = {}, []
        of_target: dict = {}
        for name, seq in zip(right.column("target").to_pylist(), right.column("seq").to_pylist(), strict=True):
            if name not in of_target:
                of_target[name] = len(names)
                names.append(name)
            for i in range(len(seq) - k + 1):
                bears.setdefault(seq[i : i + k], set()).add(of_target[name])
        bears = {x: np.array(sorted(v)) for x, v in bears.items()}
        places: dict = {}
        for i, (key, text) in enumerate(zip(zip(left.column("node").to_pylist(), left.column("frame").to_pylist(), strict=True), left.column("aa").to_pylist(), strict=True)):
            spans = places.setdefault(key, (i, {}))[1]
            for j in range(len(text or "") - k + 1):
                x = text[j : j + k]
                if x in bears:
                    first, last = spans.get(x, (j, j))
                    spans[x] = (min(first, j), max(last, j))
        row, target, score, start, end = [], [], [], [], []
        for i, spans in places.values():
            if len(spans) < least:
                continue
            who = [bears[x] for x in spans]
            size = np.array([len(w) for w in who])
            where = np.concatenate(who)
            ends = np.repeat(np.array(list(spans.values())), size, 0)
            count = np.bincount(where, minlength=len(names))
            low, high = np.full(len(names), np.iinfo(np.int32).max), np.full(len(names), -1)
            np.minimum.at(low, where, ends[:, 0])
            np.maximum.at(high, where, ends[:, 1])
            stay = np.flatnonzero(count >= max(least, 1))
            row.append(np.full(len(stay), i))
            for out, values in ((target, stay), (score, count[stay]), (start, low[stay]), (end, high[stay] + k)):
                out.append(values)
        whole = lambda parts, kind: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64()).cast(kind)
        some = whole(row, pa.int64())
        return pa.table({"node": left.column("node").take(some), "frame": left.column("frame").take(some), "target": pa.array(names, right.column("target").type).take(whole(target, pa.int64())), "score": whole(score, pa.int64()), "qstart": whole(start, pa.int32()), "qend": whole(end, pa.int32())})

    return own.repartition(n, *at).groupBy(*at).cogroup(known.repartition(n, *at).groupBy(*at)).applyInArrow(run, schema)


def intron_free(rows: DataFrame) -> DataFrame:
    """G6 for (gene, node, seq, reference): seq without introns, and introns."""
    schema = "gene string, node long, seq string, introns array<struct<s:int,e:int>>"

    def run(batches):
        for pdf in batches:
            for reference, own in pdf.groupby("reference", sort=False):
                done = all_introns_removed(own["seq"].tolist(), reference)
                yield pd.DataFrame({"gene": own["gene"], "node": own["node"], "seq": [d[0] for d in done], "introns": [[{"s": s, "e": e} for s, e in d[1]] for d in done]})

    # Dealt into all partitions: rows are small to shuffle and long to align.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("gene", "node", "seq", "reference").repartition(n, "gene", "node").mapInPandas(run, schema)
