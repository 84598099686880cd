"""Votes by column of aligned rows, as numpy arrays: the shared ground of assembling, filtering and merging."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

GAP = "-"


def span(seq: str, gap: str = GAP) -> tuple[int, int]:
    """[first, last + 1) letter of data; (0, 0) without any."""
    body = seq.strip(gap)
    if not body:
        return 0, 0
    start = len(seq) - len(seq.lstrip(gap))
    return start, start + len(body)


@dataclass
class Row:
    """An aligned row: its name, letters, weight and span."""

    name: str
    seq: str
    weight: int = 1
    start: int = field(init=False)
    end: int = field(init=False)

    def __post_init__(self) -> None:
        self.start, self.end = span(self.seq)

    def data(self) -> int:
        return len(self.seq) - self.seq.count(GAP)


def letters(rows: list[Row]) -> np.ndarray:
    """[row, column] code points, padded with gaps."""
    width = max((len(r.seq) for r in rows), default=0)
    text = "".join(r.seq.ljust(width, GAP) for r in rows)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(rows), width)


#: Letters of rows that are counted at once.
STEP = 1 << 22


def votes(rows: list[Row]) -> tuple[list[str], np.ndarray]:
    """(letters in ascending order, votes [letter, column]): rows vote inside their spans by weight. Rows are read in parts of bounded size."""
    width = max((len(r.seq) for r in rows), default=0)
    total: dict[int, np.ndarray] = {}
    per = max(1, STEP // max(1, width))
    for at in range(0, len(rows), per):
        part = rows[at : at + per]
        m = letters(part)
        place = np.arange(m.shape[1])
        inside = (place >= np.array([r.start for r in part])[:, None]) & (place < np.array([r.end for r in part])[:, None])
        weight = np.array([r.weight for r in part], np.int64)
        for c in np.unique(m[inside]).tolist():
            total.setdefault(c, np.zeros(width, np.int64))[: m.shape[1]] += weight @ ((m == c) & inside)
    kinds = sorted(total)
    return [chr(c) for c in kinds], np.stack([total[c] for c in kinds]) if kinds else np.zeros((0, width), np.int64)


def consensus(rows: list[Row], threshold: float, least: int = 1) -> str:
    """A12 for one group: the letter with more than ``threshold`` of the votes, else the only one that is no gap, else X.

    Rows vote inside their spans by weight; columns with less than ``least`` votes are gaps.
    """
    return consensus_of(*votes(rows), threshold, least)


def consensus_of(kinds: list[str], count: np.ndarray, threshold: float, least: int = 1) -> str:
    """consensus() from votes()."""
    if not kinds:
        return GAP * count.shape[1]
    total = count.sum(0)
    best = len(kinds) - 1 - count[::-1].argmax(0)  # ties: the last letter
    data = np.array([c != GAP for c in kinds])
    some = (count > 0) & data[:, None]
    clear = count.max(0) > threshold * total
    name = np.array([ord(c) for c in kinds], np.uint32)
    out = np.where(clear, name[best], np.where(some.sum(0) == 1, name[some.argmax(0)], ord("X")))
    out = np.where((total < least) | (total == 0), ord(GAP), out)
    return out.astype("<u4").tobytes().decode("utf-32-le")


def runs_of(text: str, letter: str, join: int = 0) -> list[tuple[int, int]]:
    """[start, end) of the runs of a letter; runs at most ``join`` apart count as one."""
    out: list[tuple[int, int]] = []
    for k, c in enumerate(text):
        if c == letter:
            if out and k - out[-1][1] <= join:
                out[-1] = (out[-1][0], k + 1)
            else:
                out.append((k, k + 1))
    return out


def reference_counts(references: list[str]) -> list[dict[str, int]]:
    """How many references have each letter (no gap) in each column."""
    width = max(map(len, references), default=0)
    out: list[dict[str, int]] = [{} for _ in range(width)]
    for seq in references:
        for k, c in enumerate(seq):
            if c != GAP:
                out[k][c] = out[k].get(c, 0) + 1
    return out


def reference_letters(references: list[str]) -> list[dict[str, int]]:
    """As reference_counts(), with the gaps inside each reference's span."""
    out: list[dict[str, int]] = [{} for _ in range(max(map(len, references), default=0))]
    for seq in references:
        for k in range(*span(seq)):
            out[k][seq[k]] = out[k].get(seq[k], 0) + 1
    return out


class Counts:
    """How many of a gene's references have each letter in each column: what reference_counts() or reference_letters() tell, as one array."""

    def __init__(self, places, letters, votes, references: int, width: int):
        code = np.frombuffer("".join(letters).encode("utf-32-le"), np.uint32) if len(letters) else np.zeros(0, np.uint32)
        self.references, self.width = references, width
        self.kinds, number = np.unique(code, return_inverse=True)
        self.votes = np.zeros((width, len(self.kinds) + 1), np.int64)  # the last for letters that no reference has
        np.add.at(self.votes, (np.asarray(places, np.int64), number), np.asarray(votes, np.int64))

    @classmethod
    def of(cls, references: list[str]) -> Counts:
        found = [(k, c, n) for k, here in enumerate(reference_counts(references)) for c, n in here.items()]
        return cls([f[0] for f in found], [f[1] for f in found], [f[2] for f in found], len(references), max(map(len, references), default=0))

    def numbers(self, text: str) -> np.ndarray:
        """The column of ``votes`` of each letter."""
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not len(self.kinds):
            return np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(self.kinds, code), len(self.kinds) - 1)
        return np.where(self.kinds[at] == code, at, len(self.kinds))

    def dicts(self) -> list[dict[str, int]]:
        """As reference_counts() gives them."""
        names = [chr(c) for c in self.kinds.tolist()]
        out: list[dict[str, int]] = [{} for _ in range(self.width)]
        for k, j in zip(*np.nonzero(self.votes[:, :-1]), strict=True):
            out[k][names[j]] = int(self.votes[k, j])
        return out


def best_split(left: str, right: str, start: int, end: int, counts: list[dict[str, int]]) -> int:
    """G23. The place in [start, end] where going over from ``left`` to ``right`` agrees with most references; ties: the first."""
    own = lambda s, k: counts[k].get(s[k], 0) if k < len(counts) and k < len(s) else 0
    score = sum(own(right, k) for k in range(start, end))
    best, at = score, start
    for k in range(start, end):
        score += own(left, k) - own(right, k)
        if score > best:
            best, at = score, k + 1
    return at


def last_split(left: str, right: str, start: int, end: int, counts: list[dict[str, int]]) -> int:
    """G22. The place in [start, end) up to which, itself included, ``left`` gains most over ``right``, if it loses nothing; ties: the last; 0 where
    every place loses."""
    own = lambda s, k: counts[k].get(s[k], 0) if k < len(counts) and k < len(s) else 0
    gain = best = at = 0
    for k in range(start, end):
        gain += own(left, k) - own(right, k)
        if gain >= best:
            best, at = gain, k
    return at


def excised_split(left: str, right: str, start: int, end: int, letters: list[dict[str, int]]) -> int:
    """G14. The place in [start, end] where going over from ``left`` to ``right`` scores most; ties: the last. A letter scores the references that
    have it, or -1 if none has, and a gap 1 less; where nothing reaches -1, the start."""
    def own(s: str, k: int) -> int:
        here = letters[k].get(s[k], 0) if k < len(letters) else 0
        return (here or -1) - (s[k] == GAP)

    score = sum(own(right, k) for k in range(start, end))
    best, at = (score, start) if score >= -1 else (-1, start)
    for k in range(start, end):
        score += own(left, k) - own(right, k)
        if score >= best:
            best, at = score, k + 1
    return at
