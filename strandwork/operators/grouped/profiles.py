"""Profiles of aligned references and searches with them."""

from __future__ import annotations

import numpy as np

from strandwork.functions.blosum import LETTERS, codes
from strandwork.operators.grouped.columns import GAP

_NUMBER = np.full(256, -1, np.int64)
for _k, _c in enumerate(LETTERS):
    _NUMBER[ord(_c)] = _k


def profile(references: list[str], most_gaps: float = 0.5, pseudo: float = 2.0) -> np.ndarray:
    """Log odds [column, letter] of the columns where at most ``most_gaps`` of the references have none of the twenty letters.

    Shares lean on equal ones by ``pseudo`` counts; all letters are equally likely elsewhere."""
    width = max(map(len, references), default=0)
    if not width:
        return np.zeros((0, len(LETTERS)))
    m = np.stack([_NUMBER[codes(r.ljust(width, GAP))] for r in references])
    keep = (m >= 0).mean(0) >= 1 - most_gaps
    count = np.stack([(m == k).sum(0) for k in range(len(LETTERS))], 1)[keep].astype(float)
    share = (count + pseudo / len(LETTERS)) / (count.sum(1, keepdims=True) + pseudo)
    return np.log(share * len(LETTERS))


def best_placement(seq: str, odds: np.ndarray, unknown: float = -1.0) -> tuple[float, int, int]:
    """(score, start, end) of the part of a text that fits a run of columns best, without gaps; (0, 0, 0) if nothing scores above 0.

    Row by row: the best run that ends at a letter and a column is what ended at both before, if that is above 0, and their score."""
    number = _NUMBER[codes(seq)]
    best, at = 0.0, (0, 0)
    run, length = np.zeros(len(odds)), np.zeros(len(odds), np.int64)
    for i, k in enumerate(number.tolist()):
        before, long = np.append(0.0, run[:-1]), np.append(0, length[:-1])
        on = before > 0
        run = np.where(on, before, 0.0) + (odds[:, k] if k >= 0 else unknown)
        length = np.where(on, long, 0) + 1
        if len(run) and run.max() > best + 1e-12:
            j = int(run.argmax())
            best, at = float(run[j]), (i + 1 - int(length[j]), i + 1)
    return best, *at
