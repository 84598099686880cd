"""The BLOSUM62 substitution matrix: sets of letters by strictness (X20) and distances of aligned proteins (H8)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The published matrix, lower triangle, rows and columns in this order.
LETTERS = "ARNDCQEGHILKMFPSTWYV"
TRIANGLE = """
 4
-1 5
-2 0 6
-2 -2 1 6
 0 -3 -3 -3 9
-1 1 0 0 -3 5
-1 0 0 2 -4 2 5
 0 -2 0 -1 -3 -2 -2 6
-2 0 1 -1 -3 0 0 -2 8
-1 -3 -3 -3 -1 -3 -3 -4 -3 4
-1 -2 -3 -4 -1 -2 -3 -4 -3 2 4
-1 2 0 -1 -3 1 1 -2 -1 -3 -2 5
-1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1 5
-2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0 6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4 7
 1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1 4
 0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1 5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2 7
 0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1 4
"""
#: Scores above these count as similar.
STRICTNESS = {"lax": -1, "strict": 0, "exact": 999_999}

_ROWS = [list(map(int, line.split())) for line in TRIANGLE.split("\n") if line.strip()]
#: Scores by code point; where either letter is none of the twenty, UNKNOWN.
UNKNOWN = -128
SCORES = np.full((256, 256), UNKNOWN, np.int64)
for _i, _row in enumerate(_ROWS):
    for _j, _s in enumerate(_row):
        SCORES[ord(LETTERS[_i]), ord(LETTERS[_j])] = SCORES[ord(LETTERS[_j]), ord(LETTERS[_i])] = _s


def similar_letters(strictness: str = "strict") -> dict[str, str]:
    """X20. For each letter those whose score with it is above the limit, itself included where its own is."""
    least = STRICTNESS[strictness]
    return {a: "".join(b for b in LETTERS if SCORES[ord(a), ord(b)] > least) for a in LETTERS}


def similar_column(letter: Column, strictness: str = "strict") -> Column:
    """X20 as a column: the similar letters of a letter, empty for others."""
    table = F.create_map(*[F.lit(x) for pair in similar_letters(strictness).items() for x in pair])
    return F.coalesce(F.element_at(table, letter), F.lit(""))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("latin-1", "replace"), np.uint8)


def blosum62_distance(a: str | np.ndarray, b: str | np.ndarray) -> float:
    """H8. 1 - 2 S(a, b) / (S(a, a) + S(b, b)), scores summed over places where both have one of the twenty letters; at least 0; NaN without any.

    The exact form of the distance is a choice of this library: 0 for equal texts, 1 where substitutions score nothing.
    """
    x, y = (codes(t) if isinstance(t, str) else t for t in (a, b))
    n = min(len(x), len(y))
    x, y = x[:n], y[:n]
    ok = SCORES[x, y] > UNKNOWN
    if not ok.any():
        return float("nan")
    x, y = x[ok], y[ok]
    return max(0.0, float(1 - 2 * SCORES[x, y].sum() / (SCORES[x, x].sum() + SCORES[y, y].sum())))


def blosum62(a: Column, b: Column) -> Column:
    """H8 for columns of aligned text; null for a null or where nothing can be compared."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        found = [None if s is None or t is None else blosum62_distance(s, t) for s, t in zip(x, y, strict=True)]
        return pd.Series([None if d is None or d != d else d for d in found], dtype="float64")

    return run(a, b)
