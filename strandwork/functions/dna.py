"""Column functions on nucleotide and protein text; all but translated_long() and six_frames() stay in the JVM."""

from collections.abc import Callable
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code in the order T, C, A, G of each codon position, and the IUPAC ambiguity letters.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
IUPAC = {"AG": "R", "CT": "Y", "CG": "S", "AT": "W", "GT": "K", "AC": "M", "CGT": "B", "AGT": "D", "ACT": "H", "ACG": "V", "ACGT": "N"}

CODONS = {"".join(c): a for c, a in zip(product(BASES, repeat=3), AMINO_ACIDS, strict=True)} | {"---": "-"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with ``value`` worked out once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def reverse_complement(seq: Column) -> Column:
    """X1. Letters other than A, C, G, T and N stay."""
    return F.translate(F.reverse(seq), "ACGTN", "TGCAN")


def strand_key(seq: Column) -> Column:
    """The same text for a sequence and its reverse complement."""
    return F.least(seq, reverse_complement(seq))


def codons(seq: Column) -> Column:
    """The complete triplets of a sequence, from its first letter on; one pass however long it is."""
    return F.filter(F.split(seq, r"(?<=\G.{3})"), lambda c: F.length(c) == 3)


def translated(seq: Column) -> Column:
    """X2. Amino acids of the complete codons; unknown ones are X."""

    def acid(c: Column) -> Column:
        at = [F.position(F.substring(c, k, 1), F.lit(BASES)) for k in (1, 2, 3)]
        code = (at[0] - 1) * 16 + (at[1] - 1) * 4 + at[2]
        return F.when(F.least(*at) > 0, F.substring(F.lit(AMINO_ACIDS), code, F.lit(1))).when(c == "---", "-").otherwise("X")

    return F.array_join(F.transform(codons(seq), acid), "")


#: Codes of letters: the four bases in order, 4 for any other, 5 for a gap; and the amino acid of three codes as a number to the base 6.
_CODE = np.full(256, 4, np.uint8)
_CODE[list(map(ord, BASES))] = range(4)
_CODE[ord("-")] = 5
_OTHER_STRAND = np.array([2, 3, 0, 1, 4, 5], np.uint8)
_ACID = np.full(216, ord("X"), np.uint8)
_ACID[[a * 36 + b * 6 + c for a in range(4) for b in range(4) for c in range(4)]] = list(AMINO_ACIDS.encode())
_ACID[5 * 43] = ord("-")
FRAMES = (1, 2, 3, -1, -2, -3)


def _acids(code: np.ndarray) -> np.ndarray:
    """The amino acid of the three letters that begin at each place."""
    c = code.astype(np.int16)
    return _ACID[c[:-2] * 36 + c[1:-1] * 6 + c[2:]] if len(c) > 2 else np.zeros(0, np.uint8)


def acids_at(seq: str) -> np.ndarray:
    """The amino acid of the codon that begins at each place, as letters."""
    return _acids(_CODE[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)])


def translated_long(seq: Column) -> Column:
    """X2 for long sequences: Arrow batches and a table look-up by numpy instead of an expression for each codon."""

    @F.arrow_udf("string")
    def run(part: pa.Array) -> pa.Array:
        one = lambda s: _acids(_CODE[np.frombuffer(s, np.uint8)])[::3].tobytes().decode()
        return pa.array([None if s is None else one(s.encode("latin-1", "replace")) for s in part.to_pylist()], pa.string())

    return run(seq)


def six_frames(seq: Column) -> Column:
    """X3 and X2. The translations of a sequence in frames 1, 2, 3, -1, -2 and -3, in that order (see FRAMES): one pass over its letters."""

    @F.arrow_udf("array<string>")
    def run(part: pa.Array) -> pa.Array:
        out = []
        for s in part.to_pylist():
            if s is None:
                out.append(None)
                continue
            code = _CODE[np.frombuffer(s.encode("latin-1", "replace"), np.uint8)]
            strands = _acids(code), _acids(_OTHER_STRAND[code[::-1]])
            out.append([a[k::3].tobytes().decode() for a in strands for k in range(3)])
        return pa.array(out, pa.list_(pa.string()))

    return run(seq)


def framed(seq: Column, frame: Column) -> Column:
    """X3. The sequence as read in frame 1 to 3 or, of the other strand, -1 to -3."""
    strand = F.when(frame < 0, reverse_complement(seq)).otherwise(seq)
    return let(strand, lambda s: F.substring(s, F.abs(frame), F.length(s)))


def iupac(bases: Column) -> Column:
    """The ambiguity letter of an array of bases; single bases stay, unknown sets are N."""
    table = F.create_map(*[F.lit(x) for pair in IUPAC.items() for x in pair])
    present = F.array_sort(F.array_distinct(F.filter(bases, lambda b: b != "-")))
    return F.when(F.size(present) == 1, F.element_at(present, 1)).otherwise(F.coalesce(F.element_at(table, F.array_join(present, "")), F.lit("N")))


def stop_to_x(aa: Column) -> Column:
    """X10 for proteins."""
    return F.translate(aa, "*", "X")


def stops_masked(nt: Column) -> Column:
    """X10 for codons: stop codons become NNN; a rest of one or two letters stays."""
    stops = F.array(*[F.lit(c) for c, a in CODONS.items() if a == "*"])
    whole = lambda s: F.array_join(F.transform(codons(s), lambda c: F.when(F.array_contains(stops, c), F.lit("NNN")).otherwise(c)), "")
    return let(nt, lambda s: F.concat(whole(s), F.substring(s, F.floor(F.length(s) / 3).cast("int") * 3 + 1, 2)))


def codon_positions(nt: Column, keep: tuple[int, ...]) -> Column:
    """F24. The letters at the given positions (1, 2, 3) of their codons."""
    return F.array_join(F.filter(F.split(nt, ""), lambda c, i: (i % 3 + 1).isin(*keep) & (c != "")), "")


def entropy(seq: Column, letters: str = "ACGT") -> Column:
    """F4. Shannon entropy of the given letters over log2 of their number: 0 for one letter only, null without any."""

    def of(count: Column) -> Column:
        total = F.aggregate(count, F.lit(0), lambda a, c: a + c)
        part = F.transform(count, lambda c: F.when(c > 0, -(c / total) * F.log2(c / total)).otherwise(0.0))
        return F.when(total > 0, F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.log2(F.lit(float(len(letters)))))

    counts = let(seq, lambda s: F.transform(F.array(*map(F.lit, letters)), lambda x: F.length(s) - F.length(F.replace(s, x, F.lit("")))))
    return let(counts, of)


def _cutter(pattern: str) -> Callable[[Column], Column]:
    def cut(s: Column) -> Column:
        n = F.floor(F.length(F.regexp_extract(s, pattern, 1)) / 3).cast("int") * 3
        return F.substring(s, n + 1, F.length(s)) if pattern[0] == "^" else F.substring(s, F.lit(1), F.length(s) - n)

    return cut


def homopolymer_trimmed(seq: Column, least: int = 9) -> Column:
    """W15. Runs of one letter, then of one pair of letters, are cut from both ends where they have at least ``least`` letters.

    Cuts have a multiple of three letters, so the reading frame stays.
    """
    for pattern in (rf"^((.)\2{{{least - 1},}})", rf"((.)\2{{{least - 1},}})$", rf"^((..)\2{{{(least + 1) // 2 - 1},}})", rf"((..)\2{{{(least + 1) // 2 - 1},}})$"):
        seq = let(seq, _cutter(pattern))
    return seq
