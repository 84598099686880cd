"""The library's functions under SQL names (M2): scalar functions on columns, and table functions of reads."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strandwork.functions.blosum import blosum62_distance
from strandwork.functions.dna import CODONS

_AMINO = ", ".join(f"'{c}', '{a}'" for c, a in CODONS.items())
#: Functions that SQL itself can say: they are planned as part of the query that calls them.
SQL_FUNCTIONS = {
    "reverse_complement": ("(seq STRING) RETURNS STRING", "translate(reverse(seq), 'ACGTN', 'TGCAN')"),
    "translate_codons": ("(seq STRING) RETURNS STRING", f"array_join(transform(filter(split(seq, '(?<=\\\\G.{{3}})'), c -> length(c) = 3), c -> coalesce(element_at(map({_AMINO}), c), 'X')), '')"),
    "chunks": (
        "(seq STRING, size INT, step INT, least INT) RETURNS TABLE (`start` INT, `end` INT, `last` INT, seq STRING)",
        "SELECT at, at + size - 1, length(part) - 1, part FROM (SELECT at, substring(seq, at + 1, size) AS part FROM (SELECT explode(CASE WHEN length(seq) > 0 THEN sequence(0, length(seq) - 1, step) END) AS at)) WHERE length(part) >= least",
    ),
}


@pandas_udf(DoubleType())
def blosum_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """H8."""
    found = [None if x is None or y is None else blosum62_distance(x, y) for x, y in zip(a, b, strict=True)]
    return pd.Series([None if d is None or d != d else d for d in found], dtype="float64")


@udtf(returnType=StructType([StructField("offset", IntegerType()), StructField("seq", StringType())]))
class SplitAtN:
    """X11: the parts between runs of N with at least ``least`` letters."""

    def eval(self, seq: str, least: int):
        for m in re.finditer(f"[^N]{{{max(1, least)},}}", seq or ""):
            yield m.start(), m[0]


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Makes the functions known to spark.sql; returns their names. X1, X2 and X12 are SQL functions, H8 and X11 run in Python."""
    for name, (head, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{head} RETURN {body}")
    spark.udf.register(f"{prefix}blosum_distance", blosum_distance)
    spark.udtf.register(f"{prefix}split_at_n", SplitAtN)
    return [prefix + n for n in (*SQL_FUNCTIONS, "blosum_distance", "split_at_n")]
