"""Views of the driver's tables in the shape of this domain, with the same views in SQL.

The tables hold no sequences: hits come from lineitem and part, sequences from texts whose letters are mapped to A, C, G and T.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwork.scratch import ship

LETTERS, MAPPED = "BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAC"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def acgt(text: Column) -> Column:
    return F.translate(F.upper(F.regexp_replace(text, "[^A-Za-z]", "")), LETTERS, MAPPED)


ACGT_SQL = f"translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{LETTERS}', '{MAPPED}')"


def with_n(text: Column) -> Column:
    """As acgt(), but for N and every Q, which stand for unknown bases."""
    return F.translate(F.upper(F.regexp_replace(text, "[^A-Za-z]", "")), "BDEFHIJKLMOPQRSUVWXYZ", "ACGTACGTACGTNCGTACGTA")


WITH_N_SQL = "translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BDEFHIJKLMOPQRSUVWXYZ', 'ACGTACGTACGTNCGTACGTA')"


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, seq."""
    return load(spark, sf_dir, "documents").where("text is not null").select("doc_id", "source", "lang", acgt(F.col("text")).alias("seq"))


READS_SQL = f"reads AS (SELECT doc_id, source, lang, {ACGT_SQL} AS seq FROM documents WHERE text IS NOT NULL)"


#: Columns of where a row stands in its table, for orders that leave rows equal: of those the first in the table is first, as SQL reads them.
PLACE = ["file", "row"]


def line_hits(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """header, line, target, taxon, frame, score, qstart, qend: also of lines whose part is not there; with PLACE if ``placed``."""
    line = load(spark, sf_dir, "lineitem")
    frame = (F.col("l_linenumber") % 3 + 1) * F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    start, size = F.col("l_quantity").cast("int"), 10 + (F.col("l_partkey") % 30).cast("int")
    low, high = start, start + size
    return line.select(
        F.col("l_orderkey").alias("header"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("target"), F.col("l_suppkey").alias("taxon"), frame.cast("int").alias("frame"),
        F.col("l_extendedprice").alias("score"), F.when(frame < 0, high).otherwise(low).alias("qstart"), F.when(frame < 0, low).otherwise(high).alias("qend"),
        *([F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")] if placed else []),
    )


def hits(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """header, line, target, gene, taxon, frame, score, qstart, qend; with PLACE of the line if ``placed``."""
    rows, part = line_hits(spark, sf_dir, placed), load(spark, sf_dir, "part")
    return rows.join(part.select(F.col("p_partkey").alias("target"), F.col("p_brand").alias("gene")), "target")


HITS_SQL = """hits AS (
  SELECT header, line, target, gene, taxon, frame, score, CASE WHEN frame < 0 THEN high ELSE low END AS qstart, CASE WHEN frame < 0 THEN low ELSE high END AS qend
  FROM (SELECT l_orderkey AS header, l_linenumber AS line, l_partkey AS target, l_suppkey AS taxon, p_brand AS gene, l_extendedprice AS score,
               CAST((l_linenumber % 3 + 1) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS INTEGER) AS frame,
               CAST(floor(l_quantity) AS INTEGER) AS low, CAST(floor(l_quantity) AS INTEGER) + 10 + CAST(l_partkey % 30 AS INTEGER) AS high
        FROM lineitem JOIN part ON l_partkey = p_partkey))"""


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, doc_id, weight, seq: each document's sequence with every TT as gaps; rows of a language begin in one column."""
    seq = F.replace("seq", F.lit("TT"), F.lit("--"))
    return reads(spark, sf_dir).select("lang", "doc_id", (F.col("doc_id") % 3 + 1).alias("weight"), seq.alias("seq"))


ALIGNMENT_SQL = READS_SQL + ", msa AS (SELECT lang, doc_id, doc_id % 3 + 1 AS weight, replace(seq, 'TT', '--') AS seq FROM reads)"
LETTERS_SQL = ALIGNMENT_SQL + """, letters AS (SELECT lang, doc_id, weight, s, e, unnest(range(0, length(seq))) AS place, unnest(string_split(seq, '')) AS ch
  FROM (SELECT *, length(seq) - length(ltrim(seq, '-')) AS s, length(rtrim(seq, '-')) AS e FROM msa WHERE seq <> ''))"""
