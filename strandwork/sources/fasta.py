"""FASTA and FASTQ files as tables, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions.headers import regenerated, sample_name

SUFFIXES = ("fa", "fas", "fasta", "fq", "fastq", "fna")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """S1. file, idx (order in the file), header, seq of FASTA files, sequences on one or many lines, plain or gzip.

    Records are split at '>' on a new line by the text source, so plain files are read in many tasks. idx grows with the
    place in the file: where the split begins and the number of the record in its task, which is less than the bytes of a split
    that another one of the file follows.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("order"))
    text = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^\\s*>", "")
    parts = F.split(text, "\n", 2)
    rows = raw.select("file", "block", "order", F.trim(F.get(parts, F.lit(0))).alias("header"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), "\\s", "").alias("seq"))
    return rows.where("header != '' or seq != ''").select("file", (F.col("block") + F.col("order").bitwiseAND(F.lit((1 << 33) - 1))).alias("idx"), "header", "seq")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """S1. file, idx (place in the file, from 0), header and seq of FASTQ files, plain or gzip, four lines a record; other files are an error
    (sequences.SequenceSource reads records of any number of lines).

    Lines are read in as many tasks as Spark cuts files into; a line's number is its place in its cut and the lines of the cuts
    before it, which are counted first. No task holds a file.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    cuts = raw.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    cuts = cuts.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    line = F.col("id") - F.col("first") + F.col("before")
    lines = raw.join(cuts, ["file", "block"]).select("file", F.floor(line / 4).alias("idx"), (line % 4).alias("k"), F.rtrim(F.replace("value", F.lit("\r"), F.lit(""))).alias("value"))
    # Of the third and fourth line only the first letter and the length go on.
    short = lines.withColumn("value", F.when(F.col("k") == 2, F.substring("value", 1, 1)).when(F.col("k") == 3, F.length("value").cast("string")).otherwise(F.col("value")))
    part = lambda k, name: F.max(F.when(F.col("k") == k, F.col("value"))).alias(name)
    rows = short.groupBy("file", "idx").agg(part(0, "header"), part(1, "seq"), part(2, "plus"), part(3, "quals"))
    good = F.col("header").startswith("@") & (F.col("plus") == "+") & (F.coalesce("quals", F.lit("0")) == F.length("seq").cast("string"))
    blank = (F.col("header") == "") & F.col("seq").isNull()
    told = F.concat(F.lit("not a FASTQ record of four lines: "), "file", F.lit(", record "), F.col("idx").cast("string"))
    rows = rows.where(~blank).withColumn("header", F.when(F.coalesce(good, F.lit(False)), F.expr("substring(header, 2)")).otherwise(F.raise_error(told)))
    return rows.select("file", "idx", "header", "seq")


def samples(files: DataFrame) -> DataFrame:
    """S2 and S3. Rows of sequence files with ``sample``, the name that the files of one sample share."""
    known = F.lower("file").rlike(rf"\.({'|'.join(SUFFIXES)})(\.gz)?$")
    return files.where(known).withColumn("sample", sample_name(F.col("file")))


def write_fasta(rows: DataFrame, path: str, by: list[str] | None = None, compress: bool = False) -> None:
    """K1. Two lines for each row (header, seq), one folder for each value of ``by``."""
    text = rows.select(*(by or []), F.concat(F.lit(">"), F.col("header"), F.lit("\n"), F.col("seq")).alias("value"))
    writer = text.write.mode("overwrite").option("compression", "gzip" if compress else "none")
    (writer.partitionBy(*by) if by else writer).text(path)


def write_references(rows: DataFrame, path: str) -> None:
    """K12. Reference rows (gene, taxon, target, seq) as FASTA by gene, their names with taxon and gene as JSON."""
    named = rows.select("gene", regenerated(F.col("target"), F.col("taxon"), F.col("gene")).alias("header"), F.replace("seq", F.lit("-"), F.lit("")).alias("seq"))
    write_fasta(named, path, ["gene"])


def write_lines(rows: DataFrame, path: str) -> None:
    """K2. A flat list of the lines of records (idx, lines): names and sequences in turn, in order of idx. A record is sorted as one row, so its
    lines stay together in one file, whatever records of equal idx there are."""
    rows.orderBy("idx").select(F.explode("lines").alias("value")).write.mode("overwrite").text(path)
