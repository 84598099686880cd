"""Named tables under one folder, and the smaller text sources and sinks around them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwork.operators.combining import charsets, concatenated

#: Where a stage looks for its input: the latest earlier stage that has written any.
REFERENCE_ORDER = ("final", "cleaned", "trimmed", "aligned", "raw")
STAGE_ORDER = ("internal", "excise", "clusters", "profile_filter", "screened")


class Catalog:
    """Tables as Parquet folders; a table may be split by one column, and reads of some of its values read their folders only."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def put(self, name: str, df: DataFrame, by: str | None = None, rows_per_file: int = 0) -> None:
        """K3 and K4."""
        writer = df.write.mode("overwrite")
        writer = writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/{name}")

    def get(self, name: str, by: str | None = None, values: list | None = None) -> DataFrame:
        """S7. The table, or its rows with the given values of the splitting column."""
        df = self.spark.read.parquet(f"{self.root}/{name}")
        return df.where(F.col(by).isin(values)) if by else df

    def has(self, name: str) -> bool:
        try:
            self.get(name)
        except AnalysisException:
            return False
        return True

    def first_of(self, names: tuple[str, ...]) -> DataFrame:
        """S16 and S17. The first table of the list that is there."""
        for n in names:
            if self.has(n):
                return self.get(n)
        raise FileNotFoundError(f"none of {', '.join(names)} under {self.root}")

    def reads_of(self, nodes: DataFrame, name: str = "reads") -> DataFrame:
        """S6. The reads whose node is in ``nodes``."""
        return self.get(name).join(nodes.select("node").distinct(), "node", "left_semi")


def files_with_data(spark: SparkSession, path: str, least: int = 1) -> DataFrame:
    """S4. path and length of files of at least ``least`` bytes."""
    return spark.read.format("binaryFile").load(path).select("path", "length").where(F.col("length") >= least)


def read_isoforms(spark: SparkSession, path: str) -> DataFrame:
    """S14. Rows whose description names an isoform, from a table of six columns with a header."""
    schema = "pub_og_id string, organism_name string, pub_gene_id string, description string, assembly_accession string, genome_sequence string"
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path).where("lower(description) like '%isoform%'")


def read_accessions(spark: SparkSession, path: str) -> DataFrame:
    """S15. A CSV or, where a reader of them is installed, an XLSX table of accessions or taxonomy, all columns as text, names in lower case."""
    if path.lower().endswith((".xlsx", ".xls")):
        import pandas as pd

        sheet = pd.read_excel(path.removeprefix("file://"), dtype=str)  # a small table by nature, read by the driver
        df = spark.createDataFrame(sheet.astype(object).where(sheet.notna(), None), ", ".join(f"`{c}` string" for c in sheet.columns))
    else:
        df = spark.read.option("header", True).csv(path)
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def with_reason(rows: DataFrame, reasons: dict[str, Column], kept: str = "kept") -> DataFrame:
    """K6. Rows with ``reason``: the first of the named conditions that holds, or ``kept``; what a filter logs is a table like any other."""
    reason = F.lit(kept)
    for name, holds in reversed(reasons.items()):
        reason = F.when(holds, name).otherwise(reason)
    return rows.withColumn("reason", reason)


def filled_taxonomy(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """J17. Empty or null columns of ``rows`` taken from ``known`` by ``key``."""
    more = [c for c in known.columns if c != key]
    k = known.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in more]).dropDuplicates(["__key"])
    out = rows.join(k, F.col(key) == F.col("__key"), "left")
    empty = lambda c: F.when(F.trim(F.col(c)) == "", None).otherwise(F.col(c))
    return out.select(*[F.coalesce(empty(c), f"__{c}").alias(c) if c in more else F.col(c) for c in rows.columns], *[F.col(f"__{c}").alias(c) for c in more if c not in rows.columns])


def write_concatenation(rows: DataFrame, path: str) -> None:
    """K7. path/fasta: each taxon's concatenated genes; path/nexus: the genes' places."""
    concatenated(rows).select(F.concat(F.lit(">"), "taxon", F.lit("\n"), "seq").alias("value")).write.mode("overwrite").text(f"{path}/fasta")
    line = F.concat(F.lit("charset "), "gene", F.lit(" = "), F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string"), F.lit(";"))
    charsets(rows).orderBy("first").coalesce(1).select(line.alias("value")).write.mode("overwrite").text(f"{path}/nexus")


def write_counts(rows: DataFrame, path: str) -> None:
    """K6 and K9. Small result tables as CSV with a header."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def share(part: Column, whole: Column) -> Column:
    """X16. part / whole; 0 where both are 0, 1 where only the whole is."""
    return F.when((part == 0) & (whole == 0), 0.0).when(whole == 0, 1.0).otherwise(part / whole)
