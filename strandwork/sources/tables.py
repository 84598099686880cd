"""Text formats around the sequences: search hits, profile hits, features, name lists, legacy reference sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions.headers import json_field

HITS = "header long, target string, frame byte, evalue double, score float, qstart int, qend int, sstart long, send long"


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """S5. Search hits; the first line's tabs tell whether a tenth column, coverage, is there. One column means no hits."""
    first = spark.read.text(path).where("value != ''").limit(1).collect()
    tabs = first[0][0].count("\t") if first else 0
    schema = HITS + ", coverage float" * (tabs >= 9)
    rows = spark.read.schema(schema).option("sep", "\t").csv(path)
    return rows.where("false") if tabs == 0 else rows


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """S8. Profile hits: name, score and place of columns 0, 13, 17 and 18 of a domain table, comments skipped."""
    at = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where("value not like '#%' and trim(value) != ''").select(F.get(at, F.lit(0)).alias("name"), F.get(at, F.lit(13)).cast("double").alias("score"), F.get(at, F.lit(17)).cast("int").alias("start"), F.get(at, F.lit(18)).cast("int").alias("end"))


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """S9. Features with their attributes as a map."""
    schema = "parent string, source string, type string, start long, end long, score string, strand string, phase string, attributes string"
    return spark.read.schema(schema).option("sep", "\t").option("comment", "#").csv(path).withColumn("attribute", F.expr("str_to_map(attributes, ';', '=')"))


def write_gff(features: DataFrame, lengths: DataFrame, path: str) -> None:
    """K5. Features of all parents in order of parent and start, each parent after its region line."""
    line = F.concat_ws("\t", "parent", "source", "type", F.col("start").cast("string"), F.col("end").cast("string"), "score", "strand", "phase", "attributes")
    rows = features.select("parent", F.lit(1).alias("k"), "start", line.alias("value"))
    heads = lengths.select("parent", F.lit(0).alias("k"), F.lit(0).cast("long").alias("start"), F.concat(F.lit("##sequence-region "), "parent", F.lit(" 1 "), F.col("length").cast("string")).alias("value"))
    heads.unionByName(rows).orderBy("parent", "k", "start", "value").select("value").write.mode("overwrite").text(path)


def filled_features(new: DataFrame, old: DataFrame) -> DataFrame:
    """J16. ``new`` (parent, id, more) with nulls taken from ``old`` where it has the same parent and id."""
    o = old.select("parent", "id", *[F.col(c).alias(f"__{c}") for c in new.columns if c not in ("parent", "id")])
    return new.join(o, ["parent", "id"], "left").select("parent", "id", *[F.coalesce(c, f"__{c}").alias(c) for c in new.columns if c not in ("parent", "id")])


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """S12. One value a line, blanks trimmed, empty lines skipped."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value != ''").distinct()


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """S13."""
    return spark.read.schema("id string, name string").csv(path)


def references(records: DataFrame) -> DataFrame:
    """S11. gene, taxon, target and seq of reference records (file, idx, header, seq) in three kinds of header:
    GENE|TAXON|ID, ID {json} with pub_og_id and organism_name, or free text (gene: the file's name, target: the header).
    Repeated targets of a file get _1, _2 and on."""
    bars = F.split("header", r"\|")
    name = F.regexp_replace(F.regexp_extract("file", r"([^/]+)$", 1), r"\..*$", "")
    has_json, has_bars = F.contains("header", F.lit("{")), F.size(bars) >= 3
    rows = records.select(
        "file", "idx", "seq",
        F.when(has_json, json_field(F.col("header"), "pub_og_id")).when(has_bars, F.get(bars, F.lit(0))).otherwise(name).alias("gene"),
        F.when(has_json, json_field(F.col("header"), "organism_name")).when(has_bars, F.get(bars, F.lit(1))).otherwise(F.substring_index("header", " ", 1)).alias("taxon"),
        F.when(has_json, F.substring_index("header", " ", 1)).when(has_bars, F.get(bars, F.lit(2))).otherwise(F.col("header")).alias("target"),
    )
    again = F.row_number().over(Window.partitionBy("file", "target").orderBy("idx")) - 1
    return rows.withColumn("__n", again).select("gene", "taxon", F.when(F.col("__n") > 0, F.concat("target", F.lit("_"), F.col("__n").cast("string"))).otherwise(F.col("target")).alias("target"), "seq")


def legacy_reference_set(pairs: DataFrame, orthologs: DataFrame, aa: DataFrame, nt: DataFrame, taxa: DataFrame) -> DataFrame:
    """S10, J18. The four tables of a legacy set joined: gene, taxon, header, aa and, where there is one, nt."""
    rows = orthologs.select(F.col("sequence_pair").alias("pair"), F.col("ortholog_gene_id").alias("gene")).join(pairs.select(F.col("id").alias("pair"), "aa_seq", "nt_seq"), "pair")
    rows = rows.join(aa.select(F.col("id").alias("aa_seq"), "header", F.col("sequence").alias("aa"), "taxid"), "aa_seq").join(taxa.select(F.col("id").alias("taxid"), F.col("name").alias("taxon")), "taxid")
    return rows.join(nt.select(F.col("id").alias("nt_seq"), F.col("sequence").alias("nt")), "nt_seq", "left").select("gene", "taxon", "header", "aa", "nt")
