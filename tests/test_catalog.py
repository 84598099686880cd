import pytest
from pyspark.sql import functions as F

from strandwork.functions import msa
from strandwork.sources import catalog as C


def test_tables_and_fallbacks(spark, tmp_path):
    cat = C.Catalog(spark, f"file://{tmp_path}/tables")
    rows = spark.createDataFrame([("g1", "a", 1), ("g2", "b", 2), ("g2", "c", 3)], "gene string, name string, node long")
    cat.put("reads", rows, by="gene", rows_per_file=1)
    assert cat.get("reads", "gene", ["g2"]).count() == 2 and not cat.has("final")
    cat.put("trimmed", rows.limit(1))
    assert cat.first_of(C.REFERENCE_ORDER).count() == 1
    with pytest.raises(FileNotFoundError):
        cat.first_of(C.STAGE_ORDER)
    assert [r["name"] for r in cat.reads_of(spark.createDataFrame([(3,), (3,), (9,)], "node long")).collect()] == ["c"]


def test_small_sources_and_sinks(spark, tmp_path):
    (tmp_path / "empty.fa").write_text("")
    (tmp_path / "full.fa").write_text(">a\nAC\n")
    assert [r["path"].rsplit("/")[-1] for r in C.files_with_data(spark, f"file://{tmp_path}/*.fa").collect()] == ["full.fa"]
    (tmp_path / "iso.tsv").write_text("a\tb\tc\td\te\tf\nG1\tOrg\tP1\tprotein Isoform X1\tAcc\tMK\nG1\tOrg\tP2\tprotein\tAcc\tMK\n")
    assert [r["pub_gene_id"] for r in C.read_isoforms(spark, f"file://{tmp_path}/iso.tsv").collect()] == ["P1"]
    (tmp_path / "acc.csv").write_text("Accession No,Order\nA1,\nA2,Diptera\n")
    acc = C.read_accessions(spark, f"file://{tmp_path}/acc.csv")
    known = spark.createDataFrame([("A1", "Odonata", "fam")], "accession_no string, order string, family string")
    assert sorted((r["accession_no"], r["order"], r["family"]) for r in C.filled_taxonomy(acc, known, "accession_no").collect()) == [("A1", "Odonata", "fam"), ("A2", "Diptera", None)]
    rows = spark.createDataFrame([("g1", "A", "MK"), ("g2", "B", "LLL")], "gene string, taxon string, seq string")
    C.write_concatenation(rows, f"file://{tmp_path}/cat")
    assert [r[0] for r in spark.read.text(f"file://{tmp_path}/cat/nexus").collect()] == ["charset g1 = 1-2;", "charset g2 = 3-5;"]
    C.write_counts(rows, f"file://{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/csv").count() == 2


def test_more_text_functions(spark):
    row = spark.range(1).select(
        msa.minimum_data(F.lit("A-CX"), 2, gap="-X").alias("a"), msa.minimum_data(F.lit("A-CX"), 2, F.array(F.lit(0)), "-X").alias("b"), msa.same_variant(F.lit("abc12345678"), F.lit("abc87654321")).alias("c"),
        msa.gaps_inserted(F.lit("ACG"), F.array(F.lit(1), F.lit(4))).alias("d"), C.share(F.lit(0), F.lit(0)).alias("e"), C.share(F.lit(2), F.lit(0)).alias("f"), C.share(F.lit(1), F.lit(4)).alias("g"),
    ).first()
    assert tuple(row) == (True, False, True, "A-CG-", 0.0, 1.0, 0.25)
