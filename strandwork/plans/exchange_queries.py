"""Queries of sources and sinks: what is written in a format and read again is what SQL reads from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwork.functions import headers
from strandwork.operators import pairs
from strandwork.plans.registry import query
from strandwork.plans.tables import HITS_SQL, READS_SQL, hits, load, reads
from strandwork.scratch import new_path
from strandwork.sources import catalog, fasta, sequences, store, tables
from strandwork.streaming import stateful, windows


def _md5(c: str):
    return F.md5(F.col(c).cast("binary")).alias(f"{c}_md5")


def _put(df, tag: str, compression: str = "none") -> str:
    """Lines (column value) as text in the shared folder."""
    path = new_path(df.sparkSession, tag)
    df.select("value").write.option("compression", compression).text(path)
    return path


@query(f"WITH {READS_SQL} SELECT CAST(doc_id AS VARCHAR) AS header, length(seq) AS n, md5(seq) AS seq_md5 FROM reads")
def fasta_round_trip(spark, d):
    """S1 and K1, compressed, a folder for each language."""
    path = new_path(spark, "fasta")
    fasta.write_fasta(reads(spark, d).select("lang", F.col("doc_id").cast("string").alias("header"), "seq"), path, ["lang"], compress=True)
    return fasta.read_fasta(spark, f"{path}/*").select("header", F.length("seq").cast("long").alias("n"), _md5("seq"))


@query(f"WITH {READS_SQL} SELECT CAST(doc_id AS VARCHAR) AS header, md5(seq) AS seq_md5 FROM reads")
def fasta_lines(spark, d):
    """K2: a flat list of names and sequences."""
    path = new_path(spark, "lines")
    lines = F.array(F.concat(F.lit(">"), F.col("doc_id").cast("string")), F.col("seq"))
    fasta.write_lines(reads(spark, d).select(F.col("doc_id").alias("idx"), lines.alias("lines")), path)
    return fasta.read_fasta(spark, path).select("header", _md5("seq"))


@query(f"WITH {READS_SQL} SELECT CAST(doc_id AS VARCHAR) AS header, md5(seq) AS seq_md5 FROM reads WHERE seq <> ''")
def fastq_round_trip(spark, d):
    """Four lines a record."""
    record = F.concat(F.lit("@"), F.col("doc_id").cast("string"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.translate("seq", "ACGTN", "IIII#"))
    path = _put(reads(spark, d).where("seq != ''").select(record.alias("value")), "fastq", "gzip")
    return fasta.read_fastq(spark, path).select("header", _md5("seq"))


@query(f"WITH {READS_SQL} SELECT CAST(doc_id AS VARCHAR) AS header, CAST(length(seq) AS BIGINT) AS n, md5(seq) AS seq_md5, md5(translate(seq, 'ACGTN', '@I+>#')) AS qual_md5 FROM reads WHERE seq <> ''")
def sequence_source(spark, d):
    """S1 as a data source: records over many lines, files in many splits."""
    wrapped = lambda c: F.regexp_replace(c, "(.{60})(?!$)", "$1\n")
    record = F.concat(F.lit("@"), F.col("doc_id").cast("string"), F.lit("\n"), wrapped("seq"), F.lit("\n+\n"), wrapped(F.translate("seq", "ACGTN", "@I+>#")))
    path = _put(reads(spark, d).where("seq != ''").select(record.alias("value")), "fastq")
    spark.dataSource.register(sequences.SequenceSource)
    rows = spark.read.format("sequences").schema("header string, seq string, qual string, n long").option("split_bytes", 1 << 20).load(path)
    return rows.select("header", "n", _md5("seq"), _md5("qual"))


@query("""WITH f AS (SELECT '/data/' || source || '_' || lang || CASE WHEN doc_id % 2 = 0 THEN '_R1_001' ELSE '_R2_001' END || CASE WHEN doc_id % 3 = 0 THEN '.fastq.gz' WHEN doc_id % 3 = 1 THEN '.fa' ELSE '.txt' END AS file, source || '_' || lang AS sample FROM documents)
SELECT sample, count(*) AS files FROM f WHERE file NOT LIKE '%.txt' GROUP BY sample""")
def sample_discovery(spark, d):
    """Files of known kinds, by sample."""
    k = F.col("doc_id")
    file = F.concat(F.lit("/data/"), "source", F.lit("_"), "lang", F.when(k % 2 == 0, "_R1_001").otherwise("_R2_001"), F.when(k % 3 == 0, ".fastq.gz").when(k % 3 == 1, ".fa").otherwise(".txt"))
    return fasta.samples(load(spark, d, "documents").select(file.alias("file"))).groupBy("sample").agg(F.count("*").alias("files"))


@query("SELECT lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL GROUP BY lang")
def files_with_data(spark, d):
    """The sizes of written files, by folder."""
    path = new_path(spark, "sized")
    load(spark, d, "documents").where("text is not null and lang is not null").select("lang", F.col("text").alias("value")).write.partitionBy("lang").text(path)
    found = catalog.files_with_data(spark, f"{path}/*/part-*")
    return found.groupBy(F.regexp_extract("path", "lang=([^/]*)", 1).alias("lang")).agg(F.sum("length").alias("bytes"))


@query(f"WITH {HITS_SQL} SELECT header, CAST(target AS VARCHAR) AS target, CAST(frame AS INTEGER) AS frame, CAST(CAST(score AS FLOAT) AS DOUBLE) AS score, qstart, qend FROM hits")
def hit_table(spark, d):
    """Ten columns, told by the first line."""
    cols = F.concat_ws("\t", *[c.cast("string") for c in (F.col("header"), F.col("target"), F.col("frame"), F.lit(1e-9), F.col("score"), F.col("qstart"), F.col("qend"), F.lit(1), F.lit(2), F.lit(0.5))])
    rows = tables.read_hits(spark, _put(hits(spark, d).select(cols.alias("value")), "hits"))
    return rows.where("coverage = 0.5").select("header", "target", F.col("frame").cast("int").alias("frame"), F.col("score").cast("double").alias("score"), "qstart", "qend")


@query("SELECT p_brand AS gene, p_partkey AS target FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#23')")
def catalog_tables(spark, d):
    """Of several stages' tables the first that is there, some genes' folders of it."""
    tables_ = catalog.Catalog(spark, new_path(spark, "catalog"))
    part = load(spark, d, "part").select(F.col("p_brand").alias("gene"), F.col("p_partkey").alias("target"))
    tables_.put("trimmed", part, by="gene", rows_per_file=500)
    tables_.put("raw", part.limit(0))
    found = next(n for n in catalog.REFERENCE_ORDER if tables_.has(n))
    return tables_.get(found, "gene", ["Brand#11", "Brand#12", "Brand#23"]).select("gene", "target") if tables_.first_of(catalog.REFERENCE_ORDER).columns else part


@query("SELECT c_custkey AS node, c_name AS seq FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def reads_of_nodes(spark, d):
    """Two batches in a bucketed store; the reads aren't shuffled to be joined."""
    reads_, k = load(spark, d, "customer").select(F.col("c_custkey").alias("node"), F.col("c_name").alias("seq")), F.col("node") % 2
    kept = store.ReadStore(spark, new_path(spark, "read-store"), buckets=8)
    kept.add(reads_.where(k == 0))
    kept.add(reads_.where(k == 1))
    return kept.reads_of(load(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("node"))).select("node", "seq")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS name, l_extendedprice AS score, CAST(l_linenumber AS INTEGER) AS start, CAST(l_linenumber + 20 AS INTEGER) AS \"end\" FROM lineitem")
def domain_table(spark, d):
    """Columns 0, 13, 17 and 18 between any blanks, comments skipped."""
    gap, n = F.lit("   "), F.col("l_linenumber")
    line = F.concat_ws(" ", F.col("l_orderkey").cast("string"), *[F.lit(f"c{k}") for k in range(1, 13)], F.concat(F.col("l_extendedprice").cast("string"), gap), F.lit("c14"), F.lit("c15"), F.lit("c16"), n.cast("string"), F.concat((n + 20).cast("string"), gap), F.lit("rest"))
    lines = load(spark, d, "lineitem").select(F.explode(F.array(line, F.lit("# a comment"), F.lit("   "))).alias("value"))
    return tables.read_domains(spark, _put(lines, "domains"))


_GFF_SQL = "g AS (SELECT 'chr' || o_custkey AS parent, o_orderkey % 100000 + 1 AS start, o_orderkey % 100000 + 90 AS \"end\", 'node_' || o_orderkey AS id, o_orderstatus AS status FROM orders)"


def _features(spark, d):
    k = F.col("o_orderkey")
    return load(spark, d, "orders").select(
        F.concat(F.lit("chr"), F.col("o_custkey").cast("string")).alias("parent"), F.lit("engine").alias("source"), F.lit("exon").alias("type"), (k % 100000 + 1).alias("start"), (k % 100000 + 90).alias("end"),
        F.lit(".").alias("score"), F.lit("+").alias("strand"), F.lit("0").alias("phase"), F.concat(F.lit("ID=node_"), k.cast("string"), F.lit(";Status="), "o_orderstatus").alias("attributes"),
    )


@query(f"WITH {_GFF_SQL} SELECT parent, start, \"end\", id, status FROM g")
def gff_round_trip(spark, d):
    """S9 and K5."""
    path, rows = new_path(spark, "gff"), _features(spark, d)
    tables.write_gff(rows, rows.groupBy("parent").agg(F.max("end").alias("length")), path)
    return tables.read_gff(spark, path).select("parent", "start", "end", F.col("attribute")["ID"].alias("id"), F.col("attribute")["Status"].alias("status"))


@query("""WITH n AS (SELECT o_custkey AS parent, o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS place, o_orderstatus AS strand FROM orders),
o AS (SELECT o_custkey AS parent, o_orderkey AS id, -1.0 AS place FROM orders WHERE o_orderkey % 2 = 0) SELECT n.parent, n.id, coalesce(n.place, o.place) AS place, n.strand FROM n LEFT JOIN o ON n.parent = o.parent AND n.id = o.id""")
def features_filled(spark, d):
    """Nulls taken from an earlier table of the same features."""
    rows = load(spark, d, "orders").select(F.col("o_custkey").alias("parent"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("place"), F.col("o_orderstatus").alias("strand"))
    old = rows.where("id % 2 = 0").select("parent", "id", F.lit(-1.0).alias("place"), F.lit("x").alias("strand"))
    return tables.filled_features(rows, old)


@query("""WITH o AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber AS pair, l_suppkey AS gene FROM lineitem), p AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber AS pair, l_partkey, l_suppkey FROM lineitem)
SELECT o.gene, n_name AS taxon, p_name AS header, p_brand AS aa, CASE WHEN l_partkey % 2 = 0 THEN p_type END AS nt
FROM o JOIN p ON o.pair = p.pair JOIN part ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def legacy_reference_set(spark, d):
    """Pairs, genes, texts and taxa of a legacy set; a text may lack its nucleotides."""
    line, part, supplier = (load(spark, d, n) for n in ("lineitem", "part", "supplier"))
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    taxid = supplier.select("s_suppkey", F.col("s_nationkey").alias("taxid"))
    pairs = line.select(key.alias("id"), F.concat_ws(":", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("aa_seq"), F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey")).alias("nt_seq")).distinct()
    orthologs = line.select(key.alias("sequence_pair"), F.col("l_suppkey").alias("ortholog_gene_id")).distinct()
    used = line.select("l_partkey", "l_suppkey").distinct().join(part, F.col("l_partkey") == F.col("p_partkey")).join(taxid, F.col("l_suppkey") == F.col("s_suppkey"))
    aa = used.select(F.concat_ws(":", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"), F.col("p_name").alias("header"), F.col("p_brand").alias("sequence"), "taxid")
    nt = part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("sequence"))
    taxa = load(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return tables.legacy_reference_set(pairs, orthologs, aa, nt, taxa)


@query("""WITH r AS (SELECT p_partkey, p_brand, p_type, p_name, p_partkey % 3 AS kind FROM part),
t AS (SELECT p_partkey, CASE kind WHEN 2 THEN 'file' ELSE p_brand END AS gene, CASE kind WHEN 2 THEN 'free' ELSE p_type END AS taxon,
      CASE kind WHEN 0 THEN 'T' || p_partkey % 50 WHEN 1 THEN 'U' || p_partkey % 50 ELSE 'free text ' || p_partkey % 50 END AS target, row_number() OVER (PARTITION BY kind, p_partkey % 50 ORDER BY p_partkey) - 1 AS again FROM r)
SELECT gene, taxon, target || CASE WHEN again > 0 THEN '_' || again ELSE '' END AS target, p_partkey AS key FROM t""")
def reference_headers(spark, d):
    """Three kinds of names, repeated targets numbered."""
    k, kind = F.col("p_partkey"), F.col("p_partkey") % 3
    n = (k % 50).cast("string")
    json = F.concat(F.lit("U"), n, F.lit(" {'pub_og_id': '"), "p_brand", F.lit("', 'organism_name': '"), "p_type", F.lit("'}"))
    header = F.when(kind == 0, F.concat_ws("|", "p_brand", "p_type", F.concat(F.lit("T"), n))).when(kind == 1, json).otherwise(F.concat(F.lit("free text "), n))
    rows = load(spark, d, "part").select(F.lit("/set/file.fa").alias("file"), k.alias("idx"), header.alias("header"), k.cast("string").alias("seq"))
    return tables.references(rows).select("gene", "taxon", "target", F.col("seq").cast("long").alias("key"))


@query("SELECT DISTINCT trim(p_brand) AS value, CASE WHEN trim(p_brand) = 'Brand#11' THEN 'eleven' END AS name FROM part")
def name_lists(spark, d):
    """A list with blanks, empty lines and repeats, and a table of names."""
    lines = load(spark, d, "part").select(F.explode(F.array(F.concat(F.lit("  "), "p_brand", F.lit(" ")), F.lit(""))).alias("value"))
    names = tables.read_names(spark, _put(spark.createDataFrame([("Brand#11,eleven",), ("other,x",)], "value string"), "names"))
    return tables.read_list(spark, _put(lines, "list")).join(names, F.col("value") == F.col("id"), "left").select("value", "name")


@query("SELECT CAST(doc_id AS VARCHAR) AS pub_gene_id, source AS organism_name, md5(text) AS genome_md5 FROM documents WHERE text IS NOT NULL AND text <> '' AND source IS NOT NULL AND doc_id % 3 = 0")
def isoform_table(spark, d):
    """Six columns with a header, those whose description names an isoform."""
    rows = load(spark, d, "documents").where("text is not null and text != '' and source is not null")
    description = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("protein Isoform X"), F.col("doc_id").cast("string"))).otherwise("protein")
    path = new_path(spark, "isoforms")
    rows.select(F.lit("g").alias("pub_og_id"), F.col("source").alias("organism_name"), F.col("doc_id").cast("string").alias("pub_gene_id"), description.alias("description"), F.lit("a").alias("assembly_accession"), _md5("text").alias("genome_sequence")).write.option("sep", "\t").option("header", True).csv(path)
    return catalog.read_isoforms(spark, path).select("pub_gene_id", "organism_name", F.col("genome_sequence").alias("genome_md5"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS accession, CASE WHEN s_suppkey % 2 = 0 THEN 'own' ELSE n_name END AS family, CAST(n_regionkey AS VARCHAR) AS n_region FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def taxonomy_fill(spark, d):
    """A CSV of accessions, its empty columns filled from known taxonomy."""
    rows = load(spark, d, "supplier").select(F.col("s_suppkey").alias("Accession"), F.when(F.col("s_suppkey") % 2 == 0, "own").otherwise(" ").alias("Family"))
    path = new_path(spark, "accessions")
    catalog.write_counts(rows, path)
    nation = load(spark, d, "nation")
    known = load(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").cast("string").alias("accession"), F.col("n_name").alias("family"), F.col("n_regionkey").cast("string").alias("n_region"))
    return catalog.filled_taxonomy(catalog.read_accessions(spark, path), known, "accession").select("accession", "family", "n_region")


@query("""WITH c AS (SELECT turn AS gene, conv_id AS taxon, max(regexp_replace(text, '[^a-z]', '', 'g')) AS seq FROM conversations WHERE text IS NOT NULL GROUP BY turn, conv_id), l AS (SELECT gene, max(length(seq)) AS n FROM c GROUP BY gene)
SELECT 'charset ' || gene || ' = ' || CAST(sum(n) OVER w - n + 1 AS BIGINT) || '-' || CAST(sum(n) OVER w AS BIGINT) || ';' AS value FROM l WINDOW w AS (ORDER BY gene ROWS UNBOUNDED PRECEDING)""")
def charset_file(spark, d):
    """K7: the places of genes in the concatenation, as written."""
    rows = load(spark, d, "conversations").where("text is not null").select(F.col("turn").alias("gene"), F.col("conv_id").alias("taxon"), F.regexp_replace("text", "[^a-z]", "").alias("seq"))
    path = new_path(spark, "concatenation")
    catalog.write_concatenation(rows.withColumn("gene", F.col("gene")), path)
    return spark.read.text(f"{path}/nexus")


@query("""WITH r AS (SELECT event_type, CASE WHEN value IS NULL THEN 'no value' WHEN value < 20 THEN 'low' WHEN user_id % 7 = 0 THEN 'listed' ELSE 'kept' END AS reason FROM events)
SELECT event_type AS taxon, CAST(count(*) AS VARCHAR) AS reads, reason FROM r GROUP BY event_type, reason""")
def count_tables(spark, d):
    """K6 and K9: counts by the reason of a filter, written and read as CSV."""
    path = new_path(spark, "counts")
    rows = catalog.with_reason(load(spark, d, "events"), {"no value": F.col("value").isNull(), "low": F.col("value") < 20, "listed": F.col("user_id") % 7 == 0})
    catalog.write_counts(rows.groupBy(F.col("event_type").alias("taxon"), "reason").agg(F.count("*").alias("reads")), path)
    return spark.read.option("header", True).csv(path).select("taxon", "reads", "reason")


@query("""SELECT p_partkey || ' {"organism_name":"' || p_type || '","pub_og_id":"' || p_brand || '"}' AS header, md5(p_name) AS seq_md5, p_brand AS gene, p_type AS taxon FROM part""")
def reference_fasta(spark, d):
    """Reference rows written by gene with their names rebuilt, and read again."""
    path = new_path(spark, "references")
    fasta.write_references(load(spark, d, "part").select(F.col("p_brand").alias("gene"), F.col("p_type").alias("taxon"), F.col("p_partkey").cast("string").alias("target"), F.translate("p_name", " ", "_").alias("seq")), path)
    rows = fasta.read_fasta(spark, f"{path}/*").withColumn("seq", F.translate("seq", "_", " "))
    return rows.select("header", _md5("seq"), headers.json_field(F.col("header"), "pub_og_id").alias("gene"), headers.json_field(F.col("header"), "organism_name").alias("taxon"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN s_name || '|.' ELSE s_name || '|NODE_1' END AS header, CASE WHEN s_suppkey % 4 = 0 THEN 'reference' ELSE 'candidate' END AS side FROM supplier")
def reference_split(spark, d):
    """S18."""
    header = F.concat("s_name", F.when(F.col("s_suppkey") % 4 == 0, "|.").otherwise("|NODE_1"))
    refs, rows = pairs.references_and_candidates(load(spark, d, "supplier").select("s_suppkey", header.alias("header")))
    return refs.withColumn("side", F.lit("reference")).unionByName(rows.withColumn("side", F.lit("candidate")))


@query("SELECT event_type, date_trunc('hour', ts) AS start, count(*) AS n FROM events GROUP BY event_type, date_trunc('hour', ts)")
def windowed_stream(spark, d):
    """M1: the events read as a stream, counted by hour."""
    events = load(spark, d, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    path = new_path(spark, "windows")
    windows.run_into_folder(windows.windowed_counts(stream, "ts", "event_type", "1 hour"), path, new_path(spark, "stream"))
    return spark.read.parquet(path).select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n")


#: Rows of a file of a stream: what one task writes or reads.
FILE_ROWS = 20_000


def _in_files(df, tag: str, n: int = 3):
    """The rows as a stream of n batches, each of as many files as its rows need."""
    path = new_path(df.sparkSession, tag)
    files = max(1, -(-df.count() // (n * FILE_ROWS)))
    df.repartition(n * files).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


@query("""WITH n AS (SELECT user_id, event_id, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) > 35 THEN 1 ELSE 0 END AS new FROM events),
c AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cluster FROM n)
SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM c GROUP BY user_id, cluster""")
def clustered_stream(spark, d):
    """W8 on a stream: the clusters of event ids of each user, kept as state over batches of files."""
    path = new_path(spark, "clusters")
    stream = stateful.id_clusters(_in_files(load(spark, d, "events").select("user_id", "event_id"), "events"), "user_id", "event_id", 35)
    stateful.run_updates(stream, path, new_path(spark, "stream"))
    return stateful.latest(spark.read.parquet(path), "user_id").select("user_id", "first", "last", "n")


@query(f"""WITH {READS_SQL}, k AS (SELECT doc_id, length(seq) AS n, least(seq, translate(reverse(seq), 'ACGTN', 'TGCAN')) AS key FROM reads)
SELECT min(doc_id) AS doc_id, max(n) AS n, count(*) - 1 AS dupes FROM k GROUP BY key""")
def deduped_stream(spark, d):
    """A1 on a stream: strand-insensitive copies counted over batches of files."""
    path = new_path(spark, "deduped")
    windows.run_into_folder(stateful.deduped(_in_files(reads(spark, d).select("doc_id", "seq"), "reads"), "doc_id"), path, new_path(spark, "stream"))
    return spark.read.parquet(path).select("doc_id", F.length("seq").alias("n"), "dupes")
