"""Queries of the grouped algorithms through their DataFrame forms; tests hold the algorithms against cases and brute force."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandwork.functions import dna
from strandwork.functions.blosum import LETTERS
from strandwork.operators import outliers, profiling, searching, signatures
from strandwork.operators.grouped import aligning, assembly, frames
from strandwork.plans.registry import plain, query
from strandwork.plans.row_queries import turns
from strandwork.plans.tables import PLACE, acgt, line_hits, load, reads


def _references(spark, d):
    """Every third conversation stands for a reference of its turn."""
    return turns(spark, d).where("cast(name as long) % 3 = 0")


def _candidates(spark, d):
    return turns(spark, d).where("cast(name as long) % 3 != 0")


def _dna(spark, d):
    """gene, name, nt: the text of a turn as bases."""
    rows = load(spark, d, "conversations").where("text is not null").groupBy(F.col("turn").cast("string").alias("gene"), F.col("conv_id").cast("string").alias("name"))
    return rows.agg(acgt(F.max("text")).alias("nt"))


@plain
def end_trimming(spark, d):
    """Proteins and nucleotides trimmed alike."""
    rows = _candidates(spark, d).withColumn("nt", F.regexp_replace("seq", "(.)", "$1$1$1"))
    return frames.end_trimmed(rows, _references(spark, d), least=5)


@plain
def cluster_filter(spark, d):
    """G12."""
    n = F.col("name").cast("long")
    rows = _candidates(spark, d).withColumns({"ids": F.array(n), "strand": F.when(n % 2 == 0, "+").otherwise("-")})
    return frames.cluster_filtered(rows, _references(spark, d))


@plain
def excision(spark, d):
    """G14."""
    return frames.excised(_candidates(spark, d), _references(spark, d), 0.6, least=5)


@plain
def assembly_contigs(spark, d):
    """G15 on overlapping pieces of the shortest long read of each source."""
    one = reads(spark, d).where("length(seq) >= 200").groupBy("source").agg(F.min_by("seq", F.struct(F.length("seq"), "doc_id")).alias("whole"))
    n = F.length("whole")
    cut = one.select(F.col("source").alias("gene"), "whole", F.explode(F.sequence(F.lit(0), n - 60, F.lit(20))).alias("k"))
    seq = F.concat(F.repeat(F.lit("-"), F.col("k")), F.substring(F.col("whole"), F.col("k") + 1, F.lit(60)), F.repeat(F.lit("-"), n - 60 - F.col("k")))
    rows = cut.select("gene", F.concat(F.lit("r"), F.lpad(F.col("k").cast("string"), 6, F.lit("0"))).alias("name"), seq.alias("seq"))
    references = one.select(F.col("source").alias("gene"), F.lit("ref").alias("name"), F.col("whole").alias("seq"))
    return frames.contigs(rows, references).select("gene", "name", "seq", F.array_join("names", ",").alias("names"), "score")


@plain
def recovery(spark, d):
    """G17."""
    return frames.recovered(turns(spark, d).withColumn("kicked", F.col("name").cast("long") % 4 == 1), 0.2, 1, 8)


@plain
def profile_filter(spark, d):
    """G18."""
    rows = _candidates(spark, d).withColumns({"read": (F.col("name").cast("long") / 2).cast("long"), "score": F.length(F.translate("seq", "-", "")).cast("double")})
    return frames.profile_filtered(rows, _references(spark, d), 0.1)


@plain
def splice_search(spark, d):
    """Thirds of each text as exon, stretch between and exon."""
    third = F.floor(F.length("nt") / 9).cast("int") * 3
    rows = _dna(spark, d).withColumn("t", third).where("t >= 30")
    rows = rows.select("gene", "name", F.substring(F.col("nt"), F.lit(1), F.col("t")).alias("left"), F.substring(F.col("nt"), F.col("t") + 1, F.col("t")).alias("between"), F.substring(F.col("nt"), 2 * F.col("t") + 1, F.col("t")).alias("right"))
    return frames.splice_sites(rows)


@plain
def gap_filling(spark, d):
    """Each text is scanned for the ten columns from 5 of its turn's references, translated from other texts."""
    rows = _dna(spark, d).withColumns({"genomic": F.col("nt"), "first": F.lit(5), "last": F.lit(15)})
    references = _dna(spark, d).where("cast(name as long) % 9 = 0").select("gene", "name", dna.translated(F.col("nt")).alias("seq"))
    return frames.gaps_filled(rows.select("gene", "name", "genomic", "first", "last"), references, 0.2)


@plain
def fragment_splice(spark, d):
    """Conversations of one tens digit are fragments of one component."""
    component = (F.col("name").cast("long") / 10).cast("long").cast("string")
    return frames.fragments_spliced(_candidates(spark, d).withColumn("component", component), _references(spark, d))


@plain
def chunk_merge(spark, d):
    """Hits of overlapping chunks of the documents."""
    rows = reads(spark, d).where("length(seq) >= 1000").select(F.col("source"), "doc_id", "seq", F.explode(F.sequence(F.lit(0), F.length("seq") - 750, F.lit(501))).alias("start"))
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("start"))
    hit = rows.select(F.col("doc_id").cast("string").alias("gene"), order.cast("long").alias("node"), F.col("start").cast("long").alias("start"), (F.col("start") + 750).cast("long").alias("end"), F.substring(F.col("seq"), F.col("start") + 1, F.lit(750)).alias("seq"))
    named = hit.withColumns({"name": F.concat(F.lit("NODE_"), F.col("node").cast("string")), "strand": F.lit("+")})
    return frames.chunks_merged(named).select("gene", "name", F.array_join("ids", ",").alias("ids"), "start", "end", F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@plain
def intron_removal(spark, d):
    """Each text against the first one of its turn."""
    rows = _dna(spark, d)
    first = rows.where("length(nt) >= 60").groupBy("gene").agg(F.min_by("nt", "name").alias("reference"))
    return aligning.intron_free(rows.select("gene", F.col("name").cast("long").alias("node"), F.col("nt").alias("seq")).join(first, "gene")).select("gene", "node", "seq", F.size("introns").alias("n_introns"))


@plain
def isoform_choice(spark, d):
    """G25."""
    return frames.isoforms(_references(spark, d), _candidates(spark, d))


@plain
def severe_rows(spark, d):
    """A29."""
    return frames.severe(turns(spark, d), 0.3, 0.1)


@plain
def deviation(spark, d):
    """A28, whole rows and halves."""
    rows = turns(spark, d)
    return frames.deviating(rows, rounds=2).unionByName(frames.deviating(rows, rounds=2, halves=True))


@plain
def shallow_regions(spark, d):
    """W11 by depth."""
    return frames.shallow_regions(turns(spark, d), 0.3, 3)


@plain
def hit_dedupe(spark, d):
    """A3: the parts of a document between unknown bases are the hits of one read."""
    rows = reads(spark, d).select(F.col("source").alias("gene"), "doc_id", F.posexplode(F.split("seq", "ACGT")).alias("k", "nt")).where("length(nt) >= 12")
    rows = rows.select(F.coalesce("gene", F.lit("")).alias("gene"), F.col("doc_id").alias("node"), "k", "nt", dna.translated_long(F.col("nt")).alias("aa"))
    return assembly.deduped_hits(rows, "gene", "node", ["k"]).select("gene", "node", "k", "suffix")


@plain
def reference_alignment(spark, d):
    """References of a turn aligned by themselves, and candidates with them."""
    plain_text = lambda rows: rows.withColumn("seq", F.translate("seq", "-", "")).where("seq != ''")
    references, rows = plain_text(_references(spark, d)), plain_text(_candidates(spark, d))
    return frames.aligned(references).withColumn("kind", F.lit("alone")).unionByName(frames.aligned(rows, references).withColumn("kind", F.lit("with rows")))


@plain
def consensus_distance(spark, d):
    """Rows against the consensus of their turn."""
    from strandwork.operators.columns import consensus

    rows = turns(spark, d)
    return outliers.consensus_distance_kick(rows, consensus(rows, "gene", 0.3), "gene", 0.8).select("gene", "name")


@plain
def seeded_search(spark, d):
    """E and G4's search: conversations against the benchmark by shared words of five letters."""
    aa = lambda c: F.translate(F.regexp_replace(c, "[^A-Za-z]", ""), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    rows = load(spark, d, "conversations").where("text is not null").select(F.col("conv_id").alias("node"), F.col("turn").cast("int").alias("frame"), aa(F.col("text")).alias("aa"))
    targets = load(spark, d, "benchmark").where("text is not null").select(F.col("item_id").cast("string").alias("target"), aa(F.col("text")).alias("seq"))
    return aligning.seeded_hits(rows, targets, 5, 3)


#: The letters that are none of the twenty stand for others, so that seeds run through.
_TWENTY = ("BJOUXZ", "DLKCAE")


def _search_texts(spark, d):
    aa = lambda c: F.translate(F.upper(F.regexp_replace(c, "[^A-Za-z]", "")), *_TWENTY)
    rows = load(spark, d, "conversations").where("text is not null").groupBy(F.col("conv_id").alias("node"), F.col("turn").cast("int").alias("frame")).agg(F.max("text").alias("text"))
    targets = load(spark, d, "benchmark").where("text is not null").select(F.col("item_id").cast("string").alias("target"), aa(F.col("text")).alias("seq"))
    return rows.select("node", "frame", aa(F.col("text")).alias("aa")), targets


_SEEDING = searching.Seeding(k=8, least_letters=4)


def _seeds_sql(rows: str, names: str, text: str) -> str:
    return f"""SELECT {names}, "at", list_reduce(list_transform(range(1, 9), lambda i: CAST(instr('{LETTERS}', seed[i]) - 1 AS BIGINT)), lambda a, b: a * 32 + b) AS seed
  FROM (SELECT {names}, "at", substr(t, "at" + 1, 8) AS seed FROM (SELECT *, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{_TWENTY[0]}', '{_TWENTY[1]}') AS t, unnest(range(0, greatest(0, length({text}) - 7))) AS "at" FROM {rows}))
  WHERE len(list_distinct(string_split(seed, ''))) >= 4"""


@query(f"""WITH c AS (SELECT conv_id AS node, CAST(turn AS INTEGER) AS frame, max(text) AS text, regexp_replace(max(text), '[^A-Za-z]', '', 'g') AS bare FROM conversations WHERE text IS NOT NULL GROUP BY ALL),
b AS (SELECT CAST(item_id AS VARCHAR) AS target, text, regexp_replace(text, '[^A-Za-z]', '', 'g') AS bare FROM benchmark WHERE text IS NOT NULL),
x AS ({_seeds_sql("c", "node, frame", "bare")}), y AS ({_seeds_sql("b", "target", "bare")}),
l AS (SELECT node, frame, target, y."at" - x."at" AS diagonal, count(*) AS n, min(x."at") AS "at" FROM x JOIN y ON x.seed = y.seed GROUP BY ALL),
w AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER v > 16 THEN 1 ELSE 0 END AS new FROM l WINDOW v AS (PARTITION BY node, frame, target ORDER BY diagonal)),
r AS (SELECT *, sum(new) OVER (PARTITION BY node, frame, target ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS run FROM w)
SELECT node, frame, target, min(diagonal) AS low, max(diagonal) AS high, sum(n) AS n_seeds, arg_max(diagonal, {{'n': n, 'd': -diagonal}}) AS diagonal, arg_max("at", {{'n': n, 'd': -diagonal}}) AS "at"
FROM r GROUP BY node, frame, target, run HAVING sum(n) >= 2""")
def seed_diagonals(spark, d):
    """E: where conversations and the benchmark share seeds, by diagonal."""
    found = searching.candidates(searching.seed_pairs(*_search_texts(spark, d), _SEEDING), _SEEDING)
    return found.select("node", "frame", "target", *[F.col(c).cast("long").alias(c) for c in ("low", "high", "n_seeds", "diagonal", "at")])


@plain
def extended_search(spark, d):
    """E: conversations against the benchmark, seeds extended and scored."""
    found = searching.extended_hits(*_search_texts(spark, d), _SEEDING)
    return found.withColumns({"bits": F.round("bits", 6), "evalue": F.round(F.log10("evalue"), 6)}).withColumnRenamed("evalue", "log10_evalue")


@plain
def search_stage(spark, d):
    """The search stage over all line items: signed frames, hits without target, top taxa, filters and clusters."""
    from strandwork.plans import stages

    part = load(spark, d, "part")
    lines = line_hits(spark, d, placed=True).select("header", F.col("target").cast("string").alias("target"), "frame", "score", "qstart", "qend", *PLACE)
    # Dealt by target once: rows that are equal lie together then, and with their target.
    raw = lines.join(part.select(F.col("p_partkey").cast("string").alias("target")).hint("shuffle_hash"), "target", "left_semi")
    # Of hits that differ in their scores alone the first one in the table.
    raw = raw.groupBy("header", "target", "frame", "qstart").agg(F.min_by(F.struct("score", "qend"), F.struct(*PLACE)).alias("x"))
    raw = raw.select("header", "target", "frame", (F.col("x.score") * 1e-12).alias("evalue"), "x.score", "qstart", "x.qend")
    targets = part.where("p_size > 3").select(F.col("p_brand").alias("gene"), F.concat(F.lit("t"), (F.col("p_partkey") % 20).cast("string")).alias("taxon"), F.col("p_partkey").cast("string").alias("target"), F.col("p_size").alias("aa_len"))
    return stages.search(raw, targets)["hits"].select("gene", "header", "target", "frame", "qstart", "qend", "score", "cluster")


@plain
def report_stage(spark, d):
    """G7 over all documents: hits on each read, named rows of genes."""
    from strandwork.plans import stages

    read = reads(spark, d).where("length(seq) >= 90")
    n = F.col("doc_id")
    hit = read.select(F.coalesce("source", F.lit("none")).alias("gene"), n.alias("header"), F.concat(F.lit("t"), (n % 7).cast("string")).alias("target"), F.when(n % 2 == 0, -1).otherwise(1).alias("frame"), F.lit(10.0).alias("score"), (n % 30 + 1).cast("int").alias("qstart"), F.length("seq").alias("qend"), F.when(n % 2 == 0, "-").otherwise("+").alias("strand"))
    targets = hit.select("gene", "target", F.concat(F.lit("T"), "target").alias("taxon")).distinct()
    dupes = read.select(n.alias("node"), (n % 4).alias("dupes"))
    rows = stages.report_genes(hit, read.select(n.alias("node"), "seq"), dupes, targets, "s")
    return rows.select("gene", "name", F.length("nt").alias("n_nt"), F.length("aa").alias("n_aa"), "copies")


@plain
def reference_building(spark, d):
    """G24 over the benchmark's items."""
    from strandwork.plans import stages

    k = F.col("item_id")
    aa = F.translate(F.regexp_replace("text", "[^A-Za-z]", ""), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    rows = load(spark, d, "benchmark").where("text is not null").select((k % 8).cast("string").alias("gene"), F.lpad(k.cast("string"), 6, F.lit("0")).alias("name"), F.concat(F.lit("T"), (k % 5).cast("string")).alias("taxon"), (k % 3).cast("string").alias("component"), aa.alias("seq"))
    return stages.build_references(rows, stages.References(edge_share=0.2))


@plain
def finish_stage(spark, d):
    """G26 over the turns of conversations: the counts of genes and taxa, with stops and kicked rows."""
    from strandwork.plans import stages

    rows = turns(spark, d).select("gene", (F.col("name").cast("long") % 40).cast("string").alias("taxon"), F.replace("seq", F.lit("K"), F.lit("*")).alias("seq"))
    return stages.finish(rows, params=stages.Finish(coverage=0.3, least_letters=20))["matrix"]


@plain
def profile_search(spark, d):
    """The texts near every third one of a turn against the profile of the translations of every fifth."""
    from strandwork.plans import stages

    rows = _dna(spark, d).withColumn("node", F.col("name").cast("long") * 16 + F.col("gene").cast("long"))
    references = rows.where("node % 5 = 0").select("gene", "name", dna.translated_long(F.col("nt")).alias("seq"))
    return stages.profile_search(rows.where("node % 3 = 0").select("gene", "node"), rows.select("node", F.col("nt").alias("seq")), references, margin=2)


@plain
def profile_matches(spark, d):
    """G4 with gaps: every text's translation against the profile of every fifth one of its turn, scored and calibrated."""
    rows = _dna(spark, d).select("gene", "name", dna.translated_long(F.col("nt")).alias("seq"))
    found = profiling.profile_matches(rows, profiling.profiles(rows.where("cast(name as long) % 5 = 0")), 1e-3)
    return found.withColumn("evalue", F.round(F.log10("evalue"), 4)).withColumnRenamed("evalue", "log10_evalue")


@plain
def signature_clusters(spark, d):
    """The documents of each language in clusters of similar words of five letters."""
    rows = load(spark, d, "documents").select(F.col("lang").alias("gene"), F.col("doc_id").cast("string").alias("name"), F.col("text").alias("seq"))
    return signatures.signature_clusters(rows, most=200)


@plain
def outlier_stage(spark, d):
    """G11 with rescue, on the turns of conversations."""
    from strandwork.plans import stages

    rows = _candidates(spark, d).withColumn("node", F.col("name").cast("long"))
    return stages.outliers(rows, _references(spark, d), is_genome=True, least_match=0.3)


@plain
def split_merge(spark, d):
    """Candidates of each turn, in samples of five, merged at the splits that their references prefer."""
    from strandwork.operators.grouped.merging import merged

    n = F.col("name").cast("long")
    rows = _candidates(spark, d).withColumns({"taxa": (n % 5).cast("string"), "ref": F.concat(F.lit("R"), (n % 3).cast("string")), "weight": F.lit(1), "aa": F.col("seq"), "nt": F.regexp_replace("seq", "(.)", "$1$1$1")})
    return merged(rows.select("gene", "taxa", "name", "ref", "weight", "aa", "nt"), _references(spark, d).select(F.col("gene").alias("gene"), F.col("seq").alias("seq")), "split").select("gene", "taxa", "reference", "total", F.md5(F.col("names").cast("binary")).alias("names_md5"), "aa", F.md5(F.col("nt").cast("binary")).alias("nt_md5"))


@plain
def top_reference_alignment(spark, d):
    """G3 over the benchmark's items: the first three taxa of each gene."""
    from strandwork.plans import stages

    k = F.col("item_id")
    aa = F.translate(F.regexp_replace("text", "[^A-Za-z]", ""), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    rows = load(spark, d, "benchmark").where("text is not null").select((k % 8).cast("string").alias("gene"), F.lpad(k.cast("string"), 6, F.lit("0")).alias("name"), F.concat(F.lit("T"), (k % 5).cast("string")).alias("taxon"), aa.alias("seq"))
    ranked = spark.createDataFrame([(f"T{k}", k + 1) for k in range(5)], "taxon string, rank int")
    return stages.top_references(rows, ranked, 3)


@plain
def consensus_distance_pairs(spark, d):
    """G16 on proteins and nucleotides of the turns of conversations."""
    from strandwork.operators.columns import consensus

    aa = turns(spark, d)
    nt = aa.withColumn("seq", F.regexp_replace("seq", "(.)", "$1$1$1"))
    a, n = outliers.consensus_distance_pair(aa, nt, consensus(aa, "gene", 0.3), consensus(nt, "gene", 0.3), "gene", 0.8, 0.7)
    return a.select(F.lit("aa").alias("side"), "gene", "name").unionByName(n.select(F.lit("nt").alias("side"), "gene", "name"))
