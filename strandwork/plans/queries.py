"""Queries of the operators on the driver's tables, each beside the same result in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandwork.functions import dna, headers, intervals, msa
from strandwork.operators import columns, combining, hits as H, islands, outliers, pairs, reads as R
from strandwork.plans.registry import QUERIES, SQL, plain, query
from strandwork.plans.tables import ALIGNMENT_SQL, HITS_SQL, LETTERS_SQL, PLACE, READS_SQL, WITH_N_SQL, alignment, hits, load, reads, with_n

TOP_SQL = HITS_SQL + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, header, line, target) AS rn, count(*) OVER () AS n FROM hits),
counted AS (SELECT taxon, count(*) AS reads FROM (SELECT DISTINCT header, taxon FROM ranked WHERE rn <= CAST(floor(n * 0.25) AS BIGINT)) GROUP BY taxon),
top AS (SELECT taxon, reads FROM counted ORDER BY reads DESC, taxon LIMIT 10)"""


def _top(spark, d):
    return H.top_taxa(H.count_taxa(hits(spark, d), ["header", "line", "target"]), 10)


@query(f"WITH {TOP_SQL} SELECT taxon, reads FROM top")
def top_reference(spark, d):
    return _top(spark, d)


@query("SELECT l_orderkey AS header, l_linenumber AS line, p_brand AS gene, p_size AS aa_len FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 5")
def left_join_target_map(spark, d):
    part = load(spark, d, "part").where("p_size > 5").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("gene"), F.col("p_size").alias("aa_len"))
    return load(spark, d, "lineitem").join(part, "l_partkey", "left").select(F.col("l_orderkey").alias("header"), F.col("l_linenumber").alias("line"), "gene", "aa_len")


@query(f"WITH {TOP_SQL} SELECT gene, count(*) AS n, round(max(score), 2) AS best FROM hits WHERE taxon IN (SELECT taxon FROM top) GROUP BY gene")
def semi_join_top(spark, d):
    return hits(spark, d).join(_top(spark, d), "taxon", "left_semi").groupBy("gene").agg(F.count("*").alias("n"), F.round(F.max("score"), 2).alias("best"))


@query(f"""WITH {HITS_SQL}, p AS (SELECT *, sum(score) OVER (PARTITION BY header, target) AS pooled FROM hits),
b AS (SELECT *, max(pooled) OVER (PARTITION BY header) AS best FROM p)
SELECT header, line, target, round(pooled, 2) AS pooled FROM b WHERE pooled >= 0.9 * best""")
def pooled_score_90(spark, d):
    return H.pooled_filter(hits(spark, d)).select("header", "line", "target", F.round("pooled", 2).alias("pooled"))


@query(f"WITH {HITS_SQL} SELECT header, frame, gene, line FROM (SELECT *, row_number() OVER (PARTITION BY header, frame, gene ORDER BY score DESC, line) AS rn FROM hits) WHERE rn = 1")
def best_per_group(spark, d):
    return H.best_per_group(hits(spark, d), [F.col("line")]).select("header", "frame", "gene", "line")


@query(f"""WITH {HITS_SQL}, s AS (SELECT *, least(qstart, qend) AS s, greatest(qstart, qend) AS e FROM hits),
m AS (SELECT *, first_value(gene) OVER w AS mg, first_value(score) OVER w AS ms, first_value(s) OVER w AS m1, first_value(e) OVER w AS m2 FROM s
      WINDOW w AS (PARTITION BY header, frame ORDER BY score DESC, line))
SELECT header, line, gene FROM m
WHERE NOT (gene <> mg AND greatest(0, least(m2, e) - greatest(m1, s)) / CAST(m2 - m1 AS DOUBLE) >= 0.3 AND ms / score >= 1.1)""")
def multi_filter(spark, d):
    return H.multi_gene_filter(hits(spark, d), [F.col("line")]).select("header", "line", "gene")


_FOLD = """r AS (
  SELECT header, 0 AS i, rows, CAST([] AS INTEGER[]) AS kept FROM g
  UNION ALL
  SELECT header, i + 1, rows, CASE WHEN len(list_filter(kept, lambda k: {meets})) > 0 THEN kept ELSE list_append(kept, CAST(i + 1 AS INTEGER)) END
  FROM r WHERE i < len(rows))
SELECT header, rows[k].line AS line FROM (SELECT header, rows, unnest(kept) AS k FROM r WHERE i = len(rows))"""
_COMMON = "(least(rows[k].e, rows[i + 1].e) - greatest(rows[k].s, rows[i + 1].s))"


@query(f"WITH RECURSIVE {HITS_SQL}, g AS (SELECT header, list({{'line': line, 's': least(qstart, qend), 'e': greatest(qstart, qend)}} ORDER BY line, target) AS rows FROM hits GROUP BY header), " + _FOLD.format(meets=f"{_COMMON} > 0 AND {_COMMON} / CAST(greatest(rows[k].e, rows[i + 1].e) - least(rows[k].s, rows[i + 1].s) AS DOUBLE) >= 0.3"))
def internal_filter_greedy(spark, d):
    s, e = intervals.swapped(F.col("frame"), F.col("qstart"), F.col("qend"))
    rows = hits(spark, d, placed=True).select("header", "line", "target", s.alias("qstart"), e.alias("qend"), *PLACE)
    # One part may stand twice in a line's number: the order of the table decides then.
    return H.internal_filter(rows, ["header"], ["line", "target"], ties=PLACE).select("header", "line")


@query(f"WITH RECURSIVE {HITS_SQL}, g AS (SELECT header, list({{'line': line, 'sc': score, 's': least(qstart, qend), 'e': greatest(qstart, qend)}} ORDER BY score DESC, line, target) AS rows FROM hits GROUP BY header), " + _FOLD.format(meets=f"{_COMMON} > 0 AND {_COMMON} >= 0.6 * (rows[i + 1].e - rows[i + 1].s) AND rows[k].sc / rows[i + 1].sc >= 1.1"))
def dominance_overlap(spark, d):
    s, e = intervals.swapped(F.col("frame"), F.col("qstart"), F.col("qend"))
    rows = hits(spark, d).select("header", "line", "target", "score", s.alias("qstart"), e.alias("qend"))
    return H.dominance_filter(rows, ["header"], ["line", "target"]).select("header", "line")


@query("""WITH t AS (SELECT p_brand AS gene, p_size AS taxon, p_partkey AS target FROM part), h AS (SELECT DISTINCT l_partkey AS target FROM lineitem WHERE l_quantity > 45),
c AS (SELECT t.*, h.target IS NOT NULL AS hit, count(*) OVER (PARTITION BY gene, taxon) AS n FROM t LEFT JOIN h ON t.target = h.target)
SELECT gene, taxon, target FROM c WHERE n = 1 OR hit""")
def valid_target_variants(spark, d):
    t = load(spark, d, "part").select(F.col("p_brand").alias("gene"), F.col("p_size").alias("taxon"), F.col("p_partkey").alias("target"))
    return H.valid_targets(load(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("target")), t)


@query(f"""WITH {HITS_SQL}, k AS (SELECT taxon, row_number() OVER (ORDER BY count(*) DESC, taxon) AS rank FROM hits GROUP BY taxon),
p AS (SELECT DISTINCT gene, taxon FROM hits WHERE score > 50000)
SELECT gene, taxon, rank FROM (SELECT p.gene, p.taxon, k.rank, row_number() OVER (PARTITION BY p.gene ORDER BY k.rank, p.taxon) AS rn FROM p JOIN k ON p.taxon = k.taxon) WHERE rn <= 3""")
def top_taxa_of_gene(spark, d):
    h = hits(spark, d)
    # Taxa in rank order: one row a taxon, numbered by the two-level form, so that no task has them all.
    counted = h.groupBy("taxon").count().withColumn("all", F.lit(1)).withColumn("place", -F.col("count"))
    ranked = R.numbered_in_ranges(counted, "all", "place", ["place", "taxon"], "rank", 16).select("taxon", F.col("rank").cast("int").alias("rank"))
    return H.top_taxa_by_gene(h.where("score > 50000"), ranked, 3).select("gene", "taxon", "rank")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS text_md5, count(*) - 1 AS dupes FROM documents WHERE text IS NOT NULL GROUP BY text")
def exact_dedupe_counts(spark, d):
    docs = load(spark, d, "documents").where("text is not null").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return R.exact_dedupe(docs, "text_md5", "doc_id")


@query(f"""WITH {READS_SQL}, k AS (SELECT doc_id, length(seq) AS n, least(seq, translate(reverse(seq), 'ACGTN', 'TGCAN')) AS key FROM reads)
SELECT min(doc_id) AS doc_id, max(n) AS n, count(*) - 1 AS dupes FROM k GROUP BY key""")
def strand_dedupe(spark, d):
    return R.strand_dedupe(reads(spark, d).select("doc_id", "seq"), "doc_id").select("doc_id", F.length("seq").alias("n"), "dupes")


@query(f"""WITH s AS (SELECT doc_id, string_split({WITH_N_SQL}, 'N') AS parts FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, i, parts[i] AS seq, CAST(coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x) + 1)), 0) AS INTEGER) AS "offset" FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM s))
SELECT doc_id, "offset", md5(seq) AS seq_md5 FROM u WHERE length(seq) >= 20""")
def n_split(spark, d):
    docs = load(spark, d, "documents").where("text is not null").select("doc_id", with_n(F.col("text")).alias("seq"))
    return R.split_at_n(docs, 20).select("doc_id", "offset", F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@query(f"""WITH {READS_SQL} SELECT doc_id, "start", "start" + 749 AS "end", length(c) - 1 AS last, md5(c) AS seq_md5
FROM (SELECT doc_id, k * 500 AS "start", substr(seq, k * 500 + 1, 750) AS c FROM (SELECT doc_id, seq, unnest(range(0, CAST(ceil(length(seq) / 500.0) AS BIGINT))) AS k FROM reads WHERE length(seq) > 0)) WHERE length(c) >= 90""")
def chunk_750_500(spark, d):
    return R.chunked(reads(spark, d)).select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("last").cast("long").alias("last"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@query(f"WITH {READS_SQL} SELECT source, count(*) AS n, max(length(seq)) AS longest, max(length(seq)) >= 1250 AS is_assembly, max(length(seq)) > 50000 AS is_genome FROM reads WHERE length(seq) >= 90 GROUP BY source")
def length_filter_classify(spark, d):
    rows = R.long_enough(reads(spark, d))
    return rows.groupBy("source").agg(F.count("*").alias("n")).join(R.dataset_flags(rows, "source"), "source").select("source", "n", F.col("longest").cast("long").alias("longest"), "is_assembly", "is_genome")


@query(f"""WITH {READS_SQL}, c AS (SELECT doc_id, length(seq) AS t, unnest([length(seq) - length(replace(seq, 'A', '')), length(seq) - length(replace(seq, 'C', '')), length(seq) - length(replace(seq, 'G', '')), length(seq) - length(replace(seq, 'T', ''))]) AS n FROM reads WHERE length(seq) > 0),
e AS (SELECT doc_id, sum(CASE WHEN n > 0 THEN -(n / CAST(t AS DOUBLE)) * log2(n / CAST(t AS DOUBLE)) ELSE 0 END) / 2 AS entropy FROM c GROUP BY doc_id)
SELECT doc_id, round(entropy, 6) AS entropy FROM e WHERE entropy >= 0.7""")
def entropy_filter(spark, d):
    return reads(spark, d).withColumn("entropy", dna.entropy(F.col("seq"))).where("entropy >= 0.7").select("doc_id", F.round("entropy", 6).alias("entropy"))


@query("""WITH n AS (SELECT user_id, event_id, CASE WHEN event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) > 35 THEN 1 ELSE 0 END AS new FROM events),
c AS (SELECT *, 1 + sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cluster FROM n)
SELECT user_id, CAST(cluster AS BIGINT) AS cluster, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM c GROUP BY user_id, cluster""")
def id_clusters(spark, d):
    rows = islands.id_clusters(load(spark, d, "events").select("user_id", "event_id"), ["user_id"], "event_id", 35)
    return rows.groupBy("user_id", "cluster").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"), F.count("*").alias("n"))


@query("""WITH o AS (SELECT o_custkey AS gene, o_orderkey AS node, CAST(o_orderkey % 1000 AS BIGINT) AS s, CAST(o_orderkey % 1000 + 40 + o_orderkey % 7 AS BIGINT) AS e FROM orders),
n AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY gene ORDER BY s, e, node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM o),
g AS (SELECT *, 1 + sum(new) OVER (PARTITION BY gene ORDER BY s, e, node ROWS UNBOUNDED PRECEDING) AS grp FROM n)
SELECT gene, CAST(grp AS BIGINT) AS "group", min(s) AS s, max(e) AS e, count(*) AS n FROM g GROUP BY gene, grp""")
def interval_union(spark, d):
    k = F.col("o_orderkey")
    rows = load(spark, d, "orders").select(F.col("o_custkey").alias("gene"), k.alias("node"), (k % 1000).alias("s"), (k % 1000 + 40 + k % 7).alias("e"))
    return islands.interval_union(rows, ["gene"], "s", "e", ["node"]).groupBy("gene", "group").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id, event_id, value > 50 AS passed FROM events)
SELECT a.user_id, a.event_id, a.passed FROM e a WHERE a.passed OR EXISTS (SELECT 1 FROM e b WHERE b.user_id = a.user_id AND b.passed AND abs(a.event_id - b.event_id) <= 100)""")
def band_rescue(spark, d):
    rows = load(spark, d, "events").select("user_id", "event_id", (F.col("value") > 50).alias("passed"))
    return H.rescued(rows, ["user_id"], "event_id", "passed", 100)


@query("""WITH r AS (SELECT o_custkey AS cluster, unnest(range(o_orderkey - 2, o_orderkey + 3)) AS node FROM orders WHERE o_orderstatus = 'F')
SELECT r.cluster, r.node, o.o_orderstatus AS status FROM r JOIN orders o ON r.node = o.o_orderkey WHERE o.o_orderstatus <> 'F'""")
def range_expand_join(spark, d):
    o = load(spark, d, "orders")
    c = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("cluster"), F.col("o_orderkey").alias("low"))
    other = o.where("o_orderstatus != 'F'").select(F.col("o_orderkey").alias("node"), F.col("o_orderstatus").alias("status"))
    return H.range_expanded(c.withColumn("high", F.col("low")), "low", "high", 2).join(other, "node").select("cluster", "node", "status")


@query("SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def anti_join_kicks(spark, d):
    return load(spark, d, "documents").select("doc_id", "lang", "source").join(load(spark, d, "labels").where("toxic = 1"), "doc_id", "left_anti")


@query(f"""WITH {LETTERS_SQL},
v AS (SELECT lang, place, ch, sum(weight) AS n FROM letters WHERE place >= s AND place < e GROUP BY lang, place, ch),
p AS (SELECT lang, place, sum(n) AS total, max(n) AS top_n, arg_max(ch, {{'n': n, 'ch': ch}}) AS top, count(*) FILTER (ch <> '-') AS kinds, max(ch) FILTER (ch <> '-') AS only_one FROM v GROUP BY lang, place),
l AS (SELECT lang, place, CASE WHEN top_n > 0.3 * total THEN top WHEN kinds = 1 THEN only_one ELSE 'X' END AS ch FROM p)
SELECT lang, string_agg(ch, '' ORDER BY place) AS consensus FROM l GROUP BY lang""")
def column_consensus(spark, d):
    return columns.consensus(alignment(spark, d), "lang", 0.3, "weight")


_IUPAC_SQL = "CASE " + " ".join(f"WHEN s = '{k}' THEN '{v}'" for k, v in dna.IUPAC.items()) + " WHEN length(s) = 1 THEN s ELSE 'N' END"


@query(f"""WITH {ALIGNMENT_SQL}, c AS (SELECT lang, weight, unnest(range(0, length(seq) // 3)) AS place, unnest(regexp_extract_all(seq, '...')) AS codon FROM msa WHERE length(seq) >= 3),
v AS (SELECT lang, place, codon, sum(weight) AS n FROM c GROUP BY lang, place, codon),
p AS (SELECT lang, place, sum(n) AS total, max(n) AS top_n, arg_max(codon, {{'n': n, 'c': codon}}) AS top, count(*) FILTER (codon <> '---') AS kinds, max(codon) FILTER (codon <> '---') AS only_one FROM v GROUP BY lang, place),
b AS (SELECT lang, place, k, coalesce(string_agg(DISTINCT substr(codon, k, 1), '' ORDER BY substr(codon, k, 1)) FILTER (substr(codon, k, 1) <> '-'), '') AS s FROM v, range(1, 4) t(k) GROUP BY lang, place, k),
i AS (SELECT lang, place, string_agg({_IUPAC_SQL}, '' ORDER BY k) AS mixed FROM b GROUP BY lang, place)
SELECT p.lang, string_agg(CASE WHEN top_n > 0.2 * total THEN top WHEN kinds = 1 THEN only_one ELSE mixed END, '' ORDER BY p.place) AS consensus FROM p JOIN i ON p.lang = i.lang AND p.place = i.place GROUP BY p.lang""")
def codon_consensus_iupac(spark, d):
    return columns.codon_consensus(alignment(spark, d), "lang", 0.2, "weight")


_OCC_SQL = LETTERS_SQL + ", occ AS (SELECT lang, place, count(*) AS n_rows, avg(CASE WHEN ch <> '-' THEN 1.0 ELSE 0.0 END) AS share FROM letters GROUP BY lang, place)"


@query(f"WITH {_OCC_SQL} SELECT lang, CAST(place AS INTEGER) AS place, n_rows, round(share, 8) AS share FROM occ")
def column_occupancy(spark, d):
    return columns.occupancy(alignment(spark, d), "lang").select("lang", "place", "n_rows", F.round("share", 8).alias("share"))


@query(f"""WITH {_OCC_SQL}, low AS (SELECT lang, CAST(place AS INTEGER) AS place, place - row_number() OVER (PARTITION BY lang ORDER BY place) AS run FROM occ WHERE share < 0.9)
SELECT lang, min(place) AS first, max(place) AS last, count(*) AS size FROM low GROUP BY lang, run HAVING count(*) >= 3""")
def cull_columns(spark, d):
    return islands.runs(columns.occupancy(alignment(spark, d), "lang").where("share < 0.9"), ["lang"], "place", 3)


@query(f"WITH {_OCC_SQL} SELECT lang, CAST(min(place) AS INTEGER) AS first, CAST(max(place) AS INTEGER) AS last FROM occ WHERE share >= 0.92 GROUP BY lang")
def edge_trim(spark, d):
    return columns.edges(columns.occupancy(alignment(spark, d), "lang"), "lang", 0.92)


@query("""WITH m AS (SELECT turn, conv_id, regexp_replace(max(text), '[^A-Z]', '-', 'g') AS seq FROM conversations WHERE text IS NOT NULL GROUP BY turn, conv_id),
l AS (SELECT turn, conv_id, unnest(range(0, length(seq))) AS p, unnest(string_split(seq, '')) AS ch FROM m WHERE seq <> ''), k AS (SELECT turn, p FROM l GROUP BY turn, p HAVING bool_or(ch <> '-')),
j AS (SELECT l.turn, l.conv_id, string_agg(l.ch, '' ORDER BY l.p) AS seq FROM l JOIN k ON l.turn = k.turn AND l.p = k.p GROUP BY l.turn, l.conv_id)
SELECT m.turn, m.conv_id, coalesce(j.seq, '') AS seq FROM m LEFT JOIN j ON m.turn = j.turn AND m.conv_id = j.conv_id""")
def empty_column_removal(spark, d):
    rows = load(spark, d, "conversations").where("text is not null").groupBy("turn", "conv_id").agg(F.max("text").alias("text"))
    return columns.without_empty_columns(rows.select("turn", "conv_id", F.regexp_replace("text", "[^A-Z]", "-").alias("seq")), "turn")


@query(f"""WITH {LETTERS_SQL}, n AS (SELECT lang, place, ch, count(*) AS n FROM letters WHERE ch NOT IN ('-', 'X', '?') GROUP BY lang, place, ch),
p AS (SELECT lang, place, sum(n) AS data, max(n) AS most FROM n GROUP BY lang, place), f AS (SELECT *, max(data) OVER () AS f FROM p)
SELECT lang, CAST(sum(CASE WHEN data > 0 THEN 1 ELSE 0 END) AS BIGINT) AS lax, CAST(sum(CASE WHEN data >= 4 AND most < data - 2 THEN 1 ELSE 0 END) AS BIGINT) AS lax_informative,
       CAST(sum(CASE WHEN data >= f THEN 1 ELSE 0 END) AS BIGINT) AS strict, CAST(sum(CASE WHEN data >= f AND most < f - 2 THEN 1 ELSE 0 END) AS BIGINT) AS strict_informative FROM f GROUP BY lang""")
def column_diversity(spark, d):
    return columns.diversity(alignment(spark, d), "lang")


@query("""WITH r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL),
q AS (SELECT event_type, (avg(value) FILTER (k = floor((n - 1) * 0.25)) + avg(value) FILTER (k = ceil((n - 1) * 0.25))) / 2 AS q1, (avg(value) FILTER (k = floor((n - 1) * 0.75)) + avg(value) FILTER (k = ceil((n - 1) * 0.75))) / 2 AS q3 FROM r GROUP BY event_type)
SELECT e.event_type, round(q3 + 0.5 * greatest(q3 - q1, 0.02), 6) AS upper, count(*) FILTER (value > q3 + 0.5 * greatest(q3 - q1, 0.02)) AS outliers FROM events e JOIN q ON e.event_type = q.event_type GROUP BY e.event_type, q1, q3""")
def iqr_outlier_midpoint(spark, d):
    rows = outliers.midpoint_bound(load(spark, d, "events").select("event_type", "value"), "event_type", "value", 0.5)
    return rows.groupBy("event_type").agg(F.round(F.first("upper"), 6).alias("upper"), F.count(F.when(F.col("outlier"), 1)).alias("outliers"))


@query("""WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
SELECT e.event_type, round(greatest(q3 + 0.5 * (q3 - q1), 0.2), 6) AS upper, count(*) FILTER (value > greatest(q3 + 0.5 * (q3 - q1), 0.2)) AS outliers FROM events e JOIN q ON e.event_type = q.event_type GROUP BY e.event_type, q1, q3""")
def iqr_linear(spark, d):
    rows = outliers.linear_bound(load(spark, d, "events").select("event_type", "value"), "event_type", "value", 0.5, 0.2)
    return rows.groupBy("event_type").agg(F.round(F.first("upper"), 6).alias("upper"), F.count(F.when(F.col("outlier"), 1)).alias("outliers"))


@query("""SELECT a.vec_id AS a, b.vec_id AS b, round(list_sum(list_transform(range(1, 65), lambda i: (CAST(a.embedding[i] AS DOUBLE) - b.embedding[i]) ** 2)), 4) AS distance
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id""")
def pairwise_distance(spark, d):
    """All pairs of one label, as between the references of one gene."""
    return pairs.pair_distances(load(spark, d, "embeddings"), "label", "vec_id", "embedding", 64, 4)


@query("SELECT event_type AS gene, user_id % 5 AS taxon, count(*) AS n FROM events GROUP BY CUBE (event_type, user_id % 5)")
def gene_by_taxon_matrix(spark, d):
    rows = load(spark, d, "events").select(F.col("event_type").alias("gene"), (F.col("user_id") % 5).alias("taxon"))
    return combining.gene_by_taxon(rows, "gene", "taxon")


_CONV_SQL = "c AS (SELECT turn AS gene, conv_id AS taxon, max(regexp_replace(text, '[^a-z]', '', 'g')) AS seq FROM conversations WHERE text IS NOT NULL GROUP BY turn, conv_id)"


def _conversations(spark, d):
    rows = load(spark, d, "conversations").where("text is not null")
    return rows.select(F.col("turn").alias("gene"), F.col("conv_id").alias("taxon"), F.regexp_replace("text", "[^a-z]", "").alias("seq"))


@query(f"""WITH {_CONV_SQL}, l AS (SELECT gene, max(length(seq)) AS n FROM c GROUP BY gene), e AS (SELECT DISTINCT taxon FROM c)
SELECT e.taxon, string_agg(rpad(coalesce(c.seq, ''), CAST(l.n AS INTEGER), '-'), '' ORDER BY l.gene) AS seq FROM e CROSS JOIN l LEFT JOIN c ON c.gene = l.gene AND c.taxon = e.taxon GROUP BY e.taxon""")
def concat_fill(spark, d):
    return combining.concatenated(_conversations(spark, d))


@query(f"""WITH {_CONV_SQL}, l AS (SELECT gene, max(length(seq)) AS n FROM c GROUP BY gene)
SELECT gene, CAST(sum(n) OVER w - n + 1 AS BIGINT) AS first, CAST(sum(n) OVER w AS BIGINT) AS last FROM l WINDOW w AS (ORDER BY gene ROWS UNBOUNDED PRECEDING)""")
def charset_offsets(spark, d):
    return combining.charsets(_conversations(spark, d)).select("gene", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"))


@query(f"WITH {_CONV_SQL} SELECT taxon, count(DISTINCT gene) AS genes, count(*) AS n_rows, CAST(sum(length(seq)) AS BIGINT) AS letters FROM c GROUP BY taxon")
def taxon_presence(spark, d):
    one = _conversations(spark, d).groupBy("gene", "taxon").agg(F.max("seq").alias("seq"))
    return combining.taxon_presence(one)


@query("""WITH r AS (SELECT user_id AS gene, event_type AS taxon, event_id FROM events), t AS (SELECT count(DISTINCT taxon) AS t FROM r), g AS (SELECT gene, count(DISTINCT taxon) AS n FROM r GROUP BY gene)
SELECT r.gene, r.taxon, r.event_id FROM r JOIN g ON r.gene = g.gene CROSS JOIN t WHERE g.n / CAST(t.t AS DOUBLE) > 0.75""")
def gene_kick(spark, d):
    rows = load(spark, d, "events").select(F.col("user_id").alias("gene"), F.col("event_type").alias("taxon"), "event_id")
    return combining.kick_genes(rows, 0.75)


@query("SELECT s_suppkey AS taxa, n_name AS taxon FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE lower(n_name) NOT IN (SELECT lower(n_name) FROM nation WHERE n_regionkey = 1)")
def taxa_kick(spark, d):
    nation = load(spark, d, "nation")
    rows = load(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("taxa"), F.col("n_name").alias("taxon"))
    return combining.kick_names(rows, nation.where("n_regionkey = 1").select(F.upper("n_name")), "taxon")


@query(f"WITH {ALIGNMENT_SQL} SELECT doc_id, length(translate(seq, '-?X', '')) AS data FROM msa WHERE seq <> '' AND length(translate(seq, '-?X', '')) / CAST(length(seq) AS DOUBLE) >= 0.85")
def coverage_kick(spark, d):
    return combining.coverage_kick(alignment(spark, d), 0.85).select("doc_id", msa.data_length(F.col("seq"), "-?X").cast("long").alias("data"))


@query("SELECT s_suppkey, coalesce(n_name, CAST(s_nationkey AS VARCHAR)) AS taxon FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON s_nationkey = n_nationkey")
def rename_join(spark, d):
    names = load(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("taxon"), "n_name")
    return combining.renamed(load(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("taxon")), names, "taxon", "n_name")


@query("""WITH a AS (SELECT 0 AS sample, c_nationkey AS gene, c_mktsegment AS target, c_custkey % 4 = 0 AS is_ref, c_name AS seq FROM customer),
b AS (SELECT 1 AS sample, s_nationkey AS gene, 'BUILDING' AS target, s_suppkey % 2 = 0 AS is_ref, s_name AS seq FROM supplier), u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT gene, target, is_ref, sample, replace(replace(seq, '#', ''), '-', '') AS seq FROM (SELECT *, row_number() OVER (PARTITION BY gene, target, is_ref ORDER BY sample, replace(replace(seq, '#', ''), '-', '')) AS rn FROM u) WHERE NOT is_ref OR rn = 1""")
def union_refs_once(spark, d):
    c = load(spark, d, "customer").select(F.col("c_nationkey").alias("gene"), F.col("c_mktsegment").alias("target"), (F.col("c_custkey") % 4 == 0).alias("is_ref"), F.col("c_name").alias("seq"))
    s = load(spark, d, "supplier").select(F.col("s_nationkey").alias("gene"), F.lit("BUILDING").alias("target"), (F.col("s_suppkey") % 2 == 0).alias("is_ref"), F.col("s_name").alias("seq"))
    return combining.union_references_once([c, s], ["gene", "target"], "#-")


_CODON_LIST = ", ".join(f"'{c}'" for c, a in dna.CODONS.items() if a == "*")


@query(f"""WITH {READS_SQL} SELECT doc_id, coalesce(list_aggregate(list_transform(regexp_extract_all(seq, '...'), lambda c: CASE WHEN c IN ({_CODON_LIST}) THEN 'NNN' ELSE c END), 'string_agg', ''), '') || right(seq, CAST(length(seq) % 3 AS BIGINT)) AS nt FROM reads""")
def stop_replace(spark, d):
    return reads(spark, d).select("doc_id", dna.stops_masked(F.col("seq")).alias("nt"))


@query(f"""WITH {ALIGNMENT_SQL}, s AS (SELECT doc_id, seq, length(seq) - length(ltrim(seq, '-')) AS s, length(rtrim(seq, '-')) AS e FROM msa)
SELECT doc_id, CASE WHEN e > s THEN substr(seq, 1, s) || replace(substr(seq, s + 1, e - s), '-', '?') || substr(seq, e + 1) ELSE seq END AS seq FROM s""")
def gap_replace(spark, d):
    return alignment(spark, d).select("doc_id", msa.inner_gaps(F.col("seq")).alias("seq"))


@query(f"WITH {READS_SQL} SELECT doc_id, regexp_replace(seq, '(..).', '\\1', 'g') AS nt FROM reads")
def codon_positions(spark, d):
    return reads(spark, d).select("doc_id", dna.codon_positions(F.col("seq"), (1, 2)).alias("nt"))


@query(f"""WITH {READS_SQL}, f AS (SELECT doc_id, k, CASE WHEN k < 0 THEN substr(translate(reverse(seq), 'ACGTN', 'TGCAN'), abs(k)) ELSE substr(seq, k) END AS seq FROM reads, (VALUES (1), (2), (3), (-1), (-2), (-3)) t(k))
SELECT doc_id, k AS frame, coalesce(list_aggregate(list_transform(regexp_extract_all(seq, '...'), lambda c: substr('{dna.AMINO_ACIDS}', CAST((strpos('TCAG', substr(c, 1, 1)) - 1) * 16 + (strpos('TCAG', substr(c, 2, 1)) - 1) * 4 + strpos('TCAG', substr(c, 3, 1)) AS BIGINT), 1)), 'string_agg', ''), '') AS aa FROM f""")
def six_frames(spark, d):
    both = F.arrays_zip(F.array(*map(F.lit, dna.FRAMES)).alias("frame"), dna.six_frames(F.col("seq")).alias("aa"))
    return reads(spark, d).select("doc_id", F.inline(both))


@query(f"WITH {ALIGNMENT_SQL} SELECT doc_id, length(seq) - length(ltrim(seq, '-')) AS s, length(rtrim(seq, '-')) AS e FROM msa")
def data_span(spark, d):
    return alignment(spark, d).select("doc_id", msa.data_start(F.col("seq")).cast("long").alias("s"), msa.data_end(F.col("seq")).cast("long").alias("e"))


@query("""WITH h AS (SELECT o_orderkey, o_orderpriority || '|' || o_custkey || '|' || o_orderstatus || '|NODE_' || o_orderkey || '&&NODE_' || (o_orderkey + 1) || '|2' AS header FROM orders)
SELECT o_orderkey, string_split(header, '|')[1] AS gene, string_split(header, '|')[3] AS taxon, o_orderkey + 1 AS last_node, 2 AS n_nodes FROM h""")
def header_split(spark, d):
    k = F.col("o_orderkey").cast("string")
    name = F.concat_ws("|", "o_orderpriority", F.col("o_custkey").cast("string"), "o_orderstatus", F.concat(F.lit("NODE_"), k, F.lit("&&NODE_"), (F.col("o_orderkey") + 1).cast("string")), F.lit("2"))
    rows = load(spark, d, "orders").select("o_orderkey", name.alias("header")).withColumn("nodes", headers.nodes(headers.field(F.col("header"), 3)))
    return rows.select("o_orderkey", headers.field(F.col("header"), 0).alias("gene"), headers.field(F.col("header"), 2).alias("taxon"), F.array_max("nodes").alias("last_node"), F.size("nodes").alias("n_nodes"))


@query("""WITH c AS (SELECT o_custkey, o_orderpriority AS r, count(*) AS n FROM orders GROUP BY 1, 2), b AS (SELECT o_custkey, r, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, r) AS k FROM c),
l AS (SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), '&&' ORDER BY o_orderkey) AS nodes FROM orders GROUP BY 1)
SELECT l.o_custkey, b.r AS reference, l.nodes FROM l JOIN b ON l.o_custkey = b.o_custkey AND b.k = 1""")
def node_list(spark, d):
    return combining.merged_name(load(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_header(spark, d):
    return load(spark, d, "events").select("event_id", headers.json_field(F.concat(F.lit("id "), F.col("props")), "k").alias("k"))


@query(f"""WITH {READS_SQL}, s AS (SELECT doc_id, repeat('A', CAST(doc_id % 14 AS INTEGER)) || 'x' || seq || 'y' || repeat('CG', CAST(doc_id % 8 AS INTEGER)) AS seq FROM reads),
t AS (SELECT doc_id, substr(seq, CASE WHEN doc_id % 14 >= 9 THEN CAST(doc_id % 14 // 3 * 3 + 1 AS INTEGER) ELSE 1 END, length(seq) - (CASE WHEN doc_id % 14 >= 9 THEN CAST(doc_id % 14 // 3 * 3 AS INTEGER) ELSE 0 END) - (CASE WHEN doc_id % 8 >= 5 THEN CAST(doc_id % 8 * 2 // 3 * 3 AS INTEGER) ELSE 0 END)) AS seq FROM s)
SELECT doc_id, length(seq) AS n, md5(seq) AS seq_md5 FROM t""")
def homopolymer_trim(spark, d):
    """Whole sequences between runs of one letter and of two."""
    made = F.concat(F.repeat(F.lit("A"), (F.col("doc_id") % 14).cast("int")), F.lit("x"), F.col("seq"), F.lit("y"), F.repeat(F.lit("CG"), (F.col("doc_id") % 8).cast("int")))
    cut = reads(spark, d).select("doc_id", dna.homopolymer_trimmed(made, 9).alias("seq"))
    return cut.select("doc_id", F.length("seq").cast("long").alias("n"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@query("SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size = 1) THEN 'target' ELSE 'off_target' END AS route FROM part")
def route_target(spark, d):
    part = load(spark, d, "part")
    return combining.routed(part.select("p_partkey", "p_brand"), part.where("p_size = 1").select("p_brand"), "p_brand").select("p_partkey", "route")


@query(f"""WITH {READS_SQL}, k AS (SELECT doc_id, lang, list_distinct(list_transform(range(1, length(seq) - 6), lambda i: substr(seq, i, 8))) AS g FROM reads WHERE length(seq) >= 8)
SELECT a.doc_id AS a, b.doc_id AS b, round(len(list_intersect(a.g, b.g)) / CAST(least(len(a.g), len(b.g)) AS DOUBLE), 6) AS similarity FROM k a JOIN k b ON b.doc_id = a.doc_id + 1""")
def kmer_similarity(spark, d):
    rows = reads(spark, d).select("doc_id", "seq")
    b = rows.select(F.col("doc_id").alias("b"), (F.col("doc_id") - 1).alias("doc_id"), F.col("seq").alias("other"))
    # Texts that are too short give null: a filter before the join would work out every sequence twice.
    found = rows.join(b, "doc_id").select(F.col("doc_id").alias("a"), "b", combining.kmer_similarity(F.col("seq"), F.col("other"), 8).alias("similarity"))
    return found.where("similarity is not null").withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH {HITS_SQL} SELECT header, line, CASE WHEN frame < 0 THEN qend ELSE qstart END AS s, CASE WHEN frame < 0 THEN qstart ELSE qend END AS e,
CASE WHEN frame > 0 THEN least(qstart, qend) + target * 500 ELSE 749 - greatest(qstart, qend) + target * 500 END AS parent_s, CASE WHEN frame > 0 THEN greatest(qstart, qend) + target * 500 - 1 ELSE 749 - least(qstart, qend) + target * 500 - 1 END AS parent_e FROM hits""")
def chunk_coordinates(spark, d):
    h = hits(spark, d)
    s, e = intervals.swapped(F.col("frame"), F.col("qstart"), F.col("qend"))
    h = h.select("header", "line", "target", F.when(F.col("frame") > 0, "+").otherwise("-").alias("strand"), s.alias("s"), e.alias("e"))
    ps, pe = intervals.chunk_coordinates(F.col("strand"), F.col("s"), F.col("e"), F.col("target") * 500, F.lit(749))
    return h.select("header", "line", "s", "e", ps.alias("parent_s"), pe.alias("parent_e"))


@query("SELECT l_orderkey AS node, count(*) AS hits, round(max(l_extendedprice), 2) AS best, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def node_scores(spark, d):
    """A7, A9 and A11."""
    rows = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("node"))
    return rows.agg(F.count("*").alias("hits"), F.round(F.max("l_extendedprice"), 2).alias("best"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents")).where("hits > 1")


@query("""WITH m AS (SELECT lang, median(n_chars) AS m FROM documents GROUP BY lang) SELECT doc_id, d.lang FROM documents d JOIN m ON d.lang = m.lang WHERE n_chars >= 0.5 * m.m""")
def short_against_median(spark, d):
    """F21."""
    docs = load(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(docs.groupBy("lang").agg(F.expr("percentile(n_chars, 0.5)").alias("m")), "lang").where("n_chars >= 0.5 * m").select("doc_id", "lang")


@query("""WITH k AS (SELECT o_custkey, list_sort(list_distinct(list(o_orderkey % 50) FILTER (o_orderstatus = 'F'))) AS a, list_sort(list_distinct(list(o_orderkey % 50) FILTER (o_orderstatus <> 'F'))) AS b FROM orders GROUP BY o_custkey)
SELECT o_custkey, len(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x))) AS only_a, len(list_filter(coalesce(a, []), lambda x: list_contains(coalesce(b, []), x))) AS shared FROM k""")
def set_operations(spark, d):
    """U3."""
    rows = load(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 50)).alias("a"), F.collect_set(F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey") % 50)).alias("b"))
    return rows.select("o_custkey", F.size(F.array_except("a", "b")).cast("long").alias("only_a"), F.size(F.array_intersect("a", "b")).cast("long").alias("shared"))


# --- grouped algorithms: some have SQL in grouped_sql.py, tests hold the others against cases worked out by hand or brute force ---


@plain
def directional_clusters(spark, d):
    """G13 over the orders of each customer: the order number is the node's, status gives strand and place."""
    from strandwork.operators.grouped.clusters import clustered

    k = F.col("o_orderkey")
    seq = F.concat(F.repeat(F.lit("-"), (k % 40).cast("int")), F.repeat(F.lit("A"), 30), F.repeat(F.lit("-"), (40 - k % 40).cast("int")))
    rows = load(spark, d, "orders").select(F.col("o_custkey").alias("gene"), k.cast("string").alias("name"), F.array(k).alias("ids"), F.when(F.col("o_orderstatus") == "F", "+").otherwise("-").alias("strand"), seq.alias("seq"))
    return clustered(rows, "gene", 5000, 0.3, 0.4)


@plain
def distance_screen(spark, d):
    """The texts of conversations, by turn, screened against the benchmark's."""
    from strandwork.operators.grouped.screening import screened

    rows = load(spark, d, "conversations").where("text is not null").select(F.col("turn").cast("string").alias("gene"), F.concat_ws(":", F.lit("conversation"), F.col("conv_id").cast("string"), "role", F.md5(F.col("text").cast("binary"))).alias("name"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq")).distinct()
    refs = load(spark, d, "benchmark").where("text is not null").select((F.col("item_id") % 8).cast("string").alias("gene"), F.concat_ws(":", F.lit("reference"), F.col("item_id").cast("string")).alias("name"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"))
    return screened(rows, refs)


@plain
def consensus_merge(spark, d):
    """One merged row for each overlap group of a turn and role."""
    from strandwork.operators.grouped.merging import merged

    text = F.regexp_replace("text", "[^A-Za-z]", "")
    one = load(spark, d, "conversations").where("text is not null").groupBy("turn", "role", "conv_id").agg(F.max("text").alias("text"))
    rows = one.select(F.col("turn").cast("string").alias("gene"), F.col("role").alias("taxa"), F.col("conv_id").cast("string").alias("name"), F.col("role").alias("ref"), F.lit(1).alias("weight"), text.alias("aa"), F.regexp_replace(text, "(.)", "$1$1$1").alias("nt"))
    refs = load(spark, d, "benchmark").select((F.col("item_id") % 8).cast("string").alias("gene"), F.col("text").alias("seq"))
    return merged(rows, refs)


@plain
def reference_cull(spark, d):
    """A27 over the benchmark's items."""
    rows = load(spark, d, "benchmark").where("text is not null").select((F.col("item_id") % 8).cast("string").alias("gene"), F.col("item_id").cast("string").alias("name"), F.regexp_replace("text", "[^A-Za-z]", "").alias("seq"))
    return outliers.reference_cull(rows, "gene").select("gene", "name", F.length("seq").alias("n"))


@plain
def prepare_stage(spark, d):
    """The prepare stage over all documents: reads with their nodes, lengths and further copies."""
    from strandwork.plans import stages

    rows = reads(spark, d).select(F.col("source").alias("taxa"), F.col("doc_id").alias("idx"), F.concat(F.lit("read_"), F.col("doc_id").cast("string"), F.lit(" x")).alias("header"), "seq")
    out = stages.prepare(rows)
    return out["reads"].join(out["dupes"], ["taxa", "node"], "left").select("taxa", "node", F.length("seq").alias("n"), F.coalesce("dupes", F.lit(0)).alias("dupes"))


from strandwork.plans import exchange_queries, gene_queries, row_queries  # noqa: E402, F401  these enter theirs in the registry
from strandwork.plans import grouped_sql  # noqa: E402, F401  SQL of queries that are there by now
