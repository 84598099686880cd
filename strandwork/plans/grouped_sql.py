"""SQL of queries that other modules register: the same rows by joins, windows and recursion."""

from __future__ import annotations

from strandwork.functions.blosum import SCORES
from strandwork.functions.dna import AMINO_ACIDS, BASES
from strandwork.plans.registry import QUERIES, SQL
from strandwork.plans.row_queries import TURNS_SQL
from strandwork.plans.tables import HITS_SQL, READS_SQL


def _also(name: str, sql: str) -> None:
    assert name in QUERIES
    SQL[name] = sql


def _agreed_sql(threshold: float) -> str:
    """letters (gene, name, place, ch) of turns, and agreed (gene, place, ch, total): the consensus of letters inside spans."""
    return f"""{TURNS_SQL},
letters AS (SELECT gene, name, length(seq) - length(ltrim(seq, '-')) AS s, length(rtrim(seq, '-')) AS e, unnest(range(0, length(seq))) AS place, unnest(string_split(seq, '')) AS ch FROM turns WHERE seq <> ''),
votes AS (SELECT gene, place, ch, count(*) AS n FROM letters WHERE place >= s AND place < e GROUP BY ALL),
agreed AS (
  SELECT gene, place, sum(n) AS total, CASE WHEN max(n) > {threshold} * sum(n) THEN arg_max(ch, {{'n': n, 'ch': ch}}) WHEN count(*) FILTER (ch <> '-') = 1 THEN max(ch) FILTER (ch <> '-') ELSE 'X' END AS ch
  FROM votes GROUP BY gene, place),
differs AS (
  SELECT gene, name, count(*) AS n, count(*) FILTER (l.ch <> a.ch) AS d, count(*) FILTER (l.ch <> a.ch) / CAST(count(*) AS DOUBLE) AS distance
  FROM letters l JOIN agreed a USING (gene, place) WHERE l.ch NOT IN ('-', 'X') AND a.ch NOT IN ('-', 'X') GROUP BY gene, name)"""


_also("consensus_distance", f"WITH {_agreed_sql(0.3)} SELECT t.gene, t.name FROM turns t LEFT JOIN differs f ON f.gene = t.gene AND f.name = t.name WHERE t.gene IN (SELECT gene FROM agreed) AND coalesce(distance, 0) < 0.8")

# A nucleotide row is its protein row with each letter three times, so both are as far from their consensus.
_also("consensus_distance_pairs", f"""WITH {_agreed_sql(0.3)}, kept AS (SELECT t.gene, t.name FROM turns t LEFT JOIN differs f ON f.gene = t.gene AND f.name = t.name WHERE t.gene IN (SELECT gene FROM agreed) AND coalesce(distance, 0) < 0.7)
SELECT side, gene, name FROM kept, (VALUES ('aa'), ('nt')) AS sides(side)""")

_also("severe_rows", f"""WITH {_agreed_sql(0.3)}, bound AS (SELECT gene, greatest(quantile_cont(distance, 0.75) + 1.5 * (quantile_cont(distance, 0.75) - quantile_cont(distance, 0.25)), 0.1) AS bound FROM differs GROUP BY gene)
SELECT gene, name FROM differs JOIN bound USING (gene) WHERE distance > bound""")

_also("shallow_regions", f"""WITH {_agreed_sql(0.3)}, low AS (SELECT gene, place, place - row_number() OVER (PARTITION BY gene ORDER BY place) AS run FROM agreed WHERE ch NOT IN ('-', 'X') AND total < 3)
SELECT gene, CAST(min(place) AS INTEGER) AS start, CAST(max(place) + 1 AS INTEGER) AS "end" FROM low GROUP BY gene, run""")

_also("isoform_choice", f"""WITH {TURNS_SQL}, letters AS (SELECT gene, name, unnest(range(0, length(seq))) AS place, unnest(string_split(seq, '')) AS ch FROM turns WHERE seq <> ''),
counts AS (SELECT gene, place, ch, count(*) AS n FROM letters WHERE CAST(name AS BIGINT) % 3 = 0 AND ch <> '-' GROUP BY ALL),
scored AS (SELECT t.gene, t.name, length(replace(t.seq, '-', '')) AS data, (SELECT coalesce(sum(c.n), 0) FROM letters l JOIN counts c ON c.gene = l.gene AND c.place = l.place AND c.ch = l.ch WHERE l.gene = t.gene AND l.name = t.name) AS score FROM turns t WHERE CAST(t.name AS BIGINT) % 3 <> 0)
SELECT gene, name FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY score DESC, data DESC, name) AS rn FROM scored) WHERE rn = 1""")

_KMERS = "SELECT {names}, unnest(range(0, greatest(0, length(t) - 4))) AS place, unnest(list_transform(range(1, greatest(1, length(t) - 3)), lambda i: substr(t, i, 5))) AS kmer FROM (SELECT *, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS t FROM {table} WHERE text IS NOT NULL)"
_also("seeded_search", f"""WITH a AS ({_KMERS.format(names="conv_id AS node, CAST(turn AS INTEGER) AS frame", table="conversations")}),
b AS (SELECT DISTINCT target, kmer FROM ({_KMERS.format(names="CAST(item_id AS VARCHAR) AS target", table="benchmark")}))
SELECT node, frame, target, count(DISTINCT kmer) AS score, CAST(min(place) AS INTEGER) AS qstart, CAST(max(place) + 5 AS INTEGER) AS qend
FROM a JOIN b USING (kmer) GROUP BY node, frame, target HAVING count(DISTINCT kmer) >= 3""")

_ENTROPY = "(SELECT sum(CASE WHEN n > 0 THEN -(n / CAST(length(seq) AS DOUBLE)) * log2(n / CAST(length(seq) AS DOUBLE)) ELSE 0 END) / 2 FROM (SELECT unnest([length(seq) - length(replace(seq, x, '')) for x in ['A', 'C', 'G', 'T']]) AS n))"
_also("prepare_stage", f"""WITH {READS_SQL}, kind AS (SELECT source AS taxa, max(length(seq)) > 50000 AS is_genome FROM reads GROUP BY source),
rows AS (SELECT taxa, doc_id, seq, is_genome FROM reads JOIN kind ON source = taxa),
once AS (SELECT taxa, min(doc_id) AS doc_id, min_by(seq, doc_id) AS seq, count(*) - 1 AS dupes FROM rows WHERE NOT is_genome AND length(seq) >= 90 AND {_ENTROPY} >= 0.7 GROUP BY taxa, least(seq, translate(reverse(seq), 'ACGTN', 'TGCAN'))),
chunks AS (SELECT taxa, doc_id, k, substr(seq, k * 500 + 1, 750) AS seq FROM (SELECT *, unnest(range(0, CAST(ceil(length(seq) / 500.0) AS BIGINT))) AS k FROM rows WHERE is_genome AND length(seq) > 0))
SELECT taxa, row_number() OVER (PARTITION BY taxa ORDER BY doc_id) AS node, CAST(length(seq) AS INTEGER) AS n, dupes FROM once
UNION ALL SELECT taxa, row_number() OVER (PARTITION BY taxa ORDER BY doc_id, k) AS node, CAST(length(seq) AS INTEGER) AS n, 0 AS dupes FROM chunks WHERE length(seq) >= 90""")

_also("finish_stage", f"""WITH {TURNS_SQL}, r AS (SELECT gene, CAST(CAST(name AS BIGINT) % 40 AS VARCHAR) AS taxon, length(seq) - length(replace(seq, 'K', '')) AS stops, replace(seq, 'K', 'X') AS seq FROM turns),
k AS (SELECT * FROM r WHERE length(replace(seq, '-', '')) >= 20 AND length(translate(seq, '-?X', '')) / CAST(length(seq) AS DOUBLE) >= 0.3),
b AS (SELECT gene, taxon, count(*) AS every, sum(stops) AS stops FROM r GROUP BY CUBE (gene, taxon)), m AS (SELECT gene, taxon, count(*) AS n FROM k GROUP BY CUBE (gene, taxon))
SELECT b.gene, b.taxon, coalesce(n, 0) AS n, CAST(b.stops AS BIGINT) AS stops, every - coalesce(n, 0) AS kicked FROM b LEFT JOIN m ON m.gene IS NOT DISTINCT FROM b.gene AND m.taxon IS NOT DISTINCT FROM b.taxon""")

_AMINO = f"list_aggregate(list_transform(regexp_extract_all(nt, '...'), lambda c: substr('{AMINO_ACIDS}', CAST((instr('{BASES}', c[1]) - 1) * 16 + (instr('{BASES}', c[2]) - 1) * 4 + instr('{BASES}', c[3]) AS BIGINT), 1)), 'string_agg', '')"
# Equal nucleotides have equal proteins, so of what the first hit doesn't contain the first of each protein stays.
_also("hit_dedupe", f"""WITH {READS_SQL}, p AS (SELECT coalesce(source, '') AS gene, doc_id AS node, unnest(range(0, len(parts))) AS k, unnest(parts) AS nt FROM (SELECT *, string_split(seq, 'ACGT') AS parts FROM reads)),
h AS (SELECT *, {_AMINO} AS aa, first_value(nt) OVER (PARTITION BY gene, node ORDER BY k) AS first_nt, row_number() OVER (PARTITION BY gene, node ORDER BY k) AS rn FROM p WHERE length(nt) >= 12),
s AS (SELECT *, row_number() OVER (PARTITION BY gene, node, aa ORDER BY k) AS nth FROM h WHERE rn = 1 OR NOT contains(first_nt, nt)),
n AS (SELECT *, row_number() OVER (PARTITION BY gene, node ORDER BY k) - 1 AS number FROM s WHERE nth = 1)
SELECT gene, node, CAST(k AS INTEGER) AS k, CASE WHEN number = 0 THEN '' ELSE '_' || number END AS suffix FROM n""")

_ORDER = "header, target, qstart, frame"
_MET = "(least(rows[k].e, rows[i + 1].e) - greatest(rows[k].s, rows[i + 1].s))"
_also("search_stage", f"""WITH RECURSIVE {HITS_SQL}, raw AS (SELECT DISTINCT ON (header, CAST(target AS VARCHAR), frame, qstart) header, CAST(target AS VARCHAR) AS target, frame, score, qstart, qend FROM hits),
targets AS (SELECT p_brand AS gene, 't' || (p_partkey % 20) AS taxon, CAST(p_partkey AS VARCHAR) AS target FROM part WHERE p_size > 3),
j AS (SELECT raw.*, t.gene, t.taxon FROM raw LEFT JOIN targets t ON t.target = raw.target),
ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, {_ORDER}) AS rn, count(*) OVER () AS n FROM j),
top AS (SELECT taxon FROM (SELECT DISTINCT header, taxon FROM ranked WHERE rn <= CAST(floor(n * 0.25) AS BIGINT) AND taxon IS NOT NULL) GROUP BY taxon ORDER BY count(*) DESC, taxon LIMIT 10),
good AS (SELECT *, sum(score) OVER (PARTITION BY header, target) AS pooled FROM j WHERE score * 1e-12 <= 5e-6 AND taxon IN (SELECT taxon FROM top)),
best AS (SELECT *, max(pooled) OVER (PARTITION BY header) AS most, least(qstart, qend) AS s, greatest(qstart, qend) AS e FROM good),
m AS (SELECT *, first_value(gene) OVER w AS mg, first_value(score) OVER w AS ms, first_value(s) OVER w AS m1, first_value(e) OVER w AS m2 FROM best WHERE pooled >= 0.9 * most WINDOW w AS (PARTITION BY header, frame ORDER BY score DESC, {_ORDER})),
f AS (SELECT * FROM m WHERE NOT (gene <> mg AND greatest(0, least(m2, e) - greatest(m1, s)) / CAST(m2 - m1 AS DOUBLE) >= 0.3 AND ms / score >= 1.1)),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY header, frame, gene ORDER BY score DESC, {_ORDER}) AS rn FROM f) WHERE rn = 1),
g AS (SELECT gene, header, list({{'target': target, 'frame': frame, 'score': score, 's': s, 'e': e}} ORDER BY score DESC, target, s, frame) AS rows FROM o GROUP BY gene, header),
r AS (
  SELECT gene, header, 0 AS i, rows, CAST([] AS INTEGER[]) AS kept FROM g
  UNION ALL
  SELECT gene, header, i + 1, rows, CASE WHEN len(list_filter(kept, lambda k: {_MET} > 0 AND {_MET} / CAST(greatest(rows[k].e, rows[i + 1].e) - least(rows[k].s, rows[i + 1].s) AS DOUBLE) >= 0.3)) > 0 THEN kept ELSE list_append(kept, CAST(i + 1 AS INTEGER)) END FROM r WHERE i < len(rows)),
k AS (SELECT gene, header, rows[k].target AS target, rows[k].frame AS frame, rows[k].s AS qstart, rows[k].e AS qend, rows[k].score AS score FROM (SELECT gene, header, rows, unnest(kept) AS k FROM r WHERE i = len(rows))),
c AS (SELECT *, CASE WHEN header - lag(header) OVER w > 35 THEN 1 ELSE 0 END AS new FROM k WINDOW w AS (PARTITION BY gene ORDER BY header, target, qstart, frame))
SELECT gene, header, target, frame, qstart, qend, score, CAST(1 + sum(new) OVER (PARTITION BY gene ORDER BY header, target, qstart, frame ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM c""")


def _deviating_sql(name: str, rows: str, rounds: int = 2) -> str:
    """Tables {name}_1 and on: the rows (gene, name) of ``rows`` (gene, name, seq, s, e) that deviate in each round, over their columns [s, e)."""
    out = f"""
{name}_l AS (SELECT gene, name, place, ch FROM (SELECT gene, name, s, e, unnest(range(0, length(seq))) AS place, unnest(string_split(seq, '')) AS ch FROM {rows} WHERE seq <> '') WHERE place >= s AND place < e AND ch <> '-'),
{name}_d AS (
  SELECT gene, a, b, greatest(0.0, 1 - 2 * ab / (aa + bb)) ** 2 AS d FROM (
    SELECT x.gene, x.name AS a, y.name AS b, CAST(sum(m.score) AS DOUBLE) AS ab, sum(mx.score) AS aa, sum(my.score) AS bb
    FROM {name}_l x JOIN {name}_l y ON x.gene = y.gene AND x.place = y.place AND x.name < y.name JOIN blosum m ON m.a = x.ch AND m.b = y.ch JOIN blosum mx ON mx.a = x.ch AND mx.b = x.ch JOIN blosum my ON my.a = y.ch AND my.b = y.ch GROUP BY ALL)),
{name}_0 AS (SELECT NULL AS gene, NULL AS name WHERE false)"""
    for k in range(1, rounds + 1):
        gone = " UNION ALL ".join(f"SELECT gene, name FROM {name}_{j}" for j in range(k))
        out += f""",
{name}_v{k} AS (SELECT d.* FROM {name}_d d WHERE NOT EXISTS (SELECT 1 FROM ({gone}) g WHERE g.gene = d.gene AND g.name IN (d.a, d.b))),
{name}_{k} AS (
  SELECT gene, name FROM (SELECT gene, a AS name, d FROM {name}_v{k} UNION ALL SELECT gene, b, d FROM {name}_v{k})
  JOIN (SELECT gene, greatest(quantile_cont(d, 0.5) + quantile_cont(d, 0.75) - quantile_cont(d, 0.25), 0.03) AS bound FROM {name}_v{k} GROUP BY gene) USING (gene)
  GROUP BY gene, name HAVING median(d) > any_value(bound))"""
    return out


_PAIRS = ", ".join(f"('{a}', '{b}', {SCORES[ord(a), ord(b)]})" for a in "ACDEGKLST" for b in "ACDEGKLST")
_also("deviation", f"""WITH {TURNS_SQL}, blosum AS (SELECT * FROM (VALUES {_PAIRS}) AS t(a, b, score)),
spans AS (SELECT gene, name, seq, length(seq) - length(ltrim(seq, '-')) AS s, length(rtrim(seq, '-')) AS e FROM turns),
data AS (SELECT gene, name, list(place ORDER BY place) AS places FROM (SELECT gene, name, unnest(range(0, length(seq))) AS place, unnest(string_split(seq, '')) AS ch FROM turns WHERE seq <> '') WHERE ch <> '-' GROUP BY ALL),
middles AS (SELECT spans.*, places[len(places) // 2 + 1] AS m FROM spans JOIN data USING (gene, name)),
{_deviating_sql("w", "spans")}, f_rows AS (SELECT gene, name, seq, s, m AS e FROM middles), {_deviating_sql("f", "f_rows")},
s_rows AS (SELECT gene, name, seq, m AS s, e FROM middles WHERE NOT EXISTS (SELECT 1 FROM (SELECT * FROM f_1 UNION ALL SELECT * FROM f_2) g WHERE g.gene = middles.gene AND g.name = middles.name)), {_deviating_sql("s", "s_rows")}
SELECT gene, name, 'whole' AS part FROM (SELECT * FROM w_1 UNION ALL SELECT * FROM w_2)
UNION ALL SELECT gene, name, 'first' FROM (SELECT * FROM f_1 UNION ALL SELECT * FROM f_2)
UNION ALL SELECT gene, name, 'second' FROM (SELECT * FROM s_1 UNION ALL SELECT * FROM s_2)""")
