"""The queries of this subpackage and their SQL, added to __spark_entry__.py where the subpackage is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwork.llm import conversation_repair, conversation_trie, decontaminate, embedding_dedup, html_content, license_scan, lm_score, mixing, near_dedup, quality, sentence_pieces, sharding, token_file
from strandwork.llm.common import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')) AS at
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM d GROUP BY source),
c AS (SELECT *, CAST(3 * source_size AS DOUBLE) AS cap FROM s),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight ASC, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(weight) OVER (ORDER BY cap / weight ASC, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
f AS (SELECT *, max(CASE WHEN level <= cap / weight THEN level END) OVER () AS final FROM l),
t AS (SELECT source, source_size, CASE WHEN weight * final < cap THEN weight * final ELSE cap END AS target FROM f),
q AS (
  SELECT d.*, t.source_size, t.target,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "end"
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
v AS (
  SELECT (turn * source_size + "end") / target AS finish, CAST(sum(size) AS DOUBLE) AS volume
  FROM q, (VALUES (0), (1), (2)) AS turns(turn) WHERE size > 0 AND target > 0 GROUP BY 1),
w AS (SELECT finish, volume, sum(volume) OVER (ORDER BY finish) AS until FROM v),
k AS (SELECT max(finish) AS cut FROM w WHERE until - volume / 2 <= (SELECT sum(target) FROM t))
SELECT doc_id, size, source_size, target,
       CAST(size * (SELECT count(*) FROM (VALUES (0), (1), (2)) AS turns(turn)
                    WHERE q.size > 0 AND q.target > 0 AND (turn * q.source_size + q."end") / q.target <= k.cut) AS BIGINT) AS taken
FROM q, k
"""


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "covered_words", "coverage", F.size("tiles").alias("n_tiles"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.encoded(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths: source, language and id stand for directories and a file name."""
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    found = license_scan.scan(table(spark, sf_dir, "documents"), path)
    return found.select("doc_id", "licence", "similarity", "line", F.array_join("found", ",").alias("found"), "licence_file", "inherited", "inherited_from")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")



def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"))


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentence_pieces.encoded(table(spark, sf_dir, "documents"), piece_model_path())
    decoded = sentence_pieces.decoded("ids", piece_model_path())
    return pieces.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("long").alias("source_bytes"),
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audits(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB: each character's code, then eight steps of one bit."""
    codes = f"list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({text}) + 1), lambda i: [ord({text}[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])))"
    return f"xor(list_reduce({codes}, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"


OP12_SQL = rf"""
WITH o AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, left(sha256(strlen(role) || ':' || role || text), 32)) - 1 AS place FROM o),
i AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS named, conv_id - conv_id % 20 AS head FROM o),
c AS (SELECT *, {crc32_sql("named")} % 4 AS h FROM i),
r AS (
  SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.head AND place < h
  UNION ALL SELECT c.conv_id, place, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND place >= h),
p AS (
  SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^ 	-]+')) AS words,
         sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER w) AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM c),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved FROM p GROUP BY node, depth),
l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
e AS (SELECT node, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids FROM p JOIN l ON l.conv_id = p.conv_id AND l.depth = p.depth GROUP BY node),
a AS (SELECT n.node, p.node AS parent FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
k AS (SELECT parent AS node, count(*) AS n_children FROM a GROUP BY 1),
s AS (
  SELECT p.node, count(*) FILTER (k.node IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN k ON k.node = n.node GROUP BY p.node)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN e ON e.node = n.node LEFT JOIN a ON a.node = n.node LEFT JOIN n AS u ON u.node = a.parent
"""


def _op13_sql() -> str:
    """The Viterbi pass as a recursive query: a layer a step, each state's cost, audit and repaired text, by least cost and audit."""

    def after(s: str, cost: str, letter: str, turn: str = "") -> str:
        text = f"{s}.t || CASE WHEN {s}.t = '' THEN '' ELSE chr(10) END || {turn}" if turn else f"{s}.t"
        return f"{{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 't': {text}}}"

    def least(*paths: tuple[str, str]) -> str:
        cases = ", ".join(f"CASE WHEN {given} THEN {path} END" for given, path in paths)
        return f"list_sort(list_filter([{cases}], lambda x: x IS NOT NULL))[1]"

    def reached(to: int, states: dict[int, str], role: str) -> str:
        paths = [(f"s{to} IS NOT NULL", after(f"s{to}", "4", "D"))]
        for s, initial in states.items():
            paths.append((f"s{s} IS NOT NULL AND NOT gone AND left(role, 1) = '{initial}'", after(f"s{s}", "more", "K", "role || ':' || text")))
            if role:
                paths.append((f"s{s} IS NOT NULL AND NOT gone", after(f"s{s}", "3 + more", "R", f"'{role}:' || text")))
        return least(*paths)

    here = lambda s: (f"{s} IS NOT NULL", s)  # noqa: E731
    inserted = lambda s, role: (f"{s} IS NOT NULL", after(s, "3", "I", f"'{role}:'"))  # noqa: E731
    return rf"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS named FROM conversations),
k AS (SELECT *, {crc32_sql("named")} % 20 AS kind FROM o),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, (VALUES (1), (2)) AS times(time) WHERE kind > 0 AND (time = 1 OR kind = 3)),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, left(sha256(strlen(role) || ':' || role || text), 32)) AS rn FROM d),
f AS (
  SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS again,
         regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) || left(role, 1) AS pair FROM n),
v AS (
  SELECT r.conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s1,
         {{'c': 3::BIGINT, 'a': 'I', 't': 'user:'}} AS s2, {{'c': 6::BIGINT, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations) r
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {least(here("s3"), inserted("s2", "assistant"))} AS s3 FROM (
    SELECT conv_id, i, s0, s1, {least(here("s2"), inserted("s0", "user"), inserted("s1", "user"), inserted("s3", "user"))} AS s2, s3 FROM (
      SELECT conv_id, i, {reached(0, {}, "")} AS s0, {reached(1, {0: "s"}, "")} AS s1, {reached(2, {0: "u", 1: "u", 3: "u"}, "user")} AS s2, {reached(3, {2: "a"}, "assistant")} AS s3 FROM (
        SELECT v.conv_id, f.rn AS i, s0, s1, s2, s3, role, text, blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS more
        FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.rn = v.i + 1)))),
e AS (SELECT conv_id, max_by({least(here("s0"), here("s3"))}, i) AS best FROM v GROUP BY conv_id),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(best.t) AS repaired_sha256
FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_decontamination": op4_decontamination,
    "op5_token_file": op5_token_file,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_sharding": op8_sharding,
    "op9_lm_score": op9_lm_score,
    "op10_html_extraction": op10_html_extraction,
    "op11_sentence_pieces": op11_sentence_pieces,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_conversation_repair": op13_conversation_repair,
}
SQL = {"op2_mixing": OP2_SQL, "op12_conversation_trie": OP12_SQL, "op13_conversation_repair": _op13_sql()}
