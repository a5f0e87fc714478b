"""The registered queries of the corpus operators, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.llm import (bpe, conversation_trie, decontaminate, hard_negatives, jaccard_join, line_dedup, near_vectors, quality, secret_scan,
                        suffix_dedup, token_files, url_filter, warc)
from larder.llm.common import UPPER, LOWER, scratch, table


def op1_jaccard_join(spark, sf):
    """One row per document: class (least id of its component of ties) and number of tied documents."""
    return jaccard_join.jaccard_classes(table(spark, sf, "documents"))


def op2_line_dedup(spark, sf):
    done = line_dedup.drop_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_warc(spark, sf):
    path = scratch(spark, "warc")
    warc.write_archive(table(spark, sf, "pages"), path)
    return warc.read_records(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_suffix_dedup(spark, sf):
    return suffix_dedup.remove_repeats(table(spark, sf, "documents")).drop("kept")


def op5_secret_scan(spark, sf):
    found = secret_scan.scan_documents(spark, table(spark, sf, "documents"), batches=2)
    base = F.filter("findings", lambda s: s["rank"] < len(secret_scan.BASE_RULES))

    def n(kind):
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("findings")).alias("spans"))


def op6_quality_rules(spark, sf):
    return quality.quality_features(table(spark, sf, "documents"))


def op7_token_files(spark, sf):
    path = scratch(spark, "token-files")
    token_files.write_token_files(table(spark, sf, "documents"), path)
    return token_files.read_token_files(spark, path, with_ids=False)


def op8_bpe(spark, sf):
    coded = bpe.bpe_decode(bpe.bpe_encode(table(spark, sf, "documents")))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_decontaminate(spark, sf):
    found = decontaminate.contaminated_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("bigint").alias("n_items"),
                        F.transform("items", lambda x: x["item_id"]).alias("item_ids"))


def op10_url_filter(spark, sf):
    return url_filter.judge_urls(table(spark, sf, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_near_vectors(spark, sf):
    return near_vectors.near_vectors(table(spark, sf, "embeddings"))


def op12_conversation_trie(spark, sf):
    return conversation_trie.conversation_trie(table(spark, sf, "conversations")).drop(*conversation_trie.NODE)


def op13_hard_negatives(spark, sf):
    return hard_negatives.hard_negatives(table(spark, sf, "embeddings"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_jaccard_join, op2_line_dedup, op3_warc, op4_suffix_dedup, op5_secret_scan, op6_quality_rules, op7_token_files,
    op8_bpe, op9_decontaminate, op10_url_filter, op11_near_vectors, op12_conversation_trie, op13_hard_negatives)}

# ---- SQL --------------------------------------------------------------------------------------

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), '{UPPER}', '{LOWER}') AS key FROM lines),
often AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.pos, k.line, o.key IS NOT NULL AND k.doc_id <> o.last_id AS gone
  FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP3_SQL = """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id < max(page_id) OVER same
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id < max(page_id) OVER same
            THEN max(page_id) OVER same END AS refers_to
FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))
"""


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _spans_sql(rank: int, rule: secret_scan.SecretRule) -> str:
    """Matches of one rule with their places, from the pieces between them."""
    p = _sql_text(rule.pattern)
    return f"""
SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, start, start + n AS stop FROM (
  SELECT doc_id, n, g, sum(before + n) OVER (PARTITION BY doc_id ORDER BY k) - n AS start FROM (
    SELECT doc_id, k, length(found[k]) AS n, length(groups[k]) AS g, length(pieces[k]) AS before FROM (
      SELECT doc_id, found, groups, pieces, unnest(range(1, len(found) + 1)) AS k FROM (
        SELECT doc_id, regexp_extract_all(text, {p}) AS found, regexp_extract_all(text, {p}, {rule.group}) AS groups,
               string_split_regex(text, {p}) AS pieces FROM documents WHERE text IS NOT NULL)))) WHERE g >= {rule.least}"""


_RULES = secret_scan.BASE_RULES + secret_scan.MORE_RULES
_JOINED = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
OP5_SQL = f"""
WITH spans AS ({' UNION ALL '.join(_spans_sql(k, r) for k, r in enumerate(_RULES))}),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, {_JOINED} FILTER (rank < {len(secret_scan.BASE_RULES)}) AS base, {_JOINED} AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN told USING (doc_id)
"""

_HOSTS = ", ".join(f"('{r.rule}', '{r.host}', '{r.path}', '{r.verdict}')" for r in url_filter.HOST_RULES)
_BLOCKED = " OR ".join(f"regexp_matches(low, {_sql_text(r.pattern)})" for r in url_filter.PATTERN_RULES)
OP10_SQL = f"""
WITH rules(rule, rule_host, rule_path, rule_verdict) AS (VALUES {_HOSTS}),
parts AS (
  SELECT page_id, coalesce(translate(url, '{UPPER}', '{LOWER}'), '') AS low,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS rule_verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN {_BLOCKED} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN best USING (page_id)
"""

# Cosines of all pairs, components by spreading the least id along links.
OP11_SQL = """
WITH RECURSIVE unit AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS u, vec_id AS w FROM embeddings UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE u = e.vec_id) AS n_links, c.low AS component_id, e.vec_id = c.low AS kept
FROM embeddings e JOIN (SELECT u, min(w) AS low FROM reach GROUP BY u) c ON c.u = e.vec_id
"""

# crc32 by its polynomial, bit by bit; nodes are lists of (role, text); every node adds its values to all its prefixes.
OP12_SQL = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(c::VARCHAR, ''),
           lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns)),
again AS (
  SELECT k.c, 0 AS part, t.place, t.role, t.text FROM crc k JOIN turns t ON t.c = k.c - k.c % 20 AND t.place <= k.h
  UNION ALL SELECT k.c, 1, t.place, t.role, t.text FROM crc k JOIN turns t ON t.c = k.c AND t.place > k.h),
paths AS (
  SELECT k.c, coalesce(list({'role': a.role, 'text': a.text} ORDER BY a.part, a.place) FILTER (a.c IS NOT NULL), []) AS path
  FROM crc k LEFT JOIN again a ON a.c = k.c GROUP BY k.c),
members AS (SELECT c, path, unnest(range(0, len(path) + 1)) AS depth FROM paths),
nodes AS (
  SELECT path[1:depth] AS node, depth, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = len(path)), '')) AS ends_sha256
  FROM members GROUP BY 1, 2),
valued AS (
  SELECT *, node[1:depth - 1] AS up,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(list_filter(regexp_split_to_array(node[depth].text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) END AS own
  FROM nodes),
family AS (SELECT up AS node, count(*) AS n_children FROM valued WHERE depth > 0 GROUP BY 1),
known AS (SELECT v.*, coalesce(f.n_children, 0) AS n_children FROM valued v LEFT JOIN family f ON f.node = v.node),
below AS (SELECT node[1:d] AS node, sum(own) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
          FROM (SELECT node, own, n_children, unnest(range(0, depth + 1)) AS d FROM known) GROUP BY 1)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN below b ON b.node = k.node LEFT JOIN known p ON k.depth > 0 AND p.node = k.up
"""

OP13_SQL = """
WITH rows_ AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows_ a JOIN rows_ b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 100 = 0),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positive p JOIN scored s USING (anchor_id)
  WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

LLM_ORACLES = {"op2_line_dedup": OP2_SQL, "op3_warc": OP3_SQL, "op5_secret_scan": OP5_SQL, "op10_url_filter": OP10_SQL,
               "op11_near_vectors": OP11_SQL, "op12_conversation_trie": OP12_SQL, "op13_hard_negatives": OP13_SQL}
