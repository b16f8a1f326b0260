"""The subpackage's queries over the supplied tables, and their DuckDB SQL.

Each query applies its operator to the whole of its table.  Operators whose
result SQL cannot express (hashes, learned models, graph search) have no SQL
here and are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skuflow.llm import (mixing, prefixtrie, quality, repair, secretscan, sharding, simhash, templates,
                         tokencount, toxicity, urlrules, vectors, warc)
from skuflow.session import scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc_transactions(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.capture_pages(warc.assemble(warc.read_warc(spark, path, blocks=False)))


@query
def op2_feistel_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


@query
def op3_wordpiece_counts(spark, sf_dir, vocabulary: str = VOCABULARY):
    pieces = tokencount.read_ranked_vocabulary(vocabulary)
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokencount.Automaton(pieces))


@query
def op4_pruned_graph(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_bradley_terry(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.rank_documents(docs, table(spark, sf_dir, "labels"))


@query
def op6_url_rules(spark, sf_dir):
    return urlrules.filter_urls(table(spark, sf_dir, "pages"))


@query
def op7_template_windows(spark, sf_dir):
    found = templates.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


@query
def op8_toxicity_chain(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_chain(docs, table(spark, sf_dir, "labels")))


@query
def op9_splitting_tree(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "shards")


@query
def op10_simhash_anchors(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query
def op11_lightest_repair(spark, sf_dir):
    return repair.repaired_digests(repair.damaged(table(spark, sf_dir, "conversations")))


@query
def op12_assignment_secrets(spark, sf_dir):
    return secretscan.scan_documents(table(spark, sf_dir, "documents"))


@query
def op13_burst_trie(spark, sf_dir):
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


ORACLE: dict[str, str] = {}

ORACLE["op1_warc_transactions"] = """
WITH sized AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (
  SELECT page_id, url, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM sized),
firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM hashed WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
       coalesce(url, '') AS target_uri
FROM hashed LEFT JOIN firsts USING (payload_digest)"""

_SPAM_CASE = "\n".join(
    f"      WHEN regexp_matches(host, '(^|[.-]){w}([.-]|$)') THEN '{w}'"
    for w in sorted(urlrules.SPAM_WORDS, key=lambda w: (-len(w), w)))

ORACLE["op6_url_rules"] = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
named AS (
  SELECT page_id, host, path,
    CASE
      WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    END AS rule,
    CASE
{_SPAM_CASE}
    END AS word
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
            WHEN rule IS NOT NULL OR word IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN word END AS word_rule
FROM named"""

# CRC-32, bit by bit, as DuckDB has no function for it.
_CRC32 = """xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)),
        lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)),
          lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""

ORACLE["op13_burst_trie"] = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
taken AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT taken.conv_id, o.place, o.role, o.text FROM taken JOIN own o ON o.conv_id = base AND o.place <= h
  UNION ALL
  SELECT taken.conv_id, o.place + 100, o.role, o.text FROM taken JOIN own o ON o.conv_id = taken.conv_id AND o.place > h),
rebuilt AS (
  SELECT taken.conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY place) FILTER (place IS NOT NULL), []) AS turns
  FROM taken LEFT JOIN turns USING (conv_id) GROUP BY taken.conv_id),
prefixes AS (
  SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt),
member AS (
  SELECT conv_id, depth, len(turns) = depth AS ends, list_slice(turns, 1, depth) AS prefix FROM prefixes),
node AS (
  SELECT prefix, depth, min(conv_id) AS id, count(*) AS n_convs,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(prefix[depth].t)) END AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY prefix, depth),
named AS (SELECT m.conv_id, m.depth, n.id FROM member m JOIN node n USING (prefix, depth)),
below AS (
  SELECT DISTINCT up.id AS id, up.depth AS depth, down.id AS down_id, down.depth AS down_depth
  FROM named up JOIN named down ON up.conv_id = down.conv_id AND up.depth <= down.depth),
children AS (
  SELECT id, depth, count(*) AS n FROM below WHERE down_depth = depth + 1 GROUP BY id, depth),
total AS (
  SELECT b.id, b.depth, count(*) FILTER (c.n IS NULL) AS n_leaves, sum(n.saved) AS saved
  FROM below b JOIN node n ON n.id = b.down_id AND n.depth = b.down_depth
  LEFT JOIN children c ON c.id = b.down_id AND c.depth = b.down_depth GROUP BY b.id, b.depth)
SELECT node.id AS conv_id, CAST(node.depth AS BIGINT) AS depth,
       CASE WHEN node.depth > 0 THEN (SELECT id FROM below u WHERE u.down_id = node.id AND u.down_depth = node.depth
                                      AND u.depth = node.depth - 1) END AS parent_conv_id,
       node.n_convs, coalesce(c.n, 0) AS n_children, t.n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN total t ON t.id = node.id AND t.depth = node.depth
LEFT JOIN children c ON c.id = node.id AND c.depth = node.depth"""

ORACLE["op11_lightest_repair"] = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC32.format("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role) AS place,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN bare = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id),
step(p, r, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
gap(p, q, cost, letters, roles) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
         (0, 2, 5, 'I', ['u']), (1, 2, 5, 'I', ['u']), (3, 2, 5, 'I', ['u']), (2, 3, 5, 'I', ['a']),
         (0, 3, 10, 'II', ['u', 'a']), (1, 3, 10, 'II', ['u', 'a'])),
edit AS (
  SELECT f.conv_id, f.place, s.p, s.p AS q, 2 AS cost, 'D' AS letter, NULL AS line
  FROM faulty f, (SELECT DISTINCT q AS p FROM gap) s
  UNION ALL
  SELECT f.conv_id, f.place, s.p, s.q, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', f.role || ':' || f.text
  FROM faulty f JOIN step s ON s.r = f.initial WHERE fault IN ('sound', 'truncated')
  UNION ALL
  SELECT f.conv_id, f.place, s.p, s.q, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R',
         CASE s.r WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text
  FROM faulty f JOIN step s ON s.r IN ('u', 'a') WHERE fault IN ('sound', 'truncated')),
best AS (
  SELECT conv_id, 0 AS place, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM counted
  UNION ALL
  SELECT conv_id, place, q, w.cost, w.audit, w.lines FROM (
    SELECT b.conv_id, e.place, e.q, min({{'cost': b.cost + g.cost + e.cost, 'audit': b.audit || g.letters || e.letter,
           'lines': b.lines || list_transform(g.roles, lambda r: CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
                    || CASE WHEN e.line IS NULL THEN []::VARCHAR[] ELSE [e.line] END}}) AS w
    FROM best b JOIN gap g ON g.p = b.q
    JOIN edit e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.place = b.place + 1 AND e.p = g.q
    GROUP BY b.conv_id, e.place, e.q)),
finished AS (
  SELECT b.conv_id, min({{'cost': b.cost + g.cost, 'audit': b.audit || g.letters,
         'lines': b.lines || list_transform(g.roles, lambda r: CASE r WHEN 'u' THEN 'user:' ELSE 'assistant:' END)}}) AS w
  FROM best b JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND b.place = c.n
  JOIN gap g ON g.p = b.q AND g.q IN (0, 3) GROUP BY b.conv_id)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
       CAST(coalesce(f.w.cost, 0) AS BIGINT) AS cost, coalesce(f.w.audit, '') AS audit,
       sha256(coalesce(array_to_string(f.w.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN finished f ON f.conv_id IS NOT DISTINCT FROM o.conv_id"""
