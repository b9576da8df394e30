"""Registered queries of the corpus operators (``opN_<name>``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_tree, decontaminate, importance, line_dedup, mixing, ngram_join, packing, prefix_trie,
               radix_dedup, site_quality, suffix_dedup, token_planes, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MIX_WEIGHTS = [3.0, 1.0, 2.0]
MIX_SHARE = 1.5
MIX_EPOCHS = 2.0


def default_tokenizer() -> str:
    """Path of the byte-level BPE file; every operator takes it as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_mix_sources", r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS src, (source IS NULL)::INT AS none,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (SELECT src, none, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY none, src) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE
             WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
r AS (SELECT *, (source_size * 2)::DOUBLE AS cap, (source_size * 2)::DOUBLE / weight AS ratio FROM w),
l AS (SELECT *, row_number() OVER o AS turn,
        ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM r WINDOW o AS (ORDER BY ratio, none, src)),
p AS (SELECT min(turn) AS turn, min_by(level, turn) AS level FROM l WHERE ratio >= level),
t AS (SELECT l.*, CASE WHEN p.turn IS NULL OR l.turn < p.turn THEN cap ELSE p.level * weight END AS target FROM l, p),
x AS (SELECT d.*, t.source_size, t.target,
        sum(size) OVER (PARTITION BY d.none, d.src ORDER BY key, doc_id) - size AS before,
        floor(target)::BIGINT AS budget
      FROM d JOIN t ON d.src = t.src AND d.none = t.none),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM x)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM e
""")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_radix_dedup", r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""")
def op5_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op6_token_planes")
def op6_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_planes.write_planes(table(spark, sf_dir, "documents"), default_tokenizer())
    return token_planes.digests(token_planes.read_documents(spark, path))


@query("op7_ngram_join")
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op2_template_decontamination")
def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_toxicity_fm")
def op10_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")) \
        .select("doc_id", "held_out", "score", "predicted")


CHAT_PROBE = "\\### Assistant: </turn> ok"


@query("op1_chat_tree", r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (
  SELECT *, 15 + length(role) + len(regexp_extract_all(role, '\\|###|</turn>|:'))
              + length(text) + len(regexp_extract_all(text, '\\|###|</turn>')) AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
""")
def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", CHAT_PROBE), (-7, 1, "assistant", CHAT_PROBE)], convs.schema)
    path = chat_tree.write_tree(convs.unionByName(probe), default_tokenizer())
    return chat_tree.digests(spark, path, default_tokenizer())


@query("op9_site_quality")
def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_fuzzy_lines")
def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_repeats(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_prefix_trie", r"""
WITH RECURSIVE c AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(coalesce(text, '')), role) AS r,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, n, conv_id - conv_id % 5 AS base, list_transform(range(1, len(conv_id::VARCHAR) + 1),
         lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT) AS bytes
  FROM (SELECT DISTINCT conv_id, n FROM c)),
-- crc32: the bits of each byte shifted out under the reversed polynomial
crc(conv_id, bytes, k, x) AS (
  SELECT conv_id, bytes, 0, 4294967295::BIGINT FROM ids
  UNION ALL
  SELECT conv_id, bytes, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(x, bytes[k // 8 + 1]) ELSE x END AS v
        FROM crc WHERE k < 8 * len(bytes))),
h AS (SELECT conv_id, xor(x, 4294967295) % 9 AS h FROM crc WHERE k = 8 * len(bytes)),
p AS (
  SELECT i.conv_id, i.base, h.h, least(h.h, coalesce(b.n, 0)) AS m
  FROM ids i JOIN h USING (conv_id) LEFT JOIN ids b ON b.conv_id = i.base),
t AS (
  SELECT p.conv_id, CASE WHEN p.conv_id = p.base THEN c.r ELSE c.r - p.h + p.m END AS d, c.role, c.text
  FROM p JOIN c USING (conv_id) WHERE p.conv_id = p.base OR c.r > p.h
  UNION ALL
  SELECT p.conv_id, c.r, c.role, c.text FROM p JOIN c ON c.conv_id = p.base
  WHERE p.conv_id <> p.base AND c.r <= p.m),
k AS (
  SELECT conv_id, d, strlen(text) AS b,
         sha256(string_agg(sha256(strlen(role) || ':' || role || text), ',')
                OVER (PARTITION BY conv_id ORDER BY d)) AS key,
         d = max(d) OVER (PARTITION BY conv_id) AS last FROM t
  UNION ALL
  SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM t) FROM p),
n AS (
  SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM k GROUP BY ALL),
up AS (
  SELECT n.*, q.key AS up_key, q.conv_id AS parent_conv_id
  FROM n LEFT JOIN (SELECT k.conv_id, k.d + 1 AS d, k.key, m.conv_id AS owner FROM k JOIN n m USING (d, key)) x
    ON x.conv_id = n.conv_id AND x.d = n.d
  LEFT JOIN n q ON q.key = x.key AND q.d = n.d - 1),
ch AS (SELECT d - 1 AS d, up_key AS key, count(*) AS n_children FROM up WHERE d > 0 GROUP BY ALL),
w AS (SELECT up.*, coalesce(ch.n_children, 0) AS n_children FROM up LEFT JOIN ch USING (d, key)),
s AS (  -- every node beside each of its ancestors and itself, on its smallest member's path
  SELECT k.d, k.key, sum((w.n_convs - 1) * w.b)::BIGINT AS saved_tokens, count(*) FILTER (w.n_children = 0) AS n_leaves
  FROM w JOIN k ON k.conv_id = w.conv_id AND k.d <= w.d GROUP BY ALL)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM w JOIN s USING (d, key)
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.positions(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns))


@query("op12_importance", r"""
WITH RECURSIVE f AS (
  SELECT doc_id, row_number() OVER () AS uid, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT unnest(list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS w FROM benchmark),
o AS (SELECT uid, unnest(w) AS w FROM f),
v AS (SELECT w, list_transform(range(1, strlen(w) + 1),
             lambda i: ('0x' || substr(hex(encode(w)), (2 * i - 1)::INT, 2))::BIGINT) AS bytes
      FROM (SELECT w FROM o UNION SELECT w FROM b)),
crc AS MATERIALIZED (  -- each byte, then eight shifts under the reversed polynomial
  SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda x, y: list_reduce(
           list_concat([xor(x, y)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
           lambda p, q: CASE WHEN p & 1 = 1 THEN xor(p >> 1, 3988292384) ELSE p >> 1 END)), 4294967295) % 10000 AS k FROM v),
s AS (SELECT k, count(*) AS s FROM o JOIN crc USING (w) GROUP BY ALL),
t AS (SELECT k, count(*) AS t FROM b JOIN crc USING (w) GROUP BY ALL),
g AS (
  SELECT i.k, floor(1000.0::DOUBLE * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM o) + 10000)::DOUBLE)
           / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS k) i LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
m AS (SELECT uid, sum(gain) AS gain FROM o JOIN crc USING (w) JOIN g USING (k) GROUP BY ALL),
r AS (
  SELECT doc_id, uid, len(f.w) AS n_features,
         CASE WHEN len(f.w) = 0 THEN 0 ELSE floor(gain::DOUBLE / len(f.w)) END::BIGINT AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM f LEFT JOIN m USING (uid)),
c AS (
  SELECT doc_id, uid, n_features, weight,
         weight + floor(-1000.0::DOUBLE * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM r),
e AS (SELECT uid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, uid) AS rank,
             10 * count(*) OVER () // 100 AS k FROM c WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= k THEN rank END AS rank FROM c LEFT JOIN e USING (uid)
""")
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def word_tokenizer() -> str:
    """Path of the word-level BPE file; the packer takes it as a parameter."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())
    return packing.digests(spark, path)
