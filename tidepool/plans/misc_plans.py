"""Driver queries for scoring (G1-G3), the audit stream (B10) and scalar
functions (F4-F13)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import scoring as SC
from ..operators.changes import AuditContext
from ..session import scratch_path
from ..sources.tables import read_table
from ..streaming.audit_log import AuditLogJob
from .registry import register

# ------------------------------------------------------------------ G1-G3

_SCORES_SQL = """(VALUES (0, 0, 0), (0, 1, 1), (0, 2, -1), (1, 0, -1), (1, 1, 0), (1, 2, 1),
                         (2, 0, 1), (2, 1, -1), (2, 2, 0)) s(p1, p2, score)"""
_PLAYS_SQL = """(SELECT event_id, event_id // 100 AS round, CAST(user_id % 2 AS INTEGER) AS p1,
                        CAST(event_id % 3 AS INTEGER) AS p2 FROM events)"""


def _plays(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", ["event_id", "user_id"])
    return e.select("event_id", F.floor(F.col("event_id") / 100).cast("long").alias("round"),
                    (F.col("user_id") % 2).cast("int").alias("p1"),
                    (F.col("event_id") % 3).cast("int").alias("p2"))


@register("outcome_score", f"""
SELECT p.event_id, p.round, p.p1, p.p2, s.score FROM {_PLAYS_SQL} p
LEFT JOIN {_SCORES_SQL} ON s.p1 = p.p1 AND s.p2 = p.p2
""")
def outcome_score(spark, sf_dir):
    return SC.outcome_score(_plays(spark, sf_dir)).select("event_id", "round", "p1", "p2", "score")


_SHARES_SQL = f"""
SELECT p.round,
       round(count(*) FILTER (WHERE s.score = -1) / count(*), 6) AS first_share,
       round(count(*) FILTER (WHERE s.score = 1) / count(*), 6) AS second_share,
       round(count(*) FILTER (WHERE s.score = 0) / count(*), 6) AS draw_share,
       count(*) AS plays
FROM {_PLAYS_SQL} p LEFT JOIN {_SCORES_SQL} ON s.p1 = p.p1 AND s.p2 = p.p2
GROUP BY p.round
"""


@register("round_shares", _SHARES_SQL)
def round_shares(spark, sf_dir):
    sh = SC.round_shares(SC.outcome_score(_plays(spark, sf_dir)))
    return sh.select("round", *[F.round(c, 6).alias(c) for c in
                                ("first_share", "second_share", "draw_share")], "plays")


@register("round_winners", f"""
SELECT count(*) FILTER (WHERE first_share > second_share) AS first_wins,
       count(*) FILTER (WHERE first_share < second_share) AS second_wins,
       count(*) AS rounds
FROM ({_SHARES_SQL})
""")
def round_winners(spark, sf_dir):
    return SC.round_winners(SC.round_shares(SC.outcome_score(_plays(spark, sf_dir))))


# ----------------------------------------------------------------------- B10

_STREAM_CTX = AuditContext(log_ts="2026-01-02 00:00:00", log_ip="10.0.0.2", host="stream-01")
_STREAM_BATCHES = 4


def _run_audit_stream(spark, sf_dir, keyed: bool = False):
    """``events`` as a change feed (op M, key user_id, seq event_id) that
    arrives in 4 parts, each a micro-batch of the same query. ``keyed``: with a
    compaction after every second batch."""
    events = read_table(spark, sf_dir, "events")
    run = scratch_path(spark, f"audit-stream-{uuid.uuid4().hex}")
    bounds = events.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    lo, hi = int(bounds["lo"] or 0), int(bounds["hi"] or 0)
    step = (hi - lo) // _STREAM_BATCHES + 1
    feed = events.select(F.col("event_id").alias("seq"), F.lit("M").alias("op"), *events.columns)
    job = AuditLogJob(root=f"{run}/log", keys=["user_id"], schema=events.schema, ctx=_STREAM_CTX,
                      compact_every=2 if keyed else 16)
    for b in range(_STREAM_BATCHES):
        part = feed.where((F.col("seq") >= lo + b * step) & (F.col("seq") < lo + (b + 1) * step))
        part.write.mode("overwrite").parquet(f"{run}/feed/{b:05d}")
        stream = (spark.readStream.schema(feed.schema).option("recursiveFileLookup", "true")
                  .parquet(f"{run}/feed"))
        q = job.start(stream, checkpoint_location=f"{run}/checkpoint")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return job


@register("audit_stream", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
""")
def audit_stream(spark, sf_dir):
    return _run_audit_stream(spark, sf_dir).table(spark)


@register("audit_stream_history", """
SELECT CAST(TIMESTAMP '2026-01-02 00:00:00' AS TIMESTAMP) AS log_date, '10.0.0.2' AS log_ip,
       'stream-01' AS host, 'U' AS type, p.event_id, p.ts, p.user_id, p.event_type, p.value, p.props
FROM (SELECT *, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS next_id FROM events) p
WHERE p.next_id IS NOT NULL
""")
def audit_stream_history(spark, sf_dir):
    return _run_audit_stream(spark, sf_dir).history(spark).select("log_date", "log_ip", "host", "type",
                                     *read_table(spark, sf_dir, "events").columns)


@register("audit_stream_keyed", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
""")
def audit_stream_keyed(spark, sf_dir):
    return _run_audit_stream(spark, sf_dir, keyed=True).table(spark)


@register("audit_stream_keyed_history", """
SELECT CAST(TIMESTAMP '2026-01-02 00:00:00' AS TIMESTAMP) AS log_date, '10.0.0.2' AS log_ip,
       'stream-01' AS host, 'U' AS type, p.event_id, p.ts, p.user_id, p.event_type, p.value, p.props
FROM (SELECT *, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS next_id FROM events) p
WHERE p.next_id IS NOT NULL
""")
def audit_stream_keyed_history(spark, sf_dir):
    return _run_audit_stream(spark, sf_dir, keyed=True).history(spark).select(
        "log_date", "log_ip", "host", "type", *read_table(spark, sf_dir, "events").columns)


# ------------------------------------------------------------------ F4-F13

@register("split_trim", """
SELECT doc_id, CAST(len(items) AS INTEGER) AS n_items, items[1] AS first_item, items[len(items)] AS last_item
FROM (SELECT doc_id, list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')) AS items FROM documents)
""")
def split_trim(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    items = TX.split_trim(F.col("text"), ",")
    return d.select("doc_id", items.alias("items")).select(
        "doc_id", F.size("items").alias("n_items"), F.element_at("items", 1).alias("first_item"),
        F.element_at("items", -1).alias("last_item"))


@register("template_replace", """
SELECT c_custkey,
       replace('SELECT * FROM {USER_NAME}.orders WHERE k = {K}', '{USER_NAME}', c_name) AS plain,
       regexp_replace('shard_{N}_{M}', '\\{[^}]*\\}', CAST(c_nationkey AS VARCHAR), 'g') AS by_regex
FROM customer
""")
def template_replace(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    return c.select(
        "c_custkey",
        TX.template_replace(F.lit("SELECT * FROM {USER_NAME}.orders WHERE k = {K}"), "{USER_NAME}",
                            F.col("c_name")).alias("plain"),
        TX.template_replace_regex(F.lit("shard_{N}_{M}"), r"\{[^}]*\}",
                                  F.col("c_nationkey").cast("string")).alias("by_regex"))


@register("text_keys", """
SELECT p_partkey, substr(p_name, 1, 3) AS prefix3, substr(p_name, 4, 1) AS char4,
       regexp_replace(p_name || '.v' || p_size || '.jpg', '\\.[^./]*$', '') AS no_ext,
       printf('%05d', p_partkey) AS padded, right('000' || p_size, 3) AS last3,
       contains(lower(p_name), 'ring') AS has_ring, starts_with(p_type, 'SMALL') AS small,
       coalesce(nullif(p_brand, 'Brand#1'), p_type) AS first_present
FROM part
""")
def text_keys(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    file_name = F.concat(F.col("p_name"), F.lit(".v"), F.col("p_size").cast("string"), F.lit(".jpg"))
    return p.select(
        "p_partkey", TX.prefix("p_name", 3).alias("prefix3"), TX.char_at("p_name", 3).alias("char4"),
        TX.strip_extension(file_name).alias("no_ext"), TX.zero_pad("p_partkey", 5).alias("padded"),
        TX.take_right(F.col("p_size").cast("string"), 3, "000").alias("last3"),
        TX.contains_ci("p_name", "ring").alias("has_ring"),
        F.col("p_type").startswith("SMALL").alias("small"),
        TX.first_present(F.nullif(F.col("p_brand"), F.lit("Brand#1")), "p_type").alias("first_present"))


@register("zip_minus", """
SELECT p_partkey, CAST(least(len(a), len(b)) AS INTEGER) AS n_pairs, a[1] || '/' || b[1] AS first_pair,
       array_to_string(list_filter(a, lambda x, i: NOT list_contains(b, x) AND list_position(a, x) = i), ',') AS minus
FROM (SELECT p_partkey, string_split(p_name, ' ') AS a, string_split(p_type || ' ring', ' ') AS b FROM part)
""")
def zip_minus(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type"])
    a, b = F.split("p_name", " "), F.split(F.concat(F.col("p_type"), F.lit(" ring")), " ")
    z = TX.zip_shorter(a, b)
    return p.select("p_partkey", z.alias("z"), TX.list_minus(a, b).alias("m")).select(
        "p_partkey", F.size("z").alias("n_pairs"),
        F.concat(F.col("z")[0]["a"], F.lit("/"), F.col("z")[0]["b"]).alias("first_pair"),
        F.array_join("m", ",").alias("minus"))
