"""Driver queries for order as data (P11, C3, C4), folds in pieces (W17, G6),
the written history table (B5, P6, P7), parameter rows (P8) and the job's clock
(P9, F14)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import changes as chg
from ..operators import folding, ordering
from ..operators import query as q
from ..operators.sizing import broadcast_if_small
from ..session import scratch_path
from ..sources.tables import read_table
from .registry import register

# ------------------------------------------------------------------ P11, C3, C4


@register("key_equi_join_position", """
SELECT a.l_orderkey, a.l_linenumber, a.l_returnflag, b.n_flag_lines,
       row_number() OVER (ORDER BY a.l_orderkey, a.l_linenumber, a.l_returnflag, b.n_flag_lines) - 1 AS position
FROM lineitem a
JOIN (SELECT l_orderkey, l_returnflag, count(*) AS n_flag_lines
      FROM lineitem GROUP BY 1, 2) b
  ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = b.l_returnflag
WHERE b.l_returnflag = 'R' AND a.l_linestatus = 'F'
""")
def key_equi_join_position(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])
    b = li.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n_flag_lines"))
    rows = q.key_equi_join(li, b, ["l_orderkey", "l_returnflag"],
                           where=(F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
                           select=["l_orderkey", "l_linenumber", "l_returnflag", "n_flag_lines"])
    return ordering.with_position(rows, ["l_orderkey", "l_linenumber"])


@register("union_tenants_position", """
SELECT n.n_name AS tenant, c.c_custkey, c.c_name, c.c_acctbal,
       row_number() OVER (ORDER BY n.n_name DESC, c.c_acctbal, c.c_custkey) - 1 AS position
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name NOT LIKE '%1' AND n.n_name NOT IN ('NATION_0', 'NATION_5')
  AND c.c_acctbal > 0
""")
def union_tenants_position(spark, sf_dir):
    """Tenants in descending order, each tenant's rows by balance."""
    c = read_table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    n = read_table(spark, sf_dir, "nation")
    data = c.join(broadcast_if_small(n.select("n_nationkey", "n_name")), c.c_nationkey == n.n_nationkey)
    tenants = q.tenant_list(n, "n_name", exclude_suffix="1", exclude_names=["NATION_0", "NATION_5"])
    out = q.union_tenants(data, "n_name", tenants, with_source=True)
    return ordering.with_position(out.select("tenant", "c_custkey", "c_name", "c_acctbal"),
                                  [F.col("tenant").desc(), "c_acctbal"])


# ----------------------------------------------------------------------- W17, G6

FOLD_PIECE = 64

_FOLD_SQL = """
WITH f AS (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS content FROM conversations
           WHERE text IS NOT NULL GROUP BY conv_id)"""


@register("ordered_fold_pieces", _FOLD_SQL + f""",
p AS (SELECT *, unnest(range(0, greatest(1, (length(content) + {FOLD_PIECE - 1}) // {FOLD_PIECE}))) AS piece FROM f)
SELECT conv_id, piece, substr(content, piece * {FOLD_PIECE} + 1, {FOLD_PIECE}) AS content FROM p
""")
def ordered_fold_pieces(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    return folding.ordered_fold_pieces(c, ["conv_id"], "turn", "text", piece=FOLD_PIECE)


# a character belongs to the piece that its first byte is in
@register("ordered_fold_bytes_pieces", _FOLD_SQL + f""",
c AS (SELECT conv_id, unnest(range(1, length(content) + 1)) AS i, content FROM f WHERE content <> ''),
s AS (SELECT conv_id, i, substr(content, i, 1) AS ch FROM c),
o AS (SELECT conv_id, i, ch, sum(strlen(ch)) OVER (PARTITION BY conv_id ORDER BY i) - strlen(ch) AS pos FROM s)
SELECT conv_id, CAST(pos // {FOLD_PIECE} AS BIGINT) AS piece, string_agg(ch, '' ORDER BY i) AS content
FROM o GROUP BY ALL
UNION ALL SELECT conv_id, 0, '' FROM f WHERE content = ''
""")
def ordered_fold_bytes_pieces(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    b = c.select("conv_id", "turn", F.encode("text", "UTF-8").alias("chunk"))
    return folding.ordered_fold_pieces(b, ["conv_id"], "turn", "chunk", piece=FOLD_PIECE, binary=True)


# ------------------------------------------------------------------- B5, P6, P7

@register("history_table", """
SELECT CAST(TIMESTAMP '2026-01-01 00:00:00' AS TIMESTAMP) AS log_date, '10.0.0.1' AS log_ip,
       'batch-01' AS host, t.type, o.*
FROM orders o JOIN (VALUES (0, 'D'), (1, 'U')) t(part, type) ON o.o_orderkey % 3 = t.part
""")
def history_table(spark, sf_dir):
    """A history table made empty under its schema, filled by two appends, and
    read back under the schema it was made with."""
    orders = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, f"history-table-{uuid.uuid4().hex}")
    empty = chg.history_schema(orders)
    empty.write.parquet(path)
    ctx = chg.AuditContext(log_ts="2026-01-01 00:00:00", log_ip="10.0.0.1", host="batch-01")
    for part, kind in ((0, "D"), (1, "U")):
        images = orders.where(F.col("o_orderkey") % 3 == part)
        rows = images.select(ctx.ts_col().alias("log_date"), ctx.ip_col().alias("log_ip"),
                             ctx.host_col().alias("host"), F.lit(kind).alias("type"), *orders.columns)
        chg.append_history(rows, path, empty.schema)
    return spark.read.schema(empty.schema).parquet(path)


# ------------------------------------------------------------------ P8, P9, F14

@register("param_rows_insert", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority
FROM orders
UNION ALL
SELECT b.top + v.k, v.cust, v.status, v.price, CAST(NULL AS TIMESTAMP), v.prio
FROM (SELECT max(o_orderkey) AS top FROM orders) b,
     (VALUES (1, 7, 'N', 12.5::DOUBLE, '1-URGENT'), (2, 8, NULL, 0.0::DOUBLE, 'it''s')) v(k, cust, status, price, prio)
""")
def param_rows_insert(spark, sf_dir):
    """Two rows of bound values appended to ``orders`` with keys after its own."""
    orders = read_table(spark, sf_dir, "orders")
    top = int(orders.agg(F.max("o_orderkey")).first()[0] or 0)
    rows = q.param_rows(spark, orders.schema, [
        {"o_orderkey": top + 1, "o_custkey": 7, "o_orderstatus": "N", "o_totalprice": 12.5, "o_orderpriority": "1-URGENT"},
        {"o_orderkey": top + 2, "o_custkey": 8, "o_totalprice": 0.0, "o_orderpriority": "it's"}])
    return chg.insert_rows(orders, rows)


@register("job_clock", """
SELECT o_orderstatus, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_clocks, TRUE AS in_bounds
FROM orders GROUP BY o_orderstatus
""")
def job_clock(spark, sf_dir):
    """Audit rows of every order, written by two jobs with one pinned clock:
    all rows have one time, and it lies within the job's bounds."""
    orders = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, f"job-clock-{uuid.uuid4().hex}")
    lo = chg.AuditContext().pinned(spark).log_ts
    ctx = chg.AuditContext(log_ip="10.0.0.1").pinned(spark)
    for part in (0, 1):  # two jobs, each with its own query time
        rows = orders.where(F.col("o_orderkey") % 2 == part)
        rows.select(ctx.ts_col().alias("log_date"), "o_orderstatus").write.mode("append").parquet(path)
    hi = chg.AuditContext().pinned(spark).log_ts
    h = spark.read.parquet(path)
    clocks = h.select("log_date").distinct().agg(F.count(F.lit(1)).alias("n_clocks"))
    n = int(clocks.first()["n_clocks"])
    at = [F.lit(str(t)).cast("timestamp_ntz") for t in (lo, hi)]
    return h.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"), F.lit(n).cast("long").alias("n_clocks"),
                                          F.min(F.col("log_date").between(*at)).alias("in_bounds"))
