"""Driver queries for table changes and audit history (A6, B1-B9) on
``orders``. Change batches are derived from every ``orders`` row, so the
work grows with the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes as chg
from ..operators.param_batch import Where, param_batch
from ..sources.tables import read_table
from .registry import register

CTX = chg.AuditContext(log_ts="2026-01-01 00:00:00", log_ip="10.0.0.1", host="batch-01")
FILL_VALUE = CTX.log_ip
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority"]
KEY = ["o_orderkey"]


def _slot(cond, seq, op, key=None, status=None, price=None, prio="keep"):
    """One change slot derived from an orders row; NULL when ``cond`` fails."""
    k = F.col("o_orderkey") if key is None else key
    prio_col = F.col("o_orderpriority") if prio == "keep" else F.lit(prio).cast("string")
    row = F.struct(
        seq.cast("long").alias("seq"), F.lit(op).alias("op"),
        k.cast("long").alias("o_orderkey"), F.col("o_custkey"),
        (F.col("o_orderstatus") if status is None else F.lit(status)).alias("o_orderstatus"),
        (F.col("o_totalprice") if price is None else price).cast("double").alias("o_totalprice"),
        F.col("o_orderdate"), prio_col.alias("o_orderpriority"))
    return F.when(cond, row)


def change_feed(orders):
    """Every order yields one to five changes (op chosen by key class)."""
    k = F.col("o_orderkey")
    r = k % 6
    base = k * 8
    new_key = -(k + 1)
    slots = [
        _slot(r == 0, base, "U", status="X", price=F.col("o_totalprice") + 1.0),
        _slot(r == 1, base, "D"),
        _slot(r == 2, base, "M", price=F.col("o_totalprice") * 2, prio=None),
        _slot(r == 3, base, "D"),
        _slot(r == 3, base + 1, "I", status="N", prio=None),
        _slot(r == 3, base + 2, "U", status="Y"),
        _slot(r == 4, base, "I", key=new_key, prio=None),
        _slot(r == 4, base + 1, "M", key=new_key, prio="2-HIGH"),
        _slot(r == 4, base + 2, "U", status="Z"),
        _slot(r == 5, base, "U", key=new_key, status="Q"),
        _slot(r == 5, base + 1, "M", status="M"),
        _slot(r == 5, base + 2, "D"),
        _slot(r == 5, base + 3, "U", status="W"),
        _slot(r == 5, base + 4, "M", prio=None),
        _slot(k % 500 == 7, base + 5, "M", key=F.lit(None), prio=None),
    ]
    return (orders.select(F.explode(F.array(*slots)).alias("c"))
            .where(F.col("c").isNotNull()).select("c.*"))


_FEED_SQL = """
ch AS MATERIALIZED (
  SELECT o_orderkey * 8 + c.d AS seq, c.op, CASE c.k WHEN 'same' THEN o_orderkey WHEN 'new' THEN -(o_orderkey + 1) END AS o_orderkey,
         o_custkey, coalesce(c.status, o_orderstatus) AS o_orderstatus,
         o_totalprice * c.mul + c.plus AS o_totalprice, o_orderdate,
         CASE c.prio WHEN 'keep' THEN o_orderpriority ELSE c.prio END AS o_orderpriority
    FROM orders JOIN (VALUES
      (0, 0, 'U', 'same', 'X', 1.0::DOUBLE, 1.0::DOUBLE, 'keep'), (1, 0, 'D', 'same', NULL, 1.0, 0.0, 'keep'),
      (2, 0, 'M', 'same', NULL, 2.0, 0.0, NULL), (3, 0, 'D', 'same', NULL, 1.0, 0.0, 'keep'),
      (3, 1, 'I', 'same', 'N', 1.0, 0.0, NULL), (3, 2, 'U', 'same', 'Y', 1.0, 0.0, 'keep'),
      (4, 0, 'I', 'new', NULL, 1.0, 0.0, NULL), (4, 1, 'M', 'new', NULL, 1.0, 0.0, '2-HIGH'),
      (4, 2, 'U', 'same', 'Z', 1.0, 0.0, 'keep'), (5, 0, 'U', 'new', 'Q', 1.0, 0.0, 'keep'),
      (5, 1, 'M', 'same', 'M', 1.0, 0.0, 'keep'), (5, 2, 'D', 'same', NULL, 1.0, 0.0, 'keep'),
      (5, 3, 'U', 'same', 'W', 1.0, 0.0, 'keep'), (5, 4, 'M', 'same', NULL, 1.0, 0.0, NULL)
    ) c(r, d, op, k, status, mul, plus, prio) ON o_orderkey % 6 = c.r
  UNION ALL SELECT o_orderkey * 8 + 5, 'M', NULL, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL
    FROM orders WHERE o_orderkey % 500 = 7
),
nn AS MATERIALIZED (SELECT * FROM ch WHERE o_orderkey IS NOT NULL),
own AS (SELECT CAST(-9223372036854775808 AS BIGINT) AS seq, 'T' AS op, o.*
          FROM orders o SEMI JOIN nn ON o.o_orderkey = nn.o_orderkey),
allc AS (SELECT * FROM own UNION ALL SELECT * FROM nn),
s1 AS (SELECT *, last_value(CASE WHEN op IN ('I', 'M', 'D', 'T') THEN op END IGNORE NULLS)
                   OVER (PARTITION BY o_orderkey ORDER BY seq
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_anchor
         FROM allc),
s2 AS (SELECT *, coalesce(prev_anchor IN ('I', 'M', 'T'), false) AS exists_before FROM s1),
s3 AS (SELECT *,
         CASE WHEN op = 'D' THEN false WHEN op = 'U' THEN exists_before ELSE true END AS exists_after,
         CASE WHEN op = 'I' OR (op = 'M' AND NOT exists_before)
              THEN coalesce(o_orderpriority, '10.0.0.1') ELSE o_orderpriority END AS a_prio
         FROM s2)
"""

_APPLY_BASE_SQL = "WITH " + _FEED_SQL + """,
fin AS (SELECT * FROM s3 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, a_prio AS o_orderpriority
  FROM fin WHERE exists_after
UNION ALL
SELECT o.* FROM orders o ANTI JOIN nn ON o.o_orderkey = nn.o_orderkey
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       coalesce(o_orderpriority, '10.0.0.1') FROM ch WHERE o_orderkey IS NULL AND op IN ('I', 'M')
"""

_APPLY_HISTORY_SQL = "WITH " + _FEED_SQL + """,
s4 AS (SELECT *, last_value(CASE WHEN op <> 'D' THEN seq END IGNORE NULLS)
                   OVER (PARTITION BY o_orderkey ORDER BY seq
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_nd
         FROM s3)
SELECT CAST(TIMESTAMP '2026-01-01 00:00:00' AS TIMESTAMP) AS log_date, '10.0.0.1' AS log_ip,
       'batch-01' AS host, CASE WHEN c.op = 'D' THEN 'D' ELSE 'U' END AS type,
       p.o_orderkey, p.o_custkey, p.o_orderstatus, p.o_totalprice, p.o_orderdate,
       p.a_prio AS o_orderpriority
  FROM s4 c JOIN s3 p ON p.o_orderkey = c.o_orderkey AND p.seq = c.prev_nd
 WHERE c.op IN ('U', 'D', 'M') AND c.exists_before
"""


def _apply(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return chg.apply_changes(orders, change_feed(orders), KEY, ctx=CTX,
                             fill_column="o_orderpriority")


@register("apply_changes_base", _APPLY_BASE_SQL)
def apply_changes_base(spark, sf_dir):
    return _apply(spark, sf_dir).base


@register("apply_changes_history", _APPLY_HISTORY_SQL)
def apply_changes_history(spark, sf_dir):
    return _apply(spark, sf_dir).history


@register("apply_changes_summary", "WITH " + _FEED_SQL + """
SELECT op, exists_before, count(*) AS n FROM s3 WHERE op <> 'T' GROUP BY op, exists_before
""")
def apply_changes_summary(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    ann = chg.annotate_changes(orders, change_feed(orders), KEY, ctx=CTX,
                               fill_column="o_orderpriority")
    return (ann.where(F.col("_op") != "T")
            .groupBy(F.col("_op").alias("op"), F.col("_exists_before").alias("exists_before"))
            .agg(F.count(F.lit(1)).alias("n")))


# ----------------------------------------------------------- single-op forms

def _source_rows(orders):
    """One source row per order: existing keys changed (key % 4 < 2), new
    keys (negative) otherwise."""
    k = F.col("o_orderkey")
    return orders.select(
        F.when(k % 4 < 2, k).otherwise(-(k + 1)).alias("o_orderkey"), "o_custkey",
        F.lit("S").alias("o_orderstatus"), (F.col("o_totalprice") + 100.0).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")


_SOURCE_SQL = """
src AS (SELECT CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey ELSE -(o_orderkey + 1) END AS o_orderkey,
               o_custkey, 'S' AS o_orderstatus, o_totalprice + 100.0 AS o_totalprice,
               o_orderdate, o_orderpriority FROM orders)
"""


@register("merge_upsert", "WITH " + _SOURCE_SQL + """
SELECT o.o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
  FROM orders o LEFT JOIN src s ON o.o_orderkey = s.o_orderkey
UNION ALL
SELECT * FROM src WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)
""")
def merge_upsert(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return chg.merge_upsert(orders, _source_rows(orders), KEY)


@register("insert_rows", """
SELECT * FROM orders
UNION ALL
SELECT -(o_orderkey + 1), o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def insert_rows(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    new = orders.select((-(F.col("o_orderkey") + 1)).alias("o_orderkey"), "o_custkey",
                        F.lit("N").alias("o_orderstatus"), "o_totalprice", "o_orderdate",
                        "o_orderpriority")
    return chg.insert_rows(orders, new)


@register("update_by_key", "WITH " + _SOURCE_SQL + """
SELECT o.o_orderkey,
       coalesce(s.o_custkey, o.o_custkey) AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NULL THEN o.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
  FROM orders o LEFT JOIN src s ON o.o_orderkey = s.o_orderkey
""")
def update_by_key(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return chg.update_by_key(orders, _source_rows(orders), KEY)


@register("delete_by_key", "WITH " + _SOURCE_SQL + """
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
""")
def delete_by_key(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return chg.delete_by_key(orders, _source_rows(orders), KEY)


@register("history_schema", """
SELECT CAST(NULL AS TIMESTAMP) AS log_date, CAST(NULL AS VARCHAR) AS log_ip,
       CAST(NULL AS VARCHAR) AS host, CAST(NULL AS VARCHAR) AS type, *
  FROM orders WHERE 1 = 0
""")
def history_schema(spark, sf_dir):
    return chg.history_schema(read_table(spark, sf_dir, "orders"))


@register("insert_default", """
SELECT -(o_orderkey + 1) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       coalesce(CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END, '10.0.0.1')
         AS o_orderpriority
  FROM orders
""")
def insert_default(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    rows = orders.select((-(F.col("o_orderkey") + 1)).alias("o_orderkey"), "o_custkey",
                         "o_orderstatus", "o_totalprice", "o_orderdate",
                         F.when(F.col("o_orderkey") % 2 == 0, F.lit(None).cast("string"))
                         .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return chg.insert_default(rows, "o_orderpriority", FILL_VALUE)


_AUDIT_SQL = "WITH " + _SOURCE_SQL + """
SELECT CAST(TIMESTAMP '2026-01-01 00:00:00' AS TIMESTAMP) AS log_date, '10.0.0.1' AS log_ip,
       'batch-01' AS host, '{t}' AS type, o.*
  FROM orders o WHERE o.o_orderkey IN (SELECT o_orderkey FROM src)
"""


@register("audit_delete", _AUDIT_SQL.format(t="D"))
def audit_delete(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return chg.audit_delete(orders, _source_rows(orders), KEY, CTX)


@register("audit_update", _AUDIT_SQL.format(t="U"))
def audit_update(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return chg.audit_update(orders, _source_rows(orders), KEY, CTX)


def _params(orders):
    """One parameter set per order; seq = key; a fifth of the sets name an
    absent key; two consecutive sets share each key (k div 2 * 2)."""
    k = F.col("o_orderkey")
    key = F.when(k % 5 == 0, -(k + 1)).otherwise(F.floor(k / 2) * 2)
    return orders.select(k.alias("seq"), key.cast("long").alias("o_orderkey"),
                         F.concat(F.lit("B"), (k % 7).cast("string")).alias("o_orderstatus"))


_PARAMS_SQL = """
p AS (SELECT o_orderkey AS seq,
             CASE WHEN o_orderkey % 5 = 0 THEN -(o_orderkey + 1)
                  ELSE CAST(floor(o_orderkey / 2) * 2 AS BIGINT) END AS o_orderkey,
             'B' || CAST(o_orderkey % 7 AS VARCHAR) AS o_orderstatus FROM orders)
"""


@register("param_batch_update", "WITH " + _PARAMS_SQL + """,
last AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1)
SELECT o.o_orderkey, o.o_custkey, coalesce(l.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
       o.o_totalprice, o.o_orderdate, o.o_orderpriority
  FROM orders o LEFT JOIN last l ON o.o_orderkey = l.o_orderkey
""")
def param_batch_update(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    new, _ = chg.param_batch_update(orders, _params(orders), KEY, set_columns=["o_orderstatus"])
    return new


@register("param_batch_update_counts", "WITH " + _PARAMS_SQL + """
SELECT p.seq, CAST(count(o.o_orderkey) AS BIGINT) AS affected
  FROM p LEFT JOIN orders o ON o.o_orderkey = p.o_orderkey GROUP BY p.seq
""")
def param_batch_update_counts(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    _, counts = chg.param_batch_update(orders, _params(orders), KEY, set_columns=["o_orderstatus"])
    return counts


@register("param_batch_delete_counts", "WITH " + _PARAMS_SQL + """,
f AS (SELECT o_orderkey, min(seq) AS first_seq FROM p GROUP BY o_orderkey)
SELECT p.seq, CAST(CASE WHEN p.seq = f.first_seq AND EXISTS
                     (SELECT 1 FROM orders o WHERE o.o_orderkey = p.o_orderkey)
                   THEN 1 ELSE 0 END AS BIGINT) AS affected
  FROM p JOIN f ON p.o_orderkey = f.o_orderkey
""")
def param_batch_delete_counts(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    _, counts = chg.param_batch_update(orders, _params(orders), KEY, delete=True)
    return counts


# ------------------------------------------------- A6, any WHERE in the sets

def _suppliers_sets(spark, sf_dir):
    """A set for each supplier: a price range whose length goes from a point to
    most prices, two statuses, a new status and a lowest date."""
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_acctbal"])
    k = F.col("s_suppkey")
    low = F.lit(1000.0) + (k * 37 % 100) * 4000
    return s.select(
        k.cast("long").alias("seq"), low.alias("low"),
        (low + F.element_at(F.array(*[F.lit(v) for v in (0.0, 900.0, 25_000.0, 300_000.0)]), (k % 4 + 1).cast("int"))).alias("high"),
        F.array(F.element_at(F.array(*[F.lit(v) for v in "OFP"]), (k % 3 + 1).cast("int")),
                F.concat(F.lit("S"), (k % 5).cast("string"))).alias("statuses"),
        F.concat(F.lit("S"), ((k + 2) % 5).cast("string")).alias("status"),
        F.make_date(F.lit(1992) + (k % 6).cast("int"), F.lit(3), F.lit(1)).cast("timestamp_ntz").alias("since"))


_SETS_SQL = """
sets AS (
  SELECT CAST(s_suppkey AS BIGINT) AS seq, low, low + [0.0, 900.0, 25000.0, 300000.0][s_suppkey % 4 + 1] AS high,
         [['O', 'F', 'P'][s_suppkey % 3 + 1], 'S' || s_suppkey % 5] AS statuses, 'S' || (s_suppkey + 2) % 5 AS status,
         CAST(make_date(1992 + s_suppkey % 6, 3, 1) AS TIMESTAMP) AS since
    FROM (SELECT *, 1000.0::DOUBLE + (s_suppkey * 37 % 100) * 4000 AS low FROM supplier)),
numbered AS (SELECT *, row_number() OVER (ORDER BY seq) AS n FROM sets)
"""
# every order's status after each set in turn, with the set that last hit it
_RUN_SQL = "WITH RECURSIVE" + _SETS_SQL + """,
run(o_orderkey, price, status, n, hit) AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus, 0::BIGINT, FALSE FROM orders
  UNION ALL
  SELECT r.o_orderkey, r.price,
         CASE WHEN r.price BETWEEN s.low AND s.high AND list_contains(s.statuses, r.status) THEN s.status ELSE r.status END,
         s.n, r.price BETWEEN s.low AND s.high AND coalesce(list_contains(s.statuses, r.status), FALSE)
    FROM run r JOIN numbered s ON s.n = r.n + 1)
"""
_STATUS_WHERE = Where(within={"o_totalprice": ("low", "high")}, among={"o_orderstatus": "statuses"})


def _status_batch(spark, sf_dir):
    return param_batch(read_table(spark, sf_dir, "orders"), _suppliers_sets(spark, sf_dir), _STATUS_WHERE,
                       set_columns={"o_orderstatus": "status"})


@register("param_where_update", _RUN_SQL + """
SELECT o.o_orderkey, o.o_custkey, r.status AS o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority
  FROM run r JOIN orders o USING (o_orderkey) WHERE r.n = (SELECT count(*) FROM sets)
""")
def param_where_update(spark, sf_dir):
    return _status_batch(spark, sf_dir)[0]


@register("param_where_update_counts", _RUN_SQL + """
SELECT s.seq, count(*) FILTER (r.hit) AS affected FROM numbered s LEFT JOIN run r USING (n) GROUP BY s.seq
""")
def param_where_update_counts(spark, sf_dir):
    return _status_batch(spark, sf_dir)[1]


_DELETE_SQL = "WITH" + _SETS_SQL + """,
hits AS (SELECT o.o_orderkey, min(s.seq) AS seq FROM orders o JOIN sets s
           ON o.o_totalprice BETWEEN s.low AND s.high AND o.o_orderdate >= s.since GROUP BY o.o_orderkey)
"""


def _delete_batch(spark, sf_dir):
    where = Where(within={"o_totalprice": ("low", "high")}, also=lambda p: F.col("o_orderdate") >= p("since"),
                  also_columns=["o_orderdate"])
    return param_batch(read_table(spark, sf_dir, "orders"), _suppliers_sets(spark, sf_dir), where, delete=True)


@register("param_where_delete", _DELETE_SQL + """
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM hits)
""")
def param_where_delete(spark, sf_dir):
    return _delete_batch(spark, sf_dir)[0]


@register("param_where_delete_counts", _DELETE_SQL + """
SELECT s.seq, count(h.o_orderkey) AS affected FROM sets s LEFT JOIN hits h USING (seq) GROUP BY s.seq
""")
def param_where_delete_counts(spark, sf_dir):
    return _delete_batch(spark, sf_dir)[1]


# --------------------------------------------------------- hot key (skew)

def hot_key_feed(orders):
    """Every order yields one change; every third one goes to key 0, so one
    key holds a third of all changes (ops cycle U, M, D). Its seqs are spread
    over 10^15."""
    k = F.col("o_orderkey")
    hot = k % 3 == 0
    op = F.when(hot, F.element_at(F.array(F.lit("U"), F.lit("M"), F.lit("D")),
                                  (F.floor(k / 3) % 3 + 1).cast("int"))).otherwise(F.lit("U"))
    return orders.select(
        (k * 10_000_000_019).alias("seq"), op.alias("op"), F.when(hot, F.lit(0).cast("long")).otherwise(k).alias("o_orderkey"),
        "o_custkey", F.concat(F.lit("h"), (k % 7).cast("string")).alias("o_orderstatus"),
        "o_totalprice", "o_orderdate", "o_orderpriority")


_HOT_CH = """
ch AS (
  SELECT o_orderkey * 10000000019 AS seq,
         CASE WHEN o_orderkey % 3 = 0 THEN ['U', 'M', 'D'][CAST(floor(o_orderkey / 3) % 3 AS INTEGER) + 1]
              ELSE 'U' END AS op,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS BIGINT) ELSE o_orderkey END AS o_orderkey,
         o_custkey, 'h' || CAST(o_orderkey % 7 AS VARCHAR) AS o_orderstatus, o_totalprice,
         o_orderdate, o_orderpriority
    FROM orders
),"""
_HOT_FEED_SQL = _HOT_CH + _FEED_SQL[_FEED_SQL.index("\nnn AS"):]


@register("apply_changes_hot_key_base", "WITH " + _HOT_FEED_SQL + """,
fin AS (SELECT * FROM s3 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, a_prio AS o_orderpriority
  FROM fin WHERE exists_after
UNION ALL
SELECT o.* FROM orders o ANTI JOIN nn ON o.o_orderkey = nn.o_orderkey
""")
def apply_changes_hot_key_base(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return chg.apply_changes(orders, hot_key_feed(orders), KEY, ctx=CTX,
                             fill_column="o_orderpriority").base


@register("apply_changes_hot_key_history", "WITH " + _HOT_FEED_SQL + """,
s4 AS (SELECT *, last_value(CASE WHEN op <> 'D' THEN seq END IGNORE NULLS)
                   OVER (PARTITION BY o_orderkey ORDER BY seq
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_nd
         FROM s3)
SELECT CAST(TIMESTAMP '2026-01-01 00:00:00' AS TIMESTAMP) AS log_date, '10.0.0.1' AS log_ip,
       'batch-01' AS host, CASE WHEN c.op = 'D' THEN 'D' ELSE 'U' END AS type,
       p.o_orderkey, p.o_custkey, p.o_orderstatus, p.o_totalprice, p.o_orderdate,
       p.a_prio AS o_orderpriority
  FROM s4 c JOIN s3 p ON p.o_orderkey = c.o_orderkey AND p.seq = c.prev_nd
 WHERE c.op IN ('U', 'D', 'M') AND c.exists_before
""")
def apply_changes_hot_key_history(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return chg.apply_changes(orders, hot_key_feed(orders), KEY, ctx=CTX,
                             fill_column="o_orderpriority").history
