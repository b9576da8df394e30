"""Driver queries for the query surface: A1-A5, A7, C1-C6."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import query as q
from ..operators.sizing import broadcast_if_small
from ..sources.tables import read_table
from .registry import register


def _exact_money_sum(col: str):
    """Sum of 2-decimal amounts as decimals (exact, independent of the order
    partial sums are combined in), returned as double."""
    return F.sum(F.col(col).cast("decimal(15,2)")).cast("double")


@register("union_sequence", """
SELECT * FROM orders
WHERE year(o_orderdate) BETWEEN 1995 AND 2001
  AND o_orderstatus NOT IN ('F', 'P')
  AND o_orderpriority <> '5-LOW'
""")
def union_sequence(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    pred = (~F.col("o_orderstatus").isin("F", "P")) & (F.col("o_orderpriority") != "5-LOW")
    return q.union_sequence(orders, "o_orderdate", 1995, 2001, predicate=pred)


@register("union_sequence_by_year", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS shard_year, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(15, 2))) AS DOUBLE) AS total_price
FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 2000
  AND o_orderstatus NOT IN ('F')
  AND o_orderpriority <> '1-URGENT'
GROUP BY 1
""")
def union_sequence_by_year(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    pred = (~F.col("o_orderstatus").isin("F")) & (F.col("o_orderpriority") != "1-URGENT")
    u = q.union_sequence(orders, "o_orderdate", 1996, 2000, predicate=pred, with_source=True)
    return (u.groupBy("shard_year")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 _exact_money_sum("o_totalprice").alias("total_price")))


@register("param_query", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 1000.0
""")
def param_query(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return q.param_query(
        spark,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} "
        "WHERE o_orderpriority = :prio AND o_totalprice > :min_price -- :ignored",
        args={"prio": "1-URGENT", "min_price": 1000.0}, orders=orders)


@register("param_query_lists", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('1-URGENT') AND o_orderstatus <> 'O'
""")
def param_query_lists(spark, sf_dir):
    """Parameters with several ``|``-separated values inside SQL text."""
    return q.param_query(
        spark,
        "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM {orders} WHERE o_orderstatus IN (:status) "
        "AND o_orderpriority NOT IN ( :prio ) AND NOT array_contains(:drop, o_orderstatus)",
        args={"status": "F|P||", "prio": "1-URGENT", "drop": "O|"}, lists=("status", "prio", "drop"),
        orders=read_table(spark, sf_dir, "orders"))


@register("param_in_list", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')
""")
def param_in_list(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return q.param_in_list(orders, "o_orderstatus", "F|P||").select("o_orderkey", "o_orderstatus")


@register("bounded_read", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1
""")
def bounded_read(spark, sf_dir):
    """A result whose size doesn't grow with the table, read within the limit."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_totalprice"])
    return q.bounded_read(orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")), limit=1000)


_STRINGIFY_SQL = """
SELECT {f}(CAST(c.c_custkey AS VARCHAR){z}) AS c_custkey,
       {f}(CAST(c.c_name AS VARCHAR){z}) AS c_name,
       {f}(CAST(c.c_acctbal AS VARCHAR){z}) AS c_acctbal,
       {f}(CAST(n.n_name AS VARCHAR){z}) AS n_name,
       {f}(CAST(n.n_regionkey AS VARCHAR){z}) AS n_regionkey
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 0) n
  ON c.c_nationkey = n.n_nationkey
"""


def _customer_left_nation(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 0)
    return (c.join(broadcast_if_small(n), c.c_nationkey == n.n_nationkey, "left")
            .select("c_custkey", "c_name", "c_acctbal", "n_name", "n_regionkey"))


@register("stringify_rows", _STRINGIFY_SQL.format(f="COALESCE", z=", ''"))
def stringify_rows(spark, sf_dir):
    return q.stringify_rows(_customer_left_nation(spark, sf_dir))


@register("iterate_rows", _STRINGIFY_SQL.format(f="", z=""))
def iterate_rows(spark, sf_dir):
    return q.iterate_rows(_customer_left_nation(spark, sf_dir))


@register("key_check", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
""")
def key_check(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return q.key_check(li, ["l_orderkey", "l_linenumber"])


@register("star_join", """
WITH a AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS qty, count(*) AS n_lines
           FROM lineitem GROUP BY 1, 2),
     b AS (SELECT l_orderkey, l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(15, 2))) AS DOUBLE) AS rev
           FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
     c AS (SELECT l_orderkey, l_partkey, max(l_discount) AS max_disc
           FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
SELECT a.l_orderkey, a.l_partkey, a.qty, a.n_lines, b.rev AS B_rev, c.max_disc AS C_max_disc
FROM a LEFT JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey
       LEFT JOIN c ON a.l_orderkey = c.l_orderkey AND a.l_partkey = c.l_partkey
""")
def star_join(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    keys = "l_orderkey, l_partkey"
    k = ["l_orderkey", "l_partkey"]
    master = li.groupBy(*k).agg(F.sum("l_quantity").alias("qty"),
                                F.count(F.lit(1)).alias("n_lines"))
    b = (li.where(F.col("l_returnflag") == "R").groupBy(*k)
         .agg(_exact_money_sum("l_extendedprice").alias("rev")))
    c = (li.where(F.col("l_linestatus") == "O").groupBy(*k)
         .agg(F.max("l_discount").alias("max_disc")))
    return q.star_join(master, {"A": li, "B": b, "C": c}, keys, outer=True)


@register("star_join_inner", """
WITH a AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
     b AS (SELECT l_orderkey, l_partkey, count(*) AS n_r
           FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT a.l_orderkey, a.l_partkey, a.qty, b.n_r AS B_n_r
FROM a JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey
""")
def star_join_inner(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    k = ["l_orderkey", "l_partkey"]
    master = li.groupBy(*k).agg(F.sum("l_quantity").alias("qty"))
    b = (li.where(F.col("l_returnflag") == "R").groupBy(*k)
         .agg(F.count(F.lit(1)).alias("n_r")))
    return q.star_join(master, {"B": b}, k, outer=False)


@register("key_equi_join", """
SELECT a.l_orderkey, a.l_linenumber, a.l_returnflag, b.n_flag_lines
FROM lineitem a
JOIN (SELECT l_orderkey, l_returnflag, count(*) AS n_flag_lines
      FROM lineitem GROUP BY 1, 2) b
  ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = b.l_returnflag
WHERE b.l_returnflag = 'R' AND a.l_linestatus = 'F'
ORDER BY a.l_orderkey, a.l_linenumber
""")
def key_equi_join(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    b = li.groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n_flag_lines"))
    return q.key_equi_join(
        li, b, ["l_orderkey", "l_returnflag"],
        where=(F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"),
        select=["l_orderkey", "l_linenumber", "l_returnflag", "n_flag_lines"],
        order_by=["l_orderkey", "l_linenumber"])


@register("distinct_related", """
SELECT DISTINCT c_custkey FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
""")
def distinct_related(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    o = read_table(spark, sf_dir, "orders")
    return q.distinct_related(c, "c_custkey", o, "o_custkey", F.col("o_orderstatus") == "F")


@register("union_tenants", """
SELECT n.n_name AS tenant, c.c_custkey, c.c_name, c.c_acctbal
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name NOT LIKE '%1' AND n.n_name NOT IN ('NATION_0', 'NATION_5')
  AND c.c_acctbal > 0
""")
def union_tenants(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    n = read_table(spark, sf_dir, "nation")
    data = c.join(broadcast_if_small(n.select("n_nationkey", "n_name")),
                  c.c_nationkey == n.n_nationkey)
    tenants = q.tenant_list(n, "n_name", exclude_suffix="1",
                            exclude_names=["NATION_0", "NATION_5"])
    out = q.union_tenants(data, "n_name", tenants, with_source=True)
    return out.select("tenant", "c_custkey", "c_name", "c_acctbal")


_PHOTO_KEY = "concat(replace(p_brand, 'Brand#', 'B'), '-', CAST(p_partkey AS VARCHAR))"


@register("missing_file_report", f"""
WITH keys AS (SELECT DISTINCT {_PHOTO_KEY} AS key FROM part),
     listing AS (SELECT '/photos/' || substr({_PHOTO_KEY}, 1, 3) || '/' || {_PHOTO_KEY} || '.jpg' AS path
                 FROM part WHERE p_size <= 25)
SELECT key, '/photos/' || substr(key, 1, 3) || '/' || key || '.jpg' AS expected_path
FROM keys
WHERE NOT EXISTS (SELECT 1 FROM listing
                  WHERE listing.path = '/photos/' || substr(key, 1, 3) || '/' || key || '.jpg')
""")
def missing_file_report(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    keyed = part.select(F.expr(_PHOTO_KEY.replace("VARCHAR", "STRING")).alias("key"), "p_size")
    listing = (keyed.where(F.col("p_size") <= 25)
               .select(F.concat(F.lit("file:///photos/"), F.substring("key", 1, 3), F.lit("/"),
                                F.col("key"), F.lit(".jpg")).alias("path")))
    return q.missing_file_report(keyed, "key", listing, "/photos")
