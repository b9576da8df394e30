"""Helpers shared by the corpus operators: words, distributed prefix sums and
connected components. Everything here is DataFrame code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_folder, shuffles_dropped

# White space of the word contracts: space, tab, LF, VT, FF, CR.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_array(text: Column) -> Column:
    """Words of a text; an empty array for a null, empty or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), rf"[{SPACE}]+"), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def range_sorted(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, written once with the
    partition number in ``_pid``. ``df`` should be cheap to read twice (a
    written table): Spark samples it for the range bounds. Include a unique
    column in ``keys`` so that equal leading keys can be split."""
    n = partitions(df.sparkSession)
    cols = [F.col(k) for k in keys]
    return cut_lineage(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                       .withColumn("_pid", F.spark_partition_id()), name)


def running_sum(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str,
                out: str, name: str = "running") -> DataFrame:
    """Exclusive running sum of ``value`` within ``groups`` in ``order``.

    Two levels: rows are range-partitioned by (groups, order), each partition
    sums its own rows, and the per-partition totals (a row for each partition
    and group in it) give the base of each partition. A group that holds most
    rows is spread over many partitions. Group columns must not be null.
    """
    groups, order = list(groups), list(order)
    ranged = range_sorted(df, [*groups, *order], name)
    before = Window.unboundedPreceding, -1
    totals = ranged.groupBy("_pid", *groups).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(*before)
    bases = totals.select("_pid", *groups,
                          F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_base"))
    w = Window.partitionBy("_pid", *groups).orderBy(*order).rowsBetween(*before)
    inner = ranged.withColumn("_in", F.coalesce(F.sum(value).over(w), F.lit(0)))
    return (inner.join(bases, ["_pid", *groups])
            .withColumn(out, (F.col("_base") + F.col("_in")).cast("long"))
            .drop("_pid", "_base", "_in"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of the undirected ``edges`` (a, b): component is the
    smallest node reachable. Nodes without an edge to another node are absent.

    Alternates large-star and small-star steps: each replaces a node's edges by
    edges to its smallest neighbour, and the edge count never grows. A step is
    one aggregation (combined before the shuffle) and one join on the node,
    both sides written tables, so that a hub is split by the skew join; each
    step is written, and the loop ends when a round changes nothing.
    """
    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut_lineage(both.groupBy("a").agg(F.min("b").alias("_m"))
                          .withColumn("_m", F.least("_m", "a")), f"{name}-min")
        j = both.join(low, "a")
        if small:
            j = j.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("_m").alias("b")),
                                           F.struct(F.col("a"), F.col("_m").alias("b")))).alias("e")) \
                .select("e.*")
        else:
            j = j.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        return cut_lineage(j.where("a <> b").distinct(), name)

    def state(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = cut_lineage(edges.where("a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    now = state(e)
    while now[0]:
        e = star(star(e, small=False), small=True)
        was, now = now, state(e)
        if was == now:
            break
    ends = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(ends)


def stored(df: DataFrame, name: str, *partition_by: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder with zstandard (for wide or
    large intermediates) and read back. An enclosing ``intermediates`` block
    deletes it with its end; if ``keep``, the next one around it does."""
    path = scratch_folder(df.sparkSession, name, keep)
    w = df.write.option("compression", "zstd")
    with shuffles_dropped(df.sparkSession):
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mixed(x):
    """splitmix64 finaliser over a numpy uint64 array."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that ``df`` doesn't have (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        while w.lower() in taken:
            w = "_" + w
        taken.add(w.lower())
        out.append(w)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` written once with a unique row number; its column's name."""
    uid = free_names(docs, "_uid")[0]
    return stored(docs.withColumn(uid, F.monotonically_increasing_id()), name), uid
