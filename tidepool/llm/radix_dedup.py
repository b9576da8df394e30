"""Exact deduplication by most-significant-digit radix partitioning.

Documents are split by successive runs of bytes of their normalised text
(digits of ``FIRST_DIGIT`` bytes, then ``GROWTH`` times longer each round).
A group is named by its smallest row. A round counts the rows of each
(group, digit), combined before the shuffle, and joins the groups of two or
more rows back; a row alone in its group is done, and so is a row whose text
ended in this digit: its group is its class of equal texts. Only open rows
with the bytes that are left go to the next round, so equality is decided on
the bytes themselves, without a digest. A group that holds a third of all rows
is split by Spark's skew join, as both sides of the join are written tables. The
join is a merge join at any size, so the texts are shuffled once, and after the
first round only those of rows that share their first bytes.

Defined cases: a null text counts as empty; empty texts are one group; a null
``doc_id`` sorts after every other; of rows with equal doc_id and text one row
stays; an empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stored

FIRST_DIGIT = 64
GROWTH = 8


def squeeze(text: Column) -> Column:
    """The text with each run of white space as one space; null: empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{SPACE}]+", " ")


def radix_groups(rows: DataFrame, first_digit: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """``rows`` (uid, bytes and columns to carry) without the bytes, with
    ``rep``, the smallest uid of the rows with the same bytes, and ``n``, their
    number. ``rows`` must be a written table; uid is a unique long."""
    carried = [c for c in rows.columns if c not in ("uid", "bytes")]
    active = rows.withColumn("grp", F.lit(0).cast("long"))
    done: list[DataFrame] = []
    width = first_digit
    while True:
        keyed = active.withColumn("digit", F.substring("bytes", 1, width))
        groups = stored(keyed.groupBy("grp", "digit")
                        .agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("rep")).where("n > 1"),
                        "radix-groups")
        # a digit shorter than the width: the text has ended
        more = F.col("n").isNotNull() & (F.length("digit") == width)
        found = stored(
            keyed.join(groups.hint("merge"), ["grp", "digit"], "left")
            .select("uid", *carried, F.coalesce("n", F.lit(1)).cast("long").alias("n"),
                    F.coalesce("rep", "uid").alias("rep"),
                    F.when(more, F.substring("bytes", width + 1, 2**31 - 1)).alias("bytes")), "radix")
        done.append(found.where("bytes is null").drop("bytes"))
        active = found.where("bytes is not null").withColumn("grp", F.col("rep")).drop("rep", "n")
        if active.isEmpty():
            return reduce(DataFrame.unionByName, done)
        width = min(width * growth, 1 << 20)


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                normalise=squeeze) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of
    the normalised text in UTF-8). The row with the smallest doc_id stays."""
    norm = F.encode(normalise(F.col(f"`{text}`")), "UTF-8")
    rows = stored(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(f"`{doc_id}`").alias("id"),
        norm.alias("bytes")).withColumn("sha", F.unhex(F.sha2("bytes", 256))), "radix-rows")
    groups = radix_groups(rows)
    me = F.struct(F.col("id").isNull().alias("no_id"), "id", "uid")
    first = stored(groups.where("n > 1").groupBy("rep").agg(F.min(me).alias("first")), "radix-first")
    return (groups.join(first.hint("merge"), "rep", "left")
            .select(F.col("id").alias("doc_id"),
                    F.when(F.col("n") > 1, F.col("first.id")).otherwise(F.col("id")).alias("keep_id"),
                    F.col("n").alias("group_size"),
                    ((F.col("n") == 1) | (F.col("first.uid") == F.col("uid"))).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))
