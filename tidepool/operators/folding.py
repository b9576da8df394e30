"""W17, G6 for keys of any size: the content of a key in pieces.

``web.ordered_fold`` gives a key's content as one value, which a hot key can
outgrow. Here chunks get their offset in the content by prefix sums over range
partitions, are cut at multiples of the piece size, and meet again piece by
piece; nothing larger than a piece (and a chunk) is ever in one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PIECE = 1 << 20


def chunk_offsets(df: DataFrame, keys: Sequence[str], seq: str, size: Column) -> DataFrame:
    """``df`` with ``_start``: the sizes of the key's chunks before this one.
    A key that holds most chunks is spread over range partitions by ``seq``;
    a partition hands on one sum for each key in it. Equal seqs of a key keep
    the order of ``web.ordered_fold``: by chunk."""
    keys = list(keys)
    d = cut_lineage(df.withColumn("_size", size.cast("long")), "fold-chunks")
    order = [*keys, seq, "_chunk"]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = cut_lineage(d.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("_part", F.spark_partition_id())
                    .withColumn("_row", F.monotonically_increasing_id()), "fold-ranged")
    # null keys are keys as well
    same = [F.struct(F.col(f"`{k}`")).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    d = d.select("*", *same)
    sums = d.groupBy("_part", *names).agg(F.sum("_size").alias("_sum"))
    before = Window.unboundedPreceding, -1
    w = Window.partitionBy(*names).orderBy("_part").rowsBetween(*before)
    bases = sums.select("_part", *names, F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_base"))
    w = Window.partitionBy("_part", *names).orderBy("_row").rowsBetween(*before)
    inner = d.withColumn("_in", F.coalesce(F.sum("_size").over(w), F.lit(0)))
    return (inner.join(bases, ["_part", *names])
            .withColumn("_start", F.col("_base") + F.col("_in")).drop(*names, "_part", "_base", "_in"))


def _leading_tail(b: Column) -> Column:
    """How many of a piece's first three bytes go on with a character that
    the piece before has begun (bytes 80 to BF at its start)."""
    goes_on = [F.hex(F.substring(b, i, 1)).between("80", "BF") for i in (1, 2, 3)]
    n = F.lit(0)
    for k in (3, 2, 1):
        cond = goes_on[0]
        for c in goes_on[1:k]:
            cond = cond & c
        n = F.when(cond, F.lit(k)).otherwise(n) if k == 3 else F.when((n == 0) & cond, F.lit(k)).otherwise(n)
    return n


def ordered_fold_pieces(df: DataFrame, key_cols: Sequence[str], seq_col: str, chunk_col: str,
                        piece: int = PIECE, binary: bool = False, out_col: str = "content") -> DataFrame:
    """Rows (key columns, piece, ``out_col``): the concatenation of a key's
    chunks by ``seq_col`` in pieces numbered from 0, each of ``piece``
    characters but the last.

    With ``binary`` chunks are bytes and pieces are ``piece`` bytes of the UTF-8
    content, where a character belongs to the piece it starts in: the bytes of a
    character cut between two pieces go from the head of the later one to the
    end of the earlier. A key is valid when all its pieces are; the content of
    one that isn't is one empty piece.

    NULL chunks are skipped; a key without other chunks is absent, one with
    empty chunks alone has one empty piece; a NULL key is a key; equal seqs go
    by chunk; no rows give no rows."""
    if piece < 4:
        raise ValueError("a piece holds 4 bytes at least")
    keys = list(key_cols)
    cols = [F.col(f"`{k}`") for k in keys]
    d = df.select(*cols, F.col(f"`{seq_col}`").alias("_seq"), F.col(f"`{chunk_col}`").alias("_chunk")) \
        .where(F.col("_chunk").isNotNull())
    d = cut_lineage(chunk_offsets(d, keys, "_seq", F.length("_chunk")), "fold-offsets")

    # a chunk in the pieces it touches
    first = F.floor(F.col("_start") / piece)
    last = F.floor((F.col("_start") + F.col("_size") - 1) / piece)
    parts = (d.where("_size > 0").withColumn("piece", F.explode(F.sequence(first, last)))
             .withColumn("_from", F.greatest(F.col("piece") * piece, F.col("_start")))
             .withColumn("_to", F.least((F.col("piece") + 1) * piece, F.col("_start") + F.col("_size"))))
    cut = F.substring(F.col("_chunk"), (F.col("_from") - F.col("_start") + 1).cast("int"),
                      (F.col("_to") - F.col("_from")).cast("int"))
    vals = F.transform(F.array_sort(F.collect_list(F.struct("_from", F.col("_cut")))), lambda x: x["_cut"])
    whole = F.unhex(F.array_join(F.transform(vals, lambda x: F.hex(x)), "")) if binary else F.array_join(vals, "")
    pieces = parts.withColumn("_cut", cut).groupBy(*cols, "piece").agg(whole.alias(out_col))
    blank = (d.groupBy(*cols).agg(F.sum("_size").alias("_all")).where("_all = 0")
             .select(*cols, F.lit(0).cast("long").alias("piece"), F.lit("").alias(out_col)))
    if not binary:
        return pieces.unionByName(blank)

    pieces = cut_lineage(pieces.withColumn("_tail", F.when(F.col("piece") > 0, _leading_tail(F.col(out_col)))
                                           .otherwise(0)), "fold-pieces")
    same = [F.struct(c).alias(f"_k{i}") for i, c in enumerate(cols)]  # null keys join
    names = [f"_k{i}" for i in range(len(keys))]
    tails = pieces.where("_tail > 0").select(
        *same, (F.col("piece") - 1).alias("piece"), F.substring(F.col(out_col), F.lit(1), F.col("_tail")).alias("_more"))
    own = F.substring(F.col(out_col), F.col("_tail") + 1, F.lit(piece))
    joined = (pieces.select("*", *same).join(tails, [*names, "piece"], "left")
              .withColumn("_bytes", F.concat(own, F.coalesce(F.col("_more"), F.lit(b"")))))
    text = F.col("_bytes").cast("string")
    joined = cut_lineage(joined.select(*cols, *names, "piece", text.alias(out_col), F.is_valid_utf8(text).alias("_valid")),
                         "fold-texts")
    bad = joined.where(~F.col("_valid")).select(*names).distinct()
    good = joined.join(bad, names, "left_anti").select(*cols, "piece", out_col)
    # the last piece can be nothing but the end of a character
    good = good.where((F.col("piece") == 0) | (F.col(out_col) != ""))
    spoilt = joined.where("piece = 0").join(bad, names, "left_semi").select(
        *cols, "piece", F.lit("").alias(out_col))
    return good.unionByName(spoilt).unionByName(blank)
