"""Order as data (P11, C3, C4): a column with each row's place in a global order.

A parquet table doesn't keep the order of its rows, and a global sort puts
equal keys into one task; a position column survives both. Rows are
range-partitioned and sorted; a row's place is its number in its partition plus
the rows of the partitions before it, of which there are only as many as
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

_LOCAL_BITS = 33  # fixed value: low bits of monotonically_increasing_id that count rows


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return not isinstance(t, (T.MapType, T.VariantType))


def with_position(df: DataFrame, order_by: Sequence[str | Column], out: str = "position",
                  base: int = 0) -> DataFrame:
    """``df`` with column ``out``: the place of each row (``base`` on, without
    gaps) in the order ``order_by`` (names, or columns such as
    ``F.col("x").desc_nulls_last()``). Rows equal there are placed by their
    other columns, so the result doesn't depend on the input's partitions;
    rows equal in all columns take any of their places, and are spread over
    tasks by a row number. NULLs come first, as in Spark's ascending order.
    An empty frame stays empty; ``out`` must be a new name."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out!r} exists")
    keys = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]
    ties = [F.col(f"`{f.name}`") for f in df.schema.fields
            if f.name not in order_by_names(order_by) and _orderable(f.dataType)]
    names = [f"`{c}`" for c in df.columns]
    numbered = cut_lineage(df.withColumn("_tidepool_row", F.monotonically_increasing_id()), "position-rows")
    order = [*keys, *ties, F.col("_tidepool_row")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(numbered.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("_tidepool_row", F.monotonically_increasing_id()), "position-ranged")
    part = F.shiftright("_tidepool_row", _LOCAL_BITS)
    local = F.col("_tidepool_row").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = ranged.groupBy(part.alias("_tidepool_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row a partition at most: this window and the broadcast are bounded by ``n``
    before = Window.orderBy("_tidepool_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_tidepool_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (ranged.join(F.broadcast(bases), part == F.col("_tidepool_part"))
            .select(*names, (F.col("_base") + local + F.lit(base)).cast("long").alias(out)))


def order_by_names(order_by: Sequence[str | Column]) -> set[str]:
    return {c for c in order_by if isinstance(c, str)}
