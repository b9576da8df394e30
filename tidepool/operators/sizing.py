"""Size-checked broadcast.

A side is broadcast only after a job proves it small in rows *and* bytes; beyond either bound the plain frame is returned and Spark shuffles
(sort-merge join, with AQE's skew-join splitting hot partitions).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default bounds for broadcasting a side: small lookup tables, tenant lists,
# parameter sets, per-key change summaries.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

_FIXED = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
          T.DoubleType: 8, T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8,
          T.TimestampNTZType: 8}


def _bytes_expr(col: Column, dtype: T.DataType) -> Column:
    """Payload bytes of one value (variable-width types measured exactly)."""
    for t, n in _FIXED.items():
        if isinstance(dtype, t):
            return F.lit(n)
    if isinstance(dtype, T.DecimalType):
        return F.lit(16)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(dtype, T.StructType):
        parts = [_bytes_expr(col.getField(f.name), f.dataType) for f in dtype.fields]
        return reduce(lambda a, b: a + b, parts, F.lit(0))
    # arrays, maps, variants: their JSON text length is a close upper bound
    return F.coalesce(F.octet_length(F.to_json(col)), F.lit(0))


def row_bytes(df: DataFrame) -> Column:
    fields = df.schema.fields
    if not fields:
        return F.lit(0)
    return reduce(lambda a, b: a + b,
                  [_bytes_expr(F.col(f"`{f.name}`"), f.dataType) for f in fields]).cast("long")


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is within both bounds. One aggregation: each task counts its
    own rows and bytes, and only those two numbers leave it."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return r["n"] <= max_rows and (r["b"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` is within both bounds, else ``df``."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
