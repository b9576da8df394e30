"""Parameterised and bounded reads (A1-A5, A7), shard and tenant unions
(C2, C3), key joins (C1, C4, C5) and the missing-file report (C6)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import strip_scheme
from .sizing import broadcast_if_small

# Fixed values that must equal the reference's behaviour:
# row limit of an eager read, and the separator of several values of one
# parameter.
EAGER_ROW_LIMIT = 100_000
PARAM_SEPARATOR = "|"


class RowLimitExceeded(RuntimeError):
    pass


# --------------------------------------------------------------------- A1-A2

def param_query(spark: SparkSession, sql: str, args: dict | None = None,
                defaults: dict | None = None, lists: Sequence[str] = (), **frames: DataFrame) -> DataFrame:
    """A1: SQL with named ``:name`` markers, bound by Spark's own parser.

    Markers inside literals and comments are left alone by the parser. A
    marker with no value raises ``UNBOUND_SQL_PARAMETER`` unless ``defaults``
    supplies one. ``frames`` are referenced in the SQL as ``{name}``. A marker
    named in ``lists`` stands for several values separated by ``|``: each
    ``IN (:name)`` gets a marker for each of them (none: it matches nothing),
    and anywhere else ``:name`` is an array.
    """
    bound = dict(defaults or {})
    bound.update(args or {})
    for name in lists:
        values = split_param(bound.pop(name))
        each = {f"{name}_{i}": v for i, v in enumerate(values)}
        marks = ", ".join(f":{k}" for k in each) or "NULL"
        sql = re.sub(rf"(?i)\bin\s*\(\s*:{re.escape(name)}\s*\)", f"IN ({marks})", sql)
        bound.update(each)
        bound[name] = F.array(*[F.lit(v) for v in values]).cast("array<string>") if not values else \
            F.array(*[F.lit(v) for v in values])
    return spark.sql(sql, args=bound, **frames)


def split_param(value) -> list[str]:
    """Several values of one parameter, separated by ``|``.

    ``""`` is one empty value; trailing empty items are dropped, so ``"|"``
    is no value at all and ``"F|P||"`` is ``F, P``.
    """
    text = "" if value is None else str(value)
    if text == "":
        return [""]
    parts = text.split(PARAM_SEPARATOR)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def param_in_list(df: DataFrame, column: str, value, max_inline: int = 1000) -> DataFrame:
    """A2: ``column IN (:p)`` where ``:p`` carries several ``|``-separated values.

    Short lists become an ``In`` predicate (pushed to the parquet scan);
    long ones a broadcast left-semi join against a values frame (the list
    size is the parameter's size, so it is bounded by the caller).
    """
    values = split_param(value)
    if not values:
        return df.where(F.lit(False))
    if len(values) <= max_inline:
        return df.where(F.col(column).isin(values))
    spark = df.sparkSession
    vals = spark.createDataFrame([(v,) for v in values], T.StructType(
        [T.StructField("_v", T.StringType())])).distinct()
    return df.join(F.broadcast(vals), F.col(column) == F.col("_v"), "left_semi")


# --------------------------------------------------------------------- A3-A5

def bounded_read(df: DataFrame, limit: int = EAGER_ROW_LIMIT) -> DataFrame:
    """A3: fail when the result has more than ``limit`` rows (exactly
    ``limit`` passes); never truncates. The check stops after ``limit + 1``."""
    n = df.limit(limit + 1).count()
    if n > limit:
        raise RowLimitExceeded(f"result has more than {limit} rows")
    return df


def _check_unique_names(df: DataFrame) -> None:
    names = [c.lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate column names: {df.columns}")


def stringify_rows(df: DataFrame) -> DataFrame:
    """A4: every column as a string, NULL as ``""`` (eager read's view)."""
    _check_unique_names(df)
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c)
                       for c in df.columns])


def iterate_rows(df: DataFrame) -> DataFrame:
    """A5: every column as a string, NULL kept (lazy read's view)."""
    _check_unique_names(df)
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def local_rows(df: DataFrame) -> Iterator[dict]:
    """A5 at the edge: pull rows lazily, one partition at a time."""
    for row in iterate_rows(df).toLocalIterator(prefetchPartitions=True):
        yield row.asDict()


# ------------------------------------------------------------------------ A7

def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the declared key that break it (duplicates or NULLs).

    One aggregation with map-side partial counts, so a hot key collapses to
    one row per map task before the shuffle.
    """
    if not keys:
        raise ValueError("empty key")
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where((F.col("n_rows") > 1) | any_null))


# ------------------------------------------------------------------------ C2

def sequence_years(start: int, end: int) -> list[int]:
    """The start year always, then start+1..end (empty tail when end < start)."""
    return [int(start)] + list(range(int(start) + 1, int(end) + 1))


def _typed_literal(df: DataFrame, column: str, text: str) -> Column:
    dtype = df.schema[column].dataType
    return F.lit(text).cast(dtype)


def union_sequence(df: DataFrame, ts_column: str, start: int, end: int,
                   predicate: Column | None = None, with_source: bool = False,
                   source_name: str = "shard_year") -> DataFrame:
    """C2 with the year shard as a column: one scan, one range predicate.

    ``year(ts) in years`` is rewritten as ``ts >= Jan 1 of first year and
    ts < Jan 1 after the last`` so parquet row groups are skipped by their
    min/max statistics (the filter shows in ``PushedFilters``).
    """
    years = sequence_years(start, end)
    lo, hi = min(years), max(years) + 1
    cond = ((F.col(ts_column) >= _typed_literal(df, ts_column, f"{lo:04d}-01-01"))
            & (F.col(ts_column) < _typed_literal(df, ts_column, f"{hi:04d}-01-01")))
    out = df.where(cond)
    if predicate is not None:
        out = out.where(predicate)
    if with_source:
        out = out.withColumn(source_name, F.year(ts_column))
    return out


def union_sequence_frames(make_shard: Callable[[int], DataFrame], start: int, end: int,
                          with_source: bool = False,
                          source_name: str = "shard_year") -> DataFrame:
    """C2 with one table per year: ``UNION ALL`` of ``make_shard(year)``."""
    frames = []
    for y in sequence_years(start, end):
        f = make_shard(y)
        frames.append(f.withColumn(source_name, F.lit(y)) if with_source else f)
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_sequence_sql(spark: SparkSession, template: str, pattern: str,
                       start: int, end: int, **frames: DataFrame) -> DataFrame:
    """C2 as text: the regex ``pattern`` in ``template`` is replaced by each
    year, each instance run by Spark, the results unioned."""
    rx = re.compile(pattern)
    return union_sequence_frames(
        lambda y: spark.sql(rx.sub(str(y), template), **frames), start, end)


def read_shards(spark: SparkSession, template: str, placeholder: str, names: Sequence,
                source_name: str | None = None) -> DataFrame:
    """Shards stored as folders (``template`` with ``placeholder`` replaced by
    each name): one ``spark.read.parquet(*paths)`` scan (one scan operator,
    filters pushed to all files) instead of a union of per-shard scans.
    With ``source_name`` the shard name is recovered from each row's file
    path (``_metadata.file_path``)."""
    names = [str(n) for n in names]
    paths = [template.replace(placeholder, n) for n in names]
    df = spark.read.parquet(*paths)
    if source_name:
        head, tail = template.split(placeholder, 1)
        pattern = "(" + "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True)) + ")"
        marker = re.escape(head.split("/")[-1]) + pattern + re.escape(tail.split("/")[0])
        df = df.withColumn(source_name, F.regexp_extract(F.col("_metadata.file_path"), marker, 1))
    return df


def union_sequence_paths(spark: SparkSession, template: str, placeholder: str, start: int,
                         end: int, with_source: bool = False,
                         source_name: str = "shard_year") -> DataFrame:
    """C2 with one folder per year, read as one scan."""
    years = sequence_years(start, end)
    df = read_shards(spark, template, placeholder, years, source_name if with_source else None)
    return df.withColumn(source_name, F.col(source_name).cast("int")) if with_source else df


# ------------------------------------------------------------------------ P8

def param_rows(spark: SparkSession, schema: T.StructType | str, rows: Sequence[dict]) -> DataFrame:
    """Bound values as rows of a frame, a source like any other (the caller's
    list bounds its size). A column left out is NULL; a name that ``schema``
    hasn't raises; no rows give an empty frame of ``schema``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    unknown = {k for r in rows for k in r} - set(names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


# ------------------------------------------------------------------------ C3

def tenant_list(tenants: DataFrame, name_col: str, exclude_suffix: str | None = None,
                exclude_names: Iterable[str] = ()) -> DataFrame:
    """Tenants kept by ``NOT LIKE '%suffix'`` and ``NOT IN (names)``; NULL
    names drop out as in SQL."""
    out = tenants.select(F.col(name_col).alias("tenant"))
    if exclude_suffix:
        out = out.where(~F.col("tenant").endswith(exclude_suffix))
    names = list(exclude_names)
    if names:
        out = out.where(~F.col("tenant").isin(names))
    return out.where(F.col("tenant").isNotNull()).distinct()


def union_tenants(data: DataFrame, tenant_col: str, tenants: DataFrame,
                  with_source: bool = False, source_name: str = "tenant") -> DataFrame:
    """C3 with the tenant as a column: keep rows of listed tenants.

    ``tenants`` has one column ``tenant`` (see ``tenant_list``). The list is
    broadcast only when its row count is under the bound.
    """
    t = broadcast_if_small(tenants.select("tenant").distinct())
    out = data.join(t, F.col(tenant_col) == F.col("tenant"), "left_semi")
    if with_source:
        out = out.withColumn(source_name, F.col(tenant_col))
    return out


def union_tenant_frames(make_frame: Callable[[str], DataFrame], tenants: Sequence[str],
                        with_source: bool = False, source_name: str = "tenant",
                        schema: T.StructType | None = None,
                        spark: SparkSession | None = None) -> DataFrame:
    """C3 with one schema/path per tenant: ``UNION ALL`` in tenant order.
    No tenants gives an empty frame of ``schema``."""
    frames = []
    for t in tenants:
        f = make_frame(t)
        frames.append(f.withColumn(source_name, F.lit(t)) if with_source else f)
    if not frames:
        if schema is None or spark is None:
            raise ValueError("no tenants: pass schema and spark for the empty result")
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), frames)


# ------------------------------------------------------------------- C1, C4, C5

def star_join(master: DataFrame, subs: dict[str, DataFrame], keys: Sequence[str],
              outer: bool = True, master_alias: str = "A") -> DataFrame:
    """One master, each sub joined on the same key list; left outer when
    ``outer`` else inner. Pairs are master-sub only; an alias equal to the
    master's is skipped. Sub columns other than the keys are prefixed
    ``<alias>_``.

    Keys are trimmed names (``"k1, k2"`` is accepted). When master and subs
    are already hash-partitioned on the keys (aggregates on the same keys),
    Spark joins them without another shuffle.
    """
    if isinstance(keys, str):
        keys = [k.strip() for k in keys.split(",")]
    keys = [k.strip() for k in keys]
    how = "left" if outer else "inner"
    out = master
    for alias, sub in subs.items():
        if alias == master_alias:
            continue
        renamed = sub.select(*[F.col(f"`{c}`") if c in keys else
                               F.col(f"`{c}`").alias(f"{alias}_{c}") for c in sub.columns])
        out = out.join(renamed, on=list(keys), how=how)
    return out


def key_equi_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  where: Column | None = None, select: Sequence | None = None,
                  order_by: Sequence | None = None) -> DataFrame:
    """C4: multi-key equi join plus literal filters, projected and ordered."""
    out = left.join(right, on=list(keys), how="inner")
    if where is not None:
        out = out.where(where)
    if select:
        out = out.select(*select)
    if order_by:
        out = out.orderBy(*order_by)
    return out


def distinct_related(left: DataFrame, left_key: str, right: DataFrame, right_key: str,
                     right_filter: Column | None = None) -> DataFrame:
    """DISTINCT left keys having a related right row that passes a filter.

    The right side is reduced to its distinct keys first (partial aggregation
    collapses hot keys map-side), then a left-semi join.
    """
    r = right if right_filter is None else right.where(right_filter)
    r_keys = r.select(F.col(right_key).alias("_rk")).distinct()
    return (left.select(left_key).join(r_keys, F.col(left_key) == F.col("_rk"), "left_semi")
            .distinct())


# ------------------------------------------------------------------------ C6

def expected_image_path(key: Column, root: str, ext: str = ".jpg") -> Column:
    """``<root>/<first 3 chars of key>/<key><ext>``."""
    k = key.cast("string")
    return F.concat(F.lit(root.rstrip("/") + "/"), F.substring(k, 1, 3), F.lit("/"), k, F.lit(ext))


def missing_file_report(keys: DataFrame, key_col: str, listing: DataFrame, root: str,
                        ext: str = ".jpg", path_col: str = "path") -> DataFrame:
    """Distinct keys whose expected file is not in ``listing``."""
    expected = (keys.select(F.col(key_col).alias("key")).distinct()
                .withColumn("expected_path", expected_image_path(F.col("key"), root, ext)))
    present = listing.select(strip_scheme(F.col(path_col)).alias("expected_path"))
    return expected.join(present, "expected_path", "left_anti").select("key", "expected_path")
