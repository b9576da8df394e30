"""Table, JDBC and file-listing sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet table; listing the needed columns keeps ReadSchema narrow
    (Catalyst prunes anyway, this just documents intent)."""
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def jdbc_read(spark: SparkSession, url: str, table: str, *,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              options: dict | None = None) -> DataFrame:
    """Read a relational table or ``(subquery) alias`` through JDBC.

    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    range queries in parallel instead of one cursor on one thread.
    Credentials come only from the caller's ``options``.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs bounds and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def list_files(spark: SparkSession, root: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """File listing ``(path, length, modification_time)``.

    Uses the ``binaryFile`` source with the ``content`` column pruned, so no
    file body is read; the listing itself is distributed by Spark.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (reader.load(root)
            .select(F.col("path"), F.col("length"),
                    F.col("modificationTime").alias("modification_time")))


def strip_scheme(path_col) -> "F.Column":
    """The path without scheme and authority: ``file:/a/b``, ``file:///a/b`` and
    ``hdfs://host:1/a/b`` all give ``/a/b``."""
    return F.regexp_replace(path_col, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "")


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int,
                   mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as a catalog table bucketed and sorted by ``keys``.

    Joins and aggregations on ``keys`` (e.g. a large change batch applied to
    it) then read the table already hash-partitioned: only the other side is
    shuffled to the bucket layout.
    """
    (df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .saveAsTable(table))
    return df.sparkSession.table(table)
