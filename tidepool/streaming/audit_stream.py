"""B10, versioned form: keyed changes with audit history as a stream, for small
tables that readers want as one folder. ``audit_log`` has the form that scales.

Each micro-batch of change rows is applied with ``apply_changes`` to the
newest complete table version; the result is written as version folder
``<table_root>/v=<batch_id>`` and the history rows as
``<history_root>/batch_id=<batch_id>``. Both writes overwrite their own
folder, so a micro-batch replayed after a failure (same ``batch_id``)
produces the same files: the sink is idempotent and the query's
checkpoint gives exactly-once batches. A version counts as complete when
its ``_SUCCESS`` marker exists; history is written before the table so a
complete version implies its history is there.

Folders are listed with the Hadoop FileSystem of the session, so the roots
may be on any shared storage the cluster mounts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.changes import AuditContext, apply_changes, history_schema
from ..session import delete_paths, intermediates

VERSION_PREFIX = "v="


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def complete_folders(spark: SparkSession, root: str, prefix: str) -> list[int]:
    """Numbers N of the folders ``<prefix>N`` under ``root`` that have a
    ``_SUCCESS`` marker, ascending."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    jvm = spark.sparkContext._jvm
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[len(prefix):]))
    return sorted(out)


def complete_versions(spark: SparkSession, table_root: str) -> list[int]:
    """Version numbers under ``table_root`` that have a ``_SUCCESS`` marker."""
    return complete_folders(spark, table_root, VERSION_PREFIX)


def version_path(table_root: str, version: int) -> str:
    return f"{table_root.rstrip('/')}/{VERSION_PREFIX}{version}"


def read_latest(spark: SparkSession, table_root: str, schema: T.StructType,
                before: int | None = None) -> DataFrame | None:
    """Newest complete version (optionally older than ``before``)."""
    vs = [v for v in complete_versions(spark, table_root) if before is None or v < before]
    if not vs:
        return None
    return spark.read.schema(schema).parquet(version_path(table_root, vs[-1]))


@dataclass
class AuditStreamJob:
    """Configuration of one audit stream."""

    table_root: str
    history_root: str
    keys: list[str]
    schema: T.StructType              # schema of the table (without op/seq)
    initial: DataFrame | None = None  # table before the first batch (default: empty)
    op: str = "op"
    seq: str = "seq"
    ctx: AuditContext = AuditContext()
    fill_column: str | None = None
    # keep this many newest versions (None: all). At least 2 are kept: a
    # replay of the newest batch reads the version before it.
    retain_versions: int | None = None

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = read_latest(spark, self.table_root, self.schema, before=batch_id)
        if prev is None:
            prev = self.initial if self.initial is not None else spark.createDataFrame([], self.schema)
        with intermediates(spark):  # the batch's change states go once both outputs are written
            res = apply_changes(prev, batch, self.keys, op=self.op, seq=self.seq, ctx=self.ctx,
                                fill_column=self.fill_column)
            (res.history.write.mode("overwrite")
             .parquet(f"{self.history_root.rstrip('/')}/batch_id={batch_id}"))
            res.base.write.mode("overwrite").parquet(version_path(self.table_root, batch_id))
        if self.retain_versions:
            old = complete_versions(spark, self.table_root)[:-max(2, self.retain_versions)]
            delete_paths(spark, [version_path(self.table_root, v) for v in old if v < batch_id])

    def start(self, changes_stream: DataFrame, checkpoint_location: str, available_now: bool = True):
        w = (changes_stream.writeStream.foreachBatch(self.apply_batch)
             .option("checkpointLocation", checkpoint_location))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
        return w.start()

    def table(self, spark: SparkSession) -> DataFrame:
        latest = read_latest(spark, self.table_root, self.schema)
        if latest is not None:
            return latest
        return self.initial if self.initial is not None else spark.createDataFrame([], self.schema)

    def history(self, spark: SparkSession) -> DataFrame:
        fs, root = _fs(spark, self.history_root)
        if not fs.exists(root):
            return history_schema(spark.createDataFrame([], self.schema))
        h = spark.read.parquet(self.history_root)
        return h.drop("batch_id")
