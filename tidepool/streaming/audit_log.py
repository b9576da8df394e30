"""B10, append-only form: keyed changes with audit history as a stream.

Each micro-batch looks up the images of the keys that it touches, applies its
changes to those rows alone with ``apply_changes``, and appends two folders:
its history rows, and one image row for each touched key (``_exists`` false
after a delete). No table is rewritten; the current table is the last image of
each key. Batches come one after another and seqs order the changes within
one, so a seq that arrives late takes effect when it arrives.

Images lie in ``buckets`` buckets by a hash of the key, each a folder of its own
inside a batch's folder. A batch opens the buckets of its keys only: each one's last
compacted level and the images written to it since. Every ``compact_every`` batches
the buckets written to since their last compaction (those alone) get a new level, so
a bucket has at most ``compact_every`` image folders above its level. The table
before the first batch is the first level. Choose ``buckets`` so that a bucket's rows
are a task's work (some 100,000 rows): what a batch reads depends on how many buckets it touches, not on
the table.

All writes overwrite their own folder, so a replayed batch (same ``batch_id``)
gives the same files; a folder counts once its ``_SUCCESS`` marker is there, history
before images. NULL keys never match: I and M insert such rows, U and D do
nothing. All of it is JVM work on the table's own types.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import AuditContext, apply_changes, history_schema
from ..operators.sizing import broadcast_if_small
from ..session import cut_lineage, intermediates
from .audit_stream import complete_folders

_BUCKET = "_bucket"


@dataclass
class AuditLogJob:
    """Configuration of one append-only audit stream."""

    root: str                         # images, compacted images and history go below it
    keys: list[str]
    schema: T.StructType              # schema of the table (without op/seq)
    initial: DataFrame | None = None  # table before the first batch (default: empty)
    op: str = "op"
    seq: str = "seq"
    ctx: AuditContext = AuditContext()
    fill_column: str | None = None
    compact_every: int = 16
    buckets: int = 16

    def _path(self, kind: str, batch_id: int | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{kind}"
        return base if batch_id is None else f"{base}/b={batch_id}"

    def _buckets_in(self, spark: SparkSession, kind: str, batch_id: int) -> set[int]:
        """Buckets that a written folder has."""
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._path(kind, batch_id))
        names = [st.getPath().getName() for st in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
        return {int(n[len(_BUCKET) + 1:]) for n in names if n.startswith(f"{_BUCKET}=")}

    def _write(self, images: DataFrame, kind: str, batch_id: int) -> None:
        # rows without a key share a bucket, so they are dealt by their values
        deal = F.when(self._no_key(), F.pmod(F.xxhash64(*images.columns), F.lit(self.buckets))).otherwise(F.lit(0))
        (images.withColumn(_BUCKET, self._bucket()).repartition(self.buckets, _BUCKET, deal)
         .write.mode("overwrite").partitionBy(_BUCKET).parquet(self._path(kind, batch_id)))

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _start(self, spark: SparkSession) -> None:
        """The table before the first batch becomes the first level, once."""
        if self.initial is not None and not complete_folders(spark, self._path("compact"), "b="):
            self._write(self.initial.select(F.lit(True).alias("_exists"), F.lit(-1).cast("long").alias("_batch"),
                                            *self.schema.fieldNames()), "compact", -1)

    def _paths(self, spark: SparkSession, before: int | None, wanted: set[int] | None) -> dict[int, list[str]]:
        """For each bucket (of ``wanted``) its folders: the last level before
        batch ``before``, and the images above it."""
        def folders(kind):
            return [b for b in complete_folders(spark, self._path(kind), "b=") if before is None or b < before]

        images, levels = folders("images"), folders("compact")
        wanted, level, out = set(range(self.buckets)) if wanted is None else wanted, {}, {}
        for b in reversed(levels):
            if len(level) == len(wanted):
                break
            level.update({k: b for k in self._buckets_in(spark, "compact", b) & wanted if k not in level})
        lowest = min(level.get(k, -2) for k in wanted) if wanted else 0
        for k, b in level.items():
            out[k] = [f"{self._path('compact', b)}/{_BUCKET}={k}"]
        for b in images:
            if b > lowest:
                for k in self._buckets_in(spark, "images", b) & wanted:
                    if b > level.get(k, -2):
                        out.setdefault(k, []).append(f"{self._path('images', b)}/{_BUCKET}={k}")
        return out

    def _images(self, spark: SparkSession, before: int | None, wanted: set[int] | None = None) -> DataFrame:
        """Image rows (_exists, _batch, columns) of batches before ``before``,
        of the buckets ``wanted``."""
        self._start(spark)
        schema = T.StructType([T.StructField("_exists", T.BooleanType()), T.StructField("_batch", T.LongType()),
                               *self.schema.fields])
        paths = [p for ps in self._paths(spark, before, wanted).values() for p in ps]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def _no_key(self):
        return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])

    def _live(self, images: DataFrame) -> DataFrame:
        """The last image of each key that exists; rows without a key as they are."""
        rest = [c for c in self.schema.fieldNames() if c not in self.keys]
        last = (images.where(~self._no_key()).groupBy(*self.keys)
                .agg(F.max_by(F.struct("_exists", *rest), "_batch").alias("_l")).where("_l._exists"))
        cols = self.schema.fieldNames()
        live = last.select(*[F.col(c) if c in self.keys else F.col("_l")[c].alias(c) for c in cols])
        return live.unionByName(images.where(self._no_key() & F.col("_exists")).select(*cols))

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark, cols = batch.sparkSession, self.schema.fieldNames()
        with intermediates(spark):  # what the batch writes on its way goes once its outputs are there
            batch = cut_lineage(batch.select(self.op, self.seq, *cols), "audit-batch")
            touched = batch.where(~self._no_key()).select(*self.keys).distinct()
            # a bounded number: the buckets
            wanted = {r[0] for r in touched.select(self._bucket().alias("b")).distinct().collect()}
            some = self._images(spark, batch_id, wanted).join(broadcast_if_small(touched), self.keys, "left_semi")
            before = cut_lineage(self._live(some), "audit-before")
            res = apply_changes(before, batch, self.keys, op=self.op, seq=self.seq, ctx=self.ctx,
                                fill_column=self.fill_column)
            res.history.write.mode("overwrite").parquet(self._path("history", batch_id))
            number = F.lit(batch_id).cast("long").alias("_batch")
            # one row for each touched key, whether it is there after or not, and rows without a key
            after = res.base.withColumn("_exists", F.lit(True)).join(touched, self.keys, "full_outer")
            self._write(after.select(F.coalesce("_exists", F.lit(False)).alias("_exists"), number, *cols), "images", batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self._compact(spark, batch_id)

    def _compact(self, spark: SparkSession, batch_id: int) -> None:
        """A new level for the buckets that have images above their last one."""
        paths = {k: p for k, p in self._paths(spark, batch_id + 1, None).items() if any("/images/" in x for x in p)}
        if paths:
            rows = self._live(self._images(spark, batch_id + 1, set(paths)))
            self._write(rows.select(F.lit(True).alias("_exists"), F.lit(batch_id).cast("long").alias("_batch"),
                                    *self.schema.fieldNames()), "compact", batch_id)

    def start(self, changes_stream: DataFrame, checkpoint_location: str, available_now: bool = True):
        w = (changes_stream.writeStream.foreachBatch(self.apply_batch)
             .option("checkpointLocation", checkpoint_location))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
        return w.start()

    def table(self, spark: SparkSession) -> DataFrame:
        return self._live(self._images(spark, None))

    def history(self, spark: SparkSession) -> DataFrame:
        done = complete_folders(spark, self._path("history"), "b=")
        if not done:
            return history_schema(spark.createDataFrame([], self.schema))
        return spark.read.parquet(*[self._path("history", b) for b in done])
