"""Session helpers: building a session for tests/bench and resolving the
shared checkpoint folder.

On a cluster the checkpoint folder must be shared storage named by the
cluster in ``spark.checkpoint.dir``; this module only reads that setting.
A private folder is created only when the setting is absent *and* the
master is ``local[...]`` (tests and local bench runs).
"""

from __future__ import annotations

import contextlib
import gc
import os
import re
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "tidepool",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session used by tests and bench.py (local mode, UI off, AQE on)."""
    b = (SparkSession.builder
         .master(master or "local[*]")
         .appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only in
    local mode when the cluster named none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        try:
            conf = spark.conf.get(CHECKPOINT_CONF)
        except Exception:  # noqa: BLE001 - key absent
            conf = None
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared checkpoint folder")
    local = tempfile.mkdtemp(prefix="tidepool-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


_LOCAL = threading.local()  # per-thread stack of path trackers (streams run batches on threads)


def _trackers() -> list[list[str]]:
    if not hasattr(_LOCAL, "trackers"):
        _LOCAL.trackers = []
    return _LOCAL.trackers


def cut_lineage(df: DataFrame, name: str = "lineage") -> DataFrame:
    """Write ``df`` once as a parquet table in the shared checkpoint folder
    and read it back: the plan runs once (a reliable ``checkpoint()`` of an
    unpersisted frame computes it twice), later stages read columnar files,
    and a lost executor does not force recomputation from the sources."""
    path = scratch_folder(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_folder(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path in the shared checkpoint folder, deleted with the others of an
    enclosing ``intermediates`` block; if ``keep``, of the next one around it."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    for t in _trackers()[:-1] if keep else _trackers():
        t.append(path)
    return path


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders through the session's Hadoop FileSystem."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished jobs now: it does
    so once the driver's heap has dropped the plans that made them."""
    gc.collect()  # Python's handles on those plans
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting inside the block."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def shuffles_dropped(spark: SparkSession):
    """Writes inside delete their own shuffle files when they end: what comes
    after reads the written table (``release_shuffles`` has to wait until the
    heap has dropped their plans)."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


class intermediates:
    """``with intermediates(spark):`` deletes the folders ``cut_lineage``
    wrote inside the block (on this thread) when it ends without error. Use
    it around work whose outputs are fully written inside the block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self):
        _trackers().append(self.paths)
        return self

    def __exit__(self, exc_type, exc, tb):
        _trackers().pop()  # blocks end in reverse order; equal lists of others stay
        if exc_type is None:
            delete_paths(self.spark, self.paths)
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidepool`` importable in Python workers (executors): zip the
    package once per application and ``addPyFile`` it, as ``--py-files``
    would. Called by every operator that runs Python tasks."""
    sc = spark.sparkContext
    app = sc.applicationId
    with _SHIP_LOCK:
        if app in _SHIPPED:
            return
        pkg = os.path.dirname(os.path.abspath(__file__))
        base = os.path.dirname(pkg)
        out = os.path.join(tempfile.mkdtemp(prefix="tidepool-pyfiles-"), "tidepool.zip")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for root, _, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.relpath(full, base))
        sc.addPyFile(out)
        _SHIPPED.add(app)


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a frame with fewer partitions than the cluster's parallelism
    (round-robin) before expensive per-row work (HTML parsing, grid
    generation). A large input already has enough partitions and is left
    alone, so this never shuffles a big table."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    # counting partitions only plans a scan; after an exchange it would run the
    # stages below, so such a frame (its partitions are what AQE makes of it) is spread
    if re.search(r"Join|Aggregate|Sort|Window|Repartition|Distinct|Intersect|Except",
                 plan.optimizedPlan().toString()):
        return df.repartition(target)
    return df.repartition(target) if plan.toRdd().getNumPartitions() < target else df
