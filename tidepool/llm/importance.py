r"""Target-distribution importance resampling.

Documents are drawn with probability in proportion to how much their words look
like a target's, by Gumbel scores: the largest of (log weight + noise) are a
draw without replacement. Words are hashed into ``buckets`` buckets; a bucket's
gain is the log of its smoothed share in the target over that in the documents.
A document's weight is the mean gain of its features, looked up in one array of
gains (its size is the number of buckets, whatever the data).

The k-th best composite key (score downwards, doc_id, row) is found by a
distributed quickselect: each round takes random rows between the bounds as
pivots, counts exactly how many rows lie before and at each pivot, and narrows the
bounds to the gap that holds the k-th. Then the winners alone are range-sorted
and ranked by a prefix count. Nothing but pivots and counts reaches the driver.

All scores are whole numbers (thousandths), so reruns agree.

Defined cases: a null or blank text has no features and weight 0; a null doc_id
hashes as an empty string and comes last among equal scores; rows with one doc_id
are candidates of their own, in row order; an empty target gives gains from
smoothing alone; an empty table gives no row; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import ascii_lower, running_sum, stored

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
PIVOTS = 16
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORDER = ["neg", "none", "id", "uid"]


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def buckets_of(df: DataFrame, keep: list[Column], runs: int, buckets: int) -> DataFrame:
    """``keep``, n_words and an array with the bucket of each feature: every
    run of 1 to ``runs`` words, repeats counted."""
    def of(n):
        if n == 1:
            return F.transform("w", lambda x: (F.crc32(x) % buckets).cast("int"))
        starts = F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: (F.crc32(F.array_join(F.slice("w", i, n), " ")) % buckets).cast("int"))

    parts = [of(n) for n in range(1, runs + 1)]
    return df.select(*keep, words(F.col("text")).alias("w")).select(
        *[c for c in df.select(*keep).columns], F.size("w").alias("n_words"),
        (F.concat(*parts) if runs > 1 else parts[0]).alias("buckets"))


def _counts(features: DataFrame) -> DataFrame:
    return features.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count()


def gains(features: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed document share)) of each
    bucket, from counts over all features. ``buckets`` rows reach the driver."""
    spark = features.sparkSession
    held, wanted = _counts(features).toDF("bucket", "s"), _counts(target).toDF("bucket", "t")
    rows = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(held, "bucket", "left").join(wanted, "bucket", "left").na.fill(0, ["s", "t"]))
    rows = stored(rows, "importance-counts")
    total = rows.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    up = (F.col("t") + 1).cast("double") * F.lit(float(total[0] + buckets))
    down = (F.col("s") + 1).cast("double") * F.lit(float(total[1] + buckets))
    out = np.zeros(buckets, np.int64)
    for r in rows.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).cast("long").alias("g")).collect():
        out[r["bucket"]] = r["g"]
    return out


def _weigh(gain: np.ndarray, keep: list[str], schema: pa.Schema):
    """Rows with ``weight`` instead of ``buckets``: one lookup and one segmented
    sum for a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("buckets")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            n = np.diff(lists.offsets.to_numpy())
            sums = np.concatenate([[0], np.cumsum(gain[values])])
            at = np.concatenate([[0], np.cumsum(n)])
            total = sums[at[1:]] - sums[at[:-1]]
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(n.astype(np.int64)), pa.array(weight.astype(np.int64))], schema=schema)
    return run


def _before(pivot: tuple) -> Column:
    """Rows whose composite key comes before ``pivot``."""
    out = F.lit(False)
    for c, v in reversed(list(zip(ORDER, pivot))):
        out = (F.col(c) < F.lit(v)) | ((F.col(c) == F.lit(v)) & out)
    return out


def _same(pivot: tuple) -> Column:
    return F.col("uid") == F.lit(pivot[-1])


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> tuple:
    """The k-th (from 1) composite key of ``keys`` (neg, none, id, uid; uid is
    unique). Every round is one pass for random pivots and one for counts."""
    keys = keys.select(*ORDER)
    low = high = None
    turn = 0
    while True:
        turn += 1
        rows = keys
        if low is not None:
            rows = rows.where(~_before(low) & ~_same(low))
        if high is not None:
            rows = rows.where(_before(high))
        drawn = rows.orderBy(F.xxhash64(F.lit(seed), F.lit(turn), "uid"), "uid").limit(pivots).collect()
        at = sorted(tuple(r) for r in drawn)
        # rows before each pivot, over all keys: the pivot itself is one more, what is left comes after
        counts = keys.agg(*[F.count(F.when(_before(p), True)) for p in at]).first()
        for p, n in zip(at, counts):
            if n + 1 == k:
                return p
            if n + 1 < k:
                low = p
            else:
                high = p
                break


def importance(docs: DataFrame, target: DataFrame, runs: int = 1, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
               percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null if not drawn) of every
    document: of the N with at least ``min_words`` words, floor(``percent`` N /
    100) are drawn towards the texts of ``target``."""
    ship_package(docs.sparkSession)
    features = stored(buckets_of(docs, [F.col("doc_id")], runs, buckets), "importance-features")
    gain = gains(features, buckets_of(target, [], runs, buckets), buckets)
    id_type = features.schema["doc_id"].dataType
    arrow_id = pa.schema([("doc_id", _arrow_type(id_type))])
    schema = pa.schema([arrow_id.field(0), ("n_words", pa.int32()), ("n_features", pa.int64()), ("weight", pa.int64())])
    weighed = features.mapInArrow(_weigh(gain, ["doc_id", "n_words"], schema), T.StructType([
        T.StructField("doc_id", id_type), T.StructField("n_words", T.IntegerType()),
        T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType())]))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0)))).cast("long")
    empty = F.lit("" if isinstance(id_type, T.StringType) else 0).cast(id_type)
    scored = (weighed.withColumn("score", F.col("weight") + noise).withColumn("neg", -F.col("score"))
              .withColumn("none", F.col("doc_id").isNull().cast("int")).withColumn("id", F.coalesce("doc_id", empty))
              .withColumn("uid", F.monotonically_increasing_id()))
    scored = stored(scored, "importance-scored")
    long_enough = scored.where(F.col("n_words") >= min_words)
    k = percent * long_enough.count() // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if k == 0:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    last = kth_key(long_enough, k, seed=seed)
    wins = (F.col("n_words") >= min_words) & (_before(last) | _same(last))
    winners = stored(scored.where(wins).withColumn("one", F.lit(1)), "importance-winners")
    ranked = running_sum(winners, [], ORDER, "one", "rank", "importance-rank")
    return ranked.select(*out, (F.col("rank") + 1).alias("rank")).unionByName(
        scored.where(~wins).select(*out, F.lit(None).cast("long").alias("rank")))


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)
