"""Links between rows that share a signature, joined into components.

Rows are (sig, uid, v): documents (or lines) that may be linked share a
signature; ``v`` lets a cheap test rule pairs out. A signature may hold a large
part of all rows, so no bucket is expanded into all pairs. Where the test ranks
rows, each row is paired with the first one of its bucket: a text that many near
copies come from joins them at once. Buckets are then
range-sorted (a large one lies in many partitions); neighbours in a bucket are
verified first and joined into components. Similar rows share most signatures, so
each uid takes part with ``PROBES`` of them, picked by a hash of the signature
that is the same for all: pairs go by the uids, however many signatures they have.
Only pairs of one bucket that lie in different components are left
then. They are probed by neighbours in other orders while that still joins
much, and the rest is tested and verified without exception: every link between
different components is found, and links inside one need not be listed. A bucket
with one component stays that way, so a turn goes on with the others' rows alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, intermediates, release_shuffles
from .common import components, partitions, stored

NEIGHBOURS = 2
PROBES = 4        # signatures of a uid in a probe, at most
REST_FACTOR = 2   # probe on while the rest has more pairs than this times its rows,
PROBE_SHARE = 20  # and while a probe joins one in so many of the rest's uids


@dataclass(frozen=True)
class Test:
    """The cheap test on two rows' v and their signature, for numpy arrays and for
    columns; the verification of pairs (a, b); more that the test on columns
    can use: x by uid, joined to the rows of the rest only (and null before); and a
    row's rank by its v: the lowest of a bucket is likeliest to be linked with the others."""
    arrays: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    columns: Callable[[Column, Column, Column, Column, Column], Column]
    verify: Callable[[DataFrame], DataFrame]
    more: DataFrame | None = None
    rank: Callable[[Column], Column] | None = None


def pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    p = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["a", "b"])


def columns_of(b: pa.RecordBatch) -> list[np.ndarray]:
    return [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]


def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Batches sorted by their first column, cut so that no run of equal first
    values goes over the end of one."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = columns_of(b)
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        cut = np.searchsorted(cols[0], cols[0][-1])
        if cut:
            yield [c[:cut] for c in cols]
        held = [c[cut:] for c in cols]
    if held is not None:
        yield held


def neighbour_pairs(rows: DataFrame, test: Test, turn: int, reach: int = NEIGHBOURS) -> DataFrame:
    """Pairs of rows (sig, uid, v, comp) of different components that lie next
    to each other in a bucket, in an order that depends on ``turn``; of each uid
    PROBES signatures at most, that depend on ``turn``, too."""
    near = test.arrays
    pick = F.xxhash64("sig", F.lit(turn))
    picked = (rows.groupBy("uid", F.pmod(pick, F.lit(PROBES)).alias("k"))
              .agg(F.min(F.struct(pick.alias("p"), "sig", "v", "comp")).alias("r")))
    # sampled for the range bounds, so the input is a written table
    ordered = (cut_lineage(picked.select("r.sig", F.xxhash64("uid", F.lit(turn)).alias("o"), "uid", "r.v", "r.comp"),
                           "bucket-order")
               .repartitionByRange(partitions(rows.sparkSession), "sig", "o").sortWithinPartitions("sig", "o"))

    def run(batches):
        held = None  # the last rows of the batch before
        for b in batches:
            cols = columns_of(b)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            sig, _, uid, v, comp = cols
            a, z = [], []
            for d in range(1, reach + 1):
                if len(sig) > d:
                    at = np.flatnonzero((sig[:-d] == sig[d:]) & (comp[:-d] != comp[d:]))
                    at = at[near(v[at], v[at + d], sig[at])]
                    a.append(uid[at])
                    z.append(uid[at + d])
            if a:
                yield pair_batch(np.concatenate(a), np.concatenate(z))
            held = [c[-reach:] for c in cols]

    return ordered.mapInArrow(run, "a long, b long").distinct()


def star_pairs(rows: DataFrame, test: Test) -> DataFrame:
    """Pairs of rows (sig, uid, v, comp) with the first one of their bucket, if it
    lies in another component; of each uid PROBES signatures at most."""
    first = rows.groupBy("sig").agg(F.min(F.struct(test.rank(F.col("v")).alias("rank"), "uid", "v", "comp")).alias("f"))
    picked = (rows.join(first.hint("merge"), "sig").where("comp <> f.comp")
              .groupBy("uid", F.pmod(F.xxhash64("sig"), F.lit(PROBES)).alias("k"))
              .agg(F.min(F.struct("f", "v", "sig")).alias("r")))
    none = F.lit(None).cast("array<bigint>")
    return (picked.where(test.columns(F.col("r.v"), F.col("r.f.v"), none, none, F.col("r.sig")))
            .select(F.least("uid", "r.f.uid").alias("a"), F.greatest("uid", "r.f.uid").alias("b")).distinct())


def open_buckets(rows: DataFrame, comps: DataFrame) -> tuple[DataFrame, int, int, int]:
    """Rows (sig, uid, v, comp) of the buckets with several components; the
    number of them, of their uids, and of the pairs across components."""
    labelled = cut_lineage(rows.join(comps.toDF("uid", "comp").hint("merge"), "uid", "left")
                           .withColumn("comp", F.coalesce("comp", "uid")), "bucket-labelled")
    per = labelled.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("k"))
    sums = cut_lineage(per.groupBy("sig").agg(
        F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("own"), F.count(F.lit(1)).alias("c"))
        .where("c > 1"), "bucket-open")
    pairs = sums.agg(F.coalesce(F.sum((F.col("all") * F.col("all") - F.col("own")) / 2), F.lit(0))).first()[0]
    left = stored(labelled.join(sums.select("sig").hint("merge"), "sig").select("sig", "uid", "v", "comp"),
                  "bucket-rest", keep=True)
    n, uids = left.agg(F.count(F.lit(1)), F.approx_count_distinct("uid")).first()
    return left, n, uids, int(pairs)


def pairs_across(rows: DataFrame, test: Test) -> DataFrame:
    """All pairs of a bucket that lie in different components and pass the test."""
    if test.more is not None:
        rows = rows.join(test.more.toDF("uid", "x").hint("merge"), "uid", "left").select("sig", "uid", "v", "comp", "x")
    else:
        rows = rows.withColumn("x", F.lit(0))
    x, y = rows.toDF("sig", "a", "va", "ca", "xa"), rows.toDF("sig2", "b", "vb", "cb", "xb")
    fits = test.columns(F.col("va"), F.col("vb"), F.col("xa"), F.col("xb"), F.col("sig"))
    return (x.join(y.hint("merge"), (F.col("sig") == F.col("sig2")) & (F.col("ca") < F.col("cb")) & fits)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def link_components(rows: DataFrame, links: DataFrame, tested: DataFrame, test: Test, name: str) -> DataFrame:
    """(node, component) from the known ``links`` (a, b) and all links among
    ``rows`` (sig, uid, v), a written table; ``tested`` are pairs verified before."""
    spark = rows.sparkSession
    with intermediates(spark):
        comps = stored(components(links, name), f"{name}-comps", keep=True)
    if rows.isEmpty():
        return comps
    turn, probing = 0, True
    while True:
        with intermediates(spark):  # of a turn, what is left, tested and joined stays
            left, n, uids, pairs = open_buckets(rows, comps)
            if not pairs:
                return comps
            rows = left.drop("comp")
            last = not probing or pairs <= REST_FACTOR * n
            if last:
                found = pairs_across(left, test)
            elif test.rank is not None and turn == 0:
                found = star_pairs(left, test)
            else:
                found = neighbour_pairs(left, test, turn)
            fresh = stored(found.join(tested.hint("merge"), ["a", "b"], "left_anti"), f"{name}-pairs", keep=True)
            more = cut_lineage(test.verify(fresh), f"{name}-links")
            joined = more.count()
            if joined:
                # components found so far are stars, so only what the new links join moves
                comps = stored(components(comps.toDF("a", "b").unionByName(more), name), f"{name}-comps", keep=True)
        release_shuffles(spark)
        if last:
            return comps
        tested = tested.unionByName(fresh)
        probing = joined * PROBE_SHARE >= uids  # otherwise probing joins little: the whole rest comes next
        turn += 1
