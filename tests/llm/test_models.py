"""Quality (hierarchical empirical Bayes) and toxicity (factorization machine)."""

import numpy as np
import pytest
from helpers import make_docs
from pyspark.sql import functions as F

from tidepool.llm import site_quality as sq
from tidepool.llm import toxicity as tx


def labels(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


def test_factors_learn_an_interaction():
    """Two terms that are harmless alone and toxic together."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (1500, 6)).astype(np.int8)
    y = (x[:, 0] & x[:, 1]).astype(float)
    m = tx.fit(x, y, np.arange(6), epochs=200)
    p = m.scores([np.flatnonzero(r) for r in x])
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.97
    pair, one, two = m.scores([np.array([0, 1]), np.array([0]), np.array([1])])
    odds = np.log([q / (1 - q) for q in (pair, one, two)])
    assert odds[0] > odds[1] + odds[2] - m.bias + 1      # more than the sum of its parts


def test_toxicity_held_out(spark, sf_dir):
    root = sf_dir.replace("sf0.001", "sf0.01")
    docs, marks = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    rows = tx.toxicity(docs, marks).join(marks.withColumnRenamed("doc_id", "d"), F.col("doc_id") == F.col("d")).collect()
    held = [r for r in rows if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    clean = [r for r in held if not r.toxic]
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.5 * len(toxic)  # a part of the labels is noise


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    marks = labels(spark, [(i, int(i == 16)) for i in range(1, 18)] + [(None, 1), (3, None)], "toxic")
    rows = tx.toxicity(odd_docs, marks).collect()
    assert len(rows) == odd_docs.count()
    empty = {r.score for r in rows if not (r.text or "").strip()}
    assert len(empty) == 1
    left = tx.reject_toxic(odd_docs, marks)
    assert left.columns == odd_docs.columns
    assert tx.reject_toxic(no_docs, marks).count() == 0
    none = tx.toxicity(odd_docs, labels(spark, [], "toxic"))
    assert {r.predicted for r in none.collect()} == {0}


def test_sparse_sites_shrink(spark):
    """A site with one document lies near the global mean, a large one near its own."""
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for site, size, good in (("big", 300, 0.95), ("bad", 300, 0.05), ("mid", 200, 0.6), ("tiny", 1, 0.0)):
        for _ in range(size):
            ok = rng.random() < good
            text = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"], 30)) + "."
            rows.append((n, text if ok else text.replace(" ", "!! ").upper(), site))
            n += 1
    docs = make_docs(spark, rows)
    marks = labels(spark, [(i, int("!!" not in t)) for i, t, _ in rows if i % 3], "quality")
    out = sq.site_quality(docs, marks).collect()
    post = {}
    for r in out:
        post.setdefault(r.host, []).append(r.path_posterior)
    mean = {k: float(np.mean(v)) for k, v in post.items()}
    overall = float(np.mean([r.evidence for r in out]))
    assert mean["big"] > 0.85 and mean["bad"] < 0.2
    assert abs(mean["tiny"] - overall) < 0.15
    truth = {i: "!!" not in t for i, t, _ in rows}
    assert np.mean([r.keep == truth[r.doc_id] for r in out]) > 0.97


def test_quality_held_out(spark, sf_dir):
    root = sf_dir.replace("sf0.001", "sf0.01")
    docs, marks = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in marks.collect()}
    rows = [r for r in sq.site_quality(docs, marks).withColumn("held", tx.held_out(F.col("doc_id"))).collect()
            if r.held and r.doc_id in truth]
    assert np.mean([int(r.keep) == truth[r.doc_id] for r in rows]) > 0.95


@pytest.mark.parametrize("some", [True, False])
def test_quality_odd_rows(spark, odd_docs, no_docs, some):
    marks = labels(spark, [(i, i % 2) for i in range(1, 18)] + [(None, 1), (3, None)] if some else [], "quality")
    rows = sq.site_quality(odd_docs, marks).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert sq.site_quality(no_docs, marks).count() == 0
