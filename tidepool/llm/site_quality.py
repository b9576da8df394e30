"""Quality by hierarchical empirical Bayes over sites.

A logistic classifier on the shape of a text gives each document a probability
of good quality. Grouped aggregation sums that evidence (a training row's label
where there is one) by host and by path within host. The prior of a path is
its host's posterior mean, the prior of a host the global mean; how strongly a
level is shrunk towards the one above (its pseudo-count) follows from the
spread of the means at that level by the method of moments. So a site with few
documents lies near the global prior and a large one near its own mean. A
document's own evidence is left out of its site's posterior, and the two are
combined as log odds: logit(document) + logit(path posterior) - logit(global).

The classifier is fitted on at most ``MAX_ROWS`` labelled rows, those with the
smallest hash of doc_id; all counts and sums cover every document. Scoring is
DataFrame code.

Defined cases: a null or empty text has all-zero shape; a null host or path is
a site of its own; rows with equal doc_id are separate documents; with no
labelled rows each document's evidence is 0.5; null labels are left out; an
empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, stored, word_array
from .toxicity import held_out

MAX_ROWS = 8_000
THRESHOLD = 0.5
SIGNS = "!#$%&*|"


def shape(text: Column) -> dict[str, Column]:
    """Shape of a text: shares of kinds of characters, words and lines."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words, lines = word_array(t), F.split(t, "\n")
    k = F.greatest(F.size(words), F.lit(1)).cast("double")
    out = {f"sign_{i}": F.sqrt((F.length(t) - F.length(F.translate(t, s, ""))) / n) for i, s in enumerate(SIGNS)}
    return out | {
        "upper": F.length(F.regexp_replace(t, r"\P{Lu}+", "")) / n,
        "digit": (F.length(t) - F.length(F.translate(t, "0123456789", ""))) / n,
        "stops": (F.length(t) - F.length(F.translate(t, ".,;:?", ""))) / n,
        "log_words": F.log1p(F.size(words).cast("double")),
        "word_length": F.log1p(n / k),
        "distinct_words": F.size(F.array_distinct(words)) / k,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
    }


@dataclass(frozen=True)
class Logistic:
    names: tuple[str, ...]
    bias: float
    weights: np.ndarray

    def log_odds(self) -> Column:
        return sum((F.col(n) * float(w) for n, w in zip(self.names, self.weights)), F.lit(float(self.bias)))


def fit(x: np.ndarray, y: np.ndarray, names: tuple[str, ...], l2: float = 1.0, steps: int = 30) -> Logistic:
    """Newton steps on standardised features; weights for the raw ones."""
    if not len(y) or y.min() == y.max():
        base = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return Logistic(names, float(np.log(base / (1 - base))), np.zeros(len(names)))
    mean, std = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(y), 1)), (x - mean) / std])
    w, ridge = np.zeros(z.shape[1]), l2 * np.eye(z.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
    return Logistic(names, float(w[0] - (w[1:] * mean / std).sum()), w[1:] / std)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Logistic:
    """``docs`` (doc_id, text), ``labels`` (doc_id, quality): rows not held out."""
    # at most max_rows rows of two numbers: safe to broadcast
    sample = labels.orderBy(F.xxhash64("doc_id", F.lit(13)), "doc_id", "label").limit(max_rows)
    names = tuple(shape(F.lit("")))
    got = (docs.join(F.broadcast(sample), "doc_id").select("label", *[c.alias(n) for n, c in shape(F.col("text")).items()])
           .orderBy(F.xxhash64("label", *names), *names).limit(max_rows).toPandas())
    return fit(got[list(names)].to_numpy(np.float64), got["label"].to_numpy(np.float64), names)


def pseudo_count(n: Column, m: Column, above: Column) -> Column:
    """Pseudo-count of a level's prior by the method of moments, from its
    groups' sizes ``n``, means ``m`` and the means ``above`` them. Without any
    spread beyond chance it is the number of documents."""
    total = F.sum(n)
    within = F.sum(n * above * (1 - above)) / total
    spread = F.sum(n * (m - above) * (m - above)) - F.count(F.lit(1)) * within
    between = spread / (total - F.sum(n * n) / total)
    return F.coalesce(F.when(between > 0, F.least(F.greatest(within / between - 1, F.lit(1.0)), total)), total)


def logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def site_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
                 text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, host, path, evidence (the classifier's
    probability), host_posterior and path_posterior (without the row's own
    evidence), score, keep (score >= threshold)."""
    own = labels.select("doc_id", F.col("quality").cast("double").alias("label")) \
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = stored(own.groupBy("doc_id").agg(F.max("label").alias("label")), "site-labels")
    rows = docs.select(col(doc_id).alias("doc_id"), col(host).alias("host"), col(path).alias("path"),
                       col(text).alias("text"))
    model = train(rows.select("doc_id", "text"), own)
    # written once without the texts; the labels meet these narrow rows
    plain = stored(rows.select("doc_id", "host", "path", *[c.alias(n) for n, c in shape(F.col("text")).items()])
                   .select("doc_id", "host", "path", (1 / (1 + F.exp(-model.log_odds()))).alias("evidence")),
                   "site-evidence")
    scored = stored(plain.join(own, "doc_id", "left").withColumn("e", F.coalesce("label", "evidence")), "site-scored")

    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"),
                                                      F.sum("e").alias("s")), "site-paths")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs")), "site-hosts")
    whole = hosts.agg(F.sum("hn").alias("gn"), F.sum("hs").alias("gs")).select((F.col("gs") / F.col("gn")).alias("mu"))
    mu = whole.first()["mu"]
    mu = 0.5 if mu is None else float(mu)
    k_host = hosts.agg(pseudo_count(F.col("hn"), F.col("hs") / F.col("hn"), F.lit(mu)).alias("k")).first()["k"] or 1.0
    hosts = hosts.withColumn("hm", (F.col("hs") + k_host * mu) / (F.col("hn") + k_host))
    same_host = F.col("host").eqNullSafe(F.col("host2"))
    paths = stored(paths.join(hosts.withColumnRenamed("host", "host2"), same_host).drop("host2"), "site-levels")
    k_path = paths.agg(pseudo_count(F.col("n"), F.col("s") / F.col("n"), F.col("hm")).alias("k")).first()["k"] or 1.0

    # a site's row meets all of its documents: a merge join, which Spark splits for a hot site
    both = scored.join(paths.toDF("host2", "path2", *paths.columns[2:]).hint("merge"),
                       same_host & F.col("path").eqNullSafe(F.col("path2")))
    host_post = (F.col("hs") - F.col("e") + k_host * mu) / (F.col("hn") - 1 + k_host)
    path_post = (F.col("s") - F.col("e") + k_path * F.col("host_posterior")) / (F.col("n") - 1 + k_path)
    odds = logit(F.col("evidence")) + logit(F.col("path_posterior")) - F.lit(float(np.log(
        np.clip(mu, 1e-6, 1 - 1e-6) / (1 - np.clip(mu, 1e-6, 1 - 1e-6)))))
    return (both.withColumn("host_posterior", host_post).withColumn("path_posterior", path_post)
            .withColumn("score", 1 / (1 + F.exp(-odds)))
            .select("doc_id", "host", "path", "evidence", "host_posterior", "path_posterior", "score",
                    (F.col("score") >= threshold).alias("keep")))
