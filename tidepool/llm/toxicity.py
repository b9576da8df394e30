"""Toxicity scores from a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>) over the distinct hashed
terms of a text. The pairwise part learns what a term means beside another one
(an insult beside a group mention), which additive weights miss. Terms are
words (runs of letters and digits, in lower case) hashed to ``HASH_BITS`` bits.

The model is fitted on a bounded sample of labelled rows: at most ``MAX_ROWS``,
those with the smallest hash of their doc_id, so the sample is the same each
time. A term is a feature if at least ``MIN_ROWS`` sample rows have it and its
chi-squared against the label reaches ``MIN_CHI2``; the strongest
``MAX_FEATURES`` at most. Scoring covers every row and whole texts: each row's
terms are reduced to the model's features by a JVM set intersection and a
vectorised UDF sums the factors.

Defined cases: a null or empty text has no terms and scores sigmoid(b); with no
labelled rows every score is sigmoid(-30), some 1e-13; null labels are left out; equal rows get equal
scores; an empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import free_names

HASH_BITS = 40
MAX_ROWS = 5_000
MIN_ROWS = 4
MIN_CHI2 = 15.0
MAX_FEATURES = 4_096
FACTORS = 4
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    terms: np.ndarray     # sorted term hashes
    bias: float
    weights: np.ndarray   # a weight for each term
    factors: np.ndarray   # terms x FACTORS

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probabilities for rows of term hashes, each of them in ``terms``."""
        n = np.fromiter(map(len, rows), np.int64, len(rows))
        at = np.searchsorted(self.terms, np.concatenate(rows)) if n.sum() else np.zeros(0, int)
        row = np.repeat(np.arange(len(rows)), n)
        z = self.bias + np.bincount(row, self.weights[at], len(rows))
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            z += 0.5 * (np.bincount(row, v, len(rows)) ** 2 - np.bincount(row, v * v, len(rows)))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def hashed_terms(text: Column) -> Column:
    words = F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.transform(words, lambda w: F.shiftrightunsigned(F.xxhash64(w), 64 - HASH_BITS))


def fit(x: np.ndarray, y: np.ndarray, terms: np.ndarray, factors: int = FACTORS, epochs: int = 60,
        rate: float = 0.1, l2: float = 1e-4, seed: int = 7) -> Model:
    """Adagrad on the logistic loss; ``x`` (rows x terms) has 0 and 1."""
    rng = np.random.default_rng(seed)
    n, m = x.shape
    base = np.clip(y.mean() if n else 0.0, 1e-6, 1 - 1e-6)
    b, w, v = float(np.log(base / (1 - base))), np.zeros(m), rng.normal(0, 0.01, (m, factors))
    gb, gw, gv = 1e-8, np.full(m, 1e-8), np.full((m, factors), 1e-8)
    for _ in range(epochs if n else 0):
        for part in np.array_split(rng.permutation(n), max(1, n // 256)):
            xb = x[part].astype(np.float64)
            s = xb @ v
            z = b + xb @ w + 0.5 * ((s * s).sum(1) - xb @ (v * v).sum(1))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            db, dw = g.sum(), xb.T @ g + l2 * w
            dv = xb.T @ (g[:, None] * s) - (xb.T @ g)[:, None] * v + l2 * v
            gb, gw, gv = gb + db * db, gw + dw * dw, gv + dv * dv
            b, w, v = b - rate * db / np.sqrt(gb), w - rate * dw / np.sqrt(gw), v - rate * dv / np.sqrt(gv)
    return Model(terms, float(b) if n else -30.0, w, v)


def select_terms(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature terms and the 0/1 matrix of the sample over them."""
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, 0), np.int8)
    sets = [np.unique(r) for r in rows]
    n = np.array([len(s) for s in sets])
    terms, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(rows)), n)
    df = np.bincount(at, minlength=len(terms)).astype(float)
    pos = np.bincount(at, weights=y[row], minlength=len(terms))
    total, all_pos = len(rows), y.sum()
    # chi-squared of the 2 x 2 table (term, label)
    num = total * (pos * (total - all_pos - df + pos) - (df - pos) * (all_pos - pos)) ** 2
    den = df * (total - df) * all_pos * (total - all_pos)
    chi = np.divide(num, den, out=np.zeros_like(num), where=den > 0)
    good = np.flatnonzero((df >= MIN_ROWS) & (chi >= MIN_CHI2))
    good = np.sort(good[np.argsort(-chi[good], kind="stable")[:MAX_FEATURES]])
    to = np.full(len(terms), -1)
    to[good] = np.arange(len(good))
    hit = to[at] >= 0
    x = np.zeros((total, len(good)), np.int8)
    x[row[hit], to[at][hit]] = 1
    return terms[good], x


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """``docs`` (doc_id, text), ``labels`` (doc_id, ``label``): rows that are
    not held out."""
    own = labels.select("doc_id", F.col(f"`{label}`").cast("int").alias("_y")) \
        .where(F.col("_y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # at most max_rows rows of two numbers: safe to broadcast
    sample = own.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id", "_y").limit(max_rows)
    got = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
           .select("doc_id", "_y", F.array_distinct(hashed_terms(F.col("text"))).alias("t"))
           .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id", F.hash("t")).limit(max_rows)
           .select("_y", "t").toPandas())
    y = got["_y"].to_numpy(np.float64)
    terms, x = select_terms([np.asarray(t, np.int64) for t in got["t"]], y)
    return fit(x, y, terms)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the model's probability for each text."""
    ship_package(docs.sparkSession)
    known = F.array(*[F.lit(int(t)) for t in model.terms]).cast("array<bigint>")

    @F.pandas_udf("double")
    def fm(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(model.scores([np.asarray(r, np.int64) for r in s]))

    hits = F.array_intersect(known, hashed_terms(F.col(f"`{text}`")))
    return docs.withColumn(out, fm(hits))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted (1 if score >= threshold)."""
    scored = score(docs, train(docs, labels))
    return (scored.withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the model calls toxic."""
    out = free_names(docs, "_toxicity")[0]
    return score(docs, train(docs, labels), out=out).where(F.col(out) < threshold).drop(out)
