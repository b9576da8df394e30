"""Importance resampling against a plain computation; the quickselect against a sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from helpers import make_docs
from pyspark.sql import functions as F

from tidepool.llm import importance

NOT_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, runs):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in NOT_WORD.split(low) if x]
    return w, [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, runs=1, buckets=10_000, min_words=20, percent=10):
    docs = [(d, *features(t, runs)) for d, t in rows]
    s = Counter(f % buckets for _, _, fs in docs for f in fs)
    t = Counter(f % buckets for x in target for f in features(x, runs)[1])
    gain = [math.floor(1000 * math.log((t[k] + 1) * (s.total() + buckets) / ((s[k] + 1) * (t.total() + buckets))))
            for k in range(buckets)]
    out = []
    for n, (d, w, fs) in enumerate(docs):
        weight = sum(gain[f % buckets] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(fs), weight, score, None, len(w) >= min_words, n])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[6]))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("runs, percent", [(1, 10), (2, 35), (1, 100)])
def test_equals_plain(spark, odd_docs, odd_rows, runs, percent):
    target = [odd_rows[0][1], "words of É another TARGET text", None, ""]
    frame = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    got = importance.importance(odd_docs, frame, runs=runs, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.collect()) == plain([(d, t) for d, t, _ in odd_rows], target, runs, percent=percent)


def test_empty_tables(spark, no_docs, odd_docs, odd_rows):
    nothing = spark.createDataFrame([], "text string")
    assert importance.importance(no_docs, nothing).collect() == []
    got = importance.importance(odd_docs, nothing)
    assert Counter(tuple(r) for r in got.collect()) == plain([(d, t) for d, t, _ in odd_rows], [])


def test_equal_scores_and_ids(spark):
    text = "one two three four five six seven eight nine ten " * 2
    docs = make_docs(spark, [(7, text, "a")] * 30 + [(None, text, "a")] * 10)
    got = importance.importance(docs, spark.createDataFrame([(text,)], "text string"), percent=50)
    ranked = sorted((r["rank"], r["doc_id"]) for r in got.collect() if r["rank"])
    assert [r[0] for r in ranked] == list(range(1, 21))


def test_kth_key_is_the_sorted_one(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 6), 0, rng.randint(0, 20), n) for n in range(700)]  # very many ties
    keys = spark.createDataFrame(rows, "neg long, none int, id long, uid long").repartition(5).cache()
    for k in (1, 2, 350, 699, 700):
        assert importance.kth_key(keys, k, pivots=3) == sorted(rows)[k - 1]


def test_drawn_documents_look_like_the_target(spark):
    rng = random.Random(1)
    near, far = [f"near{i}" for i in range(50)], [f"far{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choices(near if i % 4 == 0 else far, k=40)), "s") for i in range(200)]
    target = spark.createDataFrame([(" ".join(near * 400),)], "text string")  # large beside the smoothing
    drawn = importance.importance(make_docs(spark, rows), target, percent=20).where(F.col("rank").isNotNull())
    assert sum(r["doc_id"] % 4 == 0 for r in drawn.collect()) >= 36  # of 40
