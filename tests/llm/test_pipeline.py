"""The pipeline against a plain version of its stages (the model's scores and
the tokenizer are taken as given)."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import make_docs, words

from tidepool.llm import toxicity

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def plain_pipeline(docs, scores, items, tokenizer):
    from test_mixing import dealt
    from test_ngram_join import expected
    from test_token_planes import reference_ids
    docs = [d for d in docs if scores[d.doc_id] < toxicity.THRESHOLD]
    comps, _ = expected([(d.doc_id, d.text, d.source) for d in docs])
    first = {c for _, _, c in comps}
    docs = [d for d in docs if d.doc_id in first]

    def flat(t):
        return " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "

    docs = [d for d in docs if not any(flat(i) in flat(d.text) for i in items)]
    by = defaultdict(list)
    for d in docs:
        by[d.source].append(d)
    sizes = {s: sum(len(words(d.text)) for d in ds) for s, ds in by.items()}
    target = dealt(sizes, [3, 1, 2], 1.5, 2.0)
    out = []
    for s, ds in by.items():
        budget, left = int(target[s] + 1e-9), 0
        epochs = budget // sizes[s] if sizes[s] else 0
        left = budget - epochs * sizes[s]
        for d in sorted(ds, key=lambda d: hashlib.md5(f"mix-1:{d.doc_id}".encode()).hexdigest()):
            out += [(d.doc_id, d.text)] * epochs
            n = len(words(d.text))
            if left >= n > 0:
                out.append((d.doc_id, d.text))
            elif left > 0 and n:
                pieces = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", d.text)
                out.append((d.doc_id, "".join(pieces[:left])))
            left = max(0, left - n)
    ids = reference_ids(tokenizer, [t or "" for _, t in out])
    return sorted((d, len(x) + 1, zlib.crc32(np.array([*x, 2], "<u4").tobytes())) for (d, _), x in zip(out, ids))


def test_run(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.toxicity(docs, marks).collect()}
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = plain_pipeline(docs.collect(), scores, items, tokenizer)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert [s for s, _ in starts] == [0, *np.cumsum([n for _, n in starts])[:-1].tolist()]


def test_stages_keep_odd_columns(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns, name
            assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_near_copies_by_five_words(spark):
    """Other words at both ends: 0.806 on five-word shingles, 0.81 on four-word ones."""
    w = [f"w{i}" for i in range(60)]
    base, ends = " ".join(w), " ".join(["x", "y", *w[2:-4], "a", "b", "c", "d"])
    far = " ".join(w[:20] + ["u"] + w[21:40] + ["v"] + w[41:])
    docs = make_docs(spark, [(1, base, "a"), (2, ends, "a"), (3, far, "a")])
    five = lambda t: {tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)}
    a, b, c = map(five, (base, ends, far))
    assert len(a & b) / len(a | b) >= 0.8 > len(a & c) / len(a | c)
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_a_stage_leaves_its_result_only(spark, sf_dir, monkeypatch):
    import os

    import corpus_pipeline

    from tidepool.llm.common import numbered
    from tidepool.session import checkpoint_dir

    def stage(spark, docs, sf_dir):
        rows, uid = numbered(docs.select("doc_id"), "stage-own")
        return rows.select("doc_id")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage), ("three", stage)])
    base = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    left = sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before)
    assert left == ["pipeline-one", "pipeline-two", "stage-own"]  # the last stage is read by the caller
