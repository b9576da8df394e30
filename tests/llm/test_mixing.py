import hashlib
from collections import Counter, defaultdict

import pytest
from helpers import words

from tidepool.llm import mixing


def dealt(sizes, weights, share, most):
    """Targets by dealing round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            out.update({s: level * w[s] for s in open_})
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def check(rows, docs, share=1.5, most=2.0):
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len(words(t))
    want = dealt(sizes, [3, 1, 2], share, most)
    assert len(rows) == len(docs)
    taken = Counter()
    for r in rows:
        taken[r.source_size, round(r.target, 6)] += r.taken
        assert 0 <= r.taken <= most * r.size
    expect = Counter()
    for s, t in want.items():
        expect[sizes[s], round(t, 6)] += int(t + 1e-9)
    assert +taken == +expect
    assert Counter(r.size for r in rows) == Counter(len(words(t)) for _, t, _ in docs)


@pytest.mark.parametrize("share", [0.2, 1.5, 2.0])
def test_budgets(odd_docs, odd_rows, share):
    rows = mixing.mix_plan(odd_docs, [3.0, 1.0, 2.0], share, 2.0).collect()
    check(rows, odd_rows, share)
    again = mixing.mix_plan(odd_docs.repartition(7), [3.0, 1.0, 2.0], share, 2.0).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_order_is_hash_random(spark):
    from helpers import make_docs
    docs = make_docs(spark, [(i, "a b c", "x") for i in range(50)])
    rows = mixing.mix_plan(docs, [1.0], 0.5, 1.0).collect()
    by_key = sorted(rows, key=lambda r: hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest())
    assert [r.taken for r in by_key] == [3] * 25 + [0] * 25


def test_mixed_rows(odd_docs, odd_rows, no_docs):
    plan = mixing.mix_plan(odd_docs, [3.0, 1.0, 2.0], 1.5, 2.0).collect()
    out = mixing.mix(odd_docs, [3.0, 1.0, 2.0], 1.5, 2.0)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert sum(len(words(r.text)) for r in rows) == sum(r.taken for r in plan)
    whole = {t for _, t, _ in odd_rows}
    assert all(r.text in whole or any(t and t.startswith(r.text) for t in whole) for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows)
    assert mixing.mix(no_docs, [1.0], 1.5, 2.0).count() == 0
    assert mixing.mix_plan(no_docs, [1.0], 1.5, 2.0).count() == 0
