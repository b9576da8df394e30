import random
from collections import defaultdict

import pytest
from helpers import make_docs, words

from tidepool.llm import ngram_join as nj

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def expected(rows):
    sets = [shingles(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _, _) in enumerate(rows):
        low[find(i)].append((d is None, d or 0))
    first = {k: min(v) for k, v in low.items()}
    return sorted(((d, len(sets[i]), None if first[find(i)][0] else first[find(i)][1])
                   for i, (d, _, _) in enumerate(rows)), key=str), len(first)


def check(spark, rows):
    got = nj.join(make_docs(spark, rows)).collect()
    want, components = expected(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    kept = [r for r in got if r.first_of_component]
    assert len(kept) == components and all(r.doc_id == r.component_id for r in kept)


@pytest.mark.parametrize("frequent,very", [(16, 32), (2, 2), (2, 64)])
def test_odd_rows(spark, odd_rows, monkeypatch, frequent, very):
    monkeypatch.setattr(nj, "FREQUENT", frequent)
    monkeypatch.setattr(nj, "VERY_FREQUENT", very)
    check(spark, odd_rows)


def variants(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            k = rng.randrange(len(w))
            w[k] = rng.choice(base) + str(rng.randrange(1000))
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed,frequent,size", [(1, 2, 12), (2, 2, 60), (3, 3, 150), (4, 4, 150)])
def test_groups_of_near_copies(spark, monkeypatch, seed, frequent, size):
    """Groups with many variants near the threshold: all tokens are frequent."""
    monkeypatch.setattr(nj, "FREQUENT", frequent)
    monkeypatch.setattr(nj, "VERY_FREQUENT", 4)
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(5):
        base = [f"w{rng.randrange(300)}" for _ in range(size)]
        for t in variants(rng, base, 18, max(1, size // 25)):
            rows.append((n, t, "a"))
            n += 1
    rng.shuffle(rows)
    check(spark, rows)


def test_small_sets(spark):
    w = "a b c d e f g h i j k l".split()
    rows = [(i, " ".join(w[:i]), "x") for i in range(1, 13)] + [(20 + i, " ".join(w[1:i]), "x") for i in range(2, 12)]
    check(spark, rows + rows[:3])


def test_dedup_keeps_columns(spark, odd_docs, no_docs):
    out = nj.dedup(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.count() == nj.join(odd_docs).where("first_of_component").count()
    assert nj.dedup(no_docs).count() == 0


def test_probes_go_by_uids(spark, monkeypatch):
    """Rows that share many signatures take part in a probe with a few of them."""
    from tidepool.llm import bucket_join as bj
    rows = spark.createDataFrame([(s, u, 50, u) for s in range(60) for u in range(40)],
                                 "sig long, uid long, v long, comp long")
    test = bj.Test(lambda a, b, _: a == b, None, None)
    probed, write = [], bj.cut_lineage

    def counted(df, name):
        out = write(df, name)
        probed.append(out.count())
        return out

    monkeypatch.setattr(bj, "cut_lineage", counted)
    pairs = bj.neighbour_pairs(rows, test, 0, 1).collect()
    assert len(probed) == 1 and probed[0] <= 40 * bj.PROBES
    assert len(pairs) == 39  # similar rows pick the same signatures, so all are chained


def test_turns_leave_no_folders(spark):
    """Of a join, the sizes and components stay, not its index and turns."""
    import os

    from tidepool.session import checkpoint_dir
    base = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    w = [f"w{i}" for i in range(60)]
    nj.join(make_docs(spark, [(i, " ".join(w[:59 - i % 3]), "a") for i in range(30)])).count()
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before}
    assert "ngram-comps" in left and not left & {"ngram-index", "bucket-labelled", "bucket-order", "bucket-rest", "ngram-pairs", "ngram-sets"}


def test_own_words_rule_pairs_out(spark, monkeypatch):
    """Near copies of one text with too many words of their own are no candidates:
    they share buckets, but not enough tokens that others can have."""
    monkeypatch.setattr(nj, "FREQUENT", 4)
    asked, verify = [], nj.verified
    monkeypatch.setattr(nj, "verified", lambda pairs, *a: asked.append(pairs.count()) or verify(pairs, *a))
    base = [f"w{i}" for i in range(203)]
    rows = []
    for d in range(30):
        w = list(base)
        for k in range(5):  # 20 of 200 shingles are its own
            w[7 + 40 * k + d % 25] = f"own{d}x{k}"
        rows.append((d, " ".join(w), "a"))
    check(spark, rows)
    assert sum(asked) == 0
