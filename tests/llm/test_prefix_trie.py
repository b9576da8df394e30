"""Prefix trie against a plain trie built in Python."""

import hashlib
import random
import zlib

from tidepool.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, depth long, key0 string, uid int, k int, n long"


def make(spark, rows):
    return spark.createDataFrame([(*r, 9, "x", 1, 2, 3) for r in rows], SCHEMA)


def ordered(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))

    def key(t):
        body = f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()
        return (t[0] is not None, t[0] or 0, hashlib.sha256(body).hexdigest())
    return {c: [(r, x) for _, r, x in sorted(v, key=key)] for c, v in convs.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, m in members.items():
        below = {p: v for p, v in members.items() if p[:len(path)] == path}
        inner = {p[:-1] for p in members if p}
        ends = sorted(c for c in m if len(convs[c]) == len(path))
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m),
                    sum(len(p) == len(path) + 1 for p in below), sum(p not in inner for p in below),
                    sum((len(v) - 1) * len(p[-1][1].encode()) for p, v in below.items() if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def spark_trie(df, **kw):
    rows = prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.positions(df)), **kw)
    assert rows.columns == COLUMNS
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def odd_conversations():
    rng = random.Random(3)
    texts = ["", "a", "bb", "é ü", None, "line\nbreak", "x" * 20_000]
    rows = []
    for c in [*range(-7, 40), 60, 61, 77]:
        for turn in range(rng.randint(1, 14)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), texts[min(rng.randint(0, 9), 6) if turn > 2 else turn]))
    rows += [(5, None, "user", "null turn"), (5, None, "user", "null turn"), (6, 1, "user", "a tie"), (6, 1, "b", "another")]
    rows += [(None, 1, "user", "nobody's")]
    # a role that ends in the text's first line is another turn
    rows += [(100, 0, "assistant", "x\ny"), (105, 0, "assistant\nx", "y"), (110, 0, "assistant", "x\ny")]
    rows += [(200, t, "user", f"t{t % 3}") for t in range(150)]  # a long conversation
    rows += [(c, 0, "user", "the same") for c in range(300, 380)]  # very many equal ones
    return rows


def test_trie_equals_plain_trie(spark):
    rows = odd_conversations()
    want = plain_trie(rebuild(ordered(rows)))
    assert spark_trie(make(spark, rows)) == want
    assert spark_trie(make(spark, rows), block=7) == want  # the result doesn't depend on the block's length


def test_conversations_without_turns(spark):
    # conversations 1 and 2 lose their only turn to a base that isn't there
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 4)]
    convs = rebuild(ordered(rows))
    assert any(not t for t in convs.values())
    assert spark_trie(make(spark, rows)) == plain_trie(convs)


def test_no_conversations(spark):
    assert spark_trie(make(spark, [])) == []
    assert spark_trie(make(spark, [(None, 1, "user", "x")])) == []
