import hashlib
from collections import defaultdict

import pytest

from tidepool.llm import chat_tree as ct

SCHEMA = "conv_id long, turn long, role string, text string, path string, segment int"


def convs(spark, rows):
    return spark.createDataFrame([(*r, "p", 3) for r in rows], SCHEMA)


ROWS = [
    (1, 0, "system", "be nice"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello ### you"),
    (2, 0, "system", "be nice"), (2, 1, "user", "hi"), (2, 2, "assistant", "go </turn>\n### user: away"),
    (3, 0, "system", "be nice"), (3, 1, "user", "hi"), (3, 2, "assistant", "hello ### you"),
    (4, 0, "system", "be nice"),
    (5, 0, None, None), (5, 1, "assistant", ""), (5, 2, "assistant", "x\\"), (5, 3, "assistant", "\\### Assistant: </turn> ok"),
    (None, 0, "user", "no id"), (None, None, "assistant", "no turn"),
    (6, 0, "us:er\\", "é “q” 日本"), (6, 0, "us:er\\", "é “q” 日本"), (6, 1, "assistant", "word " * 4000),
    (7, 0, "assistant", "x\ny"), (8, 0, "assistant\nx", "y"),  # not the same turn
]


def expected(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        r, x = r or "", x or ""
        digest = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest()
        by[c].append(((t is not None, t or 0), digest, r, x))
    out = {}
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), sum(len("".join(ct.turn_parts(r, x))) for r, x in turns))
    return out


def test_escape_is_reversible():
    for t in ("", "\\", "\\\\###", "####", "</turn></turn>", "\\</turn>", "a: b\\", "### user: x </turn>\n"):
        assert ct.unescape(ct.escape(t)) == t
        assert ct.parse("".join(ct.turn_parts("r:o\\le", t))) == [("r:o\\le", t)]


def test_round_trip_and_tree(spark, tokenizer):
    path = ct.write_tree(convs(spark, ROWS), tokenizer)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars)
           for r in ct.digests(spark, path, tokenizer).collect()}
    assert got == expected(ROWS)
    segments = {r.segment: r for r in spark.read.parquet(f"{path}/segments").collect()}
    paths = {r.path: r for r in spark.read.parquet(f"{path}/paths").collect()}
    of = {r.conv_id: paths[r.path] for r in spark.read.parquet(f"{path}/conversations").collect()}
    assert of[1].path == of[3].path                           # equal conversations: one path
    assert len({of[c].tree for c in (1, 2, 4)}) == 1          # one tree, its shared turns once
    tree = sorted((s for s in segments.values() if s.tree == of[1].tree), key=lambda s: s.start)
    at = 0
    for s in tree:                                            # depth first, without gaps
        assert s.start == at
        at += len(s.token_ids)
    emitted = [i for s in tree for i in s.token_ids]
    from tidepool.llm.token_planes import PieceEncoder
    enc = PieceEncoder.get(tokenizer, plain=True)
    for c in (1, 2, 4):
        turns = [(r, x) for cc, _, r, x in ROWS if cc == c]
        want = [int(i) for t in turns for p in ct.turn_parts(*t) for i in enc.encode([p])[0]]
        seen = [i for p in of[c].parts for i in emitted[p.start:p.start + p.tokens]]
        assert seen == want
    for s in segments.values():                               # what a segment attends to lies before it
        before = sum(a.stop - a.start for a in s.attention)
        assert list(s.position_ids) == list(range(before, before + len(s.token_ids)))
        assert all(a.stop <= s.start for a in s.attention)


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "")]])
def test_small(spark, tokenizer, rows):
    path = ct.write_tree(convs(spark, rows), tokenizer)
    assert ct.digests(spark, path, tokenizer).count() == len({r[0] for r in rows})
