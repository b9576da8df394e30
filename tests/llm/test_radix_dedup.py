import hashlib
import re
from collections import defaultdict

import pytest

from tidepool.llm import radix_dedup as rd


def expected(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows]
    groups = defaultdict(list)
    for (d, _, _), t in zip(rows, norm):
        groups[t].append((d is None, d or 0))
    out = []
    for (d, _, _), t in zip(rows, norm):
        first = min(groups[t])
        out.append((d, None if first[0] else first[1], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("digit,growth", [(64, 8), (1, 2), (3, 1)])
def test_groups(odd_docs, odd_rows, digit, growth, monkeypatch):
    short = [r for r in odd_rows if len(r[1] or "") < 400] if growth == 1 else odd_rows
    docs = odd_docs if growth > 1 else odd_docs.where("text is null or length(text) < 400")
    if growth == 1:
        short = [r for r in short if len(r[1] or "") < 40]
        docs = docs.where("text is null or length(text) < 40")
    monkeypatch.setattr(rd.radix_groups, "__defaults__", (digit, growth))
    rows = rd.exact_dedup(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == expected(short)
    by = defaultdict(list)
    for r in rows:
        by[r.text_sha256].append(r)
    for group in by.values():
        assert [r.doc_id for r in group if r.kept] == [group[0].keep_id]


def test_empty(no_docs):
    assert rd.exact_dedup(no_docs).count() == 0
