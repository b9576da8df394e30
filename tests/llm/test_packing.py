"""Packing: ids as the library gives them, nothing lost, few sequences."""

import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import make_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidepool.llm import packing
from tidepool.llm.queries import default_tokenizer, word_tokenizer

WORDS = word_tokenizer()
TOK = Tokenizer.from_file(WORDS)


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=12), st.text("abIJéÉ̌.,'!?&　\x0b\x1c\x85 \n019-", max_size=15),
    st.sampled_from(["<|endoftext|>", "don't", "I'LL", "J̌", "ﬁ", "İ", "word...", "(a)", "≠x", "≠", "漢字。", "ÇA", "x" * 90])),
    max_size=12).map(" ".join))
def test_encoder_equals_library(text):
    got = packing.WordEncoder.get(WORDS).encode(text)
    want = TOK.encode(text, add_special_tokens=False).ids
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == want


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    enc, rng = packing.WordEncoder(WORDS), random.Random(4)
    for _ in range(40):
        text = " ".join("".join(rng.choices("abcdeéΩ.,'", k=rng.randint(1, 6))) for _ in range(30))
        assert enc.encode(text) == struct.pack(f"<{len(ids_of(text)) - 1}I", *ids_of(text)[:-1])
        assert len(enc.words) + len(enc.words.older) < 320


def test_other_tokenizer_encodes_whole_texts():
    path = default_tokenizer()
    enc, tok = packing.WordEncoder(path), Tokenizer.from_file(path)
    assert not enc.by_word
    text = "Two  spaces and 'signs'\n"
    got = enc.encode(text)
    assert list(struct.unpack(f"<{len(got) // 4}I", got)) == tok.encode(text, add_special_tokens=False).ids


def check(spark, path, rows, length):
    want = Counter()
    total = 0
    for d, text, *_ in rows:
        ids = ids_of(text)
        total += len(ids)
        for k, a in enumerate(range(0, len(ids), length)):
            want[d, k, a, tuple(ids[a:a + length])] += 1
    got, sequences = Counter(), packing.read_sequences(spark, path).collect()
    for r in sequences:
        at = 0
        assert len(r["token_ids"]) <= length
        for p in r["pieces"]:
            assert p["offset"] == at
            at += p["length"]
            got[p["doc_id"], p["piece"], p["start"], tuple(r["token_ids"][p["offset"]:at])] += 1
        assert at == len(r["token_ids"]) > 0
    assert got == want
    assert len({r["sequence_id"] for r in sequences}) == len(sequences)
    digests = packing.digests(spark, path).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in digests) == Counter({
        (d, k, a, len(i), zlib.crc32(struct.pack(f"<{len(i)}I", *i))): 0 for d, k, a, i in want}) + Counter(
        (d, k, a, len(i), zlib.crc32(struct.pack(f"<{len(i)}I", *i))) for d, k, a, i in want.elements())
    places = defaultdict(list)
    for r in digests:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(p), sorted(p)[1:])) and min(p)[0] == 0
    return len(sequences), math.ceil(total / length)


@pytest.mark.parametrize("kw", [{}, {"shard_ids": 2000}, {"open_ids": 300, "shard_ids": 700}])
def test_nothing_lost(spark, odd_docs, odd_rows, kw):
    path = packing.pack(odd_docs, WORDS, length=256, **kw)
    used, least = check(spark, path, odd_rows, 256)
    assert used <= least * 1.1 + 2


def test_pieces_that_never_fit_together(spark):
    rows = [(i, "word " * 39, "s") for i in range(60)]  # 40 ids each, 64 a sequence
    path = packing.pack(make_docs(spark, rows), WORDS, length=64, shard_ids=500)
    assert check(spark, path, rows, 64)[0] == 60


def test_few_sequences(spark):
    rng = random.Random(8)
    rows = [(i, "word " * int(rng.expovariate(1 / 60)), "s") for i in range(3000)]
    path = packing.pack(make_docs(spark, rows).repartition(6), WORDS, length=256)
    used, least = check(spark, path, rows, 256)
    assert used <= least * 1.005 + 1


def test_empty_table(spark, no_docs):
    path = packing.pack(no_docs, WORDS)
    assert packing.read_sequences(spark, path).collect() == [] == packing.digests(spark, path).collect()


def test_place_by_sum_of_squares():
    """Each placement against all choices tried out."""
    rng = random.Random(2)
    bins, gaps = packing.Packer(30), []
    for n in range(400):
        size = rng.randint(1, 30)

        def squares(g):
            return sum(v * v for k, v in Counter(g).items() if 0 < k < 30)
        options = [(squares([*gaps, 30 - size]), 1, 30 - size, None)]
        options += [(squares([x for j, x in enumerate(gaps) if j != i] + [g - size]), 0, g - size, i)
                    for i, g in enumerate(gaps) if g >= size]
        best = min(options, key=lambda o: o[:3])
        if best[3] is not None:
            gaps.pop(best[3])
        gaps = [g for g in [*gaps, best[2]] if g]
        bins.place((n, 0, 0, b"\0" * 4 * size), size)
        held = Counter({g: len(s) for g, s in bins.open.items() if s})
        assert held == Counter(gaps) and all(bins.count[g] == v for g, v in held.items())
